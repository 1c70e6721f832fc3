"""Writers for split outputs, snapshots and reference extracts."""
