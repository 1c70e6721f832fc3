"""Report configs, period windows, the derivation registry and whole reports."""
