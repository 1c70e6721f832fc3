"""Shipment reporting on Spark: config-driven scans, enrichment, status rules and pivots."""
