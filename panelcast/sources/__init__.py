"""Sources and sinks: text scans (fixed columns, wide year x month, daily), parquet, CSV, JSON."""
