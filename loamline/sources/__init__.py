"""Table scans, adapters from the driver tables, and writes."""
