"""Table scans and sinks."""
