"""Sources and sinks: partitioned scans, text readers, partition writers, staging (io.py)."""
