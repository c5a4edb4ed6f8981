"""Sources and sinks: declared table specs, file scans, the test-data adapter, writers."""
