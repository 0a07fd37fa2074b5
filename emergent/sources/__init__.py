"""Sources and sinks: XML entity scan, delimited scans, stand-in tables, writers."""
