"""Sources: table scans, the fixture mapping, export files and probes."""
