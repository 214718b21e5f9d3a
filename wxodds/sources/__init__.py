"""Sources and sinks: test tables, derived landing data, topic I/O and serving-table sinks."""
