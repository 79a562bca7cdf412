"""Sources (text files, tables, events) and sinks."""
