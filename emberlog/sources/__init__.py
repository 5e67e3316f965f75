"""Sources and sinks: text lines, CSV records, topic logs, tables, bridge."""
