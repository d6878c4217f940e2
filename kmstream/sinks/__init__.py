"""B-1..B-7: sinks. Executors write; nothing is collected to the driver."""

from kmstream.sinks.tables import centers_text, console, write_table, write_text

__all__ = ["centers_text", "console", "write_table", "write_text"]
