from holdfast.sources.adapter import order_tables
from holdfast.sources.tables import load, parse_timestamps, read_scored, read_table, write_scored

__all__ = ["load", "order_tables", "parse_timestamps", "read_scored", "read_table", "write_scored"]
