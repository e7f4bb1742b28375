"""Business rules over tables, on Spark."""

from .config import find_table, read_config, table_columns, table_format
from .session import build_session, rule_session, stream_session, work_folder

__all__ = [
    "build_session", "find_table", "read_config", "rule_session", "stream_session", "table_columns",
    "table_format", "work_folder",
]
