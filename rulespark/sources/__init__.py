from .database import execute_query, optional_table, read_database, write_database
from .files import Tables, apply_dictionary, count_bad_values, load_tables, read_table, set_bad_rows_aside
from .sinks import (
    append_results,
    append_status,
    compact_ledger,
    ledger_stream,
    read_ledger,
    read_results,
    result_path,
    write_results,
)

__all__ = [
    "Tables", "append_results", "append_status", "apply_dictionary", "compact_ledger", "count_bad_values", "execute_query",
    "ledger_stream", "load_tables", "optional_table", "read_database", "read_ledger", "read_results", "read_table", "result_path", "set_bad_rows_aside",
    "write_database", "write_results",
]
