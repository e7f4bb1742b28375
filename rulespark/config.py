"""The two JSON documents of a run: where tables are, and their column types."""

import json


def read_config(path):
    with open(path, encoding="utf-8") as source:
        return json.load(source)


def tables_by_name(config):
    """The entries by logical name; of several with one name the first."""
    return {table["logicalName"]: table for table in reversed(config.get("tables", []))}


def find_table(config, logical_name):
    """The first entry with that logical name, or ``None``."""
    return tables_by_name(config).get(logical_name)


def table_columns(dictionary, logical_name):
    """The dictionary's columns for a table; empty if it has none."""
    columns = (find_table(dictionary, logical_name) or {}).get("schema", {}).get("RAW", [])
    if any(not column.get("name") for column in columns):
        raise ValueError(f"dictionary of table {logical_name!r} has a column without a name")
    return columns


def table_format(table):
    return table["kind"].get("RAW", "PARQUET").upper()
