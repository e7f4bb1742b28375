"""File sources and the dictionary's casts."""

import warnings
from collections import namedtuple
from collections.abc import Mapping

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..config import table_columns, table_format, tables_by_name

# Type names a dictionary may use. Any other name leaves the column as read.
CASTS = {"string": "string", "integer": "int", "double": "double", "date": "date"}


def read_table(spark, file_format, path, schema=None):
    """Read one table. CSV has a header line, and all its columns are strings.

    A schema that is already known saves the job that looks into the files for it.
    """
    name = file_format.lower()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if name == "parquet":
        return reader.parquet(path)
    if name == "csv":
        return reader.option("header", "true").csv(path)
    try:
        return reader.format(name).load(path)
    except Exception as error:
        if not any(text in str(error) for text in ("DATA_SOURCE_NOT_FOUND", "Failed to find data source")):
            raise
        raise RuntimeError(f"format {file_format!r} needs its package on Spark's class path") from error


def _quoted(name):
    return "`" + name.replace("`", "``") + "`"


def _cast_entries(df, columns):
    """The dictionary entries that apply to ``df``, as (column, Spark type)."""
    present = set(df.columns)
    by_case = {name.lower(): name for name in df.columns}
    for column in columns:
        name, type_name = column["name"], column.get("dataType", "string").lower()
        if name in present:
            if type_name in CASTS:
                yield name, CASTS[type_name]
        elif name.lower() in by_case:
            warnings.warn(f"dictionary column {name!r} differs from {by_case[name.lower()]!r} in case; not cast")


def apply_dictionary(df, columns, on_bad_value="fail"):
    """Cast the named columns, all in one projection.

    ``on_bad_value="fail"`` leaves a value that does not fit to the session's ANSI
    setting, which raises by default; ``"null"`` makes it NULL.
    """
    if on_bad_value not in ("fail", "null"):
        raise ValueError("on_bad_value is 'fail' or 'null'")
    entries = list(_cast_entries(df, columns))
    if not entries:
        return df
    expressions = {name: F.col(_quoted(name)) for name in df.columns}
    for name, type_name in entries:
        source = expressions[name]
        expressions[name] = source.try_cast(type_name) if on_bad_value == "null" else source.cast(type_name)
    return df.select([expression.alias(name) for name, expression in expressions.items()])


def count_bad_values(df, columns):
    """How many values of each dictionary column do not fit its type."""
    counts = {}
    for name, type_name in _cast_entries(df, columns):
        value = F.col(_quoted(name))
        bad = F.count_if(value.isNotNull() & value.try_cast(type_name).isNull())
        counts[name] = bad.alias(name)
    if not counts:
        return df.sparkSession.createDataFrame([], "column string, bad_values bigint")
    return df.agg(*counts.values()).unpivot([], [_quoted(name) for name in counts], "column", "bad_values")


Checked = namedtuple("Checked", "good set_aside bad_values rows rows_set_aside")


def set_bad_rows_aside(df, columns, path):
    """Cast the named columns and part rows with values that don't fit from the others, in one pass.

    The table is read once, and written once to a new folder ``path``: as cast rows, and as
    rows to set aside, which keep their values as they were and name the columns at fault in
    ``bad_columns``. What is counted is observed by the write itself. Returns both as
    DataFrames, the number of bad values by column, and the numbers of rows. A column that the
    dictionary names twice counts once; of no columns, no row is bad.
    """
    entries = dict(_cast_entries(df, columns))
    values = {name: F.col(_quoted(name)) for name in df.columns}
    bad = {name: values[name].isNotNull() & values[name].try_cast(kind).isNull() for name, kind in entries.items()}
    at_fault = F.array_compact(F.array(*[F.when(wrong, F.lit(name)) for name, wrong in bad.items()], F.lit(None).cast("string")))
    cast = F.struct(*[(value.try_cast(entries[name]) if name in entries else value).alias(name) for name, value in values.items()])
    raw = F.struct(*[value.alias(name) for name, value in values.items()])
    rows = df.select(cast.alias("cast"), raw.alias("raw"), at_fault.alias("bad_columns"))
    is_bad = F.size("bad_columns") > 0
    rows = rows.select(F.when(~is_bad, F.col("cast")).alias("good"), F.when(is_bad, F.col("raw")).alias("bad"), "bad_columns",
                       F.when(is_bad, "set_aside").otherwise("good").alias("part"))
    seen, names = Observation(), list(entries)
    counts = [F.count_if(F.array_contains("bad_columns", name)).alias(f"bad_{at}") for at, name in enumerate(names)]
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("part") == "set_aside").alias("set_aside"), *counts)
    rows.write.partitionBy("part").parquet(path)
    found, stored = seen.get, df.sparkSession.read.schema(rows.schema).parquet(path)
    good = stored.where("part = 'good'").select("good.*")
    set_aside = stored.where("part = 'set_aside'").select("bad.*", "bad_columns")
    return Checked(good, set_aside, {name: found[f"bad_{at}"] for at, name in enumerate(names)}, found["rows"], found["set_aside"])


# Formats that take a schema as it was read. Others may keep their own, as a table format does.
_GIVEN_SCHEMA = {"PARQUET", "CSV", "ORC", "JSON"}


class Tables(Mapping):
    """The configured tables as lazy DataFrames, by logical name; each is read when asked for.

    ``schemas`` holds the schemas read so far by path, and may be shared by several
    sessions' tables: reading a schema takes a small job over the table's files.
    """

    def __init__(self, spark, data_config, dictionary, on_bad_value="fail", schemas=None):
        self._spark, self._dictionary, self._on_bad_value = spark, dictionary, on_bad_value
        self._entries, self._loaded = tables_by_name(data_config), {}
        self._schemas = {} if schemas is None else schemas

    def __getitem__(self, name):
        if name not in self._loaded:
            entry = self._entries[name]
            path, file_format = entry["path"], table_format(entry)
            read = read_table(self._spark, file_format, path, self._schemas.get(path))
            if file_format in _GIVEN_SCHEMA:
                self._schemas.setdefault(path, read.schema)
            self._loaded[name] = apply_dictionary(read, table_columns(self._dictionary, name), self._on_bad_value)
        return self._loaded[name]

    def __iter__(self):
        return iter(self._entries)

    def __len__(self):
        return len(self._entries)


def load_tables(spark, data_config, dictionary, on_bad_value="fail", schemas=None):
    """All of them at once, up to the first that cannot be read."""
    tables = Tables(spark, data_config, dictionary, on_bad_value, schemas)
    return {name: tables[name] for name in dict.fromkeys(table["logicalName"] for table in data_config.get("tables", []))}
