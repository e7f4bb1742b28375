"""Result files and the status ledger's files."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..model import LEDGER_SCHEMA, RESULT_COLUMNS, RESULT_DATA_COLUMNS, RESULT_SCHEMA
from .commits import commit, folders

#: The folders of a ledger: the last day that an append has rows of, and the append.
LAST_DAY, APPEND = "last_day", "append"
_STORED = StructType([*LEDGER_SCHEMA, StructField(LAST_DAY, DateType()), StructField(APPEND, StringType())])


def result_path(base, rule_id, run_id):
    for part in (rule_id, run_id):
        if not part or "/" in part or part in (".", ".."):
            raise ValueError(f"{part!r} cannot name a result folder")
    return f"{base.rstrip('/')}/{rule_id}/{run_id}"


def write_results(results, base, rule_id, run_id):
    """Save one run's result rows. A repeated attempt replaces the earlier one."""
    path = result_path(base, rule_id, run_id)
    results.write.mode("overwrite").parquet(path)
    return path


def read_results(spark, paths):
    """Result rows of any number of runs, in one scan. None stands for a run without rows."""
    paths = [path for path in paths if path is not None]
    if not paths:
        return spark.createDataFrame([], RESULT_SCHEMA)
    return spark.read.schema(RESULT_SCHEMA).parquet(*paths).select(*RESULT_SCHEMA.names)


def append_status(rows, path):
    """Append ledger rows, all visible at once, safe from other appends.

    An append is one folder with a file per task, in the folder of the last UTC day that it
    has rows of: that of the append itself, or a later one if rows are dated later. Rows from
    a time on are then in the folders from that day on, however old other rows of an append
    are. An append with undated rows is in the folder without a day.
    """
    last = Observation()
    created = F.col("created_dt")
    rows = rows.select(*LEDGER_SCHEMA.names).observe(
        last, F.max(F.unix_seconds("created_dt")).alias("seconds"), F.count_if(created.isNull()).alias("undated"))

    def place():
        seen = last.get
        if seen["undated"]:
            return f"{LAST_DAY}=__HIVE_DEFAULT_PARTITION__/{APPEND}={uuid.uuid4().hex}"
        day = max(datetime.now().timestamp(), seen["seconds"] or 0)
        return f"{LAST_DAY}={datetime.fromtimestamp(day, timezone.utc).date()}/{APPEND}={uuid.uuid4().hex}"

    commit(rows, path, place)


def read_ledger(spark, path, since=None):
    """The ledger; or what has no time, or one from ``since`` on, without listing older folders."""
    reader = spark.read.schema(_STORED)
    if since is None:
        return _recent(reader.parquet(path), None)
    days = [day for day in folders(spark, path) if not _is_before(day, since)]
    if not days:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return _recent(reader.option("basePath", path).parquet(*(f"{path.rstrip('/')}/{day}" for day in days)), since)


def _is_before(folder, since):
    name, _, day = folder.partition("=")
    return name != LAST_DAY or (day[:1].isdigit() and day < str(_utc_day(since)))


def ledger_stream(spark, path, since=None, files_per_look=1000):
    """Ledger rows as they are appended; undated ones and those from ``since`` on, if given.

    Each micro-batch takes at most ``files_per_look`` new files, and opens none of older appends.
    """
    rows = spark.readStream.schema(_STORED).option("maxFilesPerTrigger", files_per_look).parquet(path)
    return _recent(rows, since)


def _recent(rows, since):
    if since is not None:
        recent_day = F.col(LAST_DAY).isNull() | (F.col(LAST_DAY) >= F.lit(_utc_day(since)))
        recent = F.col("created_dt").isNull() | (F.col("created_dt") >= F.lit(since))
        rows = rows.where(recent_day & recent)
    return rows.select(*LEDGER_SCHEMA.names)


def compact_ledger(spark, path, into):
    """Write the whole ledger to a new folder, in few files, each with rows of a time.

    A reader of recent rows skips what is older by the files' own least and greatest times.
    Nothing is taken away: readers and writers go over to the new folder when none of
    them is at work, and the old one may go then.
    """
    rows, dated = read_ledger(spark, path), F.col("created_dt").isNotNull()
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    append_status(rows.where(dated).repartitionByRange(parts, "created_dt", "rule_run_id"), into)
    undated = rows.where(~dated)
    if not undated.isEmpty():
        append_status(undated.repartition(parts), into)


def _utc_day(moment):
    return datetime.fromtimestamp(moment.timestamp(), timezone.utc).date()


def result_rows(entries):
    """Result rows from (rule_run_id, rule_id, data), where ``data`` maps the lower-case
    names of the result's data columns to text. An absent key becomes an empty text."""
    def value(name):
        key = F.lit(name.lower())
        return F.when(F.map_contains_key("data", key), F.col("data")[key]).otherwise("").alias(name)

    return entries.select(
        F.col("rule_run_id").alias(RESULT_COLUMNS[0]),
        F.col("rule_id").alias(RESULT_COLUMNS[1]),
        *[value(name) for name in RESULT_DATA_COLUMNS],
    )


def append_results(entries, path):
    """Append result rows, all visible at once, safe from other appends to the same folder."""
    commit(result_rows(entries), path, lambda: f"{APPEND}={uuid.uuid4().hex}")
