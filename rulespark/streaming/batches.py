"""What micro-batches write, folded as they go on.

A batch is a folder that becomes visible at once; one that is tried again replaces its own.
Every ``fold`` batches, one holds what it and all before it come to, so a reader takes that
and the few after it. Folders that two such snapshots have made needless are taken away.
"""

from ..sources.commits import commit, exists, folders, remove

BATCH = "batch"
FOLD = 32


def _numbers(spark, folder):
    if not exists(spark, folder):
        return []
    return sorted(int(name.partition("=")[2]) for name in folders(spark, folder) if name.startswith(f"{BATCH}="))


def _is_snapshot(number, fold):
    return number % fold == fold - 1


def _path(folder, number):
    return f"{folder.rstrip('/')}/{BATCH}={number}"


def current(spark, folder, schema, before=None, fold=FOLD):
    """The rows of the last snapshot and of the batches after it, or up to a batch; None if there are none."""
    numbers = [number for number in _numbers(spark, folder) if before is None or number < before]
    snapshots = [number for number in numbers if number >= 0 and _is_snapshot(number, fold)]
    paths = [_path(folder, number) for number in numbers if not snapshots or number >= snapshots[-1]]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def save(rows, folder, number, reduced, fold=FOLD):
    """Write a batch's rows; in a snapshot, ``reduced`` of them and of all before."""
    spark = rows.sparkSession
    if _is_snapshot(number, fold):
        earlier = current(spark, folder, rows.schema, number, fold)
        rows = reduced(rows if earlier is None else earlier.unionByName(rows))
    commit(rows, folder, lambda: f"{BATCH}={number}", replace=True)
    if _is_snapshot(number, fold):
        for old in _numbers(spark, folder):
            if old < number - fold:
                remove(spark, _path(folder, old))

