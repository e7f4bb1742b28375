"""Writes that become visible at once: a hidden folder, and one rename."""

import uuid

STAGING = "_staging"


def _file_system(spark, path):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration())


def _path(spark, *parts):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(part.rstrip("/") for part in parts))


def commit(rows, path, place, replace=False):
    """Write rows as Parquet to a folder under ``path``, which ``place()`` names when they are written.

    The folder must be new, unless the write may ``replace`` it.

    Readers skip folders that begin with an underscore, so they see all files or none, also
    while others write: each write has a staging folder of its own. A write that fails leaves
    nothing. The rename is as atomic as the file system's; on an object store it is a copy.
    """
    spark = rows.sparkSession
    files = _file_system(spark, path)
    staged = _path(spark, path, STAGING, uuid.uuid4().hex)
    try:
        rows.write.parquet(staged.toString())
        target = _path(spark, path, place())
        files.mkdirs(target.getParent())
        if replace:
            files.delete(target, True)
        if files.exists(target) or not files.rename(staged, target):
            raise OSError(f"{target} can't be committed")
    except BaseException:
        files.delete(staged, True)
        raise
    return target.toString()


def folders(spark, path):
    """The names of the visible folders right below ``path``."""
    files, below = _file_system(spark, path), _path(spark, path)
    found = [entry.getPath().getName() for entry in files.listStatus(below) if entry.isDirectory()]
    return sorted(name for name in found if not name.startswith(("_", ".")))


def exists(spark, path):
    return _file_system(spark, path).exists(_path(spark, path))


def remove(spark, path):
    """Take a folder away, if it is there."""
    _file_system(spark, path).delete(_path(spark, path), True)
