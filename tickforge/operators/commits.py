"""Replacing a stored table in one commit.

A replacement is written beside the table (``<table>.new-<id>``).  The commit
is the creation of one empty file, ``<table>.commit-<id>-<files>-<bytes>``:
before it the table is the old folder, from then on it is the new one,
wherever its files are.  What follows only tidies up - the old folder goes,
the new one takes its name, the marker goes - and can be taken up again after
a crash at any point (`finish`, which every writer calls first).  The marker
states how many files and bytes the new folder has, so that a folder that a
store without atomic renames has moved in part is never taken for the table.

Writers of one table run one at a time: a second commit beside an open one is
an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class Files:
    """The few file-system calls that commits need."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def create(self, path: str) -> None:
        if not self._fs.createNewFile(self._path(path)):
            raise OSError(f"{path} exists already: another writer is replacing this table")

    def named(self, pattern: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.globStatus(self._path(pattern)) or [])

    def size(self, path: str) -> tuple[int, int]:
        """Number and bytes of the files below; (0, 0) if there is none."""
        if not self.exists(path):
            return 0, 0
        found = self._fs.getContentSummary(self._path(path))
        return found.getFileCount(), found.getLength()


def _open(files: Files, path: str) -> tuple[str, str, tuple[int, int]] | None:
    """An unfinished commit: its marker, its new folder and that folder's size."""
    markers = files.named(f"{path}.commit-*")
    if not markers:
        return None
    if len(markers) > 1:
        raise OSError(f"{path} has several open commits: {', '.join(markers)}")
    mark, count, length = markers[0].rsplit(".commit-", 1)[1].split("-")
    return f"{path}.commit-{mark}-{count}-{length}", f"{path}.new-{mark}", (int(count), int(length))


def current_folder(spark: SparkSession, path: str) -> str | None:
    """The folder that holds the table now; None if there is no table."""
    path = path.rstrip("/")
    files = Files(spark, path)
    commit = _open(files, path)
    if commit is None:
        return path if files.exists(path) else None
    _, new, size = commit
    for folder in (new, path):
        if files.size(folder) == size:
            return folder
    # the writer has just finished: its marker is gone by now
    if _open(files, path) is None and files.exists(path):
        return path
    raise OSError(f"{path} has an open commit whose files are not complete")


def finish(spark: SparkSession, path: str) -> None:
    """Tidy up after a commit that a crash has left open."""
    path = path.rstrip("/")
    files = Files(spark, path)
    commit = _open(files, path)
    if commit is not None:
        marker, new, size = commit
        if files.size(new) == size:
            files.delete(path)
            files.rename(new, path)
        elif files.size(path) == size:
            files.delete(new)
        else:
            raise OSError(f"{path} has an open commit whose files are not complete")
        files.delete(marker)
    for left in files.named(f"{path}.new-*"):        # of writers that never came to their commit
        files.delete(f"{path.rsplit('/', 1)[0]}/{left}" if "/" in path else left)


def replace(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Make the rows of ``df``, which may read the table, the table's content."""
    spark, path = df.sparkSession, path.rstrip("/")
    files = Files(spark, path)
    if _open(files, path) is not None:
        raise OSError(f"{path} has an open commit; call finish first")
    mark = uuid.uuid4().hex
    new = f"{path}.new-{mark}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    try:
        writer.parquet(new)
    except Exception:
        files.delete(new)      # our own folder, not committed
        raise
    count, length = files.size(new)
    files.create(f"{path}.commit-{mark}-{count}-{length}")     # may have come about even if it fails
    finish(spark, path)
    spark.catalog.refreshByPath(path)
