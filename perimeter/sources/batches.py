"""JSON-lines batches that can be appended again after a failure.

Every attempt to append a batch writes a folder of its own; the batch counts once its commit file,
which names that folder, is there. A broken-off attempt has none and is never read; a
batch that is already committed is left as it is. So a repeated append adds each line once.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from perimeter.sources.documents import write_jsonl

_COMMITS = "_commits"
_BATCH_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def _at(spark: SparkSession, *parts: str):
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _folder(spark: SparkSession, path: str, batch: str) -> str | None:
    """Folder of a committed batch. A commit file that was never filled commits nothing."""
    commit, system = _at(spark, path, _COMMITS, batch)
    if not system.exists(commit):
        return None
    stream = system.open(commit)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8") or None
    finally:
        stream.close()


def committed_batches(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of each committed batch; as many as there were appends."""
    commits, system = _at(spark, path, _COMMITS)
    if not system.exists(commits):
        return {}
    names = sorted(s.getPath().getName() for s in system.listStatus(commits))
    # A local file system keeps checksums beside the files, under names with a dot.
    folders = {n: _folder(spark, path, n) for n in names if _BATCH_ID.fullmatch(n)}
    return {n: f"{path}/{folder}" for n, folder in folders.items() if folder}


def append_batch(documents: DataFrame, path: str, batch: str, compression: str = "none") -> bool:
    """Append documents as the batch of this name; False if it was committed before.

    The lines are those of ``write_jsonl``. Of two drivers that append one batch at the same time the
    first to create the commit file wins, the other raises. Names are letters, digits, ``.``, ``_`` and ``-``.
    """
    if not _BATCH_ID.fullmatch(batch):
        raise ValueError(f"not a batch name: {batch!r}")
    spark = documents.sparkSession
    if _folder(spark, path, batch):
        return False
    folder = f"{batch}-{uuid.uuid4().hex}"
    write_jsonl(documents, f"{path}/{folder}", mode="errorifexists", compression=compression)
    commit, system = _at(spark, path, _COMMITS, batch)
    if system.exists(commit) and system.getFileStatus(commit).getLen() == 0:
        system.delete(commit, False)
    stream = system.create(commit, False)
    try:
        stream.write(bytearray(folder, "utf-8"))
    finally:
        stream.close()
    return True


def batch_paths(spark: SparkSession, path: str) -> list[str]:
    """Folders to read: those of committed batches, for ``read_lines`` and the like."""
    return list(committed_batches(spark, path).values())
