"""Token totals by source, language and tokenizer version, maintained by signed deltas.

A batch of changes (inserts, revised counts, deletes) is turned into signed rows against the
current state of its documents: minus what was counted, plus what counts now. The rows go to
a ledger, their sums to a delta table; totals are the sum of all deltas. A batch is committed
once its delta table is complete. Committing it again changes nothing, and a commit that was
broken off goes on from the changes or the ledger if they were complete.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
VERSIONS = {"byte-bpe-50k": "byte_bpe_50k.tiktoken", "byte-bpe-multi-50k": "byte_bpe_multi_50k.tiktoken"}
# Pre-tokenization of byte-level BPE: a fixed value of these vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
KEYS = ("source", "lang", "version")
_CHANGES = ("doc_id", "version", "source", "lang", "tokens")


def load_ranks(file: str, folder: str = TOKENIZERS) -> dict[bytes, int]:
    """A vocabulary file, read by the driver; it travels to the tasks (about 1 MB)."""
    lines = Path(folder, file).read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}


def token_count(ranks: dict[bytes, int], name: str):
    """A column function: tokens of whole texts, 0 for null. Special tokens are ordinary text."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        coder = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pd.Series([len(coder.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return counted


def counts(
    documents: DataFrame, version: str, doc_id: str = "doc_id", text: str = "text", folder: str = TOKENIZERS
) -> DataFrame:
    """Insert changes: doc_id, version, source, lang, tokens of every document."""
    counted = token_count(load_ranks(VERSIONS[version], folder), version)
    return documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.lit(version).alias("version"),
        "source",
        "lang",
        counted(F.col(text)).alias("tokens"),
    )


class Rollup:
    """Totals under a folder that all executors share. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _files(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path
        system = path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return system, path

    def _complete(self, kind: str, batch: str) -> bool:
        system, path = self._files()
        return system.exists(path(f"{self.path}/{kind}/batch={batch}/_SUCCESS"))

    def batches(self) -> list[str]:
        """Ids of committed batches."""
        system, path = self._files()
        folder = path(f"{self.path}/deltas")
        if not system.exists(folder):
            return []
        names = [s.getPath().getName().removeprefix("batch=") for s in system.listStatus(folder)]
        return sorted(n for n in names if self._complete("deltas", n))

    def _read(self, kind: str, batches: list[str]) -> DataFrame | None:
        paths = [f"{self.path}/{kind}/batch={b}" for b in batches]
        return self.spark.read.parquet(*paths) if paths else None

    def state(self, batches: list[str] | None = None, wanted: DataFrame | None = None) -> DataFrame | None:
        """What counts now: doc_id, version, source, lang, tokens; of the ``wanted`` (doc_id, version) only."""
        ledger = self._read("ledger", self.batches() if batches is None else batches)
        if ledger is None:
            return None
        if wanted is not None:
            ledger = ledger.join(wanted, ["doc_id", "version"], "left_semi")
        return ledger.groupBy(*_CHANGES).agg(F.sum("sign").alias("times")).where("times > 0").drop("times")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Applies a batch; False if it had been committed already.

        ``changes`` has doc_id, version, source, lang, tokens; null tokens delete. A document
        counts once per version: a change replaces what was counted. Of several changes of one
        document in a batch the one with most tokens (then the larger source, lang) holds, and a
        delete only if it stands alone. Rows without id can't be found again: they are added.
        Deleting what isn't counted changes nothing. Null sources and languages are keys as
        others. An empty batch is committed, too.
        """
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
            raise ValueError("a batch id has letters, digits, _ and - only")
        if self._complete("deltas", batch):
            return False
        if not self._complete("ledger", batch):
            # Written once, as counting the tokens of a text costs more than all that follows.
            if not self._complete("changes", batch):
                changes.select(*_CHANGES).write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch}")
            rows = self._read("changes", [batch])
            keyed = rows.where("doc_id IS NOT NULL").groupBy("doc_id", "version").agg(
                F.max(F.struct("tokens", "source", "lang")).alias("c")
            )
            after = (
                keyed.select("doc_id", "version", "c.source", "c.lang", "c.tokens")
                .unionByName(rows.where("doc_id IS NULL"))
                .where("tokens IS NOT NULL")
                .withColumn("sign", F.lit(1))
            )
            before = self.state(wanted=keyed.select("doc_id", "version"))
            if before is not None:
                after = after.unionByName(before.withColumn("sign", F.lit(-1)))
            after.write.mode("overwrite").parquet(f"{self.path}/ledger/batch={batch}")
        signed = self._read("ledger", [batch])
        sums = signed.groupBy(*KEYS).agg(
            F.sum("sign").alias("documents"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens")
        )
        sums.write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, version, documents, tokens; keys without documents are left out."""
        deltas = self._read("deltas", self.batches())
        if deltas is None:
            return self.spark.createDataFrame(
                [], "source string, lang string, version string, documents long, tokens long"
            )
        sums = deltas.groupBy(*KEYS).agg(
            F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")
        )
        return sums.where("documents <> 0")


def without_repeated_lines(documents: DataFrame, text: str = "text") -> DataFrame:
    """Documents in which a line repeats, with its first occurrence only."""
    lines = F.array_distinct(F.split(F.col(text), "\n"))
    revised = documents.withColumn("_revised", F.array_join(lines, "\n"))
    return revised.where(F.col("_revised") != F.col(text)).withColumn(text, F.col("_revised")).drop("_revised")
