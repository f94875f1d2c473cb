"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model counts character 4-grams (UTF-16 units, packed into one long) of all trusted
documents; lower orders count distinct continuations. Counts, discounts and back-off weights
are tables sharded by gram. Documents are dealt into blocks, one per partition; a block's
distinct grams are joined with the sharded tables, and the block scores its documents with what
comes back. So neither the model nor the occurrences of common grams are gathered anywhere.

Thresholds are quantiles of perplexities that trusted documents have under a model that hasn't
seen them: the trusted text is cut into two folds by a hash, and each fold is scored by a model
of the other one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perimeter.llm.shared import Scratch

ORDER = 4
START = 2  # pads the beginning of a text
# Text bytes of a block.
BLOCK_BYTES = 24 << 20
# Of trusted documents that the model hasn't seen (README).
QUANTILE = 0.99
# The model of all trusted text; 0 and 1 are those without that fold.
WHOLE = 2


def grams_of(text: str) -> np.ndarray:
    """The packed 4-gram that ends at each UTF-16 unit of the text."""
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16).astype(np.int64)
    padded = np.concatenate([np.full(ORDER - 1, START), units])
    packed = np.zeros(len(units), np.int64)
    for n in range(ORDER):
        packed = (packed << 16) | padded[n : n + len(units)]
    return packed


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts by fold, added up batch by batch of about 2 MB of text."""

    def emit(fold: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        counts = pd.Series(np.concatenate(parts)).value_counts(sort=False)
        columns = [
            pa.array(np.full(len(counts), fold, np.int32)),
            pa.array(counts.index.to_numpy()),
            pa.array(counts.to_numpy(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["fold", "gram", "times"])

    parts: dict[int, list[np.ndarray]] = {}
    sizes: dict[int, int] = {}
    for batch in batches:
        for fold, text in zip(batch["fold"].to_pylist(), batch["text"].to_pylist(), strict=True):
            parts.setdefault(fold, []).append(grams_of(text or ""))
            sizes[fold] = sizes.get(fold, 0) + len(parts[fold][-1])
            if sizes[fold] > 1 << 21:
                yield emit(fold, parts.pop(fold))
                sizes[fold] = 0
    for fold, rest in parts.items():
        if sizes[fold]:
            yield emit(fold, rest)


def _context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, 16)


def _by_model(values: dict) -> Column:
    """The value of the row's model; the only one where there is just one model, without a name."""
    if set(values) == {None}:
        return F.lit(values[None])
    return F.coalesce(*(F.when(F.col("model") == m, F.lit(v)) for m, v in values.items()), F.lit(1.0))


def _models(table: DataFrame) -> list[str]:
    """Column that tells models apart, where a table holds several."""
    return [c for c in table.columns if c == "model"]


def _discounts(counts: DataFrame) -> dict:
    """Modified Kneser-Ney discounts from the numbers of grams that occur 1 to 4 times, per model."""
    found = {}
    numbers = [F.count_if(F.col("times") == n).alias(f"n{n}") for n in (1, 2, 3, 4)]
    for row in counts.groupBy(*_models(counts)).agg(*numbers).collect():
        n1, n2, n3, n4 = (max(row[f"n{n}"], 1) for n in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        first, second, third = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
        held = min(max(first, 0.05), 0.95), min(max(second, 0.05), 1.9), min(max(third, 0.05), 2.9)
        found[row["model"] if "model" in counts.columns else None] = held
    return found


def _level(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """alpha per gram and gamma per context of one order."""
    discounts = _discounts(counts)
    by, times = _models(counts), F.col("times")
    one, two, more = (_by_model({m: d[n] for m, d in discounts.items()}) for n in range(3))
    discount = F.when(times == 1, one).when(times == 2, two).otherwise(more)
    contexts = (
        counts.groupBy(*by, _context(F.col("gram")).alias("context"))
        .agg(F.sum("times").alias("total"), F.sum(discount).alias("held"))
    )
    alphas = (
        counts.withColumn("context", _context(F.col("gram")))
        .join(contexts, [*by, "context"])
        .select(*by, "gram", ((times - discount) / F.col("total")).alias("alpha"))
    )
    return alphas, contexts.select(*by, "context", (F.col("held") / F.col("total")).alias("gamma"))


def gram_counts(trusted: DataFrame) -> DataFrame:
    """fold, gram, times: counts of all text by the column ``fold``."""
    sums = trusted.select("fold", "text").mapInArrow(_counted, "fold int, gram long, times long")
    return sums.groupBy("fold", "gram").agg(F.sum("times").alias("times"))


def models(counts: DataFrame, scratch: Scratch) -> list[tuple[DataFrame, DataFrame]]:
    """Per order from 4 down to 1: alpha by gram, gamma by context, from gram counts.

    The lower orders count how many different units precede. A column ``model`` of the counts
    tells models apart, which are built in the same passes.
    """
    levels, by = [], _models(counts)
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            shorter = F.col("gram").bitwiseAND((1 << 16 * order) - 1)
            counts = scratch.store(
                counts.select(*by, shorter.alias("gram")).groupBy(*by, "gram").agg(F.count(F.lit(1)).alias("times")),
                "counts",
            )
        levels.append(tuple(scratch.store(t, f"order{order}") for t in _level(counts)))
    return levels


def train(trusted: DataFrame, scratch: Scratch) -> list[tuple[DataFrame, DataFrame]]:
    """The model of all trusted text."""
    counts = gram_counts(trusted.select(F.lit(0).alias("fold"), "text")).drop("fold")
    return models(scratch.store(counts, "counts"), scratch)


def probabilities(grams: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """gram, log_p: interpolated from the unigram up. An unseen context leaves all to the next order.

    Where the levels hold several models, ``grams`` says in ``model`` which one to ask.
    """
    by = _models(grams)
    units = {r["model"] if by else None: r["n"] for r in levels[-1][0].groupBy(*by).agg(F.count(F.lit(1)).alias("n")).collect()}
    unknown = {m: 1.0 / (max(n, 1) + 1) for m, n in units.items()} or {None: 0.5}
    current = grams.withColumn("p", _by_model(unknown))
    for order, (alphas, gammas) in zip(range(1, ORDER + 1), reversed(levels), strict=True):
        part = F.col("gram").bitwiseAND((1 << 16 * order) - 1) if order < ORDER else F.col("gram")
        current = (
            current.withColumns({"part": part, "context": _context(part)})
            .join(alphas.withColumnRenamed("gram", "part"), [*by, "part"], "left")
            .join(gammas, [*by, "context"], "left")
            .select(
                *by,
                "gram",
                (F.coalesce("alpha", F.lit(0.0)) + F.coalesce("gamma", F.lit(1.0)) * F.col("p")).alias("p"),
            )
        )
    return current.select(*by, "gram", F.log("p").cast("float").alias("log_p"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch["text"].cast(pa.binary()).to_pylist()
        blobs = pa.array([compressor.compress(t or b"") for t in texts], pa.binary())
        columns = [batch["block"], batch["fold"], batch["doc_id"], batch["lang"], blobs]
        yield pa.RecordBatch.from_arrays(columns, ["block", "fold", "doc_id", "lang", "packed"])


def _text(blob: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(blob).decode("utf-8", "surrogatepass")


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, model, gram) without repeats in a task; it holds the distinct grams of its block."""
    held: dict[tuple[int, int], list[np.ndarray]] = {}
    sizes: dict[tuple[int, int], int] = {}

    def shrink(key: tuple[int, int]) -> None:
        held[key] = [pd.unique(np.concatenate(held[key]))]
        sizes[key] = 0

    for batch in batches:
        names = zip(batch["block"].to_pylist(), batch["fold"].to_pylist(), strict=True)
        for (block, fold), blob in zip(names, batch["packed"].to_pylist(), strict=True):
            grams = grams_of(_text(blob))
            for model in (WHOLE,) if fold is None else (WHOLE, fold):
                key = block, model
                held.setdefault(key, []).append(grams)
                sizes[key] = sizes.get(key, 0) + len(grams)
                if sizes[key] > 1 << 20:
                    shrink(key)
    for key in held:
        shrink(key)
        block, model = (np.full(len(held[key][0]), name, np.int32) for name in key)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (block, model, held[key][0])], ["block", "model", "gram"])


def _score(documents: pa.Table, known: pa.Table) -> pa.Table:
    lookups = {}
    for model in pc.unique(known["model"]).to_pylist():
        rows = known.filter(pc.equal(known["model"], model))
        lookups[model] = pd.Index(rows["gram"].to_numpy()), rows["log_p"].to_numpy().astype(np.float64)

    def perplexity(own: np.ndarray, model: int) -> float:
        grams, logs = lookups[model]
        place = grams.get_indexer(own)
        if (place < 0).any():
            raise ValueError("a gram of the block was not looked up")
        return float(np.exp(-logs[place].mean()))

    units, seen, unseen = [], [], []
    for fold, blob in zip(documents["fold"].to_pylist(), documents["packed"].to_pylist(), strict=True):
        own = grams_of(_text(blob))
        units.append(len(own))
        seen.append(perplexity(own, WHOLE) if len(own) else None)
        unseen.append(perplexity(own, fold) if len(own) and fold is not None else None)
    return pa.table(
        {
            "doc_id": documents["doc_id"],
            "lang": documents["lang"],
            "units": pa.array(units, pa.int64()),
            "perplexity": pa.array(seen, pa.float64()),
            "unseen": pa.array(unseen, pa.float64()),
            "trusted": pc.is_valid(documents["fold"]),
        }
    )


def perplexities(documents: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """doc_id, lang, units, perplexity, unseen, trusted; no perplexity for texts without characters.

    Trusted documents are those with a ``fold``; ``unseen`` is what the model without that fold
    makes of them. The blocks' documents are shuffled once: the plan reads one exchange for their
    distinct grams and for scoring, so both must take the same columns. A partition is one block.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    total = documents.agg(F.sum(F.octet_length(body))).first()[0] or 0
    count = max(1, -(-total // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).cast("int")
    dealt = (
        documents.select(block.alias("block"), "fold", "doc_id", "lang", body.alias("text"))
        .mapInArrow(_packed, "block int, fold int, doc_id long, lang string, packed binary")
        .repartitionById(count, F.col("block"))
    )
    wanted = dealt.mapInArrow(_distinct, "block int, model int, gram long")
    known = probabilities(wanted.select("model", "gram").distinct(), levels)
    by_block = wanted.join(known, ["model", "gram"]).repartitionById(count, F.col("block")).groupBy("block")
    return dealt.groupBy("block").cogroup(by_block).applyInArrow(
        _score, "doc_id long, lang string, units long, perplexity double, unseen double, trusted boolean"
    )


def classify(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    quantile: float = QUANTILE,
) -> DataFrame:
    """doc_id, lang, units, perplexity, threshold, trusted, keep per row.

    ``labels`` has doc_id, quality and perhaps toxic; quality 1 is trusted, unless a row of the
    same id has toxic 1. The threshold of a language is the ``quantile`` of its trusted documents'
    perplexity, out of fold or (if that is higher, as where a fold is empty) under the whole model;
    rows above it are not kept. A language without trusted documents (null is one) has no threshold
    and keeps all its texts. Null and empty texts have no perplexity and are not kept. Repeated
    rows are scored each.
    """
    scratch = Scratch(documents.sparkSession, "quality")
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        F.col(lang).cast("string").alias("lang"),
    )
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    if "toxic" in labels.columns:
        good = good.join(labels.where("toxic = 1").select("doc_id").distinct(), "doc_id", "left_anti")
    ids = scratch.store(good, "trusted")
    # Equal texts are of one fold, or a copy in the other would show a model what it is to be tested on.
    fold = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")
    trusted = rows.join(ids, "doc_id", "left_semi").withColumn("fold", fold)
    counts = scratch.store(gram_counts(trusted), "folds")
    # Model n knows all but fold n, the last one knows both.
    known = F.when(F.col("fold") == 0, F.array(F.lit(1), F.lit(WHOLE))).otherwise(F.array(F.lit(0), F.lit(WHOLE)))
    by_model = counts.select(F.explode(known).alias("model"), "gram", "times").groupBy("model", "gram")
    levels = models(scratch.store(by_model.agg(F.sum("times").alias("times")), "counts"), scratch)
    marked = rows.join(ids.withColumn("good", F.lit(True)), "doc_id", "left")
    asked = marked.withColumn("fold", F.when(F.col("good"), fold)).drop("good")
    scored = scratch.store(perplexities(asked, levels), "scored")
    measured = F.explode(F.array(F.struct(F.lit(True).alias("out"), F.col("unseen").alias("value")),
                                 F.struct(F.lit(False).alias("out"), F.col("perplexity").alias("value"))))
    limits = (
        scored.where("trusted AND perplexity IS NOT NULL")
        .select("lang", measured.alias("m"))
        .groupBy("lang", "m.out")
        .agg(F.percentile_approx("m.value", quantile, 10_000).alias("threshold"))
        .groupBy(F.col("lang").alias("_lang"))
        .agg(F.max("threshold").alias("threshold"))
    )
    keep = F.col("perplexity").isNotNull() & (F.col("perplexity") <= F.coalesce("threshold", "perplexity"))
    return (
        scored.join(limits, scored["lang"].eqNullSafe(limits["_lang"]), "left")
        .drop("_lang", "unseen")
        .withColumn("keep", keep)
    )
