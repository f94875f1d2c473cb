"""Language identification by compression.

Each language has a raw-content zstandard dictionary, cut from a bounded sample of labelled
texts. Of a text its letters count, lower-cased, with one blank between words. They are encoded
block by block with every dictionary; the language whose blocks are smallest together is
chosen, and the margin to the next one is the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

UNKNOWN = "und"
# Bound of the sample: pieces of text per language, and characters of a piece.
PIECES, PIECE = 96, 1_000
MAX_LANGUAGES = 500
# Bytes of text encoded at once: each block starts from the dictionary anew.
BLOCK = 2_048
# Short matches count: what two languages share is short, too.
ENCODING = {
    "window_log": 17,
    "chain_log": 17,
    "hash_log": 16,
    "search_log": 3,
    "min_match": 3,
    "target_length": 32,
    "strategy": zstandard.STRATEGY_LAZY,
    "write_checksum": False,
    "write_content_size": False,
    "write_dict_id": False,
}
# Starts every block: without it a short block would be kept as it is, whatever the dictionary.
HEAD = bytes(64)
# Below this share of the second-best size the choice is rejected.
MIN_MARGIN = 0.01
RESULT = "lang_pred string, score double, rejected boolean"


@dataclass(frozen=True)
class Dictionaries:
    """Language and dictionary content, languages of many texts first."""

    content: tuple[tuple[str, bytes], ...]


def remainder(doc_id: Column, of: int = 3) -> Column:
    """crc32 of the id as text, modulo ``of``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


# Marks belong to their letters: vowel signs of Indic scripts are marks.
_NO_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str) -> bytes:
    """Lower-cased words with one blank around each."""
    return f" {_NO_LETTERS.sub(' ', text).strip()} ".lower().encode("utf-8", "ignore")


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Dictionaries:
    """Dictionaries from at most ``PIECES`` different texts per language, drawn by their hash.

    Of a text at most ``PIECE`` characters go in, from a place given by its hash. Copies of a
    text count once; no other column has a say. Rows without language or letters teach nothing.
    """
    drawn = F.xxhash64(F.col(text))
    first = F.pmod(drawn, F.greatest(F.length(F.col(text)) - PIECE, F.lit(0)) + 1)
    usable = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), drawn.alias("drawn"), F.col(text).alias("text"), first.alias("first")
    )
    different = usable.groupBy("lang", "drawn").agg(F.count(F.lit(1)).alias("rows"))
    languages = different.groupBy("lang").agg(F.sum("rows").alias("texts")).orderBy(F.desc("texts"), "lang")
    names = [r["lang"] for r in languages.take(MAX_LANGUAGES + 1)]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    chosen = (
        different.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("drawn")))
        .where(F.col("n") <= PIECES)
        .select("lang", "drawn", "n")
    )
    # At most MAX_LANGUAGES times PIECES rows, so texts stay where they are; copies fold before they move.
    pieces = (
        usable.join(F.broadcast(chosen), ["lang", "drawn"])
        .select("lang", "n", F.substring("text", F.col("first").cast("int") + 1, F.lit(PIECE)).alias("piece"))
        .groupBy("lang", "n")
        .agg(F.min("piece").alias("piece"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("n", "piece"))).alias("pieces"))
    )
    found = {r["lang"]: b"".join(letters(p["piece"]) for p in r["pieces"]) for r in pieces.collect()}
    return Dictionaries(tuple((name, found[name]) for name in names))


class Classifier:
    """Encoders of all languages, made once per worker."""

    def __init__(self, dictionaries: Dictionaries) -> None:
        self.languages = [name for name, _ in dictionaries.content]
        form = zstandard.ZstdCompressionParameters(**ENCODING)
        self.plain = zstandard.ZstdCompressor(compression_params=form)
        self.encoders = []
        for _, content in dictionaries.content:
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=form)
            self.encoders.append(zstandard.ZstdCompressor(dict_data=raw, compression_params=form))

    def sizes(self, data: bytes) -> np.ndarray:
        """Encoded bytes of the whole text per language."""
        parts = [HEAD + data[n : n + BLOCK] for n in range(0, len(data), BLOCK)]
        return np.array([sum(len(e.compress(p)) for p in parts) for e in self.encoders])

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        if not self.encoders or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        data = letters(text)
        sizes = self.sizes(data)
        best = int(sizes.argmin())
        rest = np.delete(sizes, best)
        # With one language the margin is the one to encoding without dictionary.
        other = rest.min() if len(rest) else len(self.plain.compress(data))
        margin = float(max(0.0, 1.0 - sizes[best] / other))
        return self.languages[best], margin, margin < MIN_MARGIN


def identify(documents: DataFrame, dictionaries: Dictionaries, text: str = "text") -> DataFrame:
    """Adds lang_pred, score (0 to 1: saved share against the second-best) and rejected.

    Null texts and texts without a letter are ``und`` with score 0, rejected. Ties go to the
    language of more learned texts, with score 0. Columns of these names are replaced. The
    dictionaries (bounded by ``PIECES``, ``PIECE`` and ``MAX_LANGUAGES``) travel with the tasks.
    """

    @F.pandas_udf(RESULT)
    def chosen(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classifier = Classifier(dictionaries)
        for texts in batches:
            rows = [classifier.classify(t) for t in texts]
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "rejected"])

    names = ("lang_pred", "score", "rejected")
    found = documents.withColumn("__found", chosen(F.col(text)))
    return found.withColumns({n: F.col(f"__found.{n}") for n in names}).drop("__found")
