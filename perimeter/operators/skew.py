"""Joins and copies that stay even when one key holds much of the data.

Two tools:

* ``keyed_join`` splits the hot keys of either side over several tasks. Which
  keys are hot comes from ``HotKeys``, measured once per inventory. A stale or
  empty measurement costs speed only: rows are never dropped and the join
  condition never changes.
* ``count_copies`` / ``expand_copies`` carry equal rows as one row and a count,
  so that copies are combined before any shuffle and given back at the end.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one key that one task handles without help.
ROWS_PER_TASK = 1_000_000
# Most hot keys of all columns together that the driver keeps.
MAX_HOT_KEYS = 1_000_000
# Copies of one row that one sort row stands for.
COPIES_PER_CHUNK = 100_000

# Groups of keys, by hash, that are weighed before the keys.
KEY_GROUPS = 1 << 14

Salts = Mapping[str | None, int]


_HOT_SCHEMA = "column string, key string, splits long"


@dataclass(frozen=True)
class HotKeys:
    """Number of splits of each hot key, per join column; the key may be NULL."""

    splits: Mapping[str, Salts] = field(default_factory=dict)

    def on(self, column: str) -> Salts:
        return self.splits.get(column, {})

    def store(self, spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
        rows = [(c, k, n) for c, salts in self.splits.items() for k, n in salts.items()]
        spark.createDataFrame(rows, _HOT_SCHEMA).coalesce(1).write.mode(mode).parquet(path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> HotKeys:
        found: dict[str, dict[str | None, int]] = {}
        for row in spark.read.schema(_HOT_SCHEMA).parquet(path).collect():
            found.setdefault(row["column"], {})[row["key"]] = row["splits"]
        return cls(found)


def measure_hot_keys(
    weighted: DataFrame, rows_per_task: int = ROWS_PER_TASK, most: int = MAX_HOT_KEYS
) -> HotKeys:
    """Hot keys of several columns in one job over ``(column, key, weight)`` rows.

    A key is hot if it holds more than ``rows_per_task`` rows, so there are at most all
    rows divided by that. Beyond ``most`` such keys (10^12 rows) a task takes more rows.
    """
    # No key weighs more than its group. Few groups fit into each task's memory, many keys don't.
    weighted = weighted.withColumn("_group", F.pmod(F.xxhash64("key"), F.lit(KEY_GROUPS)))
    per_group = weighted.groupBy("column", "_group").agg(F.sum("weight").alias("weight"))
    heavy = per_group.where(F.col("weight") > rows_per_task).select("column", "_group").collect()
    if not heavy:
        return HotKeys()
    groups = weighted.sparkSession.createDataFrame(heavy, "column string, _group long")
    weighted = weighted.join(groups, ["column", "_group"], "left_semi")
    per_key = weighted.groupBy("column", "key").agg(F.sum("weight").alias("weight"))
    counted = per_key.where(F.col("weight") > rows_per_task)
    found = counted.orderBy(F.desc("weight")).limit(most).collect()
    splits: dict[str, dict[str | None, int]] = {}
    for row in found:
        splits.setdefault(row["column"], {})[row["key"]] = -(-row["weight"] // rows_per_task)
    return HotKeys(splits)


def _splits_table(df: DataFrame, hot_left: Salts, hot_right: Salts) -> DataFrame:
    keys = sorted({*hot_left, *hot_right})
    return df.sparkSession.createDataFrame(
        pa.table(
            {
                "_hot": pa.array(keys, pa.string()),
                "_left_splits": pa.array([hot_left.get(k, 1) for k in keys], pa.int64()),
                "_right_splits": pa.array([hot_right.get(k, 1) for k in keys], pa.int64()),
            }
        )
    )


def _with_splits(df: DataFrame, key: str, splits: DataFrame) -> DataFrame:
    # Local rows, so Spark knows their size and broadcasts them if they are few.
    return df.join(splits, F.col(key) == F.col("_hot"), "left").drop("_hot")


def _spread(columns: list[str], splits: Column) -> Column:
    return F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in columns)), splits)


def _each(splits: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), splits - 1))


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    hot_left: Salts | None = None,
    hot_right: Salts | None = None,
) -> DataFrame:
    """Equi-join on ``key`` with hot keys split on either side.

    Rows of a hot left key are spread by a hash of the row and meet a copy of
    the matching right rows in every split, and the other way round. Both
    sides should hold no equal rows (see ``count_copies``), because equal rows
    hash alike. ``left`` deals out rows with a NULL key, which match nothing, by
    the hash of the row instead. For every type but ``inner`` the right side must be
    small per key, so only the left side is split.
    """
    hot_left = {k: n for k, n in (hot_left or {}).items() if k is not None}
    hot_right = (hot_right or {}) if how == "inner" else {}
    hot_right = {k: n for k, n in hot_right.items() if k is not None}
    if how == "left":
        return _left_join(left, right, key, hot_left)
    if not (hot_left or hot_right):
        return left.join(right, key, how)

    left_columns, right_columns = left.columns, right.columns
    one = F.lit(1).cast("bigint")
    splits = _splits_table(left, hot_left, hot_right)
    left, right = _with_splits(left, key, splits), _with_splits(right, key, splits)
    left_splits, right_splits = F.coalesce("_left_splits", one), F.coalesce("_right_splits", one)
    left_salts, right_salts = {}, {}
    if hot_left:
        left_salts["_left_salt"] = _spread(left_columns, left_splits)
        right_salts["_left_salt"] = _each(left_splits)
    if hot_right:
        left_salts["_right_salt"] = _each(right_splits)
        right_salts["_right_salt"] = _spread(right_columns, right_splits)
    left = _salted(left, left_columns, left_salts)
    right = _salted(right, right_columns, right_salts)
    return left.join(right, [key, *left_salts], how).drop(*left_salts)


def _left_join(left: DataFrame, right: DataFrame, key: str, hot_left: Salts) -> DataFrame:
    """Left join on a text key; rows without key get one of their own, which matches nothing."""
    left_columns, right_columns = left.columns, right.columns
    own = F.concat(F.lit("\0"), F.xxhash64(*(F.col(f"`{c}`") for c in left_columns)).cast("string"))
    missing = F.col(key).isNull()
    left_salts = {"_missing": missing, "_key": F.when(missing, own).otherwise(F.col(key))}
    right_salts = {"_key": F.col(key)}
    if hot_left:
        splits = _splits_table(left, hot_left, {})
        left, right = _with_splits(left, key, splits), _with_splits(right, key, splits)
        number = F.coalesce("_left_splits", F.lit(1).cast("bigint"))
        left_salts["_salt"] = _spread(left_columns, number)
        right_salts["_salt"] = _each(number)
    left = _salted(left, left_columns, left_salts).alias("l")
    right = _salted(right, right_columns, right_salts).alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in right_salts]
    joined = left.join(right, reduce(and_, same, ~F.col("l._missing")), "left")
    return joined.select(
        *(F.col(f"l.`{c}`") for c in left_columns),
        *(F.col(f"r.`{c}`") for c in right_columns if c != key),
    )


def set_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left_semi",
    hot_left: Salts | None = None,
) -> DataFrame:
    """``left`` as a set, whatever its keys, against a right side with one row per key.

    Equal rows are combined before the join, so what is left of a hot key can be split.
    """
    return keyed_join(left.distinct(), right, key, how, hot_left)


def counted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left_semi",
    hot_left: Salts | None = None,
    copies: str = "n",
) -> DataFrame:
    """As ``set_join``, with ``copies`` telling how many left rows each row stands for."""
    return keyed_join(count_copies(left, copies), right, key, how, hot_left)


def _salted(df: DataFrame, columns: list[str], salts: Mapping[str, Column]) -> DataFrame:
    return df.select(
        *(F.col(f"`{c}`") for c in columns), *(salt.alias(name) for name, salt in salts.items())
    )


def count_copies(rows: DataFrame, copies: str = "copies") -> DataFrame:
    """Distinct rows with how often each occurs; combined before the shuffle."""
    return rows.groupBy(*(F.col(f"`{c}`") for c in rows.columns)).agg(
        F.count(F.lit(1)).alias(copies)
    )


def expand_copies(
    rows: DataFrame,
    copies: Column | str,
    order: list[Column] | None = None,
    chunk: int = COPIES_PER_CHUNK,
) -> DataFrame:
    """Each row as often as ``copies`` says, sorted by ``order`` if given.

    Copies are cut into chunks before the sort, or else dealt out by chunk, so a row with
    very many copies is spread over tasks and no array grows beyond ``chunk``.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns if c != copies]
    total = F.col(copies) if isinstance(copies, str) else copies
    numbers = F.sequence(F.lit(0).cast("bigint"), F.floor((total - 1) / chunk))
    chunks = rows.select(*columns, total.alias("_copies"), F.explode(numbers).alias("_chunk"))
    if order:
        chunks = chunks.orderBy(*order, F.col("_chunk").asc())
    else:
        chunks = chunks.repartition(*columns, "_chunk")
    in_chunk = F.least(F.lit(chunk).cast("bigint"), F.col("_copies") - F.col("_chunk") * chunk)
    return chunks.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), in_chunk))).drop(
        "col"
    )
