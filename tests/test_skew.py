"""Splitting hot keys and carrying copies as counts."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from perimeter.operators import skew
from perimeter.operators.skew import (
    count_copies,
    counted_join,
    expand_copies,
    keyed_join,
    measure_hot_keys,
    set_join,
)


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the left rows share one key, which is hot on the right as well."""
    left = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL "
        "ELSE concat('k', id % 40) END AS key",
        "id AS l",
    )
    right = spark.range(120).selectExpr(
        "CASE WHEN id % 4 = 0 THEN 'hot' ELSE concat('k', id % 60) END AS key", "id AS r"
    )
    return left, right


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_split_inner_join(sides):
    left, right = sides
    plain = rows(left.join(right, "key"))
    for hot_left, hot_right in (({"hot": 7}, {}), ({}, {"hot": 3}), ({"hot": 7, "k1": 2}, {"hot": 3})):
        assert rows(keyed_join(left, right, "key", "inner", hot_left, hot_right)) == plain


def test_split_outer_and_semi_joins(sides):
    left, right = sides
    unique = right.groupBy("key").agg(F.min("r").alias("r"))
    for how in ("left", "left_semi", "left_anti"):
        plain = rows(left.join(unique, "key", how))
        assert rows(keyed_join(left, unique, "key", how)) == plain
        assert rows(keyed_join(left, unique, "key", how, {"hot": 5})) == plain
    ids = unique.select("key")
    twice = left.unionByName(left)
    plain = rows(left.join(ids, "key", "left_semi"))
    for hot in ({}, {"hot": 5}):
        assert set(rows(set_join(twice, ids, "key", hot_left=hot))) == set(plain)
        counted = counted_join(twice, ids, "key", hot_left=hot)
        totals = counted.groupBy("key", "l").agg(F.sum("n").alias("n"))
        assert rows(totals) == Counter((*row, 2) for row in plain)


def test_hot_rows_are_spread(spark, sides):
    """With shuffled joins no task gets more than its split of the hot key."""
    left, right = sides
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def largest(df):
            per_task = df.where("key = 'hot'").groupBy(F.spark_partition_id().alias("task")).count()
            return max(r["count"] for r in per_task.collect())

        spark.conf.set("spark.sql.adaptive.enabled", "false")
        ids = right.select("key").distinct()
        assert largest(keyed_join(left, ids, "key", "left_semi")) == 1000
        assert largest(keyed_join(left, ids, "key", "left_semi", {"hot": 64})) < 400
        # A third of the rows without key, with and without hot keys beside them.
        mixed = left.withColumn("key", F.when(F.expr("l % 3 = 0"), F.lit(None)).otherwise(F.col("key")))
        for hot in ({}, {"hot": 64}):
            matched = keyed_join(mixed, ids.withColumn("m", F.lit(1)), "key", "left", hot)
            missing = matched.where("key IS NULL")
            per_task = missing.groupBy(F.spark_partition_id()).count().collect()
            assert missing.where("m IS NOT NULL").count() == 0
            assert max(r["count"] for r in per_task) < 0.4 * sum(r["count"] for r in per_task)
        # Copies that nothing sorts are dealt out by chunk.
        copies = spark.createDataFrame([("a", 3_000)], "name string, copies long")
        spread = expand_copies(copies, "copies", chunk=10)
        per_task = spread.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in per_task) == 3_000
        assert max(r["count"] for r in per_task) < 1_500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_measured_keys(spark, sides):
    left, right = sides

    def weighted(name, df):
        return df.selectExpr(f"'{name}' AS column", "key", "CAST(1 AS BIGINT) AS weight")

    both = weighted("l", left).unionByName(weighted("r", right))
    hot = measure_hot_keys(both, 100)
    assert hot.on("l") == {"hot": 10}
    assert hot.on("r") == {}
    assert hot.on("unknown") == {}
    nulls = left.selectExpr("'n' AS column", "CAST(NULL AS STRING) AS key", "1L AS weight")
    assert measure_hot_keys(nulls, 1000).on("n") == {None: 3}
    most = measure_hot_keys(both, rows_per_task=1, most=3)
    assert len(most.on("l")) + len(most.on("r")) == 3


def test_copies_survive_counting_and_chunks(spark):
    values = [("b",)] * 25 + [("a",)] * 3 + [(None,)] * 2
    df = spark.createDataFrame(values, "name string").repartition(4)
    counted = count_copies(df)
    assert rows(counted) == Counter([("b", 25), ("a", 3), (None, 2)])
    order = [F.col("name").asc_nulls_last()]
    for chunk in (1, 4, 25, 100):
        again = expand_copies(counted, "copies", order, chunk)
        assert [r.name for r in again.collect()] == ["a"] * 3 + ["b"] * 25 + [None] * 2
    assert rows(expand_copies(counted, "copies")) == rows(df)


def test_hot_keys_are_exact_whatever_share_of_keys_falls_into_a_group(spark, monkeypatch):
    rows = [("a", f"k{n % 7}" if n % 7 else None, n % 3) for n in range(300)] + [("b", "k1", 200), ("b", None, 1)]
    weighted = spark.createDataFrame(rows, "column string, key string, weight long")
    weights: dict = {}
    for column, key, weight in rows:
        weights[column, key] = weights.get((column, key), 0) + weight
    for groups in (1, 3, 1 << 14):
        monkeypatch.setattr(skew, "KEY_GROUPS", groups)
        for limit in (10, 42, 10_000):
            expected: dict = {}
            for (column, key), weight in weights.items():
                if weight > limit:
                    expected.setdefault(column, {})[key] = -(-weight // limit)
            assert skew.measure_hot_keys(weighted, limit).splits == expected
