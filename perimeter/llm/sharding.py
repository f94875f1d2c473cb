"""Placement of rows on shards by a permutation-filled lookup table.

Each shard has its own permutation of the slots of a prime-sized table. The
shards take turns, each claiming the first free slot of its permutation, until
the table is full. All shards hold nearly the same number of slots, and leaving
out one moves few slots besides its own. A row's key is hashed to a slot, so
its place is one look into the broadcast table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimeter.llm.shared import small_table

# Slots of the table: a prime, about 250 for each of 256 shards. It bounds what is broadcast.
TABLE_SIZE = 65_537
MAX_TABLE_SIZE = 4_000_037
SHARDS = 256


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(name: str, purpose: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), key=purpose, digest_size=8).digest(), "big")


def fill_table(
    shards: Sequence[str], size: int = TABLE_SIZE, weights: Mapping[str, int] | None = None
) -> list[int]:
    """The shard (its place in ``shards``) of every slot.

    ``size`` is a prime of at most ``MAX_TABLE_SIZE`` and at least the number of
    shards. A shard with weight w claims w slots in each turn (1 unless given).
    """
    if not _is_prime(size) or not len(shards) <= size <= MAX_TABLE_SIZE or not shards:
        raise ValueError("the table needs a prime size between the number of shards and its limit")
    if len(set(shards)) != len(shards):
        raise ValueError("shards must have different names")
    starts = [_number(s, b"start") % size for s in shards]
    steps = [_number(s, b"step") % (size - 1) + 1 for s in shards]
    turns = [(weights or {}).get(s, 1) for s in shards]
    if min(turns) < 0 or not any(turns):
        raise ValueError("weights must not be negative, and one must be positive")
    table, free, claimed = [-1] * size, size, [0] * len(shards)
    while free:
        for shard, turn in enumerate(turns):
            for _ in range(min(turn, free)):
                while table[slot := (starts[shard] + claimed[shard] * steps[shard]) % size] >= 0:
                    claimed[shard] += 1
                table[slot] = shard
                claimed[shard] += 1
                free -= 1
    return table


def shard_names(count: int) -> list[str]:
    return [f"shard-{n:05d}" for n in range(count)]


def place(
    rows: DataFrame,
    key: str,
    shards: Sequence[str],
    size: int = TABLE_SIZE,
    weights: Mapping[str, int] | None = None,
) -> DataFrame:
    """Adds ``slot`` and ``shard`` (int, the place in ``shards``).

    Equal keys are placed together. Rows without key are spread by the hash of the whole
    row, as they may be many. Columns of these names that the rows already have are
    replaced. Nulls, empty and long values elsewhere don't matter; an empty table stays empty.
    """
    table = fill_table(shards, size, weights)
    schema = pa.schema([("slot", pa.int32()), ("shard", pa.int32())])
    slots = small_table(
        rows.sparkSession, schema, [{"slot": n, "shard": s} for n, s in enumerate(table)]
    )
    rest = rows.drop(*(c for c in ("slot", "shard") if c != key))
    hashed = F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key).cast("string"))).otherwise(
        F.xxhash64(*(F.col(f"`{c}`") for c in rest.columns))
    )
    placed = rest.withColumn("__slot", F.pmod(hashed, F.lit(size)).cast("int"))
    if key in ("slot", "shard"):
        placed = placed.drop(key)
    table_rows = F.broadcast(slots.withColumnRenamed("slot", "__slot"))
    return placed.join(table_rows, "__slot").withColumnRenamed("__slot", "slot")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard. Rows are not shuffled: a task writes a file for each shard it meets."""
    placed.write.partitionBy("shard").parquet(path)
