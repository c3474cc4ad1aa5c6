"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

A row's place is a function of its number, the number of rows and the seed alone: the permutation
needs no table, and anyone can compute where row ``i`` lies, or which row lies in a slot.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalflow.session import written

ROUNDS = 6
# Steps of a walk. One leaves the domain with a probability below 1/2, so that none takes this many.
WALK = 256


def _side(n: int) -> int:
    """Side of the smallest square that holds the numbers below ``n``."""
    side = math.isqrt(max(n, 1))
    return side if side * side >= n else side + 1


def _permuted(x: Column, side: int, seed: int) -> Column:
    """One pass of the Feistel network on the numbers below ``side`` squared."""
    pair = F.struct(F.floor(x / side).cast("long").alias("l"), F.pmod(x, F.lit(side)).cast("long").alias("r"))

    def turn(p: Column, i: Column) -> Column:
        key = F.pmod(F.xxhash64(F.lit(seed).cast("long"), i, p["r"]), F.lit(side).cast("long"))
        return F.struct(p["r"].alias("l"), F.pmod(p["l"] + key, F.lit(side).cast("long")).cast("long").alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), pair, turn, lambda p: p["l"] * side + p["r"])


def permute(number: Column, n: int, seed: int = 0) -> Column:
    """Place of row ``number`` among ``n`` rows: a bijection of ``0 .. n-1``.

    The network permutes a square just above ``n``; a value outside the rows walks on along its
    cycle until it is back inside (``WALK`` steps at most, an error beyond).
    """
    side = _side(n)
    steps = F.sequence(F.lit(1), F.lit(WALK))
    first = _permuted(number.cast("long"), side, seed)
    walked = F.aggregate(steps, first, lambda x, _: F.when(x >= n, _permuted(x, side, seed)).otherwise(x))
    place = F.when(first < n, first).otherwise(walked)
    return F.when(place < n, place).otherwise(F.raise_error(F.lit("a walk did not end")).cast("long"))


def shard_and_slot(place: Column, shards: int) -> tuple[Column, Column]:
    """Shard and slot of a place: places are dealt out in turn, so shard sizes differ by one at most."""
    return F.pmod(place, F.lit(shards)).cast("int"), F.floor(place / shards).cast("long")


def number_rows(df: DataFrame, order: Sequence[str], label: str = "numbered") -> tuple[DataFrame, int]:
    """``df`` with ``row_number`` 0, 1, ... in the order of ``order``, and the number of rows.

    The rows are range-partitioned, sorted and written once, so every task that is run again meets
    the same order. A row's number is its index within its partition plus the rows of the partitions
    before; that table has one row per partition. Give enough columns that large groups of ties don't
    land in one range; rows that tie in all of them are alike to this function.
    """
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*order)
    ranged = written(ranged.withColumn("__position", F.monotonically_increasing_id()), label)
    part = F.shiftright("__position", 33)
    sizes = [(r[0], r[1]) for r in ranged.groupBy(part.alias("part")).agg(F.count("*")).orderBy("part").collect()]  # one row per partition
    if not sizes:
        return ranged.withColumn("row_number", F.lit(0).cast("long")).drop("__position"), 0
    starts, total = [], 0
    for number, size in sizes:
        starts += [F.lit(number).cast("long"), F.lit(total).cast("long")]
        total += size
    start = F.element_at(F.create_map(*starts), part)
    index = F.col("__position").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn("row_number", start + index).drop("__position"), total


def feistel_shards(df: DataFrame, order: Sequence[str], shards: int = 40, seed: int = 0) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` and ``slot``; the sizes of the shards differ by one at most.

    Slots of a shard are gapless from 0. NULLs sort first. The same rows with the same seed get the
    same places on any cluster. Columns named like the new ones are replaced.
    """
    clash = {"row_number", "shard", "slot", "__position"}
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in clash])
    numbered, n = number_rows(df, order)
    shard, slot = shard_and_slot(F.col("place"), shards)
    placed = numbered.withColumn("place", permute(F.col("row_number"), n, seed) if n else F.lit(0).cast("long"))
    return placed.withColumn("shard", shard).withColumn("slot", slot).drop("place")


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 20240229) -> DataFrame:
    """Shard and slot of every document under the law of equal row counts.

    Rows are numbered by id, then checksum and size. The size is the UTF-8 length plus 16; a NULL text has none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")
    )
    placed = feistel_shards(rows, ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
