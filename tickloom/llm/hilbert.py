"""Hilbert-curve sharding: metadata dimensions are quantised, rows sorted by curve index and cut in equal runs.

DataFrame functions only. The curve is walked with a table of states that is made from the curve's rule; each
state is an entry corner and a direction, each digit holds one bit of every dimension.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import partitions, stored

BITS = 6
SHARDS = 24


@dataclass(frozen=True)
class Curve:
    """``step[state * 2**dims + digit]`` is (next state) * 2**dims + (digit of the curve index)."""

    dims: int
    step: tuple[int, ...]


def curve(dims: int) -> Curve:
    """The state table for ``dims`` dimensions, from Gray codes and rotations."""
    size = 1 << dims

    def rotate_left(x: int, by: int) -> int:
        by %= dims
        return (x << by | x >> (dims - by)) & (size - 1)

    def gray(x: int) -> int:
        return x ^ x >> 1

    def trailing_ones(x: int) -> int:
        n = 0
        while x >> n & 1:
            n += 1
        return n

    rank = {gray(w): w for w in range(size)}
    step = []
    for state in range(size * dims):
        entry, direction = divmod(state, dims)
        for digit in range(size):
            w = rank[rotate_left(digit ^ entry, dims - (direction + 1) % dims)]
            corner = gray(2 * ((w - 1) // 2)) if w else 0
            turn = 0 if w == 0 else trailing_ones(w if w % 2 else w - 1) % dims
            following = (entry ^ rotate_left(corner, direction + 1)) * dims + (direction + turn + 1) % dims
            step.append(following * size + w)
    return Curve(dims, tuple(step))


def curve_index(dims: Sequence[Column], bits: int = BITS) -> Column:
    """Index on the curve of a point whose coordinates have ``bits`` bits each; dimension 0 is the lowest bit of a digit."""
    c = curve(len(dims))
    size = 1 << c.dims
    step = F.array(*[F.lit(x) for x in c.step])

    def digit(plane: Column) -> Column:
        total = F.lit(0)
        for k, x in enumerate(dims):
            total = total + F.pmod(F.floor(x / F.pow(F.lit(2.0), plane)), F.lit(2)).cast("int") * (1 << k)
        return total

    def walk(acc: Column, plane: Column) -> Column:
        found = F.element_at(step, acc["state"] * size + digit(plane) + 1)
        return F.struct(
            F.floor(found / size).cast("int").alias("state"),
            (acc["index"] * size + F.pmod(found, F.lit(size))).cast("long").alias("index"),
        )

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))
    planes = F.array(*[F.lit(p) for p in reversed(range(bits))])
    return F.aggregate(planes, start, walk, lambda acc: acc["index"])


def size_level(size: Column) -> Column:
    """Logarithmic level of a positive whole number: two levels per doubling, 0 to 63, from integers only."""
    bits = F.bin(size.cast("long"))
    exponent = F.length(bits) - 1
    half = F.when(F.substring(bits, 2, 1) == "1", 1).otherwise(0)
    return F.least(F.lit(63), exponent * 2 + half).cast("int")


def name_level(name: Column) -> Column:
    """A name's place on a dimension, 0 to 63; null has place 0."""
    return F.coalesce(F.pmod(F.crc32(name.cast("binary")), F.lit(64)), F.lit(0)).cast("int")


def positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``_pos`` (gapless from 0 in the order given, nulls first) and ``_rows`` (their number).

    Rows are range-partitioned, written once, counted per range and numbered inside each range, so no task sees more
    than one range. Rows that tie in every column of ``order`` may still be cut into different ranges.
    """
    spark = df.sparkSession
    ranged = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(partitions(spark), *order, "_tie")
        .withColumn("_range", F.spark_partition_id())
    )
    ranged = stored(ranged, "ranges")
    # One row per range: the windows over them are as long as the number of shuffle partitions.
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.partitionBy()).alias("_rows"),
    )
    inside = Window.partitionBy("_range").orderBy(*order, "_tie")
    numbered = ranged.withColumn("_at", F.row_number().over(inside)).join(F.broadcast(starts), "_range")
    return numbered.withColumn("_pos", F.col("_start") + F.col("_at") - 1).drop("_range", "_tie", "_at", "_start")


def hilbert_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    dims: Sequence[str] = ("source", "lang"),
    bits: int = BITS,
) -> DataFrame:
    """One row per document: its id, ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``, ``curve_index``, ``shard``, ``slot``.

    Dimensions: the logarithmic level of the size, and a level for each name column of ``dims`` that the table has.
    Shards are runs of the curve order with row counts at most one apart; inside one cell, rows are ordered by size,
    checksum and id, so equal texts of one source and language lie together. A shard's rows share narrow ranges of all
    dimensions, which lets a reader skip files.

    Null text counts no bytes and has the checksum of the empty text; null names and ids are placed first; repeated rows
    get slots of their own; an empty table gives an empty result; further columns of the table are not read.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        *[name_level(F.col(f"`{c}`")).alias(f"_d{k}") for k, c in enumerate(dims) if c in docs.columns],
    )
    levels = [size_level(F.col("size")), *[F.col(c) for c in rows.columns if c.startswith("_d")]]
    rows = rows.withColumn("curve_index", curve_index(levels, bits))
    placed = positions(rows.select("_id", "size", "text_crc32", "curve_index"), ["curve_index", "size", "text_crc32", "_id"])
    exact = F.expr(f"(_pos * {shards}L) div _rows")
    first = F.expr(f"(shard * _rows + {shards - 1}L) div {shards}L")
    return (
        placed.withColumn("shard", exact.cast("int"))
        .withColumn("slot", F.col("_pos") - first)
        .select(F.col("_id").alias(id_col), "size", "text_crc32", "curve_index", "shard", "slot")
    )


def write_shards(assigned: DataFrame, docs: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write whole documents in one folder per shard, ordered by slot. Ids must be unique here."""
    whole = docs.join(assigned.select(id_col, "shard", "slot"), id_col)
    whole.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
