"""Ordered windows per entity that stay bounded when one entity holds most of the rows.

A window task normally receives every row of its entity. An entity with too many rows is cut in blocks
along its order, at positions taken from a sample, so that (entity, block) groups hold about
``BLOCK_ROWS`` rows; the others stay whole. Each block also receives the few rows before it that a frame
can reach, computes, and drops them. The sample only places the cuts; every row is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators import trailing
from tickloom.operators.trailing import Trailing
from tickloom.plans import sizing
from tickloom.plans.sizing import Split
from tickloom.session import checkpointed

BLOCK = "_block"
_EDGES = "_edges"
_HALO = "_halo"
_SAMPLES_PER_BLOCK = 20
# Frame updates per row up to which window expressions are the faster way.
UPDATES_IN_WINDOWS = 40


def order_position(df: DataFrame, order: Sequence[str]) -> Column:
    """One double per row that never decreases along ``order`` (integer columns).

    Each later column becomes a fraction of a step of the one before. Rounding may give neighbours the
    same position, never the reverse order, so equal positions only share a block.
    """
    ends = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(order) for n, f in (("lo", F.min), ("hi", F.max))])
    row = ends.first()
    position: Column = F.lit(0.0)
    for i in reversed(range(len(order))):
        low = row[f"lo{i}"] or 0
        width = float((row[f"hi{i}"] or 0) - low + 1)
        position = (F.col(order[i]) - F.lit(low) + position) / F.lit(width)
    return position


def block_edges(df: DataFrame, group: Sequence[str], position: Column, split: Split) -> DataFrame:
    """Per hot group the ascending positions at which its blocks begin.

    Taken from every 20th row of a sample that holds 20 rows per block. Written once, so every part of a
    plan cuts at the same positions.
    """
    group = list(group)
    fraction = min(1.0, _SAMPLES_PER_BLOCK / split.block_rows)
    placed = df.select(*group, position.cast("double").alias("_position"))
    if group:
        placed = placed.join(sizing.lookup_side(split.hot.select(*group)), group, "left_semi")
    if fraction < 1.0:
        placed = placed.sample(fraction, seed=7)
    every = max(1, round(split.block_rows * fraction))
    number = F.row_number().over(Window.partitionBy(*group).orderBy("_position"))
    picked = placed.withColumn("_n", number).where(F.col("_n") % every == 0)
    return checkpointed(picked.groupBy(*group).agg(F.sort_array(F.collect_list("_position")).alias(_EDGES)))


def _edges_passed(edges: Column, position: Column) -> Column:
    """Number of edges at or below ``position``: a binary search by falling powers of two."""
    size = F.size(edges)

    def step(found: Column, power: Column) -> Column:
        at = found + power
        hit = F.when(at <= size, F.get(edges, at - 1) <= position).otherwise(F.lit(False))
        return F.when(hit, at).otherwise(found)

    powers = F.array(*[F.lit(2**k) for k in range(20, -1, -1)])
    return F.aggregate(powers, F.lit(0), step)


def in_blocks(df: DataFrame, group: Sequence[str], position: Column, edges: DataFrame, out: str = BLOCK) -> DataFrame:
    """Add the block number; rows of groups without edges are in block 0."""
    group = list(group)
    if group:
        placed = df.join(sizing.lookup_side(edges), group, "left")
    else:
        placed = df.withColumn(_EDGES, edges.select(_EDGES).scalar())
    passed = _edges_passed(F.col(_EDGES), position.cast("double"))
    return placed.withColumn(out, F.when(F.col(_EDGES).isNull(), F.lit(0)).otherwise(passed)).drop(_EDGES)


def with_blocks(df: DataFrame, entity: Sequence[str], order: Sequence[str], split: Split) -> DataFrame:
    position = order_position(df, order)
    return in_blocks(df, entity, position, block_edges(df, entity, position, split))


def _reaching_rows(
    blocked: DataFrame, entity: Sequence[str], order: Sequence[str], inputs: Sequence[str], reach: int
) -> DataFrame:
    """The rows that frames of later blocks look back to, one copy per block that needs them."""
    group = [*entity, BLOCK]
    newest_first = Window.partitionBy(*group).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        blocked.select(*dict.fromkeys([*group, *order, *inputs]))
        .withColumn("_k", F.row_number().over(newest_first))
        .where(F.col("_k") <= reach)
    )
    # Per entity: its non-empty blocks, with the reachable rows before each of them.
    by_block = Window.partitionBy(*entity).orderBy(BLOCK)
    blocks = (
        tails.groupBy(*group)
        .agg(F.max("_k").alias("_n"))
        .withColumn("_end", F.sum("_n").over(by_block))
        .withColumn(
            "_later",
            F.collect_list(F.struct(BLOCK, (F.col("_end") - F.col("_n")).alias("start"))).over(
                by_block.rowsBetween(1, reach)
            ),
        )
        .where(F.size("_later") > 0)
        .select(*group, "_end", "_later")
    )
    targets = F.filter("_later", lambda b: b["start"] - F.col("_end") + F.col("_k") <= reach)
    return (
        tails.join(blocks, group)
        .withColumn("_to", F.explode(F.transform(targets, lambda b: b[BLOCK])))
        .withColumn(BLOCK, F.col("_to"))
        .drop("_k", "_end", "_later", "_to")
        .withColumn(_HALO, F.lit(True))
    )


def entity_windows(
    df: DataFrame,
    items: Sequence[Trailing],
    *,
    entity: Sequence[str],
    order: Sequence[str],
    blocks: int | None = None,
    batches: bool | None = None,
) -> DataFrame:
    """Add trailing columns per entity in ``order``.

    Entities too large for one task are cut (``blocks`` forces it). Large inputs with many frame updates
    per row go through Arrow batches, others through window expressions (``batches`` forces either).
    """
    if batches is None:
        many = trailing.updates_per_row(items) > UPDATES_IN_WINDOWS
        batches = many and sizing.estimated_bytes(df) > sizing.ONE_TASK_BYTES
    add = trailing.add_in_batches if batches else trailing.add_in_windows
    split = sizing.find_split(df, entity, blocks)
    if split is None:
        return add(df, items, list(entity), list(order))
    inputs = list(dict.fromkeys(i.column for i in items))
    blocked = with_blocks(df, entity, order, split)
    # Only entities that were cut have rows to pass on.
    cut = blocked.join(sizing.lookup_side(split.hot.select(*entity)), list(entity), "left_semi")
    halo = _reaching_rows(cut, entity, order, inputs, trailing.reach(items))
    rows = blocked.withColumn(_HALO, F.lit(False)).unionByName(halo, allowMissingColumns=True)
    return add(rows, items, [*entity, BLOCK], list(order)).where(~F.col(_HALO)).drop(_HALO, BLOCK)
