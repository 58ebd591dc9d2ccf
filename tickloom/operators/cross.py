"""Ranks and z-scores within a snapshot or over the whole table.

Window form where each group fits one task. Otherwise ranks come from counted values: one row per
(group, value) with the number of rows before it, summed in blocks of the value range, joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.functions.scalar import EPS, conditional_zscore, spread_order
from tickloom.operators.blocks import BLOCK, block_edges, in_blocks, order_position
from tickloom.plans import sizing
from tickloom.plans.sizing import Split

RANK_METHODS = ("average", "min", "max", "dense", "ordinal", "random")


def counted_positions(
    df: DataFrame,
    value: str,
    group: Sequence[str] = (),
    then: Sequence[str] = (),
    split: Split | None = None,
) -> DataFrame:
    """Per distinct (group, value, then): row count ``n``, rows before it, distinct keys before it.

    Order is by value, then by the integer columns in ``then``. NULL values are left out. With ``split``
    the hot groups are summed in blocks of their value range.
    """
    group, then = list(group), list(then)
    known = df.where(F.col(value).isNotNull())
    counts = known.groupBy(*group, value, *then).agg(F.count("*").alias("n"))
    along = [value, *then]
    if split is None:
        w = Window.partitionBy(*group).orderBy(*along)
        return counts.withColumns(
            {"before": F.sum("n").over(w) - F.col("n"), "distinct_before": F.row_number().over(w) - 1}
        )
    # Edges come from the rows, so a value held by many rows only repeats an edge.
    cut = in_blocks(counts, group, F.col(value), block_edges(known, group, F.col(value), split))
    by_block = Window.partitionBy(*group).orderBy(BLOCK)
    offsets = (
        cut.groupBy(*group, BLOCK)
        .agg(F.sum("n").alias("_rows"), F.count("*").alias("_keys"))
        .select(
            *group,
            BLOCK,
            (F.sum("_rows").over(by_block) - F.col("_rows")).alias("_rows_before"),
            (F.sum("_keys").over(by_block) - F.col("_keys")).alias("_keys_before"),
        )
    )
    w = Window.partitionBy(*group, BLOCK).orderBy(*along)
    return (
        cut.withColumns({"_r": F.sum("n").over(w) - F.col("n"), "_d": F.row_number().over(w) - 1})
        .join(offsets, [*group, BLOCK])
        .select(
            *group,
            *along,
            "n",
            (F.col("_r") + F.col("_rows_before")).alias("before"),
            (F.col("_d") + F.col("_keys_before")).alias("distinct_before"),
        )
    )


def _check_method(method: str, tiebreak: Sequence[str]) -> None:
    if method not in RANK_METHODS:
        raise ValueError(f"unknown rank method {method!r}, choose from {list(RANK_METHODS)}")
    if method in ("ordinal", "random") and not tiebreak:
        raise ValueError(f"method {method!r} needs tiebreak columns")


def ranked(
    df: DataFrame,
    column: str,
    group: Sequence[str] = (),
    method: str = "average",
    out: str = "rank",
    tiebreak: Sequence[str] = (),
    seed: int = 42,
    blocks: int | None = None,
) -> DataFrame:
    """Add the rank of ``column`` within ``group``; NULL stays NULL.

    ``ordinal`` breaks ties by ``tiebreak``, ``random`` by a hash of it.
    """
    _check_method(method, tiebreak)
    group = list(group)
    split = sizing.find_split(df, group, blocks)
    return _ranked(df, column, group, method, out, tiebreak, seed, split)


def _ranked(
    df: DataFrame,
    column: str,
    group: list[str],
    method: str,
    out: str,
    tiebreak: Sequence[str],
    seed: int,
    split: Split | None,
) -> DataFrame:
    if split is None:
        return df.withColumn(out, _window_rank(column, group, method, tiebreak, seed))
    if method in ("ordinal", "random"):
        return _distributed_row_rank(df, column, group, method, out, tiebreak, seed, split)
    at = counted_positions(df, column, group, split=split)
    n, before = F.col("n"), F.col("before")
    rank = {
        "average": before + (n + 1) / 2,
        "min": before + 1,
        "max": before + n,
        "dense": F.col("distinct_before") + 1,
    }[method]
    side = at.select(*group, column, rank.cast("double").alias(out))
    return df.join(side, [*group, column], "left").select(*df.columns, out)


def _window_rank(column: str, group: list[str], method: str, tiebreak: Sequence[str], seed: int) -> Column:
    by_value = F.col(column).asc_nulls_last()
    w = Window.partitionBy(*group).orderBy(by_value)
    # Rows with the same value, in the same sort as the rank.
    peers = F.count("*").over(w.rangeBetween(Window.currentRow, Window.currentRow))
    if method == "average":
        rank = F.rank().over(w) + (peers - 1) / 2
    elif method == "min":
        rank = F.rank().over(w)
    elif method == "max":
        rank = F.rank().over(w) + peers - 1
    elif method == "dense":
        rank = F.dense_rank().over(w)
    else:
        hashed = [spread_order(F.col(tiebreak[-1]), seed)] if method == "random" else []
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(by_value, *hashed, *tiebreak))
    return F.when(F.col(column).isNotNull(), rank.cast("double"))


def _distributed_row_rank(
    df: DataFrame,
    column: str,
    group: list[str],
    method: str,
    out: str,
    tiebreak: Sequence[str],
    seed: int,
    split: Split,
) -> DataFrame:
    """Row numbers from counts per (group, value, tie block) plus a number within the block.

    Tie blocks cut the tie-break order of a hot group, so a value that many of its rows share is cut too.
    """
    hashed = [spread_order(F.col(tiebreak[-1]), seed)] if method == "random" else []
    position = hashed[0] if hashed else order_position(df, tiebreak)
    edges = block_edges(df, group, position, split)
    tied = in_blocks(df, group, position, edges, out="_tie")
    at = counted_positions(tied, column, group, then=["_tie"], split=split)
    keys = [*group, column, "_tie"]
    within = [*hashed, *[F.col(c) for c in tiebreak]]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*within))
    numbered = tied.withColumn("_number", number)
    rank = F.when(F.col(column).isNotNull(), (F.col("before") + F.col("_number")).cast("double"))
    joined = numbered.join(at.select(*keys, "before"), keys, "left")
    return joined.withColumn(out, rank).select(*df.columns, out)


def group_moments(df: DataFrame, columns: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of each column per group."""
    return df.groupBy(*group).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_samp(c).alias(f"{c}_std") for c in columns],
    )


def with_group_moments(
    df: DataFrame,
    columns: Sequence[str],
    group: Sequence[str],
    blocks: int | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add ``{c}_mean`` and ``{c}_std`` of the row's group.

    ``sized_by`` is a table with the same rows in which groups are cheaper to count.
    """
    split = sizing.find_split(df if sized_by is None else sized_by, group, blocks)
    return _with_moments(df, columns, group, split)


def _with_moments(df: DataFrame, columns: Sequence[str], group: Sequence[str], split: Split | None) -> DataFrame:
    if split is None:
        w = Window.partitionBy(*group)
        return df.withColumns(
            {f"{c}_mean": F.avg(c).over(w) for c in columns}
            | {f"{c}_std": F.stddev_samp(c).over(w) for c in columns}
        )
    side = sizing.lookup_side(group_moments(df, columns, group))
    return df.join(side, list(group), "left")


def xs_rank(
    df: DataFrame,
    columns: Sequence[str],
    group: Sequence[str] = tuple(S.SNAPSHOT),
    method: str = "average",
    normalize: bool = True,
    tiebreak: Sequence[str] = (),
    seed: int = 42,
    blocks: int | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Rank within the snapshot; with ``normalize`` centred and scaled by the snapshot's ranks."""
    _check_method(method, tiebreak)
    keep = df.columns
    names = [f"{c}_xrank" for c in columns]
    split = sizing.find_split(df if sized_by is None else sized_by, group, blocks)
    for c, name in zip(columns, names):
        df = _ranked(df, c, list(group), method, name, tiebreak, seed, split)
    if not normalize:
        return df
    df = _with_moments(df, names, group, split)
    scaled = [
        ((F.col(n) - F.col(f"{n}_mean")) / (F.col(f"{n}_std") + F.lit(EPS))).alias(f"{n}_norm") for n in names
    ]
    return df.select(*keep, *scaled)


def xs_zscore(
    df: DataFrame,
    columns: Sequence[str],
    group: Sequence[str] = tuple(S.SNAPSHOT),
    blocks: int | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """(x - mean) / (sample deviation + 1e-8) within the snapshot."""
    moments = with_group_moments(df, columns, group, blocks, sized_by)
    scaled = [
        ((F.col(c) - F.col(f"{c}_mean")) / (F.col(f"{c}_std") + F.lit(EPS))).alias(f"{c}_xzscore")
        for c in columns
    ]
    return moments.select(*df.columns, *scaled)


def cs_zscore_safe(
    df: DataFrame,
    columns: Sequence[str],
    group: Sequence[str] = tuple(S.SNAPSHOT),
    blocks: int | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """(x - mean) / deviation where the deviation is usable, else 0; as float."""
    moments = with_group_moments(df, columns, group, blocks, sized_by)
    scaled = [
        conditional_zscore(F.col(c), F.col(f"{c}_mean"), F.col(f"{c}_std")).cast("float").alias(f"{c}_cs_zscore")
        for c in columns
    ]
    return moments.select(*df.columns, *scaled)


def rank_percentile(
    df: DataFrame, columns: Sequence[str], suffix: str = "_pct", blocks: int | None = None
) -> DataFrame:
    """Average rank over all rows divided by the row count."""
    total = df.agg(F.count("*")).scalar()
    keep = df.columns
    split = sizing.find_split(df, [], blocks)
    for c in columns:
        at = counted_positions(df, c, split=split)
        pct = ((F.col("before") + (F.col("n") + 1) / 2) / total).alias(f"{c}{suffix}")
        df = df.join(at.select(c, pct), c, "left")
    return df.select(*keep, *[f"{c}{suffix}" for c in columns])


def exact_medians(df: DataFrame, columns: Sequence[str], blocks: int | None = None) -> DataFrame:
    """Exact median per column as (column, median).

    A sketch brackets each median within a few percent of the rows. One pass counts the rows below and
    inside the brackets, which proves that they hold the middle; a bracket that does not is opened. Then
    only the values inside are counted and ordered.
    """
    columns = list(columns)
    # NaN is missing.
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    brackets = []
    for ends in values.approxQuantile(columns, [0.49, 0.51], 0.002):
        brackets.append((ends[0], ends[1]) if ends else (None, None))
    tallies = []
    for i, (c, (low, high)) in enumerate(zip(columns, brackets)):
        tallies.append(F.count(c).alias(f"n{i}"))
        tallies.append(F.count_if(F.col(c) < F.lit(low)).alias(f"below{i}"))
        tallies.append(F.count_if(F.col(c).between(F.lit(low), F.lit(high))).alias(f"inside{i}"))
    tally = values.agg(*tallies).first()
    cells, ranks = [], []
    for i, (c, (low, high)) in enumerate(zip(columns, brackets)):
        n, below, inside = tally[f"n{i}"], tally[f"below{i}"], tally[f"inside{i}"]
        first, last = (n + 1) // 2, n // 2 + 1
        kept = F.col(c)
        if below < first and last <= below + inside:
            kept = F.when(kept.between(F.lit(low), F.lit(high)), kept)
        else:
            below = 0
        cells.append(F.struct(F.lit(c).alias("column"), kept.alias("value")))
        ranks.append((c, first - below, last - below))
    long = values.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    at = counted_positions(long, "value", ["column"], split=sizing.find_split(long, ["column"], blocks))
    wanted = df.sparkSession.createDataFrame(ranks, "column string, first bigint, last bigint")
    end = F.col("before") + F.col("n")
    middle = ((F.col("before") < F.col("first")) & (F.col("first") <= end)) | (
        (F.col("before") < F.col("last")) & (F.col("last") <= end)
    )
    found = at.join(F.broadcast(wanted), "column").where(middle)
    return found.groupBy("column").agg(F.avg("value").alias("median"))
