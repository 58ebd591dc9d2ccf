"""Approximate nearest neighbours by inner product: stable projections in kd-trees, with a chi-square stopping test.

One added component turns the largest inner product into the smallest distance. A Gaussian projection to twelve
dimensions keeps distances in this sense: squared projected distance over squared distance follows a chi-square law.
So a query that looks at points in order of projected distance may stop once a point as near as its current k-th
would, with the stated confidence, have been met before.

The upper levels of the kd-tree are fitted on a bounded sample and cut the space in cells; all rows are indexed, and
cells of many rows are dealt into blocks. Each query is first searched in a block of its own cell, which bounds its
k-th distance, then goes only to cells whose box passes the test. Inside a task, the rest of the tree is walked leaf
by leaf for a block of queries at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored

NEIGHBOURS = 20
DIMS = 12
CONFIDENCE = 0.97
SEED = 20
# Rows that the upper tree is fitted on (the smallest hashes of ids), most cells, rows aimed at per block of candidates
# and of queries, and rows per leaf inside a task.
SAMPLE = 8192
CELLS = 1024
BLOCK = 8192
QUERY_BLOCK = 1024
LEAF = 256


def chi_square_quantile(p: float, dims: int) -> float:
    """Wilson and Hilferty's approximation."""
    z, a = NormalDist().inv_cdf(p), 2 / (9 * dims)
    return dims * (1 - a + z * a**0.5) ** 3


def _valid(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Vectors that take part, as doubles, with their squared lengths."""
    for frame in frames:
        rows = []
        for key, vector in zip(frame["id"], frame["vec"], strict=True):
            if vector is None or pd.isna(key):
                continue
            v = np.asarray([np.nan if x is None else x for x in vector] if vector.dtype == object else vector, np.float64)
            size = float(v @ v) if len(v) else 0.0
            if np.isfinite(v).all() and v.any() and np.isfinite(size):
                rows.append((int(key), v, size))
        yield pd.DataFrame(rows, columns=["id", "vec", "size"])


class Upper:
    """The kd-tree's upper levels: a complete binary tree of (dimension, value), and the projection before it."""

    def __init__(self, sample: np.ndarray, width: int, longest: float, levels: int):
        self.width, self.longest, self.levels = width, longest, levels
        self.matrix = np.random.RandomState(SEED).standard_normal((width + 1, DIMS))
        nodes = 2**levels - 1
        self.dim, self.value = np.zeros(nodes, np.int64), np.zeros(nodes)
        groups = {0: self.project(sample)}
        for node in range(nodes):
            points = groups.pop(node)
            if len(points):
                self.dim[node] = int(points.var(axis=0).argmax())
                self.value[node] = float(np.median(points[:, self.dim[node]]))
            right = points[:, self.dim[node]] > self.value[node]
            groups[2 * node + 1], groups[2 * node + 2] = points[~right], points[right]

    def stack(self, vectors) -> np.ndarray:
        out = np.zeros((len(vectors), self.width))
        for k, v in enumerate(vectors):
            out[k, :len(v)] = v
        return out

    def project(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        added = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.longest - (x * x).sum(axis=1)))
        return np.column_stack([x, added]) @ self.matrix

    def cell(self, u: np.ndarray) -> np.ndarray:
        node = np.zeros(len(u), np.int64)
        for _ in range(self.levels):
            node = 2 * node + 1 + (u[np.arange(len(u)), self.dim[node]] > self.value[node])
        return node - (2**self.levels - 1)


def _box_distance(u: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each query to each box."""
    gap = np.maximum(np.maximum(low[None] - u[:, None], u[:, None] - high[None]), 0.0)
    return (gap * gap).sum(axis=2)


def _leaves(u: np.ndarray) -> list[np.ndarray]:
    """The lower tree's leaves: halves at the median of the widest dimension."""
    todo, out = [np.arange(len(u))], []
    while todo:
        at = todo.pop()
        if len(at) <= LEAF:
            out.append(at)
            continue
        points = u[at]
        order = np.argpartition(points[:, int(np.ptp(points, axis=0).argmax())], len(at) // 2)
        todo += [at[order[:len(at) // 2]], at[order[len(at) // 2:]]]
    return out


def search_block(upper: Upper, queries: pd.DataFrame, points: pd.DataFrame, k: int, reach: float) -> pd.DataFrame:
    """Best ``k`` points of a block for each query that are no worse than the query's ``bound`` (an inner product)."""
    q, x = upper.stack(queries["vec"]), upper.stack(points["vec"])
    qid, pid = queries["id"].to_numpy(np.int64), points["id"].to_numpy(np.int64)
    u, t = upper.project(x), upper.project(q, query=True)
    leaves = _leaves(u)
    near = _box_distance(t, np.stack([u[a].min(axis=0) for a in leaves]), np.stack([u[a].max(axis=0) for a in leaves]))
    length = (q * q).sum(axis=1) + upper.longest
    slack = 1e-9 * np.sqrt((q * q).sum(axis=1) * upper.longest)
    best = [(np.empty(0), np.empty(0, np.int64)) for _ in qid]
    floor = queries["bound"].to_numpy(np.float64).copy()
    for leaf in np.argsort(near.mean(axis=0), kind="stable"):
        # The stopping test: distance^2 = length - 2 * product, so the k-th product bounds the k-th distance.
        open_ = np.flatnonzero(near[:, leaf] <= reach * np.maximum(0.0, length - 2 * floor))
        if not len(open_):
            continue
        at = leaves[leaf]
        rough = q[open_] @ x[at].T
        for row, j in enumerate(open_):
            take = at[(rough[row] >= floor[j] - slack[j]) & (pid[at] != qid[j])]
            if not len(take):
                continue
            # Each product is summed in one order, whatever the block, so that equal vectors tie exactly.
            scores = np.concatenate([best[j][0], (x[take] * q[j]).sum(axis=1)])
            ids = np.concatenate([best[j][1], pid[take]])
            first = np.lexsort((ids, -scores))[:k]
            best[j] = (scores[first], ids[first])
            if len(first) == k:
                floor[j] = max(floor[j], scores[first[-1]])
    rows = [(qid[j], int(i), float(s)) for j, (scores, ids) in enumerate(best) for s, i in zip(scores, ids, strict=True) if s >= queries["bound"].iloc[j]]
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, every: int = 20, k: int = NEIGHBOURS, id_col: str = "vec_id", vec_col: str = "embedding", confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each row whose id is divisible by ``every``.

    The score is the inner product in double precision; order is by score, ties by smaller id. Vectors that are null,
    empty, zero or hold a null or non-finite component take no part, nor do rows with a null id; shorter vectors count
    as padded with zeros; rows with the query's id are not its candidates; an empty table gives an empty result; other
    columns are not read.
    """
    spark = vectors.sparkSession
    raw = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("vec"))
    base = stored(raw.mapInPandas(_valid, "id long, vec array<double>, size double"), "vectors")
    facts = base.agg(F.count("*").alias("n"), F.max("size").alias("longest"), F.max(F.size("vec")).alias("width"), F.sum((F.col("id") % every == 0).cast("long")).alias("nq")).first()
    result = "query_id long, rank int, vec_id long, score double"
    if not facts["n"]:
        return spark.createDataFrame([], result)
    levels = max(0, min(CELLS, facts["n"] // BLOCK)).bit_length()
    sample = base.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()
    blank = Upper(np.zeros((0, facts["width"])), facts["width"], facts["longest"], 0)
    upper = Upper(blank.stack(sample["vec"]), facts["width"], facts["longest"], levels)
    shared = spark.sparkContext.broadcast(upper)
    reach = chi_square_quantile(confidence, DIMS)

    @F.pandas_udf("cell int, u array<double>")
    def place(vecs: pd.Series) -> pd.DataFrame:
        u = shared.value.project(shared.value.stack(vecs))
        return pd.DataFrame({"cell": shared.value.cell(u).astype(np.int32), "u": list(u)})

    placed = base.select("id", "vec", place("vec").alias("p")).select("id", "vec", "p.cell", "p.u")
    # One row per cell, at most CELLS * 2: its rows and its box.
    bounds = [f(F.get("u", F.lit(d))).alias(f"{n}{d}") for d in range(DIMS) for n, f in (("lo", F.min), ("hi", F.max))]
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), *bounds).toPandas()
    blocks = {int(c): -(-int(n) // BLOCK) for c, n in zip(cells["cell"], cells["n"], strict=True)}
    per_cell = F.get(F.array(*[F.lit(blocks.get(c, 1)) for c in range(2**levels)]), F.col("cell"))
    indexed = placed.select("id", "vec", "cell", F.pmod(F.xxhash64("id"), per_cell).cast("int").alias("block"))
    indexed = stored(indexed, "indexed")
    box = spark.sparkContext.broadcast((
        cells["cell"].to_numpy(np.int32), cells[[f"lo{d}" for d in range(DIMS)]].to_numpy(), cells[[f"hi{d}" for d in range(DIMS)]].to_numpy()
    ))

    def searched(queries: DataFrame, points: DataFrame) -> DataFrame:
        keys = ["cell", "block", "part"]
        # Both sides come from one table; new names keep their columns apart.
        points = points.select(*[F.col(c).alias(c if c in keys else f"p_{c}") for c in ("id", "vec", *keys)])
        join = queries.groupBy(*keys).cogroup(points.groupBy(*keys))
        empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

        def one(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
            return search_block(shared.value, q, p.rename(columns={"p_id": "id", "p_vec": "vec"}), k, reach) if len(q) and len(p) else empty

        return join.applyInPandas(one, "query_id long, vec_id long, score double")

    asking = indexed.where(F.col("id") % every == 0)
    # A block's own queries are at most its rows, so the first round needs no parts.
    home = searched(asking.withColumns({"part": F.lit(0), "bound": F.lit(float("-inf"))}), indexed.withColumn("part", F.lit(0)))
    floor = home.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(float("-inf"))).alias("bound"))
    floor = stored(floor, "bounds")
    known = asking.join(floor, asking["id"] == floor["query_id"], "left")
    known = known.select("id", "vec", F.coalesce("bound", F.lit(float("-inf"))).alias("bound")).dropDuplicates(["id"])

    @F.pandas_udf("array<int>")
    def targets(vecs: pd.Series, bound: pd.Series) -> pd.Series:
        names, low, high = box.value
        q = shared.value.stack(vecs)
        length = (q * q).sum(axis=1) + shared.value.longest
        inside = _box_distance(shared.value.project(q, query=True), low, high) <= (reach * np.maximum(0.0, length - 2 * bound.to_numpy()))[:, None]
        return pd.Series([names[row] for row in inside])

    parts = max(1, -(-int(facts["nq"]) // QUERY_BLOCK))
    sent = known.withColumns({"part": F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"), "cell": F.explode(targets("vec", "bound"))})
    sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0), per_cell - 1)))
    dealt = indexed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    found = searched(sent, dealt)
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id")))
    # Per query: at most ``k`` rows from each block that holds anything as good as its bound.
    ranked = found.distinct().groupBy("query_id").agg(F.slice(best, 1, k).alias("top"))
    out = ranked.select("query_id", F.posexplode("top").alias("at", "t"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), (-F.col("t.minus")).alias("score"))


def brute_force(ids: np.ndarray, vectors: np.ndarray, every: int = 20, k: int = NEIGHBOURS) -> dict[int, list[int]]:
    """For tests: the exact neighbours of each query."""
    out = {}
    for j in np.flatnonzero(ids % every == 0):
        scores = (vectors * vectors[j]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[j]][:k]
        out[int(ids[j])] = [int(ids[i]) for i in order]
    return out
