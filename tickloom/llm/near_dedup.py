"""Near-duplicates by a chosen-path set similarity join.

Every document has a signature of 64 minwise tokens. A tree sends documents to nodes by one chosen token, and large
nodes branch on, each by tokens that its own path chooses, until a node is small enough to be compared exhaustively.
Twelve independent trees miss a pair at the threshold with probability below 1e-6. Two things keep dense groups
linear: equal sets are one vertex from the start, and every vertex is first checked against the head of its nodes;
pairs that these links already connect need no comparison. All links are confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import free_name, partitions, stored
from tickloom.llm.graph import components
from tickloom.llm.shingles import COORDINATES, set_id, shingle_set, signature, similar
from tickloom.plans.sizing import lookup_side

PERCENT = 75
TREES = 12
# A node is small if it has at most so many pairs across components and so many members: some seconds of one task.
NODE_PAIRS, NODE_ROWS = 33_000_000, 8192
# Members whose texts meet those of as many others in one task when candidates are confirmed.
HALF = 1024
BRANCHES = 2
DEPTH = 6
# Rounds in which every vertex is checked against heads of its nodes before any node is compared exhaustively.
STARS = 3
# Least number of equal tokens, of 64, that sends a pair to the check on full sets: at similarity 0.75, 48 are
# expected and fewer than 34 happen once in 70,000 pairs of a component's few direct links.
AGREE = 34
# At the last level: members of a dense node that meet so many others at once, and those others, in one task.
BLOCK, PART = 64, 2048
# Rows with texts that a Python worker gets at once.
TEXT_ROWS = 500


def _sets(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = []
        for text in batch:
            s = shingle_set(text)
            rows.append((len(s), set_id(s), signature(s) if len(s) else None))
        yield pd.DataFrame(rows, columns=["n", "sid", "sig"])


def _agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    x = np.frombuffer(b"".join(a), np.uint32).reshape(-1, COORDINATES)
    y = np.frombuffer(b"".join(b), np.uint32).reshape(-1, COORDINATES)
    return pd.Series((x == y).sum(axis=1).astype(np.int32))


def _fresh(equal: np.ndarray, small: int, tree: int) -> np.ndarray:
    """Which rows share no small root of an earlier tree with a member whose small roots are the bits of ``small``.

    A pair that shares one was compared there already, so each pair leaves one node only.
    """
    earlier = [t for t in range(min(tree, TREES)) if small >> t & 1]
    return ~equal[:, earlier].any(axis=1) if earlier else np.ones(len(equal), bool)


# What a node sends on, so that no row per pair is made: a row per member with its candidates, and a row per candidate.
# A large node sends several parts, each of which meets its texts apart.
LISTS = "node long, part int, at int, sid string, label string, partners array<int>"
_LISTS = ["node", "part", "at", "sid", "label", "partners"]


def _lists(node: int, sid: np.ndarray, label: np.ndarray, found: dict[int, np.ndarray]) -> list[tuple]:
    """Rows of ``LISTS``. ``found``: positions of a member's candidates by the member's position.

    Members and candidates are parted by ``HALF`` positions each, so the texts of at most two halves are one part.
    """
    halves = -(-len(sid) // HALF)
    parts: dict[int, dict[int, np.ndarray]] = {}
    for at, partners in found.items():
        if halves <= 2:
            parts.setdefault(0, {})[at] = partners
            continue
        half = partners // HALF
        for h in np.unique(half).tolist():
            parts.setdefault(at // HALF * halves + h, {})[at] = partners[half == h]
    rows = []
    for part, asks in parts.items():
        rows += [(node, part, at, sid[at], label[at], partners) for at, partners in asks.items()]
        rows += [(node, part, at, sid[at], label[at], None) for at in np.unique(np.concatenate(list(asks.values()))).tolist()]
    return rows


def _equal_tokens(equal: np.ndarray) -> np.ndarray:
    """Number of true values per row of ``COORDINATES`` of them: eight bytes are added at once, no byte passes 64."""
    lanes = equal.view(np.uint64).sum(axis=1)
    return (lanes * np.uint64(0x0101010101010101)) >> np.uint64(56)


def _candidates(sig: np.ndarray, label: np.ndarray, n: np.ndarray, small: np.ndarray, tree: int, others: int) -> dict[int, np.ndarray]:
    """Positions behind each of the first ``others`` members that have another label and enough equal tokens."""
    found = {}
    for k in range(others):
        equal = sig[k + 1:] == sig[k]
        near = np.flatnonzero(_equal_tokens(equal) >= AGREE)
        if not len(near):
            continue
        at = near + k + 1
        keep = (label[at] != label[k]) & (100 * np.minimum(n[at], n[k]) >= PERCENT * np.maximum(n[at], n[k]))
        keep &= _fresh(equal[near], int(small[k]), tree)
        if keep.any():
            found[k] = at[keep].astype(np.int32)
    return found


def _cross_pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of whole nodes in order (a node may span frames): candidates with other labels and enough equal tokens.

    Columns are made arrays once per frame, since most nodes have a few members only.
    """

    def pairs(frame: pd.DataFrame, starts: list[int]) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(frame["sig"]), np.uint32).reshape(-1, COORDINATES)
        node, tree, sid, names, n, small = (frame[c].to_numpy() for c in ("node", "tree", "sid", "label", "n", "small"))
        label, rows = pd.factorize(names)[0], []
        for i, j in zip(starts, [*starts[1:], len(frame)], strict=True):
            own, count = np.unique(label[i:j], return_counts=True)
            # The largest component comes last: its members need no comparison among each other.
            main = label[i:j] == own[count.argmax()]
            order = i + np.argsort(main, kind="stable")
            found = _candidates(sig[order], label[order], n[order], small[order], int(tree[i]), j - i - int(count.max()))
            if found:
                rows += _lists(int(node[i]), sid[order], names[order], found)
        return pd.DataFrame(rows, columns=_LISTS)

    held = None
    for frame in frames:
        if not len(frame):
            continue
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        node = frame["node"].to_numpy()
        starts = [0, *(np.flatnonzero(node[1:] != node[:-1]) + 1).tolist()]
        # The last node may go on in the next frame.
        held = frame.iloc[starts[-1]:]
        if len(starts) > 1:
            yield pairs(frame.iloc[:starts[-1]], starts[:-1])
    if held is not None:
        yield pairs(held, [0])


def _value(at: str) -> str:
    return f"substring(sig, 4 * ({at}) + 1, 4)"


def _texts(sids: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(sid, text) of the sets in question only."""
    needed = sids.distinct().join(sets.select("sid", "key"), "sid")
    return stored(docs.join(lookup_side(needed), "key").groupBy("sid").agg(F.first("text").alias("text")), "texts")


def confirmed_lists(lists: DataFrame, sets: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among the candidates of each node, on full sets, one link per member and component.

    The texts of a part of a node meet in one task: those of two times ``HALF`` members, or of a block and a part of a
    node of the last level.
    """

    def check(node: pd.DataFrame) -> pd.DataFrame:
        asks = node[node["partners"].notna()]
        others = node[node["partners"].isna()]
        others = {at: row for at, *row in zip(others["at"], others["sid"], others["label"], others["text"], strict=True)}
        sets_of: dict[int, np.ndarray] = {}
        out = []
        for sid, text, partners in zip(asks["sid"], asks["text"], asks["partners"], strict=True):
            mine, met = shingle_set(text), set()
            for p in partners:
                other, label, words = others[p]
                if label in met:
                    continue
                if p not in sets_of:
                    sets_of[p] = shingle_set(words)
                if similar(mine, sets_of[p], percent):
                    met.add(label)
                    out.append((min(sid, other), max(sid, other)))
        return pd.DataFrame(out, columns=["a", "b"])

    texts = _texts(lists.select("sid"), sets, docs)
    return stored(lists.join(texts, "sid").groupBy("node", "part").applyInPandas(check, "a string, b string"), "links", TEXT_ROWS)


def confirmed(pairs: DataFrame, sets: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids whose full sets are similar; texts are fetched for the sets in question only."""
    texts = _texts(pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))), sets, docs)

    @F.pandas_udf(T.BooleanType())
    def full(a: pd.Series, b: pd.Series) -> pd.Series:
        last = (None, None)
        out = []
        for x, y in zip(a, b, strict=True):
            if last[0] != y:
                last = (y, shingle_set(y))
            out.append(similar(shingle_set(x), last[1], percent))
        return pd.Series(out, dtype=bool)

    left = texts.select(F.col("sid").alias("a"), F.col("text").alias("_a"))
    right = texts.select(F.col("sid").alias("b"), F.col("text").alias("_b"))
    checked = pairs.join(left, "a").join(right, "b").where(full("_a", "_b"))
    return stored(checked.select("a", "b"), "links", TEXT_ROWS)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, trees: int = TREES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, n_shingles, component_id and kept.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of five-word shingles; the
    component's id is its smallest document id, and that document is kept.

    Null and empty texts, and texts of white space, have no shingles: they are linked with nothing and kept. Texts of
    fewer than five words have one shingle. Null ids take no part in the smallest id and are kept only if their whole
    component has null ids. Repeated rows share one id and one fate. An empty table gives an empty result; only the id
    and the text are read. A node of any size is handled whole: what is too dense to branch is compared in blocks.
    """
    found = _verdicts(docs, percent, trees, id_col, text_col)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")


def _verdicts(docs: DataFrame, percent: int, trees: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, key (hash of id and text), n, component_id, kept."""
    if percent < PERCENT:
        raise ValueError(f"percent must be {PERCENT} or more: candidates are only looked for from there, got {percent}")
    spark = docs.sparkSession
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    base = base.withColumn("key", F.xxhash64("id", "text"))
    describe = F.pandas_udf(_sets, "n long, sid string, sig binary")
    agreement = F.pandas_udf(_agreement, "int")
    rows = stored(base.select("id", "key", describe("text").alias("s")).select("id", "key", "s.*"), "rows", TEXT_ROWS)
    sets = rows.where("sid is not null").groupBy("sid").agg(
        F.min("key").alias("key"), F.min("id").alias("min_id"), F.first("n").alias("n"), F.first("sig").alias("sig")
    )
    sets = stored(sets, "sets")

    # Roots of all trees: one chosen token each; what stands alone in a node has no partner there.
    steps = F.array(*[F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), F.expr(_value(str(t)))).alias("node")) for t in range(trees)])
    nodes = sets.select("sid", F.inline(steps))
    shared = nodes.groupBy("node").agg(F.count("*").alias("size")).where("size > 1").select("node")
    members = stored(nodes.join(shared, "node"), "members")

    def plausible(pairs: DataFrame) -> DataFrame:
        x = sets.select(F.col("sid").alias("a"), F.col("n").alias("_na"), F.col("sig").alias("_sa"))
        y = sets.select(F.col("sid").alias("b"), F.col("n").alias("_nb"), F.col("sig").alias("_sb"))
        sized = pairs.join(x, "a").join(y, "b").where(f"100 * least(_na, _nb) >= {percent} * greatest(_na, _nb)")
        return sized.where(agreement("_sa", "_sb") >= AGREE).select("a", "b")

    def labelled(df: DataFrame) -> DataFrame:
        if labels is None:
            return df.withColumn("label", F.col("sid"))
        known = labels.select(F.col("v").alias("sid"), F.col("root"))
        return df.join(known, "sid", "left").withColumn("label", F.coalesce("root", "sid")).drop("root")

    def mixed(df: DataFrame) -> DataFrame:
        """The rows of nodes that hold more than one component, with the number of pairs across components."""
        per_label = df.groupBy("node", "label").agg(F.count("*").alias("_c"))
        stats = per_label.groupBy("node").agg(F.sum("_c").alias("size"), F.expr("(sum(_c) * sum(_c) - sum(_c * _c)) div 2").alias("cross"))
        return df.join(stats.where("cross > 0"), "node")

    def joined_by(links: DataFrame) -> DataFrame:
        """Components of all links so far: the new ones contracted by those known before."""
        if labels is None:
            return components(links)
        ends = labelled(links.withColumnRenamed("a", "sid")).select(F.col("label").alias("a"), F.col("b").alias("sid"))
        new = components(labelled(ends).select("a", F.col("label").alias("b")))
        # Roots of before move to their new roots; vertices that had no link yet come in.
        moved = labels.join(new.select(F.col("v").alias("root"), F.col("root").alias("_to")), "root", "left")
        moved = moved.select("v", F.coalesce("_to", "root").alias("root"))
        return stored(moved.unionByName(new.join(labels.select("v"), "v", "left_anti").select("v", "root")), "labels")

    labels = None
    for turn in range(STARS):
        # A node's head is a member of the component that has most members there; another one each time.
        here = members if labels is None else stored(mixed(labelled(members)).select("node", "sid", "label"), "mixed")
        if labels is None:
            heads = here.groupBy("node").agg(F.min(F.struct(F.xxhash64("sid"), "sid")).alias("h")).select("node", F.col("h.sid").alias("a"))
            pairs = here.join(heads, "node").where("sid <> a").groupBy("sid", "a").agg(F.count("*").alias("votes"))
            pairs = pairs.groupBy("sid").agg(F.max(F.struct("votes", "a")).alias("m")).select("m.a", F.col("sid").alias("b"))
        else:
            most = here.groupBy("node", "label").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("sid", F.lit(turn)), "sid")).alias("h"))
            heads = most.groupBy("node").agg(F.max(F.struct("n", "label", "h.sid")).alias("m")).select("node", F.col("m.sid").alias("a"), F.col("m.label").alias("_head"))
            pairs = here.join(heads, "node").where("label <> _head").select("a", F.col("sid").alias("b")).distinct()
        labels = joined_by(confirmed(stored(plausible(pairs), "candidates"), sets, base, percent))

    # Then, in nodes that still hold more than one component, all pairs across components; large nodes branch first.
    is_small = (F.col("cross") <= NODE_PAIRS) & (F.col("size") <= NODE_ROWS)
    columns = ["node", "tree", "sid", "label", "n", "sig", "small", "cross", "size"]
    roots = stored(mixed(labelled(members)), "roots")
    # Bits of the trees whose root is small, so compared at once.
    small = roots.groupBy("sid").agg(F.bit_or(F.when(is_small, F.pow(F.lit(2), F.col("tree")).cast("int")).otherwise(0)).alias("small"))
    level = roots.join(small, "sid").join(sets.select("sid", "n", "sig"), "sid")
    level = stored(level.select(*columns), "level")
    found = []
    for _ in range(DEPTH):
        now = level.where(is_small).drop("cross", "size").repartition(partitions(spark), "node").sortWithinPartitions("node", "sid")
        found.append(stored(now.mapInPandas(_cross_pairs, LISTS), "pairs"))
        large = level.where(~is_small)
        if large.isEmpty():
            break
        pick = lambda j: f"{trees} + pmod(xxhash64(node, {j}), {COORDINATES - trees})"
        child = F.array(*[F.xxhash64("node", F.lit(j), F.expr(_value(pick(j)))) for j in range(BRANCHES)])
        children = large.drop("cross", "size").withColumns({"tree": F.lit(trees), "node": F.explode(F.array_distinct(child))})
        level = stored(mixed(children).select(*columns), "level")
    else:
        found += _rest(level, percent)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    labels = joined_by(confirmed_lists(pairs, sets, base, percent))
    by_set = labelled(sets.select("sid", "min_id")).withColumnRenamed("label", "root")
    least = by_set.groupBy("root").agg(F.min("min_id").alias("component_id"))
    answer = stored(by_set.join(least, "root").select("sid", "component_id"), "answer")
    out = rows.select("id", "key", "n", "sid").join(answer, "sid", "left")
    component = F.when(F.col("sid").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "key", "n", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _rest(level: DataFrame, percent: int) -> list[DataFrame]:
    """Exact way for the nodes of the last level, of any size: blocks of about ``BLOCK`` members against all members.

    One block of each node at a time meets the node's members, which are dealt in parts; both are arrays in a task,
    and only pairs of different components with enough equal tokens leave it.
    """
    if level.isEmpty():
        return []
    sizes = level.groupBy("node").agg(F.count("*").alias("size"))
    deal = lambda rows, salt: F.pmod(F.xxhash64("sid", "node", F.lit(salt)), F.greatest(F.lit(1).cast("long"), F.floor(F.col("size") / rows)))
    dealt = level.drop("size").join(sizes, "node").withColumns({"block": deal(BLOCK, 1), "part": deal(PART, 2)})
    dealt = stored(dealt.select("node", "part", "block", "size", "sid", "label", "n", "sig", "small"), "dealt")
    last = dealt.agg(F.max("block").alias("b")).first()["b"]

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame([], columns=_LISTS)
        sig = np.frombuffer(b"".join(y["sig"]), np.uint32).reshape(-1, COORDINATES)
        sid, label, n, out = y["sid"].to_numpy(), y["label"].to_numpy(), y["n"].to_numpy(), {}
        for k, (lab, size, own, small) in enumerate(zip(x["l_label"], x["l_n"], x["l_sig"], x["l_small"], strict=True)):
            equal = sig == np.frombuffer(own, np.uint32)
            near = (_equal_tokens(equal) >= AGREE) & _fresh(equal, int(small), TREES)
            near &= (label != lab) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))
            if near.any():
                out[len(sid) + k] = np.flatnonzero(near).astype(np.int32)
        every = np.concatenate([sid, x["l_sid"].to_numpy()]), np.concatenate([label, x["l_label"].to_numpy()])
        return pd.DataFrame(_lists(int(x["l_group"].iloc[0]), *every, out), columns=_LISTS)

    found = []
    for b in range(int(last) + 1):
        parts = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(1).cast("long"), F.floor(F.col("size") / PART)) - 1)
        leaders = dealt.where(F.col("block") == b).select("node", F.explode(parts).alias("part"), *[F.col(c).alias(f"l_{c}") for c in ("sid", "label", "n", "sig", "small")])
        leaders = leaders.withColumn("l_group", F.xxhash64("node", "part", F.lit(b)))
        others = dealt.select("node", "part", "sid", "label", "n", "sig")
        both = leaders.groupBy("node", "part").cogroup(others.groupBy("node", "part"))
        found.append(stored(both.applyInPandas(meet, LISTS), "pairs"))
    return found


def keep_one(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay: one of each component, with the columns they came with.

    What goes is found again by a hash of id and text, so rows that repeat one id and text share one fate.
    """
    mark = free_name(docs.columns, "_key")
    gone = _verdicts(docs, percent, TREES, id_col, text_col).where("not kept").select(F.col("key").alias(mark)).distinct()
    keyed = docs.withColumn(mark, F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    return keyed.join(lookup_side(stored(gone, "gone")), mark, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = r"""WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 4), ' ') AS sh
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS k FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
j AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM j JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * c >= 75 * (p.n + q.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id, c FROM (WITH RECURSIVE t(doc_id, c) AS (SELECT a, a FROM e UNION SELECT e.b, t.c FROM t JOIN e ON e.a = t.doc_id) SELECT * FROM t)),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""
