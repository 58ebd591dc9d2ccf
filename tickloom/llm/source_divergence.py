"""Source divergence audit: how far each source's term distribution lies from each other source's and its language's.

For a group (lang, source) and a term kept by the language, p = 1 + floor(1e9 * (count + 2) / (N + 2V)), where N is
the group's count of kept terms and V their number; q is the same of another source or of the whole language, and
f = floor((p - q)^2 / (p + q)). Pair values sum f over all V kept terms.

Most terms are absent from most sources, where p is a per-source constant z. So a pair's value is V * f(z, z') plus
corrections: for a term present in one of the two, from the number of terms with each count in that source; for a term
present in both, from a frequent-pattern tree. Each term is a row of its (source, count) pairs, ordered by source;
equal rows are inserted once with their multiplicity, every prefix is a node that adds up the multiplicities below
it, and a node pairs its last entry with each of its ancestors' once, weighted by the node's multiplicity. Everything
is a DataFrame aggregation, combined map-side; no group of terms or documents meets in one task. Terms are counted in
Python: a worker numbers the terms that it meets and combines repeats in arrays before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored, top_per

# Fixed by the contract: least number of documents, scale, length of the term list.
MIN_DOCS = 10
SCALE = 1_000_000_000
TERM_TOP = 10
EXACT = "decimal(38,0)"
# Terms, and keys (group and term), that a Python worker holds before it hands them on; bounds its memory.
FLUSH = 400_000
FLUSH_KEYS = 2_000_000
# Bytes of text cut into terms at once, and rows with texts that a Python worker gets at once.
CHUNK_BYTES = 1 << 20
TEXT_ROWS = 2000


def p_of(count: str, total: str, v: str) -> Column:
    """1 + floor(1e9 * (count + 2) / (N + 2V)), exactly, as a long."""
    return F.expr(f"1 + (CAST({SCALE} AS {EXACT}) * (CAST({count} AS {EXACT}) + 2)) div (CAST({total} AS {EXACT}) + 2 * CAST({v} AS {EXACT}))")


def f_of(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)) of two longs below 2^31.5, exactly."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


# What is neither A-Z, a-z nor above 127 becomes a space; A-Z is lower-cased. No UTF-8 text holds the byte 255.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256))
_END = b"\xff"


class _Numbers(dict):
    """Numbers terms in the order in which they are met; 0 is the end of a document."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and per key the sum of each of ``values``."""
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[at], *(np.add.reduceat(v[order], at) for v in values)


def _chunks(texts: pd.Series) -> Iterator[bytes]:
    """Texts as bytes, some at once, each with ``_END`` after it."""
    held, size = [], 0
    for text in texts:
        if text:
            held.append(text.encode() if isinstance(text, str) else text)
            size += len(text)
        if size >= CHUNK_BYTES:
            yield b" \xff ".join([*held, b""])
            held, size = [], 0
    if held:
        yield b" \xff ".join([*held, b""])


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, source, term, c, d): occurrences and documents, combined until FLUSH terms or FLUSH_KEYS keys are held."""
    numbers, groups, held, size = _Numbers({_END: 0}), {}, [], 0

    def rows() -> pd.DataFrame:
        keys, c, d = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
        group, term = keys >> 32, keys & 0xFFFFFFFF
        lang, source = (np.array([name[k] for name in groups], object)[group] for k in (0, 1))
        terms = np.array([t if t == _END else t.decode() for t in numbers], object)[term]
        return pd.DataFrame({"lang": lang, "source": source, "term": terms, "c": c, "d": d})

    for pdf in batches:
        for name, texts in pdf.groupby(["lang", "source"], sort=False)["text"]:
            group = groups.setdefault(name, len(groups)) << 32
            for chunk in _chunks(texts):
                terms = chunk.translate(_BYTES).split()
                ids = np.fromiter(map(numbers.__getitem__, terms), np.int64, len(terms))
                doc, real = np.cumsum(ids == 0), ids > 0
                if not real.any():
                    continue
                per_doc, c = _summed(doc[real] << 32 | ids[real], np.ones(int(real.sum()), np.int64))
                keys, c, d = _summed(per_doc & 0xFFFFFFFF, c, np.ones(len(c), np.int64))
                held.append((keys | group, c, d))
                size += len(keys)
                if len(numbers) > FLUSH or size >= FLUSH_KEYS:
                    yield rows()
                    numbers, groups, held, size = _Numbers({_END: 0}), {}, [], 0
                    group = groups.setdefault(name, len(groups)) << 32
    if held:
        yield rows()


def term_stats(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, c, d): occurrences and documents per group and term, from one scan."""
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source"), F.col(text).cast("binary").alias("text")
    )
    counted = rows.mapInPandas(_term_counts, "lang string, source string, term string, c long, d long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value (long), rank (int): pair values to every other source, top terms.

    Null text, lang and source read as ''. Terms are runs of letters and of all code points above 127 (A-Z
    lower-cased). A language keeps the terms that at least 10 of its documents (rows) hold. Part 'pair': every
    other source of the language, all ranks; a language without kept terms gives 0. Part 'term': kept terms with a
    count above 0 in the group whose p exceeds the language's, the first 10. Ranks per group and part: value
    descending, item ascending (UTF-8 bytes). Every (lang, source) of the table is a group, even one without terms; a
    language with one source has no pair rows. An empty table gives no rows. Arithmetic is exact.
    """
    stats = stored(term_stats(docs, text, lang, source), "divergence-terms", TEXT_ROWS)
    groups = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source")).distinct()
    kept = stats.groupBy("lang", "term").agg(F.sum("d").alias("docs"), F.sum("c").alias("c_lang")).where(F.col("docs") >= MIN_DOCS)
    v = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("c_lang").alias("n_lang"))
    counts = stats.join(kept.select("lang", "term", "c_lang"), ["lang", "term"]).where("c > 0").select("lang", "source", "term", "c", "c_lang")
    counts = stored(counts, "divergence-counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    # One row per group: its total N, the language's V and total, and its p of an absent term.
    groups = (
        groups.join(v, "lang", "left").join(totals, ["lang", "source"], "left")
        .fillna(0, ["v", "n_lang", "n"])
        .withColumn("z", F.when(F.col("v") > 0, p_of("0", "n", "v")))
    )
    groups = stored(groups, "divergence-groups")

    # Part 'term': present terms above the language's p.
    terms = counts.join(groups.select("lang", "source", "n", "v", "n_lang"), ["lang", "source"])
    terms = terms.select("lang", "source", "term", p_of("c", "n", "v").alias("p"), p_of("c_lang", "n_lang", "v").alias("q")).where("p > q")
    terms = terms.select("lang", "source", F.col("term").alias("item"), f_of("p", "q").alias("value"))
    order = [F.col("value").desc(), F.col("item").asc()]
    term_part = top_per(terms, ["lang", "source"], order, TERM_TOP, F.xxhash64("item")).withColumn("part", F.lit("term"))

    # Part 'pair': all ordered pairs of sources of a language.
    other = groups.select("lang", F.col("source").alias("other"), F.col("n").alias("n2"), F.col("z").alias("z2"))
    pairs = groups.join(other, "lang").where(F.col("source") != F.col("other"))
    base = pairs.select("lang", "source", "other", F.when(F.col("v") > 0, F.col("v") * f_of("z", "z2")).otherwise(F.lit(0)).alias("value"))

    # Terms present in one source: by the number of terms with each count there.
    weights = counts.groupBy("lang", "source", "c").agg(F.count(F.lit(1)).alias("m"))
    one = _one_sided(weights, groups, other)

    # Terms present in both: the frequent-pattern tree.
    both = _tree_corrections(counts, groups)
    value = base.unionByName(one).unionByName(both).unionByName(both.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))
    value = value.groupBy("lang", "source", "other").agg(F.sum("value").cast("long").alias("value"))
    pair_part = value.withColumn("rank", F.row_number().over(_pair_window())).select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", "rank"
    )
    out = pair_part.unionByName(term_part.select("lang", "source", "part", "item", F.col("value").cast("long"), "rank"))
    return out.select("lang", "source", "part", "item", "value", F.col("rank").cast("int"))


def _pair_window():
    from pyspark.sql import Window

    # A group has one row per other source of its language, which no number of documents makes larger.
    return Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("other").asc())


def _one_sided(weights: DataFrame, groups: DataFrame, other: DataFrame) -> DataFrame:
    """Both directions of the correction for terms present in one source of a pair and absent in the other."""
    per_count = weights.join(groups.select("lang", "source", "n", "v", "z"), ["lang", "source"]).withColumn("p", p_of("c", "n", "v"))
    joined = per_count.join(other, "lang").where(F.col("source") != F.col("other"))
    # Present in ``source`` only: f(p, z') in place of f(z, z'); counted for the pair (source, other) and (other, source).
    delta = (F.col("m") * (f_of("p", "z2") - f_of("z", "z2"))).alias("value")
    forward = joined.select("lang", "source", "other", delta)
    return forward.unionByName(forward.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))


def _tree_corrections(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, value) with source < other: corrections of terms present in both, from tree nodes."""
    rows = counts.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "c"))).alias("row"))
    rows = rows.where(F.size("row") >= 2).groupBy("lang", "row").agg(F.count(F.lit(1)).alias("m"))
    prefix = F.transform(F.sequence(F.lit(2), F.size("row")), lambda i: F.slice("row", 1, i))
    nodes = rows.select("lang", F.explode(prefix).alias("node"), "m").groupBy("lang", "node").agg(F.sum("m").alias("m"))
    last = F.element_at("node", -1)
    links = nodes.select(
        "lang", last.alias("e"), F.explode(F.slice("node", 1, F.size("node") - 1)).alias("a"), "m"
    ).groupBy("lang", F.col("a.source").alias("source"), F.col("a.c").alias("c"), F.col("e.source").alias("other"), F.col("e.c").alias("c2")).agg(
        F.sum("m").alias("m")
    )
    g = groups.select("lang", "source", "n", "v", "z")
    g2 = groups.select("lang", F.col("source").alias("other"), F.col("n").alias("n2"), F.col("z").alias("z2"))
    links = links.join(g, ["lang", "source"]).join(g2, ["lang", "other"])
    links = links.withColumns({"p": p_of("c", "n", "v"), "p2": p_of("c2", "n2", "v")})
    fix = f_of("p", "p2") - f_of("p", "z2") - f_of("z", "p2") + f_of("z", "z2")
    return links.select("lang", "source", "other", (F.col("m") * fix).alias("value"))


SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
),
groups AS (SELECT DISTINCT lang, source FROM d),
occ AS (SELECT lang, source, unnest(t) AS term FROM d),
docfreq AS (SELECT lang, term, count(*) AS docs FROM (SELECT lang, unnest(list_distinct(t)) AS term FROM d) GROUP BY lang, term),
kept AS (SELECT lang, term FROM docfreq WHERE docs >= 10),
v AS (SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM groups) g LEFT JOIN kept k ON k.lang = g.lang GROUP BY g.lang),
cnt AS (SELECT o.lang, o.source, o.term, count(*) AS c FROM occ o JOIN kept k ON k.lang = o.lang AND k.term = o.term GROUP BY ALL),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS n FROM groups g LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
lc AS (SELECT lang, term, sum(c) AS c FROM grid GROUP BY ALL),
ln AS (SELECT lang, sum(c) AS n FROM lc GROUP BY ALL),
gp AS (
  SELECT x.lang, x.source, x.term, x.c,
         1 + (CAST(1000000000 AS HUGEINT) * (x.c + 2)) // (gn.n + 2 * v.v) AS p
  FROM grid x JOIN gn ON gn.lang = x.lang AND gn.source = x.source JOIN v ON v.lang = x.lang
),
lp AS (
  SELECT lc.lang, lc.term, 1 + (CAST(1000000000 AS HUGEINT) * (lc.c + 2)) // (ln.n + 2 * v.v) AS q
  FROM lc JOIN ln ON ln.lang = lc.lang JOIN v ON v.lang = lc.lang
),
pair_vals AS (
  SELECT g1.lang, g1.source, g2.source AS item,
         coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p))
                   FROM gp x JOIN gp y ON y.lang = x.lang AND y.term = x.term
                   WHERE x.lang = g1.lang AND x.source = g1.source AND y.source = g2.source), 0) AS value
  FROM groups g1 JOIN groups g2 ON g2.lang = g1.lang AND g2.source <> g1.source
),
term_vals AS (
  SELECT x.lang, x.source, x.term AS item, (x.p - q.q) * (x.p - q.q) // (x.p + q.q) AS value
  FROM gp x JOIN lp q ON q.lang = x.lang AND q.term = x.term
  WHERE x.c > 0 AND x.p > q.q
),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank
  FROM pair_vals
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term' AS part, item, value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank
    FROM term_vals) WHERE rank <= 10
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
"""
