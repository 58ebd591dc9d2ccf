"""Phrase collocation mining by best-first growth with admissible bounds from prefix counts.

Per language, phrases of two and three words are scored by their weakest cut: for a phrase with count a, cutting it
after k words into parts of counts l and r scores floor(1e6 * a^2 / (l * r)), and the lowest of its cuts counts.

Growth is level by level: a phrase can reach count 10 only if all its words do, and a three-word phrase
scores at most floor(1e6 * a / max(f(first word), f(last word))) since both parts of a cut occur at least a times.
Two-word candidates are scored exactly first; once their 2000th surviving score per language is known, only
three-word phrases whose bound reaches it (ties included) are scored, the rest cannot enter the list. The list per
language is cut in two steps (per language and hash bucket, then per language), so a language with a third of the rows
is no single task.

Words are counted first. The most frequent of those that reach count 10, ``NUMBERED`` at most, get numbers, and a
phrase of numbered words is one 64-bit integer: tasks sort and combine these in arrays and hand them on as one blob per
bucket; each bucket is summed in one task. Phrases with a word that reaches count 10 and has no number, which only very
large vocabularies have, are counted as strings. Any other phrase holds a word below count 10 and cannot reach it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import partitions, stored, top_per

# Fixed by the contract: ends of pieces, least count, list length, score scale.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
MIN_COUNT = 10
TOP = 2000
SCALE = 1_000_000
EXACT = "decimal(38,0)"
# Distinct words or string phrases a Python worker combines before it hands them on; bounds its memory.
FLUSH = 200_000
# Numbered words, at most; three numbers fit 63 bits. A worker's table of them takes some 150 MB at most.
NUMBERED = 1 << 20
BITS = 21
# Bytes of text cut into words at once, numbered phrases combined at once, words of the input per bucket.
CHUNK_BYTES = 1 << 20
FLUSH_GRAMS = 3_000_000
BUCKET_WORDS = 1_000_000
# Rows with texts that a Python worker gets at once.
TEXT_ROWS = 2000

# The end of a piece becomes a byte that UTF-8 does not have, so space and tab are the only white space left.
_END = b"\xff"
_BYTES = bytes(0xFF if b in BREAKS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def _words(texts: list[bytes]) -> list[bytes]:
    return b"\n".join(texts).translate(_BYTES).replace(_END, b" \xff ").split()


def _chunks(pdf: pd.DataFrame) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, words): the words of some texts of one language, with ``_END`` between pieces and texts."""
    for lang, texts in pdf.groupby("lang", sort=False)["text"]:
        held, size = [], 0
        for text in texts:
            if text:
                held.append(text.encode() if isinstance(text, str) else text)
                size += len(text)
            if size >= CHUNK_BYTES:
                yield lang, _words(held)
                held, size = [], 0
        if held:
            yield lang, _words(held)


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, word, f), combined until FLUSH words are held; the empty word's count is that of all words."""
    held: dict[str, Counter] = {}

    def rows() -> pd.DataFrame:
        return pd.DataFrame([(lang, w, f) for lang, c in held.items() for w, f in c.items()], columns=["lang", "word", "f"])

    for pdf in batches:
        for lang, words in _chunks(pdf):
            counts = held.setdefault(lang, Counter())
            counts.update(words)
            counts[b""] += len(words) - counts.pop(_END, 0)
            if sum(map(len, held.values())) >= FLUSH:
                yield rows()
                held.clear()
    if held:
        yield rows()


class _Numbers(dict):
    """A word's number; 0 for any other word and for the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        return 0


_worker: dict = {}


def _numbers(known) -> dict[str, _Numbers]:
    """Per language the numbers of words, kept by a worker from task to task; row k of the table has number k + 1."""
    table = known.value
    if _worker.get("table") is not table:
        numbers: dict[str, _Numbers] = {}
        for k, (lang, word) in enumerate(zip(table["lang"].to_pylist(), table["word"].to_pylist(), strict=True), 1):
            numbers.setdefault(lang, _Numbers())[word] = k
        _worker.update(table=table, numbers=numbers)
    return _worker["numbers"]


def _packed(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs and all triples of neighbouring numbers without a 0, as integers."""
    two = numbers[:-1] << BITS | numbers[1:]
    whole = (numbers[:-1] > 0) & (numbers[1:] > 0)
    three = two[:-1] << BITS | numbers[2:]
    return two[whole], three[whole[:-1] & whole[1:]]


def _summed(grams: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct integers in order and their counts."""
    if not len(grams):
        return grams, np.empty(0, np.int64)
    if counts is None:
        grams = np.sort(grams)
    else:
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order]
    at = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
    return grams[at], np.diff(np.r_[at, len(grams)]) if counts is None else np.add.reduceat(counts, at)


def _blob(values: np.ndarray) -> bytes:
    """Integers byte by byte: all lowest bytes, then all second ones; the high ones are mostly 0 and compress well."""
    return np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unblob(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _bucketed(held: list[np.ndarray], buckets: int) -> pd.DataFrame:
    grams, counts = _summed(np.concatenate(held))
    mixed = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    present, at = np.unique(bucket[order], return_index=True)
    rows = []
    for b, own in zip(present.tolist(), np.split(order, at[1:]), strict=True):
        rows.append((b, _blob(np.diff(grams[own], prepend=0)), _blob(counts[own])))
    return pd.DataFrame(rows, columns=["bucket", "grams", "counts"])


def _gram_blobs(batches: Iterator[pd.DataFrame], known, buckets: int) -> Iterator[pd.DataFrame]:
    """Per bucket, the phrases of numbered words (differences of ordered integers) and their counts."""
    held, size = [], 0
    for pdf in batches:
        for lang, words in _chunks(pdf):
            own = _numbers(known).get(lang)
            if own is None:
                continue
            grams = _packed(np.fromiter(map(own.__getitem__, words), np.int64, len(words)))
            held += grams
            size += sum(map(len, grams))
            if size >= FLUSH_GRAMS:
                yield _bucketed(held, buckets)
                held, size = [], 0
    if size:
        yield _bucketed(held, buckets)


def _gram_counts(batches: Iterator[pd.DataFrame], known=None) -> Iterator[pd.DataFrame]:
    """Counts of the phrases that hold a word without a number, as strings, combined until FLUSH are held."""
    columns = ["lang", "phrase", "words", "f"]
    counts: Counter = Counter()
    for pdf in batches:
        for lang, words in _chunks(pdf):
            own = (_numbers(known) if known else {}).get(lang, _Numbers())
            for a, b, c in zip(words, [*words[1:], _END], [*words[2:], _END, _END], strict=False):
                if a == _END or b == _END:
                    continue
                rare = not (own[a] and own[b])
                if rare:
                    counts[(lang, a + b" " + b, 2)] += 1
                if c != _END and (rare or not own[c]):
                    counts[(lang, b" ".join((a, b, c)), 3)] += 1
                if len(counts) >= FLUSH:
                    yield pd.DataFrame([(*k, f) for k, f in counts.items()], columns=columns)
                    counts = Counter()
    if counts:
        yield pd.DataFrame([(*k, f) for k, f in counts.items()], columns=columns)


def _most_frequent(words: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """The most frequent words, at most ``most`` (whole steps of a histogram of some 250 rows); whether that is all."""
    levels = words.withColumn("level", F.floor(4 * F.log2("f")).cast("int"))
    taken, least, all_taken = 0, 1 << 20, True
    for row in sorted(levels.groupBy("level").agg(F.count("*").alias("words")).collect(), key=lambda r: -r["level"]):
        taken += row["words"]
        if taken > most:
            all_taken = False
            break
        least = row["level"]
    return levels.where(F.col("level") >= least).select("lang", "word"), all_taken


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", numbered: int = NUMBERED) -> DataFrame:
    """(lang, phrase, words, f): all phrases of one to three words within pieces that occur ``MIN_COUNT`` times or more;
    per language, a row with words 0 and phrase '' holds the number of all word occurrences."""
    if not 0 < numbered < 1 << BITS:
        raise ValueError(f"numbered must be from 1 to {(1 << BITS) - 1}, got {numbered}")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    words = texts.mapInPandas(_word_counts, "lang string, word binary, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))
    total = F.length("word") == 0
    words = stored(words.where(total | (F.col("f") >= MIN_COUNT)), "collocation-words", TEXT_ROWS)
    n = words.where(total).agg(F.sum("f").alias("n")).first()["n"] or 0
    shared, all_taken = _most_frequent(words.where(~total), numbered)
    known = spark.sparkContext.broadcast(shared.toArrow().combine_chunks())
    buckets = min(max(partitions(spark), n // BUCKET_WORDS), 1 << 16)

    def merge(blobs: pd.DataFrame) -> pd.DataFrame:
        table: pa.Table = known.value
        grams = np.concatenate([np.cumsum(_unblob(b)) for b in blobs["grams"]])
        grams, counts = _summed(grams, np.concatenate([_unblob(b) for b in blobs["counts"]]))
        grams, counts = grams[counts >= MIN_COUNT], counts[counts >= MIN_COUNT]
        ids = np.stack([grams >> 2 * BITS, grams >> BITS & (1 << BITS) - 1, grams & (1 << BITS) - 1])
        first, second, third = (table["word"].take(pa.array(np.maximum(x - 1, 0))).to_pylist() for x in ids)
        out = [b" ".join((b, c) if two else (a, b, c)) for two, a, b, c in zip(ids[0] == 0, first, second, third, strict=True)]
        langs = table["lang"].take(pa.array(ids[2] - 1)).to_pylist()
        # Objects also where a bucket has no frequent phrase.
        langs, out = pd.Series(langs, dtype=object), pd.Series(out, dtype=object)
        return pd.DataFrame({"lang": langs, "phrase": out, "words": np.where(ids[0] == 0, 2, 3), "f": counts})

    schema = "lang string, phrase binary, words int, f long"
    blobs = texts.mapInPandas(lambda it: _gram_blobs(it, known, buckets), "bucket int, grams binary, counts binary")
    found = [words.select("lang", F.col("word").alias("phrase"), F.when(total, 0).otherwise(1).alias("words"), "f"), blobs.groupBy("bucket").applyInPandas(merge, schema)]
    if not all_taken:
        strings = texts.mapInPandas(lambda it: _gram_counts(it, known), schema).groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
        found.append(strings.where(F.col("f") >= MIN_COUNT))
    for more in found[1:]:
        found[0] = found[0].unionByName(more)
    return stored(found[0].withColumn("phrase", F.col("phrase").cast("string")), "collocation-counts", TEXT_ROWS)


def _score(a: str, l: str, r: str) -> Column:
    return F.expr(f"(CAST({SCALE} AS {EXACT}) * CAST({a} AS {EXACT}) * CAST({a} AS {EXACT})) div (CAST({l} AS {EXACT}) * CAST({r} AS {EXACT}))")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases of two or three words: lang, rank, phrase, a, l, r, n, score (long).

    Text is lower-cased in A-Z only and split at . , ; : ! ? and line breaks into pieces, pieces at spaces and tabs
    into words; phrases lie within pieces, overlapping occurrences count. A null lang is 'und', a null text has no
    words. Candidates have a count of at least 10; a two-word candidate is dropped if it is the first or last two
    words of a three-word candidate with at least half its count. Order: score descending, a descending, phrase
    ascending (UTF-8 bytes); a lowest cut that ties keeps the smaller k. Exact: products are taken as decimals of 38
    digits. Languages without candidates give no rows; an empty table gives none. Only ``text`` and ``lang`` are read.
    """
    # Only what can matter is kept: phrases of count 10 or more (every part of a candidate has one) and the totals.
    counts = frequent_phrases(docs, text, lang)
    n = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    frequent = counts.where("words > 0")
    single = frequent.where("words = 1").select("lang", F.col("phrase").alias("part"), F.col("f").alias("fp"))
    pair = frequent.where("words = 2").select("lang", F.col("phrase").alias("part"), F.col("f").alias("fp"))

    def part_count(df: DataFrame, expr: Column, side: DataFrame, name: str) -> DataFrame:
        return df.withColumn("part", expr).join(side, ["lang", "part"]).withColumnRenamed("fp", name).drop("part")

    bigrams = frequent.where("words = 2").select("lang", "phrase", F.col("f").alias("a"))
    bigrams = part_count(bigrams, F.substring_index("phrase", " ", 1), single, "l")
    bigrams = part_count(bigrams, F.substring_index("phrase", " ", -1), single, "r")
    bigrams = bigrams.withColumn("score", _score("a", "l", "r"))

    trigrams = frequent.where("words = 3").select("lang", "phrase", F.col("f").alias("a"))
    # Drop rule: the largest count of a three-word candidate that starts or ends with the two words.
    longer = trigrams.select("lang", F.explode(F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2))).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("a_longer"))
    kept = bigrams.join(longer, ["lang", "phrase"], "left").where(F.col("a_longer").isNull() | (2 * F.col("a_longer") < F.col("a"))).drop("a_longer")
    kept = stored(kept, "collocation-pairs")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    settled = top_per(kept, ["lang"], order, top, F.xxhash64("phrase"))
    bar = settled.groupBy("lang").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("bar"))
    bar = bar.select("lang", F.when(F.col("found") >= top, F.col("bar")).otherwise(F.lit(0)).alias("bar"))

    ends = part_count(trigrams, F.substring_index("phrase", " ", 1), single, "fx")
    ends = part_count(ends, F.substring_index("phrase", " ", -1), single, "fz")
    bound = F.expr(f"(CAST({SCALE} AS {EXACT}) * CAST(a AS {EXACT})) div CAST(greatest(fx, fz) AS {EXACT})")
    grown = ends.join(bar, "lang", "left").where(bound >= F.coalesce(F.col("bar"), F.lit(0))).drop("bar")
    grown = part_count(grown, F.substring_index("phrase", " ", 2), pair, "fxy")
    grown = part_count(grown, F.substring_index("phrase", " ", -2), pair, "fyz")
    first, second = _score("a", "fx", "fyz"), _score("a", "fxy", "fz")
    low = first <= second
    grown = grown.select(
        "lang", "phrase", "a",
        F.when(low, F.col("fx")).otherwise(F.col("fxy")).alias("l"),
        F.when(low, F.col("fyz")).otherwise(F.col("fz")).alias("r"),
        F.least(first, second).alias("score"),
    )
    both = settled.drop("rank").unionByName(grown)
    best = top_per(both, ["lang"], order, top, F.xxhash64("phrase"))
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = rf"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS pid, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER_SQL}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
),
words AS (
  SELECT lang, pid, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
),
tok AS (SELECT lang, pid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM words),
nexts AS (
  SELECT lang, w, lead(w) OVER win AS w2, lead(w, 2) OVER win AS w3 FROM tok WINDOW win AS (PARTITION BY pid ORDER BY i)
),
grams AS (
  SELECT lang, w AS phrase, 1 AS k FROM nexts
  UNION ALL SELECT lang, w || ' ' || w2, 2 FROM nexts WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, w || ' ' || w2 || ' ' || w3, 3 FROM nexts WHERE w3 IS NOT NULL
),
counts AS (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY lang, phrase, k),
n AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
cand AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2 AND f >= 10
),
cuts AS (
  SELECT lang, phrase, k, a, 1 AS cut, w[1] AS lp, array_to_string(w[2:], ' ') AS rp FROM cand
  UNION ALL
  SELECT lang, phrase, k, a, 2 AS cut, w[1] || ' ' || w[2] AS lp, w[3] AS rp FROM cand WHERE k = 3
),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, lc.f AS l, rc.f AS r,
         (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(lc.f AS HUGEINT) * rc.f) AS score
  FROM cuts c
  JOIN counts lc ON lc.lang = c.lang AND lc.phrase = c.lp
  JOIN counts rc ON rc.lang = c.lang AND rc.phrase = c.rp
),
best AS (
  SELECT lang, phrase, a, k, l, r, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM scored) WHERE o = 1
),
longer AS (
  SELECT lang, sub, max(a) AS a FROM (
    SELECT lang, w[1] || ' ' || w[2] AS sub, a FROM cand WHERE k = 3
    UNION ALL
    SELECT lang, w[2] || ' ' || w[3] AS sub, a FROM cand WHERE k = 3) GROUP BY lang, sub
),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer t ON t.lang = b.lang AND t.sub = b.phrase AND b.k = 2
  WHERE t.a IS NULL OR 100 * t.a < 50 * b.a
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r,
       n.n::BIGINT AS n, r.score::BIGINT AS score
FROM ranked r JOIN n ON n.lang = r.lang
WHERE r.rank <= 2000
"""
