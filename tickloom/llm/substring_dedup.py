"""Substring dedup by seed and extend: passages of 20 or more words that occurred before are cut out.

Seed: every document's 5-word grams are hashed, and of each run of 16 consecutive grams (the grams of one 20-word
window) the smallest hash is kept as an anchor (winnowing; the rightmost on ties). A window that occurs twice has the
same 16 grams in both places and so the same anchor in both, so anchors that occur once can hold no repeat.
Documents are joined on the anchors that occur more than once. Words are hashed in Spark; Python sees hashes only,
and texts only of documents that lose words.
Extend: around each such anchor, the windows that contain it are identified by their words; a window whose words
occurred at a smaller (doc_id, start) is a repeat, and the words of all repeats form maximal repeated passages of at
least 20 words, which are removed. Only the windows whose own anchor (the rightmost smallest of their grams) repeats
are looked at. No pairs of documents are formed: equal anchors, and equal windows, meet in one sorted group each (one
shuffle each), which spills if a passage is in a third of all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import free_name, stored

# Fixed by the contract: words, and the length of a repeated passage in words.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SEPARATORS = r"[\x20\x09-\x0D]+"
WINDOW = 20
# An anchor is a gram of GRAM words; a window holds WINDOW - GRAM + 1 of them.
GRAM = 5
SPAN = WINDOW - GRAM + 1
# Words whose arrays a Python worker holds at once, besides those of one document.
PART_WORDS = 250_000
# Odd multipliers of the polynomial hashes: grams by one, windows by two (128 bits).
GRAM_BASE = np.uint64(0x9E3779B97F4A7C15)
WINDOW_BASES = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
# Null ids are ordered as this, the smallest long.
NULL_ID = -(2**63)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def _rolled(hashes: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of every run of ``length`` consecutive word hashes (wrapping at 64 bits), joined from shorter runs."""
    acc, done, run, size, power = None, 0, hashes, 1, base
    with np.errstate(over="ignore"):
        while True:
            if length & size:
                # The runs so far, then ``size`` more words.
                acc = run if acc is None else acc[: len(run) - done] * power + run[done:]
                done += size
            if done == length:
                break
            run = run[:-size] * power + run[size:]
            size, power = 2 * size, power * power
        # A final mix so that the order of the hashes, which winnowing uses, is not that of the last word.
        acc = acc ^ (acc >> np.uint64(31))
        acc *= np.uint64(0xBF58476D1CE4E5B9)
        acc ^= acc >> np.uint64(29)
    return acc


def canonical(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes, and for every window the position of its anchor: the rightmost smallest of its grams."""
    grams = _rolled(hashes, GRAM, GRAM_BASE)
    least, at, size = grams, np.arange(len(grams)), 1
    while size < SPAN:
        step = min(size, SPAN - size)
        right = least[step:] <= least[: len(least) - step]
        least, at = np.where(right, least[step:], least[: len(least) - step]), np.where(right, at[step:], at[: len(at) - step])
        size += step
    return grams, at


def _joined(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of some documents, one after another; their starts, and per window its document and whether it is within it."""
    sizes = np.array([len(x) for x in lists])
    hashes, starts = np.concatenate(lists).astype(np.int64, copy=False).view(np.uint64), np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(lists)), sizes)
    windows = max(len(hashes) - WINDOW + 1, 0)
    return hashes, starts, doc[:windows], doc[:windows] == doc[len(doc) - windows :]


def anchors(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, position, hash) of the winnowed grams of some documents' word hashes."""
    hashes, starts, doc, within = _joined(lists)
    if not within.any():
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    grams, of_window = canonical(hashes)
    picked = np.zeros(len(grams), bool)
    picked[of_window[within]] = True
    at = np.flatnonzero(picked)
    owner = np.searchsorted(starts, at, side="right") - 1
    return owner, at - starts[owner], grams[at].view(np.int64)


def candidate_windows(lists: list[np.ndarray], positions: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, 128-bit hash) of the windows whose anchor is at one of their document's
    ``positions`` (the repeated ones)."""
    hashes, starts, doc, within = _joined(lists)
    if not within.any():
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    _, of_window = canonical(hashes)
    repeated = np.zeros(len(hashes), bool)
    repeated[np.concatenate([np.asarray(p, np.int64) + s for p, s in zip(positions, starts, strict=True)])] = True
    at = np.flatnonzero(within & repeated[of_window])
    first, second = (_rolled(hashes, WINDOW, base)[at] for base in WINDOW_BASES)
    return doc[at], at - starts[doc[at]], first.view(np.int64), second.view(np.int64)


def covered(n_words: int, starts) -> np.ndarray:
    """Mask of the words inside any window that starts at one of ``starts``."""
    edges = np.zeros(n_words + 1, dtype=np.int64)
    for s in starts:
        edges[s] += 1
        edges[s + WINDOW] -= 1
    return np.cumsum(edges[:-1]) > 0


def _parts(pdf: pd.DataFrame, hashes: str) -> Iterator[pd.DataFrame]:
    """Rows of about ``PART_WORDS`` words at once, so the arrays of many documents stay small."""
    part = np.cumsum(pdf[hashes].map(len).to_numpy()) // PART_WORDS
    for _, rows in pdf.groupby(part, sort=False):
        yield rows


def _anchor_rows(batches, key: list[str], hashes: str):
    for pdf in batches:
        for rows in _parts(pdf, hashes):
            doc, at, found = anchors(rows[hashes].tolist())
            yield pd.DataFrame({c: rows[c].to_numpy()[doc] for c in key} | {"anchor": found, "pos": at})


def _window_rows(batches, key: list[str], hashes: str, positions: str):
    for pdf in batches:
        for rows in _parts(pdf, hashes):
            doc, start, first, second = candidate_windows(rows[hashes].tolist(), rows[positions].tolist())
            yield pd.DataFrame({c: rows[c].to_numpy()[doc] for c in key} | {"w1": first, "w2": second, "start": start})


def _cut(batches, n_words: str, n_removed: str, text: str):
    """Texts without the words of the windows at ``starts``; rows without such windows have a null text and stay null."""
    for texts, starts in batches:
        out = []
        for value, found in zip(texts, starts, strict=True):
            if value is None:
                out.append((None, None, None))
                continue
            words = words_of(value)
            mask = covered(len(words), found)
            out.append((" ".join(w for w, gone in zip(words, mask, strict=True) if not gone), len(words), int(mask.sum())))
        yield pd.DataFrame(out, columns=[text, n_words, n_removed]).astype({n_words: "Int64", n_removed: "Int64"})


def drop_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every word removed that lies in a 20-word window whose words occurred earlier.

    Earlier: at a smaller ``id_col``, or in the same document at a smaller start; windows are judged on the input,
    not on what is left. Words are maximal runs without space, tab or line breaks (\\x09-\\x0D), unchanged; the text
    that stays is its words joined by one space. Added: ``n_words`` and ``n_removed`` (long), which replace columns
    of those names; all other columns pass through.
    Defined cases: a null text has no words and becomes ''; texts of fewer than 20 words have no window: they lose
    nothing and repeat nothing. Rows with equal id and equal text are one document: they are judged alike and do
    not repeat each other. Rows with equal id and different texts are ordered by a hash of their text. A null id is
    ordered as the smallest long. An empty table gives an empty table.
    Words are hashed by Spark's xxhash64 and windows told apart by two 64-bit polynomial hashes of those; two
    different windows taken for one is a chance of about 2^-100 per pair.
    """
    order, tag, hashes = (free_name(docs.columns, c) for c in ("_order_id", "_text_hash", "_word_hashes"))
    key = [order, tag]
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), SEPARATORS), lambda w: w != "")
    tagged = docs.withColumns({order: F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)), tag: F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    with_hashes = tagged.select(*key, F.transform(words, lambda w: F.xxhash64(w)).alias(hashes))
    key_fields = [T.StructField(c, T.LongType(), False) for c in key]

    anchor_schema = T.StructType([*key_fields, T.StructField("anchor", T.LongType()), T.StructField("pos", T.LongType())])
    found = with_hashes.where(F.size(hashes) >= WINDOW).mapInPandas(lambda it: _anchor_rows(it, key, hashes), anchor_schema)
    # Anchors seen more than once: one shuffle on the anchor hash.
    seen = F.count(F.lit(1)).over(Window.partitionBy("anchor"))
    seeds = found.withColumn("n", seen).where("n > 1").groupBy(*key).agg(F.collect_list(F.col("pos").cast("int")).alias("positions"))
    # Written apart, so the shuffle of all anchors is over before that of the windows takes its place on disk.
    seeds = stored(seeds, "substring-seeds")

    slim = tagged.select(*key, text)
    seeded = slim.join(seeds, key).select(*key, F.transform(words, lambda w: F.xxhash64(w)).alias(hashes), "positions")
    window_schema = T.StructType([*key_fields, T.StructField("w1", T.LongType()), T.StructField("w2", T.LongType()), T.StructField("start", T.LongType())])
    windows = seeded.mapInPandas(lambda it: _window_rows(it, key, hashes, "positions"), window_schema)
    # First occurrences: one shuffle on the window hash, ordered within each group of equal windows.
    earlier = F.row_number().over(Window.partitionBy("w1", "w2").orderBy(*key, "start"))
    repeats = windows.withColumn("o", earlier).where("o > 1").groupBy(*key).agg(F.collect_list(F.col("start").cast("int")).alias("starts"))
    repeats = stored(repeats, "substring-repeats")

    starts, cut = (free_name(tagged.columns, c) for c in ("_repeat_starts", "_cut"))
    repeats = repeats.withColumnRenamed("starts", starts)
    struct = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    @F.pandas_udf(struct)
    def without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from _cut(batches, "n_words", "n_removed", "text")

    # One join; only the texts that lose words go to Python.
    has = F.col(starts).isNotNull()
    joined = tagged.join(repeats, key, "left").withColumn(cut, without(F.when(has, F.col(text)), F.col(starts)))
    c = lambda field: F.col(f"{cut}.{field}")
    made = {
        text: F.when(has, c("text")).otherwise(F.array_join(words, " ")),
        "n_words": F.when(has, c("n_words")).otherwise(F.size(words).cast("long")),
        "n_removed": F.coalesce(c("n_removed"), F.lit(0).cast("long")),
    }
    plain = [F.col(f"`{name}`") if name != text else made[text].alias(text) for name in docs.columns if name not in ("n_words", "n_removed")]
    return joined.select(*plain, made["n_words"].alias("n_words"), made["n_removed"].alias("n_removed"))


SQL = r"""
WITH split AS (
  SELECT doc_id, hash(coalesce(text, '')) AS tag,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
),
words AS (
  SELECT doc_id, tag, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM split
),
framed AS (
  SELECT doc_id, tag, i,
         string_agg(word, ' ') OVER (PARTITION BY doc_id, tag ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS win,
         count(*) OVER (PARTITION BY doc_id, tag ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS len
  FROM words
),
repeats AS (
  SELECT doc_id, tag, i FROM (
    SELECT doc_id, tag, i, dense_rank() OVER (PARTITION BY win ORDER BY doc_id, i) AS r
    FROM framed WHERE len = 20) WHERE r > 1
),
marked AS (
  SELECT w.doc_id, w.tag, w.word, w.i,
         max(r.i + 19) OVER (PARTITION BY w.doc_id, w.tag ORDER BY w.i ROWS UNBOUNDED PRECEDING) AS reach
  FROM words w LEFT JOIN repeats r ON r.doc_id IS NOT DISTINCT FROM w.doc_id AND r.tag = w.tag AND r.i = w.i
),
per_doc AS (
  SELECT doc_id, tag, count(*) AS n_words, count(*) FILTER (WHERE reach >= i) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE reach IS NULL OR reach < i), '') AS kept
  FROM marked GROUP BY doc_id, tag
)
SELECT d.doc_id, coalesce(p.n_words, 0)::BIGINT AS n_words, coalesce(p.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(p.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per_doc p ON p.doc_id IS NOT DISTINCT FROM d.doc_id AND p.tag = hash(coalesce(d.text, ''))
"""
