"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows, one scan of each text.

A text becomes its lower-cased words, joined by single spaces. Windows of ten words of every benchmark item are the
automaton's patterns, each with a space on both sides, so that matches begin and end at words. Matches are word
positions, and only documents with a match map them back to offsets in the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import free_name, stored

WINDOW = 10
# Most bytes of window text in one automaton; a larger benchmark is cut in several, each with its own scan.
AUTOMATON_BYTES = 64 * 1024 * 1024

# What is a word in the contract, after A-Z became a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
# For UTF-8 bytes: letters in lower case, digits and bytes above 127 stay, everything else is a space.
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)

SPAN = T.StructType([
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
])
SCAN = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN))])


def normal_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).split() if text else []


def windows_of(text: str | None, window: int = WINDOW) -> list[str]:
    """The item's distinct windows; an item of fewer words, but not none, is one window."""
    words = normal_words(text)
    n = max(1, len(words) - window + 1) if words else 0
    return list(dict.fromkeys(b" ".join(words[k:k + window]).decode("utf-8", "surrogatepass") for k in range(n)))


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(window, items): every distinct window with the ids, as strings, of the items that hold it."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: windows_of(t, window))

    rows = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.explode(cut(F.col(f"`{text_col}`"))).alias("window"))
    return rows.groupBy("window").agg(F.array_sort(F.collect_set(F.coalesce("item", F.lit("null")))).alias("items"))


def build(patterns: list[tuple[str, tuple[str, ...]]]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for window, items in patterns:
        machine.add_word(f" {window} ", (window.count(" ") + 1, items))
    machine.make_automaton()
    return machine


def scan_text(text: str | None, machine: ahocorasick.Automaton, empty: bool) -> tuple[int, list[dict]]:
    """Number of words and all window occurrences, overlapping ones too, in order of their end."""
    words = normal_words(text)
    if empty or not words:
        return len(words), []
    line = b" " + b" ".join(words) + b" "
    found = list(machine.iter(line.decode("utf-8", "surrogatepass")))
    if not found:
        return len(words), []
    line = line.decode("utf-8", "surrogatepass")
    offsets = [m.span() for m in _ORIGINAL_WORD.finditer(text)]
    spans, at, seen = [], 0, 0
    for end, (length, items) in found:
        # ``end`` is the space after the last word, so it closes as many words as there are spaces before it.
        seen += line.count(" ", at, end)
        at = end
        last = seen - 1
        spans.append({"first_word": last - length + 1, "last_word": last, "start": offsets[last - length + 1][0], "end": offsets[last][1], "items": list(items)})
    return len(words), spans


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    out: str = "benchmark_scan",
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """``docs`` with a column ``out``: n_words and spans (word positions, code-point offsets, item ids).

    Every occurrence of every window is a span. The windows are measured before they are collected; if their text
    exceeds ``automaton_bytes``, they are dealt by hash into blocks of about that size, and the documents pass one
    automaton after another, so what one worker holds does not grow with the benchmark. No shuffle of documents.

    Null texts have no words and no spans; items without words have no windows; repeated items and rows each count;
    null item ids appear as "null"; a column of the documents named like ``out`` makes the new one ``out_``.
    """
    spark = docs.sparkSession
    table = stored(item_windows(benchmark, item_id, item_text, window), "windows")
    total = table.agg(F.coalesce(F.sum(F.octet_length("window") + 64), F.lit(0)).alias("b")).first()["b"]
    blocks = max(1, -(-int(total) // automaton_bytes))
    name = free_name(docs.columns, out)
    result = docs
    for block in range(blocks):
        part = table.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast([(r["window"], tuple(r["items"])) for r in part.toLocalIterator()])

        @F.pandas_udf(SCAN)
        def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            machine, empty = build(shared.value), not shared.value
            for texts in batches:
                yield pd.DataFrame([scan_text(t, machine, empty) for t in texts], columns=["n_words", "spans"])

        now = scan(F.col(f"`{text_col}`"))
        if block == 0:
            result = docs.withColumn(name, now)
            continue
        # Written between scans, so that one automaton at a time is in memory.
        result = stored(result, "scanned").withColumn("_more", now)
        both = F.struct(F.col(f"{name}.n_words"), F.concat(F.col(f"{name}.spans"), F.col("_more.spans")).alias("spans"))
        result = result.withColumn(name, both).drop("_more")
    return result


def hit_words(spans: Column) -> Column:
    """Number of words inside any span: spans in order of their first word, each adds what lies beyond those before."""
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(-1).cast("long").alias("upto"))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["first_word"].alias("a"), s["last_word"].alias("b"))))
    step = lambda acc, s: F.struct(
        (acc["hit"] + F.greatest(F.lit(0).cast("long"), s["b"] - F.greatest(s["a"] - 1, acc["upto"]))).alias("hit"),
        F.greatest(acc["upto"], s["b"]).alias("upto"),
    )
    return F.aggregate(ordered, start, step, lambda acc: acc["hit"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_benchmark(docs.select(id_col, "text"), benchmark)
    items = F.array_sort(F.array_distinct(F.flatten(F.col("benchmark_scan.spans.items"))))
    n_hit = hit_words(F.col("benchmark_scan.spans"))
    rows = found.select(id_col, F.col("benchmark_scan.n_words").alias("n_words"), n_hit.alias("n_hit"), items.alias("items"))
    return rows.select(
        id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs, with the columns they came with."""
    found = find_benchmark(docs, benchmark)
    scan = next(c for c in found.columns if c not in docs.columns)
    return found.where(F.size(F.col(f"`{scan}`.spans")) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def brute_force(texts: dict, items: dict, window: int = WINDOW) -> dict:
    """For tests: doc_id -> (n_words, n_hit, n_items, items_sha256), by looking at every position."""
    where = defaultdict(set)
    for item, text in items.items():
        words = re.findall(WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            where[tuple(words[k:k + window])].add(str(item))
    lengths, out = {len(w) for w in where}, {}
    for doc, text in texts.items():
        words = re.findall(WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))
        hit, got = set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                if owners := where.get(tuple(words[k:k + n])):
                    hit.update(range(k, k + n))
                    got |= owners
        out[doc] = (len(words), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest())
    return out


_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""WITH i AS (SELECT item_id, regexp_extract_all({_LOW}, '{WORD}') AS w FROM benchmark),
iw AS (SELECT item_id, least(len(w), {WINDOW}) AS n, array_to_string(list_slice(w, k, k + least(len(w), {WINDOW}) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - {WINDOW - 1}))) AS k FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw), ids AS (SELECT DISTINCT win, item_id FROM iw),
d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOW}, '{WORD}'), []) AS w FROM documents),
p AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d JOIN lens ON len(w) >= n),
hits AS (SELECT doc_id, k, n, item_id FROM (SELECT doc_id, k, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS win FROM p) JOIN ids USING (win)),
hw AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS pos FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)"""
