"""Byte-level BPE: ranked merges folded by higher-order functions, and decoding by joining pieces.

A text is cut before every space that a non-space follows; the tokenizer's pattern never matches across such a cut, so
the cuts' words can be encoded one by one. The most frequent distinct words of the whole corpus, 200,000 at most, are
folded in Spark and shared with all tasks; they are nearly all words of a corpus. The fold holds the array of token
ids of a word, starting with its bytes, and the ranks of neighbouring pairs; each step merges the leftmost pair of the
lowest rank, looked up in a map that is broadcast as a table of one row: as a literal, it stood in the plan once per
use, and the driver held many copies of it. The map is an array of buckets, so a look-up does not search all pairs.

Any other word is merged by the same rule in the task that meets it: Spark evaluates lambdas node by node, about 110
microseconds for a word of ten bytes, too long for every rare word of a large corpus (README has the figures).
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, stored

# Most words that are folded once and shared with all tasks, and the longest of them, in characters.
SHARED_WORDS = 200_000
SHARED_LENGTH = 48
# A pattern match of more bytes is merged with a heap, in n log n.
FOLD_BYTES = 256
BUCKETS = 1 << 16
TEXT_ROWS = 1000
# Words per row that meets the map of pairs.
ROW_WORDS = 500
# Words that a task remembers besides the shared ones.
CACHE_WORDS = 300_000
NONE = 1 << 40

_CUT = re.compile(r"(?= \S)")
_DOUBTFUL = re.compile(r" (?=\s)")


@dataclass
class Ranks:
    """A vocabulary of byte pieces by rank, and the pattern that cuts text."""

    ranks: dict[bytes, int]
    pattern: str

    @classmethod
    def load(cls, path: str, pattern: str) -> Ranks:
        """Read a file of base64 pieces and ranks, on the driver."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}, pattern)

    def pairs(self) -> tuple[list[list[int]], list[list[int]]]:
        """All pairs of ids whose pieces join to a piece: per bucket, pair keys and joined ids."""
        keys, values = [[] for _ in range(BUCKETS)], [[] for _ in range(BUCKETS)]
        for piece, rank in self.ranks.items():
            for cut in range(1, len(piece)):
                a, b = self.ranks.get(piece[:cut]), self.ranks.get(piece[cut:])
                if a is not None and b is not None:
                    slot = (a * 40503 + b) % BUCKETS
                    keys[slot].append(a << 32 | b)
                    values[slot].append(rank)
        return keys, values


def words_of(text: str) -> list[str]:
    """Keys of the words of a text that is cut before every space that is followed by a non-space.

    A word is its key with a space before it; the first one, which may have none, has a key that begins with a space
    and is the rest of that key. So most keys are what splitting at spaces gives.
    """
    if _DOUBTFUL.search(text):
        words = [w for w in _CUT.split(text) if w]
        return [f" {words[0]}", *[w[1:] for w in words[1:]]]
    keys = text.split(" ")
    # A text that begins with a space before a word has no first word.
    if keys[0]:
        keys[0] = f" {keys[0]}"
    else:
        del keys[0]
    return keys


def word_of(key: str) -> str:
    return key[1:] if key[:1] == " " else f" {key}"


def heap_merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges in n log n, for very long matches: lowest rank first, leftmost first among equals."""
    n = len(piece)
    start, end = list(range(n)), list(range(1, n + 1))
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    alive = [True] * n
    heap = []

    def offer(i: int) -> None:
        j = right[i]
        if j >= 0 and (rank := ranks.get(piece[start[i]:end[j]])) is not None:
            heapq.heappush(heap, (rank, start[i], i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, _, i, upto = heapq.heappop(heap)
        j = right[i] if alive[i] else -1
        if j < 0 or end[j] != upto:
            continue
        end[i], right[i], alive[j] = end[j], right[j], False
        if right[i] >= 0:
            left[right[i]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    return [ranks[piece[start[i]:end[i]]] for i in range(n) if alive[i]]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pattern match."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > FOLD_BYTES:
        return heap_merge(piece, ranks)
    parts = [piece[k:k + 1] for k in range(len(piece))]
    pairs = [ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
    while pairs and (lowest := min(pairs)) < NONE:
        k = pairs.index(lowest)
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
        del pairs[k]
        if k:
            pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], NONE)
        if k < len(pairs):
            pairs[k] = ranks.get(parts[k] + parts[k + 1], NONE)
    return [ranks[p] for p in parts]


def start_ids(word: str, vocabulary: Ranks, find: regex.Pattern) -> list[list[int]]:
    """Ids that the fold starts from, per pattern match: the match itself if it is a piece, else its bytes."""
    out, ranks = [], vocabulary.ranks
    for match in find.findall(word):
        piece = match.encode("utf-8", "surrogatepass")
        whole = ranks.get(piece)
        out.append([whole] if whole is not None else [ranks[bytes([b])] for b in piece])
    return out


def merge_fold(vocabulary: Ranks, maps: tuple[Column, Column] | None = None):
    """A function from a column of start ids (array of int) to the merged ids.

    ``maps``: columns that hold ``vocabulary.pairs()``; without them the pairs are constants of the plan.
    """
    if maps is None:
        keys, values = vocabulary.pairs()
        maps = F.from_json(F.lit(json.dumps(keys)), "array<array<bigint>>"), F.from_json(F.lit(json.dumps(values)), "array<array<int>>")
    key_map, value_map = maps
    none = F.array().cast("array<int>")

    def look(a: Column, b: Column) -> Column:
        slot = F.pmod(a.cast("long") * 40503 + b, F.lit(BUCKETS)).cast("int")
        at = F.array_position(F.get(key_map, slot), a.cast("long") * 4294967296 + b)
        return F.get(F.get(value_map, slot), (at - 1).cast("int"))

    def state(ids: Column, ranks: Column) -> Column:
        lowest = F.coalesce(F.array_position(ranks, F.array_min(ranks)), F.lit(0)).cast("int")
        return F.struct(ids.alias("ids"), ranks.alias("ranks"), lowest.alias("at"))

    def bound(value: Column, use) -> Column:
        """``use`` of a value that is computed once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def step(acc: Column, _: Column) -> Column:
        ids, ranks, at = acc["ids"], acc["ranks"], acc["at"]
        n = F.size(ids)
        new = F.get(ranks, at - 1)
        before = F.when(at > 1, F.array(look(F.get(ids, at - 2), new))).otherwise(none)
        after = F.when(at + 1 < n, F.array(look(new, F.get(ids, at + 1)))).otherwise(none)
        merged = F.concat(F.slice(ids, F.lit(1), at - 1), F.array(new), F.slice(ids, at + 2, n))
        changed = F.concat(F.slice(ranks, F.lit(1), F.greatest(at - 2, F.lit(0))), before, after, F.slice(ranks, at + 2, n))
        return F.when(at == 0, acc).otherwise(bound(changed, lambda r: state(merged, r)))

    def fold(start: Column) -> Column:
        n = F.size(start)
        pairs = F.when(n > 1, F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: look(F.get(start, i), F.get(start, i + 1)))).otherwise(none)
        zero = bound(pairs, lambda r: state(start, r))
        merged = F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), zero, step, lambda acc: acc["ids"])
        return F.when(n < 2, start).otherwise(merged)

    return fold


def shared_words(docs: DataFrame, text_col: str, vocabulary: Ranks, shared: int) -> pa.Table:
    """The most frequent words of all texts with their ids, at most ``shared`` of them, as one compact table.

    Counts are combined per batch and per task before the shuffle. A histogram of at most 256 rows gives the least
    frequency that keeps the number within the bound. Which words are shared changes the cost, never a result.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts: Counter = Counter()
            for text in frame["text"]:
                if text:
                    counts.update(words_of(text))
            kept = [(w, n) for w, n in counts.items() if len(w) <= SHARED_LENGTH]
            yield pd.DataFrame(kept, columns=["word", "n"])

    words = docs.select(F.col(f"`{text_col}`").alias("text")).mapInPandas(count, "word string, n long")
    level = F.floor(4 * F.log2("n")).cast("int")
    totals = words.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1").withColumn("level", level)
    totals = stored(totals, "words", TEXT_ROWS)
    taken, least = 0, None
    for row in sorted(totals.groupBy("level").agg(F.count("*").alias("words")).collect(), key=lambda r: -r["level"]):
        taken += row["words"]
        if taken > shared:
            break
        least = row["level"]
    if least is None:
        least = 1 << 20
    encoded = encode_words(totals.where(F.col("level") >= least).select("word"), vocabulary)
    return stored(encoded, "encoded").toArrow().combine_chunks()


def as_bytes(table: pa.Table) -> dict[str, bytes]:
    """Word to its ids, four bytes each."""
    if not len(table):
        return {}
    ids = table["ids"].combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    at, data = (ids.offsets.to_numpy() * 4).tolist(), ids.values.to_numpy().astype("<i4").tobytes()
    return {w: data[at[k]:at[k + 1]] for k, w in enumerate(table["word"].to_pylist())}


def encode_words(words: DataFrame, vocabulary: Ranks) -> DataFrame:
    """(word, ids) for distinct keys of words; some hundred words are a row while they meet the map of pairs."""
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    keys, values = vocabulary.pairs()
    types = pa.schema([("_keys", pa.list_(pa.list_(pa.int64()))), ("_values", pa.list_(pa.list_(pa.int32())))])
    maps = spark.createDataFrame(pa.table([[keys], [values]], schema=types))

    def starts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = regex.compile(shared.value.pattern)
        for batch in batches:
            for at in range(0, len(batch), ROW_WORDS):
                some = batch["word"].iloc[at:at + ROW_WORDS].tolist()
                yield pd.DataFrame({"words": [some], "starts": [[start_ids(word_of(key), shared.value, find) for key in some]]})

    rows = words.select("word").mapInPandas(starts, "words array<string>, starts array<array<array<int>>>").crossJoin(F.broadcast(maps))
    fold = merge_fold(vocabulary, (F.col("_keys"), F.col("_values")))
    ids = F.transform("starts", lambda matches: F.flatten(F.transform(matches, fold)))
    pairs = rows.select(F.arrays_zip(F.col("words").alias("word"), ids.alias("ids")).alias("pairs"))
    return pairs.select(F.inline("pairs")).toDF("word", "ids")


class Rare(dict):
    """Ids of words that are not shared, made when first met: each pattern match is a shared word or is merged here.

    Words and matches are kept in bounded caches.
    """

    def __init__(self, vocabulary: Ranks, shared: dict[str, bytes]):
        super().__init__()
        self.find, self.ranks = regex.compile(vocabulary.pattern), vocabulary.ranks
        self.shared, self.matches = shared, {}

    def __missing__(self, key: str) -> bytes:
        parts = []
        for match in self.find.findall(word_of(key)):
            # A key that begins with a space is not a space and a word, but a first word (see words_of).
            ids = (self.shared.get(match[1:]) if match[0] == " " and match[1:2] != " " else None) or self.matches.get(match)
            if ids is None:
                merged = merge(match.encode("utf-8", "surrogatepass"), self.ranks)
                if len(self.matches) >= CACHE_WORDS:
                    self.matches.clear()
                self.matches[match] = ids = struct.pack(f"<{len(merged)}i", *merged)
            parts.append(ids)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[key] = found = b"".join(parts)
        return found


_worker: dict = {}


def in_worker(known, rules) -> tuple[dict[str, bytes], Rare]:
    """The shared words and the cache of rare ones, kept by a worker from task to task; one pair at a time."""
    table = known.value
    if _worker.get("table") is not table:
        words = as_bytes(table)
        _worker.update(table=table, pair=(words, Rare(rules.value, words)))
    return _worker["pair"]


def encoder(docs: DataFrame, vocabulary: Ranks, text_col: str = "text", shared: int = SHARED_WORDS) -> Column:
    """A column of token ids of ``text_col``; counts and folds the shared words when it is made."""
    sc = docs.sparkSession.sparkContext
    known = sc.broadcast(shared_words(docs, text_col, vocabulary, shared))
    rules = sc.broadcast(vocabulary)

    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words, rare = in_worker(known, rules)
        for batch in batches:
            out = []
            for text in batch:
                parts = words_of(text) if text else []
                out.append(np.frombuffer(b"".join([words.get(w) or rare[w] for w in parts]), "<i4"))
            yield pd.Series(out)

    return encoded(F.col(f"`{text_col}`"))


def encode(docs: DataFrame, vocabulary: Ranks, text_col: str = "text", out: str = "ids", shared: int = SHARED_WORDS) -> DataFrame:
    """``docs`` with a column ``out``: the token ids of each whole text, without special tokens.

    No shuffle of texts; what is shuffled is a count per distinct word and task. Null texts count as empty and have no
    ids; repeated rows are encoded each; very long words without a space are merged with a heap; an empty table gives
    an empty result; a column named like ``out`` makes the new one ``out_``.
    """
    return docs.withColumn(free_name(docs.columns, out), encoder(docs, vocabulary, text_col, shared))


def pieces_by_id(ranks: dict[bytes, int]) -> np.ndarray:
    """The piece of each id, so the pieces of all ids of a text are taken at once; None where no piece has the id."""
    pieces = np.full(max(ranks.values(), default=-1) + 1, None, object)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def id_names(n: int) -> np.ndarray:
    """The decimal name of each id below ``n`` with a space behind it, as fixed-width bytes that zeros fill up."""
    return np.array([f"{k} " for k in range(n)], dtype=f"S{len(str(n)) + 1}")


def joined_names(ids: np.ndarray, names: np.ndarray) -> bytes:
    """Decimal ids joined by one space: fixed-width names in a row, without the zeros between and the last space."""
    return names[ids].tobytes().translate(None, b"\0")[:-1]


def joined_pieces(ids: np.ndarray, pieces: np.ndarray) -> bytes:
    if len(ids) and ids.min() < 0:
        raise KeyError(f"negative id {ids.min()}")
    return b"".join(pieces[ids].tolist())


def decoder(vocabulary: Ranks, df: DataFrame):
    """A function from a column of ids to the bytes that they stand for: their binary pieces, joined."""
    rules = df.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = pieces_by_id(rules.value.ranks)
        for batch in batches:
            yield batch.map(lambda ids: joined_pieces(ids, pieces))

    return decoded


def digests(vocabulary: Ranks, df: DataFrame):
    """A function from a column of ids to (n_tokens, ids_sha256, decoded_sha256)."""
    rules = df.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digested(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pieces = pieces_by_id(rules.value.ranks)
        names = id_names(len(pieces))
        for batch in batches:
            rows = [(len(ids), sha256(joined_names(ids, names)).hexdigest(), sha256(joined_pieces(ids, pieces)).hexdigest()) for ids in batch]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digested


def token_report(docs: DataFrame, vocabulary: Ranks, id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, from the ids of ``encoder``."""
    slim = docs.select(id_col, "text")
    made = slim.select(id_col, digests(vocabulary, docs)(encoder(slim, vocabulary)).alias("d")).select(id_col, "d.*")
    return stored(made, "tokens", TEXT_ROWS)
