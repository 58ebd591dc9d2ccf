"""Secret scan: base rules, and automata inferred from what the rules found.

Credentials that the base rules find are labelled by their rule. For each kind, a prefix tree of a bounded sample is
folded into a probabilistic automaton: states whose outgoing frequencies agree by the Hoeffding bound are merged. One
more automaton is learnt from ordinary long tokens. Every long token that no base span covers is then scored by the
difference of its log-likelihoods per symbol; what looks more like a credential than like ordinary text becomes a span
of kind ``format``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, stored

# The base rules; order is the order of kinds.
KINDS = ("assign", "access", "hex", "format")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
# A token to be scored.
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"

# Labelled credentials per kind, and ordinary tokens, that an automaton is inferred from; the first by hash.
FIT_ROWS = 1500
FIT_SYMBOLS = 128
ALPHA = 0.05
# Bits per symbol by which a credential automaton must beat the ordinary one.
MARGIN = 1.7

FOUND = "array<struct<kind:string,start:long,end:long,value:string>>"


def base_spans(text: str | None) -> list[tuple[str, int, int, str]]:
    """Spans of whole matches, by start and then kind; leftmost and not overlapping within a kind."""
    if not text:
        return []
    out = [("assign", *m.span(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    # A run of 24 or more is the same as a greedy run that is kept if it has 24 or more.
    out += [("hex", *m.span(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def free_tokens(text: str | None, base: Sequence[tuple]) -> list[tuple[str, int, int, str]]:
    """Long tokens that overlap no base span."""
    if not text:
        return []
    out, spans, k = [], sorted((b[1], b[2]) for b in base), 0
    for m in _TOKEN.finditer(text):
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        if not any(s < m.end() and m.start() < e for s, e in spans[k:k + 3]):
            out.append(("format", *m.span(), m[0]))
    return out


class Automaton:
    """A probabilistic automaton inferred from strings by merging compatible states of their prefix tree."""

    def __init__(self, words: Sequence[str], alpha: float = ALPHA):
        # Per state: strings that pass, strings that end, counts and targets by symbol.
        self.seen, self.ends, self.count, self.to = [0], [0], [{}], [{}]
        for word in words:
            at = 0
            for symbol in word[:FIT_SYMBOLS]:
                self.seen[at] += 1
                self.count[at][symbol] = self.count[at].get(symbol, 0) + 1
                if symbol not in self.to[at]:
                    self.to[at][symbol] = len(self.seen)
                    self.seen.append(0), self.ends.append(0), self.count.append({}), self.to.append({})
                at = self.to[at][symbol]
            self.seen[at] += 1
            self.ends[at] += 1
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()
        self._pack()

    def _differ(self, f: int, n: int, g: int, m: int) -> bool:
        return bool(n and m) and abs(f / n - g / m) > self._bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if self._differ(self.ends[x], self.seen[x], self.ends[y], self.seen[y]):
                return False
            for symbol in self.count[x].keys() | self.count[y].keys():
                if self._differ(self.count[x].get(symbol, 0), self.seen[x], self.count[y].get(symbol, 0), self.seen[y]):
                    return False
                if symbol in self.to[x] and symbol in self.to[y]:
                    todo.append((self.to[x][symbol], self.to[y][symbol]))
        return True

    def _fold(self, into: int, state: int) -> None:
        """Add the tree below ``state`` to the automaton at ``into``."""
        todo = [(into, state)]
        while todo:
            x, y = todo.pop()
            self.seen[x] += self.seen[y]
            self.ends[x] += self.ends[y]
            for symbol, n in self.count[y].items():
                self.count[x][symbol] = self.count[x].get(symbol, 0) + n
                if symbol in self.to[x]:
                    todo.append((self.to[x][symbol], self.to[y][symbol]))
                else:
                    self.to[x][symbol] = self.to[y][symbol]

    def _merge_all(self) -> None:
        """States that stay are settled one by one; their successors merge into one of them or are settled too."""
        settled = [0]
        while True:
            open_edges = [(-self.seen[t], s, symbol) for s in settled for symbol, t in self.to[s].items() if t not in settled]
            if not open_edges:
                break
            _, source, symbol = min(open_edges)
            state = self.to[source][symbol]
            for other in settled:
                if self._compatible(other, state):
                    self.to[source][symbol] = other
                    self._fold(other, state)
                    break
            else:
                settled.append(state)
        self.settled = settled

    def _pack(self) -> None:
        """Log2 probability and target by (state, symbol), with add-one-tenth smoothing over the alphabet."""
        self.step = {}
        self.missing = {}
        for s in self.settled:
            total = self.seen[s] + 0.1 * (len(ALPHABET) + 1)
            self.missing[s] = math.log2(0.1 / total)
            for symbol, n in self.count[s].items():
                self.step[s, symbol] = (math.log2((n + 0.1) / total), self.to[s][symbol])
        del self.seen, self.ends, self.count, self.to

    def bits(self, word: str) -> float:
        """Mean log2 probability of a symbol; a symbol that a state does not know leads back to the start."""
        at, total = 0, 0.0
        for symbol in word:
            p, at = self.step.get((at, symbol)) or (self.missing[at], 0)
            total += p
        return total / max(1, len(word))


def learn(spans: DataFrame, base: str, tokens: str, fit_rows: int = FIT_ROWS) -> tuple[dict[str, Automaton], Automaton]:
    """An automaton per kind that has labelled credentials, and one of ordinary tokens, from bounded samples.

    The samples are the ``fit_rows`` distinct strings with the smallest hashes, so they do not depend on partitioning.
    """

    def sample(column: str, kind: str) -> list[str]:
        one = spans.select(F.explode(column).alias("s")).where(F.col("s.kind") == kind).select("s.value").distinct()
        rows = one.where(F.length("value") <= 4 * FIT_SYMBOLS).orderBy(F.xxhash64("value"), "value").limit(fit_rows).collect()
        return [r["value"] for r in rows]

    samples = {kind: sample(base, kind) for kind in KINDS[:3]}
    return {kind: Automaton(words) for kind, words in samples.items() if words}, Automaton(sample(tokens, "format"))


def digest_of(spans: Column) -> Column:
    """kind:start:end of an ordered array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, text_col: str = "text", out: str = "secrets", margin: float = MARGIN, keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with arrays ``out`` and ``out_base`` of (kind, start, end, value).

    Texts are read once; spans and long tokens are written to the shared folder and scored from there. Offsets are code
    points, ends exclusive, of whole matches; ``value`` is the credential itself. Spans are ordered by start, then kind.

    Null texts have no spans; repeated rows have the same spans each; without labelled credentials nothing is added to
    the base spans; an empty table gives an empty result; clashing columns make the new names end in underscores.
    """
    kept = [F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)]
    name, base_name = (free_name(docs.columns, n) for n in (out, f"{out}_base"))
    tokens = free_name(docs.columns, "_tokens")

    @F.pandas_udf(f"struct<base:{FOUND},tokens:{FOUND}>")
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base = base_spans(text)
            rows.append((base, free_tokens(text, base)))
        return pd.DataFrame(rows, columns=["base", "tokens"])

    found = docs.select(*kept, scan(F.col(f"`{text_col}`")).alias("_scan"))
    found = found.select(*kept, F.col("_scan.base").alias(base_name), F.col("_scan.tokens").alias(tokens))
    found = stored(found, "spans")
    kinds, ordinary = learn(found, base_name, tokens)
    shared = docs.sparkSession.sparkContext.broadcast((list(kinds.values()), ordinary))

    @F.pandas_udf("array<boolean>")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automata, plain = shared.value
        for values in batches:
            yield pd.Series([
                [bool(automata) and max(a.bits(v) for a in automata) - plain.bits(v) > margin for v in row] for row in values
            ])

    verdict = judged(F.transform(tokens, lambda s: s["value"]))
    added = F.filter(F.col(tokens), lambda s, i: F.get(F.col("_ok"), i))
    order = F.array(*[F.lit(k) for k in KINDS])
    rank = lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s.alias("s"))
    every = F.transform(F.array_sort(F.transform(F.concat(F.col(base_name), added), rank)), lambda r: r["s"])
    out_cols = [F.col(f"`{c}`") for c in found.columns if c != tokens]
    return found.withColumn("_ok", verdict).withColumn(name, every).select(*out_cols, name)


def secret_report(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = find_secrets(docs.select(id_col, "text"), keep=[id_col])
    count = lambda kind: F.size(F.filter("secrets_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.sha2(digest_of(F.col("secrets_base")), 256).alias("base_sha256")
    return found.select(id_col, *[count(k) for k in KINDS[:3]], base, digest_of(F.col("secrets")).alias("spans"))
