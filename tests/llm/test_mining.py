"""Substring dedup, phrase collocations and source divergence against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from tickloom.llm import substring_dedup

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def repeats_by_brute_force(rows):
    """Words removed per document: every window compared with every earlier one."""
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    seen, out = set(), {}
    for i in sorted(words):
        w = words[i]
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            if key in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substring_repeats_equal_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"t{k}" for k in range(40)]
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    rows = []
    for i in range(60):
        own = [rng.choice(vocab) for _ in range(rng.randint(0, 90))]
        if i % 3 == 0:
            cut = rng.randint(0, len(own))
            take = passage.split()[rng.randint(0, 20) : rng.randint(35, 60)]
            own[cut:cut] = take
        if i % 7 == 0:
            own += own[: rng.randint(0, len(own))]  # repeats inside one document
        rows.append((i, "\t".join(own) if i % 2 else " \n".join(own)))
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOC)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in substring_dedup.drop_repeats(df).collect()}
    assert got == repeats_by_brute_force(rows)
    assert sum(v[1] for v in got.values()) > 0


def test_substring_edge_cases(spark):
    long = " ".join(f"w{k % 977}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, "a b c"), (4, long), (4, long), (5, long), (None, long), (6, " \n\t "), (7, "x" * 20_000)]
    df = spark.createDataFrame([(i, t, "en", None, None, "x", 3) for i, t in rows], DOC + ", n_words string, _order_id int")
    got = substring_dedup.drop_repeats(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert [(r["text"], r["n_words"], r["n_removed"]) for r in by[1] + by[2] + by[6]] == [("", 0, 0)] * 3
    assert (by[3][0]["text"], by[3][0]["n_removed"]) == ("a b c", 0)
    # The null id comes first; its text repeats itself after 977 words, and ids 4 and 5 repeat all of it.
    assert by[None][0]["n_removed"] == 30_000 - 977
    assert [r["n_removed"] for r in by[4]] == [30_000, 30_000] and by[5][0]["n_removed"] == 30_000
    assert by[7][0]["n_words"] == 1 and by[7][0]["_order_id"] == 3
    assert substring_dedup.drop_repeats(df.limit(0)).count() == 0


def collocations_by_brute_force(rows, top=2000):
    """Every phrase counted and scored directly."""
    from collections import Counter

    counts, n = {}, Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        c = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    c[tuple(w[i : i + k])] += 1
    out = []
    for lang, c in counts.items():
        cand = {p: a for p, a in c.items() if len(p) >= 2 and a >= 10}
        rows_ = []
        for p, a in cand.items():
            if any(len(q) == len(p) + 1 and 100 * b >= 50 * a and (q[1:] == p or q[:-1] == p) for q, b in cand.items()):
                continue
            best = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            k = best[1]
            rows_.append((best[0], a, " ".join(p), c[p[:k]], c[p[k:]]))
        rows_.sort(key=lambda t: (-t[0], -t[1], t[2].encode()))
        for rank, (score, a, phrase, l, r) in enumerate(rows_[:top], 1):
            out.append((lang, rank, phrase, a, l, r, n[lang], score))
    return sorted(out)


def test_collocations_equal_brute_force(spark):
    from tickloom.llm import collocations

    rng = random.Random(5)
    vocab = ["New", "york", "city", "the", "of", "a", "big", "apple", "ünï", "x"]
    rows = []
    for i in range(300):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        if i % 4 == 0:
            words[0:0] = ["new", "york", "city"]
        text = " ".join(words)
        text = text.replace(" of ", " of. ") if i % 5 == 0 else text
        rows.append((text if i % 17 else None, ["en", "de", None][i % 3]))
    df = spark.createDataFrame([(i, t, l, "s", None) for i, (t, l) in enumerate(rows)], DOC)
    got = sorted(tuple(r) for r in collocations.collocations(df, top=7).collect())
    assert got == collocations_by_brute_force(rows, top=7)
    full = sorted(tuple(r) for r in collocations.collocations(df).collect())
    assert full == collocations_by_brute_force(rows)
    assert collocations.collocations(df.limit(0)).count() == 0


def test_collocation_scores_are_exact_beyond_64_bits(spark):
    from tickloom.llm.collocations import SCALE, _score

    a, l, r = 3 * 10**12, 4 * 10**12 + 1, 5 * 10**12 + 3
    assert SCALE * a * a > 2**63
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert df.select(_score("a", "l", "r").alias("s")).first()["s"] == SCALE * a * a // (l * r)


def divergence_by_brute_force(rows):
    """Every group against every kept term, directly."""
    from collections import Counter

    groups, docs, occ = set(), Counter(), Counter()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        for t in set(terms):
            docs[lang, t] += 1
        for t in terms:
            occ[lang, source, t] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (l_, t), d in docs.items() if l_ == lang and d >= 10)
        v = len(kept)
        sources = sorted(s for l_, s in groups if l_ == lang)
        p = {}
        for s in sources:
            n = sum(occ[lang, s, t] for t in kept)
            p[s] = {t: 1 + 10**9 * (occ[lang, s, t] + 2) // (n + 2 * v) for t in kept}
        n_lang = sum(occ[lang, s, t] for s in sources for t in kept)
        q = {t: 1 + 10**9 * (sum(occ[lang, s, t] for s in sources) + 2) // (n_lang + 2 * v) for t in kept}
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = sorted(((sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s), key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "pair", o, val, k) for k, (val, o) in enumerate(pairs, 1)]
            terms = [(f(p[s][t], q[t]), t) for t in kept if occ[lang, s, t] > 0 and p[s][t] > q[t]]
            terms.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "term", t, val, k) for k, (val, t) in enumerate(terms[:10], 1)]
    return sorted(out)


def test_divergence_equals_brute_force(spark):
    from tickloom.llm import source_divergence

    rng = random.Random(7)
    vocab = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta", "theta", "iota", "kappa", "x1y", "ALPHA"]
    rows = []
    for i in range(400):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 12))]
        source = ["web", "news", None, "wiki", "books"][rng.randrange(5) if i % 3 else 0]
        lang = ["en", "de", None][i % 3]
        rows.append((" ".join(words) if i % 29 else None, lang, source))
    rows += [("alpha", "fr", "only"), ("", "xx", "a"), ("Beta", "xx", "b")]  # one source; no kept terms
    df = spark.createDataFrame([(i, t, l, s, None) for i, (t, l, s) in enumerate(rows)], DOC)
    got = sorted(tuple(r) for r in source_divergence.divergence(df).collect())
    assert got == divergence_by_brute_force(rows)
    assert {r[2] for r in got} == {"pair", "term"}
    assert source_divergence.divergence(df.limit(0)).count() == 0


def test_partial_counts_flushed_early_add_up_to_the_same(monkeypatch):
    """Bounded memory in the Python workers: counts handed on in small parts sum to the counts of one part."""
    import pandas as pd

    from tickloom.llm import collocations, source_divergence

    texts = pd.DataFrame({"lang": ["en", "en", "de"], "source": ["a", "b", "a"], "text": ["x y z. x y z x y", None, "Ä b Ä b c"]})

    def summed(fn, keys):
        out = pd.concat(list(fn(iter([texts]))))
        return out.groupby(keys).sum(numeric_only=True).sort_index()

    whole = summed(collocations._gram_counts, ["lang", "phrase", "words"]), summed(source_divergence._term_counts, ["lang", "source", "term"])
    monkeypatch.setattr(collocations, "FLUSH", 2)
    monkeypatch.setattr(source_divergence, "FLUSH", 2)
    parts = summed(collocations._gram_counts, ["lang", "phrase", "words"]), summed(source_divergence._term_counts, ["lang", "source", "term"])
    assert whole[0].equals(parts[0]) and whole[1].equals(parts[1])
    assert len(list(collocations._gram_counts(iter([texts])))) > 2


def test_collocations_of_words_beyond_the_numbered_ones(spark):
    from tickloom.llm import collocations

    rng = random.Random(11)
    vocab = [f"w{k}" for k in range(12)] + ["É", "\x1c", "\x00z"]
    rows = [("\t".join(rng.choice(vocab) for _ in range(20)).replace("w3\t", "w3; "), ["en", "de", None][i % 3]) for i in range(200)]
    df = spark.createDataFrame([(i, t, l, "s", None) for i, (t, l) in enumerate(rows)], DOC)
    wanted = collocations.frequent_phrases(df).collect()
    for numbered in (1, 7):
        got = collocations.frequent_phrases(df, numbered=numbered).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, wanted))
    assert sorted(tuple(r) for r in collocations.collocations(df).collect()) == collocations_by_brute_force(rows)


def test_collocations_hand_on_a_row_per_bucket_not_per_phrase(spark):
    import pandas as pd
    import pyarrow as pa

    from tickloom.llm import collocations

    words = [f"w{k}" for k in range(500)]
    known = spark.sparkContext.broadcast(pa.table({"lang": ["en"] * 500, "word": [w.encode() for w in words]}))
    rng = random.Random(2)
    text = " ".join(rng.choice(words) for _ in range(20_000))
    out = pd.concat(list(collocations._gram_blobs(iter([pd.DataFrame({"lang": ["en"], "text": [text.encode()]})]), known, 8)))
    assert len(out) == 8 and out["bucket"].is_unique
    assert sum(collocations._unblob(c).sum() for c in out["counts"]) == 19_999 + 19_998


def test_terms_are_combined_per_worker_not_per_batch():
    import pandas as pd

    from tickloom.llm import source_divergence

    batch = pd.DataFrame({"lang": ["en", "en"], "source": ["a", "b"], "text": ["Ä x y x1y", "é z"]})
    out = list(source_divergence._term_counts(iter([batch] * 5)))
    assert len(out) == 1
    got = sorted(out[0].itertuples(index=False, name=None))
    assert got == [("en", "a", "x", 10, 5), ("en", "a", "y", 10, 5), ("en", "a", "Ä", 5, 5), ("en", "b", "z", 5, 5), ("en", "b", "é", 5, 5)]


def test_windows_of_many_documents_at_once_equal_those_of_one():
    import numpy as np

    rng = np.random.default_rng(1)
    lists = [rng.integers(0, 9, size=k) * 0x1E3779B97F4A7C15 for k in (0, 3, 19, 20, 21, 0, 60, 200, 20, 5)]
    doc, at, found = substring_dedup.anchors(lists)
    positions = [at[doc == k][::2] for k in range(len(lists))]
    windows = substring_dedup.candidate_windows(lists, positions)
    for k, own in enumerate(lists):
        _, p, h = substring_dedup.anchors([own])
        assert (at[doc == k] == p).all() and (found[doc == k] == h).all()
        one = substring_dedup.candidate_windows([own], [positions[k]])
        for a, b in zip(windows[1:], one[1:], strict=True):
            assert a[windows[0] == k].tolist() == b.tolist()
    assert len(windows[1])


def test_texts_are_joined_once_with_their_repeats(spark):
    """Texts were shuffled twice for the last join: once for those that lose words and once for the others."""
    passage = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(1, passage, "en", "s", None), (2, f"x {passage}", "en", "s", None), (3, None, "en", "s", None)], DOC)
    cut = substring_dedup.drop_repeats(df)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and [(r["text"], r["n_words"], r["n_removed"]) for r in cut.orderBy("doc_id").collect()] == [(passage, 30, 0), ("x", 31, 30), ("", 0, 0)]
