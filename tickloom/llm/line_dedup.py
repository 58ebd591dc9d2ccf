"""Line dedup by a tree of line templates; DataFrame functions only.

A line walks a tree of fixed depth: its number of tokens, then its leading tokens, then the rest with variable fields
generalised. Numbers are always variable. From six tokens on, any one token behind the leading ones may be a variable
field too, so such a line also stands under one template per position with that token left open. A template that
recurs across documents is boilerplate, and every line under it is dropped.

Long lines have as many open templates as tokens, nearly all of them met once. All lines under an open template share
the half of their tokens that the open field is not in, so only lines whose half is shared by enough documents, and by
different lines, get their open templates made. No template that recurs is missed.

Copies of a whole document, edited or not, repeat its lines without any of them being boilerplate. So a template
recurs if enough documents have it and enough of these are mutually dissimilar: of the other lines of any two, less
than half are common to both. However many copies a document has, they weigh one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, stored
from tickloom.plans.sizing import lookup_side

LEADING = 2
MIN_DOCS = 5
MIN_FAMILIES = 4
# Other lines of a document that are compared, those with the smallest hashes; exact if two have no more together.
SKETCH = 64
# An open field is looked for in lines of FIELD_FROM tokens or more: below, too little is left. Lines of more than
# FIELD_TO get their open templates only after one of their halves is found to recur.
FIELD_FROM, FIELD_TO = 6, 16


def tokens_of(line: Column) -> Column:
    """Tokens between white space, with every run of digits as one 0."""
    flat = F.trim(F.regexp_replace(line, r"[\s ]+", " "))
    return F.split(F.regexp_replace(flat, "[0-9]+", "0"), " ")


def template_keys(line: Column, halves: bool = False) -> Column:
    """Hashes of the templates the line stands under, the closed one first; open ones up to FIELD_TO tokens.

    A line that ends at the leading tokens has no template: a word or two recur by chance. With ``halves``, a struct of
    ``keys`` and the ``halves`` of ``half_keys``, from the same tokens.
    """
    tokens = tokens_of(line)

    none = F.array().cast("array<bigint>")

    def keys(t: Column) -> Column:
        size = F.size(t)
        closed = F.xxhash64(size, F.slice(t, 1, LEADING), t)
        at = F.when((size >= FIELD_FROM) & (size <= FIELD_TO), F.sequence(F.lit(LEADING + 1), size)).otherwise(none.cast("array<int>"))
        opened = F.transform(at, lambda k: F.xxhash64(size, F.slice(t, 1, LEADING), F.transform(t, lambda x, i: F.when(i + 1 == k, "<*>").otherwise(x)), k))
        return F.when(size > LEADING, F.concat(F.array(closed), opened)).otherwise(none)

    # A one-element array binds the tokens to a variable, so they are made once.
    if halves:
        return F.get(F.transform(F.array(tokens), lambda t: F.struct(keys(t).alias("keys"), half_keys(t).alias("halves"))), F.lit(0))
    return F.flatten(F.transform(F.array(tokens), keys))


def half_keys(t: Column) -> Column:
    """Of the tokens of a line of more than FIELD_TO: the closed key, and hashes of its front half and of the rest."""
    size = F.size(t)
    half, leading = F.floor(size / 2).cast("int"), F.slice(t, 1, LEADING)
    front = F.xxhash64(size, F.lit("front"), F.slice(t, 1, half))
    back = F.xxhash64(size, F.lit("back"), leading, F.slice(t, half + 1, size))
    long = size >= F.lit(max(FIELD_FROM, FIELD_TO + 1))
    return F.when(long, F.array(F.xxhash64(size, leading, t), front, back)).otherwise(F.array().cast("array<bigint>"))


def open_keys(line: Column) -> Column:
    """The closed key of a long line and a hash per position with that token left open, in time linear in its tokens."""
    def keys(t: Column) -> Column:
        size = F.size(t)
        closed = F.xxhash64(size, F.slice(t, 1, LEADING), t)
        hashes = F.transform(t, lambda x, i: F.xxhash64(x, i))

        def opened(each: Column) -> Column:
            whole = F.aggregate(each, F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(h))
            places = F.sequence(F.lit(LEADING), size - 1)
            return F.flatten(F.transform(F.array(whole), lambda w: F.transform(places, lambda i: F.xxhash64(size, i, w.bitwiseXOR(F.get(each, i))))))

        return F.concat(F.array(closed), F.flatten(F.transform(F.array(hashes), opened)))

    return F.flatten(F.transform(F.array(tokens_of(line)), keys))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def candidate_templates(lines: DataFrame, min_docs: int = MIN_DOCS, keys: str = "keys", closed: bool = True) -> DataFrame:
    """(key) of what enough documents have, from one row per document with ``keys``: an array of key arrays, one per line.

    An open template under which all lines are the same says no more than their closed one and is left out; without
    ``closed``, so are the closed ones. A document counts once for each of its templates. Counts are combined before the
    shuffle, so a template with a third of all lines is a row per task.
    """
    pairs = F.flatten(F.transform(keys, lambda k: F.transform(k, lambda x: F.struct(x.alias("key"), F.get(k, F.lit(0)).alias("own")))))

    def marked(found: Column) -> Column:
        first = lambda p, i: (i == 0) | (F.get(found, i - 1)["key"] != p["key"])
        return F.transform(found, lambda p, i: F.struct(p["key"].alias("key"), p["own"].alias("own"), first(p, i).alias("first")))

    # Pairs met twice are not first, so they need no distinct, which is quadratic on structs.
    each = lines.select(F.inline(F.flatten(F.transform(F.array(F.sort_array(pairs)), marked))))
    found = each.groupBy("key").agg(F.count_if("first").alias("n"), F.min("own").alias("low"), F.max("own").alias("high"))
    kept = F.col("low") < F.col("high")
    return found.where((F.col("n") >= min_docs) & (kept | (F.col("high") == F.col("key")) if closed else kept)).select("key")


def opened_lines(docs: DataFrame, lines: DataFrame, text: Column, min_docs: int) -> DataFrame:
    """One row per document with long lines of which a half recurs: k1, k2, lines, pos, and ``keys`` of these lines."""
    halves = stored(candidate_templates(lines, min_docs, "halves", closed=False), "halves")
    marks = lines.select("k1", "k2", F.posexplode("halves").alias("pos", "half")).select("k1", "k2", "pos", F.explode("half").alias("key"))
    wanted = marks.join(lookup_side(halves), "key", "left_semi").groupBy("k1", "k2").agg(F.collect_set("pos").alias("pos"))
    wanted = stored(wanted, "wanted")
    texts = docs.select(F.xxhash64(text, F.lit(1)).alias("k1"), F.xxhash64(text, F.lit(2)).alias("k2"), text.alias("text")).where("text is not null")
    found = texts.join(lookup_side(wanted), ["k1", "k2"])
    each = found.select("k1", "k2", "pos", lines_of(F.col("text")).alias("split"))
    closed = F.array_distinct(F.flatten(F.transform("split", lambda x: F.slice(template_keys(x), 1, 1))))
    keys = F.transform("pos", lambda p: open_keys(F.get("split", p)))
    return stored(each.select("k1", "k2", F.slice(F.sort_array(closed), 1, SKETCH + 1).alias("lines"), "pos", keys.alias("keys")), "opened")


def closed_keys() -> Column:
    """The document's distinct closed keys in order, from ``keys``."""
    return F.sort_array(F.array_distinct(F.flatten(F.transform("keys", lambda k: F.slice(k, 1, 1)))))


def dissimilar(a: Column, b: Column) -> Column:
    """Whether less than half of the lines of both are common, by the smallest of their union if that is large."""
    common, sizes = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    by_least = 2 * F.size(F.array_intersect(F.array_intersect(a, b), least)) < SKETCH
    return (common == 0) | F.when(sizes - common <= SKETCH, 3 * common < sizes).otherwise(by_least)


def recurring_templates(hits: DataFrame, min_families: int = MIN_FAMILIES) -> DataFrame:
    """(key) of the candidates that ``min_families`` mutually dissimilar documents have, from (key, others): a document's other lines.

    Each round takes, per template, the commonest of the documents that are dissimilar to all those taken before. Partial
    maxima are combined before the shuffle, so a template in a third of all documents is a row per task.
    """
    others = hits.where(F.size("others") > 0).groupBy("key", "others").agg(F.count("*").alias("n"))
    others = stored(others, "others")
    best = F.max(F.struct("n", "others"))["others"].alias("head")
    heads = others.groupBy("key").agg(best).select("key", F.array("head").alias("heads"))
    for k in range(1, min_families):
        left = others.join(lookup_side(stored(heads, "heads")), "key").where(F.forall("heads", lambda h: dissimilar(h, F.col("others"))))
        if k == min_families - 1:
            heads = left.select("key").distinct()
            break
        # The heads of a template are the same in all of its rows.
        found = left.groupBy("key").agg(best, F.max("heads").alias("heads"))
        heads = found.select("key", F.array_append("heads", F.col("head")).alias("heads"))
    return stored(heads.select("key"), "templates")


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_families: int = MIN_FAMILIES, text_col: str = "text") -> DataFrame:
    """``docs`` without the lines of recurring templates; same columns, same number of rows.

    One pass over the texts writes the hashes of their lines; from these, templates are counted, the lines of those that
    may recur are marked, and their documents compared. Only hashes are shuffled to find the lines; the texts meet their
    line numbers by a hash of 128 bits.

    Null texts stay null; blank lines and lines of one or two tokens are never dropped; a text that loses all lines becomes empty; lines of one
    document count once per template, so repetition inside a document alone drops nothing; repeated rows are documents
    of one family; very long lines are one hash; an empty table gives an empty result; other columns, whatever their
    names, pass through.
    """
    text = F.col(f"`{text_col}`")
    lines = stored(docs.where(text.isNotNull()).select(
        F.xxhash64(text, F.lit(1)).alias("k1"), F.xxhash64(text, F.lit(2)).alias("k2"),
        F.transform(lines_of(text), lambda line: template_keys(line, halves=True)).alias("each"),
    ), "lines").select("k1", "k2", "each.keys", "each.halves")

    def hits_of(each: DataFrame, candidates: DataFrame) -> DataFrame:
        marks = each.select("k1", "k2", "lines", "pos", F.get("keys", F.lit(0)).alias("own"), F.explode("keys").alias("key"))
        hits = marks.join(lookup_side(candidates), "key", "left_semi")
        return hits.select("k1", "k2", "pos", "key", F.slice(F.array_remove("lines", F.col("own")), 1, SKETCH).alias("others"))

    # One more than is compared, for the line itself.
    marks = lines.select("k1", "k2", F.slice(closed_keys(), 1, SKETCH + 1).alias("lines"), F.posexplode("keys").alias("pos", "keys"))
    hits = hits_of(marks, stored(candidate_templates(lines, min_docs), "candidates"))
    opened = opened_lines(docs, lines, text, min_docs)
    long = opened.select("k1", "k2", "lines", F.inline(F.arrays_zip("pos", "keys")))
    hits = stored(hits.union(hits_of(long, stored(candidate_templates(opened, min_docs, closed=False), "candidates"))), "hits")
    recurring = recurring_templates(hits, min_families)
    hit = hits.join(lookup_side(recurring), "key", "left_semi").select("k1", "k2", "pos").distinct()
    dropped = hit.groupBy("k1", "k2").agg(F.collect_list("pos").alias("pos"))
    dropped = stored(dropped, "dropped")
    k1, k2, pos = (free_name(docs.columns, n) for n in ("_k1", "_k2", "_pos"))
    keyed = docs.withColumn(k1, F.xxhash64(text, F.lit(1))).withColumn(k2, F.xxhash64(text, F.lit(2)))
    side = lookup_side(dropped.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("pos").alias(pos)))
    joined = keyed.join(side, [k1, k2], "left")

    def without(ls: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col(pos))
        return F.array_join(F.transform(kept, lambda i: F.get(ls, i)), "\n")

    new = F.when(F.col(pos).isNull(), text).otherwise(F.get(F.transform(F.array(lines_of(text)), without), F.lit(0)))
    return joined.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
