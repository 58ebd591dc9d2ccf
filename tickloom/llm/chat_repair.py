"""Chat formatting by minimum-cost role repair.

A conversation is legal if an optional system turn comes first and user and assistant turns alternate from a user turn
on. Dynamic programming over this automaton chooses, for every turn, to keep it, to give it another role, to merge it
into the turn before, or to insert an empty turn before it, so that the whole sequence is legal at least cost.

Costs of paths add up, so a run of turns is a table of least costs from each state to each state, and tables of
neighbouring runs combine. Long conversations are cut into runs of a fixed number of turns: tables are made per run,
combined per conversation from one row per run, and each run then repeats its own search with its first and last
state known. Among paths of equal cost, the one whose choices come first in the order of ``CHOICES`` wins, whatever
the cuts are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import partitions, stored

# The states of the legal-turn automaton.
STATES = ("start", "system", "user", "assistant")
ROLES = ("system", "user", "assistant")
NEXT = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
# Other spellings of the roles.
ALIASES = {"human": "user", "prompter": "user", "ai": "assistant", "bot": "assistant", "gpt": "assistant", "model": "assistant", "developer": "system"}
CHOICES = ("keep", "merge", "relabel", "insert", "insert+relabel")
COSTS = {"keep": 0, "merge": 2, "relabel": 3, "insert": 4}
# A turn of unknown role takes any role at this cost; one without text may be merged away at this cost.
UNKNOWN_COST, EMPTY_COST = 1, 1
RUN = 1024
TEMPLATE = "<|{role}|>\n{text}\n"
FAR = 1 << 40


def known_role(role: str | None) -> str | None:
    name = (role or "").strip().lower()
    return name if name in ROLES else ALIASES.get(name)


def moves(state: str, role: str | None, empty: bool) -> Iterator[tuple[int, int, str, str, str | None]]:
    """(cost, place of the choice, new state, choice, inserted role) of all ways to take a turn in a state."""
    def as_role(to: str) -> int:
        return 0 if role == to else UNKNOWN_COST if role is None else COSTS["relabel"]

    for to in NEXT[state]:
        same = role == to
        yield as_role(to), 0 if same else 2, to, CHOICES[0 if same else 2], None
    if state != "start":
        yield (EMPTY_COST if empty else COSTS["merge"] + as_role(state)), 1, state, CHOICES[1], None
    for between in NEXT[state]:
        for to in NEXT[between]:
            if between != "system":
                same = role == to
                yield COSTS["insert"] + as_role(to), 3 if same else 4, to, CHOICES[3 if same else 4], between


def _search(turns: Sequence[tuple[str | None, bool]], first: str) -> tuple[dict, list[dict]]:
    """Best (cost, rank) to every state after the turns, and for each turn and state how it was reached.

    The rank orders the best paths to different states by their choices, so ties can be settled later.
    """
    best, trace = {first: (0, 0)}, []
    for role, empty in turns:
        new: dict[str, tuple] = {}
        for state, (cost, rank) in best.items():
            for more, place, to, choice, inserted in moves(state, role, empty):
                key = (cost + more, rank, place, STATES.index(to), STATES.index(inserted) if inserted else -1)
                if to not in new or key < new[to][0]:
                    new[to] = (key, state, choice, inserted)
        # Paths are ordered by their choices, not by cost.
        order = {k: i for i, k in enumerate(sorted({v[0][1:] for v in new.values()}))}
        best = {to: (v[0][0], order[v[0][1:]]) for to, v in new.items()}
        trace.append({to: v[1:] for to, v in new.items()})
    return best, trace


def table_of(turns: Sequence[tuple[str | None, bool]]) -> list[int]:
    """Least cost and rank from each state to each state, row by row; unreachable is FAR."""
    out = []
    for first in STATES:
        best, _ = _search(turns, first)
        for last in STATES:
            out += best.get(last, (FAR, FAR))
    return out


def choose_states(tables: Sequence[Sequence[int]]) -> list[tuple[str, str]]:
    """First and last state of each run on the best path of the whole conversation."""
    n = len(STATES)
    togo = [[0] * n]
    for table in reversed(tables):
        togo.append([min(table[2 * (s * n + e)] + togo[-1][e] for e in range(n)) for s in range(n)])
    togo.reverse()
    out, s = [], 0
    for table, after in zip(tables, togo[1:], strict=True):
        e = min(range(n), key=lambda x: (table[2 * (s * n + x)] + after[x], table[2 * (s * n + x) + 1]))
        out.append((STATES[s], STATES[e]))
        s = e
    return out


def choices_of(turns: Sequence[tuple[str | None, bool]], first: str, last: str) -> list[tuple[str, str, str | None]]:
    """(choice, role, inserted role) of every turn on the best path between two states."""
    _, trace = _search(turns, first)
    out, state = [], last
    for step in reversed(trace):
        before, choice, inserted = step[state]
        out.append((choice, state, inserted))
        state = before
    return out[::-1]


def _turns(rows: pd.DataFrame) -> list[tuple[str | None, bool]]:
    return list(zip(rows["role"].map(known_role), rows["empty"], strict=True))


def _per_run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole runs from frames that are sorted by run; a run may span frames."""
    held = None
    for frame in frames:
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        if not len(frame):
            continue
        same = (frame["conv"] == frame["conv"].iloc[-1]) & (frame["run"] == frame["run"].iloc[-1])
        same = same[::-1].cummin()[::-1]
        held = frame[same]
        if not same.all():
            yield frame[~same]
    if held is not None:
        yield held


def _runs_in(frame: pd.DataFrame) -> Iterator[tuple[tuple, pd.DataFrame]]:
    keys = list(zip(frame["conv"], frame["run"], strict=True))
    at = 0
    for key, group in groupby(keys):
        n = sum(1 for _ in group)
        yield key, frame.iloc[at:at + n]
        at += n


def repaired_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn of the input: conv_id, turn, role, choice, new_role, inserted, place and rendered.

    ``choice`` is what happens to the turn, ``new_role`` the role it ends up with, ``inserted`` the role of an empty
    turn put before it (else null), ``place`` its number in the input's order. The renderings of a conversation,
    joined by place, are the repaired text; a merged turn's piece follows the text it is merged into.

    Turns are ordered by turn (nulls first), then role and text, so ties and repeated rows have a fixed order and each
    counts as a turn. Null texts count as empty; roles are compared without case and by common aliases; null and other
    unknown roles may take any role. Turns with a null conversation id form one conversation. An empty table gives an
    empty result; only the four columns are read.

    A conversation of any length is numbered by ranges and searched in runs of ``RUN`` turns; one row per run meets in
    the combination.
    """
    spark = conversations.sparkSession
    names = {"conv": conv_col, "turn": turn_col, "role": role_col, "text": text_col}
    rows = conversations.select(*[F.col(f"`{old}`").alias(new) for new, old in names.items()])
    order = ["conv", "turn", "role", "text"]
    ranged = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(partitions(spark), *order, "tie")
    ranged = stored(ranged.withColumn("range", F.spark_partition_id()), "turns")
    inside = Window.partitionBy("range", "conv").orderBy("turn", "role", "text", "tie")
    # A conversation's rows in earlier ranges: one row per range and conversation.
    counts = ranged.groupBy("conv", "range").agg(F.count("*").alias("n"))
    crossing = counts.groupBy("conv").agg(F.count("*").alias("ranges"), F.sort_array(F.collect_list(F.struct("range", "n"))).alias("all")).where("ranges > 1")
    before = crossing.select(F.col("conv").alias("_conv"), F.explode(F.transform("all", lambda a: F.struct(
        a["range"].alias("range"),
        F.aggregate(F.col("all"), F.lit(0).cast("long"), lambda acc, b: acc + F.when(b["range"] < a["range"], b["n"]).otherwise(0)).alias("start"),
    ))).alias("b")).select("_conv", F.col("b.range").alias("_range"), "b.start")
    numbered = ranged.withColumn("at", F.row_number().over(inside) - 1)
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("range") == F.col("_range"))
    numbered = numbered.join(before, same, "left").withColumn("place", F.coalesce("start", F.lit(0).cast("long")) + F.col("at"))
    numbered = numbered.withColumns({"run": F.floor(F.col("place") / RUN), "conv_name": F.coalesce(F.col("conv").cast("string"), F.lit(""))})
    numbered = numbered.withColumn("text", F.coalesce("text", F.lit("")))
    numbered = stored(numbered.select("conv", "conv_name", "turn", "role", "text", "place", "run"), "numbered")

    # Texts stay behind: the search needs roles only.
    slim = numbered.select(F.when(F.col("conv").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), "conv_name")).alias("conv"), "place", "run", "role", (F.length(F.trim("text")) == 0).alias("empty"))
    dealt = slim.repartition(partitions(spark), "conv", "run").sortWithinPartitions("conv", "run", "place")

    def tables(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _per_run(frames):
            yield pd.DataFrame([(*key, table_of(_turns(run))) for key, run in _runs_in(frame)], columns=["conv", "run", "table"])

    runs = stored(dealt.mapInPandas(tables, "conv string, run long, table array<long>"), "runs")
    path = F.pandas_udf(lambda column: column.map(lambda t: choose_states([list(x) for x in t])), "array<struct<first:string,last:string>>")
    joined = runs.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("run", "table"))).alias("runs"))
    states = joined.select("conv", F.posexplode(path("runs.table")).alias("run", "s")).select("conv", F.col("run").cast("long"), "s.first", "s.last")
    with_states = slim.join(stored(states, "states"), ["conv", "run"])
    dealt = with_states.repartition(partitions(spark), "conv", "run").sortWithinPartitions("conv", "run", "place")

    def paths(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _per_run(frames):
            out = []
            for (conv, _), run in _runs_in(frame):
                found = choices_of(_turns(run), run["first"].iloc[0], run["last"].iloc[0])
                out += [(conv, place, *c) for place, c in zip(run["place"], found, strict=True)]
            yield pd.DataFrame(out, columns=["conv", "place", "choice", "new_role", "inserted"])

    chosen = stored(dealt.mapInPandas(paths, "conv string, place long, choice string, new_role string, inserted string"), "paths")
    name = F.when(F.col("conv").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), "conv_name"))
    whole = numbered.withColumn("_key", name).join(chosen.withColumnRenamed("conv", "_key"), ["_key", "place"])
    return whole.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "choice", "new_role", "inserted", "place", rendered().alias("rendered")
    )


def rendered(template: str = TEMPLATE) -> Column:
    """A turn's piece of the repaired text: an empty turn if one is inserted, then the turn, or only the merged text."""
    head, tail = template.split("{text}")
    opened = lambda role: F.concat(*[F.lit(p) if k % 2 == 0 else role for k, p in enumerate(x for part in [head.split("{role}")] for x in (part[0], "", part[1]))])
    empty = F.when(F.col("inserted").isNull(), F.lit("")).otherwise(F.concat(opened(F.col("inserted")), F.lit(tail)))
    return F.when(F.col("choice") == "merge", F.concat("text", F.lit(tail))).otherwise(F.concat(empty, opened(F.col("new_role")), "text", F.lit(tail)))


def brute_force(roles: Sequence[str | None], empty: Sequence[bool]) -> int:
    """For tests: least cost over all sequences of choices of a short conversation."""
    def cost(at: int, state: str) -> int:
        if at == len(roles):
            return 0
        return min(more + cost(at + 1, to) for more, _, to, _, _ in moves(state, known_role(roles[at]), empty[at]))

    return cost(0, "start")
