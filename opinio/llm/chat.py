"""Chat formatting by minimum-cost role repair (operator 9).

Legal conversations are an optional system message, then user and assistant in turn, ending with the
assistant. For every message a dynamic programme over the automaton of the last role decides between
keeping or relabelling it, merging it into the message before it, and putting an empty message before it,
so that the whole conversation costs least. The repaired sequence is rendered as one fragment per message;
a conversation is its fragments in the order of ``msg_no``.

Scale. Messages are range-partitioned and sorted by (conversation, turn, role, text, row), so one very long
conversation is spread over many tasks, even when its rows are equal. A task solves each run of messages
of one conversation for every entry and exit state. Only runs at the edge of a batch can go on in another
one: their 4 x 4 cost tables (a few numbers per batch) are joined up per conversation, and the chosen
entry and exit pick the solution that is already there. Texts are shuffled once and never collected.

Defined results. NULL turns, roles and texts sort last; a NULL or unknown role is relabelled, a NULL text is
empty. Messages with a NULL conversation are one conversation. Equal rows are messages of their own. Markers
inside a text are broken up, so they cannot pass for a turn. An empty table gives an empty result. Only
conv_id, turn, role and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.functions.text import utrim
from opinio.llm.common import none_if_missing, stage

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 1, 3, 1, 2
#: Cost of ending after each state: the empty messages that make the end legal.
END = (0, 2 * INSERT, INSERT, 0)
_INF = 1 << 40
#: Runs up to this length are solved once per sequence of roles.
REMEMBERED = 64


def role_number(role) -> int:
    name = role.strip().lower() if isinstance(role, str) else ""
    return ROLES.index(name) + 1 if name in ROLES else 0


def steps(state: int, role: int) -> Iterator[tuple[int, int, int]]:
    """(cost, next state, code) of every way to take a message; code = role + 4 * merged + 8 * inserted role."""
    for out in sorted((SYSTEM, USER, ASSISTANT), key=lambda o: o != role):
        cost = 0 if out == role else RELABEL if role else RELABEL_UNKNOWN
        if out == state:
            yield cost + MERGE, out, out + 4
        if out == SYSTEM:
            if state == START:
                yield cost, out, out
        elif out == USER:
            yield (cost + INSERT, out, out + 8 * ASSISTANT) if state == USER else (cost, out, out)
        else:
            yield (cost, out, out) if state == USER else (cost + INSERT, out, out + 8 * USER)


def solve(roles: tuple[int, ...]) -> tuple[list[int], list[list[int]]]:
    """Least costs [entry * 4 + exit] of a run, and for each message the code under each of the 16 cases."""
    costs, codes = [_INF] * 16, [[0] * 16 for _ in roles]
    for entry in range(4):
        cost = [0 if s == entry else _INF for s in range(4)]
        back = []
        for role in roles:
            new, how = [_INF] * 4, [(0, 0)] * 4
            for state in range(4):
                if cost[state] < _INF:
                    for c, out, code in steps(state, role):
                        if cost[state] + c < new[out]:
                            new[out], how[out] = cost[state] + c, (state, code)
            cost = new
            back.append(how)
        for end in range(4):
            costs[entry * 4 + end] = cost[end]
            if cost[end] < _INF:
                state = end
                for k in range(len(roles) - 1, -1, -1):
                    state, codes[k][entry * 4 + end] = back[k][state]
    return costs, codes


_remembered = lru_cache(maxsize=100_000)(solve)


def best_end(costs: list[int], entry: int = START) -> int:
    return min(range(4), key=lambda s: (costs[entry * 4 + s] + END[s], s))


_RUNS = ("piece long, seq int, length int, edge boolean, conv_id long, turn long, role string, text string, "
         "end int, costs array<long>, codes array<int>")


def _solve_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    piece = TaskContext.get().partitionId() << 36
    for pdf in batches:
        if not len(pdf):
            continue
        conv = pdf["conv_id"].astype("Int64")
        change = (conv != conv.shift()).fillna(True) & ~(conv.isna() & conv.shift().isna())
        change.iloc[0] = True
        starts = [*change.to_numpy().nonzero()[0].tolist(), len(pdf)]
        roles = [role_number(r) for r in pdf["role"]]
        rows = []
        for k, (a, b) in enumerate(zip(starts, starts[1:])):
            run = tuple(roles[a:b])
            costs, codes = _remembered(run) if b - a <= REMEMBERED else solve(run)
            edge, end = k == 0 or b == len(pdf), best_end(costs)
            rows += [(piece, q, b - a, edge, end, costs if edge and q == 0 else None, codes[q]) for q in range(b - a)]
            piece += 1
        solved = pd.DataFrame(rows, columns=["piece", "seq", "length", "edge", "end", "costs", "codes"])
        out = pd.concat([pdf.reset_index(drop=True), solved], axis=1)
        out["conv_id"] = conv.to_numpy()
        out["turn"] = out["turn"].astype("Int64")
        yield out[[c.split()[0] for c in _RUNS.split(", ")]]


def _join_up(pieces: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit of each piece of one conversation (a few rows per batch that holds it)."""
    pieces = pieces.sort_values("piece")
    tables = [list(c) for c in pieces["costs"]]
    cost, back = [0, _INF, _INF, _INF], []
    for table in tables:
        new, how = [_INF] * 4, [0] * 4
        for a in range(4):
            for b in range(4):
                if cost[a] + table[a * 4 + b] < new[b]:
                    new[b], how[b] = cost[a] + table[a * 4 + b], a
        cost = new
        back.append(how)
    state = min(range(4), key=lambda s: (cost[s] + END[s], s))
    ways = []
    for how in reversed(back):
        ways.append((how[state], state))
        state = how[state]
    entry, exits = zip(*reversed(ways))
    before = pieces["length"].cumsum() - pieces["length"]
    return pd.DataFrame({"piece": pieces["piece"], "entry": entry, "exit": exits, "before": before,
                         "final": pieces["piece"] == pieces["piece"].iloc[-1]})


def _opening(role) -> F.Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"))


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, msg_no, turn, role, new_role, action, inserted, fragment: one row per message."""
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "turn", "role", "text")] + [F.col("rid")]
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("rid", F.monotonically_increasing_id())  # spreads equal rows
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("rid")
    solved = stage(sorted_rows.mapInPandas(_solve_runs, _RUNS), "solved-runs")
    edges = solved.where("edge and seq = 0").select("conv_id", "piece", "length", "costs")
    choice = stage(edges.groupBy("conv_id").applyInPandas(
        lambda pdf: _join_up(pdf), "piece long, entry int, exit int, before long, final boolean"), "choices")

    rows = solved.join(choice, "piece", "left")
    entry, end = F.coalesce("entry", F.lit(START)), F.coalesce("exit", "end")
    code = F.element_at("codes", entry * 4 + end + 1)
    rows = (rows.withColumn("code", code).withColumn("state", end)
            .withColumn("msg_no", F.coalesce("before", F.lit(0)) + F.col("seq"))
            .withColumn("last", (F.col("seq") == F.col("length") - 1) & F.coalesce("final", F.lit(True))))
    names = F.array(*map(F.lit, ROLES))
    out, merged = F.element_at(names, F.col("code") % 4), (F.col("code") / 4).cast("int") % 2 == 1
    put = (F.col("code") / 8).cast("int")
    close, none = F.lit("<|im_end|>\n"), F.lit("")
    body = F.replace(F.coalesce("text", F.lit("")), F.lit("<|im_"), F.lit("<| im_"))
    empty = F.when(put > 0, F.concat(_opening(F.element_at(names, F.greatest(put, F.lit(1)))), close)).otherwise(none)
    opened = F.concat(F.when(F.col("msg_no") > 0, close).otherwise(none), empty, _opening(out), body)
    missing = [F.concat(_opening(F.lit(r)), close) for r in ROLES]
    tail = F.concat(close, F.when(F.col("state") == SYSTEM, missing[USER - 1]).otherwise(none),
                    F.when(F.col("state") != ASSISTANT, missing[ASSISTANT - 1]).otherwise(none))
    fragment = F.concat(F.when(merged, F.concat(F.lit("\n"), body)).otherwise(opened),
                        F.when(F.col("last"), tail).otherwise(none))
    kept = F.lower(utrim(F.coalesce("role", F.lit("")))) == out  # as the solver reads roles
    action = F.concat(F.when(kept, F.lit("keep")).otherwise(F.lit("relabel")), F.when(merged, F.lit("+merge")).otherwise(none))
    inserted = (put > 0).cast("int") + F.when(F.col("last") & (F.col("state") != ASSISTANT),
                                              F.when(F.col("state") == SYSTEM, 2).otherwise(1)).otherwise(0)
    return rows.select("conv_id", F.col("msg_no").cast("long").alias("msg_no"), "turn", "role", out.alias("new_role"),
                       action.alias("action"), inserted.cast("int").alias("inserted"), fragment.alias("fragment"))
