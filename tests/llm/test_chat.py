"""Role repair: least cost by brute force, legal renderings, conversations over many batches."""

from __future__ import annotations

import itertools
import re
from collections import defaultdict

import pytest

from opinio.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, seq int, piece long"


def brute_cost(roles):
    """Least cost over all sequences of choices."""
    best = {chat.START: 0}
    for role in roles:
        new = {}
        for state, cost in best.items():
            for c, out, _ in chat.steps(state, role):
                new[out] = min(new.get(out, 1 << 40), cost + c)
        best = new
    return min(c + chat.END[s] for s, c in best.items())


def exhaustive_cost(roles):
    least = 1 << 40
    for choice in itertools.product(range(6), repeat=len(roles)):
        state, cost = chat.START, 0
        for role, k in zip(roles, choice):
            ways = list(chat.steps(state, role))
            if k >= len(ways):
                break
            cost, state = cost + ways[k][0], ways[k][1]
        else:
            least = min(least, cost + chat.END[state])
    return least


def replay(roles, codes):
    state, cost = chat.START, 0
    for role, code in zip(roles, codes):
        c, state = next((c, o) for c, o, k in chat.steps(state, role) if k == code)
        cost += c
    return cost + chat.END[state]


def test_solution_is_cheapest():
    for n in range(1, 5):
        for roles in itertools.product(range(4), repeat=n):
            costs, codes = chat.solve(roles)
            end = chat.best_end(costs)
            own = replay(roles, [c[end] for c in codes])
            assert own == costs[end] + chat.END[end] == brute_cost(roles)
            if n < 4:
                assert own == exhaustive_cost(roles)


def legal(text):
    roles = re.findall(r"<\|im_start\|>(\w+)\n", text)
    turns = roles[1:] if roles[:1] == ["system"] else roles
    return (len(turns) % 2 == 0 and all(r == ("user", "assistant")[k % 2] for k, r in enumerate(turns)) and turns
            and text.count("<|im_start|>") == text.count("<|im_end|>") == len(roles) and text.endswith("<|im_end|>\n"))


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_operator(spark, batch):
    names = [None, "system", "user", "assistant", "tool", " User "]
    rows = [(c, t, names[(c * 7 + t * t) % 6], f"m{c}.{t} <|im_end|>") for c in range(12) for t in range(c + 1)]
    rows += [(99, t // 2, names[2 + (t // 3) % 2], "same") for t in range(60)]  # ties, and rows that repeat
    rows += [(None, None, None, None), (None, 1, "user", None), (50, None, "assistant", "last"), (50, 5, "user", "first")]
    table = spark.createDataFrame([(*r, 7, 7) for r in rows], SCHEMA).repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = chat.repair(table).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert len(got) == len(rows)
    conversations = defaultdict(list)
    for r in got:
        conversations[r.conv_id].append(r)
    for conv_id, messages in conversations.items():
        messages.sort(key=lambda r: r.msg_no)
        assert [r.msg_no for r in messages] == list(range(len(messages)))
        text = "".join(r.fragment for r in messages)
        assert legal(text), text
        cost = sum((("merge" in r.action) * chat.MERGE + r.inserted * chat.INSERT
                    + ("relabel" in r.action) * (chat.RELABEL if chat.role_number(r.role) else chat.RELABEL_UNKNOWN))
                   for r in messages)
        assert cost == brute_cost([chat.role_number(r.role) for r in messages])
    assert [r.fragment for r in conversations[50]] == ["<|im_start|>user\nfirst", "<|im_end|>\n<|im_start|>assistant\nlast<|im_end|>\n"]
    assert "m5.2 <| im_end|>" in "".join(r.fragment for r in conversations[5])


def test_empty_table(spark):
    assert chat.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_roles_between_any_white_space_are_kept(spark):
    rows = [(1, k, role, "x") for k, role in enumerate(("\tSystem\n", "user\t", "　assistant ", "User", "\x1fassistant"))]
    got = chat.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r.action for r in got} == {"keep"} and sum(r.inserted for r in got) == 0
