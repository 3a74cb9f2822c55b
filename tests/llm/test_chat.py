import itertools
import random
import re

import pytest

from factspark.llm import chat
from factspark.llm.chat import ASSISTANT, BEGIN, INSERT, MERGE, NAME, RELABEL, SYSTEM, USER, best_states, format_chats, op6_chat_format, render, repair, role_code

CODES = {"s": SYSTEM, "u": USER, "a": ASSISTANT, "?": 0}
SCHEMA = "conv_id long, turn int, role string, text string, chunk string, id string"


def legal(text):
    return re.fullmatch(r"(s?(ua)+)?", text) is not None


def slow_cost(text):
    """The least cost over all relabellings, groupings and insertions, by search over what was emitted."""
    best = {("", ""): 0}  # (last role, has anything else than a system turn come) is all that legality needs
    states = {"": 0}
    for c in text:
        after = {}
        for last, cost in states.items():
            for to in "sua":
                named = NAME if c == "?" else RELABEL * (c != to)
                if last == to:
                    after[to] = min(after.get(to, 10**9), cost + named + MERGE)
                for gap in ("", "u", "a", "ua", "au"):
                    emitted = last + gap + to
                    ok = all(x + y in ("su", "ua", "au") for x, y in itertools.pairwise(emitted)) and (last or emitted[0] in "su")
                    if ok:
                        after[to] = min(after.get(to, 10**9), cost + named + INSERT * len(gap))
        states = after
    assert best
    ends = {"": 0, "s": 2 * INSERT, "u": INSERT, "a": 0}
    return min(cost + ends[last] for last, cost in states.items())


def outcome(text, plan):
    roles, cost = "", 0
    for c, (role, merged, between) in zip(text, plan, strict=True):
        cost += NAME if c == "?" else RELABEL * (CODES[c] != role)
        cost += MERGE * merged + INSERT * len(between)
        roles += "" if merged else "".join(" sua"[x] for x in between) + " sua"[role]
    final = plan[-1][0] if plan else BEGIN
    tail = {BEGIN: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}[final]
    return roles + tail, cost + INSERT * len(tail)


@pytest.mark.parametrize("n", range(7))
def test_every_short_sequence(n):
    for letters in itertools.product("sua?", repeat=n):
        text = "".join(letters)
        roles, cost = outcome(text, repair([CODES[c] for c in text]))
        assert legal(roles), (text, roles)
        assert cost == slow_cost(text), (text, roles)
        if legal(text):
            assert cost == 0


def test_rendering():
    assert render(["a", "b"], [(USER, False, ()), (ASSISTANT, False, ())], BEGIN, True) == "<|user|>\na\n<|end|>\n<|assistant|>\nb\n<|end|>\n"
    assert render(["b"], [(ASSISTANT, False, (USER,))], BEGIN, True) == "<|user|>\n\n<|end|>\n<|assistant|>\nb\n<|end|>\n"
    assert render(["x"], [(USER, True, ())], USER, True) == "\n\nx\n<|end|>\n<|assistant|>\n\n<|end|>\n"
    assert [role_code(x) for x in (" Human", "GPT", "system", "tool", None, "")] == [USER, ASSISTANT, SYSTEM, 0, 0, 0]
    assert best_states([]) == [BEGIN]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    turns = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role[0], r.text))
    rows = op6_chat_format(spark, sf).collect()
    assert {r.conv_id for r in rows} == set(turns) and len(rows) == len(turns)
    for r in rows:
        own = sorted(turns[r.conv_id])
        text = "".join(x[1] for x in own)
        roles = "".join(x[0] for x in re.findall(r"(?m)^<\|(system|user|assistant)\|>$", r.text))
        assert legal(roles) and r.cost == slow_cost(text) and r.n_turns == len(own)
        assert all(x[2] in r.text for x in own)


def test_chunks_give_the_same_cost_and_text(spark, monkeypatch):
    rng = random.Random(2)
    rows, want = [], {}
    for conv in range(12):
        letters = "".join(rng.choice("uuaas?") for _ in range(rng.randrange(1, 60)))
        want[conv] = letters
        rows += [(conv, t, {"u": "user", "a": "assistant", "s": "system", "?": "tool"}[c], f"t{t}", None, None) for t, c in enumerate(letters)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    for chunk, fan, most in ((1, 3, 0), (1, 1024, 100_000), (7, 2, 100_000), (1000, 1024, 0)):
        monkeypatch.setattr(chat, "FAN", fan)
        monkeypatch.setattr(chat, "BROADCAST_LONG", most)
        texts, costs = {}, {}
        for r in sorted(format_chats(df, chunk=chunk).collect(), key=lambda r: (r.id, r.chunk)):
            texts[r.id] = texts.get(r.id, "") + r.text
            costs[r.id] = costs.get(r.id, 0) + r.cost
        for conv, letters in want.items():
            assert costs[conv] == slow_cost(letters), (chunk, letters)
            assert legal("".join(x[0] for x in re.findall(r"(?m)^<\|(system|user|assistant)\|>$", texts[conv])))
            assert re.findall(r"t\d+", texts[conv]) == [f"t{t}" for t in range(len(letters))]


def test_edges(spark):
    rows = [(1, 0, "user", None, None, None), (1, None, "system", "s", None, None), (None, 0, None, "x", "c", "i"), (2, 3, "assistant", "é" * 100_000, None, None), (3, 1, "user", "same", None, None), (3, 1, "user", "same", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.id, r.chunk): r for r in format_chats(df).collect()}
    assert set(got) == {(1, 0), (None, 0), (2, 0), (3, 0)}
    assert got[1, 0].text == "<|system|>\ns\n<|end|>\n<|user|>\n\n<|end|>\n<|assistant|>\n\n<|end|>\n"
    assert got[3, 0].cost == MERGE + INSERT and got[2, 0].n_inserted == 1 and got[None, 0].cost == NAME + INSERT
    assert format_chats(df.limit(0)).count() == 0


@pytest.mark.parametrize("number", ["cast(null as int)", "cast(id % 3 as int)", "cast(1 as int)", "cast(id as int)"])
def test_chunks_are_bounded_whatever_the_numbers(spark, number):
    df = spark.range(50_000).selectExpr("cast(null as long) as conv_id", f"{number} as turn", "element_at(array('user', 'assistant', 'tool'), cast(id % 3 + 1 as int)) as role", "concat('t', id) as text")
    got = format_chats(df).select("chunk", "n_turns", "text").collect()
    assert sorted(r.chunk for r in got) == list(range(49)) and max(r.n_turns for r in got) == 1024
    text = "".join(r.text for r in sorted(got))
    found = [int(x) for x in re.findall(r"(?m)^t(\d+)$", text)]
    assert sorted(found) == list(range(50_000))
    if "id %" in number:
        assert [i % 3 for i in found] == sorted(i % 3 for i in found)
    if "id as" in number:
        assert found == list(range(50_000))


def test_equal_turns_all_stay(spark):
    df = spark.range(3000).selectExpr("7L as conv_id", "1 as turn", "'user' as role", "'same' as text")
    got = format_chats(df).collect()
    assert sorted(r.n_turns for r in got) == [952, 1024, 1024] and "".join(r.text for r in sorted(got, key=lambda r: r.chunk)).count("same") == 3000
