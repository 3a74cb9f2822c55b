import random
import re

import numpy as np
import pytest

from factspark.llm import decontaminate as module
from factspark.llm.decontaminate import align, contaminated, grams, op8_benchmark_decontamination, words


def split(text):
    out, word = [], ""
    for c in text or "":
        c = c.lower() if c.isascii() or "À" <= c <= "ß" else c
        alone = any(a <= c <= b for a, b in ("\u3040\u9fff", "\u3005\u3007", "\uf900\ufaff", "\u0e00\u0eff", "\u1000\u107f", "\u1780\u17ff", "\U00020000\U00033fff"))
        mark = not (c.isascii() and c.isalnum()) if c.isascii() else any(a <= c <= b for a, b in ("\x80\xa9", "\xab\xb4", "\xb6\xb9", "\xbb\xbf", "\u2000\u207f", "\u3000\u3004", "\u3008\u303f", "\uff00\uff0f", "\uff1a\uff20", "\uff3b\uff3f", "\uff40\uff40", "\uff5b\uff65"))
        if mark or alone:
            out += [word, c if alone else ""]
            word = ""
        else:
            word += c
    return [w for w in [*out, word] if w]


def slow_align(item, window):
    """Smith-Waterman over the whole table."""
    score = [[0] * (len(window) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(window, 1):
            score[i][j] = max(0, score[i - 1][j - 1] + (2 if a == b else -1), score[i - 1][j] - 1, score[i][j - 1] - 1)
            best = max(best, score[i][j])
    return best


def block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


def test_words_and_grams():
    texts = ["The cat, the CAT!", "", "É été éTÉ", "end", "ending", "a b", " ;", "東京は、日本の首都。abc漢字def", "«Où» “quoted”—dash…end", "ภาษาไทย x", "ＡＢ，１２！ｶﾅ", "Ωmega день ª µ", "𠀀𠀁 é漢", "漢", "字"]
    hashes, cuts = words(*block(texts))
    names = [split(t) for t in texts]
    assert np.diff(cuts).tolist() == [len(x) for x in names]
    flat = [w for x in names for w in x]
    assert all((hashes[i] == hashes[j]) == (a == b) for i, a in enumerate(flat) for j, b in enumerate(flat))
    gram, at = grams(hashes, cuts)
    assert at[at < 11].tolist() == [0, 1, 4, 7, 8, 9]


def test_alignment_against_the_whole_table():
    rng = random.Random(0)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 20))] for _ in range(2))
        score, first, last = align(np.array(a, np.uint64), np.array(b, np.uint64))
        assert score == slow_align(a, b)
        assert score == slow_align(a, b[first:last])


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: split(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: split(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = set()
    for i, item in items.items():
        for d, doc in docs.items():
            there = set(doc)
            if sum(w in there for w in item) >= 0.5 * len(item):
                code = {w: k for k, w in enumerate({*item, *doc})}
                score = align(np.array([code[w] for w in item], np.uint64), np.array([code[w] for w in doc], np.uint64))[0]
                if score >= module.least_score(len(item), 0.5) * 2 * len(item):
                    want.add((d, i, round(score / 2 / len(item), 9)))
    rows = op8_benchmark_decontamination(spark, sf).collect()
    assert want and {(r.doc_id, r.item_id, round(r.score, 9)) for r in rows} == want and len(rows) == len(want)


def test_edited_copies_and_a_very_common_item(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)] + ["the", "of", "and"] * 500
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [text(40) for _ in range(20)]
    rows = []
    for d in range(400):
        body = text(120).split()
        if d < 300:  # item 0 is in most documents, edited in each
            copy = items[0].split()
            for _ in range(5):
                copy[rng.randrange(len(copy))] = "changed"
            del copy[rng.randrange(len(copy))]
            body[50:50] = copy
        elif d < 320:
            body[10:10] = items[d - 300].upper().split()
        rows.append((d, " ".join(body)))
    got = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert {(r.id, r.item_id) for r in got} == {(d, 0) for d in range(300)} | {(300 + i, i) for i in range(20)}
    where = {(r.id, r.item_id): (r.first_word, r.last_word, r.score) for r in got}
    assert where[305, 5] == (10, 50, 1.0)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_ITEMS", 2)
    item = "one two three four five six seven eight nine ten"
    rows = [(1, item, 5), (1, item, 5), (2, None, 5), (3, "", 5), (4, "x " * 100_000 + item, None), (None, item, 1), (5, item[:20], 1), (6, "yes, no", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, item, "a"), (8, None, "a"), (9, "", "a"), (10, "!!", "a"), (11, "Yes no", "a"), (7, item, "a"), (None, item, "b")], "item_id long, text string, doc_id string")
    got = sorted(((r.id, r.item_id, r.score) for r in contaminated(docs, items).collect()), key=str)
    want = [(d, i, 1.0) for d in (1, 1, 4, None) for i in (7, 7, None)] + [(6, 11, 1.0)]
    assert got == sorted(want, key=str)
    assert contaminated(docs.limit(0), items).count() == 0 and contaminated(docs, items.limit(0)).count() == 0


def test_short_items_need_more(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "one two three four five six seven eight and more"), (3, "zero one two three four five six seven eight nine x ten")], "doc_id long, text string")
    assert {(r.id, r.score) for r in contaminated(docs, items).collect()} == {(2, 0.8), (3, 0.95)}


def test_spaced_edits_without_the_words_of_an_exact_copy(spark):
    item = [f"w{k}" for k in range(20)]
    edited = [f"x{k}" if k in (2, 6, 10, 14, 18) else w for k, w in enumerate(item)]
    docs = lambda *rows: spark.createDataFrame([(i, " ".join(["before", *r, "after"])) for i, r in enumerate(rows)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = lambda df: {(r.id, r.score) for r in contaminated(df, items).collect()}
    assert found(docs(edited)) == {(0, 0.625)}
    # The grams of the edited copy are the item's commonest.
    assert found(docs(item, edited, item[3:6], item[7:10])) == {(0, 1.0), (1, 0.625)}


def edited(rng, words, how, share):
    out = []
    for k, w in enumerate(words):
        hit = k % 3 == 2 if how == "every third" else rng.random() < share
        kind = "change" if how in ("change", "every third") else how if how != "mixed" else rng.choice(["change", "drop", "add"])
        out += [w] if not hit else {"change": [f"new{rng.randrange(99)}"], "drop": [], "add": [w, f"new{rng.randrange(99)}"]}[kind]
    return out


@pytest.mark.parametrize(("how", "share"), [("change", 0.1), ("change", 0.2), ("change", 0.3), ("drop", 0.3), ("add", 0.3), ("mixed", 0.3), ("every third", None)])
def test_recall_by_edit_rate(spark, how, share):
    """Of the copies whose whole alignment reaches the threshold, those found; no item occurs as it is, and common words are as in a text."""
    rng = random.Random(f"{how}{share}")
    vocabulary = [f"w{i}" for i in range(4000)] + [f"c{i}" for i in range(40)] * 100
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [text(rng.choice([20, 40, 60])) for _ in range(120)]
    docs, want = [], set()
    for i, item in enumerate(items):
        copy = edited(rng, item, how, share)
        docs.append((i, " ".join([*text(60), *copy, *text(60)])))
        code = {w: k for k, w in enumerate({*item, *copy})}
        if align(np.array([code[w] for w in item], np.uint64), np.array([code[w] for w in copy], np.uint64))[0] >= len(item):
            want.add((i, i))
    got = {(r.id, r.item_id) for r in contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")).collect()}
    assert len(want) > 30 and len(got & want) >= 0.97 * len(want), (len(got & want), len(want))
    assert not {x for x in got if x[0] != x[1]}


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "string", "date", "timestamp", "decimal(9,2)", "double", "boolean", "binary", "struct<a:int,b:string>", "array<int>"])
def test_ids_of_any_type(spark, kind):
    make = {"date": "date'2026-01-02'", "timestamp": "timestamp'2026-01-02 03:04:05'", "struct<a:int,b:string>": "named_struct('a', 7, 'b', 'x')", "array<int>": "array(7, 8)", "boolean": "true", "binary": "cast('7' as binary)"}.get(kind, f"cast(7 as {kind})")
    text = " ".join(f"w{i}" for i in range(20))
    one = spark.range(1).selectExpr(f"{make} as doc_id", f"{make} as item_id", f"'{text}' as text")
    out = contaminated(one, one)
    assert {out.schema[c].dataType.simpleString() for c in ("id", "item_id")} == {kind}
    row, want = out.first(), one.first()
    assert row.id == row.item_id == want.doc_id and row.score == 1.0


def test_short_items_and_scripts_without_spaces(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine"), (2, "東京は日本の首都であり、世界有数の大都市である。"), (3, "alpha beta gamma delta")], "item_id int, text string")
    rows = [(1, "and one two three four FIVE six changed eight nine so"), (2, "これは別の文です。東京は日本の首都であり世界有数の大都市だ。次の文。"), (3, "alpha beta gamma epsilon"), (4, "x alpha beta gamma delta"), (5, "one two three four five six seven")]
    got = {(r.id, r.item_id) for r in contaminated(spark.createDataFrame(rows, "doc_id int, text string"), items).collect()}
    assert got == {(1, 1), (2, 2), (4, 3)}


def test_a_common_seed_of_many_items_is_taken_a_part_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(module, "_PAIRS", 50)
    rng = random.Random(9)
    lead = "which of the following is"
    items = [lead + " " + " ".join(f"w{rng.randrange(500)}" for _ in range(15)) for _ in range(60)]
    docs = [(i, f"{lead} {lead} {items[i]} end") for i in range(60)]
    got = contaminated(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(list(enumerate(items)), "item_id int, text string"))
    assert {(r.id, r.item_id) for r in got.where("score = 1").collect()} == {(i, i) for i in range(60)}


def test_the_rarer_half():
    item = np.array([0, 0, 0, 0, 0, 1, 1, 2])
    frequency = np.array([5, 0, 2, 9, 2, 0, 0, 4])
    assert module.rarer_half(np.arange(8), item, frequency).tolist() == [False, False, True, False, True, False, False, True]
