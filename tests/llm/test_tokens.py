import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from factspark.llm import tokens
from factspark.llm.tokens import END, BpeCounter, TokenCounter, op2_token_counts, piece_starts, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def mine(texts):
    raw = [t.encode() for t in texts]
    return TokenCounter(PATH).counts(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)).tolist()


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_whole_table_against_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    want = dict(zip(docs, lengths(library, list(docs.values())), strict=True))
    rows = op2_token_counts(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {k: (len(docs[k].encode()), n, n > 1024) for k, n in want.items()}
    assert len(rows) == len(docs)


def test_random_texts_against_the_library(library):
    rng = random.Random(3)
    letters = "ab'stmdrvel 'S\n\t  ré1２½Ⅳ.,!? 　漢字ひ🙂é_-\x1c\x85"
    parts = ["<|endoftext|>", " ", "a", "'re", "'r", " '", "  x", "\n", "''s", "'ll", " \n x", "<|endoftext|"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randrange(0x20, 0x250), rng.randrange(0x300, 0xD7FF), rng.randrange(0xE000, 0x1FFFF)])) for _ in range(30)) for _ in range(2000)]
    texts += ["", "a" * 5000, " " * 3000 + "x", "ab" * 4000, "<|endoftext|>" * 3, "Ã\u0082" * 300]
    assert mine(texts) == lengths(library, texts)


def test_chunks_of_any_size_agree():
    rng = np.random.default_rng(0)
    symbols = rng.integers(0, 15, 3000).astype(np.uint8)
    symbols[-1] = END
    want = piece_starts(symbols, 4096)
    for chunk in (1, 2, 7, 64, 2999):
        assert (piece_starts(symbols, chunk) == want).all()


def test_transducer_against_the_definition_of_bpe():
    rng = random.Random(5)
    for _ in range(30):
        tokens, merges = [bytes([b]) for b in range(256)], []
        alive = [b"a", b"b", b"c"]
        for _ in range(12):
            pair = (rng.choice(alive), rng.choice(alive))
            if pair not in merges and pair[0] + pair[1] not in tokens:
                merges.append(pair)
                alive.append(pair[0] + pair[1])
                tokens.append(pair[0] + pair[1])
        counter, rank = BpeCounter(merges, tokens), {p: i for i, p in enumerate(merges)}
        for _ in range(60):
            parts = [bytes([rng.choice(b"abc")]) for _ in range(rng.randrange(1, 25))]
            piece = b"".join(parts)
            while True:
                best = min((rank.get(p, 99) for p in zip(parts, parts[1:], strict=False)), default=99)
                if best == 99:
                    break
                i = next(i for i, p in enumerate(zip(parts, parts[1:], strict=False)) if rank.get(p, 99) == best)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert counter.count(piece) == len(parts)


def test_dropping_compiled_transitions_changes_nothing(library):
    counter = TokenCounter(PATH)
    counter._bpe.MOST_EDGES = counter._bpe.MOST_PIECES = 5
    texts = ["several words of a text", "and another one", "1234 !!"]
    raw = [t.encode() for t in texts]
    assert counter.counts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw])).tolist() == lengths(library, texts)


def test_edges(spark, library):
    texts = [None, "", " ", "word " * 100_000, "a<|endoftext|>b", "same", "same"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "same", 2)], "doc_id long, text string, n_tokens int")
    rows = token_counts(df, PATH).collect()
    assert len(rows) == len(texts) + 1
    want = lengths(library, [t or "" for t in texts])
    assert {r.id: r.n_tokens for r in rows if r.id is not None} == dict(enumerate(want))
    assert token_counts(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_text_that_is_not_utf8(spark, library):
    df = spark.sql("select 1L as doc_id, cast(X'61ff62' as string) as text union all select 2L, 'ab'")
    got = {r.id: r.n_tokens for r in token_counts(df, PATH).collect()}
    assert got == {1: len(library.encode("a�b", add_special_tokens=False).ids), 2: 1}


def test_different_pieces_even_if_hashes_meet(monkeypatch):
    rng = np.random.default_rng(4)
    pieces = [bytes(rng.integers(97, 100, rng.integers(1, 5)).astype(np.uint8)) for _ in range(3000)] + [b"a" * 5000]
    data = np.frombuffer(b"".join(pieces), np.uint8)
    stops = np.cumsum([len(p) for p in pieces])
    begin = stops - [len(p) for p in pieces]
    check = lambda: [pieces[tokens.different(data, begin, stops)[0][k]] for k in tokens.different(data, begin, stops)[1]]
    assert check() == pieces and len(tokens.different(data, begin, stops)[0]) == len(set(pieces))
    monkeypatch.setattr(tokens.np, "unique", lambda h, **k: (h[:1], np.array([0]), np.zeros(len(h), np.int64)))
    assert check() == pieces


def test_long_pieces_are_composed_of_chunks():
    bpe = TokenCounter(PATH)._bpe
    for text in ("a" * 5000, "ab" * 4000, "-=" * 3000, "x" + "é" * 2000, "漢字" * 1500, " " * 4000 + "x"):
        raw = text.encode()
        assert bpe.count(raw) == bpe._walk(0, raw)[1]
