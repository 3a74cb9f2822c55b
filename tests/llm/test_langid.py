import zlib

import numpy as np

from factspark.llm import langid
from factspark.llm.langid import SLOTS, WIDTH, fit, op4_language_id, predict, presence, train


def block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


def slow_presence(text):
    low = bytes(b | 32 if 65 <= b <= 90 or 97 <= b <= 122 else b if b > 127 else 32 for b in text.encode())
    low = bytes(b | 32 if i and low[i - 1] == 0xC3 and 0x80 <= b <= 0x9F else b for i, b in enumerate(low))
    out, base = np.zeros(WIDTH, bool), 0
    for order, slots in enumerate(SLOTS, 1):
        for i in range(len(low) - order + 1):
            code = int.from_bytes(low[i : i + order], "big")
            out[base + (code if order == 1 else (code * 2654435761 % 2**32) >> (32 - (slots.bit_length() - 1)))] = True
        base += slots
    return out


TEXTS = ["The Cat, sat.", "É à la ÇÃ", "", "x", "ab", "漢字 1234 %%%", "the cat sat"]


def test_presence_against_brute_force():
    got = presence(*block(TEXTS))
    for row, text in zip(got, TEXTS, strict=True):
        assert (row == slow_presence(text)).all(), text


def test_scores_are_kernel_ridge_regression_when_every_text_is_a_landmark():
    texts = ["the cat sat on a mat", "the dog and the hen", "with the other one", "der hund und die katze", "und das haus ist da", "nicht der mann"]
    labels = ["en"] * 3 + ["de"] * 3
    rows = presence(*block(texts)).astype(np.float32)
    sets = [set(np.flatnonzero(r)) for r in rows]
    kernel = np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets] for a in sets])
    target = np.array([[x == y for y in ("de", "en")] for x in labels], float)
    alpha = np.linalg.solve(kernel + 6 * 1e-3 * np.eye(6), target)
    model = fit(np.packbits(rows > 0, axis=1), labels, landmarks=6)
    assert np.allclose(model.scores(rows), kernel @ alpha, atol=1e-3)


def test_held_out_accuracy_and_that_held_out_labels_are_not_used(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op4_language_id(spark, sf).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    altered = spark.createDataFrame([(i, r.text, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else r.lang, "other") for i, r in truth.items()], "doc_id long, text string, lang string, source string")
    altered.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    again = {r.doc_id: (r.lang_pred, r.score) for r in op4_language_id(spark, str(tmp_path)).collect()}
    assert again == {r.doc_id: (r.lang_pred, r.score) for r in rows}


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en", 1.0), (2, "le chat et la souris", "fr", 2.0), (3, None, "fr", None), (4, "", "en", 0.0), (5, "123 %% \n", None, 0.0), (None, "the cat", "en", 0.0), (1, "the cat and the dog", "en", 1.0), (6, "漢字", None, 0.0), (7, "la souris " * 50_000, None, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = train(df)
    assert model.languages == ("en", "fr")
    got = predict(df, model).collect()
    assert len(got) == len(rows)
    by = {r.id: r for r in got}
    assert [by[i].lang_pred for i in (1, 2, 3, 4, 5, 7)] == ["en", "fr", "und", "und", "und", "fr"]
    assert by[3].score == 0 and by[6].lang_pred in ("en", "fr")
    empty = df.limit(0)
    assert predict(df, train(empty)).where("lang_pred <> 'und'").count() == 0
    assert predict(empty, model).count() == 0


def test_the_sample_is_bounded(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "concat('text ', id) as text", "if(id % 3 = 0, 'a', 'b') as lang")
    assert langid.training_ids(df, 50, "doc_id", "lang").groupBy("lang").count().where("count = 50").count() == 2


def test_an_id_that_repeats_counts_once_in_each_language(spark, monkeypatch):
    hot = spark.range(2000).selectExpr("7L as doc_id", "concat('the cat sat ', id) as text", "if(id % 2 = 0, 'en', 'fr') as lang")
    rest = spark.range(100, 140).selectExpr("id as doc_id", "concat('le chat ', id) as text", "'fr' as lang")
    seen = []
    monkeypatch.setattr(langid, "fit", lambda bits, labels, landmarks: seen.append((len(bits), sorted(labels))))
    for df in (hot.unionByName(rest), rest.unionByName(hot.orderBy("text"))):
        train(df, per_language=20)
    assert seen[0] == seen[1] and seen[0][1].count("en") == 1 and seen[0][0] <= 21


def test_every_label_is_a_language_however_many_there_are(spark):
    letters = [a + b for a in "bcdfghjklm" for b in "npqrstvwxz"] + [a + "y" + b for a in "bcdfg" for b in "hjklm"]
    df = spark.createDataFrame([(i, f"{w} {w * 2} {w * 3}", w) for i, w in enumerate(letters)], "doc_id long, text string, lang string")
    model = train(df, most_rows=50)
    assert len(model.languages) == 125 and len(model.landmarks) == 125
    got = predict(df, model).join(df.selectExpr("doc_id as id", "lang"), "id")
    assert got.where("lang = lang_pred").count() == 125


def test_kept_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "the cat", "en", 5.0, "x", "y")], "id long, text string, lang string, Score double, text_of_row string, lang_pred string")
    out = predict(df, train(df, id_col="id"), "id", keep=("id", "text", "Score", "text_of_row", "lang_pred"))
    assert out.columns == ["id", "lang_pred", "score", "text", "text_of_row"]
    assert tuple(out.first())[3:] == ("the cat", "x") and out.first().lang_pred == "en"
