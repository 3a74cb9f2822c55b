import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from factspark.functions import text


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def slow_name(x):
    x = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).lower()
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", re.sub(r"\([^)]*\)", "", x))).strip()


def test_normalize_name(spark):
    rng = random.Random(0)
    known = ["Title (film)", "Amélie", "A:  B, C!", "Andy Weir's novel", "ﬁn ½ Ⅳ ① İstanbul ſ K Å", "ä(x) ⑴y（z）", "東京", "", "áb", "a\x1cb\x85c", "𝐀𝐛", "Ǆ ǅ ŉ", "ःa"]
    letters = [chr(c) for c in range(0x20, 0x3000)] + [chr(c) for c in range(0xF900, 0x10000) if not 0xFDD0 <= c <= 0xFDEF and c < 0xFFFE] + [chr(c) for c in range(0x1D400, 0x1D800)]
    values = known + ["".join(rng.choice(letters) for _ in range(12)) for _ in range(3000)]
    assert column(spark, values, text.normalize_name) == [slow_name(v) for v in values]
    assert column(spark, [None], text.normalize_name) == [None]


@pytest.mark.parametrize(("value", "year", "timed"), [
    ("What is the 2026 film X?", True, True), ("What happened this year?", False, True), ("Who is the current CEO?", False, True), ("the latest edition", False, True),
    ("Who was born in January?", False, True), ("Mayhem Avenue", False, False), ("Who wrote Andy Weir's novel The Martian?", False, False), ("on 0999-01-02", False, True), ("room 12026", False, False), ("é2026", False, False), ("MAY", False, True),
])
def test_temporal(spark, value, year, timed):
    assert column(spark, [value], text.has_year) == [year]
    assert column(spark, [value], text.has_temporal_text) == [timed]


def test_ordinals_and_years(spark):
    assert column(spark, [1, 2, 3, 4, 11, 12, 13, 21, 42, 103, 110, 111], text.ordinal, "int") == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "42nd", "103rd", "110th", "111th"]
    assert column(spark, ["2026 ARCA Menards Series West", "Melodifestivalen 2026", "1999 - 2000", "a, 1850 b"], text.strip_year_tokens) == ["ARCA Menards Series West", "Melodifestivalen", "", "a, b"]


def test_wordings(spark):
    assert column(spark, ["Who is the current CEO", "Who is he married to?", "career goals", "Who wrote the novel X?"], text.targets_mutable_fact) == [True, True, True, False]
    assert column(spark, ["Who directed X and why?", "Who directed X?", "x" * 201, " " * 9 + "x" * 200], text.is_simple_question) == [False, True, False, True]


def test_ids_and_keys(spark):
    p = "http://www.wikidata.org/entity/"
    rows = spark.createDataFrame([("uri", p + "Q5", None), ("uri", "http://x/Q5", None), ("literal", "7", "int"), ("literal", "7", None), ("bnode", p + "Q1", None)], "k string, v string, t string")
    got = rows.select(text.entity_id(F.col("k"), F.col("v")), text.answer_key(F.col("k"), F.col("v"), F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("Q5", "Q5"), (None, "VALUE:literal:http://x/Q5"), (None, "VALUE:int:7"), (None, "VALUE:literal:7"), (None, f"VALUE:literal:{p}Q1")]
    assert column(spark, ["Q12", "Q12a", "q1", "Q", " Q1", "Q1\n"], text.is_id_like) == [True, False, False, False, False, False]


def test_fill_never_fills_twice(spark):
    rows = spark.createDataFrame([("Who made {descriptor}?", "{ordinal} {x}", "9th"), ("{ordinal} of {descriptor}", "A", "1st"), ("{unknown}?", "A", "1st"), ("plain", "A", None)], "t string, d string, o string")
    got = rows.select(text.fill(F.col("t"), {"descriptor": F.col("d"), "ordinal": F.col("o")}).alias("q")).collect()
    assert [r.q for r in got] == ["Who made {ordinal} {x}?", "1st of A", None, "plain"]


def test_json_object_and_styles(spark):
    assert column(spark, ['```json\n{"question": "x"}\n```', "none", "} {"], text.json_object) == ['{"question": "x"}', None, None]
    assert column(spark, ["fact_join", "ordinal_fact", "single_fact", "other"], text.normalize_style) == ["multi_hop_join", "multi_hop_ordinal", "single_fact", "other"]
    assert column(spark, ["fact_join", "single_fact", "multi_hop_aggregate"], text.is_multi_hop) == [True, False, True]
