import pytest
from pyspark.sql import functions as F

from factspark import fixed, schemas
from factspark.operators import ambiguity, evaluate, graph, harvest, report, select, validate
from factspark.plans.settings import Settings
from factspark.streaming import questions

HOPS = [{"source_qid": "Qf", "source_label": "Example Film", "property_pid": "P144", "property_label": "based on", "target_qid": "Qb", "target_label": "Hidden Source Work", "role": "bridge"},
        {"source_qid": "Qb", "source_label": "Hidden Source Work", "property_pid": "P50", "property_label": "author", "target_qid": "Qa", "target_label": "Example Author", "role": "answer"}]
FILM = {
    "tpl_ord": 0, "cand_ord": 1, "subject_qid": "Qf", "subject_label": "Example Film", "subject_aliases": [], "answer_type": "Person", "target_property_pid": "P50", "answer_qids": ["Qa"], "answer_labels": ["Example Author"],
    "answer_aliases": [], "date_value": "2026-02-01", "reasoning_style": "multi_hop_join", "hop_count": 2, "reasoning_path": HOPS, "bridge_entities": [{"qid": "Qb", "label": "Hidden Source Work", "role": "source_work"}],
    "derivation_signature": {"style": "multi_hop_join", "rule": "r"}, "provenance_complete": True, "canonical_question": "Who wrote the work that the film Example Film was based on?",
    "source_metadata": {"required_reasoning_clues": ["based on"], "multi_hop_unique": True},
}
RUN = Settings("2026", run_date="2026-05-05")


def candidate(spark, **changes):
    return spark.createDataFrame([{**FILM, **changes}], schemas.CANDIDATES)


def reason(spark, **changes):
    why, _ = validate.rejection(RUN)
    return candidate(spark, **changes).select(why.alias("r")).first().r


def meta(**changes):
    return {"source_metadata": {**FILM["source_metadata"], **changes}}


@pytest.mark.parametrize(("changes", "why"), [
    ({}, None), ({"subject_label": ""}, "no_english_label"), ({"subject_label": None}, "no_english_label"), ({"answer_labels": []}, "no_answer_label"), ({"subject_label": "Film 2026"}, "subject_label_contains_year"),
    ({"subject_label": "Latest Film"}, "subject_label_contains_temporal_expression"), ({"date_value": "2026-12-01"}, "answer_not_time_invariant"), ({"date_value": "2026-12-01", "target_property_pid": "P57"}, "future_dated_or_unsettled_fact"),
    ({"date_value": "2026-00-00"}, "answer_not_time_invariant"), ({"target_property_pid": "P26"}, "answer_not_time_invariant"), ({"target_property_pid": "P108"}, "answer_not_time_invariant"),
    ({"reasoning_path": [{**HOPS[0], "property_pid": "P26"}, HOPS[1]]}, "answer_not_time_invariant"), ({"answer_qids": ["Qa", "Qc"]}, "answer_not_unique"), (meta(multi_hop_unique=False), "answer_not_unique"),
    ({"provenance_complete": False}, "provenance_incomplete"), ({"hop_count": 3}, "provenance_incomplete"), ({"derivation_signature": None}, "provenance_incomplete"),
    ({"reasoning_path": [HOPS[0], {**HOPS[1], "target_label": "Author of 1999"}]}, "same_label_competitor_requires_temporal_disambiguation"),
    ({"reasoning_path": [{**HOPS[0], "target_label": "Work 1999"}, {**HOPS[1], "source_label": "Work 1999"}]}, None),  # a hidden bridge may name a time
    (meta(required_reasoning_clues=["based on"], multi_hop_unique=True, surface_bridge_entities=True) | {"reasoning_path": [{**HOPS[0], "target_label": "Work 1999"}, HOPS[1]]}, "same_label_competitor_requires_temporal_disambiguation"),
    ({"answer_type": "Date", "reasoning_path": [HOPS[0], {**HOPS[1], "target_label": "22 January 1988"}]}, None),
    ({"reasoning_path": [HOPS[0], {**HOPS[1], "source_qid": "Qx"}]}, "reasoning_path_not_connected"), ({"reasoning_path": [{**HOPS[0], "target_qid": None}, HOPS[1]]}, "reasoning_path_not_connected"),
    ({"reasoning_path": HOPS[:1], "hop_count": 1}, "reasoning_path_not_connected"), ({"reasoning_style": "ordinal_fact"}, "ordinal_derivation_not_safe"),
    ({"reasoning_style": "multi_hop_ordinal", **meta(ordinal_metadata={"series_history_complete": True, "descriptor": "Green Cup"})}, None),
    ({"reasoning_style": "multi_hop_ordinal", **meta(ordinal_metadata={"series_history_complete": True, "descriptor": "Green Cup 1999"})}, "ordinal_derivation_not_safe"),
    ({"reasoning_style": "multi_hop_ordinal", **meta(ordinal_metadata={"series_history_complete": False, "descriptor": "Green Cup"})}, "ordinal_derivation_not_safe"),
])
def test_rejections(spark, changes, why):
    assert why is None or why in fixed.REASONS
    assert reason(spark, **changes) == why


@pytest.mark.parametrize(("changes", "flag", "value"), [
    ({}, "answer_not_leaked", True), ({"canonical_question": "Who wrote the Nature article X?", "answer_labels": ["Nature"]}, "answer_not_leaked", False),
    ({"canonical_question": "Who wrote Andy Weir's novel?", "answer_labels": ["Andy Weir"]}, "answer_not_leaked", False), ({"canonical_question": "Who directed Stitch Head?", "answer_labels": ["Steve Hudson"]}, "answer_not_leaked", True),
    ({"canonical_question": "Who?", "answer_labels": ["...", ""]}, "answer_not_leaked", True), ({"canonical_question": "Who directed it?", "answer_labels": ["Ed"]}, "answer_not_leaked", False),
    ({}, "bridge_not_leaked", True), ({"canonical_question": "Who wrote Hidden Source Work, which Example Film was based on?"}, "bridge_not_leaked", False),
    ({"bridge_entities": [{"qid": "Qb", "label": "Example Film", "role": "x"}]}, "bridge_not_leaked", True), ({}, "question_requires_all_hops", True), ({"canonical_question": "Who wrote Example Film?"}, "shortcut_free", False),
    ({"reasoning_style": "single_fact", "canonical_question": "Who?"}, "question_requires_all_hops", True), ({"canonical_question": "based on 1999?"}, "no_year", False), ({"canonical_question": "based on 1999?", "answer_type": "Date"}, "no_year", True),
    ({"target_property_pid": "P17", "canonical_question": "In which country is Lyon Nord?", **meta(subject_location_labels=["Lyon"])}, "location_context_not_leaked", False),
    ({"target_property_pid": "P131", "canonical_question": "Where is Lyon Nord?", **meta(subject_location_labels=["Lyon"])}, "location_context_not_leaked", True),
])
def test_flags(spark, changes, flag, value):
    row = validate.flag(candidate(spark, **changes)).first()
    assert row.validation_flags[flag] is value
    if not value:
        assert not row.flags_ok


def test_further_phrases(spark):
    extra = Settings("2026", run_date="2026-05-05", extra_phrases=True)
    for label, why in (("Published in Error", "subject_label_contains_temporal_expression"), ("Example Film", None)):
        assert candidate(spark, subject_label=label).select(validate.rejection(extra)[0].alias("r")).first().r == why
        assert reason(spark, subject_label=label) is None


@pytest.mark.parametrize("at_once", [2, 10_000])
def test_texts_that_hold_names(spark, monkeypatch, at_once):
    monkeypatch.setattr(validate, "NAMES_AT_ONCE", at_once)
    texts = ["the red fox ran over the hill", "a bored foxglove ran over it all", "fox", "", "red fox", "ran over", None, "one two three four", "one two xthree four"]
    names = ["red fox", "fox", "red fox ran over", "red foxglove ran over it", "", None, "ed fox ran ov", "two three f", "over", "red fox"]
    a = spark.createDataFrame(list(enumerate(texts)), "doc_id int, norm string")
    b = spark.createDataFrame(list(enumerate(names)), "item_id long, norm string")
    want = {(i, j) for i, t in enumerate(texts) for j, n in enumerate(names) if t and n and n in t}
    got = [tuple(r) for r in validate.texts_that_hold(a, b, "doc_id", "item_id").collect()]
    assert set(got) == want and len(got) == len(want)
    assert validate.texts_that_hold(a, b.limit(0), "doc_id", "item_id").count() == 0
    plan = validate.texts_that_hold(a, b, "doc_id", "item_id")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_numbers_over_ranges(spark):
    df = spark.range(20_000).selectExpr("id * 7919 % 20011 as k", "cast(id % 3 as string) as g").repartition(7)
    got = {r.k: r.id for r in select.numbered(df, "x", ["g", "k"]).collect()}
    order = sorted((r.g, r.k) for r in df.collect())
    assert got == {k: f"x_{n:06d}" for n, (_, k) in enumerate(order, 1)}


def test_the_fold_gets_few_rows_of_each_template(spark):
    df = spark.range(100_000).selectExpr("cast(id % 4 as int) as tpl_ord", "cast(id as int) as cand_ord", "concat('q', id % 1000) as question", "true as ok")
    got = select.greedy(df, 3).where("outcome is not null").select("tpl_ord", "cand_ord", "outcome").collect()
    assert sorted(map(tuple, got)) == [(0, 0, "accepted"), (1, 1, "accepted"), (2, 2, "accepted")]


def test_finer_reasons(spark):
    rows = spark.createDataFrame([("P26",), ("P451",), ("P39",), ("P1082",), ("P50",)], "target_property_pid string")
    assert [r[0] for r in rows.select(validate.finer_reason()).collect()] == ["mutable_relationship_or_status", "mutable_relationship_or_status", "mutable_affiliation_or_office", "cumulative_statistic", None]


@pytest.mark.parametrize(("kind", "labels", "want"), [
    ("artwork", ["mural"], "mural"), ("film", ["creative work", "film"], "film"), ("film", ["anime film"], "anime film"), ("film", ["television series"], "film"), ("album", ["EP"], "EP"),
    ("building", ["a very long kind of building"], "building"), ("railway station", ["station at grade"], "station at grade"), ("film", [], "film"), ("film", ["Film"], "film"),
])
def test_subject_kind(spark, kind, labels, want):
    rows = spark.createDataFrame([(kind, labels)], "k string, l array<string>")
    assert rows.select(harvest.subject_kind(F.col("k"), F.col("l"))).first()[0] == want


def test_select_label(spark):
    rows = spark.createDataFrame([("Film", "Other"), ("Q12", "Other"), ("", "Q12"), (None, None)], "a string, b string")
    assert [tuple(r[0]) for r in rows.select(harvest.select_label(F.col("a"), F.col("b"))).collect()] == [("Film", "wbgetentities_en"), ("Other", "wdqs_label_fallback"), ("", "missing"), ("", "missing")]


def test_competitors_by_alias_and_in_other_scripts(spark):
    names = spark.createDataFrame([("Q1", "Title (film)", "title", False), ("Q2", "Title", "title", False), ("Q3", "The Title", "the title", False), ("Q3", "Title", "title", True), ("Q4", "東京", "", False), ("Q5", "大阪", "", False), ("Q6", "東京", "", False)], schemas.NAMES)
    subjects = spark.createDataFrame([("a", "Q1", ["Title (film)"]), ("b", "Q4", ["東京"])], "row_id string, qid string, names array<string>")
    got = lambda **k: {(r.row_id, r.competitor) for r in ambiguity.competitors(subjects, names, **k).collect()}
    assert got() == {("a", "Q2"), ("b", "Q6")}
    assert got(aliases=True) == {("a", "Q2"), ("a", "Q3"), ("b", "Q6")}
    assert got(aliases=True, most=1) == {("a", "Q2"), ("b", "Q6")}


def test_descriptors_and_signatures(spark):
    statements = spark.createDataFrame([("Q1", "P136", 0, "normal", "item", "G1", None, None, None, None), ("Q1", "P144", 0, "normal", "item", "W1", None, None, None, None), ("Q2", "P136", 0, "normal", "item", "G1", None, None, None, None)], schemas.STATEMENTS)
    entities = spark.createDataFrame([("G1", "drama", "", []), ("W1", "Old Book", "", [])], schemas.ENTITIES)
    facts = ambiguity.descriptors(statements, entities)
    subjects = spark.createDataFrame([("a", "Q1", ["Q2"], []), ("b", "Q1", ["Q2"], ["old book"]), ("c", "Q2", [], [])], "row_id string, qid string, competitors array<string>, forbidden array<string>")
    got = {r.row_id: r.signature for r in ambiguity.smallest_signature(subjects, facts).collect()}
    assert got == {"a": ["source: Old Book"], "b": None, "c": ["genre: drama"]}


def test_greedy_against_a_loop(spark):
    import random

    rng = random.Random(7)
    rows = [(t, c, rng.choice(["x", "y", " z", "z ", f"q{t}{c}"]), rng.random() < 0.5) for t in range(12) for c in range(5)]
    df = spark.createDataFrame(rows, "tpl_ord int, cand_ord int, question string, ok boolean")
    for total in (0, 1, 3, 100):
        want, seen, n = {}, set(), 0
        for t in range(12):
            for _, c, q, ok in [r for r in rows if r[0] == t]:
                if not ok or q.strip() in seen:
                    want[t, c] = ("rejected", ok)
                    continue
                seen.add(q.strip())
                n += 1
                want[t, c] = ("accepted", False)
                break
            if n >= total:
                break
        got = {(r.tpl_ord, r.cand_ord): (r.outcome, r.is_duplicate) for r in select.greedy(df, total).collect() if r.outcome}
        assert got == want, total
    alone = select.greedy(df, 100, separate=True).where("outcome = 'accepted'").count()
    assert alone == len({r[0] for r in rows if r[3]})


def test_dedup_and_quota(spark):
    rows = spark.createDataFrame([(1, "a", "s1"), (2, "a", "s2"), (3, "b", "s1"), (4, "c", "s3")], "i int, q string, s string")
    assert [r.i for r in select.dedup(rows, [["q"], ["s"]], ["i"]).orderBy("i").collect()] == [1, 4]
    n = spark.createDataFrame([("a", 1), ("b", 10), ("c", 10), ("d", 0)], "domain string, n int")
    assert {r.domain: r.quota for r in select.spread_quota(n, 10).collect()} == {"a": 1, "b": 5, "c": 4, "d": 0}


def test_metrics(spark):
    rows = spark.createDataFrame([("CORRECT",)] * 9 + [("INCORRECT",)] * 6 + [("NOT_ATTEMPTED",)] * 5, "grade string")
    m = evaluate.metrics(rows).first()
    assert (m.n, m.attempted, m.accuracy, m.accuracy_given_attempted, round(m.f1, 10)) == (20, 15, 0.45, 0.6, 0.5142857143)
    zero = evaluate.metrics(rows.limit(0)).first()
    assert (zero.n, zero.correct, zero.f1) == (0, 0, 0.0)
    graded = spark.createDataFrame([("The Answer!", "the answer", []), ("unknown", "x", []), ("", "x", []), ("other", "x y", ["Other"]), ("else", "x y", []), ("x y or z", "x y", [])], "p string, a string, l array<string>")
    assert [r[0] for r in graded.select(evaluate.grade(F.col("p"), F.col("a"), F.col("l"))).collect()] == ["CORRECT", "NOT_ATTEMPTED", "NOT_ATTEMPTED", "CORRECT", "INCORRECT", None]


def test_grader_client(spark):
    class Yes(evaluate.GraderClient):
        def grade(self, question, answer, prediction):
            return "CORRECT" if prediction == "p" else "what"

    rows = spark.createDataFrame([(1, "q", "a", "p", None), (2, "q", "a", "r", None), (3, "q", "a", "p", "INCORRECT")], "id int, question string, answer string, prediction string, grade string")
    assert {r.id: r.grade for r in evaluate.grade_rest(rows, Yes).collect()} == {1: "CORRECT", 2: "INCORRECT", 3: "INCORRECT"}


def test_problem_counts(spark):
    events = spark.createDataFrame([("error", "HTTPError", "HTTP 429"), ("error", "Timeout", "timed out"), ("ok", None, None), ("error", None, None)], "status string, error_type string, error_message string")
    statuses = spark.createDataFrame([("no_result",), ("rejected_only",), ("error:X",), ("accepted",)], "status string")
    got = {r.key: r.n for r in report.problem_counts(events, statuses).collect()}
    assert got == {"request_error:HTTPError": 1, "request_error:Timeout": 1, "request_error:unknown": 1, "network_limit:http_429": 1, "network_limit:timeout": 1, "outcome:no_result": 1, "outcome:rejected_only": 1, "error:X": 1}
    log = spark.createDataFrame([("network", "ok", 1), ("network", "error", 2), ("cache_hit", "ok", 1)], "kind string, status string, attempt int")
    counters, parts = report.snapshot(log, per_row=2)
    row = counters.first()
    assert (row.total_requests, row.network_requests, row.cache_hits, row.retries, row.errors) == (3, 2, 1, 1, 1)
    assert [[e.kind for e in r.events] for r in parts.orderBy("part").collect()] == [["cache_hit", "network"], ["network"]]
    counters, parts = report.snapshot(log, by=["kind"])
    assert {r.kind: r.total_requests for r in counters.collect()} == {"network": 2, "cache_hit": 1} == {r.kind: len(r.events) for r in parts.collect()}


def test_closure_with_a_cycle_and_a_limit(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "c"), (None, "a")], "child string, parent string")
    got = {tuple(r) for r in graph.class_closure(edges, spark.createDataFrame([("c",), ("z",)], "root string")).collect()}
    assert got == {("c", "c"), ("b", "c"), ("a", "c"), ("d", "c"), ("z", "z")}
    assert graph.class_closure(edges).where("cls = 'd'").count() == 4
    assert {tuple(r) for r in graph.class_closure(edges.limit(0), edges.select("parent").limit(1)).collect()} == {("b", "b")}
    long = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(6)], "child string, parent string")
    with pytest.raises(ValueError):
        graph.class_closure(long, most_rounds=3)


def test_hops_and_optional_values(spark):
    statements = spark.createDataFrame([("Q1", "P144", 0, "normal", "item", "Q2", None, None, None, None), ("Q2", "P50", 0, "normal", "item", "Q3", None, None, None, None), ("Q1", "P580", 0, "normal", "time", None, "+2026-01-02T00:00:00Z", 11, None, None)], schemas.STATEMENTS)
    rows = spark.createDataFrame([("Q1",), ("Q9",)], "film string")
    both = graph.chain(graph.chain(rows, statements, "film", "P144", "work"), statements, "work", "P50", "author")
    assert [tuple(r) for r in both.collect()] == [("Q1", "Q2", "Q3")]
    assert {tuple(r) for r in graph.optional(rows, statements, "film", "P580", "start").collect()} == {("Q1", "2026-01-02"), ("Q9", None)}


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"question": "x ", "ts": "2026-01-01T00:00:00", "event_type": "a", "value": 1}\n{"question": "x", "ts": "2026-01-01T00:01:00", "event_type": "a", "value": 2}\n{"question": "y", "ts": "2026-01-09T00:00:00", "event_type": "b", "value": 4}\n')
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("question", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    stream = questions.read_json_stream(spark, f"{tmp_path}/in", schema)
    questions.run_once(questions.new_questions(stream), f"{tmp_path}/q", f"{tmp_path}/cq")
    assert {r.question_key for r in spark.read.parquet(f"{tmp_path}/q").collect()} == {"x", "y"} and spark.read.parquet(f"{tmp_path}/q").count() == 2
    questions.run_once(questions.event_counts(stream), f"{tmp_path}/e", f"{tmp_path}/ce")
    assert {(r.key, r.n, r.total) for r in spark.read.parquet(f"{tmp_path}/e").collect()} == {("a", 2, 3.0)}


def test_signatures_of_the_whole_table_against_brute_force(spark):
    from collections import Counter

    from factspark import queries

    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    rows = part.select("p_partkey", "p_brand", F.concat(F.lit("size: "), "p_size"), F.concat(F.lit("type: "), "p_type")).collect()
    one = Counter((b, d) for _, b, *ds in rows for d in ds)
    two = Counter((b, *ds) for _, b, *ds in rows)
    want = {i: min((d for d in ds if one[b, d] == 1), default="; ".join(ds) if two[b, *ds] == 1 else None) for i, b, *ds in rows}
    got = queries.part_signatures(part).collect()
    assert {r.id: r.signature for r in got} == want and len(got) == len(rows)
    assert None in want.values() and any(";" in (s or "") for s in want.values())
    none = spark.createDataFrame([(1, None, 5, "A"), (2, None, 5, "A"), (3, "B", 5, "A"), (4, "B", 5, "A")], "p_partkey long, p_brand string, p_size int, p_type string")
    assert {r.id: r.signature for r in queries.part_signatures(none).collect()} == {1: "size: 5", 2: "size: 5", 3: None, 4: None}
