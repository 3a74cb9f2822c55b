import json

import pytest
from golden import lines
from pyspark.sql import functions as F

from factspark import catalog
from factspark.operators import graph, harvest, report, rewrite, select
from factspark.plans import cli, pipeline, sweep
from factspark.plans.settings import Settings
from factspark.sources import readers, sinks

SETTINGS = Settings("2026", run_date="2026-06-01", date_upper_bound="2026-12-31")


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("graph") / "documents.jsonl"
    path.write_text(lines())
    return str(path)


@pytest.fixture(scope="module")
def tables(spark, documents):
    return {k: v.cache() for k, v in readers.graph(spark, readers.entity_documents(spark, documents)).items()}


@pytest.fixture(scope="module")
def templates(spark):
    return catalog.templates(spark)


@pytest.fixture(scope="module")
def judged(tables, templates):
    chosen = templates.where("domain in ('film_director', 'rail_station_country', 'ordinal_tournament_winner', 'person_first_degree_university', 'film_source_work_author', 'benchmark_release_date', 'wedding_age_gap')")
    chosen = chosen.where("status <> 'blueprint' or domain = 'wedding_age_gap'")
    closure = pipeline.closure_of(tables, chosen)
    candidates = harvest.harvest(tables, closure, chosen, SETTINGS)
    return pipeline.judge(candidates, tables, chosen, SETTINGS).cache(), chosen


def test_reasons(judged):
    rows, _ = judged
    got = {(r.domain, r.subject_qid, r.date_value): r.rejection_reason for r in rows.collect()}
    film = lambda q, day="2026-02-01": ("film_director", q, day)
    competitor = "same_label_competitor_requires_temporal_disambiguation"
    assert got == {
        film("Q101"): None, film("Q103"): "subject_label_contains_year", film("Q104"): "subject_label_contains_temporal_expression", film("Q105"): "no_english_label",
        film("Q106", "2026-11-01"): "future_dated_or_unsettled_fact", film("Q107"): None, film("Q108"): None, film("Q110"): competitor, film("Q112"): "canonical_question_failed_validation",
        film("Q113", "2026-02-03"): None, film("Q113", "2026-02-04"): None, film("Q114", "2026-02-05"): None, film("Q115"): "no_answer_label", film("Q118"): None, film("Q120", "2026-04-01"): None,
        ("benchmark_release_date", "Q401", "2026-03-02"): None,
        ("rail_station_country", "Q403", "2026-01-15"): "canonical_question_failed_validation", ("rail_station_country", "Q404", "2026-01-16"): None,
        ("film_source_work_author", "Q101", "2026-02-01"): None, ("wedding_age_gap", "Q701", "2026-03-03"): "answer_not_time_invariant",
        ("person_first_degree_university", "Q801", "2026-02-02"): None, ("person_first_degree_university", "Q804", "2026-02-02"): None,
        ("ordinal_tournament_winner", "Q910", "2026-01-01"): None, ("ordinal_tournament_winner", "Q911", "2026-02-01"): None,
    }


def test_questions_and_answers(judged):
    rows, _ = judged
    got = {(r.domain, r.subject_qid): (r.canonical_question, r.answer_labels, r.ambiguity_status, r.competitor_qids) for r in rows.where("rejection_reason is null").collect()}
    assert got["film_director", "Q101"][:3] == ("Who directed the odd film Hidden Harbor?", ["Jane Doe"], "label_unique")
    assert got["film_director", "Q107"] == ("Who directed the film Twin?", ["Jane Doe"], "resolved_by_non_temporal_descriptor", ["Q207"])
    assert got["film_director", "Q108"] == ("Who directed the film Same in Paris?", ["Jane Doe"], "resolved_by_non_temporal_descriptor", ["Q109"])
    assert got["film_director", "Q114"][1] == ["Jane Doe"]
    assert got["benchmark_release_date", "Q401"][:2] == ("On what day, month, and year was the benchmark BigBench released?", ["2 March 2026"])
    assert got["film_source_work_author", "Q101"][:2] == ("Who wrote the work that the film Hidden Harbor was based on?", ["Example Author"])
    assert got["person_first_degree_university", "Q801"][:2] == ("From which university did Fay receive a first degree?", ["North College"])
    # two dates take two places; the last edition of three is the fourth
    assert got["ordinal_tournament_winner", "Q910"][:2] == ("Who won the 4th edition of Green Cup?", ["Andy Weir"])
    assert got["ordinal_tournament_winner", "Q911"][:2] == ("Who won the 1st edition of Blue League?", ["Jane Doe"])


def test_records(judged):
    rows, _ = judged
    r = rows.where("domain = 'film_director' and subject_qid = 'Q101'").first()
    assert (r.subject_aliases, r.answer_aliases, r.subject_type_qids, r.hop_count) == (["Harbor"], ["J. Doe"], ["Q24863"], 1)
    assert r.source_metadata.subject_description == "a short film" and r.source_metadata.subject_label_source == "wbgetentities_en"
    assert r.reasoning_path[0].role == "answer" and r.reasoning_path[0].target_qid == "Q501" and r.reasoning_path[0].qualifiers is None
    r = rows.where("domain = 'person_first_degree_university' and subject_qid = 'Q801'").first()
    assert r.reasoning_path[0].qualifiers == {"P512": "Q821", "P582": "2026-02-02"}
    assert [h.target_qid for h in r.reasoning_path] == ["Q811", "Q811"] and r.validation_flags.question_requires_all_hops
    r = rows.where("domain = 'wedding_age_gap'").first()
    assert r.answer_qids == ["VALUE:number:5"] and r.source_metadata.composed_from.birth_dates == ["1990-05-05", "1985-12-31"]
    r = rows.where("domain = 'benchmark_release_date'").first()
    assert r.answer_qids == ["VALUE:date:2026-03-02"] and r.answer_aliases == ["2026-03-02"]


def test_selection_and_sinks(spark, judged, tmp_path):
    rows, chosen = judged
    result = pipeline.finish(rows, SETTINGS)
    accepted = result.accepted.orderBy("id").collect()
    assert [r.id for r in accepted] == [f"wikidata_verified_pilot_{k:06d}" for k in range(1, 7)]
    assert [r.domain for r in accepted] == ["film_director", "rail_station_country", "ordinal_tournament_winner", "person_first_degree_university", "film_source_work_author", "benchmark_release_date"]
    assert len(result.accepted.columns) == 29 and accepted[0].validation_flags.rewrite_failure_reason == "rewrite_disabled"
    # what comes after the accepted one isn't looked at
    assert {(r.domain, r.rejection_reason) for r in result.rejected.collect()} == {("rail_station_country", "canonical_question_failed_validation"), ("wedding_age_gap", "answer_not_time_invariant")}
    pipeline.write(result, SETTINGS, f"{tmp_path}/a", f"{tmp_path}/r")
    first = json.loads(next(x for p in sorted((tmp_path / "a").glob("part-*")) for x in p.read_text().splitlines()))
    assert first["rewritten_question"] is None and first["date_filter"] == {"property": "P577", "value": "2026-02-01"}
    status = select.template_status(chosen, result.candidates)
    assert {r.domain: r.status for r in status.collect()}["wedding_age_gap"] == "rejected_only"
    row = report.summary(result.accepted, result.rejected, chosen, status, "2026").first()
    assert (row.accepted_total, row.missing_domains, row.rejected_only_domains) == (6, ["wedding_age_gap"], ["wedding_age_gap"])
    assert "- Accepted: `6`" in report.run_notes(row, [("x", 1)])


def test_by_person_executors(tables, templates):
    closure = pipeline.closure_of(tables, templates)
    gaps = harvest.wedding_age_gaps_by_person(tables, closure, templates, SETTINGS)
    assert {(r.subject_qid, r.answer_labels[0], r.date_property_pid) for r in gaps.collect()} == {("Q701", "5", "P580"), ("Q702", "5", "P580")}
    one = tables["entities"].where("qid in ('Q801', 'Q803')").select("qid")
    degrees = harvest.first_degrees(tables, closure, catalog.multi_hop_pilot(templates), SETTINGS, one)
    assert [r.subject_qid for r in degrees.collect()] == ["Q801"]
    shown = pipeline.demo(gaps).select("canonical_question", "flags.*").first()
    assert shown.canonical_question.startswith("What was the age gap between the couple in") and shown.provenance_complete
    assert harvest.value_counts(tables, closure, templates, SETTINGS).count() == 0


def test_rewriting(judged):
    class Upper(rewrite.RewriteClient):
        def rewrite_question(self, payload):
            if payload["domain"] == "benchmark_release_date":
                raise TimeoutError
            return {"question": {"film_director": "So who directed the film {}?".format(payload["required_anchors"][-1]), "rail_station_country": "Where in 2026?"}.get(payload["domain"], payload["canonical_question"])}

    rows, _ = judged
    result = pipeline.finish(rows, SETTINGS, Upper)
    got = {r.domain: r for r in result.accepted.collect()}
    assert got["film_director"].question == "So who directed the film Hidden Harbor?" and got["film_director"].validation_flags.llm_rewrite_used
    assert got["rail_station_country"].validation_flags.rewrite_failure_reason == "rewrite_contains_year" and got["rail_station_country"].rewritten_question is None
    assert got["benchmark_release_date"].validation_flags.rewrite_failure_reason == "rewrite_request_failed:TimeoutError"


@pytest.mark.parametrize(("question", "why"), [
    ("", "rewrite_missing_question"), ("Who directed Hidden Harbor in 2026?", "rewrite_contains_year"), ("Who directed the latest Hidden Harbor?", "rewrite_contains_temporal_expression"),
    ("Who directed it?", "rewrite_lost_required_anchor"), ("Did J Doe direct Hidden Harbor?", "rewrite_leaks_answer"), ("Who directed Hidden Harbor and why?", "rewrite_not_simple_question"), ("Who directed Hidden Harbor?", None),
])
def test_rewrite_ladder(judged, question, why):
    rows, _ = judged
    one = rows.where("domain = 'film_director' and subject_qid = 'Q101'").withColumn("new", F.lit(question))
    assert rewrite.failure(one, "new").first().rewrite_failure == why


def test_rewrite_parts(judged):
    rows, _ = judged
    assert rewrite.parse_object('```json\n{"question": "x"}\n```') == {"question": "x"}
    with pytest.raises(ValueError):
        rewrite.parse_object("none")
    with pytest.raises(ValueError):
        rewrite.client_factory(Settings("2026").rewrite or type("C", (), {"provider": "other"})())
    assert rewrite.client_factory(None) is None
    prompt = rows.where("subject_qid = 'Q101'").select(rewrite.prompt()).first()[0]
    assert all(r in prompt for r in rewrite.RULES) and "required_anchors" in prompt and "Hidden Harbor" in prompt


def again(tables, judged, **changes):
    settings = Settings("2026", run_date="2026-06-01", date_upper_bound="2026-12-31", **changes)
    _, chosen = judged
    candidates = harvest.harvest(tables, pipeline.closure_of(tables, chosen), chosen, settings)
    rows = pipeline.judge(candidates, tables, chosen, settings)
    return {(r.domain, r.subject_qid): r for r in rows.collect()}, settings, rows


def test_rules_of_the_design(tables, judged):
    got, _, _ = again(tables, judged, signatures=True)
    assert got["film_director", "Q110"].canonical_question == "Who directed the film Echo, genre: drama?" and got["film_director", "Q110"].disambiguation_signature == ["genre: drama"]
    got, _, _ = again(tables, judged, signatures=True, alias_competitors=True)
    assert got["film_director", "Q101"].rejection_reason is None and got["film_director", "Q101"].competitor_qids == ["Q121"]  # told apart by what it is based on
    got, _, _ = again(tables, judged, alias_competitors=True)
    assert got["film_director", "Q101"].rejection_reason == "same_label_competitor_requires_temporal_disambiguation"
    got, _, _ = again(tables, judged, full_statements=True, finer_reasons=True)
    assert got["film_director", "Q114"].rejection_reason == "answer_not_unique" and got["film_director", "Q107"].rejection_reason is None
    assert got["wedding_age_gap", "Q701"].rejection_reason == "mutable_relationship_or_status" and got["film_director", "Q106"].rejection_reason == "future_dated_or_unsettled_fact"


def test_quotas(tables, judged):
    _, settings, rows = again(tables, judged, quota_by="domain", pilot_total=8)
    result = pipeline.finish(rows, settings)
    got = [r.domain for r in result.accepted.orderBy("id").collect()]
    assert len(got) == 8 and got.count("film_director") == 2 == got.count("ordinal_tournament_winner") and len(set(got)) == 6
    lost = {(r.subject_qid, r.rejection_reason) for r in result.rejected.where("domain = 'film_director'").collect()}
    assert ("Q113", "duplicate_question") in lost and any(why == "quota_exceeded" for _, why in lost)
    with pytest.raises(ValueError):
        Settings("2026", quota_by="subject")


def test_sweep_goes_on_where_the_last_one_stopped(spark, documents, tables, templates, tmp_path, monkeypatch):
    some = templates.where("status = 'active' and domain in ('film_director', 'museum_country', 'rail_station_country')")
    out, calls = str(tmp_path), []
    run = pipeline.run
    monkeypatch.setattr(pipeline, "run", lambda *a: calls.append(sorted({r.domain for r in a[1].collect()})) or run(*a))
    row = sweep.sweep(tables, some.where("domain <> 'rail_station_country'"), SETTINGS, out).first()
    assert (row.accepted_domains, row.no_result_domains, row.problem_counts) == (["film_director"], ["museum_country"], {"outcome:no_result": 1})
    row = sweep.sweep(tables, some, SETTINGS, out).first()
    assert calls == [["film_director", "museum_country"], ["rail_station_country"]] and row.accepted_domains == ["film_director", "rail_station_country"]
    assert {r.domain: r.status for r in sweep.manifest(spark, out).collect()} == {"film_director": "accepted", "museum_country": "no_result", "rail_station_country": "accepted"}
    records = spark.read.json(f"{out}/accepted_all").collect()
    assert [(r.id, r.domain) for r in records] == [("wikidata_verified_pilot_000001", "film_director"), ("wikidata_verified_pilot_000002", "rail_station_country")]
    assert "- `museum_country`" in (tmp_path / "notes.md").read_text() and "outcome:no_result" in (tmp_path / "notes.md").read_text()
    # Another target time has runs of its own.
    other = Settings("2025", run_date="2026-06-01", date_upper_bound="2026-12-31")
    sweep.sweep(tables, some.where("domain = 'museum_country'"), other, out)
    assert calls[-1] == ["museum_country"]


def test_sweep_tries_again_and_then_one_by_one(spark, tables, templates, tmp_path, monkeypatch):
    some = templates.where("domain in ('film_director', 'museum_country')")
    waits, run, broken = [], pipeline.run, [True]

    def breaks(*args):
        if broken[0] and "museum_country" in {r.domain for r in args[1].collect()}:
            raise TimeoutError("timed out")
        return run(*args)

    monkeypatch.setattr(pipeline, "run", breaks)
    row = sweep.sweep(tables, some, SETTINGS, str(tmp_path), wait=waits.append).first()
    assert (row.accepted_domains, row.error_domains, waits) == (["film_director"], ["museum_country"], [3.0] * 4) and row.problem_counts == {"error:TimeoutError": 1}
    broken[0] = False
    row = sweep.sweep(tables, some, SETTINGS, str(tmp_path), wait=waits.append).first()
    assert (row.accepted_domains, row.error_domains, row.no_result_domains, len(waits)) == (["film_director"], [], ["museum_country"], 4)


def test_other_commands(spark, documents, tmp_path):
    assert cli.main(["export", "--output", f"{tmp_path}/c"]) == 0
    assert spark.read.csv(f"{tmp_path}/c/catalog", sep="\t", header=True).count() == 199 and "## Definitions" in (tmp_path / "c" / "review.md").read_text()
    assert cli.main(["demo", "--documents", documents, "--target-time", "2026", "--run-date", "2026-06-01", "--wedding", "Q701", "--degree", "Q801", "--output", f"{tmp_path}/d"]) == 0
    shown = spark.read.json(f"{tmp_path}/d").orderBy("id").collect()
    assert [(r.id, r.domain) for r in shown] == [("composed_demo_000001", "person_first_degree_university"), ("composed_demo_000002", "wedding_age_gap")]
    assert cli.main(["sweep", "--documents", documents, "--target-time", "2026", "--run-date", "2026-06-01", "--domains", "film_director", "--output", f"{tmp_path}/s"]) == 0
    assert spark.read.json(f"{tmp_path}/s/summary").first().accepted_total == 1
    (tmp_path / "p.jsonl").write_text("\n".join(json.dumps({"id": r.id, "prediction": r.answer if k else "I don't know"}) for k, r in enumerate(shown)))
    assert cli.main(["evaluate", "--dataset", f"{tmp_path}/d", "--predictions", f"{tmp_path}/p.jsonl", "--model-name", "m", "--by", "domain", "--output", f"{tmp_path}/e"]) == 0
    got = {r.domain: (r.n, r.accuracy, r.not_attempted_rate, r.attempt_rate, r.model_name) for r in spark.read.json(f"{tmp_path}/e/metrics").collect()}
    assert got == {"person_first_degree_university": (1, 0.0, 1.0, 0.0, "m"), "wedding_age_gap": (1, 1.0, 0.0, 1.0, "m")}
    with pytest.raises(SystemExit):
        cli.main(["demo", "--documents", documents, "--target-time", "2026", "--output", f"{tmp_path}/x"])


def test_command_line(spark, documents, tmp_path):
    assert cli.main(["--documents", documents, "--target-time", "2026", "--run-date", "2026-06-01", "--domains", "film_director", "museum_country", "--output", f"{tmp_path}/o", "--summary-output", f"{tmp_path}/s"]) == 0
    assert spark.read.json(f"{tmp_path}/o").count() == 1
    assert spark.read.json(f"{tmp_path}/s").first().no_result_domains == ["museum_country"]
    with pytest.raises(ValueError):
        cli.main(["--documents", documents, "--target-time", "2026", "--domains", "nothing", "--output", f"{tmp_path}/o"])


def test_stored_tables(spark, tables, tmp_path):
    readers.write_tables(tables, str(tmp_path))
    again = readers.read_tables(spark, str(tmp_path))
    assert again["statements"].count() == tables["statements"].count()
    plan = graph.truthy(again["statements"].where("pid = 'P57'"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pid" in plan


def test_other_readers(spark, tmp_path):
    p = tmp_path / "r.json"
    p.write_text(json.dumps({"results": {"bindings": [{"item": {"type": "uri", "value": "http://www.wikidata.org/entity/Q1"}, "v": {"type": "literal", "value": "7", "datatype": "int"}}, {"item": {"type": "bnode", "value": "b"}}]}}))
    rows = readers.query_results(spark, str(p), ["item", "v"]).collect()
    assert [(r.item_qid, r.v, r.v_datatype) for r in rows] == [("Q1", "7", "int"), (None, None, None)]
    p.write_text("{}")
    with pytest.raises(ValueError):
        readers.query_results(spark, str(p), ["item"])
    assert readers.json_lines(spark, f"{tmp_path}/missing", readers.DOCUMENT).count() == 0
    assert readers.json_document(spark, f"{tmp_path}/missing", readers.DOCUMENT) is None
    sinks.write_manifest(spark, f"{tmp_path}/m.jsonl", [{"resume_version": 1, "domain": "d", "target_time": "2026", "status": "accepted"}])
    assert readers.json_lines(spark, f"{tmp_path}/m.jsonl", sinks.MANIFEST).first().domain == "d"
    answers = spark.createDataFrame([("k", 1, "old", None), ("k", 2, None, "500"), ("j", 1, "only", None)], "cache_key string, fetched_at int, body string, error string")
    assert {r.cache_key: r.body for r in readers.latest_answers(answers).collect()} == {"k": "old", "j": "only"}
