import pytest
from pyspark.sql import functions as F

from factspark import catalog
from factspark.operators import report
from factspark.sources import sinks


@pytest.fixture(scope="module")
def templates(spark):
    return catalog.templates(spark).cache()


def test_totals_and_axes(templates):
    assert tuple(report.catalog_totals(templates).first()) == (199, 24, 9, 20)
    got = {(r.axis, r.value): r.n for r in report.axis_counts(report.catalog_rows(templates), [c for _, _, c in report.AXES]).collect()}
    assert [got["activation_status", s] for s in ("active", "blueprint", "date_answer_pilot", "multi_hop_pilot")] == [12, 181, 3, 3]
    assert (got["evidence_status", "proven_in_runs"], got["evidence_status", "not_yet_proven"]) == (18, 181)
    assert [got["answer_type", x] for x in ("Date", "Entity", "Language", "Number", "Organization", "Other", "Person", "Place", "Work")] == [9, 1, 4, 24, 55, 7, 57, 40, 2]
    assert [got["answer_format", x] for x in ("date", "entity", "number")] == [9, 166, 24]
    assert [got["temporal_mode", x] for x in ("atemporal", "date_answer", "time_related_join")] == [179, 9, 11]
    assert sum(n for (a, _), n in got.items() if a == "topic") == 199 and sum(a == "topic" for a, _ in got) == 19
    assert got["topic", "Arts and Media"] == 21 and got["topic", "Food, Agriculture, and Daily Life"] == 5


def test_selectors(spark, templates):
    n = lambda df: df.count()
    assert (n(catalog.active(templates)), n(catalog.multi_hop_pilot(templates)), n(catalog.date_answer_pilot(templates)), n(catalog.blueprint(templates)), n(catalog.piloted(templates)), n(catalog.unproven(templates))) == (12, 3, 3, 181, 18, 181)
    assert catalog.by_domain(templates, "person_first_degree_university").first().status == "multi_hop_pilot"
    assert catalog.by_domain(templates, "nothing").count() == 0
    assert [r.domain for r in catalog.by_domains(templates, ["museum_country", "film_director"]).collect()] == ["museum_country", "film_director"]
    with pytest.raises(ValueError, match="nothing"):
        catalog.by_domains(templates, ["film_director", "nothing"])
    twice = catalog.concatenated(catalog.active(templates), catalog.active(templates))
    assert [r.tpl_ord for r in twice.orderBy("tpl_ord").select("tpl_ord").collect()] == list(range(24))
    runs = spark.createDataFrame([("film_director", ["x"]), ("wedding_age_gap", ["x"])], "domain string, evidence_runs array<string>")
    got = {r.domain: r.evidence_status for r in catalog.with_evidence(templates, runs).where("domain in ('film_director', 'novel_author', 'wedding_age_gap')").collect()}
    assert got == {"film_director": "proven_in_runs", "novel_author": "not_yet_proven", "wedding_age_gap": "not_yet_proven"}


def test_exports(spark, templates, tmp_path):
    rows = report.catalog_rows(templates)
    sinks.write_tsv(rows, f"{tmp_path}/t", ["tpl_ord"])
    lines = next((tmp_path / "t").glob("part-*")).read_text().splitlines()
    assert lines[0].split("\t") == list(report.EXPORT) and len(lines) == 200
    again = spark.read.csv(f"{tmp_path}/t", sep="\t", header=True)
    assert again.where("domain = 'ordinal_tournament_winner'").first().required_reasoning_clues == "edition"
    page = report.catalog_markdown(templates)
    assert "- Total templates: `199`" in page and "| blueprint | 181 |" in page and page.count("| single_fact |") == 154
    assert rows.where(F.col("exact_instance_only") == "true").count() == 9


def test_a_catalog_of_ones_own(spark):
    own = catalog.templates(spark, "[active]\na | T | Person | f | Q1 | thing | P1 | P2 | maker | Who made {descriptor}? | exact; clues=x,y; hop=2").first()
    assert (own.domain, own.exact_instance_only, own.reasoning_recipe.required_reasoning_clues, own.reasoning_recipe.new_element_hop) == ("a", True, ["x", "y"], 2)
