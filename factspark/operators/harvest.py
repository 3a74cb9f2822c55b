"""Harvest: from templates and a knowledge graph to candidate facts.

All templates of a style are one plan: the templates are rows that are joined
with the statements by property and type, so a catalog of any size is one job.
Candidates of a template are numbered in a total order (date, subject, answer).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factspark import fixed, schemas
from factspark.functions import dates, text
from factspark.operators import graph
from factspark.plans.settings import Settings

TEXTS = "array<string>"
_TEMPLATE = ["tpl_ord", "domain", "topic", "answer_type", "question_family", "subject_type_qid", "subject_type_label", "date_property_pid", "target_property_pid", "target_property_label", "answer_format"]


def record(kind: T.StructType, **values: Column) -> Column:
    """A struct of the given type; fields that aren't given are null."""
    if unknown := set(values) - set(kind.names):
        raise ValueError(f"no such fields: {sorted(unknown)}")
    return F.struct(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields))


def assemble(rows: DataFrame, settings: Settings, **values: Column) -> DataFrame:
    """Candidate records: template columns from the rows, the given ones, and the defaults of the others."""
    empty = F.array().cast(TEXTS)
    values = {
        "subject_aliases": empty, "answer_aliases": empty, "target_time": F.lit(settings.target_time), "canonical_question": F.lit(""), "ambiguity_status": F.lit("unknown"),
        "disambiguation_signature": empty, "competitor_qids": empty, "bridge_entities": F.array(), "hop_count": F.lit(2), "provenance_complete": F.lit(True),
        **{c: F.col(c) for c in ("tpl_ord", "cand_ord", "domain", "topic", "answer_type", "question_family", "target_property_pid", "target_property_label", "date_property_pid")},
        **values,
    }
    return rows.select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.CANDIDATES.fields))


def hop(source: Column, source_label: Column, pid: Column, pid_label: Column, target: Column, target_label: Column, role: str, qualifiers: Column | None = None) -> Column:
    """One step of a reasoning path; empty qualifiers are left out."""
    kept = F.lit(None) if qualifiers is None else F.when(F.size(qualifiers) > 0, qualifiers)
    return record(schemas.HOP, source_qid=source, source_label=source_label, property_pid=pid, property_label=pid_label, target_qid=target, target_label=target_label, role=F.lit(role), qualifiers=kept)


def bridge(qid: Column, label: Column, role: str) -> Column:
    return F.array(record(schemas.BRIDGE, qid=qid, label=label, role=F.lit(role)))


def select_label(hydrated: Column, fallback: Column) -> Column:
    """The label and where it comes from; a text that is an id is no label."""
    usable = lambda x: x.isNotNull() & (x != "") & ~text.is_id_like(x)
    named = lambda label, source: F.struct(label.alias("label"), F.lit(source).alias("source"))
    return F.when(usable(hydrated), named(hydrated, "wbgetentities_en")).when(usable(fallback), named(fallback, "wdqs_label_fallback")).otherwise(named(F.lit(""), "missing"))


def subject_kind(default: Column, type_labels: Column) -> Column:
    """The first type label that says more than the default kind and agrees with it; else the default kind."""
    overrides = F.create_map(*(x for kind, labels in fixed.KIND_OVERRIDES.items() for x in (F.lit(kind), F.array(*map(F.lit, labels)))))
    allowed = F.coalesce(F.try_element_at(overrides, F.lower(default)), F.array().cast(TEXTS))
    own = text.words(F.lower(default))

    def fits(label: Column) -> Column:
        low = F.lower(label)
        generic = low.isin(*fixed.GENERIC_KINDS) | (low == F.lower(default))
        return ~generic & (F.size(text.words(label)) <= 4) & (F.arrays_overlap(text.words(low), own) | F.array_contains(allowed, low))

    return F.coalesce(F.get(F.filter(type_labels, fits), F.lit(0)), default)


def items_of(statements: DataFrame, entities: DataFrame, subjects: DataFrame, pids: list[str]) -> DataFrame:
    """``(subject, pid, qids, labels)``: the items of some properties, all ranks, in the order of the claims; unlabelled ones have no label."""
    rows = statements.where(F.col("pid").isin(*pids) & F.col("value_id").isNotNull()).select("subject", "pid", "stmt_ord", F.col("value_id").alias("qid"))
    rows = rows.join(subjects, "subject", "left_semi").join(entities.select("qid", "label_en"), "qid", "left")
    label = select_label(F.col("label_en"), F.lit(None).cast("string"))["label"]
    groups = rows.groupBy("subject", "pid").agg(F.array_sort(F.collect_list(F.struct(F.col("stmt_ord"), F.col("qid"), label.alias("label")))).alias("x"))
    return groups.select("subject", "pid", F.col("x.qid").alias("qids"), F.filter("x.label", lambda v: v != "").alias("labels"))


def numbered(rows: DataFrame, most: Column | int, order: list[str]) -> DataFrame:
    """The first rows of each template, numbered. Spark cuts each partition down to them before it shuffles."""
    ranked = rows.withColumn("cand_ord", F.row_number().over(Window.partitionBy("tpl_ord").orderBy(*order)))
    return ranked.where(F.col("cand_ord") <= most)


def _within(day: str, settings: Settings) -> Column:
    return dates.in_window(F.col(day), settings.target_start_date, settings.date_upper_bound)


def _times(statements: DataFrame, pids: Column, name: str) -> DataFrame:
    """Truthy times of properties, as days."""
    rows = graph.truthy(statements.where(pids)).where("value_time is not null")
    return rows.select("subject", F.col("pid").alias(f"{name}_pid"), dates.signed_day(F.col("value_time")).alias(name))


def single_facts(tables: dict[str, DataFrame], closure: DataFrame, templates: DataFrame, settings: Settings) -> DataFrame:
    """Candidates of all templates of one fact: type, date and answer of a subject, where the answer is the only one for its date."""
    statements, entities = tables["statements"], tables["entities"]
    own = templates.where("reasoning_style = 'single_fact'").select(*_TEMPLATE, "exact_instance_only", "retrieval_limit")
    types = own.select(F.col("subject_type_qid").alias("root"), F.col("exact_instance_only").alias("exact")).distinct()
    typed = graph.instances(statements, types, closure).join(own, (F.col("root") == F.col("subject_type_qid")) & (F.col("exact") == F.col("exact_instance_only")))
    date_pids, target_pids = _values(own, "date_property_pid", "target_property_pid")
    dated = _times(statements, F.col("pid").isin(date_pids), "date").where(_within("date", settings)).withColumnRenamed("date_pid", "date_property_pid")
    answers = graph.truthy(statements.where(F.col("pid").isin(target_pids)))
    answers = answers.select(
        "subject", F.col("pid").alias("target_property_pid"), F.col("value_id").alias("answer_id"), dates.signed_day(F.col("value_time")).alias("answer_day"),
        F.coalesce("value_id", F.concat_ws(":", F.lit("VALUE"), F.col("value_kind"), F.coalesce("value_time", "value_text"))).alias("answer_key"),
    ).where("answer_key is not null")
    rows = typed.join(dated, ["subject", "date_property_pid"]).join(answers, ["subject", "target_property_pid"])
    unique = graph.having_one(rows, ["tpl_ord", "subject", "date"], F.col("answer_key"), ["answer_key"])
    most = F.least(F.lit(settings.harvest_limit_per_template), F.col("retrieval_limit")) * settings.over_fetch
    picked = numbered(unique, most, ["date", "subject", "answer_key"])

    related = items_of(statements, entities, graph.references(picked, ["subject", "answer_id"]).withColumnRenamed("id", "subject"), ["P31", "P131", "P276", "P150"])
    by = related.groupBy("subject").pivot("pid", ["P31", "P131", "P276", "P150"]).agg(F.first(F.struct("qids", "labels")))
    none = F.array().cast(TEXTS)
    own_items = by.select(
        "subject", F.coalesce("P31.qids", none).alias("type_qids"), F.coalesce("P31.labels", none).alias("type_labels"),
        F.concat(F.coalesce("P131.labels", none), F.coalesce("P276.labels", none)).alias("location_labels"),
    )
    parts = by.select(F.col("subject").alias("answer_id"), F.col("P150.labels").alias("part_labels"))
    full = graph.hydrate(graph.hydrate(picked, entities, "subject", "s"), entities, "answer_id", "a")
    full = full.join(own_items, "subject", "left").join(parts, "answer_id", "left")
    full = full.withColumns({c: F.coalesce(c, none) for c in ("type_qids", "type_labels", "location_labels", "part_labels")})
    is_date = F.col("answer_format") == "date"
    subject = select_label(F.col("s_label"), F.col("subject"))
    answer = select_label(F.col("a_label"), F.col("answer_id"))
    full = full.withColumns({"subject_name": subject, "answer_name": F.when(is_date, F.struct(F.coalesce(dates.spelled(F.col("answer_day")), F.lit("")).alias("label"), F.lit("wikidata_date_literal").alias("source"))).otherwise(answer)})
    answer_qid = F.when(is_date, F.concat(F.lit("VALUE:date:"), F.col("answer_day"))).otherwise(F.col("answer_key"))
    name, value = F.col("subject_name.label"), F.col("answer_name.label")
    return assemble(
        full, settings,
        subject_qid=F.col("subject"), subject_label=name, subject_aliases=F.col("s_aliases"), subject_type_qids=F.col("type_qids"), answer_qids=F.array(answer_qid),
        answer_labels=F.when(value != "", F.array(value)).otherwise(none), answer_aliases=F.when(is_date, F.array("answer_day")).otherwise(F.col("a_aliases")), date_value=F.col("date"),
        newness_metadata=record(schemas.NEWNESS, anchor_kind=F.lit("subject_date_property"), anchor_property_pid=F.col("date_property_pid"), anchor_value=F.col("date"), reason=F.lit("subject_or_event_date_not_earlier_than_target_time")),
        reasoning_style=F.lit("single_fact"), hop_count=F.lit(1),
        reasoning_path=F.array(hop(F.col("subject"), name, F.col("target_property_pid"), F.col("target_property_label"), answer_qid, value, "answer")),
        derivation_signature=record(schemas.DERIVATION, style=F.lit("single_fact"), rule=F.lit("direct_subject_property_lookup")),
        provenance_complete=(F.col("subject") != "") & (answer_qid != "") & (value != ""),
        source_metadata=record(
            schemas.SOURCE, wikidata_access_date=F.lit(settings.run_date), retrieval_method=F.lit("statements: type, date and answer of a subject"), subject_description=F.col("s_description"),
            subject_type_labels=F.col("type_labels"), subject_location_labels=F.col("location_labels"), answer_subdivision_labels=F.col("part_labels"),
            question_format_args=F.struct(subject_kind(F.col("subject_type_label"), F.col("type_labels")).alias("subject_kind"), F.lit(None).cast("string").alias("descriptor"), F.lit(None).cast("string").alias("ordinal")),
            subject_label_source=F.col("subject_name.source"), answer_label_source=F.col("answer_name.source"),
        ),
    )


def _values(templates: DataFrame, *columns: str) -> list[list[str]]:
    """The different values of some catalog columns (a handful of property ids), by one job."""
    row = templates.agg(*(F.collect_set(c) for c in columns)).first()
    return [sorted(x) for x in row]


def _label(entities: DataFrame, rows: DataFrame, id_col: str, name: str, fallback: bool = True) -> DataFrame:
    """``rows`` with an entity's English label: without one, its id (as a label service answers) or empty."""
    known = entities.select(F.col("qid").alias(id_col), F.col("label_en").alias("__label"))
    label = F.when(F.coalesce(F.col("__label"), F.lit("")) != "", F.col("__label")).otherwise(F.col(id_col) if fallback else F.lit(""))
    return rows.join(known, id_col, "left").withColumn(name, label).drop("__label")


def _qualifier(pid: str, field: str) -> Column:
    """A field of a statement's first qualifier of a property."""
    return F.get(F.try_element_at("qualifiers", F.lit(pid)), F.lit(0))[field]


def _format_args(descriptor: Column, ordinal: Column | None = None) -> Column:
    return record(schemas.SOURCE["question_format_args"].dataType, descriptor=descriptor, ordinal=F.lit(None) if ordinal is None else ordinal)


def wedding_age_gaps(tables: dict[str, DataFrame], closure: DataFrame, templates: DataFrame, settings: Settings) -> DataFrame:
    """Couples (each once) that married within the window, and the difference of their ages on that day."""
    statements, entities = tables["statements"], tables["entities"]
    couples = statements.where("pid = 'P26' and value_id is not null").select(F.col("subject").alias("person"), F.col("value_id").alias("spouse"), dates.signed_day(_qualifier("P580", "time")).alias("start")).where("start is not null")
    couples = graph.pairs_once(couples.where(_within("start", settings)), "person", "spouse")
    births = _times(statements, F.col("pid") == "P569", "birth").select("subject", "birth")
    rows = couples.join(births.select(F.col("subject").alias("person"), F.col("birth").alias("birth1")), "person").join(births.select(F.col("subject").alias("spouse"), F.col("birth").alias("birth2")), "spouse")
    rows = rows.withColumn("gap", dates.age_gap(F.col("birth1"), F.col("birth2"), F.col("start"))).where("gap is not null").distinct()
    return _wedding(rows, entities, templates, settings, F.col("date_property_pid"), "statements: spouses and their births", F.array(F.lit("wedding")))


def wedding_age_gaps_by_person(tables: dict[str, DataFrame], closure: DataFrame, templates: DataFrame, settings: Settings, persons: DataFrame | None = None) -> DataFrame:
    """For each person (all, or those in ``persons``), the first spouse claim that has a day, labels and births."""
    statements, entities = tables["statements"], tables["entities"]
    own = statements if persons is None else statements.join(persons.select(F.col(persons.columns[0]).alias("subject")).distinct(), "subject", "left_semi")
    claims = own.where("pid = 'P26' and value_id is not null").select(
        F.col("subject").alias("person"), "stmt_ord", F.col("value_id").alias("spouse"), dates.signed_day(_qualifier("P580", "time")).alias("start"), _qualifier("P580", "precision").alias("precision")
    )
    claims = claims.where(_within("start", settings) & (F.col("precision") == 11))
    first = graph.first_by(statements.where("pid = 'P569'"), ["subject"], ["stmt_ord"]).select("subject", dates.signed_day(F.col("value_time")).alias("birth")).where("birth is not null")
    rows = claims.join(first.select(F.col("subject").alias("person"), F.col("birth").alias("birth1")), "person").join(first.select(F.col("subject").alias("spouse"), F.col("birth").alias("birth2")), "spouse")
    labelled = entities.where("label_en <> ''").select("qid")
    rows = rows.join(labelled.withColumnRenamed("qid", "person"), "person", "left_semi").join(labelled.withColumnRenamed("qid", "spouse"), "spouse", "left_semi")
    rows = rows.withColumn("gap", dates.age_gap(F.col("birth1"), F.col("birth2"), F.col("start"))).where("gap is not null")
    return _wedding(graph.first_by(rows, ["person"], ["stmt_ord", "spouse"]).drop("stmt_ord", "precision"), entities, templates, settings, F.lit("P580"), "statements: first spouse claim of a person", F.lit(None))


def _wedding(rows: DataFrame, entities: DataFrame, templates: DataFrame, settings: Settings, date_pid: Column, method: str, clues: Column) -> DataFrame:
    own = templates.where("domain = 'wedding_age_gap' and reasoning_style = 'multi_hop_join'").select(*_TEMPLATE)
    rows = _label(entities, _label(entities, rows, "person", "person_label"), "spouse", "spouse_label").withColumn("domain", F.lit("wedding_age_gap")).join(own, "domain")
    rows = numbered(rows, settings.harvest_limit_per_template, ["start", "person", "spouse", "birth1", "birth2"])
    person, spouse, gap = F.col("person_label"), F.col("spouse_label"), F.col("gap").cast("string")
    value = F.concat(F.lit("VALUE:number:"), gap)
    return assemble(
        rows, settings,
        subject_qid=F.col("person"), subject_label=person, subject_type_qids=F.array("subject_type_qid"), target_property_pid=F.lit("COMPOSED_AGE_GAP"), target_property_label=F.lit("age gap at wedding"),
        answer_qids=F.array(value), answer_labels=F.array(gap), date_property_pid=date_pid, date_value=F.col("start"),
        newness_metadata=record(schemas.NEWNESS, anchor_kind=F.lit("statement_qualifier"), anchor_property_pid=F.lit("P580"), anchor_value=F.col("start"), reason=F.lit("marriage_start_time_not_earlier_than_target_time"), what_is_new=F.lit("the marriage event")),
        reasoning_style=F.lit("multi_hop_aggregate"),
        reasoning_path=F.array(hop(F.col("person"), person, F.lit("P26"), F.lit("spouse"), F.col("spouse"), spouse, "bridge"), hop(F.col("spouse"), spouse, F.lit("DERIVED_AGE_GAP_AT_EVENT"), F.lit("age gap at wedding"), value, gap, "answer")),
        bridge_entities=bridge(F.col("spouse"), spouse, "spouse"),
        derivation_signature=record(schemas.DERIVATION, style=F.lit("multi_hop_aggregate"), rule=F.lit("age_gap_at_marriage_start")),
        source_metadata=record(
            schemas.SOURCE, wikidata_access_date=F.lit(settings.run_date), retrieval_method=F.lit(method), question_format_args=_format_args(F.concat(person, F.lit(" and "), spouse, F.lit(" at their wedding"))),
            composed_from=record(schemas.COMPOSED, person_qid=F.col("person"), spouse_qid=F.col("spouse"), birth_dates=F.array("birth1", "birth2"), marriage_start=F.col("start")),
            multi_hop_unique=F.lit(True), required_reasoning_clues=clues,
        ),
    )


def first_degrees(tables: dict[str, DataFrame], closure: DataFrame, templates: DataFrame, settings: Settings, persons: DataFrame | None = None) -> DataFrame:
    """The institution of each person's earliest degree, if no other ended on the same day.

    Without ``persons``, people who ended studies at a university within the
    window. The window holds for the earliest degree, after it was found.
    """
    statements, entities = tables["statements"], tables["entities"]
    studies = statements.where("pid = 'P69' and value_id is not null").select(F.col("subject").alias("person"), F.col("value_id").alias("university"), dates.signed_day(_qualifier("P582", "time")).alias("end"), _qualifier("P512", "id").alias("degree"))
    studies = studies.where("end is not null and degree is not null")
    if persons is None:
        universities = closure.where(F.col("root") == fixed.UNIVERSITY_CLASS).select("cls")
        types = graph.truthy(statements.where("pid = 'P31'")).where("value_id is not null").select("subject", F.col("value_id").alias("cls"))
        seeds = studies.where(_within("end", settings)).join(types.join(universities, "cls", "left_semi").select(F.col("subject").alias("university")).distinct(), "university", "left_semi")
        people = types.where(F.col("cls") == fixed.HUMAN_CLASS).select(F.col("subject").alias("person")).distinct()
        persons = seeds.select("person").distinct().join(people, "person", "left_semi")
    else:
        persons = persons.select(F.col(persons.columns[0]).alias("person")).distinct()
    classes = statements.where(F.col("pid") == "P31").where(F.col("value_id").isin(*fixed.DEGREE_CLASSES)).select(F.col("subject").alias("university")).distinct()
    rows = studies.join(persons, "person", "left_semi").join(classes, "university", "left_semi")
    rows = _label(entities, rows, "university", "university_label", fallback=False).where("university_label <> ''")
    rows = graph.earliest_unique(rows, ["person"], "end").where(_within("end", settings))
    rows = _label(entities, _label(entities, rows, "person", "person_label", fallback=False), "degree", "degree_label").where("person_label <> ''")
    own = templates.where("domain = 'person_first_degree_university' and reasoning_style = 'multi_hop_join'").select(*_TEMPLATE)
    rows = numbered(rows.withColumn("domain", F.lit("person_first_degree_university")).join(own, "domain"), settings.harvest_limit_per_template, ["end", "person"])
    person, university, end = F.col("person_label"), F.col("university_label"), F.col("end")
    return assemble(
        rows, settings,
        subject_qid=F.col("person"), subject_label=person, subject_type_qids=F.array("subject_type_qid"), target_property_pid=F.lit("COMPOSED_FIRST_DEGREE_UNIVERSITY"), target_property_label=F.lit("first degree university"),
        answer_qids=F.array("university"), answer_labels=F.array(university), date_property_pid=F.lit("P582"), date_value=end,
        newness_metadata=record(schemas.NEWNESS, anchor_kind=F.lit("statement_qualifier"), anchor_property_pid=F.lit("P582"), anchor_value=end, reason=F.lit("education_end_time_not_earlier_than_target_time"), what_is_new=F.lit("the first degree completion")),
        reasoning_style=F.lit("multi_hop_join"),
        reasoning_path=F.array(
            hop(F.col("person"), person, F.lit("P69"), F.lit("educated at"), F.col("university"), university, "bridge", F.create_map(F.lit("P512"), F.col("degree"), F.lit("P582"), end)),
            hop(F.col("university"), university, F.lit("DERIVED_FIRST_DEGREE_SELECTION"), F.lit("first degree selection"), F.col("university"), university, "answer"),
        ),
        bridge_entities=bridge(F.col("university"), university, "university"),
        derivation_signature=record(schemas.DERIVATION, style=F.lit("multi_hop_join"), rule=F.lit("earliest_unique_degree_completion"), selected_end_date=end, selected_degree_qid=F.col("degree")),
        source_metadata=record(
            schemas.SOURCE, wikidata_access_date=F.lit(settings.run_date), retrieval_method=F.lit("statements: degrees of a person"), question_format_args=_format_args(person),
            composed_from=record(schemas.COMPOSED, person_qid=F.col("person"), selected_university_qid=F.col("university"), selected_degree_qid=F.col("degree"), selected_degree_label=F.col("degree_label"), selected_end_date=end),
            multi_hop_unique=F.lit(True), required_reasoning_clues=F.array(F.lit("first degree")),
        ),
    )


def source_work_authors(tables: dict[str, DataFrame], closure: DataFrame, templates: DataFrame, settings: Settings) -> DataFrame:
    """Films of the window, the one work each is based on, and that work's one author."""
    statements, entities = tables["statements"], tables["entities"]
    films = graph.instances(statements, _types(closure, fixed.FILM_CLASS), closure).select(F.col("subject").alias("film"))
    dated = _times(statements, F.col("pid") == "P577", "date").select(F.col("subject").alias("film"), "date").where(_within("date", settings))
    one = lambda pid, a, b: graph.without_other(graph.truthy(statements.where(F.col("pid") == pid)).where("value_id is not null").select(F.col("subject").alias(a), F.col("value_id").alias(b)), [a], b)
    rows = films.join(dated, "film").join(one("P144", "film", "work"), "film").join(one("P50", "work", "author"), "work").distinct()
    for name in ("film", "work", "author"):
        rows = _label(entities, rows, name, f"{name}_label")
    own = templates.where("domain = 'film_source_work_author' and reasoning_style = 'multi_hop_join'").select(*_TEMPLATE)
    rows = numbered(rows.withColumn("domain", F.lit("film_source_work_author")).join(own, "domain"), settings.harvest_limit_per_template, ["date", "film", "author"])
    film, work, author, date = (F.col(c) for c in ("film_label", "work_label", "author_label", "date"))
    return assemble(
        rows, settings,
        subject_qid=F.col("film"), subject_label=film, subject_type_qids=F.array("subject_type_qid"), target_property_pid=F.lit("COMPOSED_SOURCE_WORK_AUTHOR"), target_property_label=F.lit("author of source work"),
        answer_qids=F.array("author"), answer_labels=F.array(author), date_value=date,
        newness_metadata=record(schemas.NEWNESS, anchor_kind=F.lit("subject_date_property"), anchor_property_pid=F.col("date_property_pid"), anchor_value=date, reason=F.lit("film_release_date_not_earlier_than_target_time")),
        reasoning_style=F.lit("multi_hop_join"),
        reasoning_path=F.array(hop(F.col("film"), film, F.lit("P144"), F.lit("based on"), F.col("work"), work, "bridge"), hop(F.col("work"), work, F.lit("P50"), F.lit("author"), F.col("author"), author, "answer")),
        bridge_entities=bridge(F.col("work"), work, "source_work"),
        derivation_signature=record(schemas.DERIVATION, style=F.lit("multi_hop_join"), rule=F.lit("film_based_on_source_work_author"), bridge_property_pid=F.lit("P144"), answer_property_pid=F.lit("P50")),
        source_metadata=record(
            schemas.SOURCE, wikidata_access_date=F.lit(settings.run_date), retrieval_method=F.lit("statements: source work of a film and its author"), question_format_args=_format_args(film),
            multi_hop_unique=F.lit(True), required_reasoning_clues=F.array(F.lit("based on")), bridge_labels=F.array(work),
        ),
    )


def _types(closure: DataFrame, *roots: str) -> DataFrame:
    return closure.sparkSession.createDataFrame([(r, False) for r in roots], "root string, exact boolean")


def tournament_winners(tables: dict[str, DataFrame], closure: DataFrame, templates: DataFrame, settings: Settings) -> DataFrame:
    """Editions of the window with one winner, and their place in the whole history of their series."""
    statements, entities = tables["statements"], tables["entities"]
    own = templates.where("domain = 'ordinal_tournament_winner' and reasoning_style = 'multi_hop_ordinal'").select(*_TEMPLATE)
    head = own.select("subject_type_qid", "target_property_pid").head()
    if head is None:
        return empty_candidates(closure.sparkSession)
    typed = graph.instances(statements, _types(closure, head.subject_type_qid, fixed.SEASON_CLASS), closure).withColumnRenamed("subject", "edition")
    items = lambda pid, name: graph.truthy(statements.where(F.col("pid") == pid)).where("value_id is not null").select(F.col("subject").alias("edition"), F.col("value_id").alias(name))
    times = lambda pid, name: _times(statements, F.col("pid") == pid, name).select(F.col("subject").alias("edition"), name)
    tournaments = typed.where(F.col("root") == head.subject_type_qid).join(items("P179", "series"), "edition").join(times("P585", "date"), "edition").select("edition", "series", "date")
    seasons = typed.where(F.col("root") == fixed.SEASON_CLASS).join(items("P3450", "series"), "edition").join(times("P582", "season_end"), "edition", "left").join(times("P580", "season_start"), "edition", "left")
    seasons = seasons.withColumn("date", graph.first_bound(F.col("season_end"), F.col("season_start"))).where("date is not null")
    end_known = F.when(F.col("season_end").isNotNull(), "P582").otherwise("P580")
    rows = graph.union_branches([
        (tournaments.withColumn("season_end", F.lit(None).cast("string")), {"series_pid": F.lit("P179"), "date_pid": F.lit("P585")}),
        (seasons.select("edition", "series", "date", "season_end"), {"series_pid": F.lit("P3450"), "date_pid": end_known}),
    ]).drop("season_end")
    winners = graph.without_other(items(head.target_property_pid, "winner"), ["edition"], "winner").distinct()
    rows = rows.where(_within("date", settings)).join(winners, "edition")
    # The history of a series: all its dated editions, whatever their type, winner or date.
    series = graph.truthy(statements.where("pid in ('P179', 'P3450')")).where("value_id is not null").select(F.col("subject").alias("edition"), F.col("pid").alias("series_pid"), F.col("value_id").alias("series"))
    history = series.join(_times(statements, F.col("pid").isin("P585", "P582", "P580"), "day").withColumnsRenamed({"subject": "edition", "day_pid": "date_pid"}), "edition")
    places = graph.series_positions(history, ["series", "series_pid", "date_pid"], "day", "edition").select("series", "series_pid", "date_pid", "edition", F.col("position").alias("place")).distinct()
    rows = rows.join(places, ["series", "series_pid", "date_pid", "edition"])
    for name in ("edition", "series", "winner"):
        rows = _label(entities, rows, name, f"{name}_label")
    rows = rows.withColumn("descriptor", text.strip_year_tokens(F.col("series_label"))).where("descriptor <> '' and winner_label <> '' and winner_label <> winner")
    rows = numbered(rows.withColumn("domain", F.lit("ordinal_tournament_winner")).join(own, "domain"), settings.harvest_limit_per_template, ["date", "edition", "series", "series_pid", "date_pid"])
    name, edition, winner, nth = F.col("descriptor"), F.col("edition_label"), F.col("winner_label"), text.ordinal(F.col("place"))
    return assemble(
        rows, settings,
        subject_qid=F.col("series"), subject_label=name, subject_type_qids=F.array("subject_type_qid"), answer_qids=F.array("winner"), answer_labels=F.array(winner), date_value=F.col("date"),
        newness_metadata=record(schemas.NEWNESS, anchor_kind=F.lit("edition_date_property"), anchor_property_pid=F.col("date_pid"), anchor_value=F.col("date"), reason=F.lit("tournament_edition_date_not_earlier_than_target_time"), what_is_new=F.lit("the tournament edition")),
        reasoning_style=F.lit("multi_hop_ordinal"),
        reasoning_path=F.array(hop(F.col("series"), name, F.col("series_pid"), F.lit("has edition"), F.col("edition"), edition, "bridge"), hop(F.col("edition"), edition, F.col("target_property_pid"), F.col("target_property_label"), F.col("winner"), winner, "answer")),
        bridge_entities=bridge(F.col("edition"), edition, "edition"),
        derivation_signature=record(schemas.DERIVATION, style=F.lit("multi_hop_ordinal"), rule=F.lit("ordinal_series_edition_winner"), ordinal_value=F.col("place"), ordinal_rendered=nth, series_property_pid=F.col("series_pid"), date_property_pid=F.col("date_pid")),
        source_metadata=record(
            schemas.SOURCE, wikidata_access_date=F.lit(settings.run_date), retrieval_method=F.lit("statements: editions of a series and its whole history"), question_format_args=_format_args(name, nth),
            ordinal_metadata=record(
                schemas.ORDINAL, ordinal_value=F.col("place"), ordinal_rendered=nth, edition_qid=F.col("edition"), series_qid=F.col("series"), descriptor=name, series_label_raw=F.col("series_label"),
                series_history_complete=F.lit(True), series_property_pid=F.col("series_pid"), date_property_pid=F.col("date_pid"),
            ),
            multi_hop_unique=F.lit(True), required_reasoning_clues=F.array(F.lit("edition"), nth),
        ),
    )


def value_counts(tables: dict[str, DataFrame], closure: DataFrame, templates: DataFrame, settings: Settings) -> DataFrame:
    """No candidates: templates that count values have no rule that makes their counts safe. ``graph.count_values`` has the counts."""
    return empty_candidates(closure.sparkSession)


def empty_candidates(spark) -> DataFrame:
    return spark.createDataFrame([], schemas.CANDIDATES)


Executor = Callable[[dict[str, DataFrame], DataFrame, DataFrame, Settings], DataFrame]
#: Executors by reasoning style and domain; a further executor is a further entry. Others have no candidates.
EXECUTORS: dict[str, dict[str, Executor]] = {
    "multi_hop_join": {"wedding_age_gap": wedding_age_gaps, "person_first_degree_university": first_degrees, "film_source_work_author": source_work_authors},
    "multi_hop_ordinal": {"ordinal_tournament_winner": tournament_winners},
    "multi_hop_aggregate": {},
}


def harvest(tables: dict[str, DataFrame], closure: DataFrame, templates: DataFrame, settings: Settings) -> DataFrame:
    """The candidates of all templates."""
    out = single_facts(tables, closure, templates, settings)
    present = {(r[0], r[1]) for r in templates.where("reasoning_style <> 'single_fact'").select("reasoning_style", "domain").distinct().collect()}
    for style, by_domain in EXECUTORS.items():
        for domain, executor in by_domain.items():
            if (style, domain) in present:
                out = out.unionByName(executor(tables, closure, templates, settings))
    return out
