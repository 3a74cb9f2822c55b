"""A run: harvest, validate, disambiguate, ask, check, rewrite and select, as one plan over all templates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspark import fixed, schemas
from factspark.functions import text
from factspark.operators import ambiguity, graph, harvest, select, validate
from factspark.operators import rewrite as rewriting
from factspark.plans.settings import Settings
from factspark.sources import sinks
from factspark.storage import stored

COLUMNS = schemas.CANDIDATES.names


@dataclass(frozen=True)
class Result:
    """``accepted`` and ``rejected`` records, and ``candidates``: all rows with their outcome."""

    accepted: DataFrame
    rejected: DataFrame
    candidates: DataFrame


def closure_of(tables: dict[str, DataFrame], templates: DataFrame) -> DataFrame:
    """The subclasses of all classes that the templates and executors name."""
    edges = graph.truthy(tables["statements"].where("pid = 'P279'")).where("value_id is not null").select(F.col("subject").alias("child"), F.col("value_id").alias("parent"))
    spark = edges.sparkSession
    own = spark.createDataFrame([(c,) for c in (fixed.FILM_CLASS, fixed.UNIVERSITY_CLASS, fixed.SEASON_CLASS, fixed.HUMAN_CLASS)], "root string")
    return graph.class_closure(edges, templates.select(F.col("subject_type_qid").alias("root")).unionByName(own).distinct())


def judge(candidates: DataFrame, tables: dict[str, DataFrame], templates: DataFrame, settings: Settings) -> DataFrame:
    """Candidates with their question and flags, ``rejection_reason`` and ``rejection_notes`` (null for those that pass)."""
    own = templates.select("tpl_ord", "subject_type_qid", "subject_type_label", "canonical_question_template", "composition_style")
    reason, note = validate.rejection(settings)
    rows = candidates.join(own, "tpl_ord").withColumns({"rejection_reason": reason, "__note": note})
    rows = stored(rows)  # read by the searches below, and by what they are joined back to
    if settings.full_statements:
        rows = _only_statements(rows, tables["statements"])
    # Only candidates that pass the cheap rules are searched for competitors.
    none = F.array().cast("array<string>")
    key = ["tpl_ord", "cand_ord"]
    single = rows.where("rejection_reason is null and composition_style = 'single_fact'")
    single = ambiguity.resolve(single, tables["names"], tables["statements"], 50 if settings.alias_competitors else settings.competitor_limit, settings.alias_competitors)
    if settings.signatures:
        single = _with_signatures(single, tables)
    rows = rows.join(single.select(*key, "resolution", F.col("found_competitors").alias("__found")), key, "left")
    meta = F.col("source_metadata")
    known = F.struct(
        F.lit("resolved_by_non_temporal_descriptor").alias("status"), F.coalesce(meta["question_format_args"]["descriptor"], F.col("subject_label")).alias("descriptor"),
        F.coalesce(meta["required_reasoning_clues"], none).alias("signature"), none.alias("competitor_qids"),
    )
    composed = F.col("rejection_reason").isNull() & (F.col("composition_style") != "single_fact")
    rows = rows.withColumns({"resolution": F.when(composed, known).otherwise(F.col("resolution")), "found_competitors": F.coalesce("__found", none)})
    args = meta["question_format_args"]
    slots = {"descriptor": F.coalesce(args["descriptor"], F.col("resolution.descriptor")), "subject_kind": F.coalesce(args["subject_kind"], F.col("subject_type_label")), "ordinal": args["ordinal"]}
    unresolved = "no_non_temporal_signature" if settings.signatures else "same_label_competitor_requires_temporal_disambiguation"
    rows = rows.withColumns({
        "rejection_reason": F.coalesce("rejection_reason", F.when(F.col("resolution").isNull(), unresolved)),
        "canonical_question": F.when(F.col("resolution").isNotNull(), text.fill(F.col("canonical_question_template"), slots)).otherwise(F.lit("")),
        "ambiguity_status": F.coalesce("resolution.status", F.lit("unknown")),
        "disambiguation_signature": F.coalesce("resolution.signature", none),
        "competitor_qids": F.coalesce("resolution.competitor_qids", none),
    })
    # A question with a slot that nothing fills can't be asked.
    rows = rows.withColumn("__unfilled", F.col("canonical_question").isNull()).withColumn("canonical_question", F.coalesce("canonical_question", F.lit("")))
    asked = validate.flag(rows, settings.extra_phrases)
    checked = F.col("resolution").isNotNull() & F.col("rejection_reason").isNull()
    failed = checked & (~F.col("flags_ok") | F.col("__unfilled"))
    notes = F.when(failed, F.to_json(F.struct("validation_flags"))).when(F.size("found_competitors") > 0, F.when(F.col("resolution").isNull(), F.to_json(F.struct(F.col("found_competitors").alias("competitor_qids")))))
    out = asked.withColumns({
        "rejection_notes": F.coalesce(F.when(F.col("__note").isNotNull(), F.to_json(F.struct(F.col("__note").alias("reasoning_error")))), notes),
        "rejection_reason": F.coalesce("rejection_reason", F.when(failed, "canonical_question_failed_validation")),
        "validation_flags": F.when(checked, F.col("validation_flags")), "shortcut_checks": F.when(checked, F.col("shortcut_checks")),
        "question_requires_all_hops": F.when(checked, F.col("question_requires_all_hops")),
    })
    return out.select(*COLUMNS, "rejection_reason", "rejection_notes")


def _only_statements(rows: DataFrame, statements: DataFrame) -> DataFrame:
    """Candidates of one fact whose answer isn't the only one among all statements of any rank are turned down."""
    asked = rows.where("rejection_reason is null and composition_style = 'single_fact'").select(F.col("subject_qid").alias("subject"), F.col("target_property_pid").alias("pid")).distinct()
    known = graph.full_statement_unique(statements.join(asked, ["subject", "pid"], "left_semi")).select(F.col("subject").alias("subject_qid"), F.col("pid").alias("target_property_pid"), F.col("is_unique").alias("__only"))
    checked = F.col("rejection_reason").isNull() & (F.col("composition_style") == "single_fact") & ~F.coalesce("__only", F.lit(False))
    out = rows.join(known, ["subject_qid", "target_property_pid"], "left")
    return out.withColumn("rejection_reason", F.when(checked, "answer_not_unique").otherwise(F.col("rejection_reason"))).select(*rows.columns)


def _with_signatures(single: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Candidates that have competitors and no other way to be told from them are resolved by the smallest signature."""
    single = stored(single)
    asked = single.where("resolution is null")
    lists = F.concat("answer_labels", "answer_aliases")
    subjects = asked.select(F.struct("tpl_ord", "cand_ord").alias("row_id"), F.col("subject_qid").alias("qid"), F.col("found_competitors").alias("competitors"), F.transform(lists, text.normalize_name).alias("forbidden"))
    entities = subjects.select("qid").unionByName(subjects.select(F.explode("competitors").alias("qid"))).distinct()
    facts = ambiguity.descriptors(tables["statements"].join(entities.withColumnRenamed("qid", "subject"), "subject", "left_semi"), tables["entities"])
    found = ambiguity.smallest_signature(subjects, facts).select("row_id.tpl_ord", "row_id.cand_ord", F.col("signature").alias("__signature"))
    rows = single.join(found, ["tpl_ord", "cand_ord"], "left")
    label = F.concat(F.col("subject_label"), F.lit(", "), F.array_join("__signature", ", "))
    made = F.struct(F.lit("resolved_by_non_temporal_descriptor").alias("status"), label.alias("descriptor"), F.col("__signature").alias("signature"), F.col("found_competitors").alias("competitor_qids"))
    return rows.withColumn("resolution", F.coalesce("resolution", F.when(F.size("__signature") > 0, made))).drop("__signature")


def finish(judged: DataFrame, settings: Settings, factory: Callable[[], rewriting.RewriteClient] | None = None) -> Result:
    """Rewrites what passed, selects, and makes the records."""
    judged = stored(judged)
    passed = rewriting.rewrite(judged.where("rejection_reason is null"), factory, settings.extra_phrases)
    rows = judged.where("rejection_reason is not null").unionByName(passed.select(*judged.columns))
    question = F.coalesce(F.nullif(F.col("rewritten_question"), F.lit("")), F.col("canonical_question"))
    rows = rows.withColumns({"question": question, "ok": F.col("rejection_reason").isNull()})
    if factory is not None:
        rows = stored(rows)  # a client is asked once
    if settings.quota_by:
        chosen = select.by_quota(rows, settings.pilot_total, settings.quota_by, subject_property=settings.dedup_subject_property)
    else:
        chosen = select.greedy(rows, settings.pilot_total, separate=settings.separate_templates).withColumn("over_quota", F.lit(False))
    chosen = chosen.withColumns({
        "rejection_reason": F.when(F.col("is_duplicate"), "duplicate_question").when(F.col("over_quota"), "quota_exceeded").otherwise(F.col("rejection_reason")),
        "rejection_notes": F.when(F.col("is_duplicate"), F.to_json(F.struct(text.strip(F.col("question")).alias("question")))).otherwise(F.col("rejection_notes")),
    }).drop("over_quota")
    won = chosen.where("outcome = 'accepted'").withColumn("id", F.format_string("%s_%06d", F.lit(settings.id_prefix), F.col("sequence")))
    lost = chosen.where("outcome = 'rejected'")
    return Result(sinks.accepted_record(won), sinks.rejected_record(lost, COLUMNS), chosen)


def run(tables: dict[str, DataFrame], templates: DataFrame, settings: Settings, factory: Callable[[], rewriting.RewriteClient] | None = None) -> Result:
    """All of it. ``factory`` makes the rewriting client, if questions are to be rewritten."""
    if factory is None and settings.rewrite is not None:
        factory = rewriting.client_factory(settings.rewrite)
    candidates = harvest.harvest(tables, closure_of(tables, templates), templates, settings)
    return finish(judge(candidates, tables, templates, settings), settings, factory)


def demo(candidates: DataFrame) -> DataFrame:
    """Composed candidates with their question and three flags, whatever the rules say: for a look at single ids."""
    args = F.col("source_metadata.question_format_args")
    rows = candidates.join(_questions(candidates), "domain")
    slots = {"descriptor": F.coalesce(args["descriptor"], F.col("subject_label")), "subject_kind": F.coalesce(args["subject_kind"], F.lit("")), "ordinal": args["ordinal"]}
    rows = rows.withColumn("canonical_question", text.fill(F.col("canonical_question_template"), slots))
    flags = F.struct(~text.has_year(F.col("canonical_question")), ~text.has_temporal_text(F.col("canonical_question")), validate.provenance_complete())
    return rows.withColumn("flags", flags.cast("struct<no_year:boolean,no_temporal_expression:boolean,provenance_complete:boolean>")).drop("canonical_question_template")


def _questions(candidates: DataFrame) -> DataFrame:
    from factspark import catalog

    every = catalog.templates(candidates.sparkSession)
    return every.groupBy("domain").agg(F.min_by("canonical_question_template", "tpl_ord").alias("canonical_question_template"))


def write(result: Result, settings: Settings, accepted_path: str, rejected_path: str) -> None:
    """Both sides of a result as JSON lines (a run's examples are few)."""
    sinks.write_json_lines(result.accepted, accepted_path, ["id"], one_file=True)
    sinks.write_json_lines(result.rejected, rejected_path, ["tpl_ord", "cand_ord"])
