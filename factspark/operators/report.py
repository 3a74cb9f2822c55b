"""Counts over catalogs, runs and telemetry, and the reports made of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The columns of a catalog export, in order.
EXPORT = (
    "domain", "activation_status", "evidence_status", "evidence_runs", "evidence_notes", "topic", "answer_type", "answer_format", "temporal_mode", "reasoning_style", "composition_style",
    "question_family", "subject_type_qid", "subject_type_label", "date_property_pid", "target_property_pid", "target_property_label", "date_answer_granularity", "exact_instance_only",
    "new_element_slot", "new_element_hop", "required_reasoning_clues", "canonical_question_template",
)
# The headings of the review document.
AXES = (
    ("Status Axis", "Activation Status", "activation_status"), ("Evidence Axis", "Evidence Status", "evidence_status"), ("Domain Axis", "Topic", "topic"),
    ("Answer Type Axis", "Answer Type", "answer_type"), ("Answer Format Axis", "Answer Format", "answer_format"), ("Temporal Axis", "Temporal Mode", "temporal_mode"),
)


DEFINITIONS = (
    ("activation_status", "how far a template is used: by default (`active`), in trials of several hops or of dates as answers, or as a plan only (`blueprint`)"),
    ("evidence_status", "whether a recorded run has accepted an example of it"),
    ("temporal_mode", "whether the question is free of time (`atemporal`), joins facts by a time (`time_related_join`), or asks for a day (`date_answer`)"),
)


def catalog_rows(templates: DataFrame) -> DataFrame:
    """The catalog as text columns: lists joined by commas, booleans in lower case, nothing null."""
    recipe = F.col("reasoning_recipe")
    made: dict[str, Column] = {
        "activation_status": F.col("status"), "evidence_runs": F.concat_ws(",", "evidence_runs"), "exact_instance_only": F.lower(F.col("exact_instance_only").cast("string")),
        "new_element_slot": recipe["new_element_slot"], "new_element_hop": recipe["new_element_hop"].cast("string"), "required_reasoning_clues": F.concat_ws(",", recipe["required_reasoning_clues"]),
    }
    return templates.select("tpl_ord", *(F.coalesce(made.get(c, F.col(c) if c not in made else None), F.lit("")).alias(c) for c in EXPORT))


def axis_counts(rows: DataFrame, axes: list[str]) -> DataFrame:
    """``(axis, value, n)``: the counts of each column's values, all columns in one pass over the rows."""
    sets = rows.groupingSets([[c] for c in axes], *axes).agg(F.count("*").alias("n"), F.grouping_id().alias("__g"))
    which = lambda k: F.col("__g") == sum(1 << (len(axes) - 1 - i) for i in range(len(axes)) if i != k)
    axis = F.coalesce(*(F.when(which(k), F.lit(c)) for k, c in enumerate(axes)))
    value = F.coalesce(*(F.when(which(k), F.col(c).cast("string")) for k, c in enumerate(axes)))
    return sets.select(axis.alias("axis"), value.alias("value"), "n")


def catalog_totals(templates: DataFrame) -> DataFrame:
    """All templates, and those that ask for numbers, for dates, and that are about a time."""
    return templates.agg(
        F.count("*").alias("total"), F.count_if((F.col("answer_type") == "Number") | (F.col("answer_format") == "number")).alias("number_total"),
        F.count_if(F.col("answer_format") == "date").alias("date_total"), F.count_if(F.col("temporal_mode") != "atemporal").alias("temporal_total"),
    )


def catalog_markdown(templates: DataFrame) -> str:
    """The catalog's review document: totals, counts by six columns, and all rows (a catalog is small)."""
    rows = catalog_rows(templates)
    total = catalog_totals(templates).first()
    counts: dict[str, list[tuple[str, int]]] = {}
    for r in axis_counts(rows, [c for _, _, c in AXES]).orderBy("axis", "value").collect():
        counts.setdefault(r.axis, []).append((r.value, r.n))
    out = [
        "# Template Catalog Review", "", "## Definitions", "", *(f"- `{name}`: {meaning}" for name, meaning in DEFINITIONS), "", "## Headline Stats", "", f"- Total templates: `{total.total}`", f"- Number-answer templates: `{total.number_total}`",
        f"- Date-answer templates: `{total.date_total}`", f"- Time-related templates (including date-answer): `{total.temporal_total}`",
    ]
    for title, head, column in AXES:
        out += ["", f"## {title}", "", f"| {head} | Count |", "|---|---:|", *(f"| {v} | {n} |" for v, n in counts.get(column, []))]
    shown = ("domain", "activation_status", "evidence_status", "topic", "answer_type", "answer_format", "temporal_mode", "reasoning_style", "subject", "date_property_pid", "target_property_pid", "evidence_runs", "canonical_question_template")
    titles = ("Domain", "Activation Status", "Evidence Status", "Topic", "Answer Type", "Answer Format", "Temporal Mode", "Reasoning Style", "Subject Type", "Date PID", "Target PID", "Runs", "Canonical Template")
    out += ["", "## Full Catalog", "", "| " + " | ".join(titles) + " |", "|" + "---|" * len(titles)]
    full = rows.withColumn("subject", F.concat("subject_type_label", F.lit(" ("), "subject_type_qid", F.lit(")"))).orderBy("tpl_ord")
    out += ["| " + " | ".join(r) + " |" for r in full.select(*shown).collect()]
    return "\n".join(out) + "\n"


def problem_counts(events: DataFrame, statuses: DataFrame | None = None) -> DataFrame:
    """``(key, n)``: problems of requests and outcomes of templates; an event may count under several keys.

    ``events`` has ``status``, ``error_type`` and ``error_message``; ``statuses`` has
    the ``status`` of each template.
    """
    message = F.coalesce("error_message", F.lit(""))
    low = F.lower(message)
    keys = F.array_compact(F.array(
        F.concat(F.lit("request_error:"), F.coalesce("error_type", F.lit("unknown"))),
        F.when(F.contains(message, F.lit("429")), "network_limit:http_429"),
        F.when(F.contains(low, F.lit("timed out")) | F.contains(low, F.lit("timeout")), "network_limit:timeout"),
    ))
    rows = events.where("status = 'error'").select(F.explode(keys).alias("key"))
    if statuses is not None:
        status = F.col("status")
        key = F.when(status.isin("no_result", "rejected_only"), F.concat(F.lit("outcome:"), status)).when(status.startswith("error:"), status)
        rows = rows.unionByName(statuses.select(key.alias("key")).where("key is not null"))
    return rows.groupBy("key").agg(F.count("*").alias("n"))


def snapshot(events: DataFrame, by: Sequence[str] = (), order: Sequence[str] = (), per_row: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Counters of requests, and a copy of their events, ``per_row`` of them in each row at most.

    ``events`` has ``kind`` (``network``, ``cache_hit``), ``status``, ``attempt``. With ``by``,
    there is a row of counters for each value. The events of a run are as many
    rows as its log needs (``part`` 0, 1, ...), in order; no row holds all of them.
    """
    place = Window.partitionBy(*by).orderBy(*(order or events.columns)) if by else None
    numbered = events.withColumn("__n", F.row_number().over(place) - 1) if by else _in_order(events, order or events.columns)
    parts = numbered.groupBy(*by, F.floor(F.col("__n") / per_row).cast("long").alias("part")).agg(F.array_sort(F.collect_list(F.struct("__n", F.struct(*events.columns).alias("event")))).alias("x"))
    return events.groupBy(*by).agg(*_counters()), parts.select(*by, "part", F.col("x.event").alias("events"))


def _in_order(events: DataFrame, order: Sequence[str]) -> DataFrame:
    from factspark.operators.select import numbered

    return numbered(events, "n", list(order), "__id").withColumn("__n", F.substring("__id", 3, 20).cast("long") - 1).drop("__id")


def _counters() -> list[Column]:
    return [
        F.count("*").alias("total_requests"), F.count_if(F.col("kind") == "network").alias("network_requests"), F.count_if(F.col("kind") == "cache_hit").alias("cache_hits"),
        F.count_if(F.col("attempt") > 1).alias("retries"), F.count_if(F.col("status") == "error").alias("errors"),
    ]


def counters_only(events: DataFrame) -> DataFrame:
    return events.agg(*_counters())


def reasons_by_domain(rejected: DataFrame) -> DataFrame:
    """``(domain, reasons)``: the different reasons of each template's rejections, sorted."""
    return rejected.groupBy("domain").agg(F.array_sort(F.collect_set("rejection_reason")).alias("reasons"))


def missing_domains(templates: DataFrame, accepted: DataFrame) -> DataFrame:
    """``(domain,)``: what was asked for and has no accepted example."""
    return templates.select("domain").distinct().join(accepted.select("domain"), "domain", "left_anti")


def summary(accepted: DataFrame, rejected: DataFrame, templates: DataFrame, status: DataFrame, target_time: str) -> DataFrame:
    """One row: what a run gave, and which domains gave nothing."""
    named = lambda s: F.array_sort(F.collect_set(F.when(s, F.col("domain"))))
    domains = status.agg(
        named(F.col("status") == "accepted").alias("accepted_domains"), named(F.col("status") == "rejected_only").alias("rejected_only_domains"),
        named(F.col("status") == "no_result").alias("no_result_domains"), named(F.startswith("status", F.lit("error:"))).alias("error_domains"),
        F.array_sort(F.collect_list(F.struct("domain", "accepted", "rejected", "status"))).alias("template_results"),
    )
    missing = missing_domains(templates, accepted).agg(F.array_sort(F.collect_set("domain")).alias("missing_domains"))
    one = lambda df, *c: df.select(F.lit(1).alias("__one"), *c)
    out = one(domains, "*").join(one(missing, "*"), "__one").join(one(accepted.agg(F.count("*").alias("accepted_total")), "*"), "__one")
    out = out.join(one(rejected.agg(F.count("*").alias("rejected_total")), "*"), "__one").join(one(templates.agg(F.count("*").alias("template_total")), "*"), "__one")
    return out.withColumn("target_time", F.lit(target_time)).drop("__one")


def run_notes(summary_row, problems: list[tuple[str, int]]) -> str:
    """A run's notes as Markdown, from the one row of its summary and its problem counts."""
    block = lambda title, names: [f"## {title}", "", *([f"- `{n}`" for n in names] or ["- none"]), ""]
    out = ["# Run notes", "", f"- Target time: `{summary_row.target_time}`", f"- Templates: `{summary_row.template_total}`", f"- Accepted: `{summary_row.accepted_total}`", f"- Rejected: `{summary_row.rejected_total}`", ""]
    for title, names in (("Accepted", summary_row.accepted_domains), ("Rejected only", summary_row.rejected_only_domains), ("No result", summary_row.no_result_domains), ("Errors", summary_row.error_domains)):
        out += block(title, names)
    return "\n".join([*out, "## Problems", "", *([f"- `{k}`: {n}" for k, n in problems] or ["- none"]), ""])
