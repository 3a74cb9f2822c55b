"""Validators: one rejection reason for a candidate, and the audit flags of its question.

Normalised names are computed once, into columns that are dropped at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factspark import fixed, schemas
from factspark.functions import dates, text
from factspark.operators.graph import path_connected
from factspark.plans.settings import Settings

TEXTS = "array<string>"


def _list(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast(TEXTS))


def holds(norm_text: Column, norm_names: Column) -> Column:
    """Whether the text holds one of the names (both normalised); empty names are never held."""
    return F.exists(norm_names, lambda n: (n != "") & F.contains(norm_text, n))


def holds_all(norm_text: Column, norm_names: Column) -> Column:
    return F.forall(norm_names, lambda n: (n == "") | F.contains(norm_text, n))


def normalized(names: Column) -> Column:
    return F.transform(names, text.normalize_name)


def is_multi_hop() -> Column:
    return text.is_multi_hop(F.col("reasoning_style"))


def time_invariant(run_date: str, finer: bool = False) -> Column:
    """A settled date, and no property on the way whose values change (``finer``: nor those that only the finer reasons name)."""
    pids = (*fixed.RISK_PIDS, *fixed.RELATIONSHIP_PIDS) if finer else fixed.RISK_PIDS
    risky = lambda pid: F.coalesce(pid, F.lit("")).isin(*pids)
    path = F.exists("reasoning_path", lambda h: risky(h["property_pid"]))
    return F.coalesce(dates.settled(F.col("date_value"), run_date), F.lit(False)) & ~risky(F.col("target_property_pid")) & ~(is_multi_hop() & path)


def answer_unique() -> Column:
    return (F.size("answer_qids") == 1) & F.coalesce(F.col("source_metadata.multi_hop_unique"), F.lit(True))


def provenance_complete() -> Column:
    whole = (F.size("reasoning_path") == F.col("hop_count")) & F.col("derivation_signature.rule").isNotNull()
    return F.coalesce("provenance_complete", F.lit(False)) & (~is_multi_hop() | whole)


def temporally_safe(extra: bool = False) -> Column:
    """No time in the subject's label, nor in those labels of the path that a question may come to show."""
    surfaced = F.coalesce(F.col("source_metadata.surface_bridge_entities"), F.lit(False))
    bridges = F.transform("bridge_entities", lambda b: b["qid"])
    timed = lambda label: text.has_temporal_text(F.coalesce(label, F.lit("")), extra)

    def safe(h: Column) -> Column:
        role = F.coalesce(h["role"], F.lit(""))
        source = F.coalesce(h["source_qid"], F.lit(""))
        hidden = F.coalesce(F.array_contains(bridges, source), F.lit(False)) & ~surfaced
        check_source = (source != F.col("subject_qid")) & ~hidden & ((role == "answer") | surfaced)
        check_target = ~((role == "bridge") & ~surfaced) & ((F.col("answer_type") != "Date") | (role != "answer"))
        return ~(check_source & timed(h["source_label"])) & ~(check_target & timed(h["target_label"]))

    return ~timed(F.col("subject_label")) & F.forall("reasoning_path", safe)


def connected() -> Column:
    return ~is_multi_hop() | ((F.col("hop_count") >= 2) & path_connected(F.col("reasoning_path")))


def ordinal_safe(extra: bool = False) -> Column:
    meta = F.col("source_metadata.ordinal_metadata")
    descriptor = F.coalesce(meta["descriptor"], F.lit(""))
    safe = F.coalesce(meta["series_history_complete"], F.lit(False)) & (descriptor != "") & ~text.has_temporal_text(descriptor, extra)
    return (text.normalize_style(F.col("reasoning_style")) != "multi_hop_ordinal") | safe


def rejection(settings: Settings) -> tuple[Column, Column]:
    """The first rule that a candidate breaks, before any search for competitors (null if it breaks none), and a note."""
    unsettled = F.when(F.col("target_property_pid") == "P57", "future_dated_or_unsettled_fact").otherwise("answer_not_time_invariant")
    if settings.finer_reasons:
        on_the_way = F.filter(F.transform("reasoning_path", lambda h: finer_reason(h["property_pid"])), lambda why: why.isNotNull())
        unsettled = F.coalesce(finer_reason(), F.when(is_multi_hop(), F.get(on_the_way, F.lit(0))), unsettled)
    extra = settings.extra_phrases
    label = F.coalesce(F.col("subject_label"), F.lit(""))
    rules: list[tuple[Column, Column | str, str | None]] = [
        (label == "", "no_english_label", None),
        (F.size(_list("answer_labels")) == 0, "no_answer_label", None),
        (text.has_year(label) & F.lit(not settings.allow_year_in_official_title), "subject_label_contains_year", None),
        # Where years are allowed in titles, other temporal text still isn't, nor are dates.
        (text.has_temporal_text(label, extra), "subject_label_contains_temporal_expression", None),
        (~time_invariant(settings.run_date, settings.finer_reasons), unsettled, None),
        (~answer_unique(), "answer_not_unique", None),
        (~provenance_complete(), "provenance_incomplete", "provenance_incomplete"),
        (~temporally_safe(extra), "same_label_competitor_requires_temporal_disambiguation", "hop_requires_temporal_disambiguation"),
        (~connected(), "reasoning_path_not_connected", "reasoning_path_not_connected"),
        (~ordinal_safe(extra), "ordinal_derivation_not_safe", "ordinal_derivation_not_safe"),
    ]
    reason = F.coalesce(*(F.when(F.coalesce(broken, F.lit(True)), F.lit(why) if isinstance(why, str) else why) for broken, why, _ in rules))
    note = F.coalesce(*(F.when(F.coalesce(broken, F.lit(True)), F.lit(note or "")) for broken, _, note in rules))
    return reason, F.nullif(note, F.lit(""))


def finer_reason(pid: Column | None = None) -> Column:
    """The design's own reason for a property whose values change: a relationship, an affiliation or a statistic."""
    pid = F.col("target_property_pid") if pid is None else pid
    return (
        F.when(pid.isin(*fixed.RELATIONSHIP_PIDS), "mutable_relationship_or_status").when(pid.isin(*fixed.AFFILIATION_PIDS), "mutable_affiliation_or_office").when(pid.isin(*fixed.STATISTIC_PIDS), "cumulative_statistic")
    )


def first_failure(rules: list[tuple[Column, str]]) -> Column:
    """The name of the first rule that is broken; null if none is."""
    return reduce(lambda found, rule: F.coalesce(found, F.when(rule[0], rule[1])), rules, F.lit(None).cast("string"))


def question_checks(candidates: DataFrame, question_col: str) -> DataFrame:
    """``candidates`` with ``__q`` (the question, normalised) and the normalised lists it is held against."""
    bridges = F.filter(F.transform("bridge_entities", lambda b: text.normalize_name(F.coalesce(b["label"], F.lit("")))), lambda n: n != text.normalize_name(F.col("subject_label")))
    meta = "source_metadata"
    return candidates.withColumns({
        "__q": text.normalize_name(F.col(question_col)),
        "__answers": normalized(_list("answer_labels")),
        "__aliases": normalized(_list("answer_aliases")),
        "__places": normalized(F.concat(_list(f"{meta}.subject_location_labels"), _list(f"{meta}.answer_subdivision_labels"))),
        "__bridges": bridges,
        "__clues": normalized(_list(f"{meta}.required_reasoning_clues")),
    })


_SCRATCH = ("__q", "__answers", "__aliases", "__places", "__bridges", "__clues")


def leaks_answer() -> Column:
    return holds(F.col("__q"), F.col("__answers"))


def leaks_any_answer() -> Column:
    return holds(F.col("__q"), F.concat("__answers", "__aliases"))


def leaks_place() -> Column:
    return (F.col("target_property_pid") == "P17") & holds(F.col("__q"), F.col("__places"))


def leaks_bridge() -> Column:
    surfaced = F.coalesce(F.col("source_metadata.surface_bridge_entities"), F.lit(False))
    return is_multi_hop() & ~surfaced & holds(F.col("__q"), F.col("__bridges"))


def requires_all_hops() -> Column:
    return ~is_multi_hop() | holds_all(F.col("__q"), F.col("__clues"))


def must_be_non_temporal() -> Column:
    return F.col("answer_type") != "Date"


def flag(candidates: DataFrame, extra: bool = False) -> DataFrame:
    """Candidates with the flags of their canonical question, and whether all of them hold (``flags_ok``)."""
    rows = question_checks(candidates, "canonical_question")
    free = ~must_be_non_temporal()
    question = F.col("canonical_question")
    hops = requires_all_hops()
    values = {
        "no_year": free | ~text.has_year(question), "no_temporal_expression": free | ~text.has_temporal_text(question, extra), "answer_unique": F.lit(True), "subject_unique_under_question": F.lit(True),
        "answer_not_leaked": ~leaks_answer(), "location_context_not_leaked": ~leaks_place(), "bridge_not_leaked": ~leaks_bridge(), "question_requires_all_hops": hops, "shortcut_free": hops,
        "provenance_complete": provenance_complete(),
    }
    flags = F.struct(*((F.coalesce(values[f.name], F.lit(False)) if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.FLAGS.fields))
    rows = rows.withColumn("validation_flags", F.when(question.isNotNull(), flags))
    rows = rows.withColumns({
        "question_requires_all_hops": F.col("validation_flags.question_requires_all_hops"),
        "shortcut_checks": F.when(question.isNotNull(), F.struct(is_multi_hop().alias("applies"), F.col("validation_flags.question_requires_all_hops").alias("question_requires_all_hops"), F.col("validation_flags.shortcut_free").alias("shortcut_free"))),
        "flags_ok": reduce(lambda a, b: a & b, (F.coalesce(F.col(f"validation_flags.{name}"), F.lit(False)) for name in values)),
    })
    return rows.drop(*_SCRATCH)


#: Names that travel with the texts' plan, so that texts are read where they lie: so many, and so many characters, at most.
NAMES_AT_ONCE, CHARS_AT_ONCE = 10_000, 4 << 20


def texts_that_hold(texts: DataFrame, names: DataFrame, id_col: str, name_id_col: str) -> DataFrame:
    """``(id_col, name_id_col)``: which ``texts`` (``norm``) hold which ``names`` (``norm``), each pair once; both are normalised, and empty names are never held.

    A name may begin or end within a word of the text; the words in its middle
    are whole words of both. So a text meets a name by that one of them that
    fewest names share, and is searched only if it holds it. The names come in
    blocks of bounded size and travel to the texts, which aren't shuffled. A
    name of one or two words has no middle: it is searched in every text.
    """
    words = F.split("norm", " ")
    named = names.where("norm is not null and norm <> ''").select(F.col(name_id_col).alias("name"), "norm", F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0))).alias("middle")).distinct()
    used = named.select("name", "norm", F.explode(F.array_distinct("middle")).alias("word"))
    rank = Window.partitionBy("name", "norm").orderBy("n", F.desc(F.length("word")), "word")
    anchors = used.join(used.groupBy("word").agg(F.count("*").alias("n")), "word").withColumn("rank", F.row_number().over(rank)).where("rank = 1").select("name", "norm", "word")
    out = None
    for block in _name_blocks(anchors.unionByName(named.where("size(middle) = 0").select("name", "norm", F.lit(None).cast("string").alias("word")))):
        own = texts.sparkSession.createDataFrame(block, T.StructType([T.StructField("name", named.schema["name"].dataType), T.StructField("norm", T.StringType()), T.StructField("word", T.StringType())]))
        parts = []
        if keys := sorted({r.word for r in block if r.word is not None}):
            met = texts.select(id_col, "norm", F.explode(F.array_intersect(words, F.array(*map(F.lit, keys)) if len(keys) < 2 else F.split(F.lit(" ".join(keys)), " "))).alias("word"))
            side = own.where("word is not null").select(F.col("word").alias("anchor"), "name", F.col("norm").alias("wanted"))
            parts.append(met.join(F.broadcast(side), F.col("word") == F.col("anchor")).where(F.contains("norm", F.col("wanted"))).select(id_col, F.col("name").alias(name_id_col)))
        short = [r for r in block if r.word is None]
        if short:
            ids = texts.sparkSession.createDataFrame([(k, r.name) for k, r in enumerate(short)], T.StructType([T.StructField("k", T.IntegerType()), T.StructField("name", named.schema["name"].dataType)]))
            listed = F.split(F.lit("\n".join(r.norm for r in short)), "\n")
            held = texts.select(id_col, F.explode(F.filter(F.transform(listed, lambda x, k: F.when(F.contains(F.col("norm"), x), k)), lambda k: k.isNotNull())).alias("k"))
            parts.append(held.join(F.broadcast(ids), "k").select(id_col, F.col("name").alias(name_id_col)))
        for part in parts:
            out = part if out is None else out.unionByName(part)
    if out is None:
        return texts.limit(0).select(id_col, F.lit(None).cast(named.schema["name"].dataType).alias(name_id_col))
    return out.distinct()


def _name_blocks(rows: DataFrame) -> Iterator[list]:
    block, size = [], 0
    for r in rows.toLocalIterator():
        if block and (len(block) == NAMES_AT_ONCE or size + len(r.norm) > CHARS_AT_ONCE):
            yield block
            block, size = [], 0
        block.append(r)
        size += len(r.norm)
    if block:
        yield block
