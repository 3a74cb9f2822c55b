"""Competitors of the same name, and descriptors that tell a subject from them without naming a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factspark.functions import text

TEXTS = "array<string>"


def name_key(norm: Column, name: Column) -> Column:
    """Names in other scripts are empty when normalised: those compare as they are written."""
    return F.when(norm != "", norm).otherwise(F.concat(F.lit("="), F.lower(name)))


def competitors(subjects: DataFrame, names: DataFrame, most: int = 10, aliases: bool = False) -> DataFrame:
    """``(row_id, competitor)``: other entities with the name of a subject, at most ``most`` of each by id.

    ``subjects`` has ``(row_id, qid, names)``. With ``aliases``, all names of the
    entities count, else only their labels. The cap is the search's own.
    """
    wanted = subjects.select("row_id", F.col("qid").alias("own"), F.explode("names").alias("name"))
    wanted = wanted.select("row_id", "own", name_key(text.normalize_name(F.col("name")), F.col("name")).alias("key")).distinct()
    known = (names if aliases else names.where("not is_alias")).select(F.col("qid").alias("competitor"), name_key(F.col("norm_name"), F.col("name")).alias("key")).distinct()
    # A subject needs the first ``most`` others of each name: one more than that, as it may be among them itself.
    known = known.withColumn("__rn", F.row_number().over(Window.partitionBy("key").orderBy("competitor"))).where(F.col("__rn") <= most + 1).drop("__rn")
    met = wanted.join(known, "key").where("competitor <> own").select("row_id", "competitor").distinct()
    ranked = met.withColumn("__rn", F.row_number().over(Window.partitionBy("row_id").orderBy("competitor")))
    return ranked.where(F.col("__rn") <= most).drop("__rn")


def safe_location(candidate_label: Column, places: Column, forbidden: Column, target_pid: Column) -> Column:
    """``label in place`` with the first place that is none of the forbidden names; null without one, and for questions for a country."""
    norm = F.transform(places, lambda p: F.struct(p.alias("name"), text.normalize_name(p).alias("norm")))
    usable = F.filter(norm, lambda p: (p["norm"] != "") & ~F.array_contains(forbidden, p["norm"]))
    label = text.strip(candidate_label)
    return F.when((target_pid != "P17") & (label != ""), text.located(label, F.get(usable, F.lit(0))["name"]))


def resolve(candidates: DataFrame, names: DataFrame, statements: DataFrame, most: int = 10, aliases: bool = False) -> DataFrame:
    """Candidates of one fact with ``resolution``: ``struct<status, descriptor, signature, competitor_qids>``, null where nothing tells them apart.

    ``candidates`` need a column ``subject_type_qid`` of their template. The
    column ``found_competitors`` holds the competitors either way.
    """
    rows = candidates.withColumn("row_id", F.struct("tpl_ord", "cand_ord"))
    own_names = F.concat(F.array("subject_label"), F.coalesce("subject_aliases", F.array().cast(TEXTS))) if aliases else F.array("subject_label")
    met = competitors(rows.select("row_id", F.col("subject_qid").alias("qid"), own_names.alias("names")), names, most, aliases)
    types = statements.where("pid = 'P31' and value_id is not null").select(F.col("subject").alias("competitor"), F.col("value_id").alias("type")).distinct()
    typed = met.join(types, "competitor", "left").groupBy("row_id", "competitor").agg(F.collect_set("type").alias("types"))
    groups = typed.groupBy("row_id").agg(F.array_sort(F.collect_set("competitor")).alias("found"), F.array_distinct(F.flatten(F.collect_list("types"))).alias("types"))
    rows = rows.join(groups, "row_id", "left").drop("row_id")
    found = F.coalesce("found", F.array().cast(TEXTS))
    same_type = F.coalesce(F.array_contains("types", F.col("subject_type_qid")), F.lit(False))
    lists = F.concat(F.col("answer_labels"), F.col("answer_aliases"), F.coalesce("source_metadata.answer_subdivision_labels", F.array().cast(TEXTS)))
    place = safe_location(F.col("subject_label"), F.coalesce("source_metadata.subject_location_labels", F.array().cast(TEXTS)), F.transform(lists, text.normalize_name), F.col("target_property_pid"))
    made = lambda status, descriptor, signature: F.struct(F.lit(status).alias("status"), descriptor.alias("descriptor"), signature.cast(TEXTS).alias("signature"), found.alias("competitor_qids"))
    resolution = (
        F.when(F.size(found) == 0, made("label_unique", F.col("subject_label"), F.array()))
        .when(~same_type, made("resolved_by_non_temporal_descriptor", F.col("subject_label"), F.array("subject_type_label")))
        .when(place.isNotNull(), made("resolved_by_non_temporal_descriptor", place, F.array(F.lit("location_descriptor"))))
    )
    return rows.withColumns({"resolution": resolution, "found_competitors": found}).drop("found", "types")


def descriptors(statements: DataFrame, entities: DataFrame, kinds: dict[str, list[str]] | None = None) -> DataFrame:
    """``(qid, kind, label)``: what could tell entities apart. ``kinds`` names the properties of each kind of descriptor."""
    kinds = kinds or {"type": ["P31"], "genre": ["P136"], "source": ["P144"], "series": ["P179"], "context": ["P17", "P364", "P123", "P178", "P1433", "P195", "P276", "P131"]}
    by = F.create_map(*(F.lit(x) for kind, pids in kinds.items() for pid in pids for x in (pid, kind)))
    rows = statements.where(F.col("pid").isin(*(p for pids in kinds.values() for p in pids)) & F.col("value_id").isNotNull() & (F.coalesce("rank", F.lit("normal")) != "deprecated"))
    labels = entities.where("label_en <> ''").select(F.col("qid").alias("value_id"), F.col("label_en").alias("label"))
    return rows.select(F.col("subject").alias("qid"), F.try_element_at(by, F.col("pid")).alias("kind"), "pid", "value_id").join(labels, "value_id").select("qid", "kind", "pid", "label").distinct()


def smallest_signature(subjects: DataFrame, facts: DataFrame, most: int = 3) -> DataFrame:
    """``(row_id, signature)``: the smallest set of descriptors, of ``most`` at most, that the subject has and no competitor has whole.

    ``subjects`` has ``(row_id, qid, competitors, forbidden)`` (normalised names that
    must not be shown, such as the answer's); ``facts`` are descriptors. Of
    equally small sets the first in order is taken; null if there is none. Sets
    are grown one descriptor at a time, and only competitors that have all of a
    set's descriptors are carried on.
    """
    clean = facts.where(~text.has_temporal_text(F.col("label"))).select("qid", F.concat_ws(": ", "kind", "label").alias("d"), text.normalize_name(F.col("label")).alias("norm")).distinct()
    own = subjects.join(clean, "qid").where(~F.array_contains("forbidden", F.col("norm"))).select("row_id", "d").distinct()
    rivals = subjects.select("row_id", F.explode("competitors").alias("rival")).join(clean.select(F.col("qid").alias("rival"), "d"), "rival").select("row_id", "rival", "d").distinct()
    shared = rivals.groupBy("row_id", "d").agg(F.collect_set("rival").alias("rivals"))
    one = own.join(shared, ["row_id", "d"], "left").select("row_id", "d", F.coalesce("rivals", F.array().cast(TEXTS)).alias("rivals"))
    level = one.select("row_id", F.array("d").alias("signature"), "rivals")
    found = None
    for k in range(most):
        good = level.where("size(rivals) = 0").select("row_id", F.lit(k).alias("k"), "signature")
        found = good if found is None else found.unionByName(good)
        if k < most - 1:
            more = level.where("size(rivals) > 0").join(one.select("row_id", F.col("d").alias("next"), F.col("rivals").alias("also")), "row_id")
            level = more.where(F.col("next") > F.element_at("signature", -1)).select("row_id", F.array_append("signature", F.col("next")).alias("signature"), F.array_intersect("rivals", "also").alias("rivals"))
    best = found.groupBy("row_id").agg(F.min(F.struct("k", "signature")).alias("x"))
    return subjects.select("row_id").distinct().join(best, "row_id", "left").select("row_id", F.col("x.signature").alias("signature"))


def unique_signature(entities: DataFrame, facts: DataFrame, most: int = 3) -> DataFrame:
    """``(qid, signature)`` of every entity: the smallest set of descriptors, of ``most`` at most, that no other entity of its group has whole.

    The same as ``smallest_signature`` with all others of the group as
    competitors and nothing forbidden. Sets are counted within their group, so
    no entity carries the others. ``entities`` has ``(qid, group)``; an entity
    without a group has no competitors.
    """
    entities = entities.select("qid", "group").distinct()
    clean = facts.where(~text.has_temporal_text(F.col("label"))).select("qid", F.concat_ws(": ", "kind", "label").alias("d")).distinct()
    own = entities.join(clean, "qid")
    alone = F.when(F.col("group").isNull(), F.col("qid"))
    level, found = own.select("qid", "group", F.array("d").alias("signature")), None
    for k in range(most):
        good = level.groupBy("group", alone.alias("alone"), "signature").agg(F.count("*").alias("n"), F.min("qid").alias("qid")).where("n = 1").select("qid", F.lit(k).alias("k"), "signature")
        found = good if found is None else found.unionByName(good)
        if k < most - 1:
            more = level.join(clean.withColumnRenamed("d", "next"), "qid").where(F.col("next") > F.element_at("signature", -1))
            level = more.select("qid", "group", F.array_append("signature", F.col("next")).alias("signature"))
    best = found.groupBy("qid").agg(F.min(F.struct("k", "signature")).alias("x"))
    return entities.select("qid").distinct().join(best, "qid", "left").select("qid", F.col("x.signature").alias("signature"))
