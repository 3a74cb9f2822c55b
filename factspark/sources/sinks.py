"""Writers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def accepted_record(candidates: DataFrame, id_col: str = "id") -> DataFrame:
    """Accepted candidates as output records, in the order of their 29 keys."""
    same = lambda *names: [F.col(n) for n in names]
    return candidates.select(
        F.col(id_col).alias("id"), F.coalesce(F.nullif(F.col("rewritten_question"), F.lit("")), F.col("canonical_question")).alias("question"), F.get("answer_labels", F.lit(0)).alias("answer"),
        *same("answer_aliases", "subject_qid", "answer_qids"), F.col("target_property_pid").alias("property_pid"), *same("domain", "topic", "answer_type", "question_family", "target_time"),
        F.struct(F.col("date_property_pid").alias("property"), F.col("date_value").alias("value")).alias("date_filter"),
        *same(
            "newness_metadata", "ambiguity_status", "disambiguation_signature", "competitor_qids", "reasoning_style", "hop_count", "reasoning_path", "bridge_entities", "derivation_signature",
            "shortcut_checks", "provenance_complete", "question_requires_all_hops", "canonical_question", "rewritten_question", "validation_flags", "source_metadata",
        ),
    )


def rejected_record(candidates: DataFrame, columns: list[str]) -> DataFrame:
    """Rejected candidates with all their columns, the reason and the notes."""
    return candidates.select(*columns, "rejection_reason", "rejection_notes")


def write_json_lines(df: DataFrame, path: str, order: list[str] | None = None, keep_nulls: bool = True, one_file: bool = False) -> None:
    """JSON lines in UTF-8, replacing what is there; null fields are written unless told otherwise.

    With ``order``, the files in name order, and the lines in each, are in that
    order. One file is for outputs that are known to be small.
    """
    if order:
        df = df.coalesce(1).sortWithinPartitions(*order) if one_file else df.orderBy(*order)
    elif one_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def write_tsv(df: DataFrame, path: str, order: list[str]) -> None:
    """A table of text with a header, in one file (catalogs are small)."""
    df.coalesce(1).sortWithinPartitions(*order).drop(*(c for c in order if c.startswith("tpl_"))).write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", quoteAll=False)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small document, by the cluster's file system."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(text.encode())
    finally:
        out.close()


def write_manifest(spark: SparkSession, path: str, rows: list[dict]) -> None:
    """Resume manifests, one row a domain, written after the domain's output is complete."""
    write_text(spark, "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), path)


MANIFEST = T.StructType([T.StructField(c, T.StringType() if c != "resume_version" else T.IntegerType()) for c in ("resume_version", "domain", "target_time", "status", "telemetry", "notes")])
