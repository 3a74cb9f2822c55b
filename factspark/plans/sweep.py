"""Sweeps: all templates of a list, one example each at most, over several runs that go on where the last one stopped.

A sweep's folder holds the records and a manifest of each of its runs. The
manifest is written last, so a run that dies leaves its templates to the next.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factspark.operators import harvest, report, select
from factspark.plans import pipeline
from factspark.plans.settings import Settings
from factspark.sources import readers, sinks

#: Manifests of other versions count as if they weren't there.
VERSION = 1
STATUS = T.StructType([T.StructField("domain", T.StringType()), T.StructField("accepted", T.LongType()), T.StructField("rejected", T.LongType()), T.StructField("status", T.StringType()), T.StructField("notes", T.StringType())])


def statuses(templates: DataFrame, result: pipeline.Result) -> DataFrame:
    """``(domain, accepted, rejected, status, notes)`` of the templates of one run; notes name the reasons of templates that were only rejected."""
    known = select.template_status(templates, result.candidates)
    reasons = report.reasons_by_domain(result.rejected).withColumn("notes", F.to_json(F.struct(F.col("reasons").alias("rejection_reasons"))))
    out = known.join(reasons.select("domain", "notes"), "domain", "left")
    return out.select("domain", "accepted", "rejected", "status", F.when(F.col("status") == "rejected_only", F.col("notes")).alias("notes"))


def run_part(tables: dict[str, DataFrame], templates: DataFrame, settings: Settings, folder: str, part: str, factory=None) -> None:
    """One run over some templates: its records, then its manifest."""
    result = pipeline.run(tables, templates, settings, factory)
    sinks.write_json_lines(result.accepted, f"{folder}/accepted/{part}", ["id"], one_file=True)
    sinks.write_json_lines(result.rejected.drop("tpl_ord", "cand_ord"), f"{folder}/rejected/{part}")
    _write_manifest(statuses(templates, result), settings, folder, part)


def _write_manifest(rows: DataFrame, settings: Settings, folder: str, part: str) -> None:
    given = {"resume_version": VERSION, "target_time": settings.target_time, "telemetry": None}
    sinks.write_manifest(rows.sparkSession, f"{folder}/manifest/{part}.jsonl", [given | r.asDict() for r in rows.orderBy("domain").collect()])  # one row a template


def manifest(spark, folder: str) -> DataFrame:
    schema = T.StructType([*sinks.MANIFEST.fields, *(f for f in STATUS.fields if f.name not in sinks.MANIFEST.names)])
    return readers.json_lines(spark, f"{folder}/manifest", schema)


def sweep(tables: dict[str, DataFrame], templates: DataFrame, settings: Settings, folder: str, attempts: int = 3, wait: Callable[[float], None] = time.sleep, factory=None) -> DataFrame:
    """Runs the templates that no earlier run in the folder has done; the one row of the summary of all runs.

    A run that fails is tried again, after three seconds, up to ``attempts``
    times; then its templates are run one by one, and those that fail alone have
    the status ``error:<type>`` and are taken up again by the next sweep.
    """
    spark = templates.sparkSession
    settings = replace(settings, separate_templates=True, pilot_total=max(1, templates.count()))
    done = manifest(spark, folder)
    todo = select.not_resumed(templates, done.where("not status like 'error:%'"), VERSION, settings.target_time)
    number = max((int(p) + 1 for p in _parts(spark, folder)), default=0)
    names = [r.domain for r in todo.select("domain").distinct().orderBy("domain").collect()]

    def tried(rows: DataFrame, part: str) -> Exception | None:
        failed = None
        for attempt in range(attempts):
            try:
                run_part(tables, rows, settings, folder, part, factory)
                return None
            except Exception as error:  # whatever a run dies of is told by its status
                failed = error
                if attempt < attempts - 1:
                    wait(3.0)
        return failed

    if names and tried(todo, f"{number:06d}") is not None:
        for k, name in enumerate(names, 1):
            error = tried(todo.where(F.col("domain") == name), f"{number + k:06d}")
            if error is not None:
                kind = f"error:{type(error).__name__}"
                row = spark.createDataFrame([(name, 0, 0, kind, json.dumps({"error_message": str(error)}))], STATUS)
                _write_manifest(row, settings, folder, f"{number + k:06d}")
    return collect(templates, settings, folder)


def _parts(spark, folder: str) -> list[str]:
    """The runs that have a manifest, which is the last thing they write: records of others don't count."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName().removesuffix(".jsonl") for f in fs.listStatus(at)) if fs.exists(at) else []


def collect(templates: DataFrame, settings: Settings, folder: str) -> DataFrame:
    """Numbers the accepted records of all runs, and writes the summary, the problems and the notes of the whole sweep."""
    spark = templates.sparkSession
    own = manifest(spark, folder).where((F.col("resume_version") == VERSION) & (F.col("target_time") == settings.target_time)).join(templates.select("domain").distinct(), "domain", "left_semi")
    # An error of an earlier run is forgotten once its template was run.
    best = own.groupBy("domain").agg(F.min_by(F.struct("accepted", "rejected", "status", "notes"), F.struct(F.col("status").startswith("error:"), "status")).alias("x")).select("domain", "x.*")
    accepted = _records(spark, folder, "accepted", sinks.accepted_record(harvest.empty_candidates(spark).withColumn("id", F.lit(""))).schema)
    rejected = _records(spark, folder, "rejected", T._parse_datatype_string("domain string, rejection_reason string"))
    place = accepted.join(templates.groupBy("domain").agg(F.min("tpl_ord").alias("__t")), "domain")
    numbered = select.numbered(place, settings.id_prefix, ["__t", "id"], "__id").withColumn("id", F.col("__id"))
    sinks.write_json_lines(numbered.select(*accepted.columns), f"{folder}/accepted_all", ["id"], one_file=True)
    row = report.summary(accepted, rejected, templates, best.na.fill(0, ["accepted", "rejected"]), settings.target_time)
    events = spark.createDataFrame([], "status string, error_type string, error_message string")
    problems = [(r.key, r.n) for r in report.problem_counts(events, best).orderBy("key").collect()]  # a handful of keys
    row = row.withColumn("problem_counts", F.map_from_entries(F.array(*(F.struct(F.lit(k), F.lit(n)) for k, n in problems))) if problems else F.create_map().cast("map<string,bigint>"))
    sinks.write_json_lines(row, f"{folder}/summary", one_file=True)
    sinks.write_text(spark, report.run_notes(row.first(), problems), f"{folder}/notes.md")
    return row


def _records(spark, folder: str, kind: str, schema: T.StructType) -> DataFrame:
    """The records of all runs, as they were written; an empty table if there are none."""
    paths = [p for p in (f"{folder}/{kind}/{part}" for part in _parts(spark, folder)) if readers._exists(spark, p)]
    return spark.read.schema(schema).json(paths) if paths else spark.createDataFrame([], schema)
