"""The command line: ``python -m factspark.plans.cli COMMAND ...``.

``run`` (the default) makes a dataset, ``sweep`` goes through all templates over
several runs, ``export`` writes the catalog, ``demo`` shows single ids, and
``evaluate`` grades predictions.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factspark import catalog
from factspark.operators import evaluate, harvest, report, select
from factspark.plans import pipeline, sweep
from factspark.plans.settings import RewriteConfig, Settings
from factspark.sources import readers, sinks

LISTS = {"active": catalog.active, "piloted": catalog.piloted, "unproven": catalog.unproven, "blueprint": catalog.blueprint, "all": lambda t: t}


def _graph_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--tables", help="a stored graph")
    p.add_argument("--documents", help="entity documents as JSON lines, instead of a stored graph")
    p.add_argument("--target-time", required=True)
    p.add_argument("--run-date")
    p.add_argument("--output", required=True)


def _run_options(p: argparse.ArgumentParser, total: int, limit: int, chosen: str) -> None:
    _graph_options(p)
    p.add_argument("--pilot-total", type=int, default=total)
    p.add_argument("--harvest-limit", type=int, default=limit)
    p.add_argument("--domains", nargs="*", help="run these templates only")
    p.add_argument("--catalog", choices=sorted(LISTS), default=chosen)
    p.add_argument("--id-prefix")
    p.add_argument("--alias-competitors", action="store_true", help="find competitors by all names of both sides")
    p.add_argument("--signatures", action="store_true", help="tell subjects from competitors by their smallest set of descriptors")
    p.add_argument("--full-statements", action="store_true", help="answers must be the only ones among statements of all ranks")
    p.add_argument("--extra-phrases", action="store_true", help="more phrases count as temporal text")
    p.add_argument("--finer-reasons", action="store_true", help="tell apart why a property changes")
    p.add_argument("--quota-by", choices=("domain", "topic", "answer_type", "question_family"), help="examples by even quotas of a column")
    p.add_argument("--proxy")
    p.add_argument("--enable-rewrite", action="store_true")
    p.add_argument("--rewrite-provider", default="openrouter")
    p.add_argument("--rewrite-model", default="")
    p.add_argument("--rewrite-api-key-env", default="OPENROUTER_API_KEY")
    p.add_argument("--rewrite-base-url")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run")
    _run_options(run, 20, 100, "active")
    run.add_argument("--rejected-output")
    run.add_argument("--summary-output")
    run.add_argument("--notes-output")
    many = commands.add_parser("sweep", help="one example of each template at most; a repeated sweep goes on where the last one stopped")
    _run_options(many, 1, 10, "unproven")
    many.add_argument("--attempts", type=int, default=3)
    export = commands.add_parser("export", help="the catalog as a table (DIR/catalog) and as a document (DIR/review.md)")
    export.add_argument("--output", required=True)
    export.add_argument("--catalog", choices=sorted(LISTS), default="all")
    demo = commands.add_parser("demo", help="composed questions about single people, whatever the rules say")
    _graph_options(demo)
    demo.add_argument("--wedding", nargs="*", default=[], help="ids of people who married")
    demo.add_argument("--degree", nargs="*", default=[], help="ids of people with a degree")
    grades = commands.add_parser("evaluate", help="grades of predictions (DIR/graded) and their metrics (DIR/metrics)")
    grades.add_argument("--dataset", required=True)
    grades.add_argument("--predictions", required=True)
    grades.add_argument("--model-name", default="")
    grades.add_argument("--by", nargs="*", default=[], help="metrics by these columns of the dataset")
    grades.add_argument("--output", required=True)
    return p


def settings_of(args: argparse.Namespace) -> Settings:
    rewrite = RewriteConfig(args.rewrite_provider, args.rewrite_model, args.rewrite_api_key_env, args.rewrite_base_url, args.proxy) if args.enable_rewrite else None
    more = {k: v for k, v in {"run_date": args.run_date, "id_prefix": args.id_prefix}.items() if v}
    return Settings(
        args.target_time, pilot_total=args.pilot_total, harvest_limit_per_template=args.harvest_limit, rewrite=rewrite, alias_competitors=args.alias_competitors, signatures=args.signatures,
        full_statements=args.full_statements, extra_phrases=args.extra_phrases, finer_reasons=args.finer_reasons, quota_by=args.quota_by, **more,
    )


def _tables(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    return readers.read_tables(spark, args.tables) if args.tables else readers.graph(spark, readers.entity_documents(spark, args.documents))


def _templates(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    every = catalog.templates(spark)
    return catalog.by_domains(every, args.domains) if args.domains else LISTS[args.catalog](every)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    settings, templates = settings_of(args), _templates(spark, args)
    result = pipeline.run(_tables(spark, args), templates, settings)
    pipeline.write(result, settings, args.output, args.rejected_output or f"{args.output}-rejected")
    status = select.template_status(templates, result.candidates)
    row = report.summary(result.accepted, result.rejected, templates, status, settings.target_time)
    if args.summary_output:
        sinks.write_json_lines(row, args.summary_output, one_file=True)
    if args.notes_output:
        events = spark.createDataFrame([], "status string, error_type string, error_message string")
        problems = [(r.key, r.n) for r in report.problem_counts(events, status).orderBy("key").collect()]
        sinks.write_text(spark, report.run_notes(row.first(), problems), args.notes_output)
    row.select("accepted_total", "rejected_total").show()


def _sweep(spark: SparkSession, args: argparse.Namespace) -> None:
    row = sweep.sweep(_tables(spark, args), _templates(spark, args), settings_of(args), args.output, args.attempts)
    row.select("template_total", "accepted_total", "rejected_total").show()


def _export(spark: SparkSession, args: argparse.Namespace) -> None:
    templates = LISTS[args.catalog](catalog.templates(spark))
    sinks.write_tsv(report.catalog_rows(templates), f"{args.output}/catalog", ["tpl_ord"])
    sinks.write_text(spark, report.catalog_markdown(templates), f"{args.output}/review.md")


def _demo(spark: SparkSession, args: argparse.Namespace) -> None:
    tables, every = _tables(spark, args), catalog.templates(spark)
    settings = Settings(args.target_time, **({"run_date": args.run_date} if args.run_date else {}))
    every = catalog.by_domains(every, ["wedding_age_gap", "person_first_degree_university"])  # of a name that comes twice, the first
    closure = pipeline.closure_of(tables, every)
    out = None
    for executor, people in ((harvest.wedding_age_gaps_by_person, args.wedding), (harvest.first_degrees, args.degree)):
        if people:
            part = executor(tables, closure, every, settings, spark.createDataFrame([(x,) for x in people], "qid string"))
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise SystemExit("name people with --wedding or --degree")
    shown = pipeline.demo(out).withColumn("ambiguity_status", F.lit("resolved_by_non_temporal_descriptor"))
    shown = shown.withColumn("id", F.format_string("composed_demo_%06d", F.row_number().over(select.Window.partitionBy().orderBy("domain", "subject_qid", "cand_ord"))))  # a few ids
    sinks.write_json_lines(sinks.accepted_record(shown), args.output, ["id"], one_file=True)


def _evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    graded = evaluate.graded(evaluate.dataset(spark, args.dataset, args.by), evaluate.predictions(spark, args.predictions))
    sinks.write_json_lines(graded, f"{args.output}/graded", ["id"])
    graded = spark.read.schema(graded.schema).json(f"{args.output}/graded")
    named = evaluate.metrics(graded, by=args.by).withColumns({"model_name": F.lit(args.model_name), "dataset_path": F.lit(args.dataset), "prediction_path": F.lit(args.predictions)})
    sinks.write_json_lines(named, f"{args.output}/metrics", one_file=True)
    named.show(truncate=False)


def main(argv: list[str] | None = None) -> int:
    import sys

    argv = sys.argv[1:] if argv is None else argv
    commands = {"run": _run, "sweep": _sweep, "export": _export, "demo": _demo, "evaluate": _evaluate}
    if argv and argv[0] not in (*commands, "-h", "--help"):
        argv = ["run", *argv]
    args = parser().parse_args(argv)
    commands[args.command](SparkSession.builder.appName("factspark").getOrCreate(), args)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
