"""Command line: ``python -m claimloom rollup|train|score|drift``, or through spark-submit."""

import argparse
import logging

from pyspark.sql import SparkSession

from claimloom.functions import storage
from claimloom.operators import enrich, quality, rollup
from claimloom.plans import monitoring, training
from claimloom.sources import bundles, tables
from claimloom.streaming import scoring as stream


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="claimloom", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("rollup", help="raw extracts to the merged claims table")
    job.add_argument("--inpatient", required=True)
    job.add_argument("--outpatient", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--rejects", default=None, help="folder for rows with unreadable cells; default: they end the job")
    job.add_argument("--drops", default=None, help="folder for the nulls and dropped rows per column")
    job = jobs.add_parser("train", help="validate, tune, fit, compare and export models")
    job.add_argument("--claims", required=True)
    job.add_argument("--income", required=True)
    job.add_argument("--models", required=True)
    job = jobs.add_parser("score", help="score a table of requests")
    job.add_argument("--requests", required=True)
    job.add_argument("--models", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--no-explanations", action="store_true")
    job = jobs.add_parser("stream-score", help="score requests as their files arrive")
    job.add_argument("--requests", required=True, help="folder of JSON files")
    job.add_argument("--models", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--no-explanations", action="store_true")
    job.add_argument("--until-empty", action="store_true", help="end when all present files are scored")
    job = jobs.add_parser("drift", help="compare a batch with the training fold")
    job.add_argument("--claims", required=True)
    job.add_argument("--income", required=True)
    job.add_argument("--models", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--current", default=None, help="CSV or Parquet; default: the held-out fold")
    return parser


def main(arguments: list[str] | None = None) -> None:
    """Run one job on the session that spark-submit configures."""
    options = _parser().parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(name)s: %(message)s")
    shared = SparkSession.getActiveSession() is not None
    spark = SparkSession.builder.appName(f"claimloom {options.job}").getOrCreate()
    try:
        _run(spark, options)
    finally:
        # All results are written by now; a session that others use may still read its tables.
        if not shared:
            storage.remove_tables(spark)


def _run(spark: SparkSession, options: argparse.Namespace) -> None:
    if options.job == "rollup":
        merged, report = rollup.merged_with_report(
            *[
                tables.load_raw_extract(spark, path, options.rejects and f"{options.rejects}/{side}")
                for side, path in (("inpatient", options.inpatient), ("outpatient", options.outpatient))
            ]
        )
        tables.write_claims(merged, options.output)
        if options.drops:
            tables.write_report({"drops": report.table(spark)}, options.drops)
    elif options.job == "train":
        claims = tables.load_claims(spark, options.claims)
        training.run(spark, claims, tables.load_income(spark, options.income), options.models)
    elif options.job == "score":
        bundle = bundles.load_bundle(spark, options.models)
        accepted, rejected = stream.check_requests(tables.load_current(spark, options.requests, typed=False))
        scored = stream.score_requests(bundle, accepted, not options.no_explanations)
        scored.write.mode("overwrite").parquet(f"{options.output}/scores")
        rejected.write.mode("overwrite").parquet(f"{options.output}/rejected")
    elif options.job == "stream-score":
        running = stream.start_scoring(
            stream.read_requests(spark, options.requests),
            bundles.load_bundle(spark, options.models),
            options.output,
            options.checkpoint,
            not options.no_explanations,
            **({"availableNow": True} if options.until_empty else {"processingTime": "30 seconds"}),
        )
        running.awaitTermination()
    else:
        claims = tables.load_claims(spark, options.claims)
        income = tables.load_income(spark, options.income)
        checked = quality.validate_modeling_frame(enrich.modeling_frame(claims, income))
        monitoring.run(
            spark, checked, bundles.load_bundle(spark, options.models), options.output, options.current
        )


if __name__ == "__main__":
    main()
