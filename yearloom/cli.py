"""Command line: land, format, exploit, train, or all three of the latter.

    spark-submit ... -m yearloom format -l zones/landing -k zones/lookup -f zones/formatted
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import replace

from pyspark.sql import SparkSession

from yearloom.plans import city, tracking, training, zones
from yearloom.session import build_session, scratch_scope
from yearloom.sources import landing, readers, writers

log = logging.getLogger(__name__)


def run_preview(spark: SparkSession, source_base: str) -> None:
    """Schema, row count, column profile and five rows of each dataset."""
    for spec in city.DATASETS:
        df = readers.preview_dataset(spark, spec, source_base)
        log.info("Dataset %s, read from %s", spec.name, spec.glob)
        df.printSchema()
        landing.profile(df).show(len(df.columns), truncate=False)
        landing.preview(df).show(truncate=False)


def run_copy(spark: SparkSession, source_base: str, landing_base: str, overwrite: bool) -> None:
    globs = {spec.name: f"{source_base}/{spec.glob}" for spec in city.DATASETS}
    landing.ingest_raw(spark, globs, landing_base, overwrite)


def run_format(
    spark: SparkSession,
    landing_base: str,
    lookup_base: str,
    formatted_base: str,
    fmt: str = "parquet",
    overwrite: bool = False,
    only_given_years: bool = False,
) -> None:
    zones.format_zone(
        spark,
        city.DATASETS,
        city.LOOKUP,
        landing_base,
        lookup_base,
        formatted_base,
        fmt,
        overwrite,
        only_given_years,
    )


def run_exploit(
    spark: SparkSession,
    formatted_base: str,
    exploitation_base: str,
    fmt: str = "parquet",
    overwrite: bool = False,
    input_fmt: str | None = None,
) -> None:
    """Without ``input_fmt`` the formatted zone is read as ``fmt``, or parquet for csv."""
    input_fmt = input_fmt or ("parquet" if fmt == "csv" else fmt)
    schemas = {s.name: zones.formatted_schema(s, city.LOOKUP) for s in city.DATASETS}
    zones.exploit_zone(
        spark,
        city.PANEL,
        formatted_base,
        exploitation_base,
        city.MASTER,
        fmt,
        overwrite,
        input_fmt,
        schemas if input_fmt == "json" else None,
    )


def run_train(
    spark: SparkSession,
    exploitation_path: str,
    tracking_path: str,
    models: tuple[str, ...] = ("incident", "income"),
    all_null: str = "raise",
    fmt: str = "parquet",
) -> dict[str, str | None]:
    """Train and register each model; returns the champion's run id per model."""
    path = f"{exploitation_path}/{city.MASTER}"
    schema = zones.master_schema(city.PANEL) if fmt in ("json", "csv") else None
    chosen = {}
    for name in models:
        master = readers.read_table(spark, path, fmt, schema=schema)
        spec = replace(city.MODELS[name], all_null=all_null)
        result = training.train(master, spec)
        log.info("%s: %s", name, {c.family: c.rmse for c in result.candidates})
        chosen[name] = tracking.track(spark, tracking_path, result)
    return chosen


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="yearloom", description=__doc__.splitlines()[0])
    stages = parser.add_subparsers(dest="stage", required=True)

    land = stages.add_parser("land", help="look at raw files or bring them into the landing zone")
    land.add_argument("--source-base", "-s", required=True)
    land.add_argument("--landing-base", "-l", help="needed to copy")
    land.add_argument("--mode", "-m", choices=["preview", "copy"], default="preview")
    land.add_argument("--overwrite", action="store_true")

    def add(name: str, help: str, *bases: str) -> argparse.ArgumentParser:
        stage = stages.add_parser(name, help=help)
        short = {"landing": "-l", "lookup": "-k", "formatted": "-f", "exploitation": "-e"}
        for base in bases:
            stage.add_argument(f"--{base}-base", short[base], required=True)
        stage.add_argument("--format", default="parquet", choices=writers.FORMATS)
        return stage

    form = add("format", "years and identifiers", "landing", "lookup", "formatted")
    exploit = add("exploit", "the master table", "formatted", "exploitation")
    everything = add(
        "all", "format, exploit and train", "landing", "lookup", "formatted", "exploitation"
    )
    for stage in (form, exploit, everything):
        stage.add_argument("--overwrite", action="store_true")
    form.add_argument("--only-given-years", action="store_true")
    exploit.add_argument("--input-format", choices=["parquet", "orc", "json"])

    train = add("train", "tune, fit, log and register the models")
    train.add_argument("--exploitation-path", required=True)
    train.add_argument("--model", choices=list(city.MODELS), action="append")
    for stage in (train, everything):
        stage.add_argument("--tracking-path", required=True)
        stage.add_argument("--all-null", choices=["raise", "drop", "zero"], default="raise")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """Run one stage.  A session that was passed in is not stopped."""
    logging.basicConfig(level=logging.INFO, format="%(name)s: %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    parser = _parser()
    args = parser.parse_args(argv)
    if args.stage == "land" and args.mode == "copy" and not args.landing_base:
        parser.error("land --mode copy needs --landing-base")
    session = spark or build_session(f"yearloom-{args.stage}")
    try:
        with scratch_scope(session):
            _run(session, args)
    finally:
        if spark is None:
            session.stop()


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.stage == "land" and args.mode == "preview":
        run_preview(spark, args.source_base)
    elif args.stage == "land":
        run_copy(spark, args.source_base, args.landing_base, args.overwrite)
    if args.stage in ("format", "all"):
        run_format(
            spark,
            args.landing_base,
            args.lookup_base,
            args.formatted_base,
            args.format,
            args.overwrite or getattr(args, "only_given_years", False),
            getattr(args, "only_given_years", False),
        )
    if args.stage in ("exploit", "all"):
        run_exploit(
            spark,
            args.formatted_base,
            args.exploitation_base,
            args.format,
            args.overwrite,
            getattr(args, "input_format", None),
        )
    if args.stage == "train":
        models = tuple(args.model or city.MODELS)
        run_train(
            spark, args.exploitation_path, args.tracking_path, models, args.all_null, args.format
        )
    if args.stage == "all":
        run_train(
            spark,
            args.exploitation_base,
            args.tracking_path,
            all_null=args.all_null,
            fmt=args.format,
        )
