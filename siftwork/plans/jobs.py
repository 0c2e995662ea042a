"""Jobs for ``spark-submit``: prepare, clean, train, evaluate, tune."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftwork.functions import presets
from siftwork.functions.aliases import COUNTRY_ALIASES
from siftwork.functions.columns import col, nan_to_null, require_columns
from siftwork.functions.labels import iso_entries, strict_entries
from siftwork.operators.classify import GRIDS, NAMES, Classifier
from siftwork.operators.lookup import clean_column
from siftwork.operators.missing import MissingValueHandler, report_row
from siftwork.operators.profile import missing_profile, wide_text_columns
from siftwork.operators.split import assign_split, sample_exact, split_metadata
from siftwork.operators.train import SearchResult, TrainedModel, grid_search
from siftwork.plans.prepare import fit_preparation, preparation
from siftwork.sources.delimited import (
    header_of,
    land,
    land_once,
    landed_before,
    product_schema,
    scan_delimited,
    select_wanted,
    valid_class,
)
from siftwork.sources.documents import landing_document, write_document
from siftwork.sources.shared import stage
from siftwork.sources.splits import load_split, save_splits

KEY = "code"


def landing_job(
    spark: SparkSession, raw: str, out: str, sample: int | None = None, partitions: int | None = None
) -> DataFrame:
    """Raw product file -> filtered parquet, and the landing document; nothing happens if ``out`` exists."""
    if landed_before(spark, out):
        return spark.read.parquet(out)
    header = header_of(spark, raw)
    # Parsed once: a gzip file keeps one task busy, and rows and totals are both needed.
    table = stage(select_wanted(scan_delimited(spark, raw, product_schema(header), partitions=partitions)), "landing")
    kept = land(table)
    if sample is not None:
        kept = sample_exact(kept, KEY, sample)
    land_once(kept, out)
    missing = [c for c in presets.RELEVANT_COLUMNS if c not in header]
    existing = [c for c in presets.RELEVANT_COLUMNS if c in header]
    origin = {"data_source": raw, "download_date": datetime.now().strftime("%Y-%m-%d %H:%M:%S")}
    sampled = spark.read.parquet(out) if sample is not None else None
    document = landing_document(table, valid_class(), presets.TARGET, existing, missing, origin, sampled)
    write_document(document, f"{out}_metadata")
    return spark.read.parquet(out)


def prepare_table(df: DataFrame, split_first: bool = True, ratios=(0.7, 0.15, 0.15), **options) -> DataFrame:
    """A prepared, split table. The split comes first so that only train rows shape the parameters."""
    table = df.withColumn(presets.TARGET, F.lower(col(presets.TARGET)))
    flow = preparation(**options)
    if split_first:
        divided = stage(assign_split(table, presets.TARGET, KEY, *ratios), "divided")
        return fit_preparation(flow, divided).transform(divided)
    prepared = stage(flow.fit(table).transform(table), "prepared")
    return assign_split(prepared, presets.TARGET, KEY, *ratios)


def prepare_job(spark: SparkSession, source: str, out: str, eda_only: bool = False, **options) -> dict[str, str]:
    df = nan_to_null(spark.read.parquet(source))
    require_columns(df, [presets.TARGET, KEY])
    if eda_only:
        preparation(**options).fit(df).transform(df).write.mode("overwrite").parquet(f"{out}/eda")
        return {"eda": f"{out}/eda"}
    prepared = prepare_table(df, **options)
    folders = save_splits(prepared, f"{out}/splits")
    written = spark.read.parquet(f"{out}/splits")
    write_document(split_metadata(written, presets.TARGET, {}), f"{out}/split_metadata")
    return folders


def clean_table(df: DataFrame, iso_names: dict[str, str] | None = None):
    """The stand-alone cleaning path: impute, strict country lists, redundant and too-wide columns away."""
    handler = MissingValueHandler().fit(df)
    out = handler.transform(df)
    if "countries" in out.columns:
        out = clean_column(out, "countries", strict_entries(iso_names or {}, COUNTRY_ALIASES))
    gone = [presets.REDUNDANT_COLUMN] if presets.REDUNDANT_COLUMN in out.columns else []
    gone += wide_text_columns(out, presets.WIDE_TEXT_COLUMNS, presets.WIDE_TEXT_LIMIT)
    return out.drop(*gone), handler


def country_names(spark: SparkSession, path: str, codes: Sequence[str] = (), name: str = "name") -> dict[str, str]:
    """Lookup entries from a country table (Parquet, or delimited with a header); by default every other column is a code."""
    table = spark.read.option("header", True).csv(path) if path.endswith((".csv", ".csv.gz")) else spark.read.parquet(path)
    require_columns(table, [name, *codes])
    return iso_entries(table, list(codes) or [c for c in table.columns if c != name], name)


def clean_job(
    spark: SparkSession,
    source: str,
    out: str,
    report: str | None = None,
    countries: str | None = None,
    codes: Sequence[str] = (),
    name: str = "name",
) -> None:
    """The stand-alone cleaning of a table; ``countries`` is the path of the country table for strict lists."""
    df = nan_to_null(spark.read.parquet(source))
    cleaned, handler = clean_table(df, country_names(spark, countries, codes, name) if countries else None)
    cleaned.write.mode("overwrite").parquet(out)
    if report:
        write_document(report_row(handler, missing_profile(df), 0.95), report)


def train_job(spark: SparkSession, splits: str, out: str, model: str, folds: int = 5, **params) -> TrainedModel:
    train, val = load_split(spark, splits, "train"), load_split(spark, splits, "val")
    trained = TrainedModel(Classifier(model, label=presets.TARGET, key=KEY, **params))
    trained.train(train, val, folds, KEY)
    trained.save(out, spark)
    return trained


def evaluate_job(spark: SparkSession, splits: str, saved: str, split: str = "test"):
    """Metrics, per-class report and confusion matrix of a saved model on one split."""
    model, data = TrainedModel.load(saved, spark), load_split(spark, splits, split)
    return model.evaluate(data, split), model.report(data), model.matrix(data)


def tune_job(spark: SparkSession, splits: str, out: str, model: str, folds: int = 5) -> SearchResult:
    train = load_split(spark, splits, "train")
    found = grid_search(train, Classifier(model, label=presets.TARGET, key=KEY), GRIDS[model], KEY, folds)
    write_document(found.document(spark), f"{out}/{model}_tuning")
    return found


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="siftwork jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    landing = jobs.add_parser("land")
    landing.add_argument("--raw", required=True)
    landing.add_argument("--sample", type=int)
    landing.add_argument("--partitions", type=int)
    prepare = jobs.add_parser("prepare")
    prepare.add_argument("--no-pca", action="store_true")
    prepare.add_argument("--scale-method", choices=["standard", "minmax", "robust", "auto"], default="standard")
    prepare.add_argument("--remove-outliers", action="store_true")
    prepare.add_argument("--eda-only", action="store_true")
    prepare.add_argument("--no-scaling", action="store_true")
    prepare.add_argument("--no-encoding", action="store_true")
    prepare.add_argument("--no-feature-engineering", action="store_true")
    clean = jobs.add_parser("clean")
    clean.add_argument("--report")
    clean.add_argument("--countries", help="country table: Parquet, or delimited with a header")
    clean.add_argument("--country-codes", default="", help="its code columns, separated by commas")
    clean.add_argument("--country-name", default="name", help="its name column")
    for name in ("train", "evaluate", "tune"):
        job = jobs.add_parser(name)
        job.add_argument("--model", choices=sorted(NAMES), required=name != "evaluate")
        job.add_argument("--folds", type=int, default=5)
        job.add_argument("--params", type=json.loads, default={}, help="hyperparameters as JSON")
        job.add_argument("--saved")
        job.add_argument("--split", default="test")
    for job in jobs.choices.values():
        job.add_argument("--input")
        job.add_argument("--output")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"siftwork-{args.job}").getOrCreate()
    if args.job == "land":
        landing_job(spark, args.raw, args.output, args.sample, args.partitions)
    elif args.job == "prepare":
        prepare_job(
            spark,
            args.input,
            args.output,
            args.eda_only,
            **{
                **presets.SCRIPT_DEFAULTS,
                "scaling_method": args.scale_method,
                "statistical_outliers": args.remove_outliers,
                "include_pca": not args.no_pca,
                "include_scaling": not args.no_scaling,
                "include_encoding": not args.no_encoding,
                "include_features": not args.no_feature_engineering,
            },
        )
    elif args.job == "clean":
        codes = [c for c in args.country_codes.split(",") if c]
        clean_job(spark, args.input, args.output, args.report, args.countries, codes, args.country_name)
    elif args.job == "train":
        train_job(spark, args.input, args.output, args.model, args.folds, **args.params)
    elif args.job == "evaluate":
        metrics, report, matrix = evaluate_job(spark, args.input, args.saved, args.split)
        print(json.dumps(metrics, indent=2))
        report.show(truncate=False)
        matrix.show(truncate=False)
    else:
        tune_job(spark, args.input, args.output, args.model, args.folds)


if __name__ == "__main__":
    main()
