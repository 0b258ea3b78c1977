"""Jobs for spark-submit.

``preprocess``, ``profile``, ``train`` and ``compare``; ``evaluate`` all saved models on one split; ``score`` requests by
one model or by all; ``explain`` them by a tree model. Models are given as NAME=PATH.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from lotwise import schema as S
from lotwise.ml.metrics import model_comparison
from lotwise.ml.models import KINDS, load_model
from lotwise.operators.association import association_matrix
from lotwise.operators.market import lookup_table
from lotwise.operators import profile as R
from lotwise.operators.chartdata import box_stats
from lotwise.plans.fitted import split_and_fit
from lotwise.plans.preprocess import preprocess
from lotwise.plans import evaluation as E
from lotwise.plans.scoring import score, score_all_models
from lotwise.plans.training import prepare_split, train_model
from lotwise.sources.listings import read_clean, read_raw, with_listing_id, write_clean
from lotwise.sources.results import read_metrics, write_lookup_json, write_result
from lotwise.sources.staging import drop_staged


def read_listings(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Listings with their key; a CSV file has the eight columns without it."""
    if fmt == "csv":
        without_key = S.StructType([f for f in S.RAW if f.name != S.ID])
        return with_listing_id(read_raw(spark, path, without_key))
    table = read_clean(spark, path)
    return table if S.ID in table.columns else with_listing_id(table)


def _tell(errors: dict[str, str]) -> None:
    for name, error in errors.items():
        print(f"{name} was left out: {error.splitlines()[0] if error else ''}")


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "compare":
        write_result(model_comparison(read_metrics(spark, args.metrics)), args.output)
        return
    if args.job == "score":
        requests = read_clean(spark, args.input)
        scored = score(load_model(args.model), args.name or args.model, requests, read_clean(spark, args.lookup))
        write_result(scored, args.output)
        return
    if args.job in ("score-all", "explain"):
        requests, lookup = read_clean(spark, args.input), read_clean(spark, args.lookup)
        models, errors = E.load_models(dict(m.split("=", 1) for m in args.model))
        if args.job == "score-all":
            scored, failed = score_all_models(models, requests, lookup)
            write_result(scored, args.output)
            errors |= failed
        else:
            for name, model in models.items():
                parts = E.explain_requests(model, requests, lookup)
                if parts is not None:
                    write_result(parts, f"{args.output}/{name}")
        _tell(errors)
        return
    raw = read_listings(spark, args.input, args.format)
    if args.job == "preprocess":
        write_clean(preprocess(raw), f"{args.output}/clean")
        lookup = lookup_table(raw)
        write_result(lookup, f"{args.output}/lookup")
        write_lookup_json(lookup, f"{args.output}/lookup_json")
    elif args.job == "profile":
        write_result(R.describe_all(raw.drop(S.ID), approx=args.approx), f"{args.output}/describe")
        parts = {
            "summary": R.profile_summary(raw), "nulls": R.null_counts(raw), "unique": R.nunique(raw, args.approx),
            "top_values": R.top_k_values(raw), "skew": R.skew_report(raw), "outliers": R.iqr_outlier_count(raw, approx=args.approx),
            "dependency": R.fd_check(raw), "group_sizes": R.group_size_profile(raw), "rare": R.rare_category_pct(raw),
            "boxes": box_stats(raw, S.numeric_columns(raw.drop(S.ID).schema)),
        }
        for name, part in parts.items():
            write_result(part, f"{args.output}/{name}")
        write_result(association_matrix(raw), f"{args.output}/association")
    elif args.job == "evaluate":
        models, errors = E.load_models(dict(m.split("=", 1) for m in args.model))
        predicted, failed = E.predict_all(models, prepare_split(raw))
        for name, part in (("predictions", predicted), ("residuals", E.residuals_of(predicted)), ("ranges", E.ranges_of(predicted)),
                           ("trends", E.trends_of(predicted)), ("metrics", E.metrics_of(predicted))):
            write_result(part, f"{args.output}/{name}")
        _tell(errors | failed)
    elif args.job == "train":
        if args.fit_on == "train":
            # The statistics are stored beside the model: requests with raw values are cleaned by them.
            split, fitted = split_and_fit(raw)
            fitted.save(f"{args.output}_preprocessor")
        else:
            split = prepare_split(raw)
        done = train_model(
            split, args.kind, tune=not args.no_search, metrics_path=args.metrics, model_path=args.output
        )
        if done.report is not None:
            done.report.orderBy("mean_r2").show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lotwise", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("preprocess", "profile", "train", "evaluate"):
        job = jobs.add_parser(name)
        job.add_argument("--input", required=True)
        job.add_argument("--format", choices=("csv", "parquet"), default="parquet")
        job.add_argument("--output", required=True)
    jobs.choices["profile"].add_argument("--approx", action="store_true", help="quantiles from a sketch")
    jobs.choices["train"].add_argument("--kind", choices=KINDS, required=True)
    jobs.choices["train"].add_argument("--metrics", required=True)
    jobs.choices["train"].add_argument("--no-search", action="store_true")
    jobs.choices["train"].add_argument("--fit-on", choices=("all", "train"), default="all", help="rows the preprocessing is fitted on")
    compare = jobs.add_parser("compare")
    compare.add_argument("--metrics", required=True)
    compare.add_argument("--output", required=True)
    scoring = jobs.add_parser("score")
    for option in ("--model", "--input", "--lookup", "--output"):
        scoring.add_argument(option, required=True)
    scoring.add_argument("--name", help="name of the model in the output")
    several = [jobs.choices["evaluate"]]
    for name in ("score-all", "explain"):
        several.append(jobs.add_parser(name))
        for option in ("--input", "--lookup", "--output"):
            several[-1].add_argument(option, required=True)
    for job in several:
        job.add_argument("--model", action="append", required=True, help="NAME=PATH, as often as there are models")
    spark = SparkSession.builder.appName("lotwise").getOrCreate()
    try:
        run(spark, parser.parse_args(argv))
    finally:
        drop_staged(spark)


if __name__ == "__main__":
    main()
