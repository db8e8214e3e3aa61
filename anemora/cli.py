"""Command line: compute_resource, compute_uncensored_resource, validate_reference."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import functions as F

from anemora import config
from anemora.plans import stages
from anemora.session import build_session
from anemora.sources import files, sinks, stac
from anemora.sources.readers import ObservationFilter, read_observations, read_reference


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="anemora")
    parser.add_argument("--master", help="Spark master; leave out under spark-submit")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.add_argument("--dataset", required=True, help="Parquet path, or a key of --catalog")
        sub.add_argument("--catalog", help="STAC catalogue index")
        sub.add_argument("--output", required=True)
        sub.add_argument("--settings", help="JSON file with option values")
        sub.add_argument("--replicas", type=int, default=500)
        sub.add_argument("--seed", type=int, default=0)
        sub.add_argument("--nodes", nargs="*")
        return sub

    resource = command("compute_resource")
    resource.add_argument("--stages", nargs="*")
    resource.add_argument("--skip", nargs="*", default=[])
    resource.add_argument("--height-method", choices=("none", "log", "power"), default="none")
    resource.add_argument("--target-height", type=float)
    resource.add_argument("--max-nodes", type=int, help="first nodes by name only")
    resource.add_argument("--tie", help="column that orders records of equal time")
    resource.add_argument("--ci-method", choices=("percentile", "bca", "percentile_t"), default="percentile")
    resource.add_argument("--resampling", choices=("iid", "moving_block", "stationary"), default="iid")
    resource.add_argument("--block-length", type=int, default=1)
    resource.add_argument("--block-lengths", help="table with node_id and block_length")
    resource.add_argument("--rmse-mode", choices=("velocity", "power", "none"), default="velocity")
    resource.add_argument("--lower", type=float, default=config.RangeThresholds().lower)
    resource.add_argument("--upper", type=float, default=config.RangeThresholds().upper)
    series = command("compute_uncensored_resource")
    series.add_argument("--node-column")
    series.add_argument("--speed-column", default="wind_speed")
    series.add_argument("--rmse", type=float, default=0.0)
    validate = command("validate_reference")
    validate.add_argument("--reference", required=True)
    validate.add_argument("--tolerance-minutes", type=float, default=30.0)
    validate.add_argument("--exact-only", action="store_true")
    return parser


def _path(spark, args: argparse.Namespace) -> str:
    return stac.resolve_dataset(spark, args.catalog, args.dataset).readable() if args.catalog else args.dataset


def main(argv: Sequence[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    if getattr(args, "settings", None):
        parser.set_defaults(**config.read_json(args.settings))
        args = parser.parse_args(argv)
    spark = build_session(master=args.master)
    if args.command == "compute_resource":
        keep = ObservationFilter(include=args.nodes) if args.nodes else None
        obs = read_observations(spark, _path(spark, args), keep=keep)
        if args.max_nodes:
            first = obs.select("node_id").distinct().orderBy("node_id").limit(args.max_nodes)
            obs = obs.join(first, "node_id", "left_semi")
        height = config.Height(args.height_method, 10.0, args.target_height or config.PowerCurve().hub_height_m)
        bounds = config.RangeThresholds(args.lower, args.upper)
        options = stages.ResourceOptions(bounds=bounds, height=height, tie=args.tie, bootstrap=config.BootstrapConfig(
            replicas=args.replicas, seed=args.seed, speed_scale=height.scale, ci_method=args.ci_method, resampling=args.resampling,
            block_length=args.block_length, rmse_mode=args.rmse_mode, apply_rmse_noise=args.rmse_mode != "none", thresholds=bounds))
        settings = spark.read.parquet(args.block_lengths) if args.block_lengths else None
        tables = stages.compute_resource(obs, options, args.stages, args.skip, settings)
    elif args.command == "compute_uncensored_resource":
        rows = read_observations(spark, _path(spark, args))
        if args.nodes and args.node_column:
            rows = rows.where(F.col(args.node_column).isin(args.nodes))
        tables = {"uncensored": stages.uncensored_resource(
            rows, node=args.node_column, speed=args.speed_column, rmse=args.rmse, replicas=args.replicas, seed=args.seed)}
    else:
        keep = ObservationFilter(include=args.nodes) if args.nodes else None
        tables = stages.validate_reference(
            read_observations(spark, _path(spark, args), keep=keep), read_reference(spark, args.reference),
            tolerance_seconds=60 * args.tolerance_minutes, prefer_nearest=not args.exact_only)
    for name, table in tables.items():
        sinks.write_parquet(table, f"{args.output}/{name}")
    files.write_json(spark, files.join(args.output, "run.json"), {k: v for k, v in vars(args).items() if k != "master"})
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
