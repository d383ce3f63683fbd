"""python -m meshloom.cli --config FILE prepare|extract|assemble|validate|replace"""

from __future__ import annotations

import argparse
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession

from . import config as configs
from .operators import validate
from .plans import modules, runs
from .sources import sinks, tables


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="meshloom")
    p.add_argument("--config", required=True)
    p.add_argument("--forcing-mode", choices=("legacy", "datm"))
    sub = p.add_subparsers(dest="command", required=True)
    e = sub.add_parser("extract", help="build module artifacts")
    e.add_argument("--build", nargs="+", default=["all"])
    e.add_argument("--changed-only", action="store_true", help="keep modules whose sources have not changed")
    e.add_argument("--batches", nargs="+", type=int, help="build only these batches of modules that are there")
    e.add_argument("--assemble", action="store_true")
    f = sub.add_parser("prepare", help="build consolidated forcing from monthly files (datm mode)")
    for c in (e, f):
        c.add_argument("--force-rebuild-forcing", action="store_true")
    a = sub.add_parser("assemble", help="join artifacts into the final dataset")
    a.add_argument("--overwrite", action="store_true")
    v = sub.add_parser("validate", help="check the final dataset")
    v.add_argument("--max-batches", type=int)
    v.add_argument("--sample-rows", type=int, default=20)
    r = sub.add_parser("replace", help="replace forcing columns of a final dataset")
    r.add_argument("--old", required=True)
    r.add_argument("--pattern", default="*")
    r.add_argument("--forcing", required=True, help="a NetCDF file (.nc) over time, lat and lon, or a folder with lat, lon and cube tables")
    r.add_argument("--column", action="append", default=[], metavar="NEW=OLD")
    r.add_argument("--out", required=True)
    r.add_argument("--records", help="folder for the log and the record of the run, the run file's output root by default")
    r.add_argument("--overwrite", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    config = configs.load(args.config)
    if args.forcing_mode:
        config = replace(config, mode=args.forcing_mode)
    spark = spark or SparkSession.builder.appName("meshloom").getOrCreate()
    if args.command in ("prepare", "extract"):
        s, wanted = modules.Sources(spark, config), "all" if args.command == "prepare" or args.build == ["all"] else args.build
        if config.mode == "datm":
            s = runs.with_prepared_forcing(s, wanted, args.force_rebuild_forcing)
        if args.command == "prepare":
            return 0
        built = runs.extract(s, wanted, not args.changed_only, args.batches)
        lines = [f"built {b}" for b in built] + s.warnings
        sinks.write_log(spark, config.output, lines)
        sinks.write_record(spark, config.output, sinks.source_lines(spark, runs.source_paths(config)) + lines)
        if args.assemble:
            runs.write_dataset(spark, config, overwrite=True)
        return 0
    if args.command == "assemble":
        for name in runs.write_dataset(spark, config, args.overwrite):
            print(f"missing: {name}")
        return 0
    if args.command == "validate":
        findings = runs.validate_dataset(spark, config, args.max_batches, args.sample_rows)
        for r in findings.orderBy("batch_id", "check").limit(1000).toLocalIterator():
            print(f"{r.severity}: batch {r.batch_id}, {r.check}: {r.detail}")
        return validate.exit_code(findings)
    old = tables.final_dataset(spark, args.old, args.pattern)
    out, columns = runs.replace_from(spark, old, args.forcing, dict(c.split("=", 1) for c in args.column))
    paths = {"final dataset": args.old, "forcing": args.forcing}
    lines = sinks.source_lines(spark, paths, tuple(columns.values())) + [f"config {x}" for x in Path(args.config).read_text().splitlines() if x.strip()]
    sources = [sinks.source_entry(spark, p) for p in paths.values()]
    sinks.write_final(out, args.out, args.overwrite)
    n = spark.read.parquet(args.out).count()
    sinks.write_manifest(spark, f"{args.out.rstrip('/')}_manifest", "replace", sources, columns=columns, out=args.out, rows=n)
    done = [f"replaced {new} by {there}" for new, there in columns.items()] + [f"wrote {n} rows to {args.out}"]
    root = args.records or config.output
    sinks.write_log(spark, root, done)
    sinks.write_record(spark, root, lines + done)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
