"""Command line: ``setup`` writes the product config seed, ``create`` builds the models.

    python -m tallyspark.plans.cli setup  --billing DIR --config DIR [--force]
    python -m tallyspark.plans.cli create --billing DIR --out DIR [--config DIR]
                                          [--as-of YYYY-MM-DD] [--model NAME]
                                          [--force] [--no-cache] [--retain-hours H]

``setup`` fails if there is a config already, unless ``--force``. ``create`` builds the
model graph in order, writes every model as a Parquet table under ``--out/models`` and
exports the two public metric tables as CSV under ``--out/exports``. A stored table is kept
only while its as-of date, config and inputs are the same; ``--force`` rebuilds all.
``--model`` builds up to that model, by force, and stops. ``--no-cache`` skips keeping
updated models in memory, and frees what this application has kept of older versions. A version
that a newer one replaced more than ``--retain-hours`` ago (default 24) is deleted.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from tallyspark.plans import sinks
from tallyspark.plans.models import ModelSet
from tallyspark.session import get_session
from tallyspark.sources.readers import read_billing_tables, read_table, seed_product_config

EXPORTS = ("exported_quarterly_metrics", "exported_latest_metrics")


def setup(args: argparse.Namespace) -> None:
    """Write the default product config (every product main, its own name) for editing."""
    spark = get_session()
    product = read_table(spark, args.billing, "product", args.format)
    mode = "overwrite" if args.force else "error"
    seed_product_config(product).write.mode(mode).option("header", True).csv(args.config)
    print(f"wrote product config to {args.config}; edit names / is_main_product, then run create")


def create(args: argparse.Namespace) -> None:
    spark = get_session()
    config = None
    if args.config:
        config = (spark.read.option("header", True)
                  .schema("product_id string, name string, is_main_product boolean")
                  .csv(args.config))
    tables = read_billing_tables(spark, args.billing, args.format, product_config=config)
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else dt.date.today()
    ms = ModelSet(tables, as_of, folder=f"{args.out}/models", force=args.force or bool(args.model),
                  cache=not args.no_cache, retain=args.retain_hours * 3600,
                  materialize=[n for n in ModelSet.NAMES if n not in EXPORTS])
    names = ms.names
    if args.model:
        names = names[:names.index(args.model) + 1]
    for name in names:
        df = ms.model(name)
        if name in EXPORTS:
            sinks.export_csv(df, f"{args.out}/exports/{name}", single_file=True)
            print(f"* {name}: {args.out}/exports/{name}")
        else:
            print(f"* {name}: {ms.table_path(name)}")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tallyspark")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("setup", help="write the default product config")
    s.add_argument("--billing", required=True)
    s.add_argument("--config", required=True)
    s.add_argument("--format", default="parquet")
    s.add_argument("--force", action="store_true")
    c = sub.add_parser("create", help="build the models and exports")
    c.add_argument("--billing", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--config")
    c.add_argument("--format", default="parquet")
    c.add_argument("--as-of")
    c.add_argument("--model")
    c.add_argument("--force", action="store_true")
    c.add_argument("--no-cache", action="store_true")
    c.add_argument("--retain-hours", type=float, default=sinks.RETAIN_SECONDS / 3600)
    args = p.parse_args(argv)
    (setup if args.cmd == "setup" else create)(args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
