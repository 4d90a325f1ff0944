"""Command line: ``python -m custofold INPUT --base FOLDER [--tag dataset=TAG ...]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from custofold.plans.batch import BatchConfig, run
from custofold.schemas import DATASETS, Tags
from custofold.sources import Store


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="custofold", description="Build customer documents from one landing batch.")
    parser.add_argument("input_path", help="JSON lines file or folder")
    parser.add_argument("--base", default="", help="folder of the tables (file formats)")
    parser.add_argument("--format", default="parquet", help="storage format or connector name")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="connector option")
    parser.add_argument("--target", default="documents", help="table the documents are added to")
    parser.add_argument("--lookup", default="value_sets", help="value-set table")
    parser.add_argument("--shape", choices=["array", "rows"], default="array")
    parser.add_argument("--tag", action="append", default=[], metavar="DATASET=TAG", help="tag of a dataset")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("custofold").getOrCreate()
    tags = Tags({**{name: name for name in DATASETS}, **_pairs(args.tag)})
    store = Store(spark, args.base, args.format, _pairs(args.option))
    run(spark, BatchConfig(args.input_path, args.target, args.lookup, tags, shape=args.shape), store)


if __name__ == "__main__":
    main()
