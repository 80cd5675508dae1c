"""Command line: run the jobs on a session (``spark-submit`` or local).

    python -m wordfold top-words --input a.txt --input b.txt --output out/ [--k 100]
    python -m wordfold int-sum --table t.parquet --column x [--wrap32]
    python -m wordfold even-count --table t.parquet --column x
    python -m wordfold list --inventory inv.parquet [--path dir] --output out/
    python -m wordfold status --inventory inv.parquet --manifest man.parquet --output out/

Object-store inputs (``s3a://...``) take ``--s3a-endpoint`` (and optionally
``--s3a-ssl``); credentials come from the S3A provider chain, never from flags.
Scalar results are printed as one JSON line; tables are written as parquet.
Session settings of the library are defaults: what ``spark-submit --conf`` or the
session already sets is kept.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from wordfold.operators import even_count, int_sum, int_sum_wrap32, list_children, path_status
from wordfold.plans.jobs import write_top_words_report
from wordfold.session import defaults
from wordfold.sources import int_column
from wordfold.sources.object_store import as_spark_conf, s3a_options


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wordfold")
    p.add_argument("--master", help="Spark master (default: from spark-submit, else local[*])")
    p.add_argument("--s3a-endpoint", help="endpoint of an S3-compatible store")
    p.add_argument("--s3a-ssl", action="store_true", help="use HTTPS for the store")
    sub = p.add_subparsers(dest="command", required=True)

    tw = sub.add_parser("top-words", help="rank the k most frequent words of text files")
    tw.add_argument("--input", action="append", required=True, help="text file or directory (repeatable)")
    tw.add_argument("--output", required=True, help="directory for the report lines")
    tw.add_argument("--k", type=int, default=100)

    for name, text in (("int-sum", "sum an int column"), ("even-count", "count even values of an int column")):
        c = sub.add_parser(name, help=text)
        c.add_argument("--table", required=True, help="parquet path")
        c.add_argument("--column", required=True)
        if name == "int-sum":
            c.add_argument("--wrap32", action="store_true", help="wrap the sum to 32 bits")

    ls = sub.add_parser("list", help="delimiter listing over a key inventory (key, size[, mtime])")
    ls.add_argument("--inventory", required=True, help="parquet path")
    ls.add_argument("--path", default="", help="directory to list (default: root)")
    ls.add_argument("--output", required=True, help="parquet directory for the listing")

    st = sub.add_parser("status", help="file / empty_dir / dir / missing for every manifest key")
    st.add_argument("--inventory", required=True, help="parquet path")
    st.add_argument("--manifest", required=True, help="parquet path with a key column")
    st.add_argument("--key-column", default="key")
    st.add_argument("--output", required=True, help="parquet directory for the statuses")
    return p


def _session(args: argparse.Namespace) -> SparkSession:
    builder = SparkSession.builder.appName(f"wordfold-{args.command}")
    if args.master:
        builder = builder.master(args.master)
    for k, v in defaults(args.master).items():
        builder = builder.config(k, v)
    if args.s3a_endpoint:
        for k, v in as_spark_conf(s3a_options(args.s3a_endpoint, ssl=args.s3a_ssl)).items():
            builder = builder.config(k, v)
    return builder.getOrCreate()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or _session(args)
    if args.command == "top-words":
        out = write_top_words_report(spark, args.input, args.output, args.k)
        print(json.dumps({"report": out}))
    elif args.command in ("int-sum", "even-count"):
        ints = int_column(spark.read.parquet(args.table), args.column)
        if args.command == "even-count":
            result = {"even_count": even_count(ints).collect()[0][0]}
        elif args.wrap32:
            result = {"int_sum_wrap32": int_sum_wrap32(ints).collect()[0][0]}
        else:
            result = {"int_sum": int_sum(ints).collect()[0][0]}
        print(json.dumps(result))
    elif args.command == "list":
        listing = list_children(spark.read.parquet(args.inventory), args.path, strict=True)
        listing.write.mode("overwrite").parquet(args.output)
        print(json.dumps({"listing": args.output}))
    elif args.command == "status":
        statuses = path_status(spark.read.parquet(args.manifest), spark.read.parquet(args.inventory), args.key_column)
        statuses.write.mode("overwrite").parquet(args.output)
        print(json.dumps({"status": args.output}))
    return 0


if __name__ == "__main__":  # pragma: no cover
    sys.exit(main())
