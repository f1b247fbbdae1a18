"""Command line: python -m maskwright COMMAND.  Storage may be any that Spark reads; set spark.checkpoint.dir on a cluster."""

from __future__ import annotations

import argparse
import json
import sys


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("maskwright").getOrCreate()


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="maskwright")
    todo = parser.add_subparsers(dest="command", required=True)
    todo.add_parser("list", help="names of the queries")
    for name, text in (("run", "run a query over a data folder"), ("explain", "show a query's plan")):
        p = todo.add_parser(name, help=text)
        p.add_argument("query")
        p.add_argument("data")
        if name == "run":
            p.add_argument("--out", help="folder for Parquet; without it the first rows are shown")
    p = todo.add_parser("release", help="write the views of the rich export")
    p.add_argument("data")
    p.add_argument("out")
    p.add_argument("--shard-rows", type=int, default=100)
    p = todo.add_parser("merge-shards", help="merge the streams of a sharded stage")
    p.add_argument("folder")
    p.add_argument("stage", choices=("caption", "mask-review"))
    p.add_argument("shards", type=int)
    p = todo.add_parser("registry", help="show a campaign's registry")
    p.add_argument("root")
    p = todo.add_parser("checksums", help="SHA-256 of each file below a path")
    p.add_argument("path")
    p = todo.add_parser("signature", help="one digest over the files below a path")
    p.add_argument("path")
    p = todo.add_parser("config", help="show a configuration with what it extends")
    p.add_argument("path")
    a = parser.parse_args(args)

    from . import registry

    if a.command == "list":
        print("\n".join(sorted(registry.queries())))
        return 0
    spark = _session()
    if a.command in ("run", "explain"):
        if a.query not in (known := registry.queries()):
            print(f"no query {a.query!r}; see list", file=sys.stderr)
            return 2
        df = known[a.query](spark, a.data)
        if a.command == "explain":
            df.explain("formatted")
        elif a.out:
            df.write.mode("overwrite").parquet(a.out)
        else:
            df.show(20, False)
    elif a.command == "release":
        from .plans.release import _tables, write_release

        print(json.dumps(write_release(_tables(spark, a.data), a.out, a.shard_rows)["histograms"], sort_keys=True))
    elif a.command == "merge-shards":
        from .operators.captions import merged_shards
        from .sources.sinks import write_jsonl

        for name, df in merged_shards(spark, a.folder, a.stage, a.shards).items():
            write_jsonl(df, f"{a.folder}/{name}")
            print(name)
    elif a.command == "registry":
        from .operators.campaign import load_registry

        print(json.dumps(load_registry(spark, a.root), indent=2, sort_keys=True))
    elif a.command == "config":
        from .sources.config import load_config

        print(json.dumps(load_config(spark, a.path), indent=2, sort_keys=True))
    else:
        from .sources.sinks import checksums, source_signature

        if a.command == "signature":
            print(source_signature(spark, a.path))
        else:
            for r in checksums(spark, a.path).orderBy("path").toLocalIterator():
                print(f"{r['sha256']}  {r['path']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
