"""Run one registered query and write its result as a table.

    python -m relevo.plans.cli QUERY SF_DIR OUT [--format csv|parquet] [--mode errorifexists|overwrite]

Uses the active session's configuration when launched with spark-submit; standalone it starts a
local session. Output is written by every task in parallel (multi-part).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from relevo.plans import registry
from relevo.session import apply_cluster_conf, apply_skew_conf, ensure_checkpoint_dir, remove_shared_tables
from relevo.sinks.csv import write_csv


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("query", choices=sorted(registry.RESULTS))
    ap.add_argument("sf_dir")
    ap.add_argument("out")
    ap.add_argument("--format", choices=["csv", "parquet"], default="parquet")
    ap.add_argument("--mode", default="errorifexists")
    ap.add_argument("--input-bytes", type=int, default=None, help="input volume, to size a cluster run")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"relevo-{args.query}").getOrCreate()
    ensure_checkpoint_dir(spark)
    apply_skew_conf(spark)
    apply_cluster_conf(spark, args.input_bytes)
    try:
        df = registry.RESULTS[args.query](spark, args.sf_dir)
        if args.format == "csv":
            arrays = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
            write_csv(df.withColumns({c: F.to_json(c) for c in arrays}), args.out, mode=args.mode)
        else:
            df.write.mode(args.mode).parquet(args.out)
    finally:
        remove_shared_tables(spark)


if __name__ == "__main__":
    main()
