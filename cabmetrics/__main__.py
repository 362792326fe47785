"""Command line: clean, train, evaluate, tune and save in one Spark session.

    python -m cabmetrics --trips hdfs:///.../trips --format parquet --out hdfs:///.../run1
    python -m cabmetrics --trips trips.csv --format csv --out /tmp/run1 --master "local[8]"

(On a cluster, run it on the driver with the session settings of the
deployment; ``--master`` is only for local runs.)
"""

from __future__ import annotations

import argparse
import json

from .plans.workflow import run_workflow
from .schema import TuningProfile
from .session import get_session
from .sources.trips import read_trips


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="cabmetrics", description=__doc__.splitlines()[0])
    ap.add_argument("--trips", required=True, help="trip table (parquet directory or CSV with header)")
    ap.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--sample-size", type=int, default=None, help="stable pre-training sample (default: all rows)")
    ap.add_argument("--num-trees", type=int, nargs="+", default=list(TuningProfile().num_trees), help="forest sizes of the grid")
    ap.add_argument("--max-depth", type=int, nargs="+", default=list(TuningProfile().max_depth), help="depths of the grid")
    ap.add_argument("--no-clean", action="store_true", help="only drop rows with missing values (parity with the reference's models)")
    ap.add_argument("--run-id", default=None, help="identifier stamped on every written table")
    ap.add_argument("--master", default=None, help="only for local runs; a cluster launcher sets it")
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    tuning = TuningProfile(num_trees=tuple(args.num_trees), max_depth=tuple(args.max_depth))
    res = run_workflow(
        spark,
        read_trips(spark, args.trips, fmt=args.format),
        args.out,
        tuning=tuning,
        sample_size=args.sample_size,
        clean=not args.no_clean,
        run_id=args.run_id,
    )
    summary = {
        "run_id": res.run_id,
        "stage_counts": [r.asDict() for r in res.stage_counts.orderBy("stage_no").collect()],
        "metrics": [r.asDict() for r in res.ranking.collect()],
        "tuning": [r.asDict() for r in res.comparison.collect()],
        "paths": res.paths,
    }
    print(json.dumps(summary, default=str))
    return summary


if __name__ == "__main__":
    main()
