"""Command line: the four steps of the city job.

    python -m citylake format    --lookup L --listings I --facilities M --income C --formatted ROOT
    python -m citylake exploit   --formatted ROOT --exploitation ROOT
    python -m citylake train     --exploitation ROOT [--seed 42] [--model-out PATH]
    python -m citylake dashboard --exploitation ROOT --out ROOT

Each step uses the session from the launcher (spark-submit settings apply); ``--master`` is only for
local runs.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="citylake")
    p.add_argument("--master", default=None, help="only for local runs; clusters take it from spark-submit")
    sub = p.add_subparsers(dest="cmd", required=True)
    f = sub.add_parser("format", help="landing documents -> formatted zone")
    for a in ("lookup", "listings", "facilities", "income", "formatted"):
        f.add_argument(f"--{a}", required=True)
    e = sub.add_parser("exploit", help="formatted zone -> model_data (upsert) and marts")
    e.add_argument("--formatted", required=True)
    e.add_argument("--exploitation", required=True)
    t = sub.add_parser("train", help="random forest on model_data; prints test error")
    t.add_argument("--exploitation", required=True)
    t.add_argument("--seed", type=int, default=42)
    t.add_argument("--model-out", default=None)
    d = sub.add_parser("dashboard", help="the data behind the four charts, written as parquet")
    d.add_argument("--exploitation", required=True)
    d.add_argument("--out", required=True)
    args = p.parse_args(argv)

    from citylake.plans import city, ml
    from citylake.session import get_spark
    from citylake.sources.zone import Zone

    spark = get_spark(args.master, app=f"citylake-{args.cmd}")
    if args.cmd == "format":
        out = city.format_zone(spark, city.LandingPaths(lookup=args.lookup, listings=args.listings,
                                                        facilities=args.facilities, income=args.income),
                               Zone(spark, args.formatted))
    elif args.cmd == "exploit":
        out = city.exploitation_zone(Zone(spark, args.formatted), Zone(spark, args.exploitation))
    elif args.cmd == "train":
        data = Zone(spark, args.exploitation).read("model_data")
        model, _, test_df = ml.train(data, seed=args.seed)
        ev = ml.evaluate(ml.predict(model, test_df)).first()
        out = {"accuracy": ev.accuracy, "test_error": ev.test_error, "n_test": ev.n_test,
               "forest": str(ml.forest(model))}
        if args.model_out:
            model.write().overwrite().save(args.model_out)
            out["model"] = args.model_out
    else:
        zone = Zone(spark, args.exploitation)
        target = Zone(spark, args.out)
        out = {name: target.overwrite(df, name) for name, df in city.dashboard_data(zone).items()}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
