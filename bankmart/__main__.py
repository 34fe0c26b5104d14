"""Command line: run the daily batch or any registered query as a job.

  python -m bankmart daily --input DIR --warehouse DIR [--as-of YYYY-MM-DD]
                           [--batch-id ID] [--no-abort] [--tune] [--local N]
  python -m bankmart query KEY --input DIR [--warehouse DIR] [--out PATH | --show N]
                           [--local N]
  python -m bankmart list

Without ``--local`` the session is the one the platform provides
(``spark-submit``); with it a local session with N cores is built.
"""

from __future__ import annotations

import argparse
import json
from datetime import date, datetime


def _session(local):
    if local:
        from bankmart.session import build_session
        return build_session(cores=local)
    from pyspark.sql import SparkSession
    return SparkSession.builder.appName("bankmart").getOrCreate()


def _config(args):
    from bankmart.config import RunConfig
    as_of = date.fromisoformat(args.as_of) if args.as_of else RunConfig().as_of
    run_ts = datetime.combine(as_of, datetime.min.time())
    batch_id = args.batch_id or as_of.strftime("%Y%m%d") + "_000000"
    return RunConfig(as_of=as_of, run_ts=run_ts, batch_id=batch_id,
                     abort_on_failure=not getattr(args, "no_abort", False))


def main(argv=None):
    p = argparse.ArgumentParser(prog="bankmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily", help="Bronze → Silver → DQ gate → Gold → serving")
    d.add_argument("--input", required=True)
    d.add_argument("--warehouse", required=True)
    d.add_argument("--as-of")
    d.add_argument("--batch-id")
    d.add_argument("--no-abort", action="store_true")
    d.add_argument("--tune", action="store_true")
    d.add_argument("--local")
    q = sub.add_parser("query", help="run one registered query")
    q.add_argument("key")
    q.add_argument("--input", required=True)
    q.add_argument("--as-of")
    q.add_argument("--batch-id")
    q.add_argument("--warehouse", help="run on the tables a daily batch wrote there")
    q.add_argument("--out")
    q.add_argument("--show", type=int, default=20)
    q.add_argument("--local")
    sub.add_parser("list", help="list registered query keys")
    args = p.parse_args(argv)

    if args.cmd == "list":
        from bankmart.plans import catalogue
        catalogue.queries()
        print("\n".join(sorted(catalogue.QUERIES)))
        return
    spark = _session(args.local)
    cfg = _config(args)
    if args.cmd == "daily":
        from bankmart.plans import daily
        res = daily.run(spark, args.input, args.warehouse, cfg, tune=args.tune)
        print(json.dumps({"paths": res.paths, "dq": res.dq}, default=str))
    else:
        from bankmart.plans import catalogue
        if args.warehouse:
            from bankmart.plans.lake import Lake
            catalogue.queries(cfg)
            lake = Lake.from_warehouse(spark, args.warehouse, cfg, sf_dir=args.input)
            df = catalogue.display_form(catalogue.QUERIES[args.key](lake))
        else:
            df = catalogue.queries(cfg)[args.key](spark, args.input)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(args.show, truncate=False)


if __name__ == "__main__":
    main()
