"""Command line for the stages: `python -m strata.cli <stage> --root <lake> ...`.

Stages: deliver, land, bronze, silver, predict, enrich, marts, index, page, all.
`deliver` and `all` read a source table: `--csv <path>` (accident schema,
header) or `--parquet <path>`.  The session is built with the library's
defaults; extra `--conf key=value` pairs are passed through.
"""

from __future__ import annotations

import argparse
import json

from strata import presets as P
from strata.plans import stages
from strata.session import build_session


def _source(spark, args):
    from strata.sources.files import read_csv, read_parquet
    if args.csv:
        return read_csv(spark, args.csv, P.ACC_SCHEMA, null_value=args.csv_null)
    if args.parquet:
        return read_parquet(spark, args.parquet)
    raise SystemExit("a source is needed: --csv or --parquet")


def parse_args(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("stage", choices=["deliver", "land", "bronze", "silver", "predict",
                                      "enrich", "marts", "index", "page", "all"])
    ap.add_argument("--root", required=True, help="lake root (shared storage)")
    ap.add_argument("--csv")
    ap.add_argument("--csv-null", default="", help="CSV null marker of the source")
    ap.add_argument("--parquet")
    ap.add_argument("--model", default="forest", choices=["forest", "stored", "baseline"])
    ap.add_argument("--resume", action="store_true", help="all: keep stages that ended over the same input")
    ap.add_argument("--date", help="bronze snapshot date for silver (default latest)")
    ap.add_argument("--offset", type=int, default=0)
    ap.add_argument("--limit", type=int, default=1)
    ap.add_argument("--master")
    ap.add_argument("--conf", action="append", default=[])
    return ap.parse_args(argv)


def main(argv=None) -> None:
    args = parse_args(argv)
    conf = dict(c.split("=", 1) for c in args.conf)
    spark = build_session(f"strata-{args.stage}", master=args.master, conf=conf)
    try:
        result = run(spark, args)
        print(json.dumps(result, default=str))
    finally:
        spark.stop()


def _rows(df):
    return [r.asDict() for r in df.collect()]


def run(spark, args):
    """Run one stage in an existing session (the caller owns the session)."""
    root = args.root
    if args.stage == "deliver":
        return _rows(stages.stage_deliver(spark, _source(spark, args), root))
    if args.stage == "land":
        return _rows(stages.stage_land(spark, root))
    if args.stage == "bronze":
        return _rows(stages.stage_bronze(spark, root))
    if args.stage == "silver":
        return stages.stage_silver(spark, root, args.date)
    if args.stage == "predict":
        info = stages.stage_predict(spark, root, args.model)
        return {k: v for k, v in info.items() if k != "model"}
    if args.stage == "enrich":
        stages.stage_enrich(spark, root)
        return {"ok": True}
    if args.stage == "marts":
        return stages.stage_marts(spark, root)
    if args.stage == "index":
        return {"rows": stages.stage_index(spark, root)}
    if args.stage == "page":
        return _rows(stages.stage_page(spark, root, args.offset, args.limit))
    out = stages.run_all(spark, _source(spark, args), root, args.model, resume=args.resume)
    return {k: v for k, v in out.items()}


if __name__ == "__main__":
    main()
