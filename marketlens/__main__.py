"""Command line: ``python -m marketlens <command> ...`` (or through spark-submit).

  ingest   CSV exports -> typed parquet tables (+ row-count validation)
  publish  test parquet (TPC-H-like) -> published mart, optionally bucketed
  report   run report keys over a published mart; write parquet/CSV or show
  check    run the data-quality rule job over a published mart
  sql      run a SQL statement over the published tables and the three views

Cluster settings (master, executors, ``spark.checkpoint.dir``) come from
spark-submit / spark-defaults; the command only adds the library's required
settings.
"""

from __future__ import annotations

import argparse
import fnmatch
import sys


def _session():
    from marketlens.session import build_session
    return build_session()


def _mart(spark, args):
    from marketlens.sources.mart import Mart
    if getattr(args, "database", None):
        return Mart.from_catalog(spark, args.database)
    return Mart.from_tables(spark, args.mart)


def _emit(df, out: str | None, fmt: str, show: int) -> None:
    if out:
        writer = df.write.mode("overwrite")
        (writer.option("header", True).csv(out) if fmt == "csv" else writer.parquet(out))
    else:
        df.show(show, truncate=False)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="marketlens")
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("ingest", help="load CSV exports into parquet tables")
    p.add_argument("source_dir")
    p.add_argument("target_dir")
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    p.add_argument("--file", action="append", default=[], metavar="TABLE=NAME", help="export file name of a table (default <table>.csv)")
    p.add_argument("--no-gate", action="store_true", help="publish even if declared rules are broken; report them")

    p = sub.add_parser("publish", help="derive the mart from TPC-H-like parquet and publish it")
    p.add_argument("sf_dir")
    p.add_argument("target_dir")
    p.add_argument("--bucketed", type=int, default=0, help="bucket count; publish as catalog tables")
    p.add_argument("--database", default="marketlens")

    for name in ("report", "check", "sql"):
        p = sub.add_parser(name)
        p.add_argument("--mart", help="published mart folder")
        p.add_argument("--database", help="catalog database of a bucketed mart")
        p.add_argument("--out", help="output folder (one sub-folder per report)")
        p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
        p.add_argument("--show", type=int, default=20)
        if name == "report":
            p.add_argument("keys", nargs="+", help="report keys or patterns (e.g. 'q8_*', 'all')")
            p.add_argument("--explain", action="store_true", help="print the formatted physical plan instead")
        if name == "sql":
            p.add_argument("statement")

    args = ap.parse_args(argv)
    spark = _session()

    if args.cmd == "ingest":
        from marketlens.sources.ingest import run_ingest
        from marketlens.sources.schemas import TABLE_ORDER
        files = dict(x.split("=", 1) for x in args.file)
        unknown = sorted(set(files) - set(TABLE_ORDER))
        if unknown:
            print("no such table:", ", ".join(unknown), file=sys.stderr)
            return 2
        res = run_ingest(spark, args.source_dir, args.target_dir, args.mode, file_names=files, gate=not args.no_gate)
        for table in res.tables:
            print(f"{table}: {res.stored[table]} rows; coerced to NULL: {res.coerced.get(table, {})}")
        print(f"categories added by back-fill: {res.categories_added}")
        for rule, n in sorted(res.violations.items()):
            print(f"rule broken: {rule} ({n})")
        return 0

    if args.cmd == "publish":
        from marketlens.sources.mart import Mart
        mart = Mart.from_testdata(spark, args.sf_dir)
        if args.bucketed:
            mart.write_bucketed(args.database, args.target_dir, args.bucketed)
        else:
            mart.write(args.target_dir)
        return 0

    mart = _mart(spark, args)
    if args.cmd == "report":
        from marketlens.plans import REPORTS, run_report
        keys = [k for k in REPORTS if any(p == "all" or fnmatch.fnmatch(k, p) for p in args.keys)]
        if not keys:
            print("no report matches", args.keys, file=sys.stderr)
            return 2
        for key in keys:
            out = f"{args.out.rstrip('/')}/{key}" if args.out else None
            if not out:
                print(f"== {key}")
            if args.explain:
                run_report(key, mart).explain("formatted")
                continue
            _emit(run_report(key, mart), out, args.format, args.show)
        return 0
    if args.cmd == "check":
        from marketlens.operators.quality import RULES, check_rules
        _emit(check_rules(mart.tables()).orderBy("table_name", "rule_type", "rule"), args.out, args.format, len(RULES))
        return 0
    if args.cmd == "sql":
        from marketlens.plans.views import register_views
        from marketlens.sources.catalog import register_tables
        register_tables(spark, mart.tables())
        register_views(mart)
        _emit(spark.sql(args.statement), args.out, args.format, args.show)
        return 0
    return 1


if __name__ == "__main__":
    sys.exit(main())
