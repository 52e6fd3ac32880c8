"""Command line: ``python -m kindred SOURCE TARGET [options]`` runs the migration."""

from __future__ import annotations

import argparse
import json

from kindred.plans.migrate import migrate
from kindred.session import build_session


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="kindred", description=__doc__)
    p.add_argument("source", help="document collection (path or glob)")
    p.add_argument("target", help="folder for the output tables")
    p.add_argument("--source-format", default="jsonl", help="jsonl | json | parquet | any Spark format")
    p.add_argument("--output-format", default="parquet")
    p.add_argument("--mode", default="overwrite")
    p.add_argument("--exact-join", action="store_true", help="run the catalog-to-document join for keys of several kinds")
    p.add_argument("--literal", action="store_true",
                   help="the source SQL's literal behaviour: lists read 'list', _id counted, no ISO expiry")
    p.add_argument("--no-checks", action="store_true")
    p.add_argument("--cluster", action="store_true", help="range-partition and sort tables on their keys")
    p.add_argument("--partition-catalog-by-type", action="store_true")
    p.add_argument("--fail-on-reject", action="store_true")
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    spark = build_session(a.master)
    literal = dict(list_field="list", drop_fields=(), iso_expire=False) if a.literal else {}
    res = migrate(spark, a.source, a.target, source_format=a.source_format,
                  output_format=a.output_format, mode=a.mode, exact_join=a.exact_join,
                  checks=not a.no_checks, cluster=a.cluster,
                  partition_catalog_by_type=a.partition_catalog_by_type,
                  on_error="fail" if a.fail_on_reject else "reject", **literal)
    print(json.dumps({"tables": res.tables, "checks": res.checks, "violations": res.violations}, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
