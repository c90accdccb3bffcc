"""Command line: check, release, resolve, diff, validate, bundle, derive, audit, aggregate, run.

Exit codes: 0 fine, 1 findings, 2 a contract that cannot be used."""

from __future__ import annotations

import argparse
import json
import sys

from .contract.model import ContractError, change_step, compiled, release, resolved


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("sparkledger").getOrCreate()


def _contract(args):
    return compiled(args.contract) if args.contract else resolved(args.releases, args.version)


def cmd_check(args) -> int:
    c = compiled(args.contract)
    print(json.dumps({"version": c.version, "fields": len(c.fields), "rules": len(c.rules), "digest": c.digest}))
    return 0


def cmd_release(args) -> int:
    print(release(compiled(args.contract), args.releases))
    return 0


def cmd_resolve(args) -> int:
    c = resolved(args.releases, args.version)
    print(json.dumps({"version": c.version, "digest": c.digest}))
    return 0


def cmd_diff(args) -> int:
    step, reasons = change_step(resolved(args.releases, args.old), resolved(args.releases, args.new))
    print(json.dumps({"step": step, "reasons": reasons}))
    return 0


def cmd_validate(args) -> int:
    from pyspark.sql import functions as F

    from .api import validate_records
    from .operators.rules import repeated_keys
    from .sources.readers import tolerant_record_lines

    rows, notes = tolerant_record_lines(_session(), args.records)
    judged = validate_records(rows, _contract(args), args.profile).persist()
    report = judged.select(F.inline("issues")).groupBy("code", "severity").count().orderBy("severity", "code").collect()
    repeated = repeated_keys(judged.select("common.record_id", "common.record_version", "_ord"), ["record_id", "record_version"], ["_ord"]).count()
    bad, unread = judged.where("NOT valid").count(), notes.count()
    print(json.dumps({"records": judged.count(), "invalid": bad, "unread": unread, "repeated": repeated, "issues": {f"{r['severity']}:{r['code']}": r["count"] for r in report}}))
    return int(bool(bad or unread or repeated))


def cmd_derive(args) -> int:
    from .operators.derive import Roles, entities, graph, links, statements, triples, values
    from .sources.readers import record_lines, typed
    from .sources.writers import write_views

    c = _contract(args)
    rows = typed(record_lines(_session(), args.records), c.schema())
    flat = rows.selectExpr(*[f"{f['path']} AS {f['path'].replace('.', '__')}" for f in c.fields])
    name = lambda p: p.replace(".", "__")
    key, source = c.by_role("record_identity")[0], c.by_role("source_identity")[0]
    roles = Roles(key=name(key), source=name(source), mentions={name(p): ("entity", None) for p in c.by_role("entity_mention")}, links=[name(p) for p in c.by_role("record_link")], values=[name(p) for p in c.by_role("assertion")], subject="transform__subject", predicate="transform__predicate", object="transform__object")
    nodes, edges = graph(flat, roles)
    made = write_views({"entities": entities(flat, roles), "links": links(flat, roles), "values": values(flat, roles), "statements": statements(flat, roles), "triples": triples(flat, roles), "nodes": nodes, "edges": edges}, args.out)
    print(json.dumps({r["view"]: r["rows"] for r in made.collect()}))
    return 0


def cmd_query(args) -> int:
    from .queries import QUERIES

    df = QUERIES[args.name](_session(), args.tables)
    if args.out:
        df.write.parquet(args.out)
    else:
        df.show(args.rows, truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sparkledger", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)

    def add(name: str, run, *options: tuple) -> None:
        p = sub.add_parser(name)
        for flags, kw in options:
            p.add_argument(*flags, **kw)
        p.set_defaults(run=run)

    contract = (("--contract",), {"help": "folder of contract sources"})
    releases, version = (("--releases",), {"help": "folder of releases"}), (("--version",), {"default": "latest"})
    add("check", cmd_check, (("contract",), {}))
    add("release", cmd_release, (("contract",), {}), (("releases",), {}))
    add("resolve", cmd_resolve, (("releases",), {}), version)
    add("diff", cmd_diff, (("releases",), {}), (("old",), {}), (("new",), {}))
    add("validate", cmd_validate, (("records",), {}), contract, releases, version, (("--profile",), {}))
    add("derive", cmd_derive, (("records",), {}), (("--out",), {"required": True}), contract, releases, version)
    add("query", cmd_query, (("name",), {}), (("tables",), {}), (("--out",), {}), (("--rows",), {"type": int, "default": 20}))
    args = parser.parse_args(argv)
    try:
        return args.run(args)
    except ContractError as error:
        print(error, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
