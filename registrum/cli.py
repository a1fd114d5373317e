"""Command line over the jobs: python -m registrum.cli COMMAND."""

from __future__ import annotations

import argparse
import json
from datetime import date
from pathlib import Path

from pyspark.sql import functions as F

from .operators import audit, evaluate, grouping, series
from .plans import build as B
from .plans.ledger import Journal
from .session import build as session
from .sources import filenames, files, remote, tables, xml_zip

COMMANDS = (
    "preflight", "download", "restore", "plan", "parse", "build", "reconcile", "release", "prune", "run", "explore", "sql", "gold", "detector-lists", "evaluate", "event-study", "validate-resolution", "resolution-score", "stage-lookups", "publish", "publish-features", "publish-detector", "status", "retry",
)


def _zips(root: Path) -> list[str]:
    return sorted(str(p) for p in (root / "bronze").glob("*.zip"))


def _fetch(args, root: Path, journal: Journal) -> int:
    if not args.source:
        print("name the server of the archives with --source")
        return 2
    server = remote.Http(args.source)
    if args.command == "preflight":
        print(json.dumps({"missing": filenames.missing(server.listing(), (Path(p).name for p in _zips(root)))}))
    else:
        print(json.dumps({"fetched": remote.fetched(server, str(root / "bronze"), journal)}))
    return 0


def _audit(spark, gold: str, target: str) -> dict:
    """The document to be judged: a sample with evidence, all grouping variants, and addresses where names meet."""
    read = lambda t: spark.read.parquet(f"{gold}/{t}")
    base = B.profile.filings_base(B.load(spark, target), read("mark_features_v1").select("serial_no", F.col("coined_token_max").alias("token_max")))
    base = B.written(base, "base")
    sample = audit.audit_sample(read("operation_profile_v1"))
    members = read("operation_membership_v1").join(F.broadcast(sample.select("op_key")), "op_key").join(base.drop("op_key"), "serial_no")  # a stated number of operations
    found = sample.join(audit.evidence(members, "op_key", {"attorney_name": 5, "addr": 5, "applicant": 5, "country": 3}), "op_key", "left")
    variants = audit.variants_compared(base, grouping.VARIANTS, "serial_no", "name", "addr", B.profile.aggregates(), B.profile.MIN_MARKS)
    together = audit.colocated(base, "addr", "name", B.profile.aggregates(), B.profile.weighted_score(B.profile.WEIGHTS))
    names = audit.names_at(base, "addr", "name", together.select("addr"))
    rows = lambda df: [r.asDict(recursive=True) for r in df.collect()]
    # rows: of the sample, of the variants, and of the stated number of addresses
    return {"sample": rows(found), "variants": rows(variants), "colocation": rows(together), "names": rows(names)}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="registrum", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("argument", nargs="?", default="")
    parser.add_argument("--root", type=Path, default=Path("data"))
    parser.add_argument("--source", default="", help="server of the archives, or of a mirror")
    parser.add_argument("--today", default=date.today().isoformat())
    args = parser.parse_args(argv)
    root, builds, gold, parsed = args.root, str(args.root / "builds"), str(args.root / "gold"), str(args.root / "parsed")
    root.mkdir(parents=True, exist_ok=True)
    journal = Journal(str(root / "journal.db"))
    if args.command in ("preflight", "download", "restore"):
        return _fetch(args, root, journal)
    if args.command == "plan":
        names = [Path(p).name for p in _zips(root)]
        cutoff, inputs = filenames.selected(names)
        print(json.dumps({"cutoff": cutoff, "inputs": [s.name for s in inputs], "prunable": filenames.prunable(names)}, default=str))
        return 0
    if args.command in ("status", "retry"):
        print(json.dumps(journal.report() | {"watermarks": journal.facts("watermark")} if args.command == "status" else {"reopened": journal.reopen(args.argument)}))
        return 0
    spark = session()
    newest = max((f"{builds}/{n}" for n in files.names(spark, builds) if n.startswith("build-")), default=None)
    released = B.live(spark, builds)
    target = released or newest
    if args.command == "parse":
        B.recorded(spark, _zips(root), journal)
        for t, df in xml_zip.ingested(spark, _zips(root), parsed).items():
            print(t, df.count())
    elif args.command in ("build", "run"):
        target = B.build(spark, _zips(root), builds, parsed, journal)
        print(target)
        if args.command == "run":
            B.reconciled(spark, target, args.today, journal.facts("download"), released)
            print(B.release(spark, builds, target, journal=journal))
    elif args.command == "reconcile":
        B.reconciled(spark, newest, args.today, journal.facts("download"), released)
    elif args.command == "release":
        print(B.release(spark, builds, newest, journal=journal))
    elif args.command == "prune":
        print(B.pruned(spark, builds, str(root / "bronze")))
    elif args.command == "explore":
        print(tables.create_views(spark, target, {p.stem: str(p) for p in (root / "lookups").glob("*.csv")}))
    elif args.command == "sql":
        tables.create_views(spark, target)
        spark.sql(args.argument).show(100, truncate=False)
    elif args.command == "gold":
        for t, df in B.derive(spark, target, gold).items():
            print(t, df.count())
    elif args.command == "detector-lists":
        print(json.dumps(B.detector_lists(spark, target, gold)))
    elif args.command in ("publish", "publish-features", "publish-detector", "stage-lookups"):
        # a folder that is ready to be sent; sending it is the platform's
        names = {"publish": ["evaluation_labels_v1", "event_series_v1"], "publish-features": ["mark_features_v1"], "publish-detector": [], "stage-lookups": []}[args.command]
        lookups = {p.stem: str(p) for p in (root / "lookups").glob("*.csv")} if args.command in ("publish", "stage-lookups") else {}
        sizes = B.staged(spark, gold, str(root / args.command), names, args.command, lookups)
        if args.command == "publish-detector":
            sizes = B.staged_lists(spark, gold, str(root / args.command))
        print(json.dumps(sizes))
    else:
        read = lambda t: spark.read.parquet(f"{gold}/{t}")
        if args.command == "evaluate":
            rows = B.load(spark, target)
            pool = evaluate.evaluation_pool(read("evaluation_labels_v1"), read("mark_features_v1"), rows["statement"])
            marks = rows["case_file"].where("mark_id_char is not null")
            doc = evaluate.evaluate(pool, evaluate.token_zipf(marks, "serial_no", "mark_id_char", evaluate.corpus_zipf(rows["statement"].where("statement_text is not null"), "statement_text")))
        elif args.command == "event-study":
            doc = series.analyzed(read("event_series_v1"))
        elif args.command == "validate-resolution":
            doc = _audit(spark, gold, target)
            cases = [{"key": r["op_key"], "evidence": {k: [[v["value"], v["n"]] for v in x] if isinstance(x, list) else x for k, x in r.items() if k != "op_key"}} for r in doc["sample"]]
            files.write_text(spark, f"{root}/audit/review.html", tables.review_page(cases, target.rsplit("/", 1)[-1], "Operations to judge"))
        else:
            verdicts = spark.read.json(args.argument, multiLine=True)
            doc = [r.asDict() for r in audit.verdict_scores(verdicts, read("operation_profile_v1")).collect()]  # a row for each stratum
        print(json.dumps(doc, default=str, indent=1))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
