"""From archives to a released build, and from a build to the derived tables.

A build is an immutable directory; LIVE.json names the released one and is replaced at
once, so readers see the old build or the new one.  All paths go through Hadoop's file systems.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate, gates, grouping, merge, profile, scorer, series
from ..schema import TABLES, assert_publishable
from ..session import written
from ..sources import filenames, files, tables, xml_zip
from .ledger import Journal

KEEP = 2


def recorded(spark: SparkSession, paths: Sequence[str], journal: Journal) -> dict[str, str]:
    """Name and sha256 of every archive the journal knows, after these archives were tested and noted."""
    known = journal.facts("download")
    new = [p for p in paths if p.rsplit("/", 1)[-1] not in known]
    if new:
        for r in xml_zip.crc_problems(spark, new).collect():  # a row for each archive
            if r.problem:
                raise ValueError(f"{r.path}: {r.problem}")
            journal.note("download", r.path.rsplit("/", 1)[-1], r.sha256)
    return journal.facts("download")


def build(spark: SparkSession, paths: Sequence[str], root: str, parsed: str, journal: Journal | None = None) -> str:
    """Merge the selected inputs, latest file wins; returns the new build's directory."""
    by_name = {p.rsplit("/", 1)[-1]: p for p in paths}
    cutoff, inputs = filenames.selected(by_name)
    if not inputs:
        raise ValueError("no input files")
    names = [s.name for s in inputs]
    if journal:
        recorded(spark, [by_name[n] for n in names], journal)
        journal.plan("parse", names)
    rows = xml_zip.ingested(spark, [by_name[n] for n in names], parsed)
    if journal:
        for n in names:
            journal.finish("parse", n)
    out = merge.merged(rows, "case_file", "serial_no")
    name = f"build-{datetime.now(UTC):%Y%m%d-%H%M%S-%f}"
    for t, df in out.items():
        tables.write_sorted(df, f"{root}/{name}/{t}", "serial_no")
    through = max([s.day for s in inputs if s.kind == "daily"], default=cutoff)
    meta = {"build": name, "annual_cutoff": cutoff, "data_current_through": through, "inputs": names}
    files.write_json(spark, meta, f"{root}/{name}/_build.json")
    return f"{root}/{name}"


def _name(directory: str) -> str:
    return directory.rstrip("/").rsplit("/", 1)[-1]


def load(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    return {t: tables.read_table(spark, directory, t) for t in TABLES}


def reconciled(spark: SparkSession, directory: str, today: str, downloads: Iterable[str] | None = None, previous: str | None = None) -> None:
    """Write the whole data profile, then run the gates and raise all they find; a build that passes is marked last.

    downloads: the names that were recorded when they were fetched; every row must come from one.
    previous: the released build, whose number of records is not to fall.
    """
    rows = load(spark, directory)
    files.delete(spark, f"{directory}/_passed.json")
    gates.row_counts(rows).coalesce(1).write.mode("overwrite").csv(f"{directory}/profile/row_counts", header=True)
    for t, df in rows.items():
        gates.null_rates(df, t).coalesce(1).write.mode("overwrite").csv(f"{directory}/profile/null_rates/{t}", header=True)
    dates = gates.date_profile(rows, today).coalesce(1)
    dates.write.mode("overwrite").csv(f"{directory}/profile/date_outliers", header=True)
    dates = spark.read.schema(dates.schema).csv(f"{directory}/profile/date_outliers", header=True)
    known = None if downloads is None else spark.createDataFrame([(n,) for n in downloads], "name string")
    found = gates.failures(rows, "case_file", "serial_no", dates, known, tables.read_table(spark, previous, "case_file") if previous else None)
    if found:
        raise gates.GateError(found)
    files.write_json(spark, {"build": _name(directory), "today": today}, f"{directory}/_passed.json")


def live(spark: SparkSession, root: str) -> str | None:
    found = files.read_json(spark, f"{root}/LIVE.json")
    return found and f"{root}/{found['build']}"


def release(spark: SparkSession, root: str, directory: str, keep: int = KEEP, journal: Journal | None = None) -> list[str]:
    """Point LIVE.json to a build whose gates have passed and delete old builds, never the live one; returns the deleted."""
    name = _name(directory)
    if (files.read_json(spark, f"{directory}/_passed.json") or {}).get("build") != name:
        raise ValueError("a build is released after its gates have passed")
    files.write_json(spark, {"build": name}, f"{root}/LIVE.json")
    if journal:
        meta = files.read_json(spark, f"{directory}/_build.json")
        for fact in ("annual_cutoff", "data_current_through"):
            journal.note("watermark", fact, str(meta[fact]))
    builds = [n for n in files.names(spark, root) if n.startswith("build-")]
    gone = [b for b in builds[:-keep] if b != name]
    for b in gone:
        files.delete(spark, f"{root}/{b}")
    return gone


def pruned(spark: SparkSession, root: str, archives: str) -> list[str]:
    """Delete the daily archives that the released build's snapshot covers; none before such a build is released."""
    at = live(spark, root)
    names = files.names(spark, archives)
    cutoff, _ = filenames.selected(names)
    if at is None or cutoff is None or files.read_json(spark, f"{at}/_build.json")["annual_cutoff"] != str(cutoff):
        return []
    gone = filenames.prunable(names)
    for n in gone:
        files.delete(spark, f"{archives}/{n}")
    return gone


def same_build(spark: SparkSession, lineage: str, directory: str) -> None:
    """Refuse to mix tables that were derived from different builds."""
    was = (files.read_json(spark, lineage) or {}).get("silver_build")
    if was and was != _name(directory):
        raise ValueError(f"derived from {was}, but the build is {_name(directory)}: derive again")


def _derived(df: DataFrame, gold: str, name: str, directory: str, *order: str) -> DataFrame:
    """Write a derived table with its lineage, and read it back."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{gold}/{name}") if not order else tables.write_small(df, f"{gold}/{name}", *order)
    files.write_json(df.sparkSession, {"table": name, "silver_build": _name(directory)}, f"{gold}/{name}/_lineage.json")
    return df.sparkSession.read.schema(df.schema).parquet(f"{gold}/{name}")


def staged(spark: SparkSession, source: str, target: str, names: Sequence[str], title: str, lookups: dict[str, str] | None = None) -> dict[str, int]:
    """Copy publishable tables and lookups to a folder for publishing, with a card; returns the rows of each table.

    A table that may not be published stops the staging before anything is written.
    """
    for n in names:
        assert_publishable(n)
    sizes, lines = {}, [f"# {title}", ""]
    for n in names:
        df = spark.read.parquet(f"{source}/{n}")
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/{n}")
        sizes[n] = spark.read.parquet(f"{target}/{n}").count()
        lines += [f"## {n}", "", f"{sizes[n]} rows.", "", "| Column | Type |", "|-|-|", *(f"| `{c}` | {k} |" for c, k in df.dtypes), ""]
    for n, path in (lookups or {}).items():
        tables.read_lookup(spark, path).coalesce(1).write.mode("overwrite").csv(f"{target}/lookup_{n}", header=True)
        lines += [f"## lookup_{n}", "", "Codes and their descriptions.", ""]
    files.write_text(spark, f"{target}/README.md", "\n".join(lines))
    return sizes


def staged_lists(spark: SparkSession, gold: str, target: str) -> dict[str, int]:
    """The screening lists for publishing, each the text file it is, and their manifest; returns their lengths."""
    assert_publishable("detector_v1")
    manifest = files.read_json(spark, f"{gold}/detector_v1/_manifest.json")
    for name in manifest["lists"]:
        spark.read.text(f"{gold}/detector_v1/{name}").coalesce(1).sortWithinPartitions("value").write.mode("overwrite").text(f"{target}/{name}")
    files.write_json(spark, manifest, f"{target}/_manifest.json")
    return manifest["lists"]


def derive(spark: SparkSession, directory: str, gold: str, min_marks: int = profile.MIN_MARKS) -> dict[str, DataFrame]:
    """mark_features_v1, operation_membership_v1, operation_profile_v1, evaluation_labels_v1 and event_series_v1."""
    rows = load(spark, directory)
    cases = rows["case_file"]
    train = scorer.training_sample(cases, "serial_no", "mark_id_char", "filing_dt", "2015-01-01").select(F.explode(F.split("mark_id_char", r"\s+")).alias("word"))
    scores = scorer.scored(cases.where("mark_id_char is not null").select("serial_no", "mark_id_char"), "serial_no", F.col("mark_id_char"), scorer.fit(train, "word"))
    out = {"mark_features_v1": _derived(profile.mark_features(rows, scores), gold, "mark_features_v1", directory)}
    kept = out["mark_features_v1"].select("serial_no", F.col("coined_token_max").alias("token_max"))
    base = grouping.assigned(profile.filings_base(rows, kept), grouping.VARIANTS["shipped"])
    out["operation_membership_v1"] = _derived(base.select("serial_no", "op_key"), gold, "operation_membership_v1", directory)
    out["operation_profile_v1"] = _derived(profile.operation_profile(base, min_marks=min_marks), gold, "operation_profile_v1", directory)
    out["evaluation_labels_v1"] = _derived(evaluate.labels(rows), gold, "evaluation_labels_v1", directory)
    out["event_series_v1"] = _derived(series.event_series(rows, out["mark_features_v1"]), gold, "event_series_v1", directory, "ym")
    return out


def detector_lists(spark: SparkSession, directory: str, gold: str, countries: Sequence[str] = ("CN",)) -> dict[str, int]:
    """Write the screening lists and return their lengths."""
    same_build(spark, f"{gold}/mark_features_v1/_lineage.json", directory)
    rows = load(spark, directory)
    features, members, ops = (spark.read.parquet(f"{gold}/{t}") for t in ("mark_features_v1", "operation_membership_v1", "operation_profile_v1"))
    lists = {"tier1": profile.tier1(rows), "tier2": profile.tier2(features), "tier3": profile.tier3(members, ops, rows["case_file"])}
    lists |= {f"origin_{c.lower()}": profile.origin(features, c) for c in countries}
    sizes = {name: tables.write_list(df.orderBy("key"), f"{gold}/detector_v1/{name}") for name, df in lists.items()}
    files.write_json(spark, {"silver_build": _name(directory), "lists": sizes}, f"{gold}/detector_v1/_manifest.json")
    return sizes
