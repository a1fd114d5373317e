"""Parquet, CSV and JSON sources, views, and sinks."""

from __future__ import annotations

import html
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schema import TABLES
from . import files


def read_table(spark: SparkSession, build: str, table: str) -> DataFrame:
    """A table of a build, with its fixed schema."""
    return spark.read.schema(TABLES[table]).parquet(f"{build}/{table}")


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of codes: all columns are strings, zeros before a code stay."""
    return spark.read.csv(path, header=True, inferSchema=False)


def last_wins(lookup: DataFrame, key: str, line: str) -> DataFrame:
    """One row per code: the one with the greatest line number."""
    rest = [c for c in lookup.columns if c != key]
    return lookup.groupBy(key).agg(F.max_by(F.struct(*rest), line).alias("r")).select(key, "r.*")


def provenance(spark: SparkSession, lookups: Mapping[str, str]) -> DataFrame:
    """(name, path, modified, bytes, sha256) of lookup files, a row for each."""
    out = None
    for name, path in lookups.items():
        f = spark.read.format("binaryFile").load(path)
        f = f.select(F.lit(name).alias("name"), "path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
        out = f if out is None else out.unionByName(f)
    return out


def read_document(spark: SparkSession, path: str, dates: tuple[str, ...] = ()) -> DataFrame:
    """One JSON document; named columns become dates."""
    df = spark.read.json(path, multiLine=True)
    return df.withColumns({c: F.to_date(c) for c in dates})


_BUILD = "build string, annual_cutoff date, data_current_through date, inputs array<string>"


def create_views(spark: SparkSession, build: str, lookups: Mapping[str, str] | None = None) -> list[str]:
    """A temporary view for every table that has rows, and for every lookup; running it again repoints them."""
    made = []
    for t in TABLES:
        try:
            df = read_table(spark, build, t)
            if not df.head(1):
                continue
        except Exception as e:  # a table that the build does not have
            if "PATH_NOT_FOUND" not in str(e):
                raise
            continue
        df.createOrReplaceTempView(t)
        made.append(t)
    meta = files.read_text(spark, f"{build}/_build.json")
    if meta is not None:
        spark.range(1).select(F.from_json(F.lit(meta), _BUILD).alias("b")).select("b.*").createOrReplaceTempView("_build")
        made.append("_build")
    for name, path in (lookups or {}).items():
        read_lookup(spark, path).createOrReplaceTempView(f"lookup_{name}")
        made.append(f"lookup_{name}")
    return made


def write_sorted(df: DataFrame, path: str, key: str, partitions: int | None = None, max_rows: int = 4_000_000) -> None:
    """Range-partitioned by key and sorted inside, so point lookups skip row groups."""
    parts = df.repartitionByRange(partitions, key) if partitions else df.repartitionByRange(key)
    parts.sortWithinPartitions(key).write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", max_rows).parquet(path)


def write_small(df: DataFrame, path: str, *order: str) -> None:
    """One file, sorted; for tables of known small size."""
    df.coalesce(1).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_list(keys: DataFrame, path: str) -> int:
    """One key a line, no header; the number of lines is observed in the same pass."""
    seen = Observation("list")
    keys.select(F.col(keys.columns[0]).cast("string").alias("value")).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").text(path)
    return seen.get["n"]


def script_json(doc) -> str:
    """JSON that can stand inside an HTML script element."""
    out = json.dumps(doc, ensure_ascii=False, default=str)
    for c in "<>&\u2028\u2029":
        out = out.replace(c, f"\\u{ord(c):04x}")
    return out


_REVIEW = """<!DOCTYPE html><html><head><meta charset="utf-8"><title>{title}</title><style>body{{font:15px sans-serif;max-width:60em;margin:2em auto}}section{{border-top:1px solid #ccc;padding:1em 0}}td{{padding:0 1em 0 0;vertical-align:top}}</style></head><body>
<h1>{title}</h1><p><span id="count"></span> <button id="save">Save verdicts</button></p><main id="list"></main><script type="application/json" id="data">{data}</script><script>
const doc=JSON.parse(document.getElementById("data").textContent),given=JSON.parse(localStorage.getItem(doc.id)||"{{}}"),list=document.getElementById("list");
const add=(to,tag,text)=>{{const e=document.createElement(tag);if(text!==undefined)e.textContent=text;to.append(e);return e}};
const tell=()=>{{document.getElementById("count").textContent=Object.keys(given).length+" of "+doc.cases.length+" judged";localStorage.setItem(doc.id,JSON.stringify(given))}};
for(const c of doc.cases){{const s=add(list,"section");add(s,"h3",c.key);const t=add(s,"table");for(const[k,v]of Object.entries(c.evidence)){{const r=add(t,"tr");add(r,"td",k);add(r,"td",Array.isArray(v)?v.map(x=>x.join?x.join(" × "):x).join("; "):String(v))}}
for(const v of doc.verdicts){{const l=add(s,"label"),i=document.createElement("input");i.type="radio";i.name=c.key;i.checked=given[c.key]===v;i.onchange=()=>{{given[c.key]=v;tell()}};l.append(i,v+" ")}}}}
document.getElementById("save").onclick=()=>{{const a=document.createElement("a");a.href=URL.createObjectURL(new Blob([JSON.stringify(doc.cases.map(c=>({{op_key:c.key,verdict:given[c.key]||""}})),null,1)]));a.download=doc.id+".json";a.click()}};tell();
</script></body></html>"""


def review_page(cases: list[dict], name: str, title: str = "Review", verdicts: tuple[str, ...] = ("coherent", "mixed", "unclear")) -> str:
    """A page of its own in which cases (key, evidence by name) are judged; it keeps the verdicts and saves them as JSON."""
    return _REVIEW.format(title=html.escape(title), data=script_json({"id": name, "cases": cases, "verdicts": verdicts}))
