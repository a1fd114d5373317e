"""Zipped XML records to relational tables.

A zip has no split points, so an archive is one task; inside it members are streamed
element by element and records leave as XML text, a batch at a time.  Everything after
that is columnar: from_xml gives one nested column, and each table is a projection or an
explode of it.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..schema import TABLES
from ..session import ship
from . import files
from .filenames import file_day

VERSIONS = ("2.0",)
PARSER = 1
BATCH = 2000

#: fixed values: column and XML element, by parser.  h is the header, r the international registration.
_TEXT = {
    "mark_id_char": "h/mark-identification", "cancel_cd": "h/cancellation-code", "status_cd": "h/status-code", "mark_draw_cd": "h/mark-drawing-code", "attorney_name": "h/attorney-name", "atty_dkt_no": "h/attorney-docket-number",
    "exm_name": "h/employee-name", "exm_office_cd": "h/law-office-assigned-location-code", "file_location": "h/current-location", "ir_no": "r/international-registration-number", "ir_status_cd": "r/international-status-code",
}
_DATE = {
    "filing_dt": "h/filing-date", "registration_dt": "h/registration-date", "publication_dt": "h/published-for-opposition-date", "abandon_dt": "h/abandonment-date", "cancel_dt": "h/cancellation-date", "renewal_dt": "h/renewal-date",
    "status_dt": "h/status-date", "file_location_dt": "h/location-date", "amend_reg_dt": "h/amend-to-register-date", "repub_12c_dt": "h/republished-12c-date", "ir_registration_dt": "r/international-registration-date",
    "ir_publication_dt": "r/international-publication-date", "ir_renewal_dt": "r/international-renewal-date", "ir_death_dt": "r/international-death-date", "ir_status_dt": "r/international-status-date", "ir_auto_reg_dt": "r/auto-protection-date", "ir_priority_dt": "r/priority-claimed-date",
}
_FLAG = {
    "cancel_pend_in": "h/cancellation-pending-in", "renewal_file_in": "h/renewal-filed-in", "std_char_claimed_in": "h/standard-characters-claimed-in", "use_af_in": "h/use-application-currently-in", "use_intent_in": "h/intent-to-use-current-in",
    "for_app_in": "h/filing-basis-current-44d-in", "for_reg_in": "h/filing-basis-current-44e-in", "intl_reg_in": "h/filing-basis-current-66a-in", "no_basis_in": "h/filing-current-no-basis-in", "use_file_in": "h/filed-as-use-application-in",
    "use_intent_file_in": "h/intent-to-use-in", "for_app_file_in": "h/filing-basis-filed-as-44d-in", "for_reg_file_in": "h/filing-basis-filed-as-44e-in", "intl_reg_file_in": "h/filing-basis-filed-as-66a-in", "no_basis_file_in": "h/without-basis-currently-in",
    "amend_lb_use_in": "h/amended-to-use-application-in", "amend_lb_itu_in": "h/amended-to-itu-application-in", "amend_lb_for_app_in": "h/amended-to-44d-application-in", "amend_lb_for_reg_in": "h/amended-to-44e-application-in",
    "amend_principal_in": "h/principal-register-amended-in", "amend_supp_reg_in": "h/supplemental-register-amended-in", "chg_reg_in": "h/change-registration-in", "opposition_pend_in": "h/opposition-pending-in", "interference_pend_in": "h/interference-pending-in",
    "concur_use_in": "h/concurrent-use-in", "concur_use_pend_in": "h/concurrent-use-proceeding-in", "concur_use_pub_in": "h/published-concurrent-in", "use_afdv_file_in": "h/section-8-filed-in", "use_afdv_acc_in": "h/section-8-accepted-in",
    "use_afdv_par_acc_in": "h/section-8-partial-accept-in", "incontest_file_in": "h/section-15-filed-in", "incontest_ack_in": "h/section-15-acknowledged-in", "acq_dist_in": "h/section-2f-in", "acq_dist_part_in": "h/section-2f-in-part-in", "repub_12c_in": "h/section-12c-in",
    "draw_color_file_in": "h/color-drawing-filed-in", "draw_color_cur_in": "h/color-drawing-current-in", "draw_3d_file_in": "h/drawing-3d-filed-in", "draw_3d_cur_in": "h/drawing-3d-current-in", "for_priority_in": "h/foreign-priority-in", "supp_reg_in": "h/supplemental-register-in",
    "certification_in": "h/certification-mark-in", "collective_in": "h/collective-membership-mark-in", "coll_serv_mark_in": "h/collective-service-mark-in", "coll_trade_mark_in": "h/collective-trademark-in", "service_in": "h/service-mark-in", "trade_in": "h/trademark-in",
    "ir_first_refus_in": "r/first-refusal-in", "ir_priority_in": "r/priority-claimed-in",
}
_OWNER = {
    "own_type_cd": "party-type", "own_name": "party-name", "own_altn_name": "dba-aka-text", "own_entity_cd": "legal-entity-type-code", "own_entity_desc": "entity-statement", "own_composed_of": "composed-of-statement", "own_addr_1": "address-1", "own_addr_2": "address-2",
    "own_addr_city": "city", "own_addr_state_cd": "state", "own_addr_postal": "postcode", "own_addr_country_cd": "country", "own_addr_other_cd": "other",
}
_FOREIGN = {"for_country_cd": "country", "for_other": "other", "for_app_no": "application-number", "for_reg_no": "registration-number", "for_renewal_no": "renewal-number"}
_FOREIGN_DATE = {"for_app_dt": "filing-date", "for_reg_dt": "registration-date", "for_reg_exp_dt": "registration-expiration-date", "for_renewal_dt": "registration-renewal-date", "for_renewal_exp_dt": "registration-renewal-expiration-date"}
_MADRID = {"madrid_ref_no": "reference-number", "ir_no": "international-registration-number", "madrid_status_cd": "international-status-code"}
_MADRID_DATE = {"madrid_orig_filing_dt": "original-filing-date-uspto", "ir_dt": "international-registration-date", "madrid_status_dt": "international-status-date", "irregularity_reply_by_dt": "irregularity-reply-by-date", "ir_renewal_dt": "international-renewal-date"}


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in dict.fromkeys(names)])


def _many(item: T.DataType) -> T.ArrayType:
    return T.ArrayType(item)


def _tags(group: str) -> list[str]:
    return [p[2:] for m in (_TEXT, _DATE, _FLAG) for p in m.values() if p[0] == group]


def record_schema() -> T.StructType:
    """The nested record; every leaf is a string, parsed by column expressions."""
    owner = _strings("entry-number", *_OWNER.values()).add("nationality", _strings("country", "state", "other")).add("name-change-explanation", _many(T.StringType()))
    kind = _strings("primary-code", "status-code", "status-date", "international-code-total-no", "us-code-total-no", "first-use-anywhere-date", "first-use-in-commerce-date").add("international-code", _many(T.StringType())).add("us-code", _many(T.StringType()))
    inside = lambda tag, item: T.StructType([T.StructField(tag, _many(item))])
    return (
        _strings("serial-number", "registration-number", "domestic-representative-name")
        .add("case-file-header", _strings(*_tags("h"), "domestic-representative-name"))
        .add("international-registration", _strings(*_tags("r")))
        .add("case-file-owners", inside("case-file-owner", owner))
        .add("classifications", inside("classification", kind))
        .add("case-file-statements", inside("case-file-statement", _strings("type-code", "text")))
        .add("case-file-event-statements", inside("case-file-event-statement", _strings("code", "type", "date", "number")))
        .add("design-searches", inside("design-search", _strings("code")))
        .add("prior-registration-applications", _strings("other-related-in").add("prior-registration-application", _many(_strings("number", "relationship-type"))))
        .add("foreign-applications", inside("foreign-application", _strings("entry-number", "foreign-priority-claim-in", *_FOREIGN.values(), *_FOREIGN_DATE.values())))
        .add("madrid-international-filing-requests", inside("madrid-international-filing-record", _strings("entry-number", *_MADRID.values(), *_MADRID_DATE.values())))
        .add("correspondent", _strings(*(f"address-{k}" for k in range(1, 6))))
    )


def _stream(content: bytes, name: str) -> Iterator[str]:
    """The records of all XML members; an unknown or missing format version stops the scan."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for member in archive.namelist():
            if not member.lower().endswith(".xml"):
                continue
            version = None
            with archive.open(member) as f:
                path: list[ElementTree.Element] = []
                for event, e in ElementTree.iterparse(f, events=("start", "end")):
                    if event == "start":
                        path.append(e)
                        continue
                    path.pop()
                    if e.tag == "version-no":
                        version = (e.text or "").strip()
                        if version not in VERSIONS:
                            raise ValueError(f"{name}/{member}: format version {version} is unknown")
                    elif e.tag == "case-file":
                        if version is None:
                            raise ValueError(f"{name}/{member}: no format version before the first record")
                        yield ElementTree.tostring(e, encoding="unicode")
                        e.clear()
                        if path:
                            path[-1].remove(e)
            if version is None:
                raise ValueError(f"{name}/{member}: no format version")


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """file_name_source, file_dt_source and the nested record r of every case in the archives."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                name, held = path.rsplit("/", 1)[-1], []
                for record in _stream(content, name):
                    held.append(record)
                    if len(held) == BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(held)), pa.array(held)], ["file_name_source", "xml"])
                        held = []
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(held), pa.string()), pa.array(held, pa.string())], ["file_name_source", "xml"])

    archives = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    # an archive is a split of its own; its bytes are parsed where they are read
    rows = archives.mapInArrow(run, "file_name_source string, xml string")
    r = F.from_xml("xml", record_schema(), {"mode": "FAILFAST"})
    out = rows.select("file_name_source", file_day(F.col("file_name_source")).alias("file_dt_source"), r.alias("r"))
    serial = X.zero_filled(X.clean(F.col("r.`serial-number`")), 8)
    return out.withColumn("serial_no", serial).where("serial_no is not null")


def _at(path: str) -> Column:
    group, tag = path.split("/", 1)
    return F.col(f"r.`{'case-file-header' if group == 'h' else 'international-registration'}`.`{tag}`")


def tables(recs: DataFrame) -> dict[str, DataFrame]:
    """The relational tables, in the order and types of their schemas."""
    case = {c: X.clean(_at(p)) for c, p in _TEXT.items()} | {c: X.compact_date(_at(p)) for c, p in _DATE.items()} | {c: X.flag(_at(p)) for c, p in _FLAG.items()}
    case |= {
        "serial_no": F.col("serial_no"), "registration_no": X.registration_number(F.col("r.`registration-number`")), "related_other_in": X.flag(F.col("r.`prior-registration-applications`.`other-related-in`")),
        "domestic_rep_name": F.coalesce(X.clean(F.col("r.`case-file-header`.`domestic-representative-name`")), X.clean(F.col("r.`domestic-representative-name`"))),
    }
    key = ["serial_no", "file_dt_source", "file_name_source"]

    def each(path: str, *more: Column) -> DataFrame:
        """One row per element, with its position i from 1."""
        array = F.col("r." + ".".join(f"`{p}`" for p in path.split("/")))
        return recs.select(*key, *more, F.posexplode(array).alias("i", "e")).withColumn("i", F.col("i") + 1)

    e = lambda tag: X.clean(F.col(f"e.`{tag}`"))
    day = lambda tag: X.compact_date(F.col(f"e.`{tag}`"))
    num = lambda tag: X.whole_number(F.col(f"e.`{tag}`"))
    nation = lambda tag: X.clean(F.col(f"e.nationality.`{tag}`"))
    owners, kinds = each("case-file-owners/case-file-owner"), each("classifications/classification")
    notes = owners.select(*key, F.col("i").alias("o"), F.posexplode("e.`name-change-explanation`").alias("p", "t")).withColumn("t", X.clean(F.col("t"))).where("t is not null")
    code = lambda tag: kinds.select(*key, F.col("i").alias("class_seq"), F.explode(f"e.`{tag}`").alias("c")).withColumn("c", X.clean(F.col("c"))).where("c is not null")
    from pyspark.sql import Window as W

    found = {
        "case_file": recs.select(*(case[f.name].alias(f.name) if f.name in case else F.col(f.name) for f in TABLES["case_file"].fields)),
        "owner": owners.select(*key, num("entry-number").alias("own_seq"), *(e(t).alias(c) for c, t in _OWNER.items()), nation("country").alias("own_nalty_country_cd"), nation("state").alias("own_nalty_state_cd"), nation("other").alias("own_nalty_other_cd")),
        "owner_name_change": notes.select(*key, F.row_number().over(W.partitionBy(*key).orderBy("o", "p")).alias("change_seq"), F.col("t").alias("change_text")),
        "classification": kinds.select(
            *key, F.col("i").alias("class_seq"), e("primary-code").alias("primary_cd"), e("status-code").alias("class_status_cd"), day("status-date").alias("class_status_dt"), num("international-code-total-no").alias("class_intl_count"), num("us-code-total-no").alias("class_us_count"),
            day("first-use-anywhere-date").alias("use_first_anywhere_dt"), day("first-use-in-commerce-date").alias("use_first_commerce_dt"), e("first-use-anywhere-date").alias("use_first_anywhere_raw"), e("first-use-in-commerce-date").alias("use_first_commerce_raw"),
        ),
        "intl_class": code("international-code").select(*key, "class_seq", X.zero_filled(F.col("c"), 3).alias("intl_class_cd")),
        "us_class": code("us-code").select(*key, "class_seq", F.col("c").alias("us_class_cd")),
        "statement": each("case-file-statements/case-file-statement").select(*key, F.col("i").alias("statement_seq"), e("type-code").alias("statement_type_cd"), e("text").alias("statement_text")),
        "event": each("case-file-event-statements/case-file-event-statement").select(*key, num("number").alias("event_seq"), e("code").alias("event_cd"), e("type").alias("event_type_cd"), day("date").alias("event_dt")),
        "design_search": each("design-searches/design-search").select(*key, e("code").alias("design_search_cd")).where("design_search_cd is not null"),
        "prior_mark": each("prior-registration-applications/prior-registration-application").select(*key, e("number").alias("prior_no"), e("relationship-type").alias("prior_type_cd")),
        "foreign_app": each("foreign-applications/foreign-application").select(*key, F.coalesce(F.nullif(num("entry-number"), F.lit(0)), "i").alias("foreign_seq"), *(e(t).alias(c) for c, t in _FOREIGN.items()), *(day(t).alias(c) for c, t in _FOREIGN_DATE.items()), X.flag(F.col("e.`foreign-priority-claim-in`")).alias("for_priority_claim_in")),
        "madrid_intl_file": each("madrid-international-filing-requests/madrid-international-filing-record").select(*key, F.coalesce(F.nullif(num("entry-number"), F.lit(0)), "i").alias("madrid_seq"), *(e(t).alias(c) for c, t in _MADRID.items()), *(day(t).alias(c) for c, t in _MADRID_DATE.items())),
        "correspondent": recs.where(F.col("r.correspondent").isNotNull()).select(*key, *(X.clean(F.col(f"r.correspondent.`address-{k}`")).alias(f"cor_addr_{k}") for k in range(1, 6))),
    }
    return {t: found[t].select(*(F.col(f.name).cast(f.dataType) for f in s.fields)) for t, s in TABLES.items()}


def ingested(spark: SparkSession, paths: Sequence[str], root: str) -> dict[str, DataFrame]:
    """Parse archives that were not parsed before, and return the parsed rows of these archives by table.

    Parsed rows lie under the parser's version, in a folder for each archive, which a run
    overwrites; an archive's marker is written last.  A run that broke off is thus parsed
    again without trace.
    """
    base = f"{root}/v{PARSER}"
    by_name = {p.rsplit("/", 1)[-1]: p for p in paths}
    done = set(files.names(spark, f"{base}/finished"))
    new = {n: p for n, p in by_name.items() if n not in done}
    if new:
        recs = records(spark, list(new.values())).persist()
        for t, df in tables(recs).items():
            df.write.mode("overwrite").partitionBy("file_name_source").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(f"{base}/{t}")
        recs.unpersist()
        for name in new:
            files.write_text(spark, f"{base}/finished/{name}", "")
    rows = {t: spark.read.schema(s).parquet(f"{base}/{t}").select(*s.names) for t, s in TABLES.items()}
    return {t: df.where(F.col("file_name_source").isin(list(by_name))) for t, df in rows.items()}


def crc_problems(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, problem) of archives that are no zip or hold a damaged member; and sha256 of every archive."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for content in batch.column(1).to_pylist():
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        bad = z.testzip()
                    found.append(f"damaged member {bad}" if bad else None)
                except (zipfile.BadZipFile, zlib.error) as err:
                    found.append(str(err))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), batch.column(2)], ["path", "problem", "sha256"])

    archives = spark.read.format("binaryFile").load(list(paths)).select("path", "content", F.sha2("content", 256).alias("sha256"))
    return archives.mapInArrow(run, "path string, problem string, sha256 string")
