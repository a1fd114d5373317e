import zipfile

import pytest
from pyspark.sql import functions as F

from registrum.operators import gates
from registrum.plans import build as B
from registrum.plans.ledger import Journal
from registrum.schema import TABLES, assert_publishable
from registrum.sources import filenames, files, remote, tables, xml_zip
from registrum.streaming import upserts


def case(serial, mark="ZULVEX", filing="20200105", owner="Example Trading", country="CN", attorney="Cora B. Agent", events="", statement="Mugs; plates", street="1 Main St"):
    return f"""<case-file><serial-number>{serial}</serial-number><registration-number>0000000</registration-number>
<case-file-header><filing-date>{filing}</filing-date><status-code>630</status-code><mark-identification>{mark}</mark-identification><mark-drawing-code>4</mark-drawing-code><attorney-name>{attorney}</attorney-name>
<use-application-currently-in>T</use-application-currently-in><intent-to-use-current-in>F</intent-to-use-current-in><renewal-date>19870000</renewal-date></case-file-header>
<case-file-statements><case-file-statement><type-code>GS0211</type-code><text>{statement}</text></case-file-statement></case-file-statements>
<case-file-event-statements><case-file-event-statement><code>NWAP</code><type>I</type><date>{filing}</date><number>1</number></case-file-event-statement>{events}</case-file-event-statements>
<classifications><classification><international-code>9</international-code><us-code>021</us-code><primary-code>009</primary-code></classification></classifications>
<correspondent><address-1>ACME</address-1><address-2>{street}</address-2></correspondent>
<case-file-owners><case-file-owner><entry-number>1</entry-number><party-type>10</party-type><nationality><country>{country}</country></nationality><party-name>{owner}</party-name><country>{country}</country><name-change-explanation>was X</name-change-explanation><name-change-explanation>was Y</name-change-explanation></case-file-owner></case-file-owners>
<design-searches><design-search><code>261721</code></design-search></design-searches></case-file>"""


def archive(folder, name, cases, version="2.0"):
    path = folder / name
    v = f"<version><version-no>{version}</version-no></version>" if version else ""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name.replace(".zip", ".xml"), f'<?xml version="1.0" encoding="UTF-8"?><root>{v}<files>{"".join(cases)}</files></root>')
    return str(path)


def test_records_become_tables(spark, tmp_path):
    path = archive(tmp_path, "apc250102.zip", [case("123"), case("")])
    got = xml_zip.tables(xml_zip.records(spark, [path]))
    assert {t: df.schema.simpleString() for t, df in got.items()} == {t: s.simpleString() for t, s in TABLES.items()}
    c = got["case_file"].first()
    assert (c.serial_no, c.registration_no, c.use_af_in, c.use_intent_in, c.trade_in, c.renewal_dt) == ("00000123", None, True, False, None, None)
    assert str(c.file_dt_source) == "2025-01-02" and c.file_name_source == "apc250102.zip"
    assert got["intl_class"].first().intl_class_cd == "009" and got["us_class"].first().us_class_cd == "021"
    assert [(r.change_seq, r.change_text) for r in got["owner_name_change"].orderBy("change_seq").collect()] == [(1, "was X"), (2, "was Y")]
    assert got["owner"].first().own_nalty_country_cd == "CN" and got["event"].count() == 1 and got["madrid_intl_file"].count() == 0


@pytest.mark.parametrize("version", ["3.1", ""])
def test_unknown_version_stops(spark, tmp_path, version):
    path = archive(tmp_path, "apc250103.zip", [case("1")], version)
    with pytest.raises(Exception, match="version"):
        xml_zip.records(spark, [path]).count()


def test_crc(spark, tmp_path):
    good = archive(tmp_path, "apc250104.zip", [case("1")])
    bad = tmp_path / "apc250105.zip"
    bad.write_bytes(b"no zip")
    got = {r.path.rsplit("/", 1)[-1]: r.problem for r in xml_zip.crc_problems(spark, [good, str(bad)]).collect()}
    assert got["apc250104.zip"] is None and got["apc250105.zip"]


@pytest.fixture(scope="module")
def released(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    sanction = "<case-file-event-statement><code>KBOC</code><type>I</type><date>20210101</date><number>2</number></case-file-event-statement>"
    many = [case(str(k), mark=f"XQZT{k}", filing=f"2020{k % 12 + 1:02d}05", owner=f"Owner {k}", events=sanction if k == 3 else "") for k in range(1, 31)]
    paths = [
        archive(root, "apc18840407-20241231-01.zip", [case("1", mark="OLD"), case("90", mark="KEPT WORD", filing="20120301", country="US", attorney="Al Day")]),
        archive(root, "apc241230.zip", [case("90", mark="STALE")]),
        archive(root, "apc250101.zip", many),
        archive(root, "readme.zip", []),
    ]
    journal = Journal(str(root / "journal.db"))
    directory = B.build(spark, paths, str(root / "builds"), str(root / "parsed"), journal)
    B.reconciled(spark, directory, "2026-01-01", journal.facts("download"))
    B.release(spark, str(root / "builds"), directory, journal=journal)
    assert journal.report() == {"parse": {"done": 2}} and journal.facts("watermark") == {"annual_cutoff": "2024-12-31", "data_current_through": "2025-01-01"}
    return root, directory, paths


def test_build_takes_the_latest_file(spark, released):
    root, directory, paths = released
    marks = {r.serial_no: r.mark_id_char for r in B.load(spark, directory)["case_file"].collect()}
    assert len(marks) == 31 and marks["00000001"] == "XQZT1" and marks["00000090"] == "KEPT WORD"
    assert B.live(spark, str(root / "builds")) == directory
    before = B.load(spark, directory)["owner"].count()
    assert xml_zip.ingested(spark, paths[:1], str(root / "parsed"))["owner"].count() == 2 and xml_zip.ingested(spark, paths[2:3], str(root / "parsed"))["owner"].count() == 30 and before == 31
    assert "case_file" in tables.create_views(spark, directory) and spark.sql("SELECT count(*) n FROM case_file").first().n == 31


def test_derived_tables_and_lists(spark, released):
    root, directory, _ = released
    gold = str(root / "gold")
    out = B.derive(spark, directory, gold)
    f = {r.serial_no: r for r in out["mark_features_v1"].collect()}
    assert f["00000090"].single_token is False and f["00000001"].filing_basis == "use" and f["00000001"].goods_item_count == 2 and f["00000001"].owner_country == "CN" and f["00000001"].is_marketplace_class
    ops = out["operation_profile_v1"].collect()
    assert [(r.op_key, r.n_marks, r.owner_turnover, r.use1a_rate) for r in ops] == [("N:AGENT CORA", 30, 1.0, 1.0)]
    assert {(r.serial_no, r.label) for r in out["evaluation_labels_v1"].collect()} == {("00000003", "sanctioned")}
    sizes = B.detector_lists(spark, directory, gold, ("CN", "US"))
    assert sizes["tier1"] == 1 and sizes["origin_cn"] == 30 and sizes["origin_us"] == 1
    assert [r.value for r in spark.read.text(f"{gold}/detector_v1/tier1").collect()] == ["XQZT3"]
    months = {str(r.ym): r.n for r in out["event_series_v1"].collect()}
    # 30 filings over twelve months: 12 and 24 fall into January, 1 and 13 and 25 into February; the last two months are still filling
    assert months == {f"2020-{m:02d}-01": sum(k % 12 + 1 == m for k in range(1, 31)) for m in range(1, 11)}
    with pytest.raises(ValueError):
        B.same_build(spark, f"{gold}/mark_features_v1/_lineage.json", "/x/build-other")


def test_release_needs_gates_and_prunes(spark, tmp_path):
    root = str(tmp_path)
    for n in ("build-1", "build-2", "build-3", "build-4"):
        (tmp_path / n / "profile").mkdir(parents=True)
    with pytest.raises(ValueError):
        B.release(spark, root, f"{root}/build-4")
    assert B.live(spark, root) is None
    files.write_json(spark, {"build": "build-1"}, f"{root}/build-1/_passed.json")
    assert B.release(spark, root, f"{root}/build-1") == ["build-2"]
    assert B.live(spark, root).endswith("build-1") and (tmp_path / "build-1").exists()


def test_a_failed_build_keeps_its_profile_and_is_not_released(spark, tmp_path):
    """Gates run over what was written: here a late filing, an orphan, a record less than before and a file nobody recorded."""
    path = archive(tmp_path, "apc250106.zip", [case("1"), case("2", filing="20990101")])
    journal = Journal(str(tmp_path / "journal.db"))
    directory = B.build(spark, [path], str(tmp_path / "builds"), str(tmp_path / "parsed"), journal)
    orphan = tables.read_table(spark, directory, "owner").limit(1).withColumn("serial_no", F.lit("99999999"))
    orphan.write.mode("append").parquet(f"{directory}/owner")
    before = f"{tmp_path}/before"
    rows = tables.read_table(spark, directory, "case_file")
    rows.unionByName(rows).write.parquet(f"{before}/case_file")
    with pytest.raises(gates.GateError) as e:
        B.reconciled(spark, directory, "2026-01-01", ["apc250107.zip"], before)
    said = " ".join(e.value.failures)
    assert "owner: 1 rows without" in said and "filing_dt" in said and "4 before" in said and "source files are unknown" in said
    assert spark.read.csv(f"{directory}/profile/date_outliers", header=True).where("failed = 'true' and column_name = 'filing_dt'").count() == 1
    with pytest.raises(ValueError):
        B.release(spark, str(tmp_path / "builds"), directory)


def test_prune_waits_for_the_released_snapshot(spark, released, tmp_path):
    root, _, _ = released
    for n in ("apc18840407-20241231-01.zip", "apc241230.zip", "apc250101.zip"):
        (tmp_path / n).write_bytes(b"")
    assert B.pruned(spark, str(tmp_path / "none"), str(tmp_path)) == []
    assert B.pruned(spark, str(root / "builds"), str(tmp_path)) == ["apc241230.zip"] and not (tmp_path / "apc241230.zip").exists()
    (tmp_path / "apc18840407-20251231-01.zip").write_bytes(b"")
    assert B.pruned(spark, str(root / "builds"), str(tmp_path)) == []


def test_a_broken_parse_leaves_no_trace(spark, tmp_path, monkeypatch):
    path = archive(tmp_path, "apc250108.zip", [case("1"), case("2")])
    real = files.write_text
    monkeypatch.setattr(files, "write_text", lambda *a: (_ for _ in ()).throw(OSError("the run breaks off")))
    with pytest.raises(OSError):
        xml_zip.ingested(spark, [path], str(tmp_path / "parsed"))
    monkeypatch.setattr(files, "write_text", real)
    other = archive(tmp_path, "apc250109.zip", [case("3")])
    for _ in range(2):
        got = xml_zip.ingested(spark, [path, other], str(tmp_path / "parsed"))
        assert {t: df.count() for t, df in got.items() if t in ("owner", "case_file", "owner_name_change")} == {"owner": 3, "case_file": 3, "owner_name_change": 6}
    assert got["owner"].columns == TABLES["owner"].names and got["owner"].where("file_name_source = 'apc250109.zip'").count() == 1


class Shelf:
    """A transport over a dict."""

    def __init__(self, offered):
        self.offered = offered

    def listing(self):
        return {n: len(b) for n, b in self.offered.items()}

    def read(self, name):
        yield self.offered[name][:3]
        yield self.offered[name][3:]


def test_fetching_what_a_build_needs(tmp_path):
    import hashlib
    import http.server
    import json
    import threading

    offered = {"apc18840407-20241231-01.zip": b"snapshot", "apc241230.zip": b"covered", "apc250101.zip": b"daily", "notes.txt": b"no"}
    journal = Journal(":memory:")
    (tmp_path / "apc250101.zip").write_bytes(b"daily")
    assert remote.fetched(Shelf(offered), str(tmp_path), journal) == ["apc18840407-20241231-01.zip"] and remote.fetched(Shelf(offered), str(tmp_path), journal) == []
    assert journal.facts("download") == {"apc18840407-20241231-01.zip": hashlib.sha256(b"snapshot").hexdigest()}
    short = Shelf({"apc250102.zip": b"whole"})
    short.listing = lambda: {"apc250102.zip": 9}
    with pytest.raises(OSError):
        remote.fetched(short, str(tmp_path / "x"))
    assert list((tmp_path / "x").iterdir()) == []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            body = json.dumps(Shelf(offered).listing()).encode() if self.path == "/index.json" else offered[self.path[1:]]
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    assert remote.fetched(remote.Http(f"http://127.0.0.1:{server.server_port}"), str(tmp_path / "y")) == ["apc18840407-20241231-01.zip", "apc250101.zip"]
    server.shutdown()


def test_staging_and_review(spark, released, tmp_path):
    root, directory, _ = released
    gold = str(root / "gold2")
    B.derive(spark, directory, gold)
    (tmp_path / "codes.csv").write_text("code,text\n007,a\n")
    sizes = B.staged(spark, gold, str(tmp_path / "out"), ["mark_features_v1"], "Features", {"codes": str(tmp_path / "codes.csv")})
    assert sizes == {"mark_features_v1": 31} and "| `filing_year` | bigint |" in (tmp_path / "out/README.md").read_text() and spark.read.csv(str(tmp_path / "out/lookup_codes"), header=True).first().code == "007"
    with pytest.raises(PermissionError):
        B.staged(spark, gold, str(tmp_path / "no"), ["mark_features_v1", "operation_profile_v1"], "No")
    assert not (tmp_path / "no").exists()
    assert tables.provenance(spark, {"codes": str(tmp_path / "codes.csv")}).first().bytes == 16
    assert set(tables.create_views(spark, directory)) >= {"_build", "case_file"} and spark.sql("SELECT size(inputs) n, annual_cutoff c FROM _build").first().n == 2


def test_the_audit_document(spark, released, tmp_path, capsys):
    import json

    from registrum import cli

    root, directory, _ = released
    if not (root / "gold").exists():
        B.derive(spark, directory, str(root / "gold"))
    doc = cli._audit(spark, str(root / "gold"), directory)
    assert [r["op_key"] for r in doc["sample"]] == ["N:AGENT CORA"] and doc["sample"][0]["attorney_name"][0]["value"] == "Cora B. Agent"
    assert {r["variant"] for r in doc["variants"]} == {"shipped", "strict_hubs", "loose_hubs", "addr_first", "name_only", "addr_only"} and doc["variants"][0]["top_jaccard"] == 1.0
    json.dumps(doc, default=str)
    assert cli.main(["plan", "--root", str(tmp_path)]) == 0 and json.loads(capsys.readouterr().out.splitlines()[-1])["inputs"] == []


def test_file_names(spark):
    names = ["apc18840407-20231231-01.zip", "apc18840407-20241231-02.zip", "apc18840407-20241231-01.zip", "apc241231.zip", "apc250101.zip", "apc990101.zip", "x.zip", "apc251399.zip"]
    cutoff, got = filenames.selected(names)
    assert cutoff.isoformat() == "2024-12-31" and [s.name for s in got] == ["apc18840407-20241231-01.zip", "apc18840407-20241231-02.zip", "apc250101.zip"]
    assert filenames.prunable(names) == ["apc241231.zip", "apc990101.zip"]
    days = [r.d and r.d.isoformat() for r in spark.createDataFrame([(n,) for n in names], "n string").select(filenames.file_day(F.col("n")).alias("d")).collect()]
    assert days == [s and s.day.isoformat() for s in map(filenames.parsed, names)]


def test_journal():
    now = [100.0]
    j = Journal(":memory:", lambda: now[0])
    assert j.plan("scan", ["x2", "x1", "x3"]) == ["x1", "x2", "x3"] and j.plan("scan", ["x1", "x4"]) == ["x4"]
    first = j.take("scan", 60)
    j.finish("scan", first)
    assert (first, j.take("scan", 60), j.state("scan", "x1")) == ("x1", "x2", "done")
    now[0] += 59
    assert j.hold("scan", "x2", 60) and not j.hold("scan", "x1") and not j.hold("scan", "nothing")
    now[0] += 59
    assert j.take("scan", 10) == "x3"  # x2 is still held
    now[0] += 11
    assert [j.take("scan"), j.take("scan"), j.take("scan"), j.take("scan")] == ["x2", "x3", "x4", None]
    j.finish("scan", "x3", "e" * 5000)
    assert j.report() == {"scan": {"done": 1, "failed": 1, "held": 2}}
    assert j.reopen("scan", "x2") == [] and j.reopen("scan", "x1") == ["x1"] and j.reopen("scan") == ["x3"] and j.reopen("other") == []
    j.note("download", "f.zip", "00")
    j.note("download", "f.zip", "01")
    assert j.facts("download") == {"f.zip": "01"} and j.facts("watermark") == {}


def test_journal_of_two_processes(tmp_path):
    a, b = Journal(str(tmp_path / "j.db")), Journal(str(tmp_path / "j.db"))
    a.plan("s", map(str, range(6)))
    assert sorted([a.take("s"), b.take("s"), a.take("s"), b.take("s"), b.take("s"), a.take("s")]) == list("012345") and b.take("s") is None


def test_lookups_lists_and_json(spark, tmp_path):
    (tmp_path / "codes.csv").write_text("code,text\n007,a\n007,b\n")
    got = tables.read_lookup(spark, str(tmp_path / "codes.csv"))
    assert got.first().code == "007"
    assert tables.last_wins(got.withColumn("line", F.monotonically_increasing_id()), "code", "line").first().text == "b"
    (tmp_path / "d.json").write_text('{"day": "2024-12-31",\n "n": 1}')
    assert str(tables.read_document(spark, str(tmp_path / "d.json"), ("day",)).first().day) == "2024-12-31"
    assert tables.write_list(spark.createDataFrame([("A",), ("B",)], "key string"), str(tmp_path / "list")) == 2
    page = tables.review_page([{"key": "</script>\u2028&", "evidence": {"addr": [["1 Main St", 3]]}}], "b1", "<b>")
    assert page.count("</script>") == 2 and "\u2028" not in page and "<b>" not in page
    with pytest.raises(PermissionError):
        assert_publishable("operation_membership_v1")


def test_stream_equals_batch(spark, tmp_path):
    rows = [(1, 10, "a"), (1, 30, "b"), (2, 5, "c"), (1, 20, "d"), (2, 6, "e")]
    schema = "k int, t int, v string"
    for n, part in enumerate((rows[:2], rows[2:4], rows[4:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        upserts.merged_stream(stream, str(tmp_path / "state"), ["k"], ["t"], str(tmp_path / "check")).awaitTermination()
    assert sorted((r.k, r.t, r.v) for r in upserts.state(spark, str(tmp_path / "state")).collect()) == [(1, 30, "b"), (2, 6, "e")]
