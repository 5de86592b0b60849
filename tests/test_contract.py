"""Published vectors and the rules of text, ids, plans, retries and pages."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerfold.functions import canon, ident
from ledgerfold.operators import enrich
from ledgerfold.operators.fold import fold, log_violations, state_violations, union_checked
from ledgerfold.operators.project import Scope, project, projection_violations, scope_errors, text_repairs
from ledgerfold.plans.planner import ProducerConfig, calendar, capacity_status, chain_breaks, check_changed, frontier, pending_gaps, plan_collection, retry_delay
from ledgerfold.schemas import OBSERVATION, RAW_RECORD, RETRACT_RECORD, SOURCE_RECORD, TASK
from ledgerfold.sources.objects import ObjectWriter, greedy_parts, read_objects, shard_violations, write_parts
from ledgerfold.sources.pages import Transport, fetch_search, harvest_day, harvest_summary, harvest_violations, page_violations, parse_pages, parse_search, record_violations, records_of, source_timestamp

from .feed_samples import SCOPE, frame, raw

# Published vectors.
OBJECT = ({"z": 1, "a": "é", "nested": {"b": True, "a": None}}, '{"a":"é","nested":{"a":null,"b":true},"z":1}', "sha256:be6f947af498e50d32e9744384b9b5d3422f83139daa3fabebab3642bbcbc5a5")
GZIP = ("one\ntwo\n", "sha256:d4904ec40e7bc7bc9990fde125acca63b7a677ca4111bda671807584519c9d47")
MODERN_KEY = "sha256:cbfb3517cc1ea9391e6a109bcd4225ff15a30f4ad0b042d7d0fa5589963bc156"
MODERN_CONTENT = "sha256:660cb1b7169e2d64c98fbe391ee133957903096d9425474233d04a9f4260d20c"
MODERN = (
    "2607.01234", 2, ("search_api_optional", "oai_arxiv_raw", "search_api_optional", "oai_arxiv_raw"), MODERN_KEY,
    ("We study a vision-language-action policy.\nIt transfers to a real robot.", [("Alice Example",), ("Bob Example",)], "Alice Example, Bob Example", ["cs.AI", "cs.RO"], None, None, None, None, "cs.RO", "A Physical AI Policy for Mobile Manipulation"),
    "oai:arXiv.org:2607.01234", "upsert", "2026-07-13", ["cs:cs:AI", "cs:cs:RO"], [("2026-07-02T16:12:00Z", 1), ("2026-07-12T10:05:00Z", 2)], "2607.01234v2",
)


def one(spark, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema)


def test_vectors(spark):
    assert canon.json_bytes(OBJECT[0]).decode() == OBJECT[1] and canon.bytes_hash(canon.file_bytes(OBJECT[0])) == OBJECT[2]
    assert canon.bytes_hash(canon.gzip_bytes(GZIP[0].encode())) == GZIP[1]
    df = spark.createDataFrame([(MODERN,)], f"r {SOURCE_RECORD}")
    content = canon.content_hash(F.col("r"))
    got = df.select(ident.record_key(F.col("r.oai_identifier")), content, ident.observation_id("sample-v1", F.col("r.oai_identifier"), F.col("r.source_datestamp"), F.col("r.operation"), content, F.lit(None).cast("string"))).first()
    parts = [ident.DOMAIN_OBSERVATION, "sample-v1", "oai:arXiv.org:2607.01234", "2026-07-13", "upsert", MODERN_CONTENT, None]
    assert tuple(got) == (MODERN_KEY, MODERN_CONTENT, canon.bytes_hash(canon.json_bytes(parts)))


@pytest.mark.parametrize("value", [1.5, 1 << 60, {1: 2}, object()])
def test_json_that_has_no_canonical_form(value):
    with pytest.raises((ValueError, AttributeError)):
        canon.json_bytes({"a": value} if not isinstance(value, dict) else value)


TEXT = [("  A \t b\r\nc d ", "A b c d", "A b\nc d"), ("é", "é", "é"), ("x  \n\n y\r z ", "x y z", "x\n\n y\n z"), (" a ", "a", "a"), ("", "", ""), (None, None, None), ("\n \t", "", "")]


def test_normal_forms(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in TEXT], "v string")
    got = df.select("v", canon.normalize_single_line(F.col("v")), canon.normalize_multiline(F.col("v"))).collect()
    assert [tuple(r) for r in got] == TEXT
    odd = one(spark, "a\x00b\x0bc\x0bd\te\nf\x85")
    r = odd.select(canon.sanitize_controls(F.col("v")).alias("s"), canon.control_repairs(F.col("v")).alias("r"), canon.has_control(F.col("v")).alias("h")).first()
    assert r["s"] == "a b c d\te\nf " and [tuple(x) for x in r["r"]] == [("U+0000", 1), ("U+000B", 2), ("U+0085", 1)] and r["h"]


def test_ids(spark):
    cases = {"2607.01234": ("2607.01234", None), "2607.01234v2": ("2607.01234", 2), "hep-th/9901001v10": ("hep-th/9901001", 10), "2607.01234v0": None, "2607.012": None, "٢٦٠٧.01234": None, "": None, None: None}
    df = spark.createDataFrame([(c,) for c in cases], "v string")
    for r in df.select("v", ident.parse_id(F.col("v")).alias("p"), ident.base_id_of(F.concat(F.lit("oai:arXiv.org:"), "v")).alias("b"), ident.versioned_id(F.lit("x"), F.lit(3)).alias("n")).collect():
        want = cases[r["v"]]
        assert (tuple(r["p"]) if r["p"] else None) == want and r["n"] == "xv3"
        assert r["b"] == (want[0] if want and want[1] is None else None)
    url = one(spark, "http://x.example/abs/2607.01234v2?a=/b").select(ident.id_from_url(F.col("v")).alias("p")).first()["p"]
    assert tuple(url) == ("2607.01234", 2)
    paths = spark.createDataFrame([("a/b.json",), ("../a",), ("/a",), ("a//b",), ("a/./b",), ("a\\b",), ("",)], "v string")
    assert [r[0] for r in paths.select(canon.is_safe_path(F.col("v"))).collect()] == [True] + [False] * 6


def test_plans():
    c, today = ProducerConfig(), date(2026, 7, 31)
    first = plan_collection(today, c)
    assert first.coverage_start == date(2026, 7, 1) and first.source_dates == ["2026-07-01", "2026-07-02", "2026-07-03", "2026-07-04", "2026-07-05"] and len(first.pending_before) == 30
    some = plan_collection(today, c, date(2026, 7, 1), date(2026, 7, 28))
    assert some.source_dates == ["2026-07-29", "2026-07-30", "2026-07-31"]
    steady = plan_collection(today, c, date(2026, 7, 1), date(2026, 7, 30))
    assert steady.source_dates == ["2026-07-30", "2026-07-31"] and steady.pending_before == []
    assert plan_collection(today, ProducerConfig(max_changed_partitions=1), date(2026, 7, 1), date(2026, 7, 30)).source_dates == ["2026-07-30"]
    with pytest.raises(ValueError):
        ProducerConfig(bootstrap_days=0)
    assert capacity_status(1, c) == "ok" and capacity_status(c.warning_bytes, c) == "warning"
    with pytest.raises(ValueError):
        capacity_status(c.stop_bytes, c)
    check_changed(["d"] * 9, c, "full_projection_correction")
    with pytest.raises(ValueError):
        check_changed(["d"] * 9, c)
    assert retry_delay(3) == 4 and retry_delay(1, "7") == 7 and retry_delay(1, None, 5.0) == 1.25


def test_frontier(spark):
    closed = spark.createDataFrame([("2026-07-01",), ("2026-07-02",), ("2026-07-04",)], "source_date string")
    assert tuple(frontier(spark, closed, "2026-07-01", "2026-07-06").first()) == ("2026-07-02", 2)
    assert [r[0] for r in pending_gaps(spark, closed, "2026-07-01", "2026-07-06").orderBy("source_date").collect()] == ["2026-07-03", "2026-07-04", "2026-07-05"]
    assert tuple(frontier(spark, closed.limit(0), "2026-07-01", "2026-07-02").first()) == (None, 1)
    assert tuple(frontier(spark, closed, "2026-07-01", "2026-07-03").first()) == ("2026-07-02", 0)
    assert calendar(spark, "2026-07-02", "2026-07-01").count() == 0
    m = spark.createDataFrame([("d1", "g", "a"), ("d2", "a", "b"), ("d3", "x", "c")], "source_date string, projection_base_hash string, projection_result_hash string")
    assert [tuple(r) for r in chain_breaks(m, "g").collect()] == [("projection_base_differs", "d3")]


def test_scope(spark):
    assert scope_errors(SCOPE) == [] and scope_errors(SCOPE | {"keywords": ["x"]}) and scope_errors(SCOPE | {"categories": ["b", "a"]}) and scope_errors({})
    with pytest.raises(ValueError):
        Scope.of(SCOPE | {"include_crosslists": False})
    df = spark.createDataFrame([(["cs.SY"],), (["cs.XX"],), ([],), (None,)], "c array<string>")
    assert [r[0] for r in df.select(Scope.of(SCOPE).contains(F.col("c"))).collect()] == [True, False, False, False]


def test_projection(spark):
    rows = [
        raw(1, "2026-07-01"), raw(1, "2026-07-02"), raw(1, "2026-07-03", ("cs.XX",)), raw(1, "2026-07-04", deleted=True), raw(1, "2026-07-05", deleted=True),
        raw(2, "2026-07-01", ("cs.XX",), title="bad \x00 text"), raw(3, "2026-07-01", deleted=True), raw(4, "2026-07-01", title=" A\x0b  title "), raw(4, "2026-07-02", title="A title"),
    ]
    scope = Scope.of(SCOPE)
    got = project(frame(spark, rows), scope)
    seen = {(r["record"]["base_arxiv_id"][-1], r["partition_date"]): r for r in got.collect()}
    assert {k: r["operation"] for k, r in seen.items()} == {("1", "2026-07-01"): "upsert", ("1", "2026-07-02"): "upsert", ("1", "2026-07-03"): "scope_exit", ("1", "2026-07-04"): "source_delete", ("4", "2026-07-01"): "upsert", ("4", "2026-07-02"): "upsert"}
    assert seen["4", "2026-07-01"]["record"]["metadata"]["title"] == "A title"
    assert seen["1", "2026-07-03"]["record"]["version_history"] == [] and seen["1", "2026-07-04"]["record"]["metadata"] is None
    assert seen["1", "2026-07-02"]["supersedes_observation_id"] == seen["1", "2026-07-01"]["observation_id"]
    # order of rows and partitions does not matter; a state in between neither
    again = project(frame(spark, rows[::-1]).repartition(7), scope)
    assert {r["observation_id"] for r in again.collect()} == {r["observation_id"] for r in seen.values()}
    first = project(frame(spark, [r for r in rows if r[6] <= "2026-07-02"]), scope)
    rest = project(frame(spark, [r for r in rows if r[6] > "2026-07-02"]), scope, fold(first))
    assert {r[0] for r in first.unionByName(rest).select("observation_id").collect()} == {r["observation_id"] for r in seen.values()}
    state = {r["logical_record_key"]: r for r in fold(got).collect()}
    assert sorted((r["ever_in_scope"], r["active_in_scope"], r["source_deleted"]) for r in state.values()) == [(True, False, True), (True, True, False)]
    assert [(r["field"], r["code_point"], r["count"]) for r in text_repairs(frame(spark, rows)).orderBy("oai_identifier").collect()] == [("title", "U+0000", 1), ("title", "U+000B", 1)]
    assert project(frame(spark, []), scope).count() == 0 and fold(spark.createDataFrame([], OBSERVATION)).count() == 0


def obs(oid, key, op="upsert", sup=None, day="2026-07-01", target=None, replacement=None):
    retract = {"logical_record_key": key, "operation": op, "target_observation_id": target, "replacement_observation_id": replacement} if op == "producer_retract" else None
    full = {c.split(":")[0]: (retract or {}).get(c.split(":")[0]) for c in RETRACT_RECORD[7:-1].split(",")} if retract else None
    return (key, oid, op, day, None, "h" + oid, full, sup)


def test_rules_of_a_log(spark):
    rows = [
        obs("a", "1"), obs("b", "1", sup="a"), obs("c", "1", sup="a"), obs("d", "2"), obs("e", "2"), obs("f", "3", sup="gone"), obs("g", "4", "source_delete"), obs("h", "4", sup="g"), obs("i", "5", sup="d"), obs("j", "6"), obs("j", "6"),
        obs("r1", "7", "producer_retract", target="nope"), obs("r2", "8", "producer_retract", target="d", replacement="zz"), obs("k", "9"), obs("r3", "9", "producer_retract", target="k", replacement="a"),
    ]
    got = {(r["rule"], r["key"]) for r in log_violations(spark.createDataFrame(rows, OBSERVATION)).collect()}
    assert got >= {("fork", "1"), ("orphan", "3"), ("after_delete", "4"), ("duplicate_id", "6"), ("retract_target_absent", "7"), ("retract_key_differs", "8"), ("replacement_absent", "8"), ("replacement_key_differs", "9")}
    assert ("second_root", "2") not in got  # its other root is retracted
    sound = [obs("a", "1"), obs("b", "1", sup="a"), obs("c", "2"), obs("r", "2", "producer_retract", target="c")]
    assert log_violations(spark.createDataFrame(sound, OBSERVATION)).count() == 0
    both, conflicts = union_checked(spark.createDataFrame(sound, OBSERVATION), spark.createDataFrame([obs("a", "1", sup="x"), obs("n", "3")], OBSERVATION))
    assert both.count() == 5 and [r[0] for r in conflicts.collect()] == ["a"]


def test_retries(spark):
    df = spark.createDataFrame([(0,), (5,), (6,), (9,)], "n int").select(*[c.alias(f"c{i}") for i, c in enumerate(enrich.after_failure(F.col("n"), F.lit("2026-07-01").cast("date")))])
    assert [tuple(r) for r in df.collect()] == [(1, "pending", "2026-07-02"), (6, "pending", "2026-07-02"), (7, "deferred", "2026-07-08"), (10, "deferred", "2026-07-08")]
    tasks = spark.createDataFrame([], TASK)
    assert tuple(enrich.backlog_age_hours(tasks, "2026-07-01T00:00:00Z").first()) == (0, None)
    assert enrich.task_violations(tasks).count() == 0
    ids = spark.createDataFrame([("b",), ("a",), ("b",)], "base_arxiv_id string")
    assert [tuple(r) for r in enrich.request_list(tasks, ids, "2026-07-01", 5, 1).orderBy("rank").collect()] == [("a", 1, 0), ("b", 2, 1)]
    assert enrich.request_list(tasks, ids, "2026-07-01", 0, 1).count() == 0
    out = enrich.search_outcomes(ids, spark.createDataFrame([(None, None, "a", None, None, 1)], "abstract string, authors array<struct<name:string>>, base_arxiv_id string, primary_category string, title string, version int"))
    assert {r["base_arxiv_id"]: r["error_kind"] for r in out.collect()} == {"a": None, "b": "search_missing"}


PAGE = """<?xml version="1.0"?><o:OAI-PMH xmlns:o="http://www.openarchives.org/OAI/2.0/" xmlns:raw="http://arxiv.org/OAI/arXivRaw/"><o:responseDate>2026-07-14T05:00:00Z</o:responseDate>{0}</o:OAI-PMH>"""
LIVE = """<o:record><o:header><o:identifier>oai:arXiv.org:2607.00001</o:identifier><o:datestamp>2026-07-14</o:datestamp><o:setSpec>cs:cs:RO</o:setSpec></o:header><o:metadata><raw:arXivRaw><raw:id>2607.00001</raw:id>
<raw:version version="v1"><raw:date>Thu, 2 Jul 2026 16:12:00 GMT</raw:date></raw:version><raw:title> A &amp; B </raw:title><raw:categories>cs.RO cs.AI cs.RO</raw:categories><raw:abstract> </raw:abstract></raw:arXivRaw></o:metadata></o:record>"""
GONE = '<o:record><o:header status="deleted"><o:identifier>oai:arXiv.org:hep-th/9901001</o:identifier><o:datestamp>2026-07-14</o:datestamp></o:header></o:record>'


def listed(*records, token=""):
    return PAGE.format(f"<o:ListRecords>{''.join(records)}<o:resumptionToken>{token}</o:resumptionToken></o:ListRecords>")


def pages_of(spark, *texts):
    return spark.createDataFrame([("2026-07-14", i, bytearray(t.encode())) for i, t in enumerate(texts, 1)], "source_date string, page_no int, payload binary")


def test_pages(spark):
    pages = pages_of(spark, listed(LIVE, token=" t1 "), listed(GONE), PAGE.format('<o:error code="noRecordsMatch">none</o:error>'))
    parsed = parse_pages(pages)
    assert page_violations(pages).count() == 0
    rows = {r["base_arxiv_id"]: r for r in records_of(parsed).collect()}
    live = rows["2607.00001"]
    assert live["metadata"]["title"] == " A & B " and live["metadata"]["abstract"] is None and live["metadata"]["categories"] == ["cs.AI", "cs.RO"] and live["versioned_arxiv_id"] == "2607.00001v1"
    assert [tuple(v) for v in live["version_history"]] == [("2026-07-02T16:12:00Z", 1)] and live["source_sets"] == ["cs:cs:RO"]
    assert rows["hep-th/9901001"]["deleted"] and rows["hep-th/9901001"]["metadata"] is None
    assert record_violations(records_of(parsed)).count() == 0
    assert harvest_summary(parsed).first()["token_exhausted"] and harvest_violations(parsed, records_of(parsed)).count() == 0
    twice = parse_pages(pages_of(spark, listed(LIVE, token="t"), listed(LIVE, token="t")))
    assert {r["rule"] for r in harvest_violations(twice, records_of(twice)).collect()} == {"not_exhausted", "token_recurs", "identifier_repeats"}


@pytest.mark.parametrize(("text", "rule"), [("<!DOCTYPE x>" + listed(LIVE), "declaration"), (PAGE.format('<o:error code="badResumptionToken">x</o:error>'), "error_answer"), ("<feed/>", "wrong_root"), (PAGE.format(""), "no_records_element"), ("no xml", "wrong_root")])
def test_broken_pages(spark, text, rule):
    assert rule in {r["rule"] for r in page_violations(pages_of(spark, text)).collect()}


@pytest.mark.parametrize(("old", "new", "rule"), [("2607.00001</raw:id>", "2607.00002</raw:id>", "raw_id_differs"), ('version="v1"', 'version="x"', "versions_not_increasing"), ("Thu, 2 Jul 2026 16:12:00 GMT", "soon", "version_date_malformed"), ("2026-07-14</o:datestamp>", "2026-07</o:datestamp>", "datestamp_malformed"), ("cs.RO cs.AI cs.RO", " ", "categories_missing")])
def test_broken_records(spark, old, new, rule):
    rows = records_of(parse_pages(pages_of(spark, listed(LIVE.replace(old, new)))))
    assert rule in {r["rule"] for r in record_violations(rows).collect()}


def test_source_dates(spark):
    df = spark.createDataFrame([("Thu, 2 Jul 2026 16:12:00 GMT",), ("2 Jul 2026 16:12:00 +0200",), ("Thu, 2 Jul 2026 16:12:00",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(source_timestamp(F.col("v"))).collect()] == ["2026-07-02T16:12:00Z", "2026-07-02T14:12:00Z", "2026-07-02T16:12:00Z", None, None]


def test_search_answers(spark):
    feed = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:a="http://arxiv.org/schemas/atom"><entry><id>http://x.example/abs/2607.00001v2</id><title>A
      title</title><summary>Some text. </summary><author><name>Alice  Example</name></author><author><name>Bob</name></author><a:primary_category term="cs.RO"/></entry></feed>"""
    r = parse_search(pages_of(spark, feed)).first()
    assert (r["base_arxiv_id"], r["version"], r["title"], r["abstract"], r["primary_category"], [a["name"] for a in r["authors"]]) == ("2607.00001", 2, "A title", "Some text.", "cs.RO", ["Alice Example", "Bob"])


def test_transport():
    slept, asked = [], []
    answers = [(503, {"Retry-After": "5"}, b""), (200, {}, listed(LIVE, token="t1").encode()), (429, {}, b""), (200, {}, listed(GONE).encode())]

    def opener(url, timeout):
        asked.append(url)
        return answers.pop(0)

    now = [0.0]
    t = Transport(opener, sleep=lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)), clock=lambda: now[0], jitter=lambda: 0.0)
    assert len(list(harvest_day(t, "http://x.example/oai", "2026-07-14"))) == 2
    assert "from=2026-07-14&until=2026-07-14" in asked[0] and asked[-1].endswith("verb=ListRecords&resumptionToken=t1") and 5.0 in slept
    with pytest.raises(OSError, match="404"):
        Transport(lambda u, s: (404, {}, b""), sleep=lambda s: None).get("u")
    loop = Transport(lambda u, s: (200, {}, listed(LIVE, token="same").encode()), sleep=lambda s: None)
    with pytest.raises(ValueError, match="recurs"):
        list(harvest_day(loop, "http://x.example", "2026-07-14"))


def test_search_requests():
    asked = []

    def opener(url, timeout):
        asked.append(url)
        return (200, {}, b"<feed/>") if "2607.00003" not in url else (400, {}, b"")

    got = list(fetch_search(Transport(opener, sleep=lambda s: None), "http://x.example/api", ["2607.00002", "2607.00001", "2607.00001", "2607.00003"], 2))
    assert got == [(["2607.00001", "2607.00002"], b"<feed/>"), (["2607.00003"], None)]
    assert "id_list=2607.00001%2C2607.00002&start=0&max_results=2" in asked[0]


def test_parts(spark, tmp_path):
    lines = spark.createDataFrame([("g", i, "x" * n + "\n") for i, n in enumerate([3, 3, 3, 50, 1, 8])] + [("h", 0, "y\n")], "g string, i int, line string")
    cut = {(r["g"], r["i"]): r["ordinal"] for r in greedy_parts(lines, "g", ["i"], 10).collect()}
    assert [cut["g", i] for i in range(6)] == [0, 0, 1, 2, 3, 4] and cut["h", 0] == 0
    parts = write_parts(lines, str(tmp_path), "g", ["i"], 10).collect()
    proofs = spark.createDataFrame(parts)
    back = read_objects(proofs, str(tmp_path), ["g", "ordinal"])
    assert back.filter("fault is not null").count() == 0
    assert "".join(r["line"] + "\n" for r in back.filter("g = 'g'").orderBy("ordinal", "line_no").collect()) == "".join("x" * n + "\n" for n in [3, 3, 3, 50, 1, 8])
    again = write_parts(lines.repartition(3), str(tmp_path), "g", ["i"], 10).collect()
    assert sorted(r["path"] for r in again) == sorted(r["path"] for r in parts)  # the same bytes, the same objects
    bad = read_objects(proofs.withColumn("record_count", F.col("record_count") + 1), str(tmp_path), ["g", "ordinal"])
    assert {r["fault"] for r in bad.filter("fault is not null").collect()} == {"record_count_differs"}
    gone = read_objects(proofs.withColumn("path", F.lit("nowhere")), str(tmp_path), ["g", "ordinal"])
    assert {r["fault"] for r in gone.collect()} == {"object_missing"}
    w = ObjectWriter(str(tmp_path / "one"), "objects")
    w.line(b"one\n")
    w.line(b"two\n")
    assert w.close()[2] == GZIP[1]
    keys = spark.createDataFrame([("sha256:" + "a" * 64,), ("sha256:" + "a" * 64,), ("x",), (None,)], "k string")
    assert {r["rule"] for r in shard_violations(keys, "k").collect()} == {"key_malformed", "key_repeats"}


def test_raw_schema_order():
    names = [f.strip().split(" ")[0] for f in RAW_RECORD.split(", ")]
    assert names == sorted(names)


def test_requests_name_a_contact_and_wait_with_jitter():
    with pytest.raises(ValueError, match="contact"):
        Transport(agent="somebody")
    assert Transport(agent="ledgerfold (+https://x.example)").attempts == 4
    slept, answers = [], [(503, {}, b""), (200, {}, b"<x/>")]
    t = Transport(lambda u, s: answers.pop(0), interval=0.0, sleep=slept.append, jitter=lambda: 0.2)
    assert t.get("u") == b"<x/>" and slept == [1.2]


def test_token_with_an_entity_is_sent_back_as_it_is():
    asked = []

    def opener(url, timeout):
        asked.append(url)
        return 200, {}, b"<OAI-PMH><ListRecords><resumptionToken>a&amp;b</resumptionToken></ListRecords></OAI-PMH>" if len(asked) == 1 else b"<OAI-PMH/>"

    assert len(list(harvest_day(Transport(opener, sleep=lambda s: None), "http://x.example", "2026-01-01"))) == 2
    assert asked[1].endswith("resumptionToken=a%26b")


def test_state_and_projection_breaches(spark):
    k = "sha256:" + "0" * 64
    rows = [(k, True, True, False), (k, False, True, False), (k, True, True, True), ("x", True, False, True)]
    df = spark.createDataFrame(rows, "logical_record_key string, ever_in_scope boolean, active_in_scope boolean, source_deleted boolean")
    assert sorted(r["rule"] for r in state_violations(df).collect()) == ["active_and_deleted", "active_never_in_scope", "key_malformed"]
    late = frame(spark, [raw(1, "2026-07-01"), raw(1, "2026-07-02", deleted=True), raw(1, "2026-07-03")])
    scope = Scope.of(SCOPE)
    with pytest.raises(Exception, match="source_delete is terminal"):
        project(late, scope).collect()
    assert [r["operation"] for r in project(late, scope, breaches="skip").sort("partition_date").collect()] == ["upsert", "source_delete"]
    assert [(r["rule"], r["source_datestamp"]) for r in projection_violations(late, scope).collect()] == [("after_delete", "2026-07-03")]
