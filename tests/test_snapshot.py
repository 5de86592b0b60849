from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerfold.operators import enrich
from ledgerfold.operators.correct import SPEC, build_retractions, correction_violations
from ledgerfold.operators.fold import envelope_violations, fold, heads, live_observations, log_violations
from ledgerfold.plans.snapshot import Producer, build, load, snapshot_violations, unreferenced, write_status
from ledgerfold.sources.objects import copy_tree, list_files, tree_diff, tree_digest

from .feed_samples import SCOPE, frame, query, raw

PRODUCER = Producer("a" * 40, "sha256:" + "1" * 64, "sha256:" + "2" * 64)
START = date(2026, 7, 1)


def run(spark, root, rows, days, today, **more):
    return build(spark, root, SCOPE, frame(spark, rows), {d: query(d) for d in days}, today, more.pop("at", "2026-07-04T06:00:00Z"), START, PRODUCER, **more)


def found(df):
    return {(r["rule"], r["key"]) for r in df.collect()}


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("feed"))
    rows = [raw(1, "2026-07-01"), raw(2, "2026-07-01", ("cs.CL",)), raw(3, "2026-07-01", ("cs.SY",)), raw(1, "2026-07-02", ("cs.CL",)), raw(3, "2026-07-02", deleted=True), raw(4, "2026-07-03")]
    built = run(spark, root, rows, ["2026-07-01", "2026-07-02", "2026-07-03"], date(2026, 7, 3))
    return root, built, rows


def test_bootstrap_is_sound(spark, published):
    root, built, _ = published
    assert built.closed_complete_through == "2026-07-02" and built.provisional_dates == ["2026-07-03"]
    assert built.changed_partitions == ["2026-07-01", "2026-07-02", "2026-07-03"]
    assert found(snapshot_violations(spark, root)) == set()
    assert unreferenced(spark, root).count() == 0
    index, manifests, rows, tasks = load(spark, root)
    ops = {(r["partition_date"], r["operation"], r["record"]["base_arxiv_id"][-1]) for r in rows.collect()}
    assert ops == {("2026-07-01", "upsert", "1"), ("2026-07-01", "upsert", "3"), ("2026-07-02", "scope_exit", "1"), ("2026-07-02", "source_delete", "3"), ("2026-07-03", "upsert", "4")}
    assert found(envelope_violations(rows, "sample-v1")) == set() and found(log_violations(rows)) == set()
    assert [m["counts"]["upsert"] for m in manifests] == [2, 0, 1]


def test_repeat_changes_nothing(spark, published):
    root, built, rows = published
    again = run(spark, root, rows, ["2026-07-01", "2026-07-02", "2026-07-03"], date(2026, 7, 3))
    assert again.changed_partitions == [] and again.feed_root_sha256 == built.feed_root_sha256


def test_provisional_day_closes_only_when_asked(spark, published, tmp_path):
    root, _, rows = published
    copy = str(tmp_path / "copy")
    copy_tree(root, copy)
    later = run(spark, copy, [], [], date(2026, 7, 4), at="2026-07-04T07:00:00Z")
    assert later.closed_complete_through == "2026-07-02"
    closed = run(spark, copy, rows, ["2026-07-03"], date(2026, 7, 4), at="2026-07-04T08:00:00Z")
    assert closed.closed_complete_through == "2026-07-03" and closed.provisional_dates == []
    assert found(snapshot_violations(spark, copy)) == set()


def test_change_of_history_needs_the_full_kind(spark, published, tmp_path):
    root, _, rows = published
    copy = str(tmp_path / "copy")
    copy_tree(root, copy)
    changed = [raw(1, "2026-07-01", title="Another title")]
    with pytest.raises(ValueError, match="full_projection_correction"):
        run(spark, copy, changed, ["2026-07-01"], date(2026, 7, 3))
    built = run(spark, copy, changed, ["2026-07-01"], date(2026, 7, 3), kind="full_projection_correction")
    assert set(built.changed_partitions) >= {"2026-07-01", "2026-07-02"}
    assert found(snapshot_violations(spark, copy)) == set()


def test_retraction_of_a_middle_row(spark, published, tmp_path):
    root, _, _ = published
    copy = str(tmp_path / "copy")
    copy_tree(root, copy)
    _, _, rows, _ = load(spark, copy)
    target = rows.filter("operation = 'upsert' and record.base_arxiv_id like '%1'").first()["observation_id"]
    spec = spark.createDataFrame([("fix-1", target, "2026-07-03T00:00:00Z", "wrong", "It was wrong.", None)], SPEC)
    assert found(correction_violations(rows, spec)) == set()
    retract = build_retractions(rows, spec, "sample-v1")
    built = run(spark, copy, [], [], date(2026, 7, 3), kind="full_projection_correction", corrections=retract)
    assert "2026-07-01" in built.changed_partitions
    assert found(snapshot_violations(spark, copy)) == set()
    _, _, after, _ = load(spark, copy)
    assert ("target_already_retracted", "fix-1") in found(correction_violations(after, spec))
    key = rows.filter("record.base_arxiv_id like '%1'").first()["logical_record_key"]
    head = fold(after).filter(F.col("logical_record_key") == key).first()
    assert head["operation"] == "scope_exit" and not head["ever_in_scope"]


def test_tampering_is_found(spark, published, tmp_path):
    import gzip
    import pathlib

    root, _, _ = published
    copy = str(tmp_path / "copy")
    copy_tree(root, copy)
    part = next(pathlib.Path(copy, "objects").rglob("*.gz"))
    part.write_bytes(gzip.compress(gzip.decompress(part.read_bytes()) + b"{}\n"))
    assert any(r == "compressed_hash_differs" for r, _ in found(snapshot_violations(spark, copy)))
    (pathlib.Path(copy) / "feed.json").write_text("{}\n")
    assert any(r == "document_unreadable" for r, _ in found(snapshot_violations(spark, copy)))


def test_keys_of_documents(spark, published):
    from ledgerfold.plans.snapshot import document_errors, key_errors
    from ledgerfold.sources.objects import read_document

    root, _, _ = published
    feed = read_document(root, "feed.json")
    index = read_document(root, feed["scopes"][0]["index_path"])
    manifests = [read_document(root, p["manifest_path"]) for p in index["partitions"]]
    assert document_errors(feed, index, manifests) == []
    assert document_errors(feed, index | {"more": 1}, manifests) == [("keys_differ", "index: more is unexpected")]
    assert ("count_negative", "2026-07-01") in document_errors(feed, index, [manifests[0] | {"counts": manifests[0]["counts"] | {"new": -1}}])
    assert key_errors("query", None) == ["query: not an object"]


def test_enrichment(spark, published, tmp_path):
    root, _, rows = published
    copy = str(tmp_path / "copy")
    copy_tree(root, copy)
    built = run(spark, copy, [], [], date(2026, 7, 3), enrichment=True, at="2026-07-03T07:00:00Z")
    assert built.backlog == 1
    result = spark.createDataFrame([("Some text.", [("Alice Example",)], "2607.00004", "cs.RO", "A title", 1)], "abstract string, authors array<struct<name:string>>, base_arxiv_id string, primary_category string, title string, version int")
    asked = spark.createDataFrame([("2607.00004",)], "base_arxiv_id string")
    built = run(spark, copy, [], [], date(2026, 7, 3), enrichment=True, outcomes=enrich.search_outcomes(asked, result), at="2026-07-03T08:00:00Z")
    assert built.backlog == 0 and built.changed_partitions == ["2026-07-03"]
    assert found(snapshot_violations(spark, copy)) == set()
    # asking the source again does not undo it
    again = run(spark, copy, rows, ["2026-07-03"], date(2026, 7, 3), enrichment=True, at="2026-07-03T09:00:00Z")
    assert again.changed_partitions == []
    _, _, after, _ = load(spark, copy)
    assert heads(live_observations(after)).filter("record.metadata.primary_category = 'cs.RO'").count() == 1


def test_status_and_trees(spark, published, tmp_path):
    root, built, _ = published
    copy = str(tmp_path / "copy")
    copy_tree(root, copy)
    before = list_files(spark, root)
    _, _, rows, _ = load(spark, copy)
    write_status(spark, copy, built, "2026-07-04T06:00:00Z", {}, rows, 10, 5, "ok", "https://example.org/run")
    assert found(snapshot_violations(spark, copy)) == set()
    assert [r["path"] for r in tree_diff(list_files(spark, copy), before).collect()] == ["scopes/sample-v1/status/latest.json"]
    assert tree_digest(before).first()["digest"].startswith("sha256:")
    (tmp_path / "copy" / "stray").write_text("x")
    with pytest.raises(ValueError, match="unexpected"):
        copy_tree(copy, str(tmp_path / "other"))
