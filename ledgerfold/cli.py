"""Commands over a published tree: ``collect``, ``validate`` and ``publish``."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.functions import canon
from ledgerfold.operators import enrich
from ledgerfold.operators.correct import SPEC, build_retractions, correction_violations
from ledgerfold.operators.fold import new_observations
from ledgerfold.plans.planner import ProducerConfig, capacity_status, plan_collection
from ledgerfold.plans.snapshot import Producer, build, load, query_block, snapshot_violations, write_status
from ledgerfold.sources.objects import copy_tree, exists, list_files, read_document, tree_diff, write_document
from ledgerfold.sources.pages import ChangeStream, Transport, fetch_search, harvest_summary, harvest_violations, page_violations, parse_pages, parse_search, read_saved_pages, record_violations, records_of
from ledgerfold.schemas import RAW_RECORD
from ledgerfold.session import ship
from ledgerfold.storage import write_table


class Rejected(ValueError):
    """A snapshot, page or correction that breaks a rule."""


def refuse(df: DataFrame, what: str) -> None:
    """Raise with a few of the violations if there are any."""
    bad = [f"{r['rule']}: {r['key']}" for r in df.limit(5).collect()]
    if bad:
        raise Rejected(f"{what}: {'; '.join(bad)}")


def harvest(spark: SparkSession, days: list[str], pages: str | None, endpoint: str | None, agent: str = "") -> tuple[DataFrame, dict[str, dict]]:
    """Records and the query summary of every day that was answered completely."""
    if pages:
        got = read_saved_pages(spark, pages).filter(F.col("source_date").isin(days))
    else:
        spark.dataSource.register(ChangeStream)
        got = spark.read.format("ledgerfold_pages").option("endpoint", endpoint).option("dates", ",".join(days)).option("userAgent", agent).load()
    got, _ = write_table(got, "pages")
    refuse(page_violations(got), "page")
    parsed = parse_pages(got)
    rows = records_of(parsed)
    refuse(record_violations(rows), "record")
    refuse(harvest_violations(parsed, rows), "harvest")
    raw = rows.select(*[f.strip().split(" ")[0] for f in RAW_RECORD.split(", ")])
    return raw, {r["source_date"]: r.asDict() for r in harvest_summary(parsed).collect()}  # a row per day


def collect(spark: SparkSession, a: argparse.Namespace) -> dict:
    scope = json.loads(open(a.scope, encoding="utf-8").read())
    config = ProducerConfig(**json.loads(open(a.config, encoding="utf-8").read())) if a.config else ProducerConfig()
    today = date.fromisoformat(a.today) if a.today else datetime.now(UTC).date()
    now = a.generated_at or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    kind = "full_projection_correction" if a.full_correction else "ordinary"
    if a.corrections and not a.full_correction:
        raise Rejected("a correction file needs --full-correction")
    if a.base:
        copy_tree(a.base, a.root)
    before = list_files(spark, a.root) if exists(a.root, "feed.json") else None
    start = closed = None
    existing = tasks = corrections = None
    if before is not None:
        before, _ = write_table(before, "before")
        refuse(snapshot_violations(spark, a.root), "snapshot")
        index, _, existing, tasks = load(spark, a.root)
        existing, _ = write_table(existing, "existing")
        start = date.fromisoformat(index["coverage"]["start_date"])
        closed = date.fromisoformat(index["coverage"]["closed_complete_through"]) if index["coverage"]["closed_complete_through"] else None
    if a.corrections:
        if existing is None:
            raise Rejected("a correction needs a published snapshot")
        specs = spark.read.schema(SPEC).json(a.corrections)
        refuse(correction_violations(existing, specs), "correction")
        corrections, _ = write_table(build_retractions(existing, specs, scope["scope_id"]), "corrections")
    plan = plan_collection(today, config, start, closed)
    raw, answered = harvest(spark, plan.source_dates, a.pages, a.endpoint, a.user_agent)
    queries = {d: query_block(d, s, now, a.schema_url, a.schema_sha256, config.metadata_prefix) for d, s in answered.items()}
    outcomes = None
    if a.enrich and (a.search_pages or a.search_endpoint) and tasks is not None:
        asked = enrich.request_list(tasks, raw.filter(~F.col("deleted")).select("base_arxiv_id"), today.isoformat(), config.max_per_run, config.batch_size)
        if a.search_pages:
            answers = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(a.search_pages).select(F.col("content").alias("payload"))
        else:  # at most max_per_run ids
            got = fetch_search(Transport(attempts=3, agent=a.user_agent), a.search_endpoint, [r["base_arxiv_id"] for r in asked.collect()], config.batch_size)
            answers = spark.createDataFrame([(bytearray(body),) for _, body in got if body is not None], "payload binary")
        outcomes = enrich.search_outcomes(asked, parse_search(answers))
    producer = Producer(a.code_sha, canon.bytes_hash(canon.file_bytes(json.loads(open(a.config, encoding="utf-8").read()) if a.config else {})), a.schema_sha256, a.run_id)
    built = build(spark, a.root, scope, raw, queries, today, now, plan.coverage_start, producer, kind, corrections, outcomes, a.enrich, config)
    refuse(snapshot_violations(spark, a.root), "snapshot")
    files = list_files(spark, a.root)
    added = (tree_diff(files, before) if before is not None else files).agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    capacity = capacity_status(a.base_bytes + added, config)
    _, _, rows, _ = load(spark, a.root)
    changed = rows.filter(F.col("partition_date").isin(built.changed_partitions or [""]))
    fresh = new_observations(changed, existing) if existing is not None else changed
    write_status(spark, a.root, built, now, queries, fresh, a.base_bytes, int(added), capacity, a.run_url)
    repairs = [r.asDict() for r in built.repairs.orderBy("oai_identifier", "ord", "code_point").drop("ord").collect()] if built.repairs is not None else []
    for r in repairs:
        print("source-text-repair: " + json.dumps(r, ensure_ascii=False, sort_keys=True), file=sys.stderr)
    artifact = {
        "artifact_schema_version": "1.1", "base_feed_commit": a.base_commit, "feed_root_sha256": built.feed_root_sha256, "index_sha256": built.index_sha256, "changed_partitions": built.changed_partitions, "snapshot_kind": read_document(a.root, f"scopes/{scope['scope_id']}/index.json")["snapshot_kind"],
        "generated_at": now, "source_text_repairs": repairs,
    }
    if a.result:
        folder, _, name = a.result.rpartition("/")
        write_document(folder or ".", name, artifact)
    return artifact


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerfold")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("collect", help="query the planned days and publish a snapshot")
    for name, more in {
        "root": {"required": True}, "scope": {"required": True}, "config": {}, "base": {}, "pages": {}, "endpoint": {}, "search-pages": {}, "search-endpoint": {}, "corrections": {}, "today": {}, "generated-at": {}, "code-sha": {"required": True}, "run-id": {"default": ""}, "run-url": {"default": "none"},
        "base-commit": {}, "result": {}, "schema-url": {"default": ""}, "schema-sha256": {"default": "sha256:" + "0" * 64}, "base-bytes": {"type": int, "default": 0},
    }.items():
        c.add_argument(f"--{name}", **more)
    c.add_argument("--user-agent", default="", help="with a contact; needed for requests over the network")
    c.add_argument("--enrich", action="store_true")
    c.add_argument("--full-correction", action="store_true")
    v = sub.add_parser("validate", help="check a published tree against itself")
    v.add_argument("root")
    s = sub.add_parser("publish", help="copy a tree, checking both sides")
    s.add_argument("source")
    s.add_argument("target")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = ship(spark or SparkSession.builder.appName("ledgerfold").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    try:
        if a.command == "collect":
            print(json.dumps(collect(spark, a), ensure_ascii=False, sort_keys=True))
        elif a.command == "validate":
            refuse(snapshot_violations(spark, a.root), "snapshot")
        else:
            refuse(snapshot_violations(spark, a.source), "snapshot")
            copy_tree(a.source, a.target)
            refuse(snapshot_violations(spark, a.target), "snapshot")
    except Exception as e:  # the exit code is what a scheduler sees
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
