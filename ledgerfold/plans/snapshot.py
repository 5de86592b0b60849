"""Building a published snapshot, and checking one against itself.

One projection and one chaining pass serve all days of a run; only days whose content changed are
written.  Objects come first, manifests and the index after all checks, the root document last: it is
the commit point, so a failed run leaves the old snapshot in force.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerfold.functions import canon
from ledgerfold.operators import enrich
from ledgerfold.operators.chain import as_observations, chain_ids
from ledgerfold.operators.fold import MAX_LINE, envelope_violations, fold, live_observations, log_violations, observation_line, operation_counts, partition_counts
from ledgerfold.operators.project import Scope, classify, normalize_records, record_for, scope_errors, text_repairs
from ledgerfold.functions.ident import record_key
from ledgerfold.plans.planner import ProducerConfig, chain_breaks
from ledgerfold.schemas import OBSERVATION, OPERATIONS, RETRACT_RECORD, SOURCE_RECORD, TASK
from ledgerfold.sources.objects import exists, list_files, read_document, read_objects, shard_violations, write_document, write_parts, write_shards
from ledgerfold.operators.upserts import chain_places
from ledgerfold.storage import write_table

#: Fixed value: version of every document of the contract.
VERSION = "1.0"
COUNTS = ("fresh", "retained", "new", "changed", "superseded", *OPERATIONS, "fresh_emitted_operation_count", "effective_source_observation_count", "observation_count")
#: The exact keys of every document and of the objects in it.
KEYS = {
    "feed": "contract_version feed_root_schema_version feed_id scopes", "scope_reference": "scope_id index_path index_sha256",
    "index": "contract_version index_schema_version feed_id scope_id scope_sha256 generated_at snapshot_kind coverage partitions closed_membership_root enrichment_root producer previous_index_sha256",
    "coverage": "start_date closed_complete_through membership_closed_through pending_gaps provisional_dates", "partition": "source_date manifest_path manifest_sha256",
    "manifest": "contract_version manifest_schema_version feed_id scope_id source_date partition_state projection_base_hash projection_result_hash query counts enrichment data_parts producer previous_manifest_sha256",
    "query": "from until metadata_prefix set first_response_date last_response_date page_count token_exhausted source_schema_url source_schema_sha256 observed_complete_at", "counts": " ".join(COUNTS), "enrichment": "status succeeded failed deferred",
    "data_part": "ordinal path compressed_size compressed_sha256 uncompressed_size uncompressed_sha256 record_count",
}
_LINE = "observation_id string, record string, record_content_sha256 string, record_schema_version string, supersedes_observation_id string"


@dataclass(frozen=True)
class Producer:
    code_sha: str
    config_sha256: str
    schema_sha256: str
    workflow_run_id: str = ""

    def __post_init__(self) -> None:
        if len(self.code_sha) != 40 or set(self.code_sha) - set("0123456789abcdef"):
            raise ValueError("code_sha must be 40 hexadecimal characters")


@dataclass
class Built:
    feed_root_sha256: str
    index_sha256: str
    closed_complete_through: str | None
    provisional_dates: list[str]
    changed_partitions: list[str]
    backlog: int
    oldest_age_hours: float | None
    repairs: DataFrame | None = field(default=None, repr=False)


def parse_lines(lines: DataFrame, partition: str = "partition_date") -> DataFrame:
    """Lines of observations back to rows, with their line."""
    e = lines.withColumn("e", F.from_json("line", _LINE)).withColumn("op", F.get_json_object("e.record", "$.operation"))
    retract = F.col("op") == "producer_retract"
    return e.select(
        F.get_json_object("e.record", "$.logical_record_key").alias("logical_record_key"), "e.observation_id", F.col("op").alias("operation"), F.col(partition).alias("partition_date"),
        F.when(~retract, F.from_json("e.record", SOURCE_RECORD)).alias("record"), "e.record_content_sha256", F.when(retract, F.from_json("e.record", RETRACT_RECORD)).alias("retract"), "e.supersedes_observation_id", "line",
    )


def _descriptors(spark: SparkSession, manifests: list[dict]) -> DataFrame:
    rows = [(m["source_date"], p["ordinal"], p["path"], p["compressed_size"], p["compressed_sha256"], p["uncompressed_size"], p["uncompressed_sha256"], p["record_count"]) for m in manifests for p in m["data_parts"]]
    return spark.createDataFrame(rows, "partition_date string, ordinal int, path string, compressed_size bigint, compressed_sha256 string, uncompressed_size bigint, uncompressed_sha256 string, record_count bigint")


def load(spark: SparkSession, root: str) -> tuple[dict, list[dict], DataFrame, DataFrame]:
    """Index, manifests, observations and backlog of a snapshot. Documents are checked by hash, rows by :func:`snapshot_violations`."""
    feed = read_document(root, "feed.json")
    ref = feed["scopes"][0]
    index = read_document(root, ref["index_path"], ref["index_sha256"])
    manifests = [read_document(root, p["manifest_path"], p["manifest_sha256"]) for p in index["partitions"]]
    lines = read_objects(_descriptors(spark, manifests), root, ["partition_date", "ordinal"]).filter("line is not null")
    observations = parse_lines(lines).drop("line")
    return index, manifests, observations, read_state(spark, root, index["enrichment_root"], TASK)


def read_state(spark: SparkSession, root: str, ref: dict, schema: str) -> DataFrame:
    doc = read_document(root, ref["path"], ref["sha256"])
    rows = [tuple(s[k] for k in ("prefix", "path", "compressed_size", "compressed_sha256", "uncompressed_size", "uncompressed_sha256", "record_count")) for s in doc["shards"]]
    d = spark.createDataFrame(rows, "prefix string, path string, compressed_size bigint, compressed_sha256 string, uncompressed_size bigint, uncompressed_sha256 string, record_count bigint")
    return read_objects(d, root, ["prefix"]).filter("line is not null").select(F.from_json("line", schema).alias("s")).select("s.*")


def write_state(records: DataFrame, root: str, scope_id: str, kind: str, key: str, coverage_end: str | None) -> dict:
    """Shards and root document of a state; the reference to it."""
    segment = "membership" if kind == "closed_membership" else "enrichment"
    base = f"scopes/{scope_id}/state/{segment}"
    lines = records.withColumn("line", F.concat(canon.canonical_json(F.struct(*sorted(records.columns))), F.lit("\n")))
    shards = [r.asDict() for r in write_shards(lines, root, key, f"{base}/objects").orderBy("prefix").collect()]  # at most 256
    doc = {"state_schema_version": VERSION, "state_kind": kind, "scope_id": scope_id, "coverage_end": coverage_end, "shards": shards}
    digest = canon.bytes_hash(canon.file_bytes(doc))
    path = f"{base}/roots/{digest[7:]}.json"
    write_document(root, path, doc)
    return {"path": path, "sha256": digest}


def _memberships(state: DataFrame) -> DataFrame:
    return state.select("active_in_scope", "ever_in_scope", "logical_record_key", "source_deleted")


def _project_all(spark: SparkSession, existing: DataFrame, raw: DataFrame, scope: Scope) -> DataFrame:
    """Existing and fresh live rows of all days, chained anew; ``old_id`` null and ``fresh`` for new ones."""
    live = live_observations(existing)
    places = chain_places(existing.filter(F.col("operation") != "producer_retract"), "logical_record_key", "observation_id", "partition_date", "supersedes_observation_id")
    old = live.join(places, "observation_id").select(
        "logical_record_key", F.col("partition_date").alias("source_datestamp"), F.col("place").alias("pos"), F.lit(False).alias("fresh"), F.col("operation").alias("known"), F.lit(False).alias("deleted"), (F.col("operation") == "upsert").alias("in_scope"),
        "record", "record_content_sha256", F.col("observation_id").alias("old_id"),
    )
    keyed = raw.withColumn("logical_record_key", record_key(F.col("oai_identifier")))
    marks = keyed.select("logical_record_key", "source_datestamp", "deleted", (~F.col("deleted") & scope.contains(F.col("metadata.categories"))).alias("in_scope"), "oai_identifier")
    events = old.select("logical_record_key", "source_datestamp", "pos", "fresh", "known", "deleted", "in_scope", F.lit(None).cast("string").alias("oai_identifier")).unionByName(
        marks.select("logical_record_key", "source_datestamp", F.lit(1 << 40).cast("bigint").alias("pos"), F.lit(True).alias("fresh"), F.lit(None).cast("string").alias("known"), "deleted", "in_scope", "oai_identifier")
    )
    before = Window.partitionBy("logical_record_key").orderBy("source_datestamp", "pos").rowsBetween(Window.unboundedPreceding, -1)
    ever = F.coalesce(F.bool_or("in_scope").over(before), F.lit(False))
    seen = events.withColumn("ever", ever)
    gone = F.coalesce(F.bool_or(F.coalesce(F.col("known") == "source_delete", F.lit(False)) | (F.col("deleted") & F.col("ever"))).over(before), F.lit(False))
    ops = seen.withColumn("gone", gone).filter("fresh").withColumn("operation", classify(F.col("deleted"), F.col("in_scope"), F.col("ever"), F.col("gone"))).select("oai_identifier", "source_datestamp", "operation")
    bad = ops.filter(F.col("operation") == "after_delete").select("oai_identifier").take(1)
    if bad:
        raise ValueError(f"source_delete is terminal: {bad[0][0]}")
    ready = normalize_records(keyed.join(ops, ["oai_identifier", "source_datestamp"]).filter(F.col("operation") != "ignored")).withColumn("record", record_for(F.col("operation"))).withColumn("record_content_sha256", canon.content_hash(F.col("record")))
    new = ready.select("logical_record_key", "source_datestamp", F.lit(1 << 40).cast("bigint").alias("pos"), F.lit(True).alias("fresh"), "operation", "record", "record_content_sha256", F.lit(None).cast("string").alias("old_id"))
    both = old.select("logical_record_key", "source_datestamp", "pos", "fresh", F.col("known").alias("operation"), "record", "record_content_sha256", "old_id").unionByName(new)
    # content that an enriched head had from the source is compared, so asking again does not undo an enrichment
    plain = F.col("record").withField("metadata", F.col("record.metadata").withField("authors", F.lit(None)).withField("primary_category", F.lit(None))).withField("field_provenance", F.col("record.field_provenance").withField("authors", F.lit("oai_arxiv_raw")).withField("primary_category", F.lit("oai_arxiv_raw")))
    source_hash = F.when(F.col("record.field_provenance.authors") == "search_api_optional", canon.content_hash(plain.cast(SOURCE_RECORD))).otherwise(F.col("record_content_sha256"))
    last = F.lag("source_hash").over(Window.partitionBy("logical_record_key").orderBy("source_datestamp", "pos"))
    kept = both.withColumn("source_hash", source_hash).withColumn("last", last).filter(~F.col("fresh") | ~F.col("last").eqNullSafe(F.col("source_hash")))
    return chain_ids(kept.withColumn("base_id", F.lit(None).cast("string")).drop("source_hash", "last"), scope.scope_id, "pos")


def build(
    spark: SparkSession,
    root: str,
    scope_document: dict,
    raw: DataFrame,
    queries: dict[str, dict],
    today: date,
    generated_at: str,
    coverage_start: date,
    producer: Producer,
    kind: str = "ordinary",
    corrections: DataFrame | None = None,
    outcomes: DataFrame | None = None,
    enrichment: bool = False,
    config: ProducerConfig = ProducerConfig(),
) -> Built:
    """Publish a snapshot of ``raw``: harvested records, each in the day of its datestamp.

    ``queries`` names the days that were asked, each with the query block of its manifest.  Days are
    closed up to the first that was neither asked nor closed before; today is provisional, and only
    built when yesterday is closed.  A change of history that re-links later rows needs the kind
    ``full_projection_correction``.  Without any change the old snapshot stays as it is.
    """
    if kind not in ("ordinary", "full_projection_correction"):
        raise ValueError("unknown snapshot kind")
    scope = Scope.of(scope_document)
    sid = scope.scope_id
    index, manifests, existing, tasks = None, [], spark.createDataFrame([], OBSERVATION), None
    if exists(root, "feed.json"):
        index, manifests, existing, tasks = load(spark, root)
        existing, _ = write_table(existing, "existing")
        if index["coverage"]["start_date"] != coverage_start.isoformat():
            raise ValueError("coverage start cannot change")
    old = {m["source_date"]: m for m in manifests}
    refs = {p["source_date"]: p for p in index["partitions"]} if index else {}
    if corrections is not None:
        existing = existing.unionByName(corrections)

    days, at = [], coverage_start
    while at < today and (at.isoformat() in queries or old.get(at.isoformat(), {}).get("partition_state") == "closed_complete"):
        days.append(at.isoformat())
        at += timedelta(days=1)
    closed = days[-1] if days else None
    current = today.isoformat()
    provisional = closed == (today - timedelta(days=1)).isoformat() and (current in queries or current in old)
    used = days + ([current] if provisional else [])

    mine = existing.filter(F.col("partition_date").isin(used or [""]))
    linked, _ = write_table(_project_all(spark, mine, raw.filter(F.col("source_datestamp").isin([d for d in used if d in queries] or [""])), scope), "linked")
    moved = [r[0] for r in linked.filter("not fresh and old_id <> observation_id").select("source_datestamp").distinct().collect()]  # days
    if moved and kind == "ordinary":
        raise ValueError("a change of history re-links later rows; run as full_projection_correction")
    aside = mine.join(linked.filter("not fresh").select(F.col("old_id").alias("observation_id")), "observation_id", "left_anti")
    rows = as_observations(linked, "fresh").unionByName(aside.withColumn("fresh", F.lit(False)))
    made = None
    if enrichment or tasks is not None:
        tasks = enrich.build_tasks(rows.drop("fresh"), generated_at, tasks) if enrichment else tasks
        if outcomes is not None:
            made, tasks = enrich.apply_outcomes(rows.drop("fresh"), tasks, outcomes, sid, generated_at, current)
            rows = rows.unionByName(made.withColumn("fresh", F.lit(True)))
    rows, _ = write_table(rows, "rows")
    tasks, _ = write_table(tasks if tasks is not None else spark.createDataFrame([], TASK), "tasks")
    broken = log_violations(rows.drop("fresh")).limit(5).collect()
    if broken:
        raise ValueError(f"log breaks {[tuple(b) for b in broken]}")
    if rows.filter(F.octet_length(observation_line()) > MAX_LINE).take(1):
        raise ValueError("an observation is longer than a line may be")

    # days whose set of observations is another one than before
    before = existing.select("partition_date", "observation_id") if index else spark.createDataFrame([], "partition_date string, observation_id string")
    now = rows.select("partition_date", "observation_id")
    touched = {r[0] for r in now.join(before, ["partition_date", "observation_id"], "left_anti").unionByName(before.filter(F.col("partition_date").isin(used or [""])).join(now, ["partition_date", "observation_id"], "left_anti")).select("partition_date").distinct().collect()}
    if corrections is not None:
        touched |= {r[0] for r in corrections.select("partition_date").distinct().collect()}
    counts = {r["partition_date"]: r.asDict() for r in partition_counts(rows.drop("fresh"), rows.filter("fresh")).collect()}  # a row per day
    summary = {r["partition_date"]: r.asDict() for r in enrich.enrichment_summary(rows.drop("fresh"), tasks, enrichment).collect()}

    genesis = write_state(_memberships(fold(rows.drop("fresh").limit(0))), root, sid, "closed_membership", "logical_record_key", None)
    stays = lambda d: d in old and d not in touched and old[d]["enrichment"] == _enrichment(summary.get(d)) and old[d]["partition_state"] == ("provisional" if d == current and provisional else "closed_complete")
    first = next((d for d in used if not stays(d)), None)
    rebuilt = used[used.index(first) :] if first else []
    parts: dict[str, list[dict]] = {d: [] for d in rebuilt}
    if rebuilt:
        lines = rows.filter(F.col("partition_date").isin(rebuilt)).withColumn("line", observation_line()).select("partition_date", "logical_record_key", "observation_id", "line")
        for r in write_parts(lines, root, "partition_date", ["logical_record_key", "observation_id"]).orderBy("partition_date", "ordinal").collect():  # a row per part
            d = r.asDict()
            parts[d.pop("partition_date")].append(d)
    base, references, docs, changed = genesis, {}, {}, []
    root_ref = genesis
    for d in used:
        if d not in rebuilt:
            references[d], docs[d] = refs[d], old[d]
            base = {"sha256": old[d]["projection_result_hash"], "path": f"scopes/{sid}/state/membership/roots/{old[d]['projection_result_hash'][7:]}.json"}
        else:
            state = fold(rows.drop("fresh").filter(F.col("partition_date") <= d))
            result = write_state(_memberships(state), root, sid, "closed_membership", "logical_record_key", d)
            doc = {
                "contract_version": VERSION, "manifest_schema_version": VERSION, "feed_id": scope_document["feed_id"], "scope_id": sid, "source_date": d, "partition_state": "provisional" if d == current else "closed_complete",
                "projection_base_hash": base["sha256"], "projection_result_hash": result["sha256"], "query": queries.get(d) or old[d]["query"], "counts": {c: int(counts.get(d, {}).get(c, 0)) for c in COUNTS}, "enrichment": _enrichment(summary.get(d)),
                "data_parts": parts[d], "producer": {"code_sha": producer.code_sha, "config_sha256": producer.config_sha256, "schema_sha256": producer.schema_sha256, "normalizer_version": scope_document["normalizer_version"], "workflow_run_id": producer.workflow_run_id},
                "previous_manifest_sha256": refs.get(d, {}).get("manifest_sha256"),
            }
            same = stays(d) and old[d]["projection_base_hash"] == base["sha256"] and old[d]["projection_result_hash"] == result["sha256"]
            if same:
                references[d], docs[d] = refs[d], old[d]
            else:
                digest = canon.bytes_hash(canon.file_bytes(doc))
                path = f"scopes/{sid}/partitions/{d[:4]}/{d[5:7]}/{d}/manifests/{digest[7:]}.json"
                write_document(root, path, doc)
                references[d], docs[d] = {"source_date": d, "manifest_path": path, "manifest_sha256": digest}, doc
                changed.append(d)
            base = result
        if d != current or not provisional:
            root_ref = base
    if kind == "ordinary" and len(changed) > config.max_changed_partitions:
        raise ValueError("ordinary run changes too many partitions")
    for d, ref in refs.items():
        references.setdefault(d, ref)
        docs.setdefault(d, old[d])
    backlog = write_state(tasks, root, sid, "enrichment_backlog", "task_key", None)
    age = enrich.backlog_age_hours(tasks, generated_at).first()
    repairs = text_repairs(raw.filter(F.col("source_datestamp").isin([d for d in used if d in queries] or [""])))
    waiting = sorted(d for d, m in docs.items() if m["partition_state"] == "provisional")
    if index and not changed and index["enrichment_root"] == backlog:
        feed = read_document(root, "feed.json")
        return Built(canon.bytes_hash(canon.file_bytes(feed)), feed["scopes"][0]["index_sha256"], index["coverage"]["closed_complete_through"], index["coverage"]["provisional_dates"], [], age["backlog"], age["oldest_age_hours"], repairs)
    gap_from = date.fromisoformat(closed) + timedelta(days=1) if closed else coverage_start
    gaps = [(gap_from + timedelta(days=i)).isoformat() for i in range(max(0, (today - gap_from).days))]
    scope_path = f"scopes/{sid}/scope.json"
    doc = {
        "contract_version": VERSION, "index_schema_version": VERSION, "feed_id": scope_document["feed_id"], "scope_id": sid, "scope_sha256": write_document(root, scope_path, scope_document), "generated_at": generated_at, "snapshot_kind": kind,
        "coverage": {"start_date": coverage_start.isoformat(), "closed_complete_through": closed, "membership_closed_through": closed, "pending_gaps": gaps, "provisional_dates": waiting},
        "partitions": [references[d] for d in sorted(references)], "closed_membership_root": root_ref, "enrichment_root": backlog,
        "producer": {"code_sha": producer.code_sha, "config_sha256": producer.config_sha256, "schema_sha256": producer.schema_sha256}, "previous_index_sha256": canon.bytes_hash(canon.file_bytes(index)) if index else None,
    }
    index_path = f"scopes/{sid}/index.json"
    index_sha = write_document(root, index_path, doc)
    feed_sha = write_document(root, "feed.json", {"contract_version": VERSION, "feed_root_schema_version": VERSION, "feed_id": scope_document["feed_id"], "scopes": [{"scope_id": sid, "index_path": index_path, "index_sha256": index_sha}]})
    return Built(feed_sha, index_sha, closed, waiting, sorted(changed), age["backlog"], age["oldest_age_hours"], repairs)


def _enrichment(row: dict | None) -> dict:
    row = row or {"status": "not_requested", "succeeded": 0, "failed": 0, "deferred": 0}
    return {k: row[k] if k == "status" else int(row[k]) for k in ("status", "succeeded", "failed", "deferred")}


def query_block(day: str, summary: dict, observed_at: str, schema_url: str, schema_sha: str, prefix: str = "arXivRaw") -> dict:
    """The query of a manifest, from the summary of a complete harvest."""
    if not summary["token_exhausted"] or summary["page_count"] < 1:
        raise ValueError("harvest is not complete")
    return {
        "from": day, "until": day, "metadata_prefix": prefix, "set": None, "first_response_date": summary["first_response_date"], "last_response_date": summary["last_response_date"], "page_count": int(summary["page_count"]), "token_exhausted": True,
        "source_schema_url": schema_url, "source_schema_sha256": schema_sha, "observed_complete_at": observed_at,
    }


def snapshot_violations(spark: SparkSession, root: str) -> DataFrame:
    """``rule, key`` for everything in a snapshot that does not follow from the rest; none for a sound one."""
    out: list[tuple[str, str]] = []
    schema = "rule string, key string"
    try:
        feed = read_document(root, "feed.json")
        ref = feed["scopes"][0]
        index = read_document(root, ref["index_path"], ref["index_sha256"])
        sid = index["scope_id"]
        scope = read_document(root, f"scopes/{sid}/scope.json", index["scope_sha256"])
        manifests = [read_document(root, p["manifest_path"], p["manifest_sha256"]) for p in index["partitions"]]
    except (ValueError, OSError, KeyError) as e:
        return spark.createDataFrame([("document_unreadable", str(e)[:300])], schema)
    out += [("scope_invalid", e) for e in scope_errors(scope)] + document_errors(feed, index, manifests)
    if any(rule == "keys_differ" for rule, _ in out):
        return spark.createDataFrame(out, schema)
    cov = index["coverage"]
    if cov["closed_complete_through"] != cov["membership_closed_through"]:
        out.append(("frontiers_differ", sid))
    dates = [p["source_date"] for p in index["partitions"]]
    if dates != sorted(set(dates)):
        out.append(("partitions_not_sorted", sid))
    for p, m in zip(index["partitions"], manifests, strict=True):
        if p["source_date"] != m["source_date"] or m["query"]["from"] != m["source_date"] or m["query"]["until"] != m["source_date"]:
            out.append(("manifest_of_other_day", p["source_date"]))
        if not m["query"]["token_exhausted"] or m["query"]["page_count"] < 1:
            out.append(("harvest_incomplete", p["source_date"]))
        if [x["ordinal"] for x in m["data_parts"]] != list(range(len(m["data_parts"]))):
            out.append(("ordinals_not_contiguous", p["source_date"]))
    closed = [m for m in manifests if m["partition_state"] == "closed_complete"]
    if sorted(m["source_date"] for m in manifests if m["partition_state"] == "provisional") != cov["provisional_dates"]:
        out.append(("provisional_dates_differ", sid))
    lines = read_objects(_descriptors(spark, manifests), root, ["partition_date", "ordinal"])
    lines, _ = write_table(lines, "lines")
    rows = parse_lines(lines.filter("line is not null"))
    rows, _ = write_table(rows, "parsed")
    o = rows.drop("line")
    w = Window.partitionBy("partition_date").orderBy("ordinal", "line_no")
    keyed = lines.filter("line is not null").select("partition_date", "ordinal", "line_no", F.concat(F.get_json_object("line", "$.record.logical_record_key"), F.get_json_object("line", "$.observation_id")).alias("k"))
    own_day = F.when(F.col("operation") == "producer_retract", F.col("retract.target_source_date")).otherwise(F.col("record.source_datestamp"))
    declared = spark.createDataFrame([(m["source_date"], *(int(m["counts"][c]) for c in (*OPERATIONS, "observation_count"))) for m in manifests], "partition_date string, " + ", ".join(f"d_{c} bigint" for c in (*OPERATIONS, "observation_count")))
    found = declared.join(partition_counts(o), "partition_date", "left")
    differs = F.lit(False)
    for c in (*OPERATIONS, "observation_count"):
        differs = differs | (F.col(f"d_{c}") != F.coalesce(F.col(c), F.lit(0)))
    hashes = spark.createDataFrame([(m["source_date"], m["projection_base_hash"], m["projection_result_hash"]) for m in closed], "source_date string, projection_base_hash string, projection_result_hash string")
    genesis = canon.bytes_hash(canon.file_bytes({"state_schema_version": VERSION, "state_kind": "closed_membership", "scope_id": sid, "coverage_end": None, "shards": []}))
    rule = lambda df, name, key: df.select(F.lit(name).alias("rule"), F.col(key).alias("key"))
    checks = [
        lines.filter("fault is not null").select(F.col("fault").alias("rule"), F.col("partition_date").alias("key")),
        rule(keyed.withColumn("b", F.lag("k").over(w)).filter("k <= b"), "rows_not_sorted", "partition_date"),
        rule(rows.filter(F.concat("line", F.lit("\n")) != observation_line()), "line_not_canonical", "observation_id"),
        rule(o.filter(~own_day.eqNullSafe(F.col("partition_date"))), "row_of_other_day", "observation_id"),
        rule(found.filter(differs), "counts_differ", "partition_date"),
        envelope_violations(o, sid), log_violations(o), chain_breaks(hashes, genesis),
    ]
    # the states: folded again, they must be those that were published
    last_closed = cov["closed_complete_through"]
    for m in ([closed[-1]] if closed else []) + [m for m in manifests if m["partition_state"] == "provisional"]:
        d = m["source_date"]
        days = [x["source_date"] for x in closed] + ([d] if m["partition_state"] == "provisional" else [])
        want = _memberships(fold(o.filter(F.col("partition_date").isin(days))))
        ref = {"path": f"scopes/{sid}/state/membership/roots/{m['projection_result_hash'][7:]}.json", "sha256": m["projection_result_hash"]}
        try:
            have = read_state(spark, root, ref, "active_in_scope boolean, ever_in_scope boolean, logical_record_key string, source_deleted boolean")
        except (ValueError, OSError) as e:
            out.append(("state_unreadable", str(e)[:300]))
            continue
        checks.append(rule(want.exceptAll(have).unionByName(have.exceptAll(want)), "state_differs", "logical_record_key"))
        checks.append(shard_violations(have, "logical_record_key"))
        if m["partition_state"] == "provisional" and m["projection_base_hash"] != index["closed_membership_root"]["sha256"]:
            out.append(("provisional_base_differs", d))
        if d == last_closed and m["projection_result_hash"] != index["closed_membership_root"]["sha256"]:
            out.append(("frontier_root_differs", d))
    try:
        tasks = read_state(spark, root, index["enrichment_root"], TASK)
        checks.append(enrich.task_violations(tasks))
        out += status_errors(root, sid, canon.bytes_hash(canon.file_bytes(feed)), feed["scopes"][0]["index_sha256"], tasks)
    except (ValueError, OSError) as e:
        out.append(("backlog_unreadable", str(e)[:300]))
    result = spark.createDataFrame(out, schema)
    for c in checks:
        result = result.unionByName(c)
    return result


def key_errors(kind: str, document: object) -> list[str]:
    """Missing and unexpected keys of a document."""
    if not isinstance(document, dict):
        return [f"{kind}: not an object"]
    want = set(KEYS[kind].split())
    return [f"{kind}: {k} is missing" for k in sorted(want - set(document))] + [f"{kind}: {k} is unexpected" for k in sorted(set(document) - want)]


def document_errors(feed: dict, index: dict, manifests: list[dict]) -> list[tuple[str, str]]:
    """``rule, key``: what is wrong with the documents themselves, before any row is read."""
    found = key_errors("feed", feed) + key_errors("scope_reference", feed["scopes"][0]) + key_errors("index", index) + key_errors("coverage", index.get("coverage"))
    for p in index.get("partitions", []):
        found += key_errors("partition", p)
    for m in manifests:
        found += key_errors("manifest", m)
        for kind in ("query", "counts", "enrichment"):
            found += key_errors(kind, m.get(kind))
        for part in m.get("data_parts", []):
            found += key_errors("data_part", part)
    out = [("keys_differ", f) for f in found]
    if found:
        return out
    if len(feed["scopes"]) != 1:
        out.append(("not_one_scope", "feed"))
    if index["snapshot_kind"] not in ("ordinary", "full_projection_correction"):
        out.append(("kind_unknown", index["snapshot_kind"]))
    cov = index["coverage"]
    out += [(f"{f}_not_sorted", "coverage") for f in ("pending_gaps", "provisional_dates") if cov[f] != sorted(set(cov[f]))]
    for m in manifests:
        d = m["source_date"]
        if m["feed_id"] != index["feed_id"] or m["scope_id"] != index["scope_id"]:
            out.append(("manifest_of_other_feed", d))
        if m["partition_state"] not in ("provisional", "closed_complete") or m["enrichment"]["status"] not in ("not_requested", "complete", "partial"):
            out.append(("state_unknown", d))
        if min(m["counts"].values()) < 0 or min(m["enrichment"][k] for k in ("succeeded", "failed", "deferred")) < 0:
            out.append(("count_negative", d))
        if m["query"]["set"] is not None:
            out.append(("query_of_a_set", d))
    return out


def unreferenced(spark: SparkSession, root: str) -> DataFrame:
    """Files of the tree that no document of the snapshot names (what failed runs leave behind)."""
    feed = read_document(root, "feed.json")
    index = read_document(root, feed["scopes"][0]["index_path"])
    sid = index["scope_id"]
    named = {"feed.json", feed["scopes"][0]["index_path"], f"scopes/{sid}/scope.json", f"scopes/{sid}/status/latest.json"}
    for p in index["partitions"]:
        m = read_document(root, p["manifest_path"])
        named |= {p["manifest_path"], *(x["path"] for x in m["data_parts"]), f"scopes/{sid}/state/membership/roots/{m['projection_result_hash'][7:]}.json", f"scopes/{sid}/state/membership/roots/{m['projection_base_hash'][7:]}.json"}
    for path in [p for p in named if "/roots/" in p] + [index["enrichment_root"]["path"]]:
        named |= {path, *(s["path"] for s in read_document(root, path)["shards"])}
    names = spark.createDataFrame([(p,) for p in sorted(named)], "path string")
    return list_files(spark, root).join(names, "path", "left_anti").select("path", "size")


STATUS_KEYS = (
    "status_schema_version feed_id scope_id last_workflow_success_at latest_query_complete_at closed_complete_through membership_closed_through pending_gaps provisional_dates changed_partitions snapshot_kind enrichment_backlog_count"
    " reachable_pack_size_bytes estimated_reachable_pack_size_bytes capacity_status operation_counts feed_root_sha256 index_sha256 workflow_run_url"
).split()


def write_status(spark: SparkSession, root: str, built: Built, generated_at: str, queries: dict[str, dict], fresh: DataFrame, reachable: int, added: int, capacity: str, run_url: str) -> dict:
    """The status document. The age of the backlog is a float and stays out of it: documents hold no floats."""
    feed = read_document(root, "feed.json")
    index = read_document(root, feed["scopes"][0]["index_path"])
    ops = {r["operation"]: int(r["n"]) for r in operation_counts(fresh).collect()}
    status = {
        "status_schema_version": VERSION, "feed_id": index["feed_id"], "scope_id": index["scope_id"], "last_workflow_success_at": generated_at, "latest_query_complete_at": max((q["observed_complete_at"] for q in queries.values()), default=generated_at),
        "closed_complete_through": built.closed_complete_through, "membership_closed_through": built.closed_complete_through, "pending_gaps": index["coverage"]["pending_gaps"], "provisional_dates": built.provisional_dates, "changed_partitions": built.changed_partitions,
        "snapshot_kind": index["snapshot_kind"], "enrichment_backlog_count": int(built.backlog), "reachable_pack_size_bytes": reachable, "estimated_reachable_pack_size_bytes": reachable + added, "capacity_status": capacity, "operation_counts": ops,
        "feed_root_sha256": built.feed_root_sha256, "index_sha256": built.index_sha256, "workflow_run_url": run_url,
    }
    write_document(root, f"scopes/{index['scope_id']}/status/latest.json", status)
    return status


def status_errors(root: str, scope_id: str, feed_sha: str, index_sha: str, tasks: DataFrame) -> list[tuple[str, str]]:
    path = f"scopes/{scope_id}/status/latest.json"
    if not exists(root, path):
        return []
    s = read_document(root, path)
    out = []
    if set(s) != set(STATUS_KEYS):
        return [("status_keys_differ", path)]
    if s["feed_root_sha256"] != feed_sha or s["index_sha256"] != index_sha:
        out.append(("status_of_other_snapshot", path))
    if s["closed_complete_through"] != s["membership_closed_through"]:
        out.append(("status_frontiers_differ", path))
    if s["enrichment_backlog_count"] != tasks.count():
        out.append(("status_backlog_differs", path))
    if s["estimated_reachable_pack_size_bytes"] < s["reachable_pack_size_bytes"] or s["capacity_status"] not in ("ok", "warning"):
        out.append(("status_capacity_invalid", path))
    if set(s["operation_counts"]) != set(OPERATIONS) or min(s["operation_counts"].values()) < 0:
        out.append(("status_counts_invalid", path))
    for f in ("pending_gaps", "provisional_dates", "changed_partitions"):
        if s[f] != sorted(set(s[f])):
            out.append((f"status_{f}_not_sorted", path))
    return out
