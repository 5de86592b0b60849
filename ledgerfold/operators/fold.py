"""Observations folded to the current state, and the rules that a log must keep.

Both are set operations: an id hashes its predecessor's, so a log without forks, orphans and second
roots is a chain per key and its head is the row that no live row supersedes.  No walk is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import canon, ident


def retractions(observations: DataFrame) -> DataFrame:
    """``target_id`` of every retraction, once."""
    return observations.filter(F.col("operation") == "producer_retract").select(F.col("retract.target_observation_id").alias("target_id")).filter("target_id is not null").distinct()


def live_observations(observations: DataFrame) -> DataFrame:
    """Source observations that no retraction targets."""
    return observations.filter(F.col("operation") != "producer_retract").join(retractions(observations), F.col("observation_id") == F.col("target_id"), "left_anti")


def heads(live: DataFrame) -> DataFrame:
    """Live rows that no live row supersedes."""
    followed = live.select(F.col("supersedes_observation_id").alias("s_id")).filter("s_id is not null").distinct()
    return live.join(followed, F.col("observation_id") == F.col("s_id"), "left_anti")


def fold(observations: DataFrame) -> DataFrame:
    """``logical_record_key, ever_in_scope, active_in_scope, source_deleted`` and the head of every key.

    A key whose observations are all retracted has no row.  Partial aggregation keeps a hot key small.
    """
    live = live_observations(observations)
    ever = live.groupBy("logical_record_key").agg(F.bool_or(F.col("operation") == "upsert").alias("ever_in_scope"))
    head = heads(live).select("logical_record_key", "observation_id", "record_content_sha256", "operation")
    return ever.join(head, "logical_record_key").select(
        "logical_record_key", "ever_in_scope", (F.col("operation") == "upsert").alias("active_in_scope"), (F.col("operation") == "source_delete").alias("source_deleted"),
        "observation_id", "record_content_sha256", "operation",
    )


#: Longest canonical line of an observation, in bytes.
MAX_LINE = 2 * 1024 * 1024
#: Fixed value: version of the records' schema.
RECORD_SCHEMA_VERSION = "1.0"


def observation_line() -> Column:
    """The canonical line of an observation, line feed included: the two kinds of record render each in its own struct."""
    envelope = lambda record: canon.canonical_json(F.struct("observation_id", record.alias("record"), "record_content_sha256", F.lit(RECORD_SCHEMA_VERSION).alias("record_schema_version"), "supersedes_observation_id"))
    return F.concat(F.when(F.col("operation") == "producer_retract", envelope(F.col("retract"))).otherwise(envelope(F.col("record"))), F.lit("\n"))


def _broken(df: DataFrame, rule: str, key: str = "logical_record_key") -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.col(key).alias("key"))


def log_violations(observations: DataFrame) -> DataFrame:
    """``rule, key`` for every breach of the rules of a log; none for a valid one.

    retract_target_absent, retract_key_differs, replacement_absent, replacement_key_differs,
    second_root, orphan, fork, key_changed, after_delete, duplicate_id.
    """
    o = observations
    source = o.filter(F.col("operation") != "producer_retract").select("observation_id", "logical_record_key", "operation", "supersedes_observation_id")
    r = o.filter(F.col("operation") == "producer_retract").select(F.col("logical_record_key").alias("r_key"), F.col("retract.target_observation_id").alias("t"), F.col("retract.replacement_observation_id").alias("p"))
    target = source.select(F.col("observation_id").alias("t"), F.col("logical_record_key").alias("t_key"))
    replacement = source.select(F.col("observation_id").alias("p"), F.col("logical_record_key").alias("p_key"))
    live = live_observations(o).select("observation_id", "logical_record_key", "operation", "supersedes_observation_id")
    parent = live.select(F.col("observation_id").alias("u_id"), F.col("logical_record_key").alias("u_key"), F.col("operation").alias("u_op"))
    child = live.filter("supersedes_observation_id is not null")
    linked = child.join(parent, F.col("supersedes_observation_id") == F.col("u_id"), "left")
    parts = [
        _broken(r.join(target, "t", "left_anti"), "retract_target_absent", "r_key"),
        _broken(r.join(target, "t").filter("r_key <> t_key"), "retract_key_differs", "r_key"),
        _broken(r.filter("p is not null").join(replacement, "p", "left_anti"), "replacement_absent", "r_key"),
        _broken(r.join(replacement, "p").filter("r_key <> p_key"), "replacement_key_differs", "r_key"),
        _broken(live.groupBy("logical_record_key").agg(F.count_if(F.col("supersedes_observation_id").isNull()).alias("n")).filter("n > 1"), "second_root"),
        _broken(linked.filter("u_id is null"), "orphan"),
        _broken(linked.filter("u_key <> logical_record_key"), "key_changed"),
        _broken(linked.filter(F.col("u_op") == "source_delete"), "after_delete"),
        _broken(child.groupBy("supersedes_observation_id").agg(F.count("*").alias("n"), F.min("logical_record_key").alias("logical_record_key")).filter("n > 1"), "fork"),
        _broken(o.groupBy("observation_id").agg(F.count("*").alias("n"), F.min("logical_record_key").alias("logical_record_key")).filter("n > 1"), "duplicate_id"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Text fields of a record, and whether they keep lines.
TEXT_FIELDS = (("title", False), ("abstract", True), ("authors_raw", False), ("comment", True), ("journal_ref", False), ("doi", False), ("license", False))


def _is_normal(c: Column, lines: bool = False) -> Column:
    """Whether text is null, or not empty and in canonical form."""
    form = canon.normalize_multiline(c) if lines else canon.normalize_single_line(c)
    return c.isNull() | ((c != "") & form.eqNullSafe(c) & ~canon.has_control(c))


def _names_are_normal(authors: Column) -> Column:
    """The same for the names of an array, which must not be null; NFC is checked on all names at once, as nothing composes over a line feed."""
    plain = lambda n: canon.strip(canon.collapse_blanks(F.translate(canon.line_endings(n), "\n", " ")))
    joined = F.array_join(F.transform(authors, lambda a: a["name"]), "\n")
    odd = F.exists(authors, lambda a: a["name"].isNull() | (a["name"] == "") | (plain(a["name"]) != a["name"]) | canon.has_control(a["name"]))
    return authors.isNull() | (~odd & canon.nfc(joined).eqNullSafe(joined))


def state_violations(state: DataFrame) -> DataFrame:
    """``rule, key`` of memberships that contradict themselves: active but never in scope, or active and deleted."""
    rules = {"active_never_in_scope": ~F.col("active_in_scope") | F.col("ever_in_scope"), "active_and_deleted": ~F.col("active_in_scope") | ~F.col("source_deleted"), "key_malformed": canon.is_hash(F.col("logical_record_key"))}
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()]))
    return state.select(F.explode(broken).alias("rule"), F.col("logical_record_key").alias("key"))


def envelope_violations(observations: DataFrame, scope_id: str) -> DataFrame:
    """``rule, key``: rows whose hashes, ids or records do not follow from their content."""
    r, t = F.col("record"), F.col("retract")
    is_retract = F.col("operation") == "producer_retract"
    content = F.when(is_retract, canon.content_hash(t)).otherwise(canon.content_hash(r))
    oid = F.when(is_retract, ident.retract_id(scope_id, t["producer_correction_key"], t["target_observation_id"], content)).otherwise(
        ident.observation_id(scope_id, r["oai_identifier"], r["source_datestamp"], r["operation"], content, F.col("supersedes_observation_id"))
    )
    sets, versions = r["source_sets"], r["version_history"]
    numbers = F.transform(versions, lambda v: v["version"])
    upsert = F.col("operation") == "upsert"
    cats = r["metadata"]["categories"]
    sorted_set = lambda c: F.array_sort(F.array_distinct(c)).eqNullSafe(c)
    rules = {
        "operation_unknown": F.col("operation").isin("upsert", "scope_exit", "source_delete", "producer_retract"),
        "content_hash_differs": content == F.col("record_content_sha256"),
        "observation_id_differs": oid == F.col("observation_id"),
        "line_too_long": F.octet_length(observation_line()) <= MAX_LINE,
        "operation_differs": F.coalesce(r["operation"], t["operation"]) == F.col("operation"),
        "base_id_differs": is_retract | r["base_arxiv_id"].eqNullSafe(ident.base_id_of(r["oai_identifier"])),
        "key_differs": is_retract | ident.record_key(r["oai_identifier"]).eqNullSafe(F.col("logical_record_key")),
        "date_malformed": is_retract | (r["source_datestamp"].rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(r["source_datestamp"], "yyyy-MM-dd").isNotNull()),
        "sets_not_sorted": is_retract | sorted_set(sets),
        "version_differs": ~upsert | r["versioned_arxiv_id"].eqNullSafe(ident.versioned_id(r["base_arxiv_id"], r["current_version"])),
        "history_not_increasing": ~upsert | ((F.size(versions) > 0) & sorted_set(numbers) & (F.try_element_at(numbers, F.lit(-1)) == r["current_version"])),
        "history_of_terminal": upsert | is_retract | versions.isNull() | (F.size(versions) == 0),
        "categories_not_sorted": ~upsert | ((F.size(cats) > 0) & sorted_set(cats)),
        **{f"{name}_not_normalized": is_retract | _is_normal(r["metadata"][name], lines) for name, lines in TEXT_FIELDS},
        "primary_category_not_normalized": is_retract | _is_normal(r["metadata"]["primary_category"]),
        "author_not_normalized": is_retract | _names_are_normal(r["metadata"]["authors"]),
        "provenance_unknown": ~upsert | (
            (r["field_provenance"]["version_history"] == "oai_arxiv_raw") & (r["field_provenance"]["authors_raw"] == "oai_arxiv_raw")
            & r["field_provenance"]["authors"].isin("oai_arxiv_raw", "search_api_optional") & r["field_provenance"]["primary_category"].isin("oai_arxiv_raw", "search_api_optional")
        ),
        "reason_malformed": ~is_retract | ((F.length(t["reason"]) <= 1000) & (t["reason"] != "") & canon.normalize_multiline(t["reason"]).eqNullSafe(t["reason"])),
        "target_malformed": ~is_retract | (canon.is_hash(t["target_observation_id"]) & (t["replacement_observation_id"].isNull() | canon.is_hash(t["replacement_observation_id"]))),
    }
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(rule)) for rule, ok in rules.items()]))
    return observations.select(F.explode(broken).alias("rule"), F.col("observation_id").alias("key"))


def partition_counts(observations: DataFrame, fresh_ids: DataFrame | None = None) -> DataFrame:
    """The counters of every partition, in one aggregation after one join with the retractions."""
    hit = retractions(observations).withColumn("gone", F.lit(True))
    rows = observations.join(hit, F.col("observation_id") == F.col("target_id"), "left")
    if fresh_ids is None:
        rows = rows.withColumn("fresh", F.lit(True))
    else:
        rows = rows.join(fresh_ids.select(F.col("observation_id").alias("f_id")).distinct().withColumn("fresh", F.lit(True)), F.col("observation_id") == F.col("f_id"), "left").withColumn("fresh", F.coalesce("fresh", F.lit(False)))
    changed = F.col("fresh") & F.col("supersedes_observation_id").isNotNull()
    op = lambda name: F.count_if(F.col("operation") == name).alias(name)
    return rows.groupBy("partition_date").agg(
        F.count_if("fresh").alias("fresh"), F.count_if(~F.col("fresh")).alias("retained"), F.count_if(F.col("fresh") & ~changed).alias("new"), F.count_if(changed).alias("changed"), F.count_if(changed).alias("superseded"),
        op("upsert"), op("scope_exit"), op("source_delete"), op("producer_retract"),
        F.count_if("fresh").alias("fresh_emitted_operation_count"), F.count_if((F.col("operation") != "producer_retract") & F.col("gone").isNull()).alias("effective_source_observation_count"), F.count("*").alias("observation_count"),
    )


def operation_counts(observations: DataFrame) -> DataFrame:
    """``operation, n`` for each operation, 0 where none is there."""
    from ledgerfold.schemas import OPERATIONS

    counts = observations.groupBy("operation").agg(F.count("*").alias("n"))
    names = observations.sparkSession.range(1).select(F.explode(F.array(*[F.lit(o) for o in OPERATIONS])).alias("operation"))
    return names.join(counts, "operation", "left").select("operation", F.coalesce("n", F.lit(0)).alias("n"))


def new_observations(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Observations that a date did not hold before."""
    return current.join(previous.select("partition_date", "observation_id"), ["partition_date", "observation_id"], "left_anti")


def union_checked(existing: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The union by id, and the ids that carry different content on the two sides."""
    both = existing.unionByName(fresh)
    conflicts = both.groupBy("observation_id").agg(F.count_distinct("record_content_sha256", F.coalesce("supersedes_observation_id", F.lit(""))).alias("n")).filter("n > 1").select("observation_id")
    return both.dropDuplicates(["observation_id"]), conflicts
