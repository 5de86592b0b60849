"""Optional enrichment: a backlog with bounded retries, and binding of search results to heads.

One task per record, for its live head only: a record that was changed or left the scope on the same
day has no task, and two days cannot fight over one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.functions import canon, ident
from ledgerfold.operators.fold import heads, live_observations
from ledgerfold.schemas import TASK

#: Attempts after which a task waits for a week instead of a day.
DEFER_AFTER = 7
_TASK_FIELDS = tuple(f.strip().split()[0] for f in TASK.split(","))


def _enriched(record: Column) -> Column:
    m, p = record["metadata"], record["field_provenance"]
    return F.coalesce(m["authors"].isNotNull() & m["primary_category"].isNotNull() & (p["authors"] == "search_api_optional") & (p["primary_category"] == "search_api_optional"), F.lit(False))


def build_tasks(observations: DataFrame, generated_at: str, tasks: DataFrame | None = None) -> DataFrame:
    """The backlog: a task for each live upsert head that is not enriched.

    A task is kept while its target is the head; a target that was only re-linked (same record,
    version and material) is bound anew and the task keeps its attempts; otherwise it starts over.
    """
    r = F.col("record")
    head = heads(live_observations(observations)).filter((F.col("operation") == "upsert") & ~_enriched(r))
    want = head.select(
        r["base_arxiv_id"].alias("base_arxiv_id"), F.col("observation_id").alias("n_target"), r["source_datestamp"].alias("n_date"), r["current_version"].alias("n_version"),
        ident.material_hash(r["base_arxiv_id"], r["current_version"], r["metadata"]["title"], r["metadata"]["abstract"]).alias("n_material"),
    )
    if tasks is None:
        tasks = observations.sparkSession.createDataFrame([], TASK)
    j = want.join(tasks, "base_arxiv_id", "left")
    keep = F.coalesce((F.col("target_observation_id") == F.col("n_target")) | ((F.col("target_current_version") == F.col("n_version")) & (F.col("target_material_sha256") == F.col("n_material"))), F.lit(False))
    value = {
        "base_arxiv_id": F.col("base_arxiv_id"), "task_key": ident.task_key(F.col("base_arxiv_id")), "target_observation_id": F.col("n_target"), "target_source_date": F.col("n_date"), "target_current_version": F.col("n_version"), "target_material_sha256": F.col("n_material"),
        "first_enqueued_at": F.when(keep, F.col("first_enqueued_at")).otherwise(F.lit(generated_at)), "attempt_count": F.when(keep, F.col("attempt_count")).otherwise(F.lit(0)), "status": F.when(keep, F.col("status")).otherwise(F.lit("pending")),
        "next_attempt_date": F.when(keep, F.col("next_attempt_date")).otherwise(F.col("n_date")),
    }
    return j.select(*[value.get(c, F.when(keep, F.col(c))).alias(c) for c in _TASK_FIELDS])


def task_violations(tasks: DataFrame) -> DataFrame:
    """``rule, key`` for tasks that are malformed."""
    rules = {
        "task_key_differs": ident.task_key(F.col("base_arxiv_id")) == F.col("task_key"), "base_id_malformed": ident.parse_id(F.col("base_arxiv_id")).isNotNull(), "hash_malformed": canon.is_hash(F.col("target_observation_id")) & canon.is_hash(F.col("target_material_sha256")),
        "date_malformed": F.try_to_date("target_source_date", "yyyy-MM-dd").isNotNull() & F.try_to_date("next_attempt_date", "yyyy-MM-dd").isNotNull(), "version_not_positive": F.col("target_current_version") >= 1, "attempts_negative": F.col("attempt_count") >= 0, "status_unknown": F.col("status").isin("pending", "deferred"),
    }
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()]))
    return tasks.select(F.explode(broken).alias("rule"), F.col("task_key").alias("key"))


def due(tasks: DataFrame, today: str) -> DataFrame:
    return tasks.filter(F.col("next_attempt_date") <= today)


def after_failure(attempts: Column, today: Column) -> tuple[Column, Column, Column]:
    """Attempts, status and next date after one more failure."""
    n = attempts + 1
    deferred = n >= DEFER_AFTER
    return n, F.when(deferred, "deferred").otherwise("pending"), F.date_add(today, F.when(deferred, 7).otherwise(1)).cast("string")


def bind_error(target: Column, result: Column) -> Column:
    """Why a search result cannot be bound to a target record; null where it can. The first reason counts."""
    m = target["metadata"]
    return (
        F.when(~result["base_arxiv_id"].eqNullSafe(target["base_arxiv_id"]), "target_base_mismatch")
        .when(result["version"] > target["current_version"], "target_ahead")
        .when(result["version"] < target["current_version"], "target_behind")
        .when(~(result["title"].eqNullSafe(m["title"]) & result["abstract"].eqNullSafe(m["abstract"])), "target_material_mismatch")
        .when(~F.coalesce(F.array_contains(m["categories"], result["primary_category"]), F.lit(False)), "primary_category_not_in_oai_categories")
    )


def search_outcomes(requested: DataFrame, found: DataFrame) -> DataFrame:
    """``base_arxiv_id, result, error_kind, error`` for every requested id; missing and repeated ones fail."""
    n = found.groupBy("base_arxiv_id").agg(F.count("*").alias("n"), F.first(F.struct("abstract", "authors", "base_arxiv_id", "primary_category", "title", "version")).alias("r"))
    j = requested.select("base_arxiv_id").distinct().join(n, "base_arxiv_id", "left")
    kind = F.when(F.col("n").isNull(), "search_missing").when(F.col("n") > 1, "search_transport_or_parse")
    return j.select("base_arxiv_id", F.when(kind.isNull(), F.col("r")).alias("result"), kind.alias("error_kind"), F.when(kind == "search_missing", "requested id is not in the answer").when(kind.isNotNull(), "duplicate entry").alias("error"))


def apply_outcomes(observations: DataFrame, tasks: DataFrame, outcomes: DataFrame, scope_id: str, attempted_at: str, today: str) -> tuple[DataFrame, DataFrame]:
    """Enriched observations that supersede their targets, and the backlog after the attempts.

    An outcome meets at most one task, since there is one per record.  A failed or unbindable one
    counts as an attempt; tasks without outcome stay as they are.
    """
    target = observations.select(F.col("observation_id").alias("target_observation_id"), F.col("record").alias("t_record"), F.col("logical_record_key").alias("t_key"), F.col("partition_date").alias("t_date"))
    j = tasks.join(outcomes.withColumn("met", F.lit(True)), "base_arxiv_id", "left").join(target, "target_observation_id", "left")
    kind = F.when(F.col("met").isNull(), F.lit(None)).otherwise(F.coalesce("error_kind", bind_error(F.col("t_record"), F.col("result"))))
    j = j.withColumn("kind", kind).withColumn("why", F.when(F.col("error_kind").isNotNull(), F.coalesce("error", F.lit("Search enrichment failed"))).otherwise(F.col("kind")))
    ok = j.filter("met and kind is null and t_record is not null")
    record = (
        F.col("t_record")
        .withField("metadata", F.col("t_record.metadata").withField("authors", F.col("result.authors")).withField("primary_category", F.col("result.primary_category")))
        .withField("field_provenance", F.col("t_record.field_provenance").withField("authors", F.lit("search_api_optional")).withField("primary_category", F.lit("search_api_optional")))
    )
    made = ok.select(F.col("t_key").alias("logical_record_key"), record.alias("record"), F.col("t_date").alias("partition_date"), F.col("target_observation_id").alias("supersedes_observation_id")).withColumn("record_content_sha256", canon.content_hash(F.col("record")))
    made = made.select(
        "logical_record_key", ident.observation_id(scope_id, F.col("record.oai_identifier"), F.col("record.source_datestamp"), F.lit("upsert"), F.col("record_content_sha256"), F.col("supersedes_observation_id")).alias("observation_id"),
        F.lit("upsert").alias("operation"), "partition_date", "record", "record_content_sha256", F.lit(None).cast(observations.schema["retract"].dataType).alias("retract"), "supersedes_observation_id",
    )
    n, status, again = after_failure(F.col("attempt_count"), F.lit(today).cast("date"))
    failed = F.col("kind").isNotNull()
    value = {
        "attempt_count": F.when(failed, n).otherwise(F.col("attempt_count")), "status": F.when(failed, status).otherwise(F.col("status")), "next_attempt_date": F.when(failed, again).otherwise(F.col("next_attempt_date")), "last_attempt_at": F.when(failed, F.lit(attempted_at)).otherwise(F.col("last_attempt_at")),
        "last_error_kind": F.when(failed, F.substring(canon.normalize_single_line(F.col("kind")), 1, 100)).otherwise(F.col("last_error_kind")), "last_error": F.when(failed, F.substring(canon.normalize_multiline(F.col("why")), 1, 1000)).otherwise(F.col("last_error")),
    }
    left = j.filter("not coalesce(met and kind is null and t_record is not null, false)").select(*[value.get(c, F.col(c)).alias(c) for c in _TASK_FIELDS])
    return made, left


def backlog_age_hours(tasks: DataFrame, now: str) -> DataFrame:
    """``backlog, oldest_age_hours``: a double beside the documents, null for an empty backlog; never below 0."""
    age = (F.unix_micros(F.to_timestamp(F.lit(now))) - F.unix_micros(F.to_timestamp(F.min("first_enqueued_at")))) / 3.6e9
    return tasks.agg(F.count("*").alias("backlog"), F.greatest(F.lit(0.0), age).alias("a")).select("backlog", F.when(F.col("backlog") > 0, F.col("a")).alias("oldest_age_hours"))


def enrichment_summary(observations: DataFrame, tasks: DataFrame, enabled: bool) -> DataFrame:
    """``partition_date, status, succeeded, failed, deferred`` for each partition."""
    own = observations.groupBy("partition_date").agg(
        F.count_if((F.col("operation") == "upsert") & (F.col("record.field_provenance.authors") == "search_api_optional")).alias("succeeded"), F.bool_or(F.lit(enabled) & (F.col("operation") == "upsert")).alias("relevant")
    )
    open_ = tasks.groupBy(F.col("target_source_date").alias("partition_date")).agg(F.count("*").alias("open"), F.count_if((F.col("attempt_count") > 0) & (F.col("status") == "pending")).alias("failed"), F.count_if(F.col("status") == "deferred").alias("deferred"))
    j = own.join(open_, "partition_date", "left")
    status = F.when(F.col("open") > 0, "partial").when(F.coalesce("relevant", F.lit(False)) | (F.col("succeeded") > 0), "complete").otherwise("not_requested")
    return j.select("partition_date", status.alias("status"), "succeeded", F.coalesce("failed", F.lit(0)).alias("failed"), F.coalesce("deferred", F.lit(0)).alias("deferred"))


def request_list(tasks: DataFrame, candidates: DataFrame, today: str, limit: int, batch_size: int) -> DataFrame:
    """``base_arxiv_id, rank, batch``: due tasks by age, then new ids in order, each once, at most ``limit``.

    The limit is the feature (a budget of requests); 0 asks for none.
    """
    queue = due(tasks, today).select("base_arxiv_id", F.lit(0).alias("p"), F.col("first_enqueued_at").alias("a"), F.col("task_key").alias("b"))
    fresh = candidates.select("base_arxiv_id", F.lit(1).alias("p"), F.lit("").alias("a"), F.col("base_arxiv_id").alias("b"))
    first = queue.unionByName(fresh).groupBy("base_arxiv_id").agg(F.min(F.struct("p", "a", "b")).alias("o")).orderBy("o").limit(limit)
    ranked = first.withColumn("rank", F.row_number().over(Window.orderBy("o")))
    return ranked.select("base_arxiv_id", "rank", F.floor((F.col("rank") - 1) / batch_size).cast("int").alias("batch"))
