"""Reviewed retractions of single observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import canon, ident
from ledgerfold.schemas import RETRACT_RECORD, RETRACT_RECORD_FIELDS, SOURCE_RECORD

SPEC = "producer_correction_key string, target_observation_id string, producer_observed_at string, reason_code string, reason string, replacement_observation_id string"


def correction_violations(observations: DataFrame, specs: DataFrame) -> DataFrame:
    """``rule, key`` (the correction key) for every correction that may not be made."""
    s = specs.withColumns({"producer_correction_key": canon.normalize_single_line(F.col("producer_correction_key")), "reason_code": canon.normalize_single_line(F.col("reason_code")), "reason": canon.normalize_multiline(F.col("reason"))})
    source = observations.filter(F.col("operation") != "producer_retract").groupBy("observation_id").agg(F.count("*").alias("n"), F.min("logical_record_key").alias("k"))
    done = observations.filter(F.col("operation") == "producer_retract").select(F.col("retract.target_observation_id").alias("d_target"), F.col("retract.producer_correction_key").alias("d_key"))
    target = s.join(source, F.col("target_observation_id") == F.col("observation_id"), "left")
    other = source.select(F.col("observation_id").alias("r_id"), F.col("k").alias("r_k"), F.col("n").alias("r_n"))
    replaced = target.filter("replacement_observation_id is not null").join(other, F.col("replacement_observation_id") == F.col("r_id"), "left")
    key = F.col("producer_correction_key").alias("key")
    text = (F.coalesce(F.col("producer_correction_key"), F.lit("")) == "") | (F.coalesce(F.col("reason_code"), F.lit("")) == "") | (F.coalesce(F.col("reason"), F.lit("")) == "") | (F.length("reason") > 1000)
    stamp = ~F.coalesce(F.col("producer_observed_at").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"), F.lit(False))
    rule = lambda df, name: df.select(F.lit(name).alias("rule"), key)
    return (
        rule(s.filter(text), "text_invalid")
        .unionByName(rule(s.filter(stamp), "timestamp_invalid"))
        .unionByName(rule(target.filter("n is null or n <> 1"), "target_not_one_source_observation"))
        .unionByName(rule(s.join(done, F.col("target_observation_id") == F.col("d_target"), "left_semi"), "target_already_retracted"))
        .unionByName(rule(s.join(done, F.col("producer_correction_key") == F.col("d_key"), "left_semi"), "key_already_used"))
        .unionByName(rule(replaced.filter("r_n is null or r_n <> 1"), "replacement_absent"))
        .unionByName(rule(replaced.filter("r_k <> k"), "replacement_of_other_record"))
    )


def build_retractions(observations: DataFrame, specs: DataFrame, scope_id: str) -> DataFrame:
    """Retraction observations for corrections without violation, in the partition of their targets."""
    source = observations.filter(F.col("operation") != "producer_retract").select(F.col("observation_id").alias("target_observation_id"), "logical_record_key", F.col("record.source_datestamp").alias("target_source_date"))
    bad = correction_violations(observations, specs).select(F.col("key").alias("b_key")).distinct()
    s = specs.withColumns({"producer_correction_key": canon.normalize_single_line(F.col("producer_correction_key")), "reason_code": canon.normalize_single_line(F.col("reason_code")), "reason": canon.normalize_multiline(F.col("reason"))})
    rows = s.join(bad, F.col("producer_correction_key") == F.col("b_key"), "left_anti").join(source, "target_observation_id").withColumn("operation", F.lit("producer_retract"))
    retract = F.struct(*[F.col(c) for c in RETRACT_RECORD_FIELDS]).cast(RETRACT_RECORD)
    hashed = rows.withColumn("retract", retract).withColumn("record_content_sha256", canon.content_hash(F.col("retract")))
    return hashed.select(
        "logical_record_key", ident.retract_id(scope_id, F.col("producer_correction_key"), F.col("target_observation_id"), F.col("record_content_sha256")).alias("observation_id"), "operation",
        F.col("target_source_date").alias("partition_date"), F.lit(None).cast(SOURCE_RECORD).alias("record"), "record_content_sha256", "retract", F.lit(None).cast("string").alias("supersedes_observation_id"),
    )
