"""Hash chains: an observation's id holds the id it supersedes, so a key's ids are folded in order.

A key's rows are sorted within one task and streamed; a hot key is a long stream, not a large group
in memory.  Keys are independent and hashed over the tasks.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions import ident
from ledgerfold.schemas import RETRACT_RECORD

_IDS = "id_key string, id_date string, id_pos bigint, observation_id string, supersedes_observation_id string"


def _hash(parts: list[str | None]) -> str:
    return "sha256:" + hashlib.sha256(json.dumps(parts, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def _walk(scope_id: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = last = None
        for b in batches:
            ids, before = [], []
            for k, ident_, day, op, content, base in zip(*(b[c].to_pylist() for c in ("id_key", "oai", "id_date", "op", "content", "base")), strict=True):
                if k != key:
                    key, last = k, base
                before.append(last)
                last = _hash([ident.DOMAIN_OBSERVATION, scope_id, ident_, day, op, content, last])
                ids.append(last)
            yield pa.RecordBatch.from_arrays([b["id_key"], b["id_date"], b["id_pos"], pa.array(ids, pa.string()), pa.array(before, pa.string())], ["id_key", "id_date", "id_pos", "observation_id", "supersedes_observation_id"])

    return run


def chain_ids(rows: DataFrame, scope_id: str, place: str | None = None) -> DataFrame:
    """``rows`` with ``observation_id`` and ``supersedes_observation_id``, in the order of day and ``place``.

    ``rows`` has ``logical_record_key, source_datestamp, operation, record, record_content_sha256`` and
    ``base_id``, the head before them.  Only keys and hashes go through Python; records do not.
    """
    placed = rows.withColumn("r_pos", (F.col(place) if place else F.lit(0)).cast("bigint"))
    thin = placed.select(
        F.col("logical_record_key").alias("id_key"), F.col("record.oai_identifier").alias("oai"), F.col("source_datestamp").alias("id_date"), F.col("operation").alias("op"),
        F.col("record_content_sha256").alias("content"), F.col("base_id").alias("base"), F.col("r_pos").alias("id_pos"),
    )
    ordered = thin.repartition("id_key").sortWithinPartitions("id_key", "id_date", "id_pos", "content")
    ids = ordered.mapInArrow(_walk(scope_id), _IDS)
    same = (F.col("logical_record_key") == F.col("id_key")) & (F.col("source_datestamp") == F.col("id_date")) & (F.col("r_pos") == F.col("id_pos"))
    return placed.join(ids, same).drop("id_key", "id_date", "id_pos", "r_pos")


def as_observations(linked: DataFrame, *more: str) -> DataFrame:
    """Linked rows in the shape of observations."""
    return linked.select(
        "logical_record_key", "observation_id", "operation", F.col("source_datestamp").alias("partition_date"), "record", "record_content_sha256", F.lit(None).cast(RETRACT_RECORD).alias("retract"), "supersedes_observation_id", *more
    )


def chain_hashes(rows: DataFrame, key: str, order: list[str], parts: list[Column]) -> DataFrame:
    """``key, order, chain_hash``: hash of a JSON array of ``parts`` and the hash before it (null first).

    Each key's rows are sorted in one task and streamed, so a hot key costs time and no memory.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    thin = rows.select(key, *order, F.array(*[p.cast("string") for p in parts]).alias("parts")).repartition(key).sortWithinPartitions(key, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last, first = None, None, True
        for b in batches:
            out = []
            for k, p in zip(b[key].to_pylist(), b["parts"].to_pylist(), strict=True):
                if first or k != now:
                    now, last, first = k, None, False
                last = _hash([*p, last])
                out.append(last)
            yield pa.RecordBatch.from_arrays([b[key], *(b[o] for o in order), pa.array(out, pa.string())], [key, *order, "chain_hash"])

    return thin.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in (key, *order)) + ", chain_hash string")


def rechain(observations: DataFrame, scope_id: str, heads: DataFrame | None = None) -> DataFrame:
    """Observations re-linked after retractions and late changes, with ``old_id`` and ``changed``.

    Retracted rows and retractions stay as they are.  The live rows of a key follow one another by day
    and, within a day, by the chain they formed, a retracted row's successors following what it
    followed; ids are folded anew, so a change runs down to every later row of its key.
    """
    from ledgerfold.operators.upserts import chain_places

    retracted = observations.filter(F.col("operation") == "producer_retract").select(F.col("retract.target_observation_id").alias("u_id")).distinct()
    source = observations.filter(F.col("operation") != "producer_retract")
    live = source.join(retracted, F.col("observation_id") == F.col("u_id"), "left_anti")
    places = chain_places(source, "logical_record_key", "observation_id", "partition_date", "supersedes_observation_id")
    placed = live.join(places, "observation_id")
    if heads is None:
        based = placed.withColumn("base_id", F.lit(None).cast("string"))
    else:
        based = placed.join(heads.select("logical_record_key", F.col("observation_id").alias("base_id")), "logical_record_key", "left")
    rows = based.select("logical_record_key", F.col("partition_date").alias("source_datestamp"), "operation", "record", "record_content_sha256", "base_id", "place", F.col("observation_id").alias("old_id"))
    return as_observations(chain_ids(rows, scope_id, "place"), "old_id", (F.col("old_id") != F.col("observation_id")).alias("changed"))
