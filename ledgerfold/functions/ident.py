"""Identifiers and the hashes that name records, observations and tasks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerfold.functions.canon import domain_hash, file_hash

#: The domains of the hashes.
DOMAIN_RECORD = "arxiv-logical-record-v1"
DOMAIN_OBSERVATION = "arxiv-oai-observation-v1"
DOMAIN_CORRECTION = "arxiv-producer-correction-v1"
DOMAIN_DIRECT = "arxiv-direct-atom-observation-v1"
DOMAIN_TASK = "arxiv-search-enrichment-task-v1"
#: Forms of identifiers, ASCII digits only.
ID = r"^([0-9]{4}\.[0-9]{4,5}|[A-Za-z][A-Za-z0-9.-]*/[0-9]{7})(?:v([1-9][0-9]*))?$"
OAI_PREFIX = "oai:arXiv.org:"


def parse_id(c: Column) -> Column:
    """``struct<base_id, version>``; null for text that is no identifier, version null where it has none."""
    version = F.nullif(F.regexp_extract(c, ID, 2), F.lit("")).cast("int")
    return F.when(c.rlike(ID), F.struct(F.regexp_extract(c, ID, 1).alias("base_id"), version.alias("version")))


def base_id_of(oai_identifier: Column) -> Column:
    """Base id of an OAI identifier; null where it is none or carries a version."""
    rest = F.substring(oai_identifier, len(OAI_PREFIX) + 1, 2147483647)
    parsed = parse_id(rest)
    return F.when(oai_identifier.startswith(OAI_PREFIX) & parsed["version"].isNull(), parsed["base_id"])


def versioned_id(base_id: Column, version: Column) -> Column:
    return F.concat(base_id, F.when(version.isNotNull(), F.concat(F.lit("v"), version.cast("string"))).otherwise(""))


def record_key(oai_identifier: Column) -> Column:
    return F.when(oai_identifier.isNotNull(), domain_hash(F.lit(DOMAIN_RECORD), oai_identifier))


def observation_id(scope_id: Column | str, oai_identifier: Column, source_date: Column, operation: Column, content: Column, supersedes: Column) -> Column:
    scope = F.lit(scope_id) if isinstance(scope_id, str) else scope_id
    return domain_hash(F.lit(DOMAIN_OBSERVATION), scope, oai_identifier, source_date, operation, content, supersedes)


def retract_id(scope_id: str, correction_key: Column, target_id: Column, content: Column) -> Column:
    return domain_hash(F.lit(DOMAIN_CORRECTION), F.lit(scope_id), correction_key, target_id, content)


def direct_id(key: Column, updated_at: Column, content: Column, supersedes: Column) -> Column:
    return domain_hash(F.lit(DOMAIN_DIRECT), key, updated_at, F.lit("upsert"), content, supersedes)


def task_key(base_id: Column) -> Column:
    return file_hash(F.struct(base_id.alias("base_arxiv_id"), F.lit(DOMAIN_TASK).alias("domain")))


def material_hash(base_id: Column, version: Column, title: Column, abstract: Column) -> Column:
    return file_hash(F.struct(abstract.alias("abstract"), base_id.alias("base_arxiv_id"), version.alias("current_version"), title.alias("title")))


def id_from_url(url: Column) -> Column:
    """Parsed id of the last part of a URL's path."""
    return parse_id(F.substring_index(F.regexp_extract(url, r"^[^?#]*", 0), "/", -1))
