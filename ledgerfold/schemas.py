"""Schemas of the documents, with the fields of every object in sorted order.

The order decides the canonical JSON and so every hash: never reorder a struct.
"""

from __future__ import annotations

VERSION_HISTORY = "array<struct<submitted_at:string,version:int>>"
AUTHORS = "array<struct<name:string>>"
METADATA = f"struct<abstract:string,authors:{AUTHORS},authors_raw:string,categories:array<string>,comment:string,doi:string,journal_ref:string,license:string,primary_category:string,title:string>"
PROVENANCE = "struct<authors:string,authors_raw:string,primary_category:string,version_history:string>"

#: A harvested record.
RAW_RECORD = (
    f"base_arxiv_id string, current_version int, deleted boolean, field_provenance {PROVENANCE}, metadata {METADATA}, oai_identifier string,"
    f" source_datestamp string, source_sets array<string>, version_history {VERSION_HISTORY}, versioned_arxiv_id string"
)
#: The record of an observation of the source: an upsert, a scope exit or a source delete.
SOURCE_RECORD_FIELDS = ("base_arxiv_id", "current_version", "field_provenance", "logical_record_key", "metadata", "oai_identifier", "operation", "source_datestamp", "source_sets", "version_history", "versioned_arxiv_id")
SOURCE_RECORD = (
    f"struct<base_arxiv_id:string,current_version:int,field_provenance:{PROVENANCE},logical_record_key:string,metadata:{METADATA},oai_identifier:string,"
    f"operation:string,source_datestamp:string,source_sets:array<string>,version_history:{VERSION_HISTORY},versioned_arxiv_id:string>"
)
#: The record of a retraction; its keys differ, so it is hashed as a struct of its own.
RETRACT_RECORD_FIELDS = ("logical_record_key", "operation", "producer_correction_key", "producer_observed_at", "reason", "reason_code", "replacement_observation_id", "target_observation_id", "target_source_date")
RETRACT_RECORD = f"struct<{','.join(f'{c}:string' for c in RETRACT_RECORD_FIELDS)}>"

#: An observation: two nullable structs, of which ``operation`` says which one is set.
OBSERVATION = (
    f"logical_record_key string, observation_id string, operation string, partition_date string, record {SOURCE_RECORD}, record_content_sha256 string, retract {RETRACT_RECORD}, supersedes_observation_id string"
)
STATE = "logical_record_key string, ever_in_scope boolean, active_in_scope boolean, source_deleted boolean, observation_id string, record_content_sha256 string, operation string"
TASK = (
    "attempt_count int, base_arxiv_id string, first_enqueued_at string, last_attempt_at string, last_error string, last_error_kind string, next_attempt_date string, status string,"
    " target_current_version int, target_material_sha256 string, target_observation_id string, target_source_date string, task_key string"
)
SEARCH_RECORD = f"abstract string, authors {AUTHORS}, base_arxiv_id string, primary_category string, title string, version int"
DATA_PART = "ordinal int, path string, compressed_size bigint, compressed_sha256 string, uncompressed_size bigint, uncompressed_sha256 string, record_count bigint"
SHARD = "prefix string, path string, compressed_size bigint, compressed_sha256 string, uncompressed_size bigint, uncompressed_sha256 string, record_count bigint"

OPERATIONS = ("upsert", "scope_exit", "source_delete", "producer_retract")
