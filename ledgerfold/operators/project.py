"""Records of the change stream through a scope to observations.

All dates are projected in one pass: what the state before a record was comes from windows over its
key (how it was ever in scope, the content before it), not from folding the history date by date.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.functions import canon, ident
from ledgerfold.operators.fold import TEXT_FIELDS
from ledgerfold.schemas import SOURCE_RECORD, SOURCE_RECORD_FIELDS

@dataclass(frozen=True)
class Scope:
    scope_id: str
    categories: tuple[str, ...]
    aliases: dict[str, str]

    @staticmethod
    def of(document: dict) -> Scope:
        """From a scope document, checked: sorted lists without repetition, aliases to categories of the scope."""
        errors = scope_errors(document)
        if errors:
            raise ValueError("; ".join(errors))
        return Scope(document["scope_id"], tuple(document["categories"]), dict(document["category_aliases"]))

    def alias_map(self) -> Column:
        if not self.aliases:
            return F.create_map().cast("map<string,string>")
        return F.create_map(*[F.lit(x) for kv in sorted(self.aliases.items()) for x in kv])

    def contains(self, categories: Column) -> Column:
        """Whether a list of categories meets the scope; false for null."""
        inside = F.arrays_overlap(canon.canonical_categories(categories, self.alias_map()), F.array(*[F.lit(c) for c in self.categories]))
        return F.coalesce(inside, F.lit(False))


def scope_errors(document: dict) -> list[str]:
    """Rules that a scope document breaks."""
    keys = {"contract_version", "scope_schema_version", "feed_id", "scope_id", "categories", "category_aliases", "include_crosslists", "keywords", "normalizer_version"}
    out = []
    if set(document) != keys:
        out.append(f"scope keys differ: {sorted(set(document) ^ keys)}")
        return out
    cats, aliases = document["categories"], document["category_aliases"]
    if not cats or cats != sorted(set(cats)):
        out.append("categories must be sorted, distinct and not empty")
    if document["include_crosslists"] is not True:
        out.append("include_crosslists must be true")
    if document["keywords"] != []:
        out.append("keywords must be empty")
    if any(not isinstance(x, str) or not x or x != x.strip() for kv in aliases.items() for x in kv):
        out.append("aliases must be normalized text")
    return out


def normalize_records(raw: DataFrame) -> DataFrame:
    """Text fields of live records in canonical form, blank ones null; deleted records pass through."""
    fields = {}
    for name, lines in TEXT_FIELDS:
        clean = canon.sanitize_controls(F.col(f"metadata.{name}"))
        fields[name] = canon.blank_to_null(canon.normalize_multiline(clean) if lines else canon.normalize_single_line(clean))
    done = F.col("metadata")
    for name, value in fields.items():
        done = done.withField(name, value)
    return raw.withColumn("metadata", F.when(~F.col("deleted") & F.col("metadata").isNotNull(), done))


def text_repairs(raw: DataFrame) -> DataFrame:
    """``oai_identifier, source_datestamp, field, code_point, count``: control characters that normalizing replaces."""
    per_field = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(n).alias("field"), canon.control_repairs(F.col(f"metadata.{n}")).alias("repairs")) for i, (n, _) in enumerate(TEXT_FIELDS)])
    return (
        raw.filter("not deleted and metadata is not null")
        .select("oai_identifier", "source_datestamp", F.explode(per_field).alias("f"))
        .select("oai_identifier", "source_datestamp", "f.ord", "f.field", F.explode("f.repairs").alias("r"))
        .select("oai_identifier", "source_datestamp", "field", "r.code_point", "r.count", "ord")
    )


def record_for(operation: Column) -> Column:
    """The source record that an operation keeps of a harvested one, as a struct in canonical order."""
    deleted = operation == "source_delete"
    value = {
        "current_version": F.when(~deleted, F.col("current_version")),
        "field_provenance": F.when(~deleted, F.col("field_provenance")),
        "metadata": F.when(~deleted, F.col("metadata")),
        "operation": operation,
        "version_history": F.when(operation == "scope_exit", F.array().cast("array<struct<submitted_at:string,version:int>>")).when(~deleted, F.col("version_history")),
        "versioned_arxiv_id": F.when(~deleted, F.col("versioned_arxiv_id")),
    }
    return F.struct(*[value.get(c, F.col(c)).alias(c) for c in SOURCE_RECORD_FIELDS]).cast(SOURCE_RECORD)


def classify(deleted: Column, in_scope: Column, ever: Column, gone: Column) -> Column:
    """The operation of a record; ``ignored`` for what never was in scope, ``after_delete`` for a breach."""
    return (
        F.when(gone & ~deleted, "after_delete").when(gone, "ignored")
        .when(deleted & ever, "source_delete").when(deleted, "ignored")
        .when(in_scope, "upsert").when(ever, "scope_exit").otherwise("ignored")
    )


def classify_stream(raw: DataFrame, scope: Scope, state: DataFrame | None = None, tie: tuple[str, ...] = ()) -> DataFrame:
    """``raw`` with its key, ``in_scope`` and ``operation``, over all dates at once.

    Order of a key: its datestamp, then the columns ``tie`` (a harvest has one row a day).  ``state`` is
    the folded state before the stream.  A second delete of a key is ignored.
    """
    keyed = raw.withColumn("logical_record_key", ident.record_key(F.col("oai_identifier"))).withColumn("in_scope", ~F.col("deleted") & scope.contains(F.col("metadata.categories")))
    if state is None:
        based = keyed.withColumns({"base_ever": F.lit(False), "base_gone": F.lit(False), "base_hash": F.lit(None).cast("string"), "base_id": F.lit(None).cast("string")})
    else:
        before = state.select("logical_record_key", F.col("ever_in_scope").alias("base_ever"), F.col("source_deleted").alias("base_gone"), F.col("record_content_sha256").alias("base_hash"), F.col("observation_id").alias("base_id"))
        based = keyed.join(before, "logical_record_key", "left").withColumns({"base_ever": F.coalesce("base_ever", F.lit(False)), "base_gone": F.coalesce("base_gone", F.lit(False))})
    earlier = Window.partitionBy("logical_record_key").orderBy("source_datestamp", *tie).rowsBetween(Window.unboundedPreceding, -1)
    ever = F.col("base_ever") | F.coalesce(F.bool_or("in_scope").over(earlier), F.lit(False))
    marked = based.withColumn("ever", ever)
    gone = F.col("base_gone") | F.coalesce(F.bool_or(F.col("deleted") & F.col("ever")).over(earlier), F.lit(False))
    return marked.withColumn("gone", gone).withColumn("operation", classify(F.col("deleted"), F.col("in_scope"), F.col("ever"), F.col("gone")))


def projection_violations(raw: DataFrame, scope: Scope, state: DataFrame | None = None, tie: tuple[str, ...] = ()) -> DataFrame:
    """``rule, key, source_datestamp``: records that come after the delete of their key, which ends it."""
    late = classify_stream(raw, scope, state, tie).filter("operation = 'after_delete'")
    return late.select(F.col("operation").alias("rule"), F.col("logical_record_key").alias("key"), "source_datestamp")


def project(raw: DataFrame, scope: Scope, state: DataFrame | None = None, breaches: str = "raise") -> DataFrame:
    """Observations of a stream that are new: changed content only, chained per key.

    The scope is applied before any text is touched, so text out of scope cannot fail a job.  An
    observation's id holds its predecessor's, so ids of a key are folded in order; keys are
    independent.  A record after the delete of its key fails the job; with ``breaches="skip"`` it is
    left out, and :func:`projection_violations` names it.
    """
    if breaches not in ("raise", "skip"):
        raise ValueError("breaches are raised or skipped")
    from ledgerfold.operators.chain import as_observations, chain_ids

    ops = classify_stream(raw, scope, state).filter("operation <> 'ignored'")
    if breaches == "skip":
        ops = ops.filter("operation <> 'after_delete'")
    else:
        stop = F.raise_error(F.concat(F.lit("source_delete is terminal: "), F.col("oai_identifier"))).cast("string")
        ops = ops.withColumn("operation", F.when(F.col("operation") == "after_delete", stop).otherwise(F.col("operation")))
    ready = normalize_records(ops).withColumn("record", record_for(F.col("operation"))).withColumn("record_content_sha256", canon.content_hash(F.col("record")))
    order = Window.partitionBy("logical_record_key").orderBy("source_datestamp")
    last = F.coalesce(F.lag("record_content_sha256").over(order), F.col("base_hash"))
    fresh = ready.withColumn("last_hash", last).filter(~F.col("last_hash").eqNullSafe(F.col("record_content_sha256")))
    linked = chain_ids(fresh.select("logical_record_key", "source_datestamp", "operation", "record", "record_content_sha256", "base_id"), scope.scope_id)
    return as_observations(linked)
