"""Catalogue of queries over the driver's tables: ``name -> f(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.operators.hierarchy import expand_hierarchy
from ledgerfold.operators.instants import CANONICAL, MONTHS, ZONE_MINUTES, normalise_instants
from ledgerfold.operators.packed_values import split_packed
from ledgerfold.operators.upserts import apply_change_feed

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Records present now, each with its last valid observation."""
    state = apply_change_feed(table(spark, folder, "observation"))
    return state.filter(F.col("operation") == "upsert").select("logical_record_key", "observation_id")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Instants not written in the canonical form, in UTC."""
    submitted = table(spark, folder, "raw_record").select("raw_id", F.explode("version_history").alias("v")).select("raw_id", "v.version", F.col("v.submitted_at").alias("value"))
    other = F.col("value").isNotNull() & ~F.col("value").rlike(CANONICAL)
    records = normalise_instants(submitted.filter(other), "value").select(F.lit("raw_record").alias("origin"), F.col("raw_id").alias("row_id"), F.col("version").cast("int").alias("version"), "utc")
    answers = table(spark, folder, "oai_page").select("page_id", "server_zone", F.col("response_date").alias("value"))
    pages = normalise_instants(answers.filter(other), "value", local_zone="server_zone").select(F.lit("oai_page").alias("origin"), F.col("page_id").alias("row_id"), F.lit(0).alias("version"), "utc")
    return records.unionByName(pages).filter("utc is not null")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Authors and sets that share a string, each with its position."""
    return split_packed(table(spark, folder, "raw_record"), "raw_id", {"authors_raw": ("metadata.authors_raw", "names"), "source_sets": ("source_sets", "tokens")}, least=2)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Root, depth and number of descendants of every observation."""
    tree = expand_hierarchy(table(spark, folder, "observation"), "observation_id", "supersedes_observation_id", order_col="feed_seq")
    return tree.select(F.col("id").alias("observation_id"), F.col("root_id").alias("root_observation_id"), "depth", "n_descendants")


from ledgerfold.catalogue import ORACLE as _ORACLE  # noqa: E402
from ledgerfold.catalogue import QUERIES as _QUERIES  # noqa: E402

_P1_SQL = """WITH RECURSIVE o AS (SELECT observation_id AS id, operation, logical_record_key AS k, source_datestamp AS d, supersedes_observation_id AS p, feed_seq, retract FROM observation
  WHERE logical_record_key IS NOT NULL AND observation_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY observation_id ORDER BY feed_seq) = 1),
u AS (SELECT DISTINCT retract.target_observation_id AS id FROM o WHERE operation = 'producer_retract'),
c AS (SELECT *, count(*) OVER (PARTITION BY k, d) AS n FROM o WHERE operation IS DISTINCT FROM 'producer_retract'),
l AS (SELECT c.id, q.id AS parent, c.n FROM c JOIN c q ON c.p = q.id AND c.k = q.k AND c.d = q.d AND c.id <> q.id),
w(id, reached, steps, n) AS (SELECT id, parent, 1, n FROM l UNION ALL SELECT w.id, l.parent, w.steps + 1, w.n FROM w JOIN l ON l.id = w.reached WHERE w.steps < w.n),
r AS (SELECT id, CASE WHEN max(steps) < any_value(n) THEN max(steps) ELSE 0 END AS pos FROM w GROUP BY id),
m AS (SELECT c.k, max({'d': c.d, 'pos': coalesce(r.pos, 0), 'seq': -c.feed_seq, 'id': c.id, 'op': c.operation}) AS s FROM c LEFT JOIN r USING (id) WHERE c.id NOT IN (SELECT id FROM u WHERE id IS NOT NULL) GROUP BY c.k)
SELECT k AS logical_record_key, s.id AS observation_id FROM m WHERE s.op = 'upsert'"""
_P6_SQL = """WITH RECURSIVE o AS (SELECT observation_id AS id, supersedes_observation_id AS p FROM observation WHERE observation_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY observation_id ORDER BY feed_seq) = 1),
e AS (SELECT o.id, q.id AS p FROM o LEFT JOIN o q ON o.p = q.id AND trim(o.p) <> ''),
t(id, root, depth) AS (SELECT id, id, 0 FROM e WHERE p IS NULL UNION ALL SELECT e.id, t.root, t.depth + 1 FROM t JOIN e ON e.p = t.id),
a(id, up) AS (SELECT t.id, e.p FROM t JOIN e USING (id) WHERE e.p IS NOT NULL UNION ALL SELECT a.id, e.p FROM a JOIN e ON e.id = a.up WHERE e.p IS NOT NULL),
n AS (SELECT up AS id, count(*) AS n FROM a GROUP BY up)
SELECT e.id AS observation_id, coalesce(t.root, '') AS root_observation_id, coalesce(t.depth, -1)::INT AS depth, CASE WHEN t.id IS NULL THEN -1 ELSE coalesce(n.n, 0) END::INT AS n_descendants FROM e LEFT JOIN t USING (id) LEFT JOIN n USING (id)"""

_MON = "|".join(MONTHS)
_DAY = "(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*"
_ZONES = "|".join(sorted(ZONE_MINUTES, key=lambda z: (-len(z), z)))
_FORMS = {  # date notations, and what makes year|month|day|time of each
    r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:t|\s+)(.*)$": r"\1|\2|\3|\4",
    r"^(\d{4})(\d{2})(\d{2})t(\d{2})(\d{2})(\d{2})(.*)$": r"\1|\2|\3|\4:\5:\6\7",
    r"^(\d{4})(\d{2})(\d{2})t(\d{2})(\d{2})((?:[^\d].*)?)$": r"\1|\2|\3|\4:\5\6",
    rf"^{_DAY},?\s+)?(\d{{1,2}})[\s-]({_MON})[a-z]*\.?[\s-](\d{{4}}|\d{{2}})\s+(.*)$": r"\3|\2|\1|\4",
    rf"^{_DAY}\s+)?({_MON})[a-z]*\.?\s+(\d{{1,2}})\s+(\d{{1,2}}:.*?)\s+(\d{{4}})$": r"\4|\1|\2|\3",
    rf"^{_DAY},?\s+)?({_MON})[a-z]*\.?\s+(\d{{1,2}}),?\s+(\d{{4}}),?\s+(.*)$": r"\3|\1|\2|\4",
}
_TIME_SQL = r"^(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d{1,12})?)?(?:\s*([ap])\.?m\b\.?)?\s*(.*)$"
_OFFSET_SQL = rf"^(?:({_ZONES})?([+\-−])(\d{{2}}):?(\d{{2}})?|({_ZONES}))?\s*(?:\[?([a-z][a-z_]+(?:/[a-z0-9_+\-]+)+|utc|gmt)\]?)?\s*(?:\([^()]*\))?$"
_P2_SQL = f"""WITH v AS (SELECT 'raw_record' AS origin, raw_id AS row_id, v.version::INT AS version, v.submitted_at AS value, 'UTC' AS lz FROM (SELECT raw_id, unnest(version_history) AS v FROM raw_record)
  UNION ALL SELECT 'oai_page', page_id, 0, response_date, server_zone FROM oai_page),
t AS (SELECT *, lower(regexp_replace(value, '^\\s+|\\s+$', '', 'g')) AS t FROM v WHERE value IS NOT NULL AND NOT regexp_matches(value, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}Z$')),
f AS (SELECT *, CASE {" ".join(f"WHEN regexp_matches(t, '{k}') THEN regexp_replace(t, '{k}', '{r}')" for k, r in _FORMS.items())} END AS q FROM t),
c AS (SELECT *, split_part(q, '|', 1) AS y, split_part(q, '|', 2) AS mo, split_part(q, '|', 3) AS d, split_part(q, '|', 4) AS rest FROM f),
h AS (SELECT *, regexp_extract(rest, '{_TIME_SQL}', ['h', 'mi', 's', 'ap', 'z']) AS x FROM c),
o AS (SELECT *, regexp_extract(x.z, '{_OFFSET_SQL}', ['a', 'sign', 'zh', 'zm', 'b', 'zone']) AS w, regexp_matches(x.z, '{_OFFSET_SQL}') AS whole FROM h),
n AS (SELECT *, CASE WHEN length(y) > 2 THEN y WHEN y < '70' THEN '20' || y ELSE '19' || y END AS yy, coalesce(list_position({list(MONTHS)!r}, substr(mo, 1, 3)), 0) AS mm,
  CASE WHEN x.ap = '' THEN try_cast(x.h AS INT) WHEN try_cast(x.h AS INT) BETWEEN 1 AND 12 THEN try_cast(x.h AS INT) % 12 + CASE WHEN x.ap = 'p' THEN 12 ELSE 0 END END AS hh FROM o WHERE q IS NOT NULL AND x.h <> '' AND whole),
p AS (SELECT *, try_cast(yy || '-' || lpad(CASE WHEN mm > 0 THEN mm::VARCHAR ELSE mo END, 2, '0') || '-' || lpad(d, 2, '0') || ' ' || lpad(hh::VARCHAR, 2, '0') || ':' || x.mi || ':' || CASE WHEN x.s = '' THEN '00' ELSE x.s END AS TIMESTAMP) AS ts FROM n WHERE hh < 24),
z AS (SELECT p.*, g.name AS named, l.name AS here, CASE WHEN w.sign <> '' THEN CASE WHEN w.sign = '+' THEN 1 ELSE -1 END * (try_cast(w.zh AS INT) * 60 + coalesce(try_cast(w.zm AS INT), 0)) WHEN w.b <> '' THEN MAP {ZONE_MINUTES!r}[w.b] END AS east
  FROM p LEFT JOIN (SELECT DISTINCT name FROM pg_timezone_names()) g ON lower(g.name) = w.zone LEFT JOIN (SELECT DISTINCT name FROM pg_timezone_names()) l ON l.name = lz
  WHERE ts IS NOT NULL AND (w.sign = '' OR (try_cast(w.zh AS INT) <= 18 AND coalesce(try_cast(w.zm AS INT), 0) <= 59))),
r AS (SELECT origin, row_id, version, CASE WHEN east IS NOT NULL THEN ts - to_minutes(east) WHEN w.zone <> '' AND named IS NULL THEN NULL
  ELSE least(timezone(coalesce(named, here, 'UTC'), ts), timezone(coalesce(named, here, 'UTC'), ts - INTERVAL 1 HOUR) + INTERVAL 1 HOUR) AT TIME ZONE 'UTC' END AS u FROM z
  UNION ALL SELECT origin, row_id, version, make_timestamp(CASE WHEN length(ltrim(t, '-')) = 13 THEN try_cast(t AS BIGINT) // 1000 ELSE try_cast(t AS BIGINT) END * 1000000) FROM t WHERE regexp_matches(t, '^-?(\\d{{13}}|\\d{{9,11}})$'))
SELECT origin, row_id, version, strftime(u, '%Y-%m-%dT%H:%M:%SZ') AS utc FROM r WHERE u IS NOT NULL"""

QUERIES: dict[str, Query] = {"p1_found": p1_found, "p2_found": p2_found, "p3_found": p3_found, "p6_found": p6_found, **_QUERIES}
ORACLE: dict[str, str] = {"p1_found": _P1_SQL, "p2_found": _P2_SQL, "p6_found": _P6_SQL, **_ORACLE}
