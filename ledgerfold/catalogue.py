"""Queries for the operators of the change log, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerfold.functions import canon, ident
from ledgerfold.operators import enrich
from ledgerfold.operators.chain import chain_hashes
from ledgerfold.operators.fold import TEXT_FIELDS, envelope_violations, fold, heads, live_observations, log_violations, new_observations, operation_counts, partition_counts
from ledgerfold.operators.project import Scope, classify_stream, project, projection_violations, text_repairs
from ledgerfold.plans.planner import frontier, pending_gaps
from ledgerfold.sources.objects import greedy_parts, read_objects, tree_diff, tree_digest, write_parts, write_shards
from ledgerfold.sources.pages import page_tokens, parse_pages, records_of
from ledgerfold.schemas import RETRACT_RECORD, SOURCE_RECORD, SOURCE_RECORD_FIELDS
from ledgerfold.storage import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _scope(spark: SparkSession, folder: str) -> Scope:
    row = _t(spark, folder, "feed_scope").select("scope_id", "categories", "category_aliases").first()  # the table has one row
    return Scope(row["scope_id"], tuple(row["categories"]), dict(row["category_aliases"] or {}))


def _observations(spark: SparkSession, folder: str) -> DataFrame:
    """Each observation once, as first delivered, in the columns that the log operators read."""
    o = _t(spark, folder, "observation").select("feed_seq", "observation_id", "operation", "logical_record_key", "source_datestamp", F.nullif("supersedes_observation_id", F.lit("")).alias("supersedes_observation_id"), "record_content_sha256", "retract")
    return o.groupBy("observation_id").agg(F.min_by(F.struct("operation", "logical_record_key", F.col("source_datestamp").alias("partition_date"), "supersedes_observation_id", "record_content_sha256", "retract"), "feed_seq").alias("x")).select("observation_id", "x.*")


_OBS = """o AS (SELECT observation_id, operation, logical_record_key, source_datestamp AS partition_date, nullif(supersedes_observation_id, '') AS sup, record_content_sha256, retract
  FROM observation QUALIFY row_number() OVER (PARTITION BY observation_id ORDER BY feed_seq) = 1),
tgt AS (SELECT DISTINCT retract.target_observation_id AS id FROM o WHERE operation = 'producer_retract'),
live AS (SELECT * FROM o WHERE operation <> 'producer_retract' AND observation_id NOT IN (SELECT id FROM tgt WHERE id IS NOT NULL))"""


@_query("SELECT raw_id, 'sha256:' || sha256(to_json(['arxiv-logical-record-v1', oai_identifier])::VARCHAR) AS logical_record_key FROM raw_record WHERE oai_identifier IS NOT NULL")
def q01_logical_key(spark, folder):
    """Keys of records from their identifiers."""
    return _t(spark, folder, "raw_record").filter("oai_identifier is not null").select("raw_id", ident.record_key(F.col("oai_identifier")).alias("logical_record_key"))


_STRIP = r"[ \n\x{2028}\x{2029}\x{85}\x{1C}-\x{1F}]+"
_LINES = "nfc_normalize(replace(replace({0}, chr(13) || chr(10), chr(10)), chr(13), chr(10)))"
def _single_sql(c: str) -> str:
    lines = _LINES.format(c)
    return f"regexp_replace(regexp_replace(regexp_replace(replace({lines}, chr(10), ' '), '[\\t\\p{{Zs}}]+', ' ', 'g'), '^{_STRIP}', ''), '{_STRIP}$', '')"


def _multi_sql(c: str) -> str:
    lines = _LINES.format(c)
    return f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({lines}, '[\\t\\p{{Zs}}]+', ' ', 'g'), ' +(\\n|$)', '\\1', 'g'), '^{_STRIP}', ''), '{_STRIP}$', '')"


@_query(f"SELECT doc_id, sha256({_single_sql('text')}) AS digest, length({_single_sql('text')}) AS n_chars FROM documents")
def q02_normalize_single(spark, folder):
    """Texts as one line."""
    c = canon.normalize_single_line(F.col("text"))
    return _t(spark, folder, "documents").select("doc_id", F.sha2(c, 256).alias("digest"), F.length(c).cast("bigint").alias("n_chars"))


@_query(f"SELECT raw_id, sha256({_multi_sql('metadata.abstract')}) AS digest, length({_multi_sql('metadata.abstract')}) AS n_chars FROM raw_record")
def q03_normalize_multi(spark, folder):
    """Abstracts with their lines kept."""
    c = canon.normalize_multiline(F.col("metadata.abstract"))
    return _t(spark, folder, "raw_record").select("raw_id", F.sha2(c, 256).alias("digest"), F.length(c).cast("bigint").alias("n_chars"))


_IN_SCOPE = "(NOT deleted AND coalesce(list_has_any(list_transform(metadata.categories, lambda c: coalesce(f.category_aliases[c], c)), f.categories), false))"


@_query(f"SELECT raw_id FROM raw_record, feed_scope f WHERE {_IN_SCOPE}")
def q04_scope_filter(spark, folder):
    """Records in scope, by canonical categories."""
    return _t(spark, folder, "raw_record").filter(~F.col("deleted") & _scope(spark, folder).contains(F.col("metadata.categories"))).select("raw_id")


_CLASSIFIED = f"""s AS (SELECT raw_id, oai_identifier, source_datestamp, deleted, {_IN_SCOPE} AS in_scope FROM raw_record, feed_scope f),
e AS (SELECT *, coalesce(bool_or(in_scope) OVER w, false) AS ever FROM s WINDOW w AS (PARTITION BY oai_identifier ORDER BY source_datestamp, raw_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, coalesce(bool_or(deleted AND ever) OVER w, false) AS gone FROM e WINDOW w AS (PARTITION BY oai_identifier ORDER BY source_datestamp, raw_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, CASE WHEN gone AND NOT deleted THEN 'after_delete' WHEN gone THEN 'ignored' WHEN deleted AND ever THEN 'source_delete' WHEN deleted THEN 'ignored' WHEN in_scope THEN 'upsert' WHEN ever THEN 'scope_exit' ELSE 'ignored' END AS operation FROM g)"""


@_query(f"WITH {_CLASSIFIED} SELECT raw_id, operation FROM c")
def q05_classify(spark, folder):
    """The operation of every harvested record."""
    return classify_stream(_t(spark, folder, "raw_record"), _scope(spark, folder), tie=("raw_id",)).select("raw_id", "operation")


@_query(f"""WITH {_OBS}, hd AS (SELECT * FROM live WHERE observation_id NOT IN (SELECT sup FROM live WHERE sup IS NOT NULL))
SELECT e.logical_record_key, ever AS ever_in_scope, hd.operation = 'upsert' AS active_in_scope, hd.operation = 'source_delete' AS source_deleted, hd.observation_id
FROM (SELECT logical_record_key, bool_or(operation = 'upsert') AS ever FROM live GROUP BY 1) e JOIN hd USING (logical_record_key)""")
def q07_fold_membership(spark, folder):
    """Membership of every key with its head (several where pointers are damaged)."""
    return fold(_observations(spark, folder)).select("logical_record_key", "ever_in_scope", "active_in_scope", "source_deleted", "observation_id")


@_query(f"WITH {_OBS} SELECT logical_record_key, observation_id, operation FROM live WHERE observation_id NOT IN (SELECT sup FROM live WHERE sup IS NOT NULL)")
def q08_heads(spark, folder):
    """Live observations that nothing supersedes."""
    return heads(live_observations(_observations(spark, folder))).select("logical_record_key", "observation_id", "operation")


_CHAIN = """WITH RECURSIVE e AS (SELECT user_id, event_id, ts, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE user_id IS NOT NULL {where}),
w AS (SELECT user_id, n, event_id, 'sha256:' || sha256(to_json([event_id::VARCHAR, event_type, NULL])::VARCHAR) AS chain_hash FROM e WHERE n = 1
UNION ALL SELECT e.user_id, e.n, e.event_id, 'sha256:' || sha256(to_json([e.event_id::VARCHAR, e.event_type, w.chain_hash])::VARCHAR) FROM w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1)
SELECT user_id, event_id, chain_hash FROM w"""


def _events(spark, folder):
    return _t(spark, folder, "events").filter("user_id is not null")


@_query(_CHAIN.format(where=""))
def q09_hash_chain(spark, folder):
    """Hash chain over the events of every user."""
    return chain_hashes(_events(spark, folder), "user_id", ["ts", "event_id"], [F.col("event_id"), F.col("event_type")]).select("user_id", "event_id", "chain_hash")


@_query(f"WITH {_OBS} SELECT v.operation, count(o.observation_id) AS n FROM (VALUES ('upsert'), ('scope_exit'), ('source_delete'), ('producer_retract')) v(operation) LEFT JOIN o USING (operation) GROUP BY 1")
def q10_operation_counts(spark, folder):
    """Observations of each operation, 0 where there is none."""
    return operation_counts(_observations(spark, folder))


@_query(f"""WITH {_OBS} SELECT partition_date, count(*) AS observation_count, count(*) FILTER (operation = 'upsert') AS upsert, count(*) FILTER (operation = 'scope_exit') AS scope_exit, count(*) FILTER (operation = 'source_delete') AS source_delete,
count(*) FILTER (operation = 'producer_retract') AS producer_retract, count(*) FILTER (sup IS NOT NULL) AS superseded, count(*) FILTER (sup IS NULL) AS new,
count(*) FILTER (operation <> 'producer_retract' AND observation_id NOT IN (SELECT id FROM tgt WHERE id IS NOT NULL)) AS effective_source_observation_count FROM o GROUP BY 1""")
def q11_partition_counts(spark, folder):
    """The counters of every day."""
    return partition_counts(_observations(spark, folder)).select("partition_date", "observation_count", "upsert", "scope_exit", "source_delete", "producer_retract", "superseded", "new", "effective_source_observation_count")


@_query(f"WITH {_OBS} SELECT logical_record_key, count(*) AS n_live FROM live GROUP BY 1")
def q12_live_per_key(spark, folder):
    """Observations of every key that are not retracted."""
    return live_observations(_observations(spark, folder)).groupBy("logical_record_key").agg(F.count("*").alias("n_live"))


@_query(_CHAIN.format(where="AND event_type <> 'error'"))
def q13_rechain(spark, folder):
    """The chain of every user after all errors were retracted."""
    kept = _events(spark, folder).filter(~F.coalesce(F.col("event_type") == "error", F.lit(True)))
    return chain_hashes(kept, "user_id", ["ts", "event_id"], [F.col("event_id"), F.col("event_type")]).select("user_id", "event_id", "chain_hash")


@_query(f"WITH {_OBS} SELECT min(logical_record_key) AS key FROM live WHERE sup IS NOT NULL GROUP BY sup HAVING count(*) > 1")
def q14_forks(spark, folder):
    """Keys of observations that several live ones supersede."""
    return log_violations(_observations(spark, folder)).filter("rule = 'fork'").select("key")


@_query(f"WITH {_OBS} SELECT logical_record_key AS key FROM live WHERE sup IS NOT NULL AND sup NOT IN (SELECT observation_id FROM live)")
def q15_orphans(spark, folder):
    """Keys of live observations whose predecessor is not live."""
    return log_violations(_observations(spark, folder)).filter("rule = 'orphan'").select("key")


_CLOSED = "closed AS (SELECT source_date FROM oai_page GROUP BY 1 HAVING bool_or(coalesce(resumption_token, '') = '') AND count(*) > 1), b AS (SELECT min(source_date) AS s, max(source_date) AS t FROM oai_page), cal AS (SELECT strftime(d, '%Y-%m-%d') AS source_date FROM b, LATERAL unnest(generate_series(s::DATE, t::DATE - 1, INTERVAL 1 DAY)) u(d)), missing AS (SELECT source_date FROM cal WHERE source_date NOT IN (SELECT source_date FROM closed))"


def _closed(spark, folder):
    pages = _t(spark, folder, "oai_page")
    closed = pages.groupBy("source_date").agg(F.bool_or(F.coalesce("resumption_token", F.lit("")) == "").alias("done"), F.count("*").alias("n")).filter("done and n > 1").select("source_date")
    b = pages.agg(F.min("source_date").alias("s"), F.max("source_date").alias("t")).first()
    return closed, b["s"] or "1970-01-02", b["t"] or "1970-01-01"


@_query(f"WITH {_CLOSED} SELECT CASE WHEN (SELECT count(*) FROM missing) = 0 THEN strftime(t::DATE - 1, '%Y-%m-%d') WHEN (SELECT min(source_date) FROM missing) > s THEN strftime((SELECT min(source_date) FROM missing)::DATE - 1, '%Y-%m-%d') END AS closed_complete_through, (SELECT count(*) FROM missing) AS n_gaps FROM b")
def q16_frontier(spark, folder):
    """How far the days are complete; a day with more than one page and a last one is closed here."""
    closed, start, today = _closed(spark, folder)
    return frontier(spark, closed, start, today)


@_query(f"WITH {_CLOSED} SELECT source_date FROM cal WHERE source_date >= (SELECT min(source_date) FROM missing)")
def q17_pending_gaps(spark, folder):
    """Days beyond the frontier."""
    closed, start, today = _closed(spark, folder)
    return pending_gaps(spark, closed, start, today)


@_query("""WITH k AS (SELECT DISTINCT logical_record_key AS k FROM observation WHERE logical_record_key IS NOT NULL), l AS (SELECT k, to_json({'key': k})::VARCHAR || chr(10) AS line FROM k)
SELECT substr(k, 8, 2) AS prefix, count(*) AS record_count, sum(strlen(line))::BIGINT AS uncompressed_size, 'sha256:' || sha256(string_agg(line, '' ORDER BY k)) AS uncompressed_sha256 FROM l GROUP BY 1""")
def q18_shards(spark, folder):
    """Shards of the keys by two characters, written as content-addressed objects."""
    k = _t(spark, folder, "observation").select(F.col("logical_record_key").alias("k")).filter("k is not null").distinct()
    lines = k.withColumn("line", F.concat(canon.canonical_json(F.struct(F.col("k").alias("key"))), F.lit("\n")))
    return write_shards(lines, new_path(spark, "shards"), "k", "objects").select("prefix", "record_count", "uncompressed_size", "uncompressed_sha256")


@_query("""WITH RECURSIVE d AS (SELECT coalesce(lang, '') AS lang, doc_id, strlen(text) + 1 AS size, row_number() OVER (PARTITION BY coalesce(lang, '') ORDER BY doc_id) AS n FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, n, doc_id, 0 AS ordinal, size AS total FROM d WHERE n = 1
UNION ALL SELECT d.lang, d.n, d.doc_id, CASE WHEN w.total + d.size > 20000 THEN w.ordinal + 1 ELSE w.ordinal END, CASE WHEN w.total + d.size > 20000 THEN d.size ELSE w.total + d.size END FROM w JOIN d ON d.lang = w.lang AND d.n = w.n + 1)
SELECT lang, doc_id, ordinal FROM w""")
def q19_greedy_parts(spark, folder):
    """Parts of at most 20,000 bytes of the texts of every language."""
    lines = _t(spark, folder, "documents").filter("text is not null").select(F.coalesce("lang", F.lit("")).alias("lang"), "doc_id", F.concat("text", F.lit("\n")).alias("line"))
    return greedy_parts(lines, "lang", ["doc_id"], 20_000).select("lang", "doc_id", "ordinal")


@_query("""SELECT count(*) AS n_files, 'sha256:' || sha256(to_json(list({'path': path, 'sha256': sha} ORDER BY path))::VARCHAR || chr(10)) AS digest
FROM (SELECT p_name || '/' || p_partkey AS path, sha256(p_brand || p_type) AS sha FROM part)""")
def q20_tree_digest(spark, folder):
    """Digest of a list of paths and hashes."""
    return tree_digest(_t(spark, folder, "part").select(F.concat("p_name", F.lit("/"), F.col("p_partkey").cast("string")).alias("path"), F.sha2(F.concat("p_brand", "p_type"), 256).alias("sha256")))


_LATEST = "l AS (SELECT base_arxiv_id, current_version, metadata FROM raw_record WHERE NOT deleted QUALIFY row_number() OVER (PARTITION BY base_arxiv_id ORDER BY raw_id DESC) = 1), q AS (SELECT * FROM search_record QUALIFY row_number() OVER (PARTITION BY base_arxiv_id ORDER BY search_id DESC) = 1)"


def _latest(spark, folder):
    raw = _t(spark, folder, "raw_record").filter("not deleted").groupBy("base_arxiv_id").agg(F.max_by(F.struct("current_version", "metadata"), "raw_id").alias("x")).select("base_arxiv_id", "x.*")
    found = _t(spark, folder, "search_record").groupBy("base_arxiv_id").agg(F.max_by(F.struct("abstract", "authors", "primary_category", "title", "version"), "search_id").alias("x")).select("base_arxiv_id", "x.*")
    return raw, found


@_query(f"WITH {_LATEST}, a AS (SELECT base_arxiv_id AS path, sha256(coalesce(metadata.title, '')) AS sha, strlen(coalesce(metadata.title, '')) AS size FROM l), p AS (SELECT base_arxiv_id AS path, sha256(coalesce(title, '')) AS sha FROM q) SELECT a.path, a.size FROM a LEFT JOIN p USING (path) WHERE a.sha IS DISTINCT FROM p.sha")
def q21_tree_diff(spark, folder):
    """Titles that the search service does not have in this form."""
    raw, found = _latest(spark, folder)
    title = F.coalesce("metadata.title", F.lit(""))
    current = raw.select(F.col("base_arxiv_id").alias("path"), F.sha2(title, 256).alias("sha256"), F.octet_length(title).cast("bigint").alias("size"))
    return tree_diff(current, found.select(F.col("base_arxiv_id").alias("path"), F.sha2(F.coalesce("title", F.lit("")), 256).alias("sha256"))).select("path", "size")


@_query(f"""WITH {_LATEST} SELECT l.base_arxiv_id, CASE WHEN q.version > l.current_version THEN 'target_ahead' WHEN q.version < l.current_version THEN 'target_behind'
WHEN q.title IS DISTINCT FROM l.metadata.title OR q.abstract IS DISTINCT FROM l.metadata.abstract THEN 'target_material_mismatch'
WHEN NOT coalesce(list_contains(l.metadata.categories, q.primary_category), false) THEN 'primary_category_not_in_oai_categories' END AS error_kind FROM l JOIN q USING (base_arxiv_id)""")
def q22_enrich_bind(spark, folder):
    """Why a search record cannot be bound to its latest harvested record."""
    raw, found = _latest(spark, folder)
    j = raw.select("base_arxiv_id", F.struct("base_arxiv_id", "current_version", "metadata").alias("t")).join(found.select("base_arxiv_id", F.struct("*").alias("r")), "base_arxiv_id")
    return j.select("base_arxiv_id", enrich.bind_error(F.col("t"), F.col("r")).alias("error_kind"))


@_query("""SELECT user_id, n + 1 AS attempt_count, CASE WHEN n + 1 >= 7 THEN 'deferred' ELSE 'pending' END AS status, strftime(d + (CASE WHEN n + 1 >= 7 THEN 7 ELSE 1 END)::INT, '%Y-%m-%d') AS next_attempt_date
FROM (SELECT user_id, count(*) AS n, max(ts)::DATE AS d FROM events WHERE event_type = 'error' AND user_id IS NOT NULL GROUP BY 1)""")
def q23_retry_schedule(spark, folder):
    """When a user's next attempt is due after so many errors."""
    e = _events(spark, folder).filter("event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("n"), F.max("ts").cast("date").alias("d"))
    n, status, again = enrich.after_failure(F.col("n"), F.col("d"))
    return e.select("user_id", n.cast("bigint").alias("attempt_count"), status.alias("status"), again.alias("next_attempt_date"))


@_query("""WITH t AS (SELECT base_arxiv_id, min(source_datestamp) AS a FROM raw_record WHERE base_arxiv_id IS NOT NULL GROUP BY 1), s AS (SELECT DISTINCT base_arxiv_id FROM search_record WHERE base_arxiv_id IS NOT NULL),
u AS (SELECT base_arxiv_id, 0 AS p, a, 'sha256:' || sha256('{"base_arxiv_id":"' || base_arxiv_id || '","domain":"arxiv-search-enrichment-task-v1"}' || chr(10)) AS b FROM t WHERE a <= '2025-12-31' UNION ALL SELECT base_arxiv_id, 1, '', base_arxiv_id FROM s),
f AS (SELECT base_arxiv_id, min({'p': p, 'a': a, 'b': b}) AS o FROM u GROUP BY 1 ORDER BY o LIMIT 50)
SELECT base_arxiv_id, row_number() OVER (ORDER BY o)::INT AS rank, ((row_number() OVER (ORDER BY o) - 1) // 20)::INT AS batch FROM f""")
def q24_request_list(spark, folder):
    """The next 50 requests in batches of 20: waiting tasks by age, then new ids."""
    tasks = _t(spark, folder, "raw_record").filter("base_arxiv_id is not null").groupBy("base_arxiv_id").agg(F.min("source_datestamp").alias("first_enqueued_at"))
    tasks = tasks.withColumns({"next_attempt_date": F.col("first_enqueued_at"), "task_key": ident.task_key(F.col("base_arxiv_id"))})
    return enrich.request_list(tasks, _t(spark, folder, "search_record").filter("base_arxiv_id is not null"), "2025-12-31", 50, 20)


@_query("SELECT raw_id, array_to_string(list_sort(list_distinct(list_transform(metadata.categories, lambda c: coalesce(f.category_aliases[c], c)))), ' ') AS categories FROM raw_record, feed_scope f WHERE metadata.categories IS NOT NULL")
def q25_canonical_categories(spark, folder):
    """Categories under their canonical names."""
    return _t(spark, folder, "raw_record").filter("metadata.categories is not null").select("raw_id", F.array_join(canon.canonical_categories(F.col("metadata.categories"), _scope(spark, folder).alias_map()), " ").alias("categories"))


@_query("SELECT o_orderkey, sha256(to_json({'custkey': o_custkey, 'nested': {'key': o_orderkey, 'none': NULL::VARCHAR, 'status': o_orderstatus}, 'priority': o_orderpriority})::VARCHAR) AS digest FROM orders")
def q26_canonical_json(spark, folder):
    """Hash of a nested document per order."""
    doc = F.struct(F.col("o_custkey").alias("custkey"), F.struct(F.col("o_orderkey").alias("key"), F.lit(None).cast("string").alias("none"), F.col("o_orderstatus").alias("status")).alias("nested"), F.col("o_orderpriority").alias("priority"))
    return _t(spark, folder, "orders").select("o_orderkey", F.sha2(canon.canonical_json(doc), 256).alias("digest"))


_NORMAL = "({0} IS NULL OR ({0} <> '' AND {1} = {0} AND NOT regexp_matches({0}, '[\\x00-\\x08\\x0B-\\x1F\\x7F-\\x{{9F}}]')))"
_TEXT_RULES = ", ".join(f"({_NORMAL.format('record.metadata.' + n, (_multi_sql if lines else _single_sql)('record.metadata.' + n))}, '{n}_not_normalized')" for n, lines in TEXT_FIELDS)
_ENVELOPE_RULES = ("base_id_differs", "key_differs", "date_malformed", "sets_not_sorted", "version_differs", "history_not_increasing", "history_of_terminal", "categories_not_sorted", *(f"{n}_not_normalized" for n, _ in TEXT_FIELDS), "author_not_normalized")


@_query(f"""WITH o AS (SELECT CASE WHEN deleted THEN 'source_delete' ELSE 'upsert' END AS operation, source_datestamp, 'sha256:' || sha256(to_json(['arxiv-logical-record-v1', 'oai:arXiv.org:' || base_arxiv_id])::VARCHAR) AS logical_record_key, r AS record FROM raw_record r),
x AS (SELECT *, operation = 'upsert' AS up, list_transform(record.version_history, lambda v: v.version) AS ns FROM o)
SELECT rule, count(*) AS n FROM (SELECT unnest([
  (coalesce(record.base_arxiv_id = CASE WHEN starts_with(record.oai_identifier, 'oai:arXiv.org:') THEN regexp_extract(substr(record.oai_identifier, 15), '^([0-9]{{4}}\\.[0-9]{{4,5}}|[A-Za-z][A-Za-z0-9.-]*/[0-9]{{7}})$') END, false), 'base_id_differs'),
  (logical_record_key IS NOT DISTINCT FROM 'sha256:' || sha256(to_json(['arxiv-logical-record-v1', record.oai_identifier])::VARCHAR), 'key_differs'),
  (coalesce(regexp_matches(source_datestamp, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AND try_cast(source_datestamp AS DATE) IS NOT NULL, false), 'date_malformed'),
  (record.source_sets IS NOT DISTINCT FROM list_sort(list_distinct(record.source_sets)), 'sets_not_sorted'),
  (NOT up OR record.versioned_arxiv_id IS NOT DISTINCT FROM record.base_arxiv_id || 'v' || record.current_version, 'version_differs'),
  (NOT up OR coalesce(len(ns) > 0 AND ns = list_sort(list_distinct(ns)) AND ns[-1] = record.current_version, false), 'history_not_increasing'),
  (up OR record.version_history IS NULL OR len(ns) = 0, 'history_of_terminal'),
  (NOT up OR coalesce(len(record.metadata.categories) > 0 AND record.metadata.categories = list_sort(list_distinct(record.metadata.categories)), false), 'categories_not_sorted'),
  {_TEXT_RULES},
  (record.metadata.authors IS NULL OR len(list_filter(record.metadata.authors, lambda a: NOT coalesce({_NORMAL.format("a.name", _single_sql("a.name")).replace("a.name IS NULL OR ", "", 1)}, false))) = 0, 'author_not_normalized')
]) AS r, r[1] AS ok, r[2] AS rule FROM x) WHERE NOT ok GROUP BY 1""".replace("AS r, r[1] AS ok, r[2] AS rule FROM x)", "AS r FROM x) q, LATERAL (SELECT r[1] AS ok, r[2] AS rule)"))
def q27_envelope_rules(spark, folder):
    """Rules that harvested records break if they are taken as records of observations as they are, by rule."""
    key = ident.record_key(F.concat(F.lit("oai:arXiv.org:"), "base_arxiv_id"))
    raw = _t(spark, folder, "raw_record").withColumns({"operation": F.when(F.col("deleted"), "source_delete").otherwise("upsert"), "logical_record_key": key})
    rows = raw.select(
        F.col("raw_id").cast("string").alias("observation_id"), "operation", "logical_record_key", F.col("source_datestamp").alias("partition_date"), F.lit(None).cast("string").alias("supersedes_observation_id"), F.lit("").alias("record_content_sha256"),
        F.struct(*SOURCE_RECORD_FIELDS).cast(SOURCE_RECORD).alias("record"), F.lit(None).cast(RETRACT_RECORD).alias("retract"),
    )
    return envelope_violations(rows, "s").filter(F.col("rule").isin(*_ENVELOPE_RULES)).groupBy("rule").agg(F.count("*").alias("n"))


@_query("""WITH late AS (SELECT oai_identifier, min(r.source_datestamp) AS since FROM raw_record r JOIN oai_page p USING (page_id) WHERE r.source_datestamp < p.source_date GROUP BY 1)
SELECT r.raw_id FROM raw_record r JOIN late l USING (oai_identifier) WHERE r.source_datestamp >= l.since""")
def q28_late_cascade(spark, folder):
    """Records that a late row of their key re-links: those from its day on."""
    raw = _t(spark, folder, "raw_record").select("raw_id", "page_id", "oai_identifier", "source_datestamp")
    late = raw.join(_t(spark, folder, "oai_page").select("page_id", "source_date"), "page_id").filter("source_datestamp < source_date").groupBy("oai_identifier").agg(F.min("source_datestamp").alias("since"))
    return raw.join(late, "oai_identifier").filter("source_datestamp >= since").select("raw_id")


@_query("""SELECT raw_id, regexp_extract(versioned_arxiv_id, '^([0-9]{4}\\.[0-9]{4,5}|[A-Za-z][A-Za-z0-9.-]*/[0-9]{7})(?:v([1-9][0-9]*))?$', 1) AS base_id,
nullif(regexp_extract(versioned_arxiv_id, '^([0-9]{4}\\.[0-9]{4,5}|[A-Za-z][A-Za-z0-9.-]*/[0-9]{7})(?:v([1-9][0-9]*))?$', 2), '')::INT AS version, oai_identifier = 'oai:arXiv.org:' || base_arxiv_id AS same_base FROM raw_record WHERE versioned_arxiv_id IS NOT NULL""")
def q29_id_parse(spark, folder):
    """Parts of versioned ids."""
    p = ident.parse_id(F.col("versioned_arxiv_id"))
    return _t(spark, folder, "raw_record").filter("versioned_arxiv_id is not null").select("raw_id", F.coalesce(p["base_id"], F.lit("")).alias("base_id"), p["version"].alias("version"), ident.base_id_of(F.col("oai_identifier")).eqNullSafe(F.col("base_arxiv_id")).alias("same_base"))


@_query("""SELECT doc_id, printf('U+%04X', unicode(x)) AS code_point, count(*)::INT AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x{9F}]')) AS x FROM documents) GROUP BY 1, 2""")
def q30_control_repairs(spark, folder):
    """Control characters that sanitizing replaces, by document."""
    return _t(spark, folder, "documents").select("doc_id", F.explode(canon.control_repairs(F.col("text"))).alias("r")).select("doc_id", "r.code_point", F.col("r.count").cast("int").alias("n"))


# a parser reads line ends of XML as line feeds
_ITEM = lambda c: f"CASE WHEN NOT deleted AND regexp_matches({c}, '\\S') THEN replace(replace({c}, chr(13) || chr(10), chr(10)), chr(13), chr(10)) END"
_PAGE_TEXTS = {"title": "title", "authors_raw": "authors", "comment": "comments", "journal_ref": "journal-ref", "doi": "doi", "license": "license", "abstract": "abstract"}


@_query(f"""SELECT page_id, oai_identifier, source_datestamp, deleted, {", ".join(f"{_ITEM('metadata.' + n)} AS {n}" for n in _PAGE_TEXTS)},
CASE WHEN NOT deleted THEN array_to_string(list_sort(list_distinct(metadata.categories)), ' ') END AS categories, coalesce(array_to_string(list_sort(list_distinct(list_transform(source_sets, lambda x: {_single_sql("x")}))), '|'), '') AS sets,
CASE WHEN NOT deleted THEN array_to_string(list_transform(version_history, lambda v: 'v' || v.version || '=2026-01-' || printf('%02d', v.version) || 'T10:00:00Z'), ' ') END AS versions, NOT deleted AND current_version > 1 AS revised, 't&' || page_id AS token
FROM raw_record WHERE oai_identifier IS NOT NULL AND source_datestamp IS NOT NULL AND len(version_history) IS DISTINCT FROM 0""")
def q31_xml_parse(spark, folder):
    """Harvested records written as XML pages, many to a page, and parsed again with all of their fields and the page's token."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    tag = lambda name, c: F.coalesce(F.concat(F.lit(f"<{name}>"), esc(c), F.lit(f"</{name}>")), F.lit(""))
    raw = _t(spark, folder, "raw_record").filter("oai_identifier is not null and source_datestamp is not null and not coalesce(size(version_history) = 0, false)")
    versions = F.array_join(F.transform("version_history", lambda v: F.concat(F.lit('<version version="v'), v["version"].cast("string"), F.lit('"><date>'), v["version"].cast("string"), F.lit(" Jan 2026 10:00:00 GMT</date></version>"))), "")
    inner = F.concat(F.lit("<id>x</id>"), F.coalesce(versions, F.lit("")), *[tag(x, F.col(f"metadata.{n}")) for n, x in _PAGE_TEXTS.items()], tag("categories", F.array_join("metadata.categories", " ")))
    body = F.when(F.col("deleted"), F.lit("")).otherwise(F.concat(F.lit("<metadata><arXivRaw>"), inner, F.lit("</arXivRaw></metadata>")))
    sets = F.coalesce(F.array_join(F.transform("source_sets", lambda x: tag("setSpec", x)), ""), F.lit(""))
    head = F.concat(F.when(F.col("deleted"), F.lit('<header status="deleted">')).otherwise("<header>"), tag("identifier", F.col("oai_identifier")), tag("datestamp", F.col("source_datestamp")), sets, F.lit("</header>"))
    records = raw.groupBy("page_id").agg(F.array_join(F.collect_list(F.concat(F.lit("<record>"), head, body, F.lit("</record>"))), "").alias("records"))
    token = tag("resumptionToken", F.concat(F.lit(" t&"), F.col("page_id").cast("string"), F.lit(" ")))
    page = F.concat(F.lit('<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><responseDate>2026-01-01T00:00:00Z</responseDate><ListRecords>'), "records", token, F.lit("</ListRecords></OAI-PMH>"))
    got = records_of(page_tokens(parse_pages(records.select("page_id", page.alias("payload")))))
    return got.select(
        "page_id", "oai_identifier", "source_datestamp", "deleted", *[F.col(f"metadata.{n}").alias(n) for n in _PAGE_TEXTS], F.array_join("metadata.categories", " ").alias("categories"), F.array_join("source_sets", "|").alias("sets"),
        F.array_join(F.transform("version_history", lambda v: F.concat(F.lit("v"), v["version"].cast("string"), F.lit("="), v["submitted_at"])), " ").alias("versions"), F.coalesce(F.col("current_version") > 1, F.lit(False)).alias("revised"), F.col("resumption_token").alias("token"),
    )


@_query("SELECT doc_id, sha256(text) AS digest FROM (SELECT doc_id, replace(replace(text, chr(13), ' '), chr(10), ' ') AS text FROM documents WHERE text IS NOT NULL)")
def q32_parts_roundtrip(spark, folder):
    """Texts written as content-addressed parts, verified and read again."""
    doc = F.struct("doc_id", F.translate("text", "\r\n", "  ").alias("text"))
    lines = _t(spark, folder, "documents").filter("text is not null").select(F.coalesce("lang", F.lit("")).alias("lang"), "doc_id", F.concat(canon.canonical_json(doc), F.lit("\n")).alias("line"))
    root = new_path(spark, "objects")
    parts = write_parts(lines, root, "lang", ["doc_id"], 1 << 20)
    proofs = spark.createDataFrame(parts.collect(), parts.schema)  # a row per part
    back = read_objects(proofs, root, ["lang", "ordinal"]).withColumn("line", F.when(F.col("fault").isNotNull(), F.raise_error(F.col("fault"))).otherwise(F.col("line")))
    return back.select(F.from_json("line", "doc_id bigint, text string").alias("d")).select("d.doc_id", F.sha2("d.text", 256).alias("digest"))


@_query(f"""WITH {_OBS.replace(" QUALIFY row_number() OVER (PARTITION BY observation_id ORDER BY feed_seq) = 1", "")}, src AS (SELECT * FROM o WHERE operation <> 'producer_retract'), r AS (SELECT logical_record_key AS k, retract.target_observation_id AS t, retract.replacement_observation_id AS p FROM o WHERE operation = 'producer_retract'),
lk AS (SELECT c.*, u.observation_id AS u_id, u.logical_record_key AS u_key, u.operation AS u_op FROM live c LEFT JOIN live u ON c.sup = u.observation_id WHERE c.sup IS NOT NULL)
SELECT rule, count(*) AS n FROM (
SELECT 'retract_target_absent' AS rule FROM r WHERE t NOT IN (SELECT observation_id FROM src)
UNION ALL SELECT 'retract_key_differs' FROM r JOIN src s ON r.t = s.observation_id WHERE r.k <> s.logical_record_key
UNION ALL SELECT 'replacement_absent' FROM r WHERE p IS NOT NULL AND p NOT IN (SELECT observation_id FROM src)
UNION ALL SELECT 'replacement_key_differs' FROM r JOIN src s ON r.p = s.observation_id WHERE r.k <> s.logical_record_key
UNION ALL SELECT 'second_root' FROM live GROUP BY logical_record_key HAVING count(*) FILTER (sup IS NULL) > 1
UNION ALL SELECT 'orphan' FROM lk WHERE u_id IS NULL
UNION ALL SELECT 'key_changed' FROM lk WHERE u_key <> logical_record_key
UNION ALL SELECT 'after_delete' FROM lk WHERE u_op = 'source_delete'
UNION ALL SELECT 'fork' FROM live WHERE sup IS NOT NULL GROUP BY sup HAVING count(*) > 1
UNION ALL SELECT 'duplicate_id' FROM o GROUP BY observation_id HAVING count(*) > 1) GROUP BY 1""")
def q33_log_violations(spark, folder):
    """Breaches of the rules of a log, by rule; repeated deliveries count as rows of it."""
    o = _t(spark, folder, "observation").select("observation_id", "operation", "logical_record_key", F.col("source_datestamp").alias("partition_date"), F.nullif("supersedes_observation_id", F.lit("")).alias("supersedes_observation_id"), "record_content_sha256", "retract")
    return log_violations(o).groupBy("rule").agg(F.count("*").alias("n"))


_MEMBER = """WITH e AS (SELECT user_id AS key, event_id AS seq, event_type IN ('signup', 'view', 'click', 'purchase') AS in_scope, event_type = 'error' AND json_extract(props, '$.k')::INT >= 95 AS deleted FROM events WHERE user_id IS NOT NULL),
a AS (SELECT *, coalesce(bool_or(in_scope) OVER w, false) AS ever FROM e WINDOW w AS (PARTITION BY key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT *, coalesce(bool_or(deleted AND ever) OVER w, false) AS gone FROM a WINDOW w AS (PARTITION BY key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT * FROM b WHERE NOT gone AND (in_scope OR ever))
SELECT key, bool_or(in_scope) AS ever_in_scope, arg_max(in_scope AND NOT deleted, seq) AS active_in_scope, bool_or(deleted) AS source_deleted, max(seq) AS head_seq FROM c GROUP BY 1"""


@_query(_MEMBER)
def q34_stream_state(spark, folder):
    """Membership of users as a stream: one keyed state, all input available now, each batch written once."""
    from ledgerfold.streaming.state import current_state

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source = f"{folder}/events.parquet"
    schema = spark.read.parquet(source).schema
    base = new_path(spark, "stream")
    events = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(source if spark.read.format("binaryFile").load(source).count() > 1 else f"{folder}/events*.parquet").filter("user_id is not null")
    marked = events.select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), F.col("event_type").isin("signup", "view", "click", "purchase").alias("in_scope"), ((F.col("event_type") == "error") & (F.get_json_object("props", "$.k").cast("int") >= 95)).alias("deleted"))

    def sink(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{base}/out/epoch={epoch}")

    q = current_state(marked).writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).foreachBatch(sink).start()
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    last = out.groupBy("key").agg(F.max_by(F.struct("ever_in_scope", "active_in_scope", "source_deleted", "head_seq"), "epoch").alias("s")).select("key", "s.*")
    return last.filter("ever_in_scope")


_DAILY = _CLASSIFIED.replace("SELECT raw_id, oai_identifier, source_datestamp, deleted,", "SELECT *,", 1).replace("FROM raw_record, feed_scope f)", "FROM (SELECT * FROM raw_record WHERE oai_identifier IS NOT NULL QUALIFY row_number() OVER (PARTITION BY oai_identifier, source_datestamp ORDER BY raw_id DESC) = 1), (SELECT scope_id, categories, category_aliases FROM feed_scope) f)")


def _clean_sql(c: str, lines: bool) -> str:
    bare = f"regexp_replace({c}, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x{{9F}}]', ' ', 'g')"
    return f"nullif({(_multi_sql if lines else _single_sql)(bare)}, '')"


_META = ", ".join(f"'{n}': " + (_clean_sql(f"metadata.{n}", dict(TEXT_FIELDS)[n]) if n in dict(TEXT_FIELDS) else f"metadata.{n}") for n in ("abstract", "authors", "authors_raw", "categories", "comment", "doi", "journal_ref", "license", "primary_category", "title"))
_PROJECTED = f"""{_DAILY},
k AS (SELECT *, operation = 'source_delete' AS del, 'sha256:' || sha256(to_json(['arxiv-logical-record-v1', oai_identifier])::VARCHAR) AS key FROM c WHERE operation NOT IN ('ignored', 'after_delete')),
h AS (SELECT key, oai_identifier, source_datestamp, operation, scope_id, 'sha256:' || sha256(to_json({{'base_arxiv_id': base_arxiv_id, 'current_version': CASE WHEN NOT del THEN current_version END, 'field_provenance': CASE WHEN NOT del THEN field_provenance END, 'logical_record_key': key,
  'metadata': CASE WHEN NOT del AND metadata IS NOT NULL THEN {{{_META}}} END, 'oai_identifier': oai_identifier, 'operation': operation, 'source_datestamp': source_datestamp, 'source_sets': source_sets,
  'version_history': CASE WHEN operation = 'scope_exit' THEN [] WHEN NOT del THEN version_history END, 'versioned_arxiv_id': CASE WHEN NOT del THEN versioned_arxiv_id END}})::VARCHAR) AS content FROM k),
g2 AS (SELECT *, lag(content) OVER (PARTITION BY key ORDER BY source_datestamp) IS DISTINCT FROM content AS fresh FROM h),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY source_datestamp) AS i FROM g2 WHERE fresh),
w AS (SELECT key, i, source_datestamp, operation, content, 'sha256:' || sha256(to_json(['arxiv-oai-observation-v1', scope_id, oai_identifier, source_datestamp, operation, content, NULL])::VARCHAR) AS id, NULL::VARCHAR AS sup FROM n WHERE i = 1
  UNION ALL SELECT n.key, n.i, n.source_datestamp, n.operation, n.content, 'sha256:' || sha256(to_json(['arxiv-oai-observation-v1', n.scope_id, n.oai_identifier, n.source_datestamp, n.operation, n.content, w.id])::VARCHAR), w.id FROM w JOIN n ON n.key = w.key AND n.i = w.i + 1)"""


def _projected(spark, folder):
    raw = _t(spark, folder, "raw_record").filter("oai_identifier is not null")
    cols = ("base_arxiv_id", "current_version", "deleted", "field_provenance", "metadata", "source_sets", "version_history", "versioned_arxiv_id")
    daily = raw.groupBy("oai_identifier", "source_datestamp").agg(F.max_by(F.struct(*cols), "raw_id").alias("x")).select("oai_identifier", "source_datestamp", "x.*")
    return project(daily, _scope(spark, folder), breaches="skip")


@_query(f"WITH RECURSIVE {_PROJECTED} SELECT key AS logical_record_key, source_datestamp AS partition_date, operation, content AS record_content_sha256, id AS observation_id, sup AS supersedes_observation_id FROM w")
def q06_project(spark, folder):
    """The stream projected to chained observations: changed content only, with hashes of records and ids."""
    return _projected(spark, folder).select("logical_record_key", "partition_date", "operation", "record_content_sha256", "observation_id", "supersedes_observation_id")


@_query(f"""WITH RECURSIVE {_PROJECTED}, l AS (SELECT key, bool_or(operation = 'upsert') AS ever, max_by(id, i) AS head, max_by(operation, i) AS op, max_by(content, i) AS content FROM w GROUP BY 1)
SELECT key AS logical_record_key, ever AS ever_in_scope, op = 'upsert' AS active_in_scope, op = 'source_delete' AS source_deleted, head AS observation_id, content AS record_content_sha256 FROM l""")
def q35_project_fold(spark, folder):
    """The whole stream projected to chained observations and folded to state, with the head of every key."""
    return fold(_projected(spark, folder)).drop("operation")


@_query(f"WITH {_CLASSIFIED.replace('FROM raw_record, feed_scope f', 'FROM (SELECT * REPLACE (deleted OR raw_id % 7 = 0 AS deleted) FROM raw_record) r, feed_scope f')} SELECT 'after_delete' AS rule, 'sha256:' || sha256(to_json(['arxiv-logical-record-v1', oai_identifier])::VARCHAR) AS key, source_datestamp FROM c WHERE operation = 'after_delete'")
def q39_projection_violations(spark, folder):
    """Records that come after the delete of their key; every seventh record is taken as a delete, as the tables hold no breach."""
    return projection_violations(_t(spark, folder, "raw_record").withColumn("deleted", F.col("deleted") | (F.col("raw_id") % 7 == 0)), _scope(spark, folder), tie=("raw_id",))


@_query("SELECT logical_record_key, sha256(to_json({'base_arxiv_id': record.base_arxiv_id, 'current_version': record.current_version})::VARCHAR) AS digest, source_datestamp FROM observation WHERE record IS NOT NULL AND operation = 'upsert' QUALIFY row_number() OVER (PARTITION BY logical_record_key ORDER BY source_datestamp DESC, feed_seq DESC) = 1")
def q36_latest_by_key(spark, folder):
    """The upsert of every key that came last."""
    o = _t(spark, folder, "observation").filter("record is not null and operation = 'upsert'")
    last = o.groupBy("logical_record_key").agg(F.max_by(F.struct(canon.canonical_json(F.struct("record.base_arxiv_id", "record.current_version")).alias("j"), "source_datestamp"), F.struct("source_datestamp", "feed_seq")).alias("x"))
    return last.select("logical_record_key", F.sha2("x.j", 256).alias("digest"), "x.source_datestamp")


@_query(f"WITH {_OBS} SELECT c.partition_date, c.observation_id FROM o c WHERE c.operation <> 'producer_retract' AND c.observation_id NOT IN (SELECT observation_id FROM o WHERE partition_date <= '2025-12-31')")
def q37_new_observations(spark, folder):
    """Source observations that a snapshot up to the end of 2025 did not hold."""
    o = _observations(spark, folder)
    return new_observations(o.filter("operation <> 'producer_retract'"), o.filter("partition_date <= '2025-12-31'")).select("partition_date", "observation_id")


_REPAIRED = {"title": "text", "abstract": "text", "authors_raw": "source", "comment": "text", "journal_ref": "lang", "doi": "text", "license": "lang"}
_REPAIRED_SQL = " UNION ALL ".join(f"SELECT doc_id, '{f}' AS field, {c} AS t FROM documents" for f, c in _REPAIRED.items())


@_query(f"""SELECT doc_id, field, printf('U+%04X', unicode(x)) AS code_point, count(*)::INT AS n FROM (SELECT doc_id, field, unnest(regexp_extract_all(t, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x{{9F}}]')) AS x FROM ({_REPAIRED_SQL})) GROUP BY 1, 2, 3""")
def q38_text_repairs(spark, folder):
    """Repairs of all text fields of records; here the fields hold the texts of documents, which need some."""
    meta = F.struct(*[F.col(_REPAIRED[n]).alias(n) for n, _ in TEXT_FIELDS])
    records = _t(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("oai_identifier"), F.lit("2026-01-01").alias("source_datestamp"), F.lit(False).alias("deleted"), meta.alias("metadata"))
    return text_repairs(records).select(F.col("oai_identifier").cast("bigint").alias("doc_id"), "field", "code_point", F.col("count").cast("int").alias("n"))
