"""Pages of the upstream change stream and answers of the search service.

Pages are rows of ``page_no, payload``; XML is parsed by Spark's own parser with a fixed schema.  A page
that breaks a rule is reported by :func:`page_violations` and never dropped in silence.
"""

from __future__ import annotations

import html
import random
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition

from ledgerfold.functions import canon, ident
from ledgerfold.plans.planner import retry_delay
from ledgerfold.schemas import METADATA, PROVENANCE

#: Largest page, in bytes.
MAX_PAGE = 25 * 1024 * 1024
#: Seconds between requests, of one request, and tries.
MIN_INTERVAL, TIMEOUT, ATTEMPTS = 3.0, 45.0, 4
#: Answers after which a request is tried again.
RETRY_STATUS = (429, 500, 502, 503, 504)

_RAW = (
    "id string, version array<struct<_version:string,date:string>>, title string, authors string, categories string, comments string, `journal-ref` string, doi string, license string, abstract string"
)
_RECORD = f"header struct<_status:string,identifier:string,datestamp:string,setSpec:array<string>>, metadata struct<arXivRaw:struct<{','.join(f'{c}' for c in ('id:string', 'version:array<struct<_version:string,date:string>>', 'title:string', 'authors:string', 'categories:string', 'comments:string', '`journal-ref`:string', 'doi:string', 'license:string', 'abstract:string'))}>>"
_PAGE = f"responseDate string, error array<struct<_code:string,_VALUE:string>>, ListRecords struct<record:array<struct<{_RECORD.replace('header struct', 'header:struct').replace('metadata struct', 'metadata:struct')}>>,resumptionToken:struct<_VALUE:string,_cursor:string,_completeListSize:string>>"
_ENTRY = "id string, title string, summary string, author array<struct<name:string>>, primary_category array<struct<_term:string>>"
_FEED = f"entry array<struct<{_ENTRY.replace(' string', ':string').replace(' array', ':array')}>>"
_XML = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE", "attributePrefix": "_"}


def _text(c: Column) -> Column:
    """Text as it is; null where it is blank."""
    return F.when(c.rlike(r"\S"), c)


def parse_pages(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """``pages`` with ``page``: the parsed page; its inside is null where the XML has no such part."""
    return pages.withColumn("page", F.from_xml(F.col(payload).cast("string"), _PAGE, {**_XML, "rowTag": "OAI-PMH"}))


def page_violations(pages: DataFrame, payload: str = "payload", key: str = "page_no") -> DataFrame:
    """``rule, key`` of pages that must not be used."""
    text = F.col(payload).cast("string")
    parsed = parse_pages(pages, payload)
    head = F.upper(F.substring(text, 1, 4096))
    errors = F.coalesce(F.col("page.error"), F.array())
    none = (F.size(errors) == 1) & F.exists(errors, lambda e: e["_code"] == "noRecordsMatch")
    rules = {
        "too_large": F.length(F.col(payload)) <= MAX_PAGE,
        "declaration": ~(head.contains("<!DOCTYPE") | head.contains("<!ENTITY")),
        "wrong_root": text.rlike(r"(?s)^\s*(?:<\?xml[^>]*\?>)?\s*(?:<!--.*?-->\s*)*<(?:\w+:)?OAI-PMH[\s>]"),
        "no_response_date": F.col("page.responseDate").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"),
        "error_answer": (F.size(errors) == 0) | none,
        "no_records_element": none | F.col("page.ListRecords").isNotNull(),
    }
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()]))
    return parsed.select(F.explode(broken).alias("rule"), F.col(key).cast("string").alias("key"))


def page_tokens(parsed: DataFrame) -> DataFrame:
    """``parsed`` with ``resumption_token``: stripped, null where empty."""
    return parsed.withColumn("resumption_token", F.nullif(canon.strip(F.col("page.ListRecords.resumptionToken._VALUE")), F.lit("")))


def records_of(parsed: DataFrame) -> DataFrame:
    """One row per record of the pages, text left as it came; the page's columns stay."""
    kept = [c for c in parsed.columns if c != "page"]
    one = parsed.select(*kept, F.posexplode("page.ListRecords.record").alias("record_no", "r"))
    h, raw = F.col("r.header"), F.col("r.metadata.arXivRaw")
    base = ident.base_id_of(h["identifier"])
    deleted = F.coalesce(h["_status"] == "deleted", F.lit(False))
    number = lambda v: F.nullif(F.regexp_extract(v["_version"], r"^v(\d+)$", 1), F.lit("")).cast("int")
    staged = one.withColumns({
        "oai_identifier": h["identifier"], "source_datestamp": h["datestamp"], "source_sets": F.coalesce(canon.normalize_categories(h["setSpec"]), F.array().cast("array<string>")), "deleted": deleted, "base_arxiv_id": base,
        "raw_versions": F.transform(raw["version"], lambda v: F.struct(number(v).alias("version"), v["date"].alias("date"))), "raw": raw, "has_metadata": F.col("r.metadata").isNotNull(),
    }).drop("r")
    current = F.try_element_at(F.transform(F.col("raw_versions"), lambda v: v["version"]), F.lit(-1))
    metadata = F.struct(
        _text(F.col("raw.abstract")).alias("abstract"), F.lit(None).alias("authors"), _text(F.col("raw.authors")).alias("authors_raw"), canon.normalize_categories(F.split(canon.strip(F.col("raw.categories")), r"\s+")).alias("categories"),
        _text(F.col("raw.comments")).alias("comment"), _text(F.col("raw.doi")).alias("doi"), _text(F.col("raw.journal-ref")).alias("journal_ref"), _text(F.col("raw.license")).alias("license"), F.lit(None).alias("primary_category"), _text(F.col("raw.title")).alias("title"),
    ).cast(METADATA)
    provenance = F.struct(*[F.lit("oai_arxiv_raw").alias(c) for c in ("authors", "authors_raw", "primary_category", "version_history")]).cast(PROVENANCE)
    live = ~F.col("deleted")
    return staged.withColumns({
        "current_version": F.when(live, current), "metadata": F.when(live, metadata), "field_provenance": F.when(live, provenance), "versioned_arxiv_id": F.when(live, ident.versioned_id(F.col("base_arxiv_id"), current)),
        "version_history": F.when(live, F.transform("raw_versions", lambda v: F.struct(source_timestamp(v["date"]).alias("submitted_at"), v["version"].alias("version")))),
    })


def source_timestamp(c: Column) -> Column:
    """A mail-style date (weekday optional, names or offsets as zone) as UTC seconds; null where it is none."""
    bare = F.regexp_replace(canon.strip(c), r"^[A-Za-z]{3},\s*", "")
    zoned = F.coalesce(F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z")), F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss xx")), F.try_to_timestamp(F.concat(bare, F.lit(" GMT")), F.lit("d MMM yyyy HH:mm:ss z")))
    seconds = F.unix_seconds(zoned)
    from ledgerfold.operators.instants import format_utc

    return format_utc(seconds)


def record_violations(records: DataFrame) -> DataFrame:
    """``rule, key`` of records that break the form of the stream."""
    v = F.transform(F.col("raw_versions"), lambda x: x["version"])
    raw_id = ident.parse_id(canon.normalize_single_line(F.col("raw.id")))
    live = ~F.col("deleted")
    rules = {
        "identifier_malformed": F.col("base_arxiv_id").isNotNull(), "datestamp_malformed": F.try_to_date("source_datestamp", "yyyy-MM-dd").isNotNull() & F.col("source_datestamp").rlike(r"^\d{4}-\d{2}-\d{2}$"),
        "deleted_with_metadata": live | ~F.col("has_metadata"), "metadata_missing": F.col("deleted") | F.col("raw").isNotNull(),
        "raw_id_differs": F.col("deleted") | (raw_id["base_id"].eqNullSafe(F.col("base_arxiv_id")) & raw_id["version"].isNull()),
        "versions_not_increasing": F.col("deleted") | ((F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | (x < 1)) & F.array_sort(F.array_distinct(v)).eqNullSafe(v)),
        "version_date_malformed": F.col("deleted") | ~F.exists("version_history", lambda x: x["submitted_at"].isNull()), "categories_missing": F.col("deleted") | (F.size("metadata.categories") > 0),
    }
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()]))
    return records.select(F.explode(broken).alias("rule"), F.col("oai_identifier").alias("key"))


def harvest_summary(parsed: DataFrame, date: str = "source_date", page: str = "page_no") -> DataFrame:
    """Per day: pages, first and last answer, and whether its last page has no token."""
    p = page_tokens(parsed)
    return p.groupBy(date).agg(
        F.min_by("page.responseDate", page).alias("first_response_date"), F.max_by("page.responseDate", page).alias("last_response_date"), F.count("*").alias("page_count"),
        F.max_by(F.col("resumption_token").isNull(), page).alias("token_exhausted"),
    )


def harvest_violations(parsed: DataFrame, records: DataFrame, date: str = "source_date", page: str = "page_no") -> DataFrame:
    """``rule, key``: days that are not complete, tokens that recur, records that repeat or lie in another day."""
    p = page_tokens(parsed)
    rule = lambda df, name, key: df.select(F.lit(name).alias("rule"), F.col(key).alias("key"))
    return (
        rule(harvest_summary(parsed, date, page).filter("not token_exhausted"), "not_exhausted", date)
        .unionByName(rule(p.filter("resumption_token is not null").groupBy(date, "resumption_token").count().filter("count > 1"), "token_recurs", date))
        .unionByName(rule(records.groupBy(date, "oai_identifier").count().filter("count > 1"), "identifier_repeats", "oai_identifier"))
        .unionByName(rule(records.filter(F.col("source_datestamp") != F.col(date)), "other_day", "oai_identifier"))
    )


def parse_search(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Entries of search answers with id, version, text, authors and primary category; malformed ones have nulls."""
    feed = pages.select(F.from_xml(F.col(payload).cast("string"), _FEED, {**_XML, "rowTag": "feed"}).alias("f")).select(F.explode("f.entry").alias("e"))
    parsed = ident.id_from_url(canon.strip(F.col("e.id")))
    return feed.select(
        canon.normalize_multiline(F.col("e.summary")).alias("abstract"), F.transform("e.author", lambda a: F.struct(canon.strip(canon.collapse_blanks(F.translate(a["name"], "\n", " "))).alias("name"))).alias("authors"),
        parsed["base_id"].alias("base_arxiv_id"), canon.normalize_single_line(F.col("e.primary_category")[0]["_term"]).alias("primary_category"), canon.normalize_single_line(F.col("e.title")).alias("title"), parsed["version"].alias("version"),
    )


# the network


class Transport:
    """Requests in series: an interval between them, tries after failures with jitter, the server's wait if it names one.

    Requests over the network carry ``agent``, which must name a contact: a mail address or a URL as ``+http...``.
    """

    def __init__(self, opener: Callable[[str, float], tuple[int, dict, bytes]] | None = None, attempts: int = ATTEMPTS, interval: float = MIN_INTERVAL, timeout: float = TIMEOUT, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic, agent: str = "", jitter: Callable[[], float] = random.random):
        if opener is None and not has_contact(agent):
            raise ValueError("the user agent must name a contact")
        self.opener, self.attempts, self.interval, self.timeout, self.sleep, self.clock, self.jitter = opener or opener_as(agent), attempts, interval, timeout, sleep, clock, jitter
        self.last: float | None = None

    def get(self, url: str) -> bytes:
        for attempt in range(1, self.attempts + 1):
            if self.last is not None and (wait := self.interval - (self.clock() - self.last)) > 0:
                self.sleep(wait)
            self.last = self.clock()
            try:
                status, headers, body = self.opener(url, self.timeout)
            except (urllib.error.URLError, TimeoutError):
                status, headers, body = 503, {}, b""
            if status == 200:
                if len(body) > MAX_PAGE:
                    raise ValueError("answer is too large")
                return body
            if status not in RETRY_STATUS or attempt == self.attempts:
                raise OSError(f"request failed with {status}")
            self.sleep(retry_delay(attempt, headers.get("Retry-After"), self.jitter()))
        raise AssertionError


def has_contact(agent: str) -> bool:
    return "@" in agent or "+http" in agent


def opener_as(agent: str) -> Callable[[str, float], tuple[int, dict, bytes]]:
    """Requests under a user agent."""

    def run(url: str, timeout: float) -> tuple[int, dict, bytes]:
        request = urllib.request.Request(url, headers={"User-Agent": agent, "Accept": "application/xml, application/atom+xml"})
        try:
            with urllib.request.urlopen(request, timeout=timeout) as r:
                return r.status, dict(r.headers), r.read(MAX_PAGE + 1)
        except urllib.error.HTTPError as e:
            return e.code, dict(e.headers), b""

    return run


def harvest_day(transport: Transport, endpoint: str, day: str, prefix: str = "arXivRaw") -> Iterator[bytes]:
    """Pages of a day: the window in the first request, only the token in later ones."""
    import re

    seen: set[str] = set()
    query = {"verb": "ListRecords", "metadataPrefix": prefix, "from": day, "until": day}
    while True:
        body = transport.get(f"{endpoint}?{urllib.parse.urlencode(query)}")
        yield body
        found = re.search(rb"<(?:\w+:)?resumptionToken[^>]*>([^<]*)<", body)
        token = html.unescape(found[1].decode()).strip() if found else ""
        if not token:
            return
        if token in seen:
            raise ValueError("resumption token recurs")
        seen.add(token)
        query = {"verb": "ListRecords", "resumptionToken": token}


def fetch_search(transport: Transport, endpoint: str, ids: list[str], batch_size: int = 20) -> Iterator[tuple[list[str], bytes | None]]:
    """Answers of the search service for sorted, distinct ids in batches; None where a batch failed."""
    wanted = sorted(set(ids))
    for i in range(0, len(wanted), batch_size):
        batch = wanted[i : i + batch_size]
        query = urllib.parse.urlencode({"id_list": ",".join(batch), "start": 0, "max_results": len(batch)})
        try:
            yield batch, transport.get(f"{endpoint}?{query}")
        except (OSError, ValueError):
            yield batch, None


class _Day(InputPartition):
    def __init__(self, days: list[str]):
        super().__init__(days)
        self.days = days


class ChangeStreamReader(DataSourceReader):
    """One partition per endpoint, so requests to it stay in series; filters on the day are pushed down."""

    def __init__(self, options: dict):
        self.endpoint, self.days = options["endpoint"], [d for d in options.get("dates", "").split(",") if d]
        self.interval, self.attempts, self.prefix = float(options.get("interval", MIN_INTERVAL)), int(options.get("attempts", ATTEMPTS)), options.get("metadataPrefix", "arXivRaw")
        self.agent = options.get("useragent", options.get("userAgent", ""))

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("source_date",):
                self.days = [d for d in self.days if d == f.value]
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [_Day(self.days)]

    def read(self, partition: _Day) -> Iterator[tuple]:
        transport = Transport(attempts=self.attempts, interval=self.interval, agent=self.agent)
        for day in partition.days:
            for n, body in enumerate(harvest_day(transport, self.endpoint, day, self.prefix), 1):
                yield day, n, body


class ChangeStream(DataSource):
    """``spark.read.format("ledgerfold_pages").option("endpoint", ...).option("dates", "2026-01-01,...").option("userAgent", "name (+https://...)")``."""

    @classmethod
    def name(cls) -> str:
        return "ledgerfold_pages"

    def schema(self) -> str:
        return "source_date string, page_no int, payload binary"

    def reader(self, schema) -> ChangeStreamReader:  # noqa: ARG002
        return ChangeStreamReader(dict(self.options))


def read_saved_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages saved as ``<folder>/<date>/<number>.xml``: ``source_date, page_no, payload``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.regexp_extract("path", r"/(\d{4}-\d{2}-\d{2})/\d+\.xml$", 1).alias("source_date"), F.nullif(F.regexp_extract("path", r"/(\d+)\.xml$", 1), F.lit("")).cast("int").alias("page_no"), F.col("content").alias("payload"))


