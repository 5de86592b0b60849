"""A small harvest for tests of projection, fold and snapshot."""

from ledgerfold.schemas import RAW_RECORD

SCOPE = {
    "contract_version": "1.0", "scope_schema_version": "1.0", "feed_id": "sample-facts-v1", "scope_id": "sample-v1", "categories": ["cs.AI", "cs.RO", "eess.SY"], "category_aliases": {"cs.SY": "eess.SY"},
    "include_crosslists": True, "keywords": [], "normalizer_version": "feed-normalizer-v1",
}
PROVENANCE = {"authors": "oai_arxiv_raw", "authors_raw": "oai_arxiv_raw", "primary_category": "oai_arxiv_raw", "version_history": "oai_arxiv_raw"}


def raw(number, day, categories=("cs.RO",), deleted=False, title="A title", abstract="Some text.", versions=1):
    base = f"2607.{number:05d}"
    if deleted:
        return (base, None, True, None, None, f"oai:arXiv.org:{base}", day, ["cs:cs:RO"], None, None)
    meta = {"abstract": abstract, "authors": None, "authors_raw": "Alice Example", "categories": sorted(categories), "comment": None, "doi": None, "journal_ref": None, "license": None, "primary_category": None, "title": title}
    history = [{"submitted_at": f"2026-07-0{v}T00:00:00Z", "version": v} for v in range(1, versions + 1)]
    return (base, versions, False, PROVENANCE, meta, f"oai:arXiv.org:{base}", day, ["cs:cs:RO"], history, f"{base}v{versions}")


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW_RECORD)


def query(day):
    return {
        "from": day, "until": day, "metadata_prefix": "arXivRaw", "set": None, "first_response_date": f"{day}T05:00:00Z", "last_response_date": f"{day}T05:00:00Z", "page_count": 1, "token_exhausted": True,
        "source_schema_url": "https://example.org/schema.xsd", "source_schema_sha256": "sha256:" + "0" * 64, "observed_complete_at": f"{day}T05:00:00Z",
    }
