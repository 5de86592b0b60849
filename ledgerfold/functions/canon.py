"""Canonical text, JSON and hashes as column expressions.

Everything stays in the JVM but the NFC of text that is not ASCII: that goes through an Arrow UDF,
and only where a filter says so (``nfc``).
"""

from __future__ import annotations

import gzip
import io
import json
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

SAFE_INTEGER = (1 << 53) - 1
HASH = "^sha256:[0-9a-f]{64}$"
ASCII = r"^[\x00-\x7F]*$"
#: Control characters that canonical text may not hold: all but TAB and LF.
CONTROLS = r"[\x00-\x08\x0B-\x1F\x7F-\x{9F}]"
#: Those of source text that are replaced by a blank: CR is a line ending there.
SOURCE_CONTROLS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}]"
#: What a full strip removes of normalized text.
_STRIP = r"[ \n\x{2028}\x{2029}\x{85}\x{1C}-\x{1F}]+"


@arrow_udf(T.StringType())
def _nfc(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())


def nfc(c: Column) -> Column:
    """NFC; ASCII text takes a path that holds no UDF value, so Python sees nulls for it."""
    return F.when(c.rlike(ASCII), c).otherwise(_nfc(F.when(~c.rlike(ASCII), c)))


def line_endings(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def collapse_blanks(c: Column) -> Column:
    """Runs of TAB and space separators as one space; line feeds end a run."""
    return F.regexp_replace(c, r"[\t\p{Zs}]+", " ")


def strip(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "^" + _STRIP, ""), _STRIP + "$", "")


def normalize_single_line(c: Column) -> Column:
    """One logical line: NFC, line feeds as blanks, blanks collapsed, stripped. Null stays null."""
    return strip(collapse_blanks(F.translate(nfc(line_endings(c)), "\n", " ")))


def normalize_multiline(c: Column) -> Column:
    """NFC, blanks collapsed, lines without blanks at their ends, stripped. Null stays null."""
    return strip(F.regexp_replace(collapse_blanks(nfc(line_endings(c))), r"(?m) +$", ""))


def has_control(c: Column) -> Column:
    """Whether text holds a control character that canonical text may not."""
    return c.rlike(CONTROLS)


def sanitize_controls(c: Column) -> Column:
    return F.regexp_replace(c, SOURCE_CONTROLS, " ")


def control_repairs(c: Column) -> Column:
    """``array<struct<code_point, count>>`` of the control characters that sanitizing replaces, in order."""
    found = F.regexp_extract_all(c, F.lit(f"({SOURCE_CONTROLS})"), F.lit(1))
    points = F.array_sort(F.array_distinct(F.transform(found, lambda x: F.format_string("U+%04X", F.ascii(x)))))
    return F.transform(points, lambda p: F.struct(p.alias("code_point"), F.size(F.filter(found, lambda x: F.format_string("U+%04X", F.ascii(x)) == p)).alias("count")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_categories(c: Column) -> Column:
    """Distinct and sorted; an empty category makes the whole null."""
    values = F.transform(c, lambda x: strip(collapse_blanks(F.translate(line_endings(x), "\n", " "))))
    return F.when(~F.array_contains(values, ""), F.array_sort(F.array_distinct(values)))


def canonical_categories(c: Column, aliases: Column) -> Column:
    """Categories under their canonical names, distinct and sorted."""
    return F.array_sort(F.array_distinct(F.transform(c, lambda x: F.coalesce(F.try_element_at(aliases, x), x))))


def canonical_json(c: Column) -> Column:
    """Sorted keys (as declared), no blanks, nulls kept, text as it is."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def sha256(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def content_hash(c: Column) -> Column:
    return sha256(canonical_json(c))


def file_hash(c: Column) -> Column:
    """Hash of a document as a file: canonical JSON and a line feed."""
    return sha256(F.concat(canonical_json(c), F.lit("\n")))


def domain_hash(*parts: Column) -> Column:
    """Hash of a JSON array of strings; a null part stays null in it."""
    return sha256(F.to_json(F.array(*[p.cast("string") for p in parts])))


def is_hash(c: Column) -> Column:
    return c.rlike(HASH)


def object_path(digest: Column, prefix: str = "objects") -> Column:
    hexes = F.substring(digest, 8, 64)
    return F.concat(F.lit(f"{prefix}/sha256/"), F.substring(hexes, 1, 2), F.lit("/"), hexes, F.lit(".jsonl.gz"))


def manifest_path(scope_id: Column, source_date: Column, digest: Column) -> Column:
    return F.concat(F.lit("scopes/"), scope_id, F.lit("/partitions/"), F.translate(F.substring(source_date, 1, 7), "-", "/"), F.lit("/"), source_date, F.lit("/manifests/"), F.substring(digest, 8, 64), F.lit(".json"))


def is_safe_path(c: Column) -> Column:
    """A relative path in plain form: no empty, ``.`` or ``..`` part, no backslash."""
    return c.rlike(r"^(?!/)(?!.*\\)(?:(?!\.{1,2}(?:/|$))[^/]+)(?:/(?!\.{1,2}(?:/|$))[^/]+)*$")


# the same for documents on the driver


def json_bytes(value: object) -> bytes:
    """Canonical JSON of a document: keys by UTF-16 units, no floats, integers that are safe."""

    def check(v: object) -> object:
        if v is None or isinstance(v, (bool, str)):
            return v
        if isinstance(v, int):
            if abs(v) > SAFE_INTEGER:
                raise ValueError("integer is not safe")
            return v
        if isinstance(v, (list, tuple)):
            return [check(x) for x in v]
        if isinstance(v, dict):
            return {k: check(v[k]) for k in sorted(v, key=lambda k: k.encode("utf-16-be"))}
        raise ValueError(f"{type(v).__name__} has no canonical form")

    return json.dumps(check(value), ensure_ascii=False, allow_nan=False, separators=(",", ":")).encode()


def file_bytes(value: object) -> bytes:
    return json_bytes(value) + b"\n"


def bytes_hash(data: bytes) -> str:
    import hashlib

    return "sha256:" + hashlib.sha256(data).hexdigest()


def gzip_bytes(data: bytes) -> bytes:
    """Gzip that only depends on the data: level 9, no name, no time."""
    out = io.BytesIO()
    with gzip.GzipFile(filename="", mode="wb", compresslevel=9, fileobj=out, mtime=0) as f:
        f.write(data)
    return out.getvalue()
