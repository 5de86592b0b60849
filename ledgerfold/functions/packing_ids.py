"""Compact binary form of ``sha256:`` identifiers.

Hex digests hardly compress; 33 bytes instead of 71 halve every shuffle that is keyed by one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGEST = "^sha256:[0-9a-f]{64}$"


def pack_id(c: Column) -> Column:
    """Exact: digests become a 1 byte and their 32 bytes, other strings a 0 byte and their UTF-8."""
    return F.when(c.rlike(_DIGEST), F.concat(F.lit(b"\x01"), F.unhex(F.substring(c, 8, 64)))).otherwise(
        F.concat(F.lit(b"\x00"), F.encode(c, "UTF-8"))
    )


def unpack_id(c: Column) -> Column:
    body = F.substring(c, 2, 2147483647)
    return F.when(F.substring(c, 1, 1) == F.lit(b"\x01"), F.concat(F.lit("sha256:"), F.lower(F.hex(body)))).otherwise(
        F.decode(body, "UTF-8")
    )
