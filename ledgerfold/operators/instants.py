"""Instants written in many notations, to UTC.

Method: all notations are compiled into one regular expression, an alternation with named groups.
A value is matched once: the expression rewrites it to the list of its components, which is split.
Calendar ranges are checked in integers, the day number is integer arithmetic (years that begin in
March, so a leap day comes last), and an instant is seconds since 1970.  Everything is a native expression; there is no Python in the plan.
"""

from __future__ import annotations

import re
import zoneinfo
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of months, days and zone abbreviations in English notations.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
ZONE_MINUTES = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "msk": 180, "ist": 330, "jst": 540, "kst": 540,
    "aest": 600, "aedt": 660, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
}

_WEEKDAY = r"(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*"
_MONTH = r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"
_ABBREVIATION = "|".join(sorted(ZONE_MINUTES, key=lambda z: (-len(z), z)))
_TIME = r"(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d{1,12}))?)?(?:\s*(?P<ap>[ap]\.?m\.?)(?![a-z]))?"
_ZONE = rf"(?:\s*(?:(?P<abbr>{_ABBREVIATION})?(?P<sign>[+\-−])(?P<zh>\d{{2}}):?(?P<zm>\d{{2}})?|(?P<abbr>{_ABBREVIATION})(?![a-z/])))?(?:\s*\[?(?P<zone>[a-z][a-z_]+(?:/[a-z0-9_+\-]+)+|\[(?:utc|gmt)(?=\]))\]?)?"
#: The notations; a group's name may recur, whichever alternative matches fills it.
NOTATIONS = (
    rf"(?P<y>\d{{4}})[-/.](?P<mo>\d{{1,2}})[-/.](?P<d>\d{{1,2}})(?:t|\s+){_TIME}{_ZONE}",
    rf"(?P<y>\d{{4}})(?P<mo>\d{{2}})(?P<d>\d{{2}})t(?P<h>\d{{2}})(?P<mi>\d{{2}})(?P<s>\d{{2}})?(?:[.,](?P<f>\d{{1,12}}))?{_ZONE}",
    rf"(?:{_WEEKDAY},?\s+)?(?P<d>\d{{1,2}})[\s-](?P<mon>{_MONTH})[\s-](?P<y>\d{{4}}|\d{{2}})\s+{_TIME}{_ZONE}",
    rf"(?:{_WEEKDAY}\s+)?(?P<mon>{_MONTH})\s+(?P<d>\d{{1,2}})\s+{_TIME}{_ZONE}\s+(?P<y>\d{{4}})",
    rf"(?:{_WEEKDAY},?\s+)?(?P<mon>{_MONTH})\s+(?P<d>\d{{1,2}}),?\s+(?P<y>\d{{4}}),?\s+{_TIME}{_ZONE}",
    r"(?P<ms>-?\d{13})",
    r"(?P<ep>-?\d{9,11})",
)
CANONICAL = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\z"
_SEPARATOR = "\u001f"
#: An offset that is none.
_NO_OFFSET = 1 << 40


def compile_notations(notations: tuple[str, ...] = NOTATIONS) -> tuple[str, dict[str, list[int]]]:
    """One expression for a whole value, and the numbers of the groups that bear each name."""
    whole = r"(?i)^\s*(?:" + "|".join(notations) + r")\s*$"
    numbers: dict[str, list[int]] = {}
    count = 0

    def number(m: re.Match) -> str:
        nonlocal count
        count += 1
        numbers.setdefault(m[1], []).append(count)
        return "("

    return re.sub(r"\(\?P<(\w+)>", number, whole), numbers


def known_zones() -> list[str]:
    return sorted(z for z in zoneinfo.available_timezones() if "/" in z or z in ("UTC", "GMT"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _table(entries: dict[str, object]) -> Column:
    """A map of text as one literal."""
    return F.str_to_map(F.lit(",".join(f"{k}={v}" for k, v in entries.items())), F.lit(","), F.lit("="))


def epoch_seconds(value: Column, local_zone: Column | None = None) -> Column:
    """Whole seconds since 1970 of the instant that ``value`` names, null where it names none.

    A value without a zone is local time of ``local_zone`` (UTC without it or where it is unknown).  A
    local time that occurs twice is the earlier instant; one that a clock change leaves out is moved
    on by the change.  A missing second is 0, two-digit years lie in 1970 to 2069; null, hour 24,
    second 60 and days that the calendar lacks name no instant.
    """
    pattern, numbers = compile_notations()
    names = list(numbers)
    # a value that matches begins with the separator afterwards; it is matched this one time
    rewritten = _SEPARATOR + _SEPARATOR.join("".join(f"${n}" for n in numbers[name]) for name in names)
    parts = F.split(F.regexp_replace(F.translate(value, _SEPARATOR, ""), pattern, rewritten), _SEPARATOR)
    return _let(parts, lambda p: F.when(F.size(p) == len(names) + 1, _from_parts(lambda n: F.nullif(F.lower(F.get(p, F.lit(names.index(n) + 1))), F.lit("")), local_zone)))


def _from_parts(text: Callable[[str], Column], local_zone: Column | None) -> Column:
    num = lambda n: text(n).cast("bigint")
    year = _let(text("y"), lambda y: y.cast("bigint") + F.when(F.length(y) > 2, 0).when(y < "70", 2000).otherwise(1900))
    month = F.coalesce(num("mo"), F.try_element_at(_table({m: i for i, m in enumerate(MONTHS, 1)}), F.substring(text("mon"), 1, 3)).cast("bigint"))
    clock = F.struct(num("h").alias("h"), F.substring(text("ap"), 1, 1).alias("half"))
    hour = _let(clock, lambda c: F.when(c["half"].isNull(), c["h"]).when(c["h"].between(1, 12), F.pmod(c["h"], F.lit(12)) + F.when(c["half"] == "p", 12).otherwise(0)))
    east = F.when(text("sign").isNotNull(), F.when((num("zh") <= 18) & (F.coalesce(num("zm"), F.lit(0)) <= 59), (num("zh") * 60 + F.coalesce(num("zm"), F.lit(0))) * F.when(text("sign") == "+", 60).otherwise(-60)).otherwise(_NO_OFFSET)).when(
        text("abbr").isNotNull(), F.try_element_at(_table(ZONE_MINUTES), text("abbr")).cast("bigint") * 60
    )
    civil = F.struct(year.alias("y"), month.alias("m"), num("d").alias("d"), hour.alias("h"), num("mi").alias("mi"), F.coalesce(num("s"), F.lit(0)).alias("s"), east.alias("east"), F.regexp_replace(text("zone"), r"^\[", "").alias("zone"))

    def in_days(c: Column) -> Column:
        leap = ((F.pmod(c["y"], F.lit(4)) == 0) & (F.pmod(c["y"], F.lit(100)) != 0)) | (F.pmod(c["y"], F.lit(400)) == 0)
        longest = F.when(c["m"] == 2, F.when(leap, 29).otherwise(28)).when(c["m"].isin(4, 6, 9, 11), 30).otherwise(31)
        valid = (c["y"] >= 1) & c["m"].between(1, 12) & (c["d"] >= 1) & (c["d"] <= longest) & c["h"].between(0, 23) & c["mi"].between(0, 59) & c["s"].between(0, 59) & (c["east"].isNull() | (c["east"] != _NO_OFFSET))
        of_year = F.floor((153 * (c["m"] + F.when(c["m"] > 2, -3).otherwise(9)) + 2) / 5) + c["d"] - 1
        days = _let(F.when(c["m"] <= 2, c["y"] - 1).otherwise(c["y"]), lambda y: y * 365 + F.floor(y / 4) - F.floor(y / 100) + F.floor(y / 400) - 719468)
        return F.when(valid, (days + of_year) * 86400 + c["h"] * 3600 + c["mi"] * 60 + c["s"])

    zones = _table({z.lower(): z for z in known_zones()})
    fallback = F.lit("UTC") if local_zone is None else F.coalesce(F.try_element_at(zones, F.lower(local_zone)), F.lit("UTC"))

    def instant(c: Column) -> Column:
        zone = F.when(c["zone"].isNotNull(), F.try_element_at(zones, c["zone"])).otherwise(fallback)
        placed = F.struct(in_days(c).alias("local"), zone.alias("zone"))
        elsewhere = lambda x: F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(x["local"]), x["zone"]))
        return F.when(c["east"].isNotNull(), in_days(c) - c["east"]).otherwise(_let(placed, lambda x: F.when(x["zone"] == "UTC", x["local"]).when(x["zone"].isNotNull(), elsewhere(x))))

    return F.when(text("ms").isNotNull(), F.floor(num("ms") / 1000)).when(text("ep").isNotNull(), num("ep")).otherwise(_let(civil, instant))


def format_utc(seconds: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ``, whatever the session's time zone."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")

    def render(s: Column) -> Column:
        of_day = F.pmod(s, F.lit(86400))
        day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(s / 86400).cast("int"))
        return F.concat(day.cast("string"), F.lit("T"), two(F.floor(of_day / 3600)), F.lit(":"), two(F.floor(F.pmod(of_day, F.lit(3600)) / 60)), F.lit(":"), two(F.pmod(of_day, F.lit(60))), F.lit("Z"))

    return _let(seconds, render)


def normalise_instants(df: DataFrame, value: str, out: str = "utc", local_zone: str | None = None) -> DataFrame:
    """``df`` with ``out``: the instant that ``value`` names, in UTC, null where it names none (see :func:`epoch_seconds`)."""
    return df.withColumn(out, format_utc(epoch_seconds(F.col(value).cast("string"), F.col(local_zone) if local_zone else None)))
