"""Several values packed in one string: one row per value, with its position.

Method: the byte buffer of an Arrow column is scanned as a whole.  The parity of quotes and the depth
of brackets come from running sums, delimiters are masks of bytes outside both, pieces between
delimiters are found by comparing neighbours, and their offsets make a list array which is flattened
with the ordinals of its parents.  No step loops over rows or characters.

Two dialects:

``names``: lists of people and organisations.  ``; | & /`` (with a blank at its side), line breaks,
the word "and" and a blank between quoted values separate.  A comma separates too, unless a family
name of one word stands before it (family name first) or "Jr.", "III" and the like after it.  Text in
round brackets is an affiliation and no part of a value.

``tokens``: identifiers such as set names.  ``; , | /`` and white space separate; a blank is part of a
value only in quotes or before a word without a colon.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Additions to a name which a comma does not separate from it.
SUFFIXES = ("Jr", "Jr.", "Sr", "Sr.", "II", "III", "IV")

_SPACE, _COMMA, _QUOTE, _OPEN, _CLOSE, _SLASH, _DOT = (ord(c) for c in ' ,"()/.')


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars]] = True
    return t


_WS = _table(" \t\n\r\x0b\x0c")
_BREAK = _table("\n\r")
_STRONG = {"names": _table(";|&"), "tokens": _table(";|,")}
_LETTER = _table("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | (np.arange(256) >= 128)


def _shift(a: np.ndarray, by: int, fill: int | bool = 0) -> np.ndarray:
    """The neighbour ``by`` places on (negative: before)."""
    out = np.full_like(a, fill)
    if by > 0:
        out[:-by] = a[by:]
    else:
        out[-by:] = a[:by]
    return out


def _within(values: np.ndarray, starts: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Running sum that begins anew in each row."""
    total = np.cumsum(values, dtype=np.int32)
    before = np.concatenate([[0], total])[starts]
    return total - before[row].astype(np.int32)


def _last_seen(mask: np.ndarray) -> np.ndarray:
    """For each place the last place at or before it where ``mask`` holds, else -1."""
    at = np.where(mask, np.arange(len(mask)), -1)
    return np.maximum.accumulate(at)


def split_values(column: pa.StringArray, dialect: str) -> pa.ListArray:
    """The values in each string; null for null, an empty list where there is none."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    column = pc.fill_null(column, "") if (nulls := column.is_null()).true_count else column
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, 8 * column.offset) if n else np.zeros(1, np.int64)
    d = np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0]) if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    starts = offsets[:-1] - offsets[0]
    row = np.repeat(np.arange(n), np.diff(offsets))
    if not len(d):
        return pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array([], pa.string()), mask=nulls)

    ws = _WS[d]
    quote = d == _QUOTE
    quote &= (np.bincount(row, weights=quote, minlength=n).astype(int) % 2 == 0)[row]  # an odd one quotes nothing
    inside = _within(quote, starts, row) % 2 == 1
    plain = ~inside & ~quote
    first = np.zeros(len(d), bool)
    first[starts[np.diff(offsets) > 0]] = True
    last = _shift(first, 1, True)
    before, after = np.where(first, _SPACE, _shift(d, -1)), np.where(last, _SPACE, _shift(d, 1))
    closing = quote & ~inside
    dropped = np.zeros(len(d), bool)
    if dialect == "names":
        step = ((d == _OPEN) & plain).astype(np.int32) - ((d == _CLOSE) & plain)
        depth = _within(step, starts, row)
        bad = np.zeros(n, bool)
        bad[row[depth < 0]] = True
        bad[row[last & (depth != 0)]] = True  # brackets that do not match are text
        dropped = ((depth > 0) | ((d == _CLOSE) & plain)) & ~bad[row]
        plain &= ~dropped
    strong = plain & _STRONG[dialect][d]
    strong |= plain & (d == _SLASH) & (_WS[before] | _WS[after])
    comma = plain & (d == _COMMA)
    if dialect == "names":
        # a line break separates unless it only follows a comma
        solid = _last_seen(~ws | first)
        strong |= plain & _BREAK[d] & ~(comma[solid] & (solid >= 0))
        strong |= plain & ws & _shift(closing, -1, False) & ~first
        low = d | 0x20
        word = plain & (low == ord("a")) & (_shift(low, 1) == ord("n")) & (_shift(low, 2) == ord("d")) & _WS[_shift(d, 3, _SPACE)] & (row == _shift(row, 3, -1)) & (_WS[before] | _shift(comma, -1, False)) & ~first
        strong |= word | _shift(word, -1, False) | _shift(word, -2, False)
        comma &= ~strong
        soft = comma
    else:
        soft = plain & ws & ~strong
    delim = strong | soft

    # pieces: runs of bytes between delimiters that have content
    content = ~ws & ~dropped & ~delim
    c_at = np.flatnonzero(content)
    if not len(c_at):
        return pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array([], pa.string()), mask=nulls)
    n_delim = np.cumsum(delim)
    fresh = np.ones(len(c_at), bool)
    fresh[1:] = (n_delim[c_at[1:]] != n_delim[c_at[:-1]]) | (row[c_at[1:]] != row[c_at[:-1]])
    p_first = c_at[fresh]
    p_last = np.append(c_at[np.flatnonzero(fresh)[1:] - 1], c_at[-1])
    p_row, p_quoted = row[p_first], quote[p_first]
    m = len(p_first)

    # which pieces continue the one before
    n_strong, n_soft = np.cumsum(strong), np.cumsum(soft)
    same = np.zeros(m, bool)
    same[1:] = (p_row[1:] == p_row[:-1]) & (n_strong[p_first[1:]] == n_strong[p_last[:-1]])
    joins = np.zeros(m, bool)
    suffix = np.zeros(m, bool)
    if dialect == "names":
        one = np.zeros(m, bool)
        one[1:] = n_soft[p_first[1:]] - n_soft[p_last[:-1]] == 1
        short = np.flatnonzero(p_last - p_first < 3)
        words = [d[a : b + 1].tobytes().decode("utf-8", "replace") for a, b in zip(p_first[short], p_last[short], strict=True)]
        suffix[short] = np.isin(words, SUFFIXES) if words else False
        gap = (ws | dropped | delim)[np.maximum(c_at - 1, 0)] | ((d[np.maximum(c_at - 1, 0)] == _DOT) & _LETTER[d[c_at]])
        begins = gap & ~fresh
        tokens = 1 + np.add.reduceat(begins.astype(np.int32), np.flatnonzero(fresh))
        family = (tokens == 1) & ~suffix & ~p_quoted
        may = same & one & ~suffix & ~p_quoted
        may[1:] &= family[:-1]
        may[0] = False
        run = _last_seen(~may)  # in a run of single words every second one continues the one before
        joins = (may & ((np.arange(m) - run) % 2 == 1)) | (same & one & suffix)
    else:
        colon = np.add.reduceat((d[c_at] == ord(":")).astype(np.int32), np.flatnonzero(fresh)) > 0
        joins = same & ~colon & ~p_quoted
        joins[1:] &= ~p_quoted[:-1]

    # bytes of the values: pieces, and what stands between joined ones
    head = np.flatnonzero(~joins)
    i_first, i_last = p_first[head], np.append(p_last[head[1:] - 1], p_last[-1])
    edge = np.zeros(len(d) + 1, np.int32)
    np.add.at(edge, i_first, 1)
    np.add.at(edge, i_last + 1, -1)
    member = (np.cumsum(edge[:-1]) > 0) & ~dropped
    upto = np.concatenate([[0], np.cumsum(member)])
    item_offsets = np.append(upto[i_first], upto[-1]).astype(np.int64)
    items = pa.LargeStringArray.from_buffers(len(head), pa.py_buffer(item_offsets.tobytes()), pa.py_buffer(d[member].tobytes())).cast(pa.string())
    items = pc.utf8_trim_whitespace(pc.replace_substring_regex(items, r"\s+", " "))
    if p_quoted.any():
        bare = pc.replace_substring(pc.replace_substring_regex(items, r'^"(.*)"$', r"\1"), '""', '"')
        items = pc.if_else(pa.array(p_quoted[head]), pc.utf8_trim_whitespace(bare), items)
    if suffix.any():
        items = pc.replace_substring_regex(items, r"\s*,\s*((?:[JS]r\.?|I{2,3}|IV))$", r", \1")
    kept = np.asarray(pc.not_equal(items, ""))
    items, i_row = items.filter(pa.array(kept)), p_row[head][kept]
    bounds = np.searchsorted(i_row, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), items.combine_chunks() if isinstance(items, pa.ChunkedArray) else items, mask=nulls)


def _numbered(parents: np.ndarray) -> np.ndarray:
    """1, 2, 3, ... within each run of equal parents."""
    if not len(parents):
        return np.zeros(0, np.int32)
    begins = np.concatenate([[True], parents[1:] != parents[:-1]])
    at = np.arange(len(parents))
    return (at - at[begins][np.cumsum(begins) - 1] + 1).astype(np.int32)


def _flatten(values: pa.Array, dialect: str) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Parent rows, positions and items of a column of strings or lists of strings; most items in one string, by row."""
    n = len(values)
    most = np.zeros(n, np.int64)
    if pa.types.is_list(values.type) or pa.types.is_large_list(values.type):
        inner, outer = values.flatten(), np.asarray(pc.list_parent_indices(values))
    else:
        inner, outer = values, np.arange(n)
    lists = split_values(inner, dialect)
    counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    np.maximum.at(most, outer, counts)
    parents = outer[np.asarray(pc.list_parent_indices(lists))].astype(np.int64)
    return parents, _numbered(parents), lists.flatten(), most


def _splitter(fields: dict[str, str], dialects: dict[str, str], least: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column(0)
            for name, dialect in dialects.items():
                parents, pos, items, most = _flatten(b.column(fields[name]), dialect)
                keep = most[parents] >= least
                parents, pos, items = parents[keep], pos[keep], items.filter(pa.array(keep))
                if len(parents):
                    yield pa.RecordBatch.from_arrays([key.take(pa.array(parents)), pa.array([name] * len(parents)), pa.array(pos, pa.int32()), items.cast(pa.string())], ["key", "field_name", "pos", "item"])

    return run


def split_packed(df: DataFrame, key: str, columns: dict[str, tuple[str, str]], least: int = 1) -> DataFrame:
    """``key, field_name, pos, item``: one row per packed value.

    ``columns`` names the outputs and gives, for each, the column (a string or an array of strings,
    whose elements are numbered through) and the dialect.  With ``least`` only rows are given in
    which some string holds that many values.  Nulls, empty strings and empty values give no row;
    repeated values stay.  Each row is split on its own, so the plan has no exchange.
    """
    from pyspark.sql import functions as F

    kind = df.select(key).schema[0].dataType.simpleString()
    chosen = df.select(F.col(key).alias("key"), *[F.col(c).alias(f"f_{name}") for name, (c, _) in columns.items()])
    run = _splitter({n: f"f_{n}" for n in columns}, {n: dialect for n, (_, dialect) in columns.items()}, least)
    return chosen.mapInArrow(run, f"key {kind}, field_name string, pos int, item string").withColumnRenamed("key", key)
