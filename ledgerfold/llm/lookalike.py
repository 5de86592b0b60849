"""One form for texts that look alike but are stored with other characters.

Method: ignorable characters are deleted and compatibility forms (widths, ligatures, kinds of blank)
are normalized; then every run of letters is a lattice of look-alike letters, and Viterbi picks the
path of best score under character bigrams of each script, with a price for changing the script.  The
choice depends on what a letter looks like and never on which of its look-alikes was stored, so
equal-looking texts get the same form.

Accents, hyphens, raised digits and signs stay different, as they look different.

Equal forms are found by hash.  Copies of one string are never paired with each other: only the
distinct strings of a form are, and their rows follow, so the work is that of the pairs given out.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Latin letters and the letters of other scripts that look the same.
LOOK_ALIKES = {
    "a": "а", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡ", "h": "һ", "i": "і", "j": "јϳ", "l": "ӏ", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "v": "ѵν", "w": "ԝ", "x": "х", "y": "уү",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟՕ", "P": "РΡ", "Q": "Ԛ", "S": "Ѕ", "T": "ТΤ", "V": "Ѵ", "W": "Ԝ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ",
}
#: Latin, Greek, Cyrillic and Armenian letters, of which bigrams are counted.
_BLOCKS = ((0x41, 0x250, "L"), (0x250, 0x2B0, "L"), (0x370, 0x400, "G"), (0x400, 0x530, "C"), (0x530, 0x590, "A"), (0x1E00, 0x1F00, "L"))
_CANDIDATES = {x: (latin, *others) for latin, others in LOOK_ALIKES.items() for x in (latin, *others)}
#: Price of a change of script, beyond any sum of bigrams in a run, and of a bigram never seen.
_CHANGE, _NEW = -1e7, -8.0
_LETTERS = re.compile(r"[^\W\d_]+")
_MARK = re.compile(r"[̀-ͯ]+")
_DROP = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10)}


@lru_cache(100_000)
def script(c: str) -> str:
    n = ord(c)
    return next((s for a, b, s in _BLOCKS if a <= n < b), "") if c.isalpha() else ""


@lru_cache(100_000)
def _compatible(c: str) -> str:
    """What a character looks like: nothing for ignorable ones, plain forms for compatibility ones."""
    if unicodedata.category(c) == "Cf" or ord(c) in _DROP:
        return ""
    if c in "‐‑":
        return "-"
    if c in _CANDIDATES:  # the lattice decides
        return c
    tag = unicodedata.decomposition(c)
    if tag.startswith(("<super>", "<sub>", "<circle>", "<square>", "<fraction>")):
        return c
    out = unicodedata.normalize("NFKC", c) if tag.startswith("<") else c
    return "-" if out in "‐‑" and out else out


def plain_form(text: str) -> str:
    """Compatibility normalization and deletion of ignorable characters; blanks as one space."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", "".join(map(_compatible, text)))
    return " ".join(text.split())


def count_bigrams(texts: list[str | None]) -> Counter:
    """Bigrams of letters of one script, in numpy over the code points of all texts."""
    out: Counter = Counter()
    joined = "\n".join(plain_form(t) for t in texts if t)
    if not joined:
        return out
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    kind = np.zeros(len(points), np.int8)
    for i, (a, b, _) in enumerate(_BLOCKS, 1):
        kind[(points >= a) & (points < b)] = i
    kind[kind == 2] = 1
    kind[kind == 6] = 1
    first, second = points[:-1], points[1:]
    same = (kind[:-1] > 0) & (kind[:-1] == kind[1:])
    pairs, counts = np.unique(first[same] << 21 | second[same], return_counts=True)
    for p, n in zip(pairs.tolist(), counts.tolist(), strict=True):
        a, b = chr(p >> 21), chr(p & 0x1FFFFF)
        if a.isalpha() and b.isalpha():
            out[a + b] += n
    return out


class Model:
    """Log probabilities of a letter after another, in each script."""

    def __init__(self, counts: dict[str, int]):
        rows: Counter = Counter()
        for pair, n in counts.items():
            rows[pair[0]] += n
        self.log = {pair: math.log((n + 0.5) / (rows[pair[0]] + 200)) for pair, n in counts.items()}
        self.cache: dict[tuple[str, str], str] = {}

    def step(self, a: str, b: str) -> float:
        if script(a) != script(b):
            return _CHANGE
        return max(self.log.get(a + b, _NEW), _NEW)

    def read(self, letters: str, leaning: str) -> str:
        """The best letters for a run of letters in a text that leans to a script."""
        key = ("".join(_CANDIDATES.get(c, c)[0] for c in letters), leaning)
        if key in self.cache:
            return self.cache[key]
        layers = [_CANDIDATES.get(c, (c,)) for c in letters]
        lean = lambda c: 0.0 if script(c) == leaning else _CHANGE / 2
        score = {c: lean(c) for c in layers[0]}
        back: list[dict[str, str]] = []
        for layer in layers[1:]:
            chosen = {c: max(score, key=lambda p, c=c: (score[p] + self.step(p, c), p)) for c in layer}
            score = {c: score[p] + self.step(p, c) for c, p in chosen.items()}
            back.append(chosen)
        c = max(score, key=lambda p: (score[p], p))
        path = [c]
        for chosen in reversed(back):
            c = chosen[c]
            path.append(c)
        out = "".join(reversed(path))
        if len(self.cache) < 500_000:
            self.cache[key] = out
        return out


def look(text: str | None, model: Model) -> str | None:
    """The form that all texts of this look share; null for null."""
    if text is None:
        return None
    plain = plain_form(text)
    if plain.isascii():
        return plain
    parts = unicodedata.normalize("NFD", plain)
    if all(script(c) in ("", "L") and (c <= "\x7f" or c not in _CANDIDATES) for c in parts):
        return plain  # what the lattices of a Latin text give
    # votes come from letters that have no look-alike, so they don't depend on what was stored
    votes = Counter(s for c in parts if c not in _CANDIDATES and (s := script(c)))
    leaning = max("LCGA", key=lambda s: votes[s])

    def run(m: re.Match) -> str:
        return model.read(m[0], leaning)

    marks = [(m.start(), m[0]) for m in _MARK.finditer(parts)]
    if not marks:
        return _LETTERS.sub(run, parts)
    # letters on both sides of a mark belong to one run: set marks aside, then put them back
    bare, at, cut = [], [], 0
    for start, mark in marks:
        bare.append(parts[cut:start])
        at.append((sum(map(len, bare)), mark))
        cut = start + len(mark)
    bare.append(parts[cut:])
    read = _LETTERS.sub(run, "".join(bare))
    out, cut = [], 0
    for place, mark in at:
        out += [read[cut:place], mark]
        cut = place
    return unicodedata.normalize("NFC", "".join([*out, read[cut:]]))


def train_model(df: DataFrame, columns: list[str]) -> Model:
    """Bigrams of all texts: counted in tasks, summed, and at most as many as pairs of letters exist."""
    texts = df.select(F.explode(F.array(*columns)).alias("text")).filter("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            total.update(count_bigrams(b["text"].to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["pair", "n"])

    rows = texts.mapInArrow(run, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    return Model({r["pair"]: r["n"] for r in rows})


def looks(df: DataFrame, key: str, columns: dict[str, str], model: Model) -> DataFrame:
    """``key, field_name, text, look`` for every field that is not null."""
    kind = df.select(key).schema[0].dataType.simpleString()
    fields = df.select(F.col(key).alias("key"), F.explode(F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(c).alias("text")) for n, c in columns.items()])).alias("f")).select("key", "f.*").filter("text is not null")
    counts = model.log

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = Model({})
        local.log = counts
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["key"], b["field_name"], b["text"], pa.array([look(x, local) for x in b["text"].to_pylist()], pa.string())], ["key", "field_name", "text", "look"])

    return fields.mapInArrow(run, f"key {kind}, field_name string, text string, look string").withColumnRenamed("key", key)


def _seen_looks(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """``field_name, id, look, form`` of every field that looks like something, the last two as hashes, in a written table."""
    from ledgerfold.storage import write_table

    model = train_model(df, list(columns.values()))
    seen = looks(df, key, columns, model).filter("look <> ''")
    return write_table(seen.select("field_name", F.col(key).alias("id"), F.unhex(F.sha2("look", 256)).alias("look"), F.unhex(F.sha2("text", 256)).alias("form")), "looks")[0]


def look_classes(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """``field_name, key, class_id, n_rows, n_forms``: a row for every field that looks like something.

    ``class_id`` is the least key among those that look the same, ``n_rows`` their number and
    ``n_forms`` the number of strings that write the look, so a hot look costs what its rows cost.
    Null and blank fields are in no class.
    """
    seen = _seen_looks(df, key, columns)
    forms = seen.groupBy("field_name", "look", "form").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    classes = forms.groupBy("field_name", "look").agg(F.min("id").alias("class_id"), F.sum("n").alias("n_rows"), F.count("*").alias("n_forms"))
    return seen.join(classes.hint("merge"), ["field_name", "look"]).select("field_name", F.col("id").alias(key), "class_id", "n_rows", "n_forms")


def equal_looking(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """``field_name, key_a, key_b`` (a < b): rows whose field looks the same but is another string.

    Null and blank fields look like nothing and pair with none.  Rows that repeat a string pair with
    the other strings of that look, not with each other.
    """
    from ledgerfold.storage import write_table

    seen = _seen_looks(df, key, columns)
    forms = seen.groupBy("field_name", "look", "form").agg(F.count("*").alias("n"))
    several = forms.groupBy("field_name", "look").agg(F.count("*").alias("forms")).filter("forms > 1").select("field_name", "look")
    forms = forms.join(several.hint("merge"), ["field_name", "look"], "left_semi").drop("n")
    forms, _ = write_table(forms, "forms")
    other = forms.select("field_name", "look", F.col("form").alias("form_b"))
    pairs = forms.withColumnRenamed("form", "form_a").join(other.hint("merge"), ["field_name", "look"]).filter("form_a < form_b")
    rows = seen.select("field_name", "look", F.col("form").alias("form_a"), F.col("id").alias("x"))
    left = pairs.join(rows.hint("merge"), ["field_name", "look", "form_a"])
    rows = seen.select("field_name", "look", F.col("form").alias("form_b"), F.col("id").alias("y"))
    both = left.join(rows.hint("merge"), ["field_name", "look", "form_b"])
    return both.select("field_name", F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b"))
