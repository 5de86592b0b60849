"""Variant spellings of the names of people and organisations.

Method: names are blocked by phonetic codes of their sorted tokens, pairs in a block are compared by
Jaro-Winkler similarity and a table of nicknames (an edit distance confirms what it accepts), and all
accepted pairs, of a spelling with each registered name that it may mean, are clustered by connected
components.  A component holds every spelling of the registered names that share one; within it each
spelling goes to the nearest registered name, and to none where several are equally near.

Only distinct spellings are blocked and compared, each against the registered names of its blocks;
occurrences come back by one join.  Nothing is collected, and no pairs are made among occurrences.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.components import connected_components
from ledgerfold.storage import write_table

#: Short and pet forms of given names.
NICKNAMES = {
    "alexander": "alex sasha sascha lex xander sandy", "anastasia": "ana nastya stasia stacy nastja", "benjamin": "ben benny benji", "daniel": "dan danny dani", "elizabeth": "liz beth betty eliza lisa lizzy bess",
    "francesca": "franca chiara fran frankie", "gabriela": "gabi gaby gabby", "johannes": "hannes hans johan jo", "joseph": "joe sepp josef jo joey", "katherine": "kathy kate katie kat cathy kitty", "margaret": "maggie peggy meg greta marge",
    "michael": "mike mick micky mikey", "nicholas": "nick nico niko klaus", "richard": "rick dick rich ricky", "robert": "bob rob bobby robbie bert", "susanna": "susi sue suzy susie sanna", "theodora": "dora thea theo", "thomas": "tom tommy thom",
    "victoria": "vicky vicki tori vick", "william": "bill will billy willy liam", "viktor": "vik vitya", "oskar": "ossi", "emil": "emilio", "karin": "kari", "petra": "pet", "lucia": "lucy", "jonas": "jon", "wanda": "wandy", "ingrid": "inga", "otto": "otti",
}
#: Words of organisations and their short forms.
ORGANISATION_WORDS = {
    "consortium": "consort cons consorcium", "collaboration": "collab coll collabor", "institute": "inst institut instit", "laboratory": "lab labs labor", "centre": "center ctr cent cntr", "university": "univ uni u", "department": "dept", "group": "grp gp",
    "robotics": "robot", "machine": "mach", "perception": "percept",
}
#: Titles before and additions after a name.
TITLES = ("dr", "prof", "mr", "mrs", "ms", "the")
ADDITIONS = ("jr", "sr", "ii", "iii", "iv")

#: Spellings that one task compares (a few seconds).
TASK_NAMES = 10_000

_NICK = {short: full for full, shorts in NICKNAMES.items() for short in shorts.split()}
_NICK_FULL = {full: set(shorts.split()) for full, shorts in NICKNAMES.items()}
_WORD = {short: full for full, shorts in ORGANISATION_WORDS.items() for short in shorts.split()}
_PLAIN = str.maketrans({"ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d", "ı": "i"})
#: Spellings of accented letters with plain ones.
_DIGRAPH = str.maketrans({"ü": "ue", "ö": "oe", "ä": "ae", "å": "aa", "ø": "oe", "š": "sh", "č": "ch", "ć": "ch", "ž": "zh", "ñ": "ny"})


@lru_cache(200_000)
def fold(s: str) -> str:
    s = unicodedata.normalize("NFC", s.casefold()).translate(_PLAIN)
    if s.isascii():
        return s
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


@lru_cache(200_000)
def folds(s: str) -> tuple[str, ...]:
    """A name without accents: by base letters, and by the digraphs that stand for them."""
    low = unicodedata.normalize("NFC", s.casefold())
    plain, spelt = fold(low), fold(low.translate(_DIGRAPH))
    return (plain,) if plain == spelt else (plain, spelt)


#: Classes of consonants that are confused in writing, vowels being left out.
_CLASS = {c: str(i) for i, group in enumerate(("bfpvw", "cgkqsxzj", "dt", "l", "mn", "r"), 1) for c in group}


def phonetic_code(word: str, length: int = 2) -> str:
    """Classes of the first consonants, runs as one."""
    out = []
    for c in word:
        k = _CLASS.get(c)
        if k and (not out or out[-1] != k):
            out.append(k)
        if len(out) == length:
            break
    return "".join(out)


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    if not la or not lb:
        return 0.0
    window = max(la, lb) // 2 - 1
    used, hits = [False] * lb, []
    for i, c in enumerate(a):
        for j in range(max(0, i - window), min(lb, i + window + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits.append(c)
                break
    m = len(hits)
    if not m:
        return 0.0
    other = [b[j] for j in range(lb) if used[j]]
    t = sum(x != y for x, y in zip(hits, other, strict=True)) / 2
    jaro = (m / la + m / lb + (m - t) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def edits(a: str, b: str, most: int = 2) -> int:
    """Optimal string alignment distance, ``most + 1`` where it is larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, prev = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        before, prev = prev, row
    return min(prev[-1], most + 1)


_letters = lru_cache(200_000)(frozenset)


@lru_cache(500_000)
def word_distance(typed: str, registered: str, least: float) -> int:
    """Edits between a typed word and the nearest fold of a registered one; 9 if Jaro-Winkler rejects it."""
    best = 9
    for t in folds(typed):
        for r in folds(registered):
            # two edits change at most two letters on either side
            if abs(len(t) - len(r)) <= 2 and len(_letters(t) ^ _letters(r)) <= 4 and jaro_winkler(t, r) >= least:
                best = min(best, edits(t, r))
    return best


_BREAK = re.compile(r"[\s.,]+")


@lru_cache(200_000)
def tokens_of(name: str) -> list[str]:
    """Words of a name without titles before and additions after them."""
    words = [w for w in _BREAK.split(name.replace(" ", " ")) if w.strip("-'’")]
    while words and fold(words[0]) in TITLES:
        words = words[1:]
    while len(words) > 1 and fold(words[-1]) in ADDITIONS:
        words = words[:-1]
    return words


def _joined(words: list[str]) -> str:
    return "".join(words).replace("-", "").replace("'", "").replace("’", "")


@lru_cache(200_000)
def _family_codes(word: str) -> set[str]:
    out = set()
    for f in folds(_joined([word])):
        if len(f) >= 3:
            out |= {"f" + phonetic_code(f), "b" + phonetic_code(f[::-1])}
    return out


def block_codes(name: str) -> list[str]:
    """Keys of a typed name: of its sorted tokens, the phonetic code of each, read from either end,
    with the initial of each other one; and the words of organisations in it."""
    words = sorted(tokens_of(name), key=fold)
    initials = [fold(w.strip("-"))[:1] for w in words]
    keys = set()
    for i, w in enumerate(words):
        for c in _family_codes(w):
            keys |= {f"{c}.{x}" for j, x in enumerate(initials) if j != i}
        word = fold(w)
        keys.add("n." + word)
        if _WORD.get(word, word) in ORGANISATION_WORDS:
            keys.add("o." + _WORD.get(word, word))
    return sorted(keys)


def registry_codes(name: str, kind: str) -> list[str]:
    """Keys of a registered name: the family name with the initials of the given name and its nicknames."""
    words = tokens_of(name)
    if not words:
        return []
    if kind == "organisation":
        return sorted({("o." if fold(w) in ORGANISATION_WORDS else "n.") + fold(w) for w in words if fold(w) not in ("of", "for", "the")})
    given = fold(_joined(words[:1]))
    initials = {given[:1]} | {n[0] for n in _NICK_FULL.get(given, ())}
    return sorted(f"{c}.{x}" for c in _family_codes(words[-1]) for x in initials)


def _given_distance(words: list[str], given: str, middle: str) -> tuple[int, bool] | None:
    """Edits between typed given names and a registered one, and whether only initials were typed."""
    if not words:
        return None
    parts = [w for w in given.split("-") if w]
    initials = fold("".join(p[0] for p in parts))
    letters = [w.strip("-") for w in words]
    flat = _joined(letters)
    short = all(len(w) == 1 for w in letters) or (len(letters) == 1 and len(flat) <= 3 and flat.isupper() and len(flat) < len(_joined([given])))
    short = short or (len(letters) == 1 and re.fullmatch(r"[^\W\d_]-[^\W\d_]", letters[0]) is not None)
    mid = fold(middle)[:1]
    if short:
        s = fold(flat)
        allowed = {initials, initials[0]} | ({initials + mid, initials[0] + mid} if mid else set())
        if s in allowed or (not mid and len(s) > 1 and s[:-1] in (initials, initials[0])):
            return 0, True
        return None
    typed_mid = ""
    if len(letters) > 1 and len(letters[-1]) == 1:
        typed_mid, letters = fold(letters[-1]), letters[:-1]
    if mid and typed_mid and mid != typed_mid:
        return None
    typed, full = _joined(letters), _joined([given])
    low, key = fold(typed), fold(full)
    if low == key:
        return 0, False
    if low in _NICK_FULL.get(key, ()):
        return 0, False
    d = word_distance(typed, full, 0.78)
    if d <= (1 if len(key) < 7 else 2):
        return d, False
    if any(len(n) > 3 and edits(low, n, 1) == 1 for n in _NICK_FULL.get(key, ())) and low not in _NICK_FULL and low[0] == fold(next(iter(n for n in _NICK_FULL[key] if edits(low, n, 1) == 1)))[0]:
        return 1, False
    return None


def compare_person(typed: list[str], comma: int | None, registered: list[str]) -> int | None:
    """Edits that a typed name is away from a registered person, null if it is none of its spellings."""
    if len(typed) < 2 or len(registered) < 2:
        return None
    given, family = registered[0], registered[-1]
    middle = registered[1] if len(registered) > 2 else ""
    splits = [(typed[:comma], typed[comma:])] if comma else [(typed[-1:], typed[:-1]), (typed[:1], typed[1:])]
    best = None
    for fam, giv in splits:
        f = _joined(fam)
        if len(f) < 3:
            continue
        df = word_distance(f, family.replace("-", ""), 0.85)
        if df > (1 if len(family) < 6 else 2):
            continue
        g = _given_distance(giv, given, middle)
        if g is None:
            continue
        dg, initials = g
        total = df + dg
        if total > (1 if initials else 2):
            continue
        if best is None or total < best:
            best = total
    return best


def _org_words(words: list[str]) -> list[str]:
    return sorted(_WORD.get(f, f) for f in (fold(w.replace("-", "")) for w in words) if f not in ("of", "for", "the"))


def compare_organisation(typed: list[str], registered: list[str]) -> int | None:
    a, b = _org_words(typed), _org_words(registered)
    if len(a) != len(b) or not a:
        return None
    left, total = list(b), 0
    for w in a:
        d, at = min((0 if w == x else edits(w, x), i) for i, x in enumerate(left))
        if d > 2 or (d and jaro_winkler(w, left[at]) < 0.8):
            return None
        total += d
        left.pop(at)
    return total if total <= 2 else None


def _comma_at(name: str) -> int | None:
    """How many tokens stand before the comma of a name written family name first."""
    head, comma, tail = name.partition(",")
    if not comma or not tokens_of(tail) or fold(tokens_of(tail)[0]) in ADDITIONS:
        return None
    return len(tokens_of(head)) or None


def name_distance(name: str, registered: str, kind: str) -> int | None:
    typed, reg = tokens_of(name), tokens_of(registered)
    if kind == "organisation":
        return compare_organisation(typed, reg)
    return compare_person(typed, _comma_at(name), reg)


def _codes(name: Column, kind: Column | None = None) -> Column:
    from pyspark.sql.functions import arrow_udf

    if kind is None:

        @arrow_udf("array<string>")
        def typed(a: pa.Array) -> pa.Array:
            return pa.array([block_codes(x) for x in a.to_pylist()], pa.list_(pa.string()))

        return typed(name)

    @arrow_udf("array<string>")
    def registered(a: pa.Array, k: pa.Array) -> pa.Array:
        return pa.array([registry_codes(x, y) for x, y in zip(a.to_pylist(), k.to_pylist(), strict=True)], pa.list_(pa.string()))

    return registered(name, kind)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Accepted pairs. A pair meets in several blocks, mostly in one batch: there it is compared once."""
    for b in batches:
        pairs = np.rec.fromarrays([b["sid"].to_numpy(), b["person_id"].to_numpy()])
        b = b.take(pa.array(np.unique(pairs, return_index=True)[1]))
        found = [name_distance(x, y, k) for x, y, k in zip(*(b[c].to_pylist() for c in ("name", "registered_name", "entity_kind")), strict=True)]
        distance = pa.array(found, pa.int32())
        kept = distance.is_valid()
        yield pa.RecordBatch.from_arrays([b["sid"].filter(kept), b["person_id"].filter(kept), distance.filter(kept)], ["sid", "person_id", "distance"])


def cluster_spellings(names: DataFrame, registry: DataFrame) -> DataFrame:
    """``cluster, name, person_id, distance``: the accepted pairs, each with the component it lies in.

    ``names`` has a column ``name``; ``registry`` has ``person_id`` (BIGINT >= 0), ``registered_name``
    and ``entity_kind`` (null is a person).  ``cluster`` is the greatest person of the component.  Null
    and blank names, and registered names without id or text, are in no pair.
    """
    spelt = names.select("name").filter(F.trim("name") != "").distinct()
    spelt, _ = write_table(spelt.withColumn("sid", F.monotonically_increasing_id()), "spellings")
    known = registry.select("person_id", "registered_name", "entity_kind").filter("registered_name is not null and person_id is not null").withColumn("entity_kind", F.coalesce("entity_kind", F.lit("person")))
    # comparing costs much time for few bytes, so tasks are cut by names
    tasks = max(int(spelt.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-spelt.count() // TASK_NAMES))
    left = spelt.repartition(tasks, "sid").select("sid", "name", F.explode(_codes(F.col("name"))).alias("code"))
    right = known.select("person_id", "registered_name", "entity_kind", F.explode(_codes(F.col("registered_name"), F.col("entity_kind"))).alias("code"))
    # pairs are compared where the join leaves them; only accepted ones move on
    pairs = left.join(right, "code").select("sid", "person_id", "name", "registered_name", "entity_kind")
    accepted, _ = write_table(pairs.mapInArrow(_compare, "sid bigint, person_id bigint, distance int").distinct(), "accepted")
    person = (-1 - F.col("person_id")).alias("v")  # below all spellings, so a registered name names its component
    clusters = connected_components(accepted.select(F.col("sid").alias("u"), person))
    return (
        accepted.join(clusters.hint("merge"), F.col("sid") == F.col("node")).join(spelt.hint("merge"), "sid")
        .select((-1 - F.col("component")).alias("cluster"), "name", "person_id", "distance")
    )


def link_spellings(names: DataFrame, registry: DataFrame) -> DataFrame:
    """``name, person_id`` for each distinct spelling that means a registered person or organisation.

    Input as for :func:`cluster_spellings`.  Within its cluster a spelling goes to the nearest
    registered name; where several are equally near it is not settled and links to none.
    """
    nearest = cluster_spellings(names, registry).groupBy("cluster", "name", "distance").agg(F.min("person_id").alias("person_id"), F.count("*").alias("n"))
    return nearest.groupBy("cluster", "name").agg(F.min(F.struct("distance", "n", "person_id")).alias("b")).filter("b.n = 1").select("name", F.col("b.person_id").alias("person_id"))
