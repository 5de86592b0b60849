"""Encoding a corpus with a public byte-level BPE, in Spark's higher-order functions.

Method: a text is cut into words by the tokenizer's expression.  A word that is a token itself, which
nearly all frequent words are, gets its id on the spot.  Of the others only the distinct ones are
merged: a fold over the word's byte array joins the pair of lowest rank, as a literal rank map gives
it, until no pair has a rank.  Decoding concatenates the binary pieces.

The rank map is a literal of the vocabulary's size (50,000 tokens, which are made of 110,000 pairs of
others), not of the corpus's: an array of small maps, so a look-up reads an entry or two.  The ranks
of a word's pairs are kept, and a join renews those of its two neighbours only.

A fold copies its state at every step, so its time is the square of a word's length.  Words of
``LONG_WORD`` bytes and more, as scripts without blanks and encoded data have them, are merged with
the same ranks by a heap over a linked list in Arrow batches.

Rare words travel once to the table of distinct words and back; hot words that are tokens never travel.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import os
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.storage import write_table

#: Where the files of the public tokenizers are; a parameter of every function here.
VOCABULARIES = os.environ.get("LEDGERFOLD_TOKENIZERS", "/opt/tokenizers")
#: The cutting expression of the byte-level vocabularies, with white space and classes of Unicode.
WORDS = r"(?U) ?\p{L}++|'(?:[sdmt]|ll|ve|re)| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s++"
_CELLS = 65_536
#: Rank of a pair that is never joined, and what stands for "up to the end".
_NEVER, _END = 1 << 22, 1 << 30
#: Distinct rare words that one task merges (a second or two).
MERGE_WORDS = 50_000
#: Bytes from which on a word is merged by a heap.
LONG_WORD = 256


@lru_cache(4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def vocabulary(name: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> dict[bytes, int]:
    return read_ranks(f"{folder}/{name}.tiktoken")


def _literal(spark: SparkSession, kind: str, text: str, value: Column) -> Column:
    """A value made of ``text`` (column t), as a session variable: the optimizer puts its literal in its place."""
    name = "ledgerfold_" + hashlib.sha256((kind + text).encode()).hexdigest()[:24]
    row = spark.createDataFrame([(text,)], "t string").select(value.alias("v"))
    row.createOrReplaceTempView(name)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {kind}")
    spark.sql(f"SET VAR {name} = (SELECT v FROM {name})")
    spark.catalog.dropTempView(name)
    return F.expr(f"system.session.{name}")


def _cells(spark: SparkSession, kind: str, entries: Iterable[tuple[int, str, int]], key: Callable[[Column], Column], empty: str) -> Column:
    """``array<map<kind,int>>`` of entries (cell, key, rank)."""
    cells: list[list[str]] = [[] for _ in range(_CELLS)]
    for cell, k, rank in entries:
        cells[cell].append(f"{k}:{rank}")
    text = "\n".join(" ".join(c) or f"{empty}:-1" for c in cells)
    entry = lambda e: F.struct(key(F.substring_index(e, ":", 1)), F.substring_index(e, ":", -1).cast("int"))
    value = F.transform(F.split("t", "\n"), lambda line: F.map_from_entries(F.transform(F.split(line, " "), entry)))
    return _literal(spark, f"array<map<{kind},int>>", text, value)


def word_literal(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The tokens that are texts."""
    entries = ((zlib.crc32(piece) % _CELLS, base64.b64encode(piece).decode(), rank) for piece, rank in ranks.items())
    return _cells(spark, "string", entries, lambda k: F.unbase64(k).cast("string"), "")


def _word_rank(cells: Column, word: Column) -> Column:
    return F.element_at(F.get(cells, F.pmod(F.crc32(word.cast("binary")), F.lit(_CELLS)).cast("int")), word)


@lru_cache(4)
def pair_ranks(name: str, folder: str) -> dict[tuple[int, int], int]:
    """Rank of every pair of tokens that together are a token."""
    ranks = vocabulary(name, folder)
    out = {}
    for piece, r in ranks.items():
        for i in range(1, len(piece)):
            a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
            if a is not None and b is not None:
                out[a, b] = r
    return out


def pair_literal(spark: SparkSession, name: str, folder: str) -> Column:
    entries = (((a << 7 ^ a ^ b) % _CELLS, str(a << 20 | b), r) for (a, b), r in pair_ranks(name, folder).items())
    return _cells(spark, "bigint", entries, lambda k: k.cast("bigint"), "-1")


def _rank(cells: Column, a: Column, b: Column) -> Column:
    """Rank of a pair of ids (BIGINT)."""
    cell = F.shiftleft(a, 7).bitwiseXOR(a).bitwiseXOR(b).bitwiseAND(F.lit(_CELLS - 1)).cast("int")
    return F.coalesce(F.element_at(F.get(cells, cell), F.shiftleft(a, 20).bitwiseOR(b)), F.lit(_NEVER))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: a fold over nothing, which copies nothing."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda acc, _: acc, use)


def merge_word(word: Column, cells: Column, byte_ids: list[int]) -> Column:
    """Ids of one word (a non-empty string of less than 2**20 bytes).

    A piece is one number: the rank of the pair that it begins, its place in the word and its id, so the
    least number is the pair to join, the first of equals.
    """
    end = F.lit((1 << 20) - 1).cast("bigint")  # no token, so it pairs with none
    table = F.array(*[F.lit(i).cast("bigint") for i in byte_ids])
    pieces = F.concat(F.array(end), F.transform(F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), ""), lambda c: F.get(table, F.ascii(c))), F.array(end))
    own = lambda x: x.bitwiseAND(end)
    ranked = lambda rank, rest: F.shiftleft(rank.cast("bigint"), 40).bitwiseOR(rest)

    def merged(x: Column) -> Column:
        def join(s: Column, m: Column) -> Column:
            def at(i: Column) -> Column:
                new, left = F.shiftright(m, 40), F.get(s, i - 2)
                beside = F.array(ranked(_rank(x["c"], own(left), new), left.bitwiseAND(F.lit((1 << 40) - 1))), ranked(_rank(x["c"], new, own(F.get(s, i + 1))), m.bitwiseAND(F.lit((1 << 40) - (1 << 20))).bitwiseOR(new)))
                return F.concat(F.slice(s, F.lit(1), i - 2), beside, F.slice(s, i + 2, F.lit(_END)))

            return _let(F.array_min(F.transform(s, lambda e, i: F.when(e == m, i + 1))), at)

        step = lambda s, _: _let(F.array_min(s), lambda m: F.when(m >= (_NEVER << 40), s).otherwise(join(s, m)))
        start = F.transform(x["p"], lambda a, i: ranked(F.coalesce(_rank(x["c"], a, F.get(x["p"], i + 1)), F.lit(_NEVER)), F.shiftleft(i.cast("bigint"), 20).bitwiseOR(a)))
        folded = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(x["p"]) - 3, F.lit(1))), start, step)
        return F.transform(F.slice(folded, F.lit(2), F.size(folded) - 2), lambda e: own(e).cast("int"))

    return _let(F.struct(pieces.alias("p"), cells.alias("c")), merged)


def merge_long_word(raw: bytes, byte_ids: list[int], pairs: dict[tuple[int, int], int]) -> list[int]:
    """The same ids by a heap of pairs: time grows with the length and its logarithm."""
    ids = [byte_ids[b] for b in raw]
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pairs.get((ids[i], ids[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:  # one of the two was joined before
            continue
        ids[i], ids[j], after[i] = r, -1, after[j]
        k = after[j]
        if k < n:
            before[k] = i
            if (x := pairs.get((r, ids[k]))) is not None:
                heapq.heappush(heap, (x, i, r, ids[k]))
        h = before[i]
        if h >= 0 and (x := pairs.get((ids[h], r))) is not None:
            heapq.heappush(heap, (x, h, ids[h], r))
    return [x for x in ids if x >= 0]


def cut_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """``id, ids``: the token ids of every text, without special tokens.

    A null or empty text has the empty list; strings that look like special tokens are ordinary text.
    Rows with the same id each get the ids of their own text.
    """
    spark = docs.sparkSession
    table = vocabulary(name, folder)
    cells, pairs, byte_ids = word_literal(spark, table), pair_literal(spark, name, folder), [table[bytes([i])] for i in range(256)]
    # a word that is no token holds -1 - its place until its ids are known
    words = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("rid"), cut_words(F.coalesce(F.col(text_col), F.lit(""))).alias("words"))
    found = words.withColumn("ids", F.transform("words", lambda w, i: F.coalesce(_word_rank(cells, w), -1 - i)))
    rare = found.withColumn("at", F.filter("ids", lambda x: x < 0)).withColumn("rare", F.transform("at", lambda x: F.struct((-1 - x).alias("at"), F.get("words", -1 - x).alias("w"))))
    cut, _ = write_table(rare.select("id", "rid", "ids", "rare"), "words")
    rare = cut.select("rid", F.explode("rare").alias("x")).select("rid", "x.at", "x.w")
    distinct, _ = write_table(rare.select("w").distinct(), "rare")
    # merging costs much time for few bytes, so tasks are cut by words
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-distinct.count() // MERGE_WORDS))
    short = F.octet_length("w") < LONG_WORD

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = pair_ranks(name, folder)
            yield pa.RecordBatch.from_arrays([b["w"], pa.array([merge_long_word(w.encode(), byte_ids, known) for w in b["w"].to_pylist()], pa.list_(pa.int32()))], ["m_w", "m_ids"])

    spread = distinct.repartition(tasks, "w")
    merged = spread.filter(short).select(F.col("w").alias("m_w"), merge_word(F.col("w"), pairs, byte_ids).alias("m_ids"))
    merged, _ = write_table(merged.unionByName(spread.filter(~short).mapInArrow(long, "m_w string, m_ids array<int>")), "merged")
    own = rare.join(merged.hint("merge"), F.col("w") == F.col("m_w")).groupBy(F.col("rid").alias("t_rid")).agg(F.array_sort(F.collect_list(F.struct("at", "m_ids"))).alias("t"))
    upto = lambda x, i: F.coalesce(F.get("t", i - 1)["at"], F.lit(-1))  # noqa: E731, place of the rare word before
    parts = F.transform("t", lambda x, i: F.concat(F.slice("ids", upto(x, i) + 2, x["at"] - upto(x, i) - 1), x["m_ids"]))
    rest = F.array(F.slice("ids", F.element_at("t", -1)["at"] + 2, F.lit(_END)))
    ids = F.when(F.col("t").isNull(), F.col("ids")).otherwise(F.flatten(F.concat(parts, rest)))
    return cut.join(own.hint("merge"), F.col("rid") == F.col("t_rid"), "left").select(F.col("id").alias(id_col), ids.alias("ids"))


def decode_ids(spark: SparkSession, ids: Column, name: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> Column:
    """The bytes that a list of ids stands for; null for null."""
    ranks = vocabulary(name, folder)
    by_id = sorted(ranks, key=ranks.get)
    text = " ".join(p.hex() for p in by_id)
    pieces = _literal(spark, "array<string>", text, F.split("t", " "))
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))
