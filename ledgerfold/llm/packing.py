"""Filling containers of fixed capacity with documents.

Method: vector best fit.  A container has three capacities: tokens, documents and attention cost (the
sum of squared lengths; a container of one piece may exceed that cost).  Documents are taken in falling order of length; among the containers that
can hold one under every constraint, the one is chosen whose residual vector is left shortest (norm)
or agrees best with the document (weighted dot product); else a new one is opened.

A text is split only if it is longer than the capacity: into full pieces, which fill containers of
their own, and a rest that is packed.  Packing runs in groups of about ``GROUP_ITEMS`` items that a
hash of the row makes, so no source and no group of copies decides a group's size; each group leaves
at most a few containers open, which is the only loss against packing all at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.tokens import VOCABULARIES, encode_corpus
from ledgerfold.storage import write_table

#: Items that are packed together: enough that open containers don't matter, few enough for one task.
GROUP_ITEMS = 20_000
#: Weights of the residuals of tokens, documents and attention cost.
WEIGHTS = (1.0, 0.05, 0.2)


def best_fit(sizes: np.ndarray, tokens: int, documents: int, attention: int, rule: str = "norm", weights: tuple[float, float, float] = WEIGHTS) -> np.ndarray:
    """Container number of each item; items are taken by falling size, equal sizes in their order.

    An item whose own cost is beyond ``attention`` is alone in its container.
    """
    n = len(sizes)
    order = np.argsort(-sizes, kind="stable")
    out = np.empty(n, np.int64)
    free = np.empty((3, n), np.float64)  # residuals of the open containers
    names = np.empty(n, np.int64)
    opened = count = 0
    w = np.asarray(weights)[:, None]
    cap = np.array([tokens, documents, attention], np.float64)
    for k, i in enumerate(order):
        size = float(sizes[i])
        need = np.array([size, 1.0, size * size])
        live = free[:, :opened]
        fits = np.flatnonzero((live[0] >= size) & (live[1] >= 1) & (live[2] >= need[2]))
        if len(fits):
            rest = live[:, fits] / cap[:, None]
            part = (need / cap)[:, None]
            score = (w * (rest - part) ** 2).sum(0) if rule == "norm" else -(w * rest * part).sum(0)
            j = fits[int(np.argmin(score))]
        else:
            j = opened
            free[:, j], names[j] = cap, count
            opened, count = opened + 1, count + 1
        out[i] = names[j]
        free[:, j] -= need
        if free[0, j] < 1 or free[1, j] < 1:  # full: closed
            opened -= 1
            free[:, j], names[j] = free[:, opened], names[opened]
        elif k % 1024 == 1023:  # those too full for any item that is left are closed, too
            keep = np.flatnonzero(free[0, :opened] >= max(1.0, float(sizes[order[-1]])))
            free[:, : len(keep)], names[: len(keep)] = free[:, keep], names[keep]
            opened = len(keep)
    return out


_PACKED = "container_kind string, container_id bigint, slot int, doc_id bigint, part int, start_token int, n_tokens int"


def pack_documents(sizes: DataFrame, capacities: DataFrame, documents: int | None = None, attention: float = 1.0, document_share: float = 1.0, rule: str = "norm", group_items: int = GROUP_ITEMS) -> DataFrame:
    """``container_kind, container_id, slot, doc_id, part, start_token, n_tokens`` for every kind.

    ``sizes`` has ``doc_id`` and ``n_tokens``; ``capacities`` has ``container_kind`` and
    ``capacity_tokens`` (null and values below 1 are no containers).  ``documents`` limits the
    documents in a container, or else ``document_share`` of its tokens does; ``attention`` limits its
    sum of squares, as a share of the square of the capacity.  A piece whose own square is beyond that
    is alone in its container, whatever stands in its group, as it is split only beyond the tokens.
    With the defaults only the tokens constrain (and the documents, for texts of 0 tokens).  Texts
    without tokens are packed as items of size 0, null sizes count as 0, and every row is packed once
    for each kind, repeated ids too.
    """
    kinds = capacities.select("container_kind", F.col("capacity_tokens").cast("int").alias("cap")).filter("cap >= 1")
    items, _ = write_table(sizes.select("doc_id", F.greatest(F.coalesce(F.col("n_tokens"), F.lit(0)), F.lit(0)).cast("int").alias("n")).withColumn("rid", F.monotonically_increasing_id()), "sizes")
    groups = max(1, -(-items.count() // group_items))
    caps = [(r["container_kind"], r["cap"]) for r in kinds.collect()]  # a row per kind of container
    pieces = items.select("doc_id", "n", "rid", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).alias("cap")) for k, c in caps])).alias("c")).select("doc_id", "n", "rid", "c.*") if caps else items.select("doc_id", "n", "rid", F.lit("").alias("kind"), F.lit(1).alias("cap")).limit(0)
    spread = pieces.withColumn("g", F.pmod(F.xxhash64("rid"), F.lit(groups)))

    def pack(key, t):
        kind, g = key[0].as_py(), key[1].as_py()
        cap = t["cap"][0].as_py()
        n, doc = t["n"].to_numpy(), t["doc_id"].combine_chunks()
        order = np.argsort(t["rid"].to_numpy(), kind="stable")
        n, doc = n[order], doc.take(pa.array(order))
        full = n // cap
        full = np.where((n > cap) & (n % cap == 0), full - 1, np.where(n > cap, full, 0))  # the rest is never empty
        rest = n - full * cap
        bins = best_fit(rest, cap, documents or max(1, int(document_share * cap)), int(attention * cap * cap), rule)
        first_full = int(bins.max(initial=-1)) + 1
        owner = np.repeat(np.arange(len(n)), full)
        piece = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
        row = np.concatenate([np.arange(len(n)), owner])
        box = np.concatenate([bins, first_full + np.arange(len(owner))])
        part = np.concatenate([full, piece])
        size = np.concatenate([rest, np.full(len(owner), cap)])
        by = np.lexsort((row, box))
        row, box, part, size = row[by], box[by], part[by], size[by]
        begins = np.concatenate([[True], box[1:] != box[:-1]]) if len(box) else np.zeros(0, bool)
        at = np.arange(len(box))
        slot = at - at[begins][np.cumsum(begins) - 1] + 1 if len(box) else at
        return pa.table(
            [pa.array([kind] * len(row), pa.string()), pa.array(g << 40 | box, pa.int64()), pa.array(slot, pa.int32()), doc.take(pa.array(row)).cast(pa.int64()), pa.array(part + 1, pa.int32()), pa.array(part * cap, pa.int32()), pa.array(size, pa.int32())],
            names=["container_kind", "container_id", "slot", "doc_id", "part", "start_token", "n_tokens"],
        )

    return spread.groupBy("kind", "g").applyInArrow(pack, _PACKED)


def container_usage(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """Containers, tokens and share of the capacity used, for each kind."""
    used = packed.groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("d")).groupBy("container_kind").agg(F.count("*").alias("n_containers"), F.sum("d").alias("n_items"), F.sum("t").alias("n_tokens"))
    return used.join(F.broadcast(capacities.select("container_kind", "capacity_tokens")), "container_kind").withColumn("fill", F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")))


def document_sizes(docs: DataFrame, name: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    return encode_corpus(docs, name=name, folder=folder).select("doc_id", F.size("ids").alias("n_tokens"))
