"""Filling containers of fixed capacity with texts that belong together (problem 8).

Method: lexical retrieval packing.  Documents are dealt to shards of about ``SHARD`` by content:
by the term that marks them most, a term of more documents than a shard holds being divided
by the next one, so neighbours meet however many shards there are.  Each shard builds a BM25
inverted index over its documents, with document frequencies counted over the whole corpus.
The largest unused document seeds a container; all its terms are looked up, and its unused
neighbours fill the window greedily from the best downwards.  The last ``CLOSING`` of a window is
closed by the largest unused pieces that fit, of equal ones the nearest, so that little stays
empty.  Containers that stay under ``LOOSE`` of the capacity, a few of each shard, are opened
again and packed in shards of their own until a round no longer lowers their number.

A document is split only if it alone exceeds the capacity: it gives full containers and one
rest, which is packed like any other piece.  Documents without tokens take no space and are
reported with no container.

Defined results: every document appears, each of its tokens exactly once; repeated rows of a
key are one; null and empty texts get container null, size 0; the result depends on the data
only, not on partitioning, since shards and ties are ordered by terms and keys.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.encoding import n_tokens, vocabulary, vocabulary_path
from quernstone.llm.forms import one_form
from quernstone.runtime import materialize, one_row_each

CAPACITY, SHARD, LOOSE, ROUNDS = 2048, 4096, 0.97, 3
#: Slots of the hashed dictionary, which bound the broadcast tables of document frequencies and of shards.
SLOTS = 1 << 18
#: Share of a window that is closed by size.
CLOSING = 1 / 4
#: A term gathers neighbours if it stands in at least this part of a shard's number of documents.
GATHERS = 64
K1, B = 1.2, 0.75
_WORD = re.compile(r"[^\W_]{2,}")


@lru_cache(maxsize=1 << 17)
def _slot(word: str) -> int:
    return zlib.crc32(word.encode()) % SLOTS


def _prepared(path: str):
    """(doc_id, n_tokens, slots, counts) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            sizes, slots, counts = [], [], []
            for text in batch.column(1).to_pylist():
                sizes.append(n_tokens(text, words))
                found: dict[int, int] = {}
                for word, n in Counter(_WORD.findall(one_form(text or "").lower())).items():
                    slot = _slot(word)
                    found[slot] = found.get(slot, 0) + n
                slots.append(list(found)), counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(slots, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                names=["doc_id", "n_tokens", "slots", "counts"],
            )

    return run


def _pack(pieces: pd.DataFrame, idf: np.ndarray, mean: float, capacity: int, closing: float = CLOSING) -> list[int]:
    """Container number of each row of ``pieces`` (doc_id, piece, size, slots, counts), sorted by (size desc, doc_id, piece)."""
    n = len(pieces)
    sizes = pieces["size"].to_numpy()
    n_terms = np.array([len(s) for s in pieces["slots"]])
    of = np.repeat(np.arange(n), n_terms)
    slots = np.concatenate(list(pieces["slots"])).astype(np.int64) if n else np.array([], np.int64)
    counts = np.concatenate(list(pieces["counts"])).astype(float) if n else np.array([])
    lengths = np.bincount(of, counts, n)
    # inverted index: the postings of each term side by side, with their BM25 weights
    terms, term_of = np.unique(slots, return_inverse=True)
    weight = idf[slots] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * lengths[of] / max(mean, 1.0)))
    order = np.argsort(term_of, kind="stable")
    posted, weights = of[order], weight[order]
    begins = np.r_[0, np.cumsum(np.bincount(term_of, minlength=len(terms)))]
    own = np.r_[0, np.cumsum(n_terms)]

    def scores(row: int) -> np.ndarray:
        """BM25 of every piece for the whole text of ``row`` as the query."""
        mine = term_of[own[row] : own[row + 1]]
        sizes_of = begins[mine + 1] - begins[mine]
        at = np.repeat(begins[mine] - np.r_[0, np.cumsum(sizes_of)[:-1]], sizes_of) + np.arange(sizes_of.sum())
        return np.bincount(posted[at], weights[at], n)

    container = np.full(n, -1)
    left = np.bincount(sizes, minlength=capacity + 1)  # unused pieces of each size
    first_of = np.searchsorted(-sizes, -np.arange(capacity + 1), "left")  # equal sizes lie side by side
    last_of = np.searchsorted(-sizes, -np.arange(capacity + 1), "right")
    used, smallest = 0, int(sizes[-1]) if n else 0
    for seed in range(n):
        if container[seed] >= 0:
            continue
        space, row, score, near = capacity, seed, None, iter(())
        while row is not None:
            container[row] = used
            left[sizes[row]] -= 1
            space -= int(sizes[row])
            while smallest < capacity and not left[smallest]:
                smallest += 1
            if space < smallest or not left[smallest]:
                break
            if score is None:
                score = scores(seed)
                fits = np.flatnonzero((container < 0) & (sizes <= space) & (score > 0))
                near = iter(fits[np.lexsort((fits, -score[fits]))].tolist())
            row = None
            if space >= capacity * closing:
                for k in near:
                    rest = space - int(sizes[k])
                    if rest >= smallest or 0 <= rest <= capacity // 64:  # no gap that nothing can fill
                        row = k
                        break
            if row is None:
                some = np.flatnonzero(left[: space + 1])
                if not len(some):
                    break
                same = np.arange(first_of[some[-1]], last_of[some[-1]])
                same = same[container[same] < 0]
                row = int(same[np.argmax(score[same])])
        used += 1
    return container.tolist()


def _marked(idf: np.ndarray, frequent: np.ndarray, mean: float):
    """The pieces with the two terms that mark each most: the weightiest of those that stand in enough documents to gather neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = [], []
            for slots, counts in zip(batch.column("slots").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                s, c = np.array(slots, np.int64), np.array(counts, float)
                gathers = frequent[s]
                if gathers.any():
                    s, c = s[gathers], c[gathers]
                weight = idf[s] * c * (K1 + 1) / (c + K1 * (1 - B + B * sum(counts) / max(mean, 1.0)))
                best = s[np.lexsort((s, -weight))][:2].tolist() + [-1, -1]
                first.append(best[0]), second.append(best[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.int32()), pa.array(second, pa.int32())], names=[*batch.schema.names, "first", "second"])

    return run


def _dealt(pieces: DataFrame, shard: int) -> DataFrame:
    """``pieces`` with their shard and its part.

    Terms go to shards in order, as many to one as fill it; a term of several shards is divided
    by the second term, and what still exceeds a shard, such as copies, by the hash of the key.
    """
    counts = sorted((r["first"], r.n) for r in pieces.groupBy("first").agg(F.count("*").alias("n")).collect())  # at most SLOTS rows
    at, filled, places = 0, 0, []
    for term, n in counts:
        parts = max(1, round(n / shard))
        if parts > 1 and filled:
            at, filled = at + 1, 0
        places.append((term, at, parts))
        filled += n
        if parts > 1 or filled >= shard:
            at, filled = at + parts, 0
    table = pieces.sparkSession.createDataFrame(places, "first int, place int, parts int")
    dealt = pieces.join(F.broadcast(table), "first").withColumn("shard", F.col("place") + F.pmod(F.xxhash64("second"), F.col("parts")).cast("int"))
    sizes = dealt.groupBy("shard").agg(F.count("*").alias("n")).select("shard", F.ceil(F.col("n") / (2 * shard)).alias("parts_of"))
    return dealt.join(sizes, "shard").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts_of")).cast("int"))


def pack(documents: DataFrame, capacity: int = CAPACITY, path: str | None = None, shard: int = SHARD, closing: float = CLOSING) -> DataFrame:
    """(doc_id, piece, first_token, n_tokens, container) of ``documents`` (doc_id, text)."""
    spark = documents.sparkSession
    rows = one_row_each(documents.select("doc_id", "text").where("doc_id is not null"), ["doc_id"])
    sized = materialize(rows.mapInArrow(_prepared(path or vocabulary_path()), "doc_id long, n_tokens int, slots array<int>, counts array<int>"), "sized")
    facts = sized.agg(F.count("*").alias("n"), F.avg(F.coalesce(F.aggregate("counts", F.lit(0), lambda a, x: a + x), F.lit(0))).alias("mean")).first()
    n, mean = facts.n, facts.mean or 1.0
    frequency = np.zeros(SLOTS)
    for r in sized.select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count("*").alias("n")).toPandas().itertuples():  # at most SLOTS rows
        frequency[r.slot] = r.n
    idf = spark.sparkContext.broadcast(np.log1p((n - frequency + 0.5) / (frequency + 0.5)).clip(min=0).astype(np.float32))
    # full containers of documents above the capacity, and the pieces that are left to pack
    parts = sized.where("n_tokens > 0").withColumn("full", F.floor((F.col("n_tokens") - 1) / capacity).cast("int"))
    whole = parts.where("full > 0").select("doc_id", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * capacity).alias("first_token"), F.lit(capacity).alias("n_tokens"),
        F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.lit("-"), F.col("piece").cast("string")).alias("container"),
    )
    left = parts.select("doc_id", F.col("full").alias("piece"), (F.col("n_tokens") - F.col("full") * capacity).alias("size"), "slots", "counts")
    gathers = spark.sparkContext.broadcast(frequency >= min(shard, n) / GATHERS)
    columns = "doc_id long, piece int, size int, slots array<int>, counts array<int>, first int, second int"

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _marked(idf.value, gathers.value, mean)(batches)

    left = materialize(left.mapInArrow(marked, columns), "pieces")

    def packed(pieces: DataFrame, label: str) -> DataFrame:
        def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(["size", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
            made = _pack(group, idf.value, mean, capacity, closing)
            group["container"] = [f"{label}{key[0]}.{key[1]}-{k}" for k in made]
            group["filled"] = group.groupby("container")["size"].transform("sum").astype("int32")
            return group[["doc_id", "piece", "size", "container", "filled"]]

        narrow = _dealt(pieces, shard).select("shard", "part", "doc_id", "piece", "size", "slots", "counts")
        return materialize(narrow.groupBy("shard", "part").applyInPandas(run, "doc_id long, piece int, size int, container string, filled int"), "packed")

    done, count = None, left.count()
    for k in range(ROUNDS):
        made = packed(left, f"{k}.")
        last = k == ROUNDS - 1
        tight = made if last else made.where(F.col("filled") >= capacity * LOOSE)
        done = tight if done is None else done.unionByName(tight)
        loose = made.where(F.col("filled") < capacity * LOOSE)
        n_loose = loose.count()
        if last or n_loose <= 1 or n_loose >= count:
            if not last:
                done = done.unionByName(loose)
            break
        left, count = left.join(loose.select("doc_id", "piece"), ["doc_id", "piece"], "left_semi"), n_loose
    rest = done.join(parts.select("doc_id", "full"), "doc_id").select(
        "doc_id", "piece", (F.col("full") * capacity).alias("first_token"), F.col("size").alias("n_tokens"), "container"
    )
    none = sized.where("n_tokens = 0").select(
        "doc_id", F.lit(0).alias("piece"), F.lit(0).alias("first_token"), F.lit(0).alias("n_tokens"), F.lit(None).cast("string").alias("container")
    )
    return whole.unionByName(rest).unionByName(none)
