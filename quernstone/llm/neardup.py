"""Groups of records that hold the same text with small edits (problem 1).

Method: every different set of words gets ``BANDS`` band keys, each made of ``ROWS`` minwise
hashes, and a fingerprint of ``BITS`` bits, each the parity of the number of its words that fall
on that bit.  Sets of one band key are self-joined in a forest of binary tries over the
fingerprints.  Pairs of nodes are walked down together; the differing bits add up, and a pair
of nodes is dropped as soon as they exceed what any pair below it may differ in.  What reaches
the leaves is checked exactly on the sets of words.

The fingerprints lose nothing: a word in one of two sets only changes one bit, so they differ
in at most as many bits as the sets do in words, and sets of a and b words with similarity t
or more differ in at most (1 - t) / (1 + t) * (a + b) words and have sizes in a ratio of at
least t.  Only the bands can miss: a pair of similarity s shares none of them with probability
(1 - s ** ROWS) ** BANDS, which is 4.0e-7 at 0.7, 3.4e-8 at 0.72 and 3.9e-10 at 0.75; where even
that is too much, ``exact`` takes the candidates from prefixes of rare words.  Equal sets
of words are one class before all this, so a text that a third of all rows repeat is one
fingerprint.

Defined results: null texts and texts without words are in no pair and no class; repeated
rows of an id are one record; an id that occurs with several texts is compared by each of
them; empty tables give an empty result of the same schema; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.llm.cells import HOT as HOT_CLASS
from quernstone.llm.cells import cell_of, in_cells, n_cells
from quernstone.llm.forms import one_form
from quernstone.runtime import materialize, shuffle_partitions

WORD = re.compile(r"[^\W_]+")
ROWS, BANDS, BITS = 5, 80, 128
#: Rows of one band's top node that a single task joins; larger nodes are cut into blocks joined by several tasks.
HOT = 8192
#: Pairs of rows below which a pair of nodes is compared directly, and such comparisons done at a time.
LEAF, AT_ONCE = 64, 1 << 20
#: One 64-bit hash of a word gives four minwise hashes of 16 bits.
_SEEDS = np.random.default_rng(20240917).integers(1, 1 << 63, -(-ROWS * BANDS // 4), dtype=np.uint64) | np.uint64(1)
_SETS = "id string, h1 long, h2 long, words array<int>"


def word_set(text: str) -> set[str]:
    return set(WORD.findall(one_form(text).lower()))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes: dict[str, int] = {}
    for batch in batches:
        ids, first, second, sets = [], [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = word_set(text)
            if not words:
                continue
            if len(hashes) > 500_000:
                hashes.clear()
            for word in words:
                if word not in hashes:
                    hashes[word] = xxhash.xxh32_intdigest(word.encode()) - (1 << 31)
            row = np.unique(np.array([hashes[word] for word in words], np.int32))
            a, b = np.frombuffer(xxhash.xxh3_128_digest(row.tobytes()), np.int64)
            ids.append(key), first.append(a), second.append(b), sets.append(row)
        sizes = np.cumsum([0, *map(len, sets)], dtype=np.int32)
        values = np.concatenate(sets) if sets else np.array([], np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.string()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.ListArray.from_arrays(pa.array(sizes), pa.array(values))],
            names=["id", "h1", "h2", "words"],
        )


def _minwise(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ROWS * BANDS minwise hashes of each set; ``starts`` has where each set begins in ``words``.

    Hashes of 16 bits: two sets that share their least word agree as ever; different least words
    agree by chance now and then, which only adds a candidate.
    """
    distinct, at = np.unique(words, return_inverse=True)
    x = distinct.astype(np.int64).view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) ^ _SEEDS[None, :]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return np.minimum.reduceat(x.view(np.uint16)[:, : ROWS * BANDS][at], starts, axis=0)


def _parities(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The fingerprint of each set in two words; ``starts`` has where each set begins in ``words``."""
    bit = ((words.astype(np.int64).view(np.uint64) * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(57)).astype(np.int64)
    of = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(words)]))
    odd = np.bincount(of * BITS + bit, minlength=len(starts) * BITS).reshape(len(starts), BITS).astype(np.uint8) & 1
    return np.packbits(odd, axis=1).view(">u8").astype(np.uint64)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each band of each set: (band key, fingerprint in two words, number of words, id of the set)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 400):
            part = batch.slice(at, 400)
            lists = part.column(1)
            offsets = np.asarray(lists.offsets)
            words = np.asarray(lists.values)[offsets[0] : offsets[-1]]
            starts = (offsets[:-1] - offsets[0]).astype(np.int64)
            least, bits = _minwise(words, starts), _parities(words, starts).view(np.int64)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15), (len(least), BANDS)).copy()
            rows = least.reshape(len(least), BANDS, ROWS).astype(np.uint64)
            for k in range(ROWS):
                key = (key ^ rows[:, :, k]) * np.uint64(0xFF51AFD7ED558CCD)
                key ^= key >> np.uint64(33)
            ids = np.asarray(part.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel().view(np.int64)), *(pa.array(np.repeat(bits[:, k], BANDS)) for k in (0, 1)), pa.array(np.repeat(np.diff(offsets).astype(np.int32), BANDS)), pa.array(np.repeat(ids, BANDS))],
                names=["band", "high", "low", "size", "h1"],
            )


def _most_differing(words, threshold: float):
    """Words that two sets of ``words`` words together, of similarity ``threshold`` or more, may have in one of them only."""
    return (1 - threshold) / (1 + threshold) * words + 1e-6


def _leaves(a, b, a_end, b_end, keeps) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of the given pairs of nodes that keep their budget, which ``keeps`` tells of row pairs."""
    wide = b_end - b
    sizes = (a_end - a) * wide
    ends = np.cumsum(sizes)
    first = 0
    while first < len(a):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + AT_ONCE, "right")))
        n = sizes[first:last]
        node = np.repeat(np.arange(first, last), n)
        k = np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n)
        left, right = a[node] + k // wide[node], b[node] + k % wide[node]
        keep = left < right
        left, right = left[keep], right[keep]
        keep = keeps(left, right)
        yield left[keep], right[keep]
        first = last


def trie_self_join(
    groups: np.ndarray, high: np.ndarray, low: np.ndarray, budget: int, leaf: int = LEAF, sizes: np.ndarray | None = None, threshold: float = 0.0
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group whose 128-bit fingerprints differ in at most ``budget`` bits.

    With ``sizes``, the numbers of words, a pair must also be one that can have a similarity of
    ``threshold``: the budget of each pair comes from its own sizes.

    The rows must be sorted by (group, high, low), so that a node of the binary trie is a
    range of rows and its children are the parts without and with the next bit.  The pairs of
    nodes of one level are walked together: a node with itself gives three pairs of children,
    two different nodes give four, those across differ in one bit more.
    """
    edges = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1], True])
    a, a_end = edges[:-1].copy(), edges[1:].copy()
    keep = a_end - a > 1
    a, a_end = a[keep], a_end[keep]
    b, b_end = a.copy(), a_end.copy()
    errors = np.zeros(len(a), np.int16)

    def keeps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        differing = np.bitwise_count(high[x] ^ high[y]).astype(np.int16) + np.bitwise_count(low[x] ^ low[y])
        keep = differing <= budget
        if sizes is not None:
            p, q = sizes[x], sizes[y]
            keep &= (differing <= _most_differing(p + q, threshold)) & (np.minimum(p, q) + 1e-6 >= threshold * np.maximum(p, q))
        return keep

    for depth in range(BITS):
        small = (a_end - a) * (b_end - b) <= leaf
        if small.any():
            yield from _leaves(a[small], b[small], a_end[small], b_end[small], keeps)
            a, a_end, b, b_end, errors = (x[~small] for x in (a, a_end, b, b_end, errors))
        if not len(a):
            return
        bit = ((high if depth < 64 else low) >> np.uint64(63 - depth % 64)) & np.uint64(1)
        ones = np.r_[0, np.cumsum(bit, dtype=np.int64)]
        a_mid, b_mid = a_end - (ones[a_end] - ones[a]), b_end - (ones[b_end] - ones[b])
        across = a != b  # of a node with itself, (0, 1) stands for (1, 0) too
        steps = (
            (a, a_mid, b, b_mid, errors, None), (a_mid, a_end, b_mid, b_end, errors, None),
            (a, a_mid, b_mid, b_end, errors + 1, None), (a_mid, a_end, b, b_mid, errors + 1, across),
        )
        parts = []
        for x, x_end, y, y_end, e, where in steps:
            keep = (x_end > x) & (y_end > y) & (e <= budget)
            if where is not None:
                keep &= where
            parts.append(tuple(v[keep] for v in (x, x_end, y, y_end, e)))
        a, a_end, b, b_end, errors = (np.concatenate(v) for v in zip(*parts, strict=True))
    yield from _leaves(a, b, a_end, b_end, keeps)


def _whole_groups(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[tuple[list[np.ndarray], int | None]]:
    """The columns as arrays, cut so that no group (equal first column, rows in its order) is divided.

    Of a group of more than ``hot`` rows no more are kept than that: it comes as (its key, its number of rows).
    """
    parts: list[list[np.ndarray]] = []  # of the group that is still open
    held = skipped = 0
    key = None

    def closed():
        if skipped:
            yield [np.array([key])], held + skipped
        elif parts:
            yield [np.concatenate(x) for x in zip(*parts, strict=True)], None

    for batch in batches:
        now = [np.asarray(c) for c in batch.columns]
        if not len(now[0]):
            continue
        begin = 0
        if key is not None:
            begin = int(np.searchsorted(now[0], key, "right"))
            if skipped or held + begin > hot:
                skipped += begin
                parts = []
            elif begin:
                parts.append([x[:begin] for x in now])
                held += begin
            if begin == len(now[0]):
                continue
            yield from closed()
        last = int(np.searchsorted(now[0], now[0][-1]))
        if last > begin:
            yield [x[begin:last] for x in now], None
        key, skipped = now[0][-1], 0
        parts, held = [[x[last:] for x in now]], len(now[0]) - last
        if held > hot:
            parts, held, skipped = [], 0, held
    if key is not None:
        yield from closed()


def _joined(hot: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, n in _whole_groups(batches, hot):
            if n is not None:  # named here, joined in blocks by _hot_pairs
                yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array([n], pa.int64()), pa.array([True])], names=["a", "b", "hot"])
                continue
            band, high, low, words, ids = columns
            size = np.diff(np.flatnonzero(np.r_[True, band[1:] != band[:-1], True]))
            size = np.repeat(size, size)
            large = (size > hot) & np.r_[True, band[1:] != band[:-1]]
            if large.any():
                yield pa.RecordBatch.from_arrays([pa.array(band[large]), pa.array(size[large]), pa.array(np.ones(large.sum(), bool))], names=["a", "b", "hot"])
            keep = (size > 1) & (size <= hot)
            band, high, low, words, ids = band[keep], high[keep].view(np.uint64), low[keep].view(np.uint64), words[keep], ids[keep]
            order = np.lexsort((low, high, band))
            band, high, low, words, ids = band[order], high[order], low[order], words[order].astype(np.int64), ids[order]
            budget = min(BITS, int(_most_differing(2 * words.max(initial=0), threshold)))
            for x, y in trie_self_join(band, high, low, budget, sizes=words, threshold=threshold):
                p, q = ids[x], ids[y]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q)), pa.array(np.zeros(len(p), bool))], names=["a", "b", "hot"]
                )

    return run


def _hot_pairs(bands: DataFrame, keys: DataFrame, partitions: int, threshold: float) -> DataFrame:
    """Candidates of the top nodes of more than HOT rows.

    A node of n rows is cut into g = n / (HOT / 2) blocks by the hash of the id; each row goes
    to the g pairs of blocks that hold its own, and each pair of blocks is a group of at most
    about HOT rows, so no task gets more than that of one node.
    """
    blocks = F.ceil(F.col("n") / F.lit(HOT // 2)).cast("int")
    rows = bands.join(keys.select(F.col("a").alias("band"), F.col("b").alias("n")), "band").withColumn("g", blocks)
    own = F.pmod(F.xxhash64("h1"), F.col("g")).cast("int")
    cells = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    cell = F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other"))
    spread = cells.select(cell.alias("band"), "high", "low", "size", "h1")
    return spread.repartition(partitions, "band").sortWithinPartitions("band").mapInArrow(_joined(1 << 60, threshold), "a long, b long, hot boolean")


def word_sets(records: DataFrame) -> DataFrame:
    """(id, h1, h2, words) of (id, text): 32-bit word hashes in order, and the 128-bit hash that names the set."""
    narrow = records.select(F.col("id").cast("string"), F.col("text")).where("id is not null and text is not null")
    return narrow.mapInArrow(_sets, _SETS)


def _banded_pairs(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b): the pairs of sets that share a band and keep the budget of the tries."""
    partitions = shuffle_partitions(classes.sparkSession)
    bands = classes.select("h1", "words").mapInArrow(_banded, "band long, high long, low long, size int, h1 long")
    found = materialize(
        bands.repartition(partitions, "band").sortWithinPartitions("band").mapInArrow(_joined(HOT, threshold), "a long, b long, hot boolean"), "trie-pairs"
    )
    pairs = found.where("not hot").select("a", "b")
    hot = found.where("hot")
    if not hot.isEmpty():
        pairs = pairs.unionByName(_hot_pairs(bands, hot, partitions, threshold).select("a", "b"))
    return pairs.distinct()


def _prefixed_pairs(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b): every pair of sets that can have the similarity ``threshold``; none is missed.

    Sets of that similarity share one of the |x| - ceil(t |x|) + 1 rarest words of either.  The
    pairs that meet on such a word and whose sizes allow it come out; words that many prefixes
    hold are dealt to cells.  It costs a join of the prefixes' postings, which the bands save.
    """
    rarity = classes.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("rarity"))
    ranked = classes.select("h1", F.size("words").alias("size"), F.explode("words").alias("word")).join(rarity, "word")
    at = F.row_number().over(Window.partitionBy("h1", "size").orderBy("rarity", "word"))
    prefix = ranked.withColumn("at", at).where(F.col("at") <= F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1)
    prefix = materialize(prefix.select("word", "h1", "size", "at"), "prefixes")
    held = prefix.join(prefix.groupBy("word").agg(F.count("*").alias("n")).where("n > 1"), "word")
    left, right = in_cells(held, "h1", "n")
    x, y = left.alias("x"), right.alias("y")
    low, high = F.least("x.size", "y.size"), F.greatest("x.size", "y.size")
    common = F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at")) + F.least("x.at", "y.at")  # at most, by the places of the word
    can = (low + 1e-6 >= threshold * high) & (common * (1 + threshold) + 1e-6 >= threshold * (F.col("x.size") + F.col("y.size")))
    met = x.join(y, (F.col("x.word") == F.col("y.word")) & (F.col("x.cell") == F.col("y.cell")) & (F.col("x.h1") < F.col("y.h1")) & can)
    return met.select(F.col("x.h1").alias("a"), F.col("y.h1").alias("b")).distinct()


def near_duplicates(records: DataFrame, threshold: float = 0.7, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members, links) of the records (id, text).

    members: (id, h1, h2), the class of equal word sets of each record.  links: (a1, a2, b1,
    b2, similarity), pairs of different classes whose sets agree in at least ``threshold``.
    With ``exact`` the candidates come from prefixes of rare words instead of bands: no link can
    be missed then, at the price of many more candidates.
    """
    sets = materialize(word_sets(records), "word-sets")
    members = sets.select("id", "h1", "h2").distinct()
    classes = sets.groupBy("h1", "h2").agg(F.first("words").alias("words"))
    classes = materialize(classes, "word-classes")
    pairs = (_prefixed_pairs if exact else _banded_pairs)(classes, threshold)
    left = classes.select(F.col("h1").alias("a"), F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("words").alias("wa"))
    right = classes.select(F.col("h1").alias("b"), F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("words").alias("wb"))
    common = F.size(F.array_intersect("wa", "wb"))
    links = (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("common", common)
        .withColumn("similarity", F.col("common") / (F.size("wa") + F.size("wb") - F.col("common")))
        .where(F.col("similarity") >= threshold)
        .select("a1", "a2", "b1", "b2", "similarity")
    )
    return members, materialize(links, "near-links")


def record_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs (id_a, id_b) of different records, the smaller id first: across linked classes and within each class.

    Classes of many records are dealt to cells, and each tie is repeated for the pairs of cells of its two classes.
    """
    sizes = members.groupBy("h1", "h2").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > HOT_CLASS).select("h1", "h2", n_cells("n").alias("cells"))
    ties = links.select("a1", "a2", "b1", "b2").unionByName(
        sizes.where("n > 1").select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("h1").alias("b1"), F.col("h2").alias("b2"))
    )
    celled, keys = members, []
    if not large.isEmpty():
        celled = members.join(large, ["h1", "h2"], "left").select("id", "h1", "h2", F.coalesce(cell_of("id", F.col("cells")), F.lit(0)).alias("cell"))
        keys = ["cell"]
        for side in "ab":
            many = large.select(F.col("h1").alias(f"{side}1"), F.col("h2").alias(f"{side}2"), "cells")
            ties = ties.join(many, [f"{side}1", f"{side}2"], "left").withColumn(f"cell_{side}", F.explode(F.sequence(F.lit(0), F.coalesce("cells", F.lit(1)) - 1))).drop("cells")
    a, b = (celled.select(F.col("id").alias(x), F.col("h1").alias(f"{s}1"), F.col("h2").alias(f"{s}2"), *(F.col(k).alias(f"{k}_{s}") for k in keys)) for s, x in zip("ab", "xy", strict=True))
    both = ties.join(a, ["a1", "a2", *(f"{k}_a" for k in keys)]).join(b, ["b1", "b2", *(f"{k}_b" for k in keys)]).where("x <> y")
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()
