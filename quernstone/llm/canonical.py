"""Mapping of freely typed values to a canonical list (problem 3).

Method: a prefix-filter set-similarity join.  A value becomes the set of the character
q-grams of its folded words.  Grams are ordered by global rarity; two sets of Jaccard
similarity t or more must share one of the first |x| - ceil(t |x|) + 1 grams of either, so
only those rare prefixes are joined.  The length filter and the positional filter drop pairs
that cannot reach t, the others are verified exactly, and the best entry is kept.

Before the join a value loses what surrounds a title (numbering such as "Chương IV -", notes
such as "(tiếp)" or "- Đề 2"), keyboard spellings of accents and usual abbreviations become
words; a value that can be read in several ways is joined in each of them.

Defined results: null, empty and pseudo-null values and exact titles are not mapped; a filled
value without an entry of similarity ``threshold`` gets id 0; ties go to the least id;
repeated values and rows give one row each; an empty list maps everything to 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import chain, combinations_with_replacement, product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.llm.forms import one_form
from quernstone.runtime import materialize

THRESHOLD = 0.41
# Spellings that stand for no value.
UNFILLED = ("", "null", "n/a", "none", "chưa phân loại")
# Usual abbreviations of the subject with what they can stand for, in folded letters.
SHORT = {
    "nh": ("nguyen ham",), "tp": ("tich phan",), "xs": ("xac suat",), "hs": ("ham so", "he so"), "kg": ("khong gian",),
    "dt": ("duong thang", "dien tich", "do thi"), "mp": ("mat phang",), "pt": ("phuong trinh",), "bpt": ("bat phuong trinh",),
    "lg": ("luong giac",), "gtln": ("gia tri lon nhat",), "gtnn": ("gia tri nho nhat",), "csc": ("cap so cong",), "csn": ("cap so nhan",),
    "bt": ("bai toan", "bieu thuc"), "ct": ("cong thuc",), "dths": ("do thi ham so",), "hh": ("hinh hoc",), "vt": ("vecto",), "tk": ("thong ke",),
    "tt": ("the tich",),
}
# What is written around a title, in folded letters.
AROUND = re.compile(
    r"(?:chuong|bai|dang|buoi|chu de|chuyen de|cd|phan|muc|§)\s*(?:\d+\s*[-–:.)]*(?=\s|$|[a-z])|[ivxl]+\s*[-–:.)]+)"
    r"|(?:^|\s)\d+\s*[.)]\s*"
    r"|\((?:tiep|hk[i12]+|phan \d+|ban nhap|de \d+|lop \d+)\)?"
    r"|[-–,]?\s*(?:lop|de so|de|ma|tuan|phan)\s+\d+"
    r"|[-–]\s*(?:nang cao|co ban)"
    r"|(?:^|\s)(?:nang cao|vdc|hk[i12]+|ban nhap)(?=\s|$)"
)
_TELEX_VOWELS = (("uw", "u"), ("ow", "o"), ("aw", "a"), ("aa", "a"), ("ee", "e"), ("oo", "o"), ("dd", "d"))
_WORD = re.compile(r"[a-z0-9]+")
_MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff]+")
SIZES = (2, 3)
#: Grams of a word of one letter.
LEAST_GRAMS = sum(max(0, 3 - size + 1) for size in SIZES)


def fold(text: str) -> str:
    """Case-folded one form without accents."""
    return _MARKS.sub("", unicodedata.normalize("NFD", one_form(text, fold_case=True))).replace("đ", "d")


def _from_keys(word: str) -> str:
    """A word typed by keyboard rules for accents, without its accents: luwowngj -> luong."""
    for typed, plain in _TELEX_VOWELS:
        word = word.replace(typed, plain)
    if len(word) > 2 and word[-1] in "sfrxj" and word[0] != word[-1]:
        word = word[:-1]
    return word.replace("w", "")


def readings(value: str, most: int | None = None) -> list[list[str]]:
    """The ways to read a value, each a list of words: as typed, and as keyboard spelling where that differs.

    Every abbreviation is read in each way it can be meant, each of its occurrences on its own; as
    the order of words doesn't count, two occurrences that swap their meanings are one way.  With
    ``most``, the grams that a match can have at most, a value whose words alone have more is read
    once: it matches nothing in any reading.
    """
    text = fold(value.replace("_", " "))
    bare = AROUND.sub(" ", text)
    words = _WORD.findall(bare) or _WORD.findall(text)
    typed = [word for word in words if word not in SHORT]
    short = Counter(word for word in words if word in SHORT)
    choices = [combinations_with_replacement(SHORT[word], n) for word, n in sorted(short.items())]
    if most is not None and LEAST_GRAMS * len(words) > most:
        return [words]
    ways = [typed + " ".join(chain.from_iterable(way)).split() for way in product(*choices)] if short else [words]
    # no accent anywhere, and a doubled vowel, dd or w, as no Vietnamese word has it: perhaps keyboard spelling
    if value.isascii() and re.search(r"w|aa|ee|oo|dd|[aeiouy][sfrxj]\b", text):
        ways.append([w for word in words for w in [_from_keys(word)] if w])
    known: set[tuple[str, ...]] = set()
    return [way for way in ways if way and not (tuple(way) in known or known.add(tuple(way)))]


def grams(words: list[str]) -> list[str]:
    """q-grams of the words, each padded; the n-th repetition of a gram is a gram of its own, so sets keep multiplicity."""
    seen: dict[str, int] = {}
    out = []
    for word in words:
        padded = f"^{word}$"
        for size in SIZES:
            for k in range(len(padded) - size + 1):
                gram = padded[k : k + size]
                seen[gram] = seen.get(gram, 0) + 1
                out.append(gram if seen[gram] == 1 else f"{gram}#{seen[gram]}")
    return out


def _with_grams(df: DataFrame, key: str, column: str, most: int | None = None) -> DataFrame:
    """(key, way, grams) of every reading of ``column``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ways, sets = [], [], []
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for way, words in enumerate(readings(value, most)):
                    keys.append(k), ways.append(way), sets.append(grams(words))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.column(0).type), pa.array(ways, pa.int32()), pa.array(sets, pa.list_(pa.string()))], names=[key, "way", "grams"]
            )

    kind = dict(df.dtypes)[key]
    return df.select(key, column).mapInArrow(run, f"{key} {kind}, way int, grams array<string>")


def similarity_join(values: DataFrame, entries: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(list, value, id, similarity) of all pairs of ``values`` (list, value) and ``entries`` (list, id, title) of that similarity or more.

    ``list`` names the canonical list a value belongs to; only pairs of one list are joined.
    """
    keyed = values.select("list", "value", F.md5("value").alias("key"))  # rows of grams carry the key, whatever the length of the value
    right = entries.select(F.struct("list", "id").alias("e"), "title").transform(lambda d: _with_grams(d, "e", "title")).where("way = 0").select(F.col("e.list").alias("list"), F.col("e.id").cast("string").alias("item"), F.lit(-1).alias("way"), "grams")
    most = right.agg(F.max(F.size("grams"))).first()[0] or 0
    left = keyed.select(F.struct("list", "key").alias("v"), "value").transform(lambda d: _with_grams(d, "v", "value", int(most / threshold))).select(F.col("v.list").alias("list"), F.col("v.key").alias("item"), "way", "grams")
    sets = left.unionByName(right)
    rarity = sets.select("list", F.explode("grams").alias("gram")).groupBy("list", "gram").agg(F.count("*").alias("n"))
    # each set's grams by rarity, with their place: (place, gram) of the prefix is what gets joined
    placed = sets.select("list", "item", "way", F.size("grams").alias("size"), F.explode("grams").alias("gram")).join(rarity, ["list", "gram"])
    ordered = placed.groupBy("list", "item", "way", "size").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("ranked")).select("list", "item", "way", "size", F.col("ranked.gram").alias("ranked"))
    ordered = materialize(ordered, "ranked-grams")
    prefix = F.slice("ranked", F.lit(1), F.col("size") - F.ceil(F.col("size") * threshold).cast("int") + 1)
    probes = ordered.select("list", "item", "way", "size", F.posexplode(prefix).alias("at", "gram"))  # the whole sets stay behind
    a = probes.where("way >= 0").select("list", "gram", F.col("item").alias("key"), "way", F.col("size").alias("sa"), F.col("at").alias("pa"))
    b = probes.where("way < 0").select("list", "gram", F.col("item").alias("id"), F.col("size").alias("sb"), F.col("at").alias("pb"))
    least = F.ceil((F.col("sa") + F.col("sb")) * (threshold / (1 + threshold)) - 1e-9)
    possible = F.least(F.col("sa") - F.col("pa"), F.col("sb") - F.col("pb"))
    met = (
        a.join(b, ["list", "gram"])
        .where((F.col("sa") * threshold <= F.col("sb")) & (F.col("sb") * threshold <= F.col("sa")))  # length filter
        # positional filter: in its first common gram a pair cannot have more in common than what follows
        .groupBy("list", "key", "way", "id")
        .agg(F.min(F.struct("pa", possible.alias("possible"), least.alias("least"))).alias("m"))
        .where("m.possible >= m.least")
        .select("list", "key", "way", "id")
    )
    left_sets = ordered.where("way >= 0").select("list", F.col("item").alias("key"), "way", F.col("ranked").alias("ga"))
    right_sets = ordered.where("way < 0").select("list", F.col("item").alias("id"), F.col("ranked").alias("gb"))
    both = met.join(left_sets, ["list", "key", "way"]).join(right_sets, ["list", "id"])
    common = F.size(F.array_intersect("ga", "gb"))
    scored = both.select("list", "key", F.col("id").cast("int").alias("id"), (common / (F.size("ga") + F.size("gb") - common)).alias("similarity"))
    return scored.where(F.col("similarity") >= threshold).join(keyed, ["list", "key"]).select("list", "value", "id", "similarity")


def best_entries(values: DataFrame, entries: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(list, value, id) of each of ``values``: its best entry of ``entries``, or 0."""
    pairs = similarity_join(values, entries, threshold)
    first = F.row_number().over(Window.partitionBy("list", "value").orderBy(F.desc("similarity"), "id"))
    best = pairs.withColumn("k", first).where("k = 1").select("list", "value", "id")
    return values.join(best, ["list", "value"], "left").select("list", "value", F.coalesce("id", F.lit(0)).alias("id"))


def is_filled(column) -> F.Column:
    return column.isNotNull() & ~F.lower(F.trim(F.regexp_replace(column, r"(?U)\s+", " "))).isin(*UNFILLED)


def map_records(records: DataFrame, entries: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, list, id) of ``records`` (key, list, value) that are filled and no exact title of their list.

    The similarity join runs over distinct values only, so a value that a third of all rows
    share is joined once; its rows get the result by an equi-join on the value.
    """
    titles = entries.select("list", F.col("title").alias("value")).distinct()
    typed = records.where(is_filled(F.col("value"))).join(titles, ["list", "value"], "left_anti")  # Spark broadcasts a short list by its size
    mapped = best_entries(typed.select("list", "value").distinct(), entries, threshold)
    return typed.join(mapped, ["list", "value"]).select("key", "list", "id").distinct()
