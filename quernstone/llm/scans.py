"""Noise in texts taken from scanned pages (problem 4).

Method.  A dictionary is counted over the clean question texts of the whole corpus.  A spelling
that is ``STRAY`` times rarer than another one that a scan takes for it counts as a stray, so
a misreading or a slip among the clean texts makes no word.  Words of the scanned texts that
the dictionary does not hold, or holds as strays, are looked up in an inverted index of character
q-grams, joined with the dictionary's q-grams by rare prefixes; gradient-boosted trees rank
the candidates and accept or refuse the best one as the reading of a misrecognised word.
Classifiers of the same kind look at a line together with its neighbours: one for running
headers, one for page numbers, one for a word broken off at the end of a line.

All models are trained here, on the bank's own records: their clean text beside the text of
the page tells which lines, breaks and words are noise.  At most ``TRAIN_RECORDS`` records (those
with the least hash of their key) are read for that; everything else covers all rows.

Defined results: null texts and unreadable JSON have no line and no case; blank lines are
counted and have no defect; a header has no other defect; a cell of a table or an option is
text; repeated rows of a key are one; without training rows nothing is called noise.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.llm.boosting import BoostedTrees
from quernstone.llm.cells import cell_of, n_cells
from quernstone.llm.forms import one_form
from quernstone.runtime import materialize, one_row_each

TRAIN_RECORDS = 3000
#: Words of the dictionary that every task holds: the most frequent ones.
FREQUENT = 50_000
#: How many times more frequent a word must be than a spelling that looks like it to make that a stray.
STRAY = 100
Q, OVERLAP = 2, 0.5
#: Name of the flat texts that are looked at for words of their own.
FLAT = "flat"

# Letters and signs that a scan confuses, brought to one spelling (m and rn, d and cl, w and vv look alike).
CONFUSED = {
    "9": "g", "|": "i", "!": "i", "1": "i", "l": "i", "ı": "i", "0": "o", "6": "o", "8": "o", "b": "o", "€": "e", "3": "e", "5": "s", "$": "s",
    "@": "a", "4": "a", "7": "t", "2": "z", "m": "rn", "d": "ci", "w": "vv", "o'": "o", "u'": "u", "o’": "o", "u’": "u",
}
HYPHENS = "-\u2010\u2011\u00ac\u00ad\u2013"  # hyphens, the not sign a scan makes of one, soft hyphen, en dash
_PIECE = re.compile(r"\S+")
_FORMULA = re.compile(r"\$[^$]*\$")
_EDGES = ".,;:?!()[]{}\"“”…*~"
_OPTION = re.compile(r"\s*[A-Fa-f]\s*[.):]")
_INTERVAL = re.compile(r"\s*[\[(]\s*-?\d[\d.,]*\s*[;,–-]\s*-?\d[\d.,]*\s*[\])]\s*$")
_BARE = re.compile(r"\s*-?\d[\d.,]*\s*$")
_CELL = re.compile(r"\s*(?:-?\d[\d.,]*|[-–—])\s*$")
_LETTER = re.compile(r"[^\W\d_]")
_END = re.compile(r"[.?!:;]\s*$")


@lru_cache(maxsize=1 << 17)
def plain(text: str) -> str:
    """Lower case without accents."""
    text = unicodedata.normalize("NFD", text.lower())
    return "".join(c for c in text if not unicodedata.combining(c)).replace("đ", "d")


@lru_cache(maxsize=1 << 17)
def skeleton(word: str) -> str:
    """What is left of a word when letters that a scan confuses are one: equal for a word and its misreading."""
    word = plain(word)
    for seen in ("o'", "u'", "o’", "u’"):
        word = word.replace(seen, CONFUSED[seen])
    return "".join(CONFUSED.get(c, c) for c in word)


@lru_cache(maxsize=1 << 17)
def _bare(piece: str) -> str:
    """A piece between white space without its outer punctuation, in lower case; a ! before a letter may be a misread one and stays."""
    word = piece.rstrip(_EDGES)
    while word and word[0] in _EDGES and not (word[0] == "!" and len(word) > 1 and word[1].isalpha()):
        word = word[1:]
    return word.lower()


def words_of(line: str) -> list[str]:
    """Words of a line in lower case, without formulas and outer punctuation; inner marks stay, as they may be misread letters."""
    if "$" in line:
        line = _FORMULA.sub(" ", line)
    return [word for word in map(_bare, line.split()) if word]


@lru_cache(maxsize=1 << 17)
def is_wordlike(word: str) -> bool:
    letters = sum(c.isalpha() for c in word)
    return letters >= 1 and len(word) >= 2 and not any(c in "=^_\\{}$<>+/" for c in word) and not re.fullmatch(r"[\d.,;:%°-]*[^\W\d_]?", word)


def lines_of_json(raw: str | None) -> str | None:
    """The question text inside a page item's JSON; unreadable JSON and other shapes give null."""
    try:
        item = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None
    text = item.get("question_text") if isinstance(item, dict) else None
    return text if isinstance(text, str) else None


def scanned(blocks: DataFrame, bank: DataFrame) -> DataFrame:
    """(source_table, row_key, text) of ``blocks`` (row_key, text) and the JSON of ``bank`` (row_key, raw)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [lines_of_json(raw) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row_key", "text"]).filter(pa.array([t is not None for t in texts]))

    bank = one_row_each(bank.select(F.col("row_key").cast("string"), "raw").where("row_key is not null and raw is not null"), ["row_key"])
    blocks = one_row_each(blocks.select(F.col("row_key").cast("string"), "text").where("row_key is not null and text is not null"), ["row_key"])
    inner = bank.mapInArrow(run, "row_key string, text string").withColumn("source_table", F.lit("random_sources_preview"))
    rows = blocks.withColumn("source_table", F.lit("mineru_preview_10_questions")).unionByName(inner)
    return rows.select("source_table", "row_key", "text")


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over ``texts`` (text), counted within each batch first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(word for line in one_form_lines(text) for word in words_of(line) if is_wordlike(word))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def with_strays(dictionary: DataFrame) -> DataFrame:
    """(word, n, stray) of ``dictionary`` (word, n): stray spellings are STRAY times rarer than the most frequent word of their skeleton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            skeletons = [skeleton(word) for word in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(skeletons, pa.string())], names=["word", "n", "skeleton"])

    spelled = dictionary.select("word", "n").mapInArrow(run, "word string, n long, skeleton string")
    return spelled.withColumn("stray", F.col("n") * STRAY <= F.max("n").over(Window.partitionBy("skeleton"))).select("word", "n", "stray")


def in_formula(lines: list[str], kinds: list[str]) -> list[bool]:
    """Whether each line begins inside a formula that an earlier line of text left open."""
    inside, out = False, []
    for line, kind in zip(lines, kinds, strict=True):
        out.append(inside)
        if kind in ("text", "broken") and line.count("$") % 2:
            inside = not inside
    return out


def one_form_lines(text: str) -> list[str]:
    """The lines in the one form; soft hyphens at an end stay visible as hyphens."""
    return [one_form(line.rstrip()[:-1] + "-" if line.rstrip().endswith("\u00ad") else line) for line in text.split("\n")]


# ---------------------------------------------------------------- line classifiers


def table_cells(lines: list[str]) -> list[bool]:
    """Which lines are cells of a table: k intervals, a label, then k numbers; other lines may stand between them.

    If more than k numbers follow, those beside a line of words that interrupts them are left out first.
    """
    interval = [bool(_INTERVAL.match(line)) for line in lines]
    cell = interval[:]

    def beside_words(at: int) -> int:
        return sum(1 for x in (at - 1, at + 1) if 0 <= x < len(lines) and len(words_of(lines[x])) >= 3)

    k = 0
    while k < len(lines):
        if not interval[k]:
            k += 1
            continue
        last, count = k, 0
        while k < len(lines) and (interval[k] or not lines[k].strip() or any(interval[k + 1 : k + 4])):
            if interval[k]:
                last, count = k, count + 1
            k += 1
        numbers, others = [], 0
        for at in range(last + 1, min(len(lines), last + 3 * count + 8)):
            if _CELL.match(lines[at]):
                numbers.append(at)
            elif lines[at].strip():
                others += 1
                if others > 4 or len(numbers) >= count:
                    break
        for at in sorted(numbers, key=lambda at: (beside_words(at), at))[:count]:
            cell[at] = True
    return cell


# Words and letters that stand beside a page number, folded.
PAGE_WORDS = {"trang", "page", "tr", "of", "pagina", "p", "a", "g", "e", "ma", "de"}


def line_features(lines: list[str], cells: list[bool], header_odds: dict[str, float], known: set[str]) -> np.ndarray:
    """A row of features for each line; its neighbours take part."""
    usual = float(np.median([len(line) for line in lines if line.strip()] or [1]))
    rows = []
    for k, line in enumerate(lines):
        words = words_of(line)
        letters = sum(c.isalpha() for c in line)
        digits = sum(c.isdigit() for c in line)
        folded = [plain(w) for w in words]
        odds = [header_odds.get(skeleton(w), 0.0) for w in words]
        before = next((x for x in reversed(lines[:k]) if x.strip()), "")
        after = next((x for x in lines[k + 1 :] if x.strip()), "")
        first_after = next((c for c in after if c.isalpha()), "")
        rows.append((
            len(words), letters, digits, digits / max(1, digits + letters), len(line) / max(usual, 1.0),
            sum(w in known for w in words) / max(1, len(words)), sum(odds) / max(1, len(odds)), sum(odds), max(odds, default=0.0),
            bool(_END.search(line)), bool(words) and next((c for c in line if c.isalpha()), "a").isupper(),
            first_after.islower(), bool(_END.search(before)) or not before, cells[k], bool(_OPTION.match(line)), "$" in line,
            sum(w in PAGE_WORDS for w in folded) / max(1, len(folded)), k / max(1, len(lines) - 1),
            sum(c.isupper() for c in line) / max(1, letters), sum(not c.isalnum() and not c.isspace() for c in line),
            bool(_BARE.match(line)), max((len(w) for w in words), default=0),
        ))
    return np.array(rows, np.float32)


def broken_ends(lines: list[str], text_lines: list[int]) -> list[tuple[int, str, str]]:
    """(line, head, tail) of each line of text that ends in a hyphen, with the next line of text."""
    out, inside = [], False
    for at, following in zip(text_lines, text_lines[1:], strict=False):
        line = lines[at].rstrip()
        inside ^= bool(line.count("$") % 2)
        if not line or line[-1] not in HYPHENS or inside:
            continue
        head, tail = line.rstrip(HYPHENS).split(), lines[following].split()
        if head and tail and head[-1] and _LETTER.search(head[-1]):
            out.append((at, words_of(head[-1])[-1] if words_of(head[-1]) else head[-1].lower(), (words_of(tail[0]) or [tail[0].lower()])[0]))
    return out


def break_features(head: str, tail: str, frequency: dict[str, int], skeletons: dict[str, int], as_stored: str) -> tuple:
    joined, compound = head + tail, f"{head}-{tail}"
    return (
        math.log1p(frequency.get(joined, 0)), math.log1p(skeletons.get(skeleton(joined), 0)), math.log1p(frequency.get(compound, 0)),
        math.log1p(skeletons.get(skeleton(compound), 0)), math.log1p(frequency.get(head, 0)), math.log1p(frequency.get(tail, 0)),
        len(head), len(tail), tail[:1].isalpha(), as_stored != as_stored.rstrip(), as_stored.rstrip()[-1:] == "-", any(c.isdigit() for c in head),
    )


class LineModels:
    """Classifiers of lines and breaks with the words they know; bounded by FREQUENT and TRAIN_RECORDS."""

    def __init__(self, frequency: dict[str, int], strays: frozenset[str] = frozenset()):
        self.frequency = frequency
        self.known = set(frequency) - strays
        self.skeletons: dict[str, int] = {}
        for word, n in frequency.items():
            s = skeleton(word)
            self.skeletons[s] = self.skeletons.get(s, 0) + n
        self.header_odds: dict[str, float] = {}
        self.header, self.page, self.broken = BoostedTrees(), BoostedTrees(), BoostedTrees()

    def fit(self, records: list[tuple[str, str]]) -> list[tuple[str, str]]:
        """Train on (scanned, clean) texts; returns the pairs (scanned word, clean word) in which they differ."""
        marked = []
        pairs: list[tuple[str, str]] = []
        odds: dict[str, list[float]] = {}
        for scan, clean in records:
            stored, lines = scan.split("\n"), one_form_lines(scan)
            kinds, found = self._labels(lines, one_form(clean))
            pairs += found
            marked.append((stored, lines, kinds, set(words_of(one_form(clean)))))
            for line, kind in zip(lines, kinds, strict=True):
                for word in set(words_of(line)):
                    odds.setdefault(skeleton(word), [0.0, 0.0])[kind == "header"] += 1
        n_text = 1 + sum(kind == "text" for _, _, kinds, _ in marked for kind in kinds)
        n_head = 1 + sum(kind == "header" for _, _, kinds, _ in marked for kind in kinds)
        self.header_odds = {w: math.log((h + 0.1) / n_head * n_text / (t + 0.1)) for w, (t, h) in odds.items() if h + t >= 3}
        x, kinds_all, breaks, broken = [], [], [], []
        for stored, lines, kinds, clean_words in marked:
            x.append(line_features(lines, table_cells(lines), self.header_odds, self.known))
            kinds_all += kinds
            for at, head, tail in broken_ends(lines, [k for k, kind in enumerate(kinds) if kind == "text"]):
                breaks.append(break_features(head, tail, self.frequency, self.skeletons, stored[at]))
                broken.append(head + tail in clean_words and f"{head}-{tail}" not in clean_words)
        if x:
            x, kinds_all = np.concatenate(x), np.array(kinds_all)
            some = kinds_all != "blank"
            self.header.fit(x[some], kinds_all[some] == "header")
            self.page.fit(x[some], kinds_all[some] == "page_number")
            self.broken.fit(np.array(breaks, np.float32).reshape(len(breaks), 12), np.array(broken, bool))
        return pairs

    def _labels(self, lines: list[str], clean: str) -> tuple[list[str], list[tuple[str, str]]]:
        """What each line is, told by the clean text, and the words read otherwise."""
        words = [(k, w) for k, line in enumerate(lines) for w in line.split()]
        target = clean.split()
        match = SequenceMatcher(None, [w for _, w in words], target, autojunk=False)
        hit, pairs = Counter(), []
        for tag, i, j, p, q in match.get_opcodes():
            if tag == "equal":
                hit.update(k for k, _ in words[i:j])
            elif tag == "replace":
                if j - i == q - p:
                    for (k, seen), meant in zip(words[i:j], target[p:q], strict=True):
                        if skeleton(seen) == skeleton(meant):
                            hit[k] += 1
                            pairs += [(a, b) for a, b in zip(words_of(seen), words_of(meant), strict=False) if a != b]
                # both halves of a broken word are text
                for x in range(i, j - 1):
                    if any(words[x][1].rstrip(HYPHENS) + words[x + 1][1] == t or words[x][1] + words[x + 1][1] == t for t in target[p:q]):
                        hit.update((words[x][0], words[x + 1][0]))
        kinds = []
        for k, line in enumerate(lines):
            n = len(line.split())
            if not n:
                kinds.append("blank")
            elif hit[k] >= 0.4 * n or "$" in line or (n <= 2 and not any(c.isdigit() for c in line)):
                kinds.append("text")
            else:
                letters = "".join(c for c in plain(line) if c.isalpha())
                kinds.append("page_number" if len(letters) <= 12 and any(c.isdigit() for c in line) else "header")
        return kinds, pairs

    def look(self, texts: list[str]) -> list[list[tuple[str, str]]]:
        """(kind, line in one form) of every line of each text; kind is header, page_number, broken, text or blank.

        The classifiers see the lines of all texts at once, so their trees are walked a few times a batch.
        """
        parts, features = [], []
        for text in texts:
            lines = one_form_lines(text)
            parts.append((text.split("\n"), lines))
            features.append(line_features(lines, table_cells(lines), self.header_odds, self.known))
        x = np.concatenate(features) if features else np.zeros((0, 22), np.float32)
        header, page = self.header.predict(x), self.page.predict(x)
        at, all_kinds, ends, places = 0, [], [], []
        for n, (stored, lines) in enumerate(parts):
            kinds = []
            for k, line in enumerate(lines, at):
                if not line:
                    kinds.append("blank")
                elif header[k] >= 0.5 and header[k] >= page[k]:
                    kinds.append("header")
                # a page number has digits, and a cell of a table is text; the texts learnt from have no tables
                elif page[k] >= 0.5 and x[k, 2] and not x[k, 13]:
                    kinds.append("page_number")
                else:
                    kinds.append("text")
            at += len(lines)
            all_kinds.append(kinds)
            for line, head, tail in broken_ends(lines, [k for k, kind in enumerate(kinds) if kind == "text"]):
                ends.append(break_features(head, tail, self.frequency, self.skeletons, stored[line]))
                places.append((n, line))
        if ends:
            for (n, line), yes in zip(places, self.broken.predict(np.array(ends, np.float32)) >= 0.5, strict=True):
                if yes:
                    all_kinds[n][line] = "broken"
        return [list(zip(kinds, lines, strict=True)) for kinds, (_, lines) in zip(all_kinds, parts, strict=True)]


# ---------------------------------------------------------------- misread words


def _pair_features(word: str, meant: str, n_word: int, n_clean: int, n_meant: int, shared: float) -> tuple:
    a, b = skeleton(word), skeleton(meant)
    alike = SequenceMatcher(None, word, meant, autojunk=False)
    ops = [(word[i:j], meant[p:q]) for tag, i, j, p, q in alike.get_opcodes() if tag != "equal"]
    visual = sum(_visual(x, y) for x, y in ops)
    return (
        shared, a == b, len(ops), visual, len(ops) - visual, len(word) - len(meant), len(meant), math.log1p(n_word), math.log1p(n_meant),
        math.log1p(n_meant) - math.log1p(n_word), sum(c.isdigit() for c in word), sum(not c.isalnum() and c != "-" for c in word),
        plain(word) == plain(meant), sum(len(x) + len(y) for x, y in ops), word[:1] == meant[:1],
        math.log1p(n_clean), math.log1p(n_meant) - math.log1p(n_clean), math.log1p(n_word) - math.log1p(n_clean),
    )


#: What a candidate is judged by, in the order of ``_pair_features``.
_PAIR, _FEATURES = ("word", "meant", "n_word", "n_clean", "n_meant", "shared"), 18


def _visual(seen: str, meant: str) -> bool:
    """Whether a scan takes ``meant`` for ``seen``: a sign for a letter, or a lost horn."""
    if seen and meant and skeleton(seen) == skeleton(meant):
        return any(not c.isalpha() for c in seen) or seen in ("rn", "cl", "vv", "l") or plain(seen) == plain(meant) and any(c in "ươứừửữựớờởỡợ" for c in meant)
    return seen.startswith("6") and plain(meant)[:1] == "o"


def _grams(word: str) -> list[str]:
    padded = f"^{skeleton(word)}$"
    return sorted({padded[k : k + Q] for k in range(len(padded) - Q + 1)})


def _gram_rows(words: DataFrame) -> DataFrame:
    """(word, n, n_clean, grams) of ``words`` (word, n, n_clean)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([_grams(w) for w in batch.column(0).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=["word", "n", "n_clean", "grams"])

    return words.select("word", "n", "n_clean").mapInArrow(run, "word string, n long, n_clean long, grams array<string>")


def candidates(odd: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(word, n_word, n_clean, meant, n_meant, shared): words whose q-gram sets agree in OVERLAP or more, by an inverted join of rare prefixes.

    ``odd`` has (word, n, n_clean), ``dictionary`` (word, n), every word of which can be the
    reading.  Grams that many dictionary words have in their prefix are dealt to cells.
    """
    left = _gram_rows(odd).withColumn("side", F.lit(0))
    right = _gram_rows(dictionary.select("word", "n", F.col("n").alias("n_clean"))).withColumn("side", F.lit(1))
    sets = materialize(left.unionByName(right), "gram-sets")
    rarity = sets.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("rarity"))
    ranked = (
        sets.select("side", "word", F.size("grams").alias("size"), F.explode("grams").alias("gram"))
        .join(rarity, "gram")
        .withColumn("at", F.row_number().over(Window.partitionBy("side", "word").orderBy("rarity", "gram")))
        .where(F.col("at") <= F.col("size") - F.ceil(F.col("size") * OVERLAP) + 1)
    )
    cells = n_cells("rarity")
    a = ranked.where("side = 0").select("gram", "word", F.col("size").alias("sa"), F.explode(F.sequence(F.lit(0), cells - 1)).alias("cell"))
    b = ranked.where("side = 1").select("gram", F.col("word").alias("meant"), F.col("size").alias("sb"), cell_of("word", cells).alias("cell"))
    met = a.join(b, ["gram", "cell"]).where((F.col("sa") * OVERLAP <= F.col("sb")) & (F.col("sb") * OVERLAP <= F.col("sa")) & (F.col("word") != F.col("meant"))).select("word", "meant").distinct()
    x = sets.where("side = 0").select("word", F.col("n").alias("n_word"), "n_clean", F.col("grams").alias("ga"))
    y = sets.where("side = 1").select(F.col("word").alias("meant"), F.col("n").alias("n_meant"), F.col("grams").alias("gb"))
    common = F.size(F.array_intersect("ga", "gb"))
    full = met.join(x, "word").join(y, "meant").withColumn("shared", common / (F.size("ga") + F.size("gb") - common))
    return full.where(F.col("shared") >= OVERLAP).select(*_PAIR)


def readings(found: DataFrame, truth: list[tuple[str, str]], train_words: set[str]) -> DataFrame:
    """(word, meant): the best candidate of each odd word that the trained ranking accepts."""
    meant_of: dict[str, set[str]] = {}
    for seen, meant in truth:
        meant_of.setdefault(seen, set()).add(meant)
    spark = found.sparkSession
    wanted = spark.createDataFrame([(w,) for w in sorted(train_words)], "word string")
    rows = found.join(F.broadcast(wanted), "word", "left_semi").collect()  # odd words of at most TRAIN_RECORDS records
    x = np.array([_pair_features(*(r[c] for c in _PAIR)) for r in rows], np.float32).reshape(len(rows), _FEATURES)
    y = np.array([r.meant in meant_of.get(r.word, ()) for r in rows], bool)
    model = spark.sparkContext.broadcast(BoostedTrees(rounds=40, depth=3).fit(x, y))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            features = np.array([_pair_features(*row) for row in zip(*(batch.column(n).to_pylist() for n in _PAIR), strict=True)], np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("meant"), pa.array(model.value.predict(features))], names=["word", "meant", "p"])

    scored = found.mapInArrow(run, "word string, meant string, p double").where("p >= 0.5")
    best = F.row_number().over(Window.partitionBy("word").orderBy(F.desc("p"), "meant"))
    return scored.withColumn("k", best).where("k = 1").select("word", "meant")


def _looked(texts: DataFrame, models) -> DataFrame:
    """(source_table, row_key, line_no, kind, odd) of the lines that are noise or hold words outside the frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            m = models.value
            tables, keys, texts = (c.to_pylist() for c in batch.columns)
            for table, key, seen in zip(tables, keys, m.look(texts), strict=True):
                tails = {k for k, (kind, _) in enumerate(seen) if kind == "broken"}
                formula = in_formula([line for _, line in seen], [kind for kind, _ in seen])
                open_break = False
                for k, (kind, line) in enumerate(seen):
                    odd: list[str] = []
                    if kind in ("text", "broken"):
                        words = words_of("$" + line if formula[k] else line)
                        inside = words[1 if open_break else 0 : len(words) - 1 if k in tails else len(words)]
                        odd = [w for w in dict.fromkeys(inside) if w not in m.known and is_wordlike(w)]
                        open_break = kind == "broken"
                    if odd or kind not in ("text", "blank"):
                        for column, value in zip(out, (table, key, k + 1, kind, odd), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.string()), pa.array(out[4], pa.list_(pa.string()))],
                names=["source_table", "row_key", "line_no", "kind", "odd"],
            )

    return texts.select("source_table", "row_key", "text").mapInArrow(run, "source_table string, row_key string, line_no int, kind string, odd array<string>")


def study(texts: DataFrame, clean: DataFrame, labelled: DataFrame):
    """(looked lines, readings, models): everything that finding and repairing share.

    ``texts`` (source_table, row_key, text) is scanned, ``clean`` (text) feeds the dictionary,
    ``labelled`` (key, raw, clean) pairs page items with their clean text.
    """
    spark = texts.sparkSession
    dictionary = materialize(with_strays(count_words(clean)), "dictionary")
    frequent = dictionary.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    models = LineModels({r.word: r.n for r in frequent}, frozenset(r.word for r in frequent if r.stray))
    # texts of several lines and, fewer, of one: a line alone must not look like noise for want of neighbours
    readable = labelled.where(F.col("raw").isNotNull() & F.col("clean").isNotNull())
    several = F.col("raw").contains("\\n")
    records: list[tuple[str, str]] = []
    for part, n in ((readable.where(several), TRAIN_RECORDS), (readable.where(~several), TRAIN_RECORDS // 4)):
        keys = part.select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(n)  # keys first: no text is sorted
        sample = part.join(F.broadcast(keys), "key").groupBy("key").agg(F.min(F.struct("raw", "clean")).alias("r"))
        records += [(text, r.clean) for r in sample.select("r.raw", "r.clean").collect() for text in [lines_of_json(r.raw)] if text]
    truth = models.fit(records)
    train_words = {w for scan, _ in records for line in one_form_lines(scan) for w in words_of(line) if w not in models.known and is_wordlike(w)}
    looked = materialize(_looked(texts, spark.sparkContext.broadcast(models)), "looked")
    odd = looked.select(F.explode("odd").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    odd = odd.join(dictionary.select("word", F.col("n").alias("n_clean"), "stray"), "word", "left").where("coalesce(stray, true)").select("word", "n", F.coalesce("n_clean", F.lit(0)).alias("n_clean"))
    meant = materialize(readings(materialize(candidates(odd, dictionary.where("not stray")), "candidates"), truth, train_words), "readings")
    return looked, meant, models


def defects(looked: DataFrame, meant: DataFrame) -> DataFrame:
    """(source_table, row_key, line_no, defect)."""
    lines = looked.where("kind in ('header', 'page_number', 'broken')").select(
        "source_table", "row_key", "line_no", F.when(F.col("kind") == "broken", "broken_word").otherwise(F.col("kind")).alias("defect")
    )
    words = looked.where("kind in ('text', 'broken')").select("source_table", "row_key", "line_no", F.explode("odd").alias("word"))
    misread = words.join(meant.select("word"), "word", "left_semi").select("source_table", "row_key", "line_no", F.lit("misread").alias("defect"))
    return lines.unionByName(misread.distinct())


def _noise(looked: DataFrame, meant: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The kinds of lines and the readings of words of each text: (source_table, row_key, kinds) and (source_table, row_key, words)."""
    words = looked.where("kind in ('text', 'broken')").select("source_table", "row_key", F.explode("odd").alias("word")).join(meant, "word")
    words = words.groupBy("source_table", "row_key").agg(F.collect_set(F.struct("word", "meant")).alias("words"))
    kinds = looked.where("kind not in ('text')").groupBy("source_table", "row_key").agg(F.collect_list(F.struct("line_no", "kind")).alias("kinds"))
    return kinds, words


def repaired(texts: DataFrame, looked: DataFrame, meant: DataFrame) -> DataFrame:
    """(source_table, row_key, text): continuous paragraphs, without furniture, broken words joined, misread words as read.

    Options, table rows and blank lines keep their places; a text without noise is only joined.
    """
    kinds, words = _noise(looked, meant)
    keys = ["source_table", "row_key"]
    rows = texts.join(kinds, keys, "left").join(words, keys, "left").select(*keys, "text", "kinds", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, kinds, words in zip(*(batch.column(n).to_pylist() for n in ("text", "kinds", "words")), strict=True):
                out.append(_joined(text, {k["line_no"]: k["kind"] for k in kinds or ()}, {w["word"]: w["meant"] for w in words or ()}))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=[*keys, "text"])

    return rows.mapInArrow(run, "source_table string, row_key string, text string")


def flat_texts(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """(row_key, flat, block) of ``pages`` (row_key, flat), texts without line ends, and the block of the same key in ``blocks`` (source_table, row_key, text), or null."""
    flats = one_row_each(pages.select(F.col("row_key").cast("string"), "flat").where("row_key is not null and flat is not null"), ["row_key"])
    return flats.join(blocks.select("row_key", F.col("text").alias("block")), "row_key", "left")


def strays(flats: DataFrame) -> DataFrame:
    """(source_table, row_key, text) of the flat texts that aren't their block up to white space: their words must be looked at too."""
    flat, block = (F.trim(F.regexp_replace(c, r"\s+", " ")) for c in ("flat", "block"))
    return flats.where(~flat.eqNullSafe(block)).select(F.lit(FLAT).alias("source_table"), "row_key", F.col("flat").alias("text"))


def repaired_flat(flats: DataFrame, looked: DataFrame, meant: DataFrame, source_table: str) -> DataFrame:
    """(source_table, row_key, text): the flat texts repaired by the lines of their blocks, which are those of ``source_table``.

    Where the two differ, lines are put back as far as the words are the same; a flat text
    without a block has the readings of its words only.
    """
    kinds, words = _noise(looked, meant)
    rows = flats
    for name, noise in (("kinds", kinds), ("words", words)):
        for table, prefix in ((source_table, "block"), (FLAT, "flat")):
            rows = rows.join(noise.where(F.col("source_table") == table).select("row_key", F.col(name).alias(f"{prefix}_{name}")), "row_key", "left")
    columns = ("row_key", "flat", "block", "block_kinds", "flat_kinds", "block_words", "flat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for flat, block, of_block, of_flat, *words in zip(*(batch.column(n).to_pylist() for n in columns[1:]), strict=True):
                readings = {w["word"]: w["meant"] for some in words for w in some or ()}
                kinds = {k["line_no"]: k["kind"] for k in (of_flat if block is None else of_block) or ()}
                out.append(_joined(*((flat, kinds) if block is None else _relined(flat, block, kinds)), readings))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["row_key", "text"])

    texts = rows.select(*columns).mapInArrow(run, "row_key string, text string")
    return texts.select(F.lit(source_table).alias("source_table"), "row_key", "text")


def _relined(flat: str, block: str, kinds: dict[int, str]) -> tuple[str, dict[int, str]]:
    """``flat`` with the line ends of ``block``, and the kinds of its lines.

    Noise is only what the block has as a whole line too; words that the block hasn't go on with
    a line of text, and stand alone beside noise.
    """
    seen = flat.split()
    lines = block.split("\n")
    words = [(n, word) for n, line in enumerate(lines, 1) for word in line.split()]
    if seen == [word for _, word in words]:
        return block, kinds
    left = Counter(n for n, _ in words)
    of: list[int | None] = [None] * len(seen)
    for i, j, n in SequenceMatcher(None, [word for _, word in words], seen, autojunk=False).get_matching_blocks():
        for k in range(n):
            of[j + k] = words[i + k][0]
            left[words[i + k][0]] -= 1
    noise = {n for n, kind in kinds.items() if kind in ("header", "page_number")}
    out: list[list[str]] = []
    new: dict[int, str] = {}
    last: int | None = None
    for word, n in zip(seen, of, strict=True):
        added = n is None and bool(out) and last is not None and last not in noise
        n = last if added else n
        if not out or n != last:
            if n and last and any(not line.strip() for line in lines[last : n - 1]):
                out.append([])
            out.append([])
            if n in kinds and not left[n]:
                new[len(out)] = kinds[n]
        elif added:  # a broken word isn't the last one any more
            new.pop(len(out), None)
        out[-1].append(word)
        last = n
    return "\n".join(" ".join(line) for line in out), new


def _like(meant: str, seen: str) -> str:
    """``meant`` in the capitals of ``seen``."""
    if len(seen) > 1 and seen.isupper():
        return meant.upper()
    return meant[:1].upper() + meant[1:] if seen[:1].isupper() else meant


def _joined(text: str, kinds: dict[int, str], words: dict[str, str]) -> str:
    lines = one_form_lines(text)
    cells = table_cells(lines)
    paragraphs: list[str] = []
    open_end = glue = gap = False
    for k, line in enumerate(lines):
        kind = kinds.get(k + 1, "text")
        if kind in ("header", "page_number"):
            continue
        if not line:
            gap = True
            continue
        for seen, meant in words.items():
            if seen in line.lower():
                line = re.sub(re.escape(seen), lambda found, meant=meant: _like(meant, found.group()), line, flags=re.IGNORECASE)
        following = next((x for x in range(k + 1, len(lines)) if lines[x] and kinds.get(x + 1) not in ("header", "page_number")), k)
        alone = cells[k] or bool(_OPTION.match(line)) or (len(line.split()) <= 3 and cells[following] and following > k)
        # a blank line ends a paragraph unless the sentence plainly goes on after it
        goes_on = glue or not gap or (not _END.search(paragraphs[-1]) and line[0].islower()) if paragraphs else False
        gap = False
        if open_end and not alone and goes_on:
            paragraphs[-1] += line if glue else " " + line
        else:
            paragraphs.append(line)
        glue = kind == "broken" or line[-1:] in HYPHENS and not alone
        if kind == "broken":
            paragraphs[-1] = paragraphs[-1].rstrip(HYPHENS)
        open_end = not alone
    return "\n".join(paragraphs)
