"""Reading level of each text (problem 9).

Method: one smoothed unigram language model for each level, trained on the texts that people
have judged; a text gets the level of the highest posterior likelihood.  Vietnamese and
English share the models, as their words hardly overlap.

Training counts cover the labelled texts, at most ``TRAIN_DOCS`` of them (those with the
least hash of their id, so the choice is the same at every size); a text judged several times
counts with the level given most often, the lower one in a tie.  Words that fewer than
``LEAST_DOCS`` labelled texts hold add nothing.

Defined results: texts under 25 words (pieces between white space with a letter in them),
null and empty texts get no level; without any label no text gets one; repeated rows of a
document are one, and of several texts of a document the lowest level counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.llm.forms import one_form

TRAIN_DOCS = 20_000
LEAST_WORDS = 25
#: Added to every count, and labelled texts a word must stand in.
SMOOTHING, LEAST_DOCS = 0.5, 2
LEVELS = (1, 2, 3, 4)
_LETTER = re.compile(r"[^\W\d_]")
_TAG = re.compile(r"<[^<>]{1,80}>|\$[^$]{0,400}\$")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")


def n_words(text: str | None) -> int:
    return sum(1 for piece in (text or "").split() if _LETTER.search(piece))


def words_of(text: str | None) -> list[str]:
    """Words, lower case, in the one form; tags and formulas are left out."""
    return _WORD.findall(one_form(_TAG.sub(" ", text or "")).lower())


def labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, level, text) of at most TRAIN_DOCS judged documents, one row each."""
    votes = labels.where("doc_id is not null and reading_level is not null").distinct().groupBy("doc_id", "reading_level").agg(F.count("*").alias("n"))
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("n"), "reading_level"))
    judged = votes.withColumn("k", first).where("k = 1").select("doc_id", F.col("reading_level").alias("level"))
    judged = judged.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    texts = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(judged), "doc_id")  # at most TRAIN_DOCS rows
    return texts.groupBy("doc_id", "level").agg(F.min("text").alias("text"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each word by level within the batch, so that little is shuffled."""
    for batch in batches:
        counts: dict[tuple[str, int], list[int]] = {}
        for level, text in zip(batch.column("level").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if n_words(text) < LEAST_WORDS:
                continue
            found: dict[str, int] = {}
            for word in words_of(text):
                found[word] = found.get(word, 0) + 1
            for word, n in found.items():
                count = counts.setdefault((word, level), [0, 0])
                count[0] += n
                count[1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in counts], pa.string()), pa.array([v for _, v in counts], pa.int32()), *(pa.array([c[k] for c in counts.values()], pa.int64()) for k in (0, 1))],
            names=["word", "level", "n", "docs"],
        )


class LevelModels:
    """Log likelihood of each known word under each level's smoothed model, and the log share of each level among the judged texts."""

    def __init__(self, counts: list[tuple[str, int, int, int]], judged: dict[int, int]):
        levels = sorted({level for _, level, _, _ in counts})
        self.levels = levels
        self.prior = np.log([judged.get(level, 0) + SMOOTHING for level in levels]) if levels else np.zeros(0)
        docs: dict[str, int] = {}
        for word, _, _, n in counts:
            docs[word] = docs.get(word, 0) + n
        kept = sorted(word for word, n in docs.items() if n >= LEAST_DOCS)
        at = {word: k for k, word in enumerate(kept)}
        table = np.full((len(kept), len(levels)), SMOOTHING)
        for word, level, n, _ in counts:
            if word in at:
                table[at[word], levels.index(level)] += n
        table = np.log(table / table.sum(axis=0, keepdims=True)) if len(kept) else table
        self.at, self.table = at, table

    def level(self, text: str | None) -> int | None:
        if not self.levels or n_words(text) < LEAST_WORDS:
            return None
        known = [k for k in map(self.at.get, words_of(text)) if k is not None]
        return int(self.levels[int((self.prior + self.table[known].sum(axis=0)).argmax())])


def train(sample: DataFrame) -> LevelModels:
    """The models of ``sample`` (level, text); its words, those of at most TRAIN_DOCS texts, come to the driver counted."""
    counts = sample.select("level", "text").mapInArrow(_count, "word string, level int, n long, docs long")
    counts = counts.groupBy("word", "level").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    judged = {r.level: r["count"] for r in sample.groupBy("level").count().collect()}  # one row a level
    return LevelModels([(r.word, r.level, r.n, r.docs) for r in counts.collect()], judged)


def with_level(documents: DataFrame, models: LevelModels) -> DataFrame:
    """(doc_id, reading_level) of every document of at least LEAST_WORDS words."""
    shared = documents.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels = [shared.value.level(text) for text in batch.column("text").to_pylist()]
            keep = pa.array([level is not None for level in levels])
            made = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(levels, pa.int32())], names=["doc_id", "reading_level"])
            yield made.filter(keep)

    levels = documents.select("doc_id", "text").where("text is not null").mapInArrow(run, "doc_id long, reading_level int")
    return levels.groupBy("doc_id").agg(F.min("reading_level").alias("reading_level"))
