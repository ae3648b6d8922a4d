"""One form for texts that look the same (problem 5).

``one_form`` keeps what a reader sees (letters, case, accents, digits, punctuation) and
removes what a reader cannot see: the width of a character, the way an accented letter is
composed, default-ignorable characters, the script of a look-alike letter, the kind and
amount of white space.  ``fold_case`` adds full case folding for comparisons that ignore case.

Defined results: null stays null; empty and blank texts become the empty text; two equal
texts always have equal forms; ``one_form`` is idempotent; superscripts, subscripts,
fractions and circled signs look different from plain digits and therefore stay.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm.cells import in_cells

# Code point ranges of Unicode's Default_Ignorable_Code_Point, and the invisible controls.
IGNORABLE = (
    (0x0000, 0x0008), (0x000E, 0x001B), (0x007F, 0x0084), (0x0086, 0x009F),
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5),
    (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164),
    (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A),
    (0xE0000, 0xE0FFF),
)

# Letters of other scripts drawn like a Latin one, each beside its Latin look-alike.
LOOK_ALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУҮХԌԚԜҺ" "асеѕіјорхуһԁԛԝӏ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ονϲϳ" "ÐƉ" "ɑɡ",
        "ABESIJKMHOPCTYYXGQWH" "acesijopxyhdqwl" "ABEZHIKMNOPTYX" "ovcj" "ĐĐ" "ag",
        strict=True,
    )
)

# Kinds of compatibility decomposition that a reader sees.
VISIBLE_KINDS = ("<super>", "<sub>", "<fraction>", "<circle>", "<square>", "<vertical>")


class _FormOfCharacter(dict):
    """Character table of ``str.translate``, filled as characters are met: each distinct one is worked out once."""

    def __missing__(self, code: int) -> str | None:
        form = self[code] = self._form(code)
        return form

    def _form(self, code: int) -> str | None:
        character = chr(code)
        if any(first <= code <= last for first, last in IGNORABLE):
            return None
        if character.isspace():
            return " "
        kind = unicodedata.decomposition(character).partition(" ")[0]
        spread = "NFD" if kind in VISIBLE_KINDS else "NFKD"
        parts = unicodedata.normalize(spread, character)
        if parts[0] == " " and len(parts) > 1:  # a spacing accent: a sign of its own, no accented space
            return character
        return "".join(LOOK_ALIKES.get(part, part) for part in parts)


_CHARACTERS = _FormOfCharacter()
# Plain texts, which are most, need no work: single spaces between printable ASCII and precomposed Latin letters.
_PLAIN = re.compile(r"(?:[!-~À-ÏÑ-þĀ-ıĴ-ĽŁ-ňŊ-žƠơƯưẠ-ỹ]+(?: |\Z))*\Z")
_BLANKS = re.compile(r" {2,}")
# The same with other ASCII white space, which only has to be squashed.
_SPACED = re.compile(r"[\t\n\r !-~À-ÏÑ-þĀ-ıĴ-ĽŁ-ňŊ-žƠơƯưẠ-ỹ]*\Z")


def one_form(text: str | None, fold_case: bool = False) -> str | None:
    if text is None:
        return None
    if _PLAIN.match(text) and text[-1:] != " ":
        pass
    elif _SPACED.match(text):
        text = " ".join(text.split())
    else:
        text = unicodedata.normalize("NFC", text.translate(_CHARACTERS))
        text = _BLANKS.sub(" ", text).strip(" ")
    return unicodedata.normalize("NFC", text.casefold()) if fold_case else text


def _per_distinct(column: pa.ChunkedArray | pa.Array, work) -> list:
    """``work`` of every value, called once for each distinct value of the batch."""
    coded = column.dictionary_encode()
    done = [work(value) for value in coded.dictionary.to_pylist()]
    return [None if code is None else done[code] for code in coded.indices.to_pylist()]


def with_form(df: DataFrame, column: str, into: str = "form", fold_case: bool = False) -> DataFrame:
    """``df`` with the one form of ``column`` in ``into``; every other column passes through unchanged."""
    schema = T.StructType([f for f in df.schema.fields if f.name != into] + [T.StructField(into, T.StringType())])
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = _per_distinct(batch.column(column), lambda text: one_form(text, fold_case))
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in kept] + [pa.array(forms, pa.string())], names=[*kept, into]
            )

    return df.mapInArrow(run, schema)


def _fingerprint(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def fingerprints(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, form_print, text_print): 128-bit prints of the one form and of the stored text; null texts leave no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = _per_distinct(
                batch.column(1), lambda text: None if text is None else (_fingerprint(one_form(text)), _fingerprint(text))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p and p[0] for p in pairs], pa.binary()), pa.array([p and p[1] for p in pairs], pa.binary())],
                names=["key", "form_print", "text_print"],
            )

    narrow = df.select(F.col(key).cast("string").alias("key"), F.col(column).alias("text")).where("key is not null and text is not null")
    return narrow.mapInArrow(run, "key string, form_print binary, text_print binary")


def mixed_forms(records: DataFrame) -> DataFrame:
    """(source_table, form_print, n): the forms with two or more different texts and how many records have them.

    The aggregation is combined before its shuffle, so a form that a third of all rows share is no burden.
    """
    per = records.groupBy("source_table", "form_print").agg(F.min("text_print").alias("least"), F.max("text_print").alias("most"), F.count("*").alias("n"))
    return per.where("least <> most").select("source_table", "form_print", "n")


def same_looking_pairs(records: DataFrame) -> DataFrame:
    """Pairs (source_table, key_a, key_b) of records whose forms agree and whose texts differ.

    ``records`` has (source_table, key, form_print, text_print).  Only forms with two or more
    different texts reach the join; those with many records are spread over cells.
    """
    records = records.distinct()
    members = records.join(mixed_forms(records), ["source_table", "form_print"])
    left, right = in_cells(members, "key", "n")
    a, b = left.alias("a"), right.alias("b")
    return (
        a.join(
            b,
            (F.col("a.source_table") == F.col("b.source_table"))
            & (F.col("a.form_print") == F.col("b.form_print"))
            & (F.col("a.cell") == F.col("b.cell"))
            & (F.col("a.text_print") != F.col("b.text_print"))
            & (F.col("a.key") < F.col("b.key")),
        )
        .select("a.source_table", F.col("a.key").alias("key_a"), F.col("b.key").alias("key_b"))
        .distinct()
    )


def same_looking_groups(records: DataFrame) -> DataFrame:
    """(source_table, key, form_class, n_texts): every record with the class of its form and in how many different texts that form is stored.

    Linear in the rows whatever the size of a group, where the pairs are not.  A record with several texts has a row for each class.
    """
    named = records.select("source_table", "key", "form_print", "text_print").distinct()
    texts = named.groupBy("source_table", "form_print", "text_print").agg(F.lit(1).alias("one"))
    counts = texts.groupBy("source_table", "form_print").agg(F.count("*").alias("n_texts"))
    several = named.join(counts.where("n_texts > 1"), ["source_table", "form_print"], "left")
    return several.select("source_table", "key", F.lower(F.hex("form_print")).alias("form_class"), F.coalesce("n_texts", F.lit(1)).alias("n_texts")).distinct()
