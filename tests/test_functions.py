import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quernstone.functions import keys, text, values


def one(rows, value, expression, kind="string"):
    return rows([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first().y


def test_fold(rows):
    assert one(rows, "Đường Thẳng", text.fold) == "duong thang"
    assert one(rows, "Straße", text.fold) == "strasse"
    assert one(rows, unicodedata.normalize("NFD", "Nguyễn"), text.fold) == one(rows, "nguyễn", text.fold) == "nguyen"
    assert one(rows, None, text.fold) is None


def test_accent_table_agrees_with_the_database():
    for accented, plain in zip(text.ACCENTED, text.PLAIN, strict=True):
        assert accented == "đ" or unicodedata.normalize("NFD", accented)[0] == plain


def test_squash_and_optional(rows):
    assert one(rows, " a \t b\n", text.squash) == "a b"
    assert [one(rows, v, text.optional) for v in (" null ", "N/A", "", None, "0", " x ")] == [None, None, None, None, "0", "x"]


def test_tokens_and_jaccard(rows):
    assert one(rows, "Hàm số và hàm số 123 ab", text.tokens) == ["ham"]
    frame = rows([(["a", "b"], ["b", "c"]), ([], ["a"]), (["a"], ["a"])], "a array<string>, b array<string>")
    assert [r.j for r in frame.select(text.jaccard(F.col("a"), F.col("b")).alias("j")).collect()] == [1 / 3, 0.0, 1.0]


def test_natural_key(rows):
    names = ["a10", "A1", "a2", "b1"]
    ordered = rows([(n,) for n in names], "x string").orderBy(text.natural_key(F.col("x"))).collect()
    assert [r.x for r in ordered] == ["A1", "a2", "a10", "b1"]


def test_slug_title_sets_and_lines(rows):
    assert one(rows, "  Đồ thị -- hàm số! ", text.slug) == "do-thi-ham-so"
    assert one(rows, "3. đồ thị", text.display_title) == "Đồ thị"
    assert one(rows, "b; a;;b", text.reason_set) == "a; b"
    assert one(rows, "x\n\nPage 3\ny", lambda c: text.without_lines(c, "^Page")) == "x\ny"
    assert one(rows, "x\ny\nEND\nz", lambda c: text.truncated_at(c, "^END")) == "x\ny"
    assert one(rows, "x\ny", lambda c: text.truncated_at(c, "^END")) == "x\ny"
    assert one(rows, "<p>a<br>b</p>", text.strip_tags) == "a b"
    assert one(rows, '<a href="x">&', text.escape_html) == "&lt;a href=&quot;x&quot;&gt;&amp;"
    assert one(rows, "```json\n{}\n```", text.without_fences) == "{}"


def test_chunks_join_to_the_text(rows):
    for value in ("", "abc", "a\nbb\n" * 7, "x" * 25, "ab\n" + "y" * 31 + "\nz"):
        parts = one(rows, value, lambda c: text.chunks(c, 10))
        assert "".join(parts) == value and all(len(p) <= 10 for p in parts)


def test_numeric_answers(rows):
    cases = {"2,5": 2.5, "3/4": 0.75, "6/3": 2.0, "x = 7 cm": 7.0, "1/0": 1.0, "-4": -4.0, "a\n5": None, "abc": None, None: None}
    for given_, meant in cases.items():
        assert one(rows, given_, values.numeric_answer) == meant, given_
    assert one(rows, "2,50", values.canonical_number) == "2.5"
    assert one(rows, "8/2", values.canonical_number) == "4"


def test_letters_codes_and_flags(rows):
    assert [one(rows, v, values.answer_letter) for v in ("A", " b ", "Đáp án C", "D.", "N/A", "", "-", None)] == ["A", "B", "C", "D", None, None, None, None]
    spellings = ("part_i", "Phần II", "PART_III", "part 3", "phan i", "other", None)
    assert [one(rows, v, values.section_code) for v in spellings] == ["part_i", "part_ii", "part_iii", "part_iii", "part_i", None, None]
    assert [one(rows, v, values.boolean) for v in ("Đúng", "sai", "1", "x", None)] == [True, False, True, None, None]
    assert [one(rows, v, values.difficulty_rank) for v in ("Nhận biết", "Vận dụng cao", "?")] == [1, 4, 99]


def test_options_statements_boxes(rows):
    frame = rows([("1", " 1 ", None, "")], "a string, b string, c string, d string")
    columns = [F.col(c) for c in "abcd"]
    got = frame.select(values.option_map(*columns).alias("m"), values.has_repeated_option(*columns).alias("r")).first()
    assert got.m == {"A": "1", "B": "1"} and got.r
    statements = rows([([("a", True), ("b", False), ("c", None)],)], "s array<struct<label:string,answer:boolean>>")
    assert statements.select(values.statement_answers(F.col("s")).alias("x")).first().x == "DS?"
    boxes = [[0.1, 0.1, 0.5, 0.5], [0.5, 0.1, 0.1, 0.5], [0.1, 0.1, 1.5, 0.5], [0.1], None]
    assert [one(rows, b, values.valid_box, "array<double>") for b in boxes] == [True, False, False, False, False]


def test_fingerprints(rows):
    assert one(rows, "Á  b", keys.folded_signature) == one(rows, "a B", keys.folded_signature)
    assert one(rows, "Á b", keys.lower_signature) != one(rows, "a b", keys.lower_signature)
    assert one(rows, "x" * 119, keys.passage_id) is None and one(rows, "x" * 120, keys.passage_id).startswith("passage-")
    assert one(rows, "short", keys.prefix_key) is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=8))
def test_fold_is_idempotent(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "x string").select(text.fold(F.col("x")).alias("a"))
    assert all(r.a == r.b for r in frame.withColumn("b", text.fold(F.col("a"))).collect())
