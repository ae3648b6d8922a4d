import unicodedata

from hypothesis import given
from hypothesis import strategies as st

from quernstone.llm import forms


def test_what_looks_the_same_has_one_form():
    plain = "Tính lý thuyết (1), $x$ 25.pdf"
    same = [
        unicodedata.normalize("NFD", plain), plain.replace(" ", " "), plain.replace(" ", "  \n"), plain.replace("l", "l‍").replace("t", "⁠t"),
        plain.replace("p", "р"), plain.replace("1", "１").replace("(", "（"), "﻿" + plain + " ", plain.replace("h", "һ").replace("T", "Τ"),
    ]
    assert {forms.one_form(t) for t in same} == {plain}


def test_what_looks_different_stays_different():
    texts = ["a-b", "a–b", "A-b", "á-b", "a-b.", "x2", "x²", "x₂", "a b", "ab", "α", "ð", "d"]
    assert len({forms.one_form(t) for t in texts}) == len(texts)
    assert forms.one_form(None) is None and forms.one_form(" ​\n") == "" and forms.one_form("") == ""
    assert forms.one_form("STRASSE", fold_case=True) == forms.one_form("Straße", fold_case=True)


@given(st.text(max_size=60))
def test_form_is_idempotent(text):
    once = forms.one_form(text)
    assert forms.one_form(once) == once


def test_pairs(spark, rows, listed):
    table = rows([("a", "x y"), ("b", "x y"), ("c", "x y"), ("c", "x y"), ("d", None), (None, "x y"), ("e", "X y")], "id string, text string, form_print string".replace(", form_print string", ""))
    from pyspark.sql import functions as F

    prints = forms.fingerprints(table, "id", "text").withColumn("source_table", F.lit("t"))
    assert listed(forms.same_looking_pairs(prints)) == [("t", "a", "b"), ("t", "b", "c")]
    assert forms.same_looking_pairs(prints.limit(0)).count() == 0
    groups = forms.same_looking_groups(prints).collect()
    assert sorted((r.key, r.n_texts) for r in groups) == [("a", 2), ("b", 2), ("c", 2), ("e", 1)]
    assert len({r.form_class for r in groups}) == 2 and forms.same_looking_groups(prints.limit(0)).count() == 0


def test_pairs_of_a_form_spread_over_cells(spark, rows, listed, monkeypatch):
    from pyspark.sql import functions as F

    from quernstone.llm import cells

    table = rows([(f"{k:02}", "x y" if k % 3 else "x  y") for k in range(40)], "id string, text string")
    prints = forms.fingerprints(table, "id", "text").withColumn("source_table", F.lit("t"))
    whole = listed(forms.same_looking_pairs(prints))
    monkeypatch.setattr(cells, "HOT", 7)
    assert listed(forms.same_looking_pairs(prints)) == whole and len(whole) == 14 * 26


def test_default_ignorable_characters_leave_no_trace():
    for code in [0xAD, 0x200B, 0x2060, 0xFE0F, 0x1BCA0, 0x1BCA3, 0x1D173, 0x1D17A, 0xE0020]:
        assert forms.one_form("a" + chr(code) + "b") == "ab", hex(code)


def test_extra_and_clashing_columns_pass_through(rows):
    table = rows([(1, "ａ", "old")], "form long, text string, other string")
    got = forms.with_form(table, "text").first()
    assert got.form == "a" and got.other == "old" and got.text == "ａ"


@given(st.text(st.characters(codec="utf-8", max_codepoint=0x2FFF), max_size=12))
def test_fast_paths_give_what_the_table_gives(text):
    slow = unicodedata.normalize("NFC", text.translate(forms._CHARACTERS))
    assert forms.one_form(text) == forms._BLANKS.sub(" ", slow).strip(" ")
