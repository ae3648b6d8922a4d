from pyspark.sql import functions as F

from quernstone.functions import items, text
from quernstone.operators import lookups

STATEMENTS = "s array<struct<label:string,text:string,answer:boolean>>"


def one(rows, value, expression, kind="string"):
    return rows([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first().y


def listed(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def test_flags(rows):
    assert [one(rows, v, lambda c: items.mentions(c, items.FIGURE_WORDS)) for v in ("Xem HÌNH VẼ bên", "khác", None)] == [True, False, False]
    assert [one(rows, v, lambda c: items.needs_image(c, least=5)) for v in ("long enough", "x", None, "the diagram shows")] == [False, True, True, True]
    assert [one(rows, v, items.looks_like_question) for v in ("Câu 1. x\nA. 1\nB. 2", "A. 1\nB. 2", None)] == [True, False, False]
    assert [one(rows, v, items.is_question) for v in ("Hỏi gì?", "Tính tổng", "Một câu.", None)] == [True, True, False, False]


def test_lists_and_letters(rows):
    assert one(rows, [" a ", "", None, "b", "c"], lambda c: items.clipped(c, 2), "array<string>") == ["a", "b"]
    assert [one(rows, v, items.truth_letters) for v in ("Đúng, Sai, Đúng, Sai", "D S D", "true false true true", "ĐSĐĐ", None)] == ["DSDS", None, "DSDD", "DSDD", None]


def test_statements(rows):
    frame = rows([([("a", "x", None), (None, "y", True)],)], STATEMENTS)
    got = frame.select(items.with_truths(F.col("s"), F.lit("SD??")).alias("v"), items.without_answers(F.col("s")).alias("w")).first()
    assert [(s.label, s.answer) for s in got.v] == [("a", False), ("b", True), ("c", None), ("d", None)]
    assert [s.answer for s in got.w] == [None, None]
    explained = frame.withColumn("e", F.expr("array(named_struct('label', 'B', 'text', 'why b'), named_struct('label', 'b', 'text', 'second'))"))
    assert [s.explanation for s in explained.select(items.with_explanations(F.col("s"), F.col("e")).alias("v")).first().v] == [None, "why b"]


def test_tables_pages_boxes(rows):
    table = rows([([(" a ", [" 1 ", None]), (None, ["", " "])],)], "t array<struct<label:string,cells:array<string>>>")
    assert [(r.label, r.cells) for r in table.select(items.clean_table(F.col("t")).alias("v")).first().v] == [("a", ["1", ""])]
    assert one(rows, "[PAGE 4] x [PAGE 12] y [PAGE 3]", items.page_range) == (3, 12) and one(rows, "none", items.page_range) is None
    assert one(rows, [0.0, 0.5, 0.995, 0.6], lambda c: items.clip_box(c, F.lit(100), F.lit(200)), "array<double>") == [0, 98, 100, 122]


def test_paragraphs_json_words(rows):
    assert one(rows, "keep\n\nAUDIT: a\n\nAUDIT: b\n\nrest", lambda c: items.without_paragraphs(c, "AUDIT")) == "keep\n\nrest"
    assert one(rows, '{"a": 1, "b": "x"}', lambda c: items.json_with(c, "a int, b string", "b", F.lit("y"))) == '{"a":1,"b":"y"}'
    frame = rows([("which distance between planets", "the passage speaks of cooking"), ("which distance", "the distance"), ("short", "x")], "q string, p string")
    assert [r.y for r in frame.select(items.unsupported_words(F.col("q"), F.col("p")).alias("y")).collect()] == [True, False, False]
    assert one(rows, "a CUE b CUE c", lambda c: items.last_passage(c, "CUE")) == "CUE c" and one(rows, "a", lambda c: items.last_passage(c, "CUE")) is None
    assert tuple(one(rows, "option. Read the text", lambda c: items.split_tail(c, "Read "))) == ("option.", "Read the text")
    assert tuple(one(rows, " option ", lambda c: items.split_tail(c, "Read "))) == ("option", None)


def test_lookups(rows):
    assert listed(lookups.in_order(rows([("a", 1), ("b", 2)], "k string, v int"), rows([("b", 1), ("x", 2), ("b", 3)], "k string, ordinal int"), "k")) == [("b", 2, 1)]
    titles = rows([(2, "abc"), (1, "ab"), (3, "xyz")], "unit int, title string")
    assert listed(lookups.by_title(rows([("abc",), ("abcd",), ("q",)], "item string"), titles)) == [("abc", 2, "exact"), ("abcd", 1, "contained")]
    lists = rows([("w", ["a", "a", "b"]), ("v", ["z"])], "name string, members array<string>")
    facts = rows([("a", 2), ("b", 5)], "k string, n int")
    assert listed(lookups.rolled_up(lists, facts, "name", "members", "k", "n", False)) == [("v", 0), ("w", 9)]
    assert listed(lookups.rolled_up(lists, facts, "name", "members", "k", "n", True)) == [("v", 0), ("w", 7)]
    assert listed(lookups.crossed(rows([("r", "x"), ("r", "x"), ("s", "y")], "r string, c string"), "r", "c", ["x", "y"])) == [("r", 2, 0), ("s", 0, 1)]
    assert [r.name for r in lookups.scored_pick(rows([("b final",), ("a final",), ("c",)], "name string"), "name", [("final", 5)], 40).collect()] == ["a final", "b final"]


def test_best_element(rows):
    frame = rows([("mặt phẳng tọa độ", ["đường thẳng", "mặt phẳng", "mặt phẳng"]), ("khác hẳn", ["đường thẳng"]), ("x", None)], "t string, c array<string>")
    candidates = F.transform("c", lambda c: F.named_struct(F.lit("text"), c, F.lit("tokens"), text.tokens(c)))
    got = [r.b for r in frame.select(lookups.best_element(text.tokens(F.col("t")), candidates).alias("b")).collect()]
    assert got[0].text == "mặt phẳng" and got[1] is None and got[2] is None


def test_commit_is_repeatable(rows):
    exams = rows([("h", 1, "t"), ("h", 2, "u")], "source_hash string, exam_index int, title string")
    questions = rows([("h", 1, "c1", "part_i", 1, "x"), ("h", 2, "c1", "part_i", 1, "x"), ("h", 2, "c2", "part_i", 2, "y")], "source_hash string, exam_index int, source_code string, section string, number int, text string")
    stored = exams.where("exam_index = 1")
    made = lookups.commit(exams, questions, stored)
    assert [made[k].count() for k in ("skipped", "sets", "questions", "links")] == [1, 1, 2, 2]
    assert tuple(made["run"].first()) == (1, 2)
    again = lookups.commit(exams, questions, stored, replace=True)
    assert [again[k].count() for k in ("skipped", "sets", "questions", "links")] == [0, 2, 2, 3]
    assert listed(again["sets"], "set_id") == listed(lookups.commit(exams, questions, stored, replace=True)["sets"], "set_id")


def test_containment_agrees_with_brute_force(rows):
    import random

    rng = random.Random(4)
    wholes = ["".join(rng.choices("abc ", k=rng.randrange(0, 14))) for _ in range(60)]
    parts = ["".join(rng.choices("abc ", k=rng.randrange(0, 6))) for _ in range(60)] + ["", "a", "abca", wholes[3]]
    got = {tuple(r) for r in lookups.containing(rows([(p,) for p in parts], "p string"), "p", rows([(w,) for w in set(wholes)], "w string"), "w").collect()}
    assert got == {(p, w) for p in parts for w in wholes if p and p in w}


def test_blanks_and_hints(rows):
    from quernstone.operators import parse, providers

    assert one(rows, "the (3) and (12) ____", items.blank_number) == 12 and one(rows, "none", items.blank_number) is None
    assert one(rows, "ab (7) cd (7) ef", lambda c: items.blank_context(c, F.lit(7), 3, 5)) == "cd (7) e"
    assert tuple(one(rows, "short (1)", lambda c: items.cloze(c, F.lit(None).cast("string")))) == ("short (1)", None)
    assert [one(rows, m, providers.wait_seconds) for m in ("reset after 1h 2m 3s", "Reset after 40s", "reset after 2m", "busy", None)] == [3733, 50, 130, 30, 30]
    assert [one(rows, m, providers.is_retryable) for m in ("HTTP 429", "read timed out", "bad request", None)] == [True, True, False, False]
    assert [one(rows, t, parse.chosen_letter) for t in ("Vậy chọn đáp án C.", "Choose b", "none", None)] == ["C", "B", None, None]
    assert one(rows, "Câu 1: a\nCâu 12: bc\nCâu 2: d", lambda c: parse.one_chunk(c, F.lit(2))) == "d"


def test_exam_items_of_a_text(rows):
    from quernstone.operators import parse

    frame = rows([("e", "Câu 9: before\nPHẦN I\nintro\nCâu 1: a\nA. x\nCâu 2. b\nphần iii\nQuestion 1) c"), ("n", None), ("m", "")], "k string, t string")
    got = sorted((r.part or "", r.number, r.body.strip()) for r in parse.exam_items(frame, "t", "k").collect())
    assert got == [("", 9, "before"), ("I", 1, "a\nA. x"), ("I", 2, "b"), ("III", 1, "c")]


def test_incremental_state(rows):
    from quernstone.streaming import incremental

    old = rows([("a", "ok"), ("b", "failed"), ("b", "failed"), ("c", "failed")], "k string, s string")
    again = incremental.rerun(old, rows([("b", "ok"), ("a", "changed")], "k string, s string"), "k", "s = 'failed'")
    assert listed(again) == [("a", "ok"), ("b", "ok"), ("c", "failed")]
    assert [tuple(incremental.gated(f, "s = 'failed'", force).first()) for f, force in ((old, False), (old, True), (old.where("s = 'ok'"), False), (old.where("s = 'failed'"), True), (old.limit(0), False))] == [
        ("completed_with_errors", 1, 3, 0), ("completed_with_errors", 1, 3, 1), ("completed", 1, 0, 1), ("failed", 0, 3, 0), ("completed", 0, 0, 0),
    ]
    new = rows([("a", "ok"), ("c", "x"), ("z", None)], "k string, s string")
    assert listed(incremental.applied(rows([("a", "ok"), ("c", None)], "k string, s string"), new, "k", ["s"], False)) == [("c", "would update", "x"), ("z", "would insert", None)]
