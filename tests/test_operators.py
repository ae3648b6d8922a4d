import time

from pyspark.sql import functions as F

from quernstone.functions import tolerant_json
from quernstone.operators import clusters, coverage, dedupe, mapping, parse, quality, rules, selection, sequences
from quernstone.streaming import incremental


def listed(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def test_keep_one_keeps_the_first_in_order(rows):
    frame = rows([("k", 1, "x"), ("k", 2, "y"), ("l", 5, None)], "key string, at int, v string")
    assert listed(dedupe.keep_one(frame, ["key"], F.col("at"))) == [("k", 1, "x"), ("l", 5, None)]
    assert listed(dedupe.keep_one(frame, ["key"], dedupe.descending(F.col("at")))) == [("k", 2, "y"), ("l", 5, None)]
    assert dedupe.keep_one(frame.limit(0), ["key"], F.col("at")).count() == 0


def test_duplicates_and_violations(rows):
    frame = rows([("a", 1), ("a", 2), ("b", 3)], "key string, id int")
    assert listed(dedupe.duplicates(frame, ["key"], "id")) == [("a", 2, 1, 1)]
    assert listed(dedupe.violations(frame, ["key"])) == [("a", 2)]


def test_overlay_fills_and_appends(rows):
    base = rows([("a", None), ("a", "x"), ("b", "y")], "k string, v string")
    old = rows([("a", "o"), ("c", "p")], "k string, v string")
    assert listed(dedupe.overlay(base, old, ["k"], ["v"])) == [("a", "o", "filled"), ("a", "x", "base"), ("b", "y", "base"), ("c", "p", "old")]


def test_replace_partition_and_upsert(rows):
    base = rows([("p", 1), ("p", 2), ("q", 3)], "part string, id int")
    new = rows([("p", 9), ("p", 9)], "part string, id int")
    assert listed(dedupe.replace_partition(base, new, "part", ["part", "id"], F.col("id"))) == [("p", 9), ("q", 3)]
    assert listed(dedupe.upsert(base, rows([("z", 1)], "part string, id int"), ["id"]), "part", "id") == [("p", 2), ("q", 3), ("z", 1)]


def test_changes_compare_nulls_as_values(rows):
    old = rows([(1, None), (2, "a"), (3, "b")], "id int, v string")
    new = rows([(1, None), (2, None), (4, "c")], "id int, v string")
    assert listed(dedupe.changes(old, new, "id", ["v"])) == [("added", "*", 1), ("changed", "v", 1), ("removed", "*", 1), ("unchanged", "*", 1)]


def test_gate_keeps_the_order_of_reasons(rows):
    gated = quality.gate(rows([("x",), (None,)], "t string"), [("short", F.length(F.coalesce("t", F.lit(""))) < 5), ("null", F.col("t").isNull())], ["null"])
    assert [(r.reason_text, r.accepted) for r in gated.collect()] == [("short", True), ("short; null", False)]
    assert listed(quality.histogram(gated)) == [("null", 1), ("short", 2)]


def test_samples_are_bounded(rows):
    frame = rows([(i, ["a"]) for i in range(100)], "id int, issues array<string>")
    assert [r.id for r in quality.samples(frame, "id", 3).orderBy("k").collect()] == [0, 1, 2]


def test_coverage_has_zero_rows(rows):
    covered = coverage.coverage(rows([("a",), ("b",), ("c",)], "k string"), rows([("a",)] * 3 + [("b",)], "k string"), "k", 3)
    assert listed(covered) == [("a", 3, 0, "ok"), ("b", 1, 2, "low"), ("c", 0, 3, "zero")]
    assert coverage.backfill(covered, "k", "gen").count() == 5


def test_first_and_last_rule(rows):
    order = [("a", "first"), ("b", "second")]
    frame = rows([("ab",), ("c",), (None,)], "t string")
    got = frame.select(rules.first_match(F.col("t"), order).alias("f"), rules.last_match(F.col("t"), order, "none").alias("l"), rules.all_matches(F.col("t"), order).alias("a"))
    assert [tuple(r) for r in got.collect()] == [("first", "second", ["first", "second"]), (None, "none", []), (None, "none", [])]


def test_best_by_tokens_prefers_the_least_unit_in_a_tie(rows):
    items = rows([("i", ["a", "b"]), ("j", ["z"])], "item string, tokens array<string>")
    units = rows([(2, ["a", "b"]), (1, ["a", "b"]), (3, ["a"])], "unit int, tokens array<string>")
    assert listed(mapping.best_by_tokens(items, units)) == [("i", 1, 1.0)]


def test_sequences(rows):
    frame = rows([("f", 1, "x"), ("f", 3, None), ("f", 7, "y"), ("g", 2, None)], "f string, n int, v string")
    assert listed(sequences.spans(frame, ["f"], "n", F.lit(9)), "n", "span_end") == [(1, 2), (2, 9), (3, 6), (7, 9)]
    assert listed(sequences.carried_forward(frame, ["f"], ["n"], "v", "c"), "n", "c")[0] == (1, "x")
    assert listed(sequences.carried_forward(frame, ["f"], ["n"], "v", "c").where("n = 3"), "c") == [("x",)]
    assert listed(sequences.sections(frame, ["f"], ["n"], F.col("v").isNotNull()), "n", "section_no") == [(1, 1), (2, 0), (3, 1), (7, 2)]
    assert listed(sequences.gaps(frame.withColumn("last", F.lit(4)), "f", "n", "last")) == [("f", 2), ("f", 4), ("g", 1), ("g", 3), ("g", 4)]
    assert listed(sequences.within_budget(frame, ["f"], ["n"], F.col("n"), 4), "n") == [(1,), (2,), (3,)]
    assert listed(sequences.unique_codes(frame, "f", ["n"]), "unique_code") == [("f",), ("f-2",), ("f-3",), ("g",)]


def test_as_of_takes_the_last_marker_at_or_before(rows):
    points = rows([("u", 1, "p"), ("u", 5, "q"), ("v", 5, "r")], "u string, t int, id string")
    marks = rows([("u", 2, "m"), ("u", 5, "n")], "u string, t int, v string")
    assert sequences.as_of(points, marks, "u", "t", "v").columns == ["u", "t", "id", "asof_v"]
    got = {r.id: r.asof_v for r in sequences.as_of(points, marks, "u", "t", "v").collect()}
    assert got == {"p": None, "q": "n", "r": None}


def test_range_join_agrees_with_all_pairs(rows):
    points = [("f", k) for k in range(60)]
    ranges = [("f", 3, 40, "a"), ("f", 20, 25, "b"), ("f", 41, 41, "c")]
    got = {r.n: r.name for r in sequences.in_range(rows(points, "f string, n int"), rows(ranges, "f string, s int, e int, name string"), "f", "n", "s", "e", "name").collect()}
    meant = {n: min(((s, name) for _, s, e, name in ranges if s <= n <= e), default=(0, None))[1] for _, n in points}
    assert got == meant


def test_selection_is_reproducible(rows):
    frame = rows([(k % 3, k, k % 2 == 0) for k in range(60)], "g int, id int, want boolean")
    first = listed(selection.stratified(frame, "g", "id", F.col("want"), 4, "s"), "g", "id", "k")
    assert first == listed(selection.stratified(frame.repartition(7), "g", "id", F.col("want"), 4, "s"), "g", "id", "k")
    assert all(i % 2 == 0 for _, i, _ in first)
    assert [r.g for r in selection.diverse(frame, "g", F.col("want"), "id", 4).collect()] == [0, 1, 2, 0]


def test_parsers(rows):
    block = "Question text\nmore\nA. 1 .\nB) two\n\nC: 3"
    frame = rows([(1, block), (2, None), (3, "")], "id int, t string")
    assert listed(parse.option_lines(frame, "t", "id")) == [(1, 3, "A", "1 ."), (1, 4, "B", "two"), (1, 6, "C", "3")]
    assert frame.where("id = 1").select(parse.stem(F.col("t")).alias("s")).first().s == "Question text more"
    key = rows([("1. A 2-B 3C 4.D 5) A 1.C",), ("1.A",), (None,)], "t string").select(parse.answer_key(F.col("t")).alias("k"))
    assert [r.k for r in key.collect()] == [{1: "C", 2: "B", 3: "C", 4: "D", 5: "A"}, None, None]
    coded = rows([(1, "x [IT123456] first block here [IT654321] tiny")], "id int, t string")
    assert listed(parse.coded_blocks(coded, "t", "id", least=20)) == [(1, 1, "[IT123456]", "[IT123456] first block here")]


def test_segments_share_their_context(rows):
    text = "Read the following passage. ABC\nQuestion 1. first\nQuestion 2. second\nRead the following text. DEF\nQuestion 3. third"
    got = [tuple(r) for r in parse.question_segments(rows([(1, text), (2, None), (3, "nothing")], "id int, t string"), "id", "t").collect()]
    assert got == [
        (1, 1, "Read the following passage. ABC", 1, "first"),
        (1, 1, "Read the following passage. ABC", 2, "second"),
        (1, 2, "Read the following text. DEF", 3, "third"),
    ]


def test_tolerant_json():
    objects = tolerant_json.objects
    assert objects('```json\n{"a": 1}\n```') == ([{"a": 1}], False)
    assert objects('{"a": 1,}') == ([{"a": 1}], False)
    assert objects("{'a': True, b: None}") == ([{"a": True, "b": None}], False)
    assert objects(r'{"f": "\dfrac{1}{2}"}')[0] == [{"f": r"\dfrac{1}{2}"}]
    assert objects('{"a": 1} {"b": "}"}') == ([{"a": 1}, {"b": "}"}], False)
    assert objects('{"a": 1} {"b": "cut') == ([{"a": 1}], True)
    assert objects("") == objects(None) == ([], False)


def test_exploded_objects_keep_every_row(rows):
    got = listed(tolerant_json.explode_objects(rows([("x", '{"b":1}{"a":2}'), ("y", None)], "id string, t string"), "id", "t").select("id", F.coalesce("ordinal", F.lit(0)).alias("n"), F.coalesce("object", F.lit("")).alias("o")))
    assert got == [("x", 1, '{"b":1}'), ("x", 2, '{"a":2}'), ("y", 0, "")]


def test_greedy_clusters_depend_on_order_only(rows):
    frame = rows([("g", 1, ["a", "b"]), ("g", 2, ["b", "c"]), ("g", 3, ["c", "d"]), ("g", 4, ["z"]), ("h", 5, None)], "grp string, id int, words array<string>")
    got = {r.id: r.unit for r in clusters.greedy(frame.repartition(3), "grp", "id", "words").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 2, 5: 1}


def test_stream_equals_batch(spark, rows, tmp_path):
    data = rows([(k, f"t{k % 4}") for k in range(12)] + [(99, None)], "id int, t string")
    data.write.parquet(str(tmp_path / "in"))
    got = []
    for _ in range(2):  # a second run over the same folder adds nothing
        query = incremental.stream_new_content(spark, str(tmp_path / "in"), "id int, t string", "t", lambda df, n: got.extend(r.sha1 for r in df.collect()), str(tmp_path / "ck"))
        query.awaitTermination(60)
        time.sleep(0.1)
    batch = [r.sha1 for r in incremental.new_content(data, data.limit(0).select(F.lit("").alias("sha1")), "t").collect()]
    assert sorted(got) == sorted(batch) and len(got) == 5
