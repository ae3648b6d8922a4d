import duckdb
from pyspark.sql import functions as F

from quernstone.operators import documents, linking, providers, sequences
from quernstone.plans import catalog


def listed(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def test_narrowing_is_soft(rows):
    pairs = rows([("q", 1, True, False), ("q", 2, False, True), ("r", 3, False, None), ("r", 3, False, None)], "q string, n int, a boolean, b boolean")
    assert listed(linking.narrowed(pairs, "q", "n", [F.col("a"), F.col("b")], 5)) == [("q", [1]), ("r", [3])]


def most_rows(plan):
    """The most rows that an operator of a plan that has run gave."""
    kind = plan.getClass().getSimpleName()
    inner = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else []
    children = plan.children()
    metric = plan.metrics().get("numOutputRows")
    return max([metric.get().value() if metric.isDefined() else 0, *map(most_rows, inner), *(most_rows(children.apply(k)) for k in range(children.size()))])


def test_lessons_of_one_subtopic_are_not_paired_with_its_questions(spark, rows, tmp_path):
    root, n = str(tmp_path), 400
    asked = [(f"q{k}", f"s{k % 2}", 1 + k % 3) for k in range(n)] + [("q0", "s1", 9), ("q1", "s9", 0), ("q2", None, 0), ("q4", "s3", 0)]
    rows(asked, "id string, subtopic string, t int").withColumn("created_at", F.timestamp_seconds("t")).drop("t").write.parquet(f"{root}/standard_exam_questions.parquet")
    taught = [(k, (["s0", "s0"] if k % 2 else ["s1", "s0", None], "practice" if k % 7 == 6 else None, "core" if k % 5 == 0 else "exam"), k) for k in range(n)]
    taught += [(0, (["s3"], "practice", "core"), n), (n, None, 1), (n + 1, (["s3"], "theory", "core"), 1), (n + 2, (["s3"], "theory", None), 1)]
    schema = "lesson_id bigint, analysis struct<concepts: array<string>, lesson_type: string, phase: string>, t int"
    rows(taught, schema).withColumn("scanned_at", F.timestamp_seconds("t")).drop("t").write.parquet(f"{root}/curriculum_scan.parquet")
    got = catalog.queries()["exam_lesson_links"](spark, root)
    answer = listed(got, "id", "lessons")
    with duckdb.connect() as sql:
        for name in ("standard_exam_questions", "curriculum_scan"):
            sql.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet/*.parquet'")
        assert answer == sorted(sql.sql(catalog.oracle_sql()["exam_lesson_links"]).fetchall())
    assert len(answer) == n - 2 and dict(answer)["q0"] == "20,55,90,125,160" and dict(answer)["q4"] == str(n + 1)
    assert most_rows(got._jdf.queryExecution().executedPlan()) <= 3 * len(taught)


def test_required_moved_numbered(rows):
    assert listed(linking.required_but_missing(rows([("s", "a"), ("s", "b")], "s string, v string"), rows([("s", "a")], "s string, v string"), "s", "v")) == [("s", "b")]
    assert listed(linking.moved(rows([(1, "x"), (2, "y")], "m int, u string"), rows([(1, "y")], "m int, u string"), "m", "u")) == [(1, "y"), (2, "y")]
    assert listed(sequences.renumbered(rows([("b",), ("a",)], "u string"), ["u"])) == [("a", 1), ("b", 2)]
    passages = rows([("f", "p", 1, "x"), ("f", "p", 2, None), ("f", "p", 3, "xyz"), ("f", None, 4, None), ("g", None, 1, None), ("g", "q", 2, None), ("g", "r", 3, "r"), ("g", "q", 4, None)], "f string, g string, o int, t string")
    assert listed(linking.filled(passages, ["f"], "g", "o", "t"), "f", "o", "t") == [
        ("f", 1, "x"), ("f", 2, "xyz"), ("f", 3, "xyz"), ("f", 4, "xyz"), ("g", 1, None), ("g", 2, None), ("g", 3, "r"), ("g", 4, "r"),
    ]
    assert listed(linking.contiguous(rows([("g", 2), ("g", 2), ("g", 4), ("h", 1)], "g string, n int"), "g", "n")) == [("g", "does not start at 1"), ("g", "has gaps"), ("g", "has repetitions")]


def test_key_lines_and_compaction(rows):
    frame = rows([(1, "plain\n# head\nplain\n\nsecond"), (2, None)], "d int, t string")
    assert [r.line for r in documents.key_lines(frame, "d", "t", "^#", 2).orderBy("k").collect()] == ["# head", "plain"]
    pages = rows([(1, k, f"p{k}") for k in range(1, 9)] + [(2, 1, "only")], "d int, page int, t string")
    got = {r.d: r.text for r in documents.compacted(pages, "d", "page", "t", 6).collect()}
    assert got == {1: "p1\np2\np3\np7\np8", 2: "only"}


def test_tables_formulas_questions(rows):
    frame = rows([(1, "| a | b |\n|---|:-:|\n| 1 | |\ntext"), (2, None)], "d int, t string")
    assert listed(documents.markdown_rows(frame, "t", "d")) == [(1, 1, ["a", "b"]), (1, 3, ["1", ""])]
    assert rows([("x $a$ y $b c$ $",)], "t string").select(documents.math_segments(F.col("t")).alias("m")).first().m == ["a", "b c"]
    text = "Câu 1: What?\nA. x\nB. y\nCâu 2. Why?\nA. z\n1A 2B 3C 4D 5A"
    got = [tuple(r) for r in documents.questions(rows([(1, text), (2, None), (3, "none")], "d int, t string"), "t", "d").orderBy("ordinal").collect()]
    assert got == [(1, 1, 1, "What?", ["x", "y"], "A"), (1, 2, 2, "Why?", ["z"], "B")]


def test_issues(rows):
    issues = dict(documents.text_issues(F.col("t"), 10))
    frame = rows([("a",), ("a??",), ("x" * 11,), ("fine",), (None,)], "t string")
    assert [[bool(r[k]) for k in issues] for r in frame.select(*(c.alias(k) for k, c in issues.items())).collect()] == [
        [True, False, False], [False, True, False], [False, False, True], [False] * 3, [False] * 3,
    ]


def test_providers_retry_fall_back_and_cache(rows):
    def flaky(text):
        if text == "bad":
            raise ValueError(text)
        return text.upper()

    frame = rows([(1, "a", "f"), (2, "bad", "f"), (3, "a", "f"), (4, None, "f")], "id int, request string, fallback string")
    got = {r.id: (r.reply, r.status) for r in providers.answered(frame, "id", "request", "fallback", [flaky], tries=2, wait=0).collect()}
    assert got == {1: ("A", "ok"), 2: ("f", "fallback_error"), 3: ("A", "ok"), 4: ("", "ok")}
    second = providers.answered(frame, "id", "request", "fallback", [flaky, lambda text: "second"], tries=1, wait=0)
    assert {r.id: r.reply for r in second.collect()}[2] == "second"
    cache = frame.where("id = 1").select(F.sha1("request").alias("request_sha1"), F.lit("kept").alias("reply"))
    assert {r.id: r.status for r in providers.answered(frame, "id", "request", "fallback", [], cache=cache).collect()} == {1: "cached", 2: "fallback_no_provider", 3: "cached", 4: "fallback_no_provider"}
