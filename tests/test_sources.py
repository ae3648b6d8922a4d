import pytest

from quernstone.sources import files, sinks


def test_manifest_in_natural_order(spark, tmp_path):
    for name in ("s/a10.pdf", "s/a2.pdf", "s/x.txt", "t/b/c.PDF"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * len(name))
    found = files.manifest(spark, str(tmp_path))
    assert [(r.source, r.file_name, r.ordinal) for r in found.orderBy("source", "ordinal").collect()] == [("s", "a2.pdf", 1), ("s", "a10.pdf", 2), ("t", "c.PDF", 1)]
    summary = {r.source: (r.n_files, r.n_folders, r.n_bytes) for r in files.manifest_summary(found).collect()}
    assert summary == {"s": (2, 1, 17), "t": (1, 1, 9)}
    assert files.with_content_hash(spark, str(tmp_path), "*.pdf").count() == 2


def test_json_envelopes_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}]')
    (tmp_path / "b.json").write_text('{"questions": [{"id": 2}, {"id": 3}], "total": 2}')
    (tmp_path / "c.json").write_text('{"data": [{"id": 4}]}')
    assert sorted(r.id for r in files.json_rows(spark, str(tmp_path / "*.json"), "id:int").collect()) == [1, 2, 3, 4]
    (tmp_path / "log.jsonl").write_text('{"id": 1}\n\nnot json\n{"id": 2}\n')
    assert sorted(r.id for r in files.json_lines(spark, str(tmp_path / "log.jsonl"), "id int").collect()) == [1, 2]


def test_sinks(spark, rows, tmp_path):
    table = rows([(1, "a"), (2, "b")], "id int, v string")
    sinks.write_envelope(table, str(tmp_path / "env"))
    assert spark.read.json(str(tmp_path / "env/summary")).first().n_rows == 2
    table.write.parquet(str(tmp_path / "base"))
    target = sinks.write_upsert(str(tmp_path / "base"), rows([(2, "c"), (3, "d")], "id int, v string"), ["id"], "v2")
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    for _ in range(2):
        sinks.append_log(table, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4
    sinks.write_partitions(rows([("p", 1), ("q", 2)], "part string, n int"), str(tmp_path / "parts"), "part")
    sinks.write_partitions(rows([("p", 9)], "part string, n int"), str(tmp_path / "parts"), "part")
    assert sorted((r.part, r.n) for r in spark.read.parquet(str(tmp_path / "parts")).collect()) == [("p", 9), ("q", 2)]


def test_tables_of_a_database(spark, rows, monkeypatch):
    """Batches go in, ranges of the key come out, and conditions reach the database."""
    from quernstone.sources import files, sinks

    url, driver = "jdbc:derby:memory:quern;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(driver)
    except Exception:
        pytest.skip("no database driver here")
    frame = rows([(k, k % 3) for k in range(250)], "id int, kind int")
    sinks.insert_batches(frame.where("id < 200"), url, "items", driver=driver)
    sinks.insert_batches(frame.where("id >= 200"), url, "items", driver=driver)
    read = files.database_table(spark, url, "items", "id", 0, 250, 4)
    assert read.count() == 250 and read.rdd.getNumPartitions() == 4
    some = read.where("kind = 1 and id < 30")
    assert "PushedFilters: [*" in some._jdf.queryExecution().executedPlan().toString() and some.count() == 10


def test_settings(spark, tmp_path):
    from quernstone.sources import files

    (tmp_path / "env").write_text("# c = 1\n\nA = 'x y'\nB=\"q=r\"\n =none\nnothing\nA=z\n", encoding="utf-8")
    assert {r.key: r.value for r in files.settings(spark, str(tmp_path / "env")).collect()} == {"A": "z", "B": "q=r"}


def test_manifest_of_a_folder(spark, tmp_path):
    from quernstone.sources import files

    for name in ("s/b10.pdf", "s/b2.PDF", "s/u/c.pdf", "s/n.txt", "t/x.pdf"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    rows = files.manifest(spark, str(tmp_path))
    got = sorted((r.source, r.ordinal, r.relative_path, r.size_bytes) for r in rows.collect())
    assert got == [("s", 1, "s/b2.PDF", 5), ("s", 2, "s/b10.pdf", 5), ("s", 3, "s/u/c.pdf", 5), ("t", 1, "t/x.pdf", 5)]
    assert [(r.file_name, r.k) for r in files.of_folder(rows, "s").orderBy("k").collect()] == [("b10.pdf", 1), ("b2.PDF", 2)]
    assert {(r.source, r.n_files, r.n_folders, r.n_bytes) for r in files.manifest_summary(rows).collect()} == {("s", 3, 2, 15), ("t", 1, 1, 5)}
