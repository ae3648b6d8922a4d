import pytest

from quernstone import runtime


@pytest.mark.parametrize("limit,size", [(0, 1 << 20), (1, 1 << 20), (100, 1 << 20), (100, 1)])
def test_one_row_each(rows, monkeypatch, limit, size):
    monkeypatch.setattr(runtime, "FEW_KEYS", limit)
    monkeypatch.setattr(runtime, "FEW_BYTES", size)
    frame = rows([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c"), (3, None)], "k int, t string")
    got = sorted((r.k is None, r.k or 0, r.t) for r in runtime.one_row_each(frame, ["k"]).collect() if r.t is not None or r.k == 3)
    assert [g[1] for g in got] == [1, 2, 3, 0]
    once = rows([(1, "a"), (2, "b")], "k int, t string")
    assert runtime.one_row_each(once, ["k"]) is once
    assert runtime.one_row_each(frame.limit(0), ["k"]).count() == 0


def test_the_least_of_several_rows_is_kept(rows):
    frame = rows([(1, "b", [2]), (1, "a", [3]), (1, "a", [1]), (2, None, None)], "k int, t string, a array<int>")
    got = sorted((r.k, r.t, r.a) for r in runtime.least_row(frame.repartition(3), ["k"]).collect())
    assert got == [(1, "a", [1]), (2, None, None)] and runtime.least_row(frame.select("k"), ["k"]).count() == 2


@pytest.mark.parametrize("missing", ["tiktoken", "xxhash", "regex"])
def test_core_queries_need_no_library_of_the_others(missing):
    import subprocess
    import sys
    from pathlib import Path

    script = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print('QUERIES', sum(n[0] != 'p' for n in q))"
    done = subprocess.run([sys.executable, "-c", script], cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True, timeout=120)
    assert "QUERIES" in done.stdout and int(done.stdout.split()[-1]) > 90, done.stderr[-2000:]


def test_materialized_tables_are_read_back(spark, rows):
    frame = rows([(1, [1, 2])], "a int, b array<int>")
    again = runtime.materialize(frame, "x")
    assert again.schema == frame.schema and again.collect() == frame.collect()
    assert runtime.shared_dir(spark).startswith("file:") and runtime.shuffle_partitions(spark) == 4


def test_workers_need_no_path_to_the_package(tmp_path):
    import os
    import subprocess
    import sys
    from pathlib import Path

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables here")
    repo = str(Path(__file__).resolve().parent.parent)
    script = f"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
import __spark_entry__ as entry
print("ROWS", entry.queries()["qb_provider_boundary"](spark, "/root/testdata/sf0.001").count(), entry.entry(spark).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]
