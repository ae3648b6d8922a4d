from quernstone.llm import splits


def union_find(nodes, ties):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in ties:
        if a and b:
            up.setdefault(a, a), up.setdefault(b, b)
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {n: root(n) for n in up}


def test_components_agree_with_union_find(spark, rows):
    nodes = [f"n{k:03}" for k in range(120)]
    chain = [(nodes[k], nodes[k + 1]) for k in range(40, 80)]  # long chain
    star = [("n000", n) for n in nodes[1:20]]
    ties = chain + star + [("n100", "n101"), ("n101", "n100"), ("n102", "n102"), (None, "n103"), ("z", "n104")]
    got = {r.node: r.component for r in splits.components(rows([(n,) for n in nodes], "node string"), rows(ties, "a string, b string")).collect()}
    assert got == union_find(nodes, ties)
    assert splits.components(rows([], "node string"), rows([], "a string, b string")).count() == 0


def test_splits_keep_components_whole_and_near_their_shares(spark, rows):
    nodes = [(f"n{k:04}", 1) for k in range(2000)]
    ties = [(f"n{k:04}", f"n{k + 1:04}") for k in range(0, 1000, 2)]
    targets = rows([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, target_share double")
    table = splits.update_components(rows(nodes, "node string, size int"), rows(ties, "a string, b string"), targets)
    got = {r.node: (r.component, r.split) for r in table.collect()}
    assert len(got) == 2000 and all(got[a][1] == got[b][1] for a, b in ties)
    counts = [sum(s == name for _, s in got.values()) / 2000 for name in ("train", "validation", "test")]
    assert abs(counts[0] - 0.8) < 0.03 and abs(counts[1] - 0.1) < 0.03 and abs(counts[2] - 0.1) < 0.03


def test_later_runs_keep_splits_and_quarantine_conflicts(spark, rows):
    targets = rows([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, target_share double")
    existing = rows([("a", 1, "a", "train", None), ("b", 1, "b", "test", None), ("c", 1, "c", "train", None), ("x", 1, "x", "test", None)], "node string, size long, component string, split string, old_split string")
    table = splits.update_components(rows([("d", 1), ("e", 1), ("f", 1), ("x", 4)], "node string, size int"), rows([("a", "d"), ("d", "b"), ("c", "e")], "a string, b string"), targets, existing)
    got = {r.node: r for r in table.collect()}
    assert {got[n].split for n in "abd"} == {splits.QUARANTINE} and got["c"].split == got["e"].split == "train" and got["f"].split in ("train", "validation", "test")
    assert (got["a"].old_split, got["b"].old_split, got["d"].old_split, got["c"].old_split) == ("train", "test", None, None)
    assert {got[n].component for n in "abd"} == {"a"} and got["e"].component == "c" and got["x"].size == 5 and got["x"].split == "test"
    # a quarantined component stays so, and what grows into it is quarantined with it
    again = splits.update_components(rows([("g", 1)], "node string, size int"), rows([("g", "d"), ("g", "x")], "a string, b string"), targets, table)
    got = {r.node: r for r in again.collect()}
    assert {got[n].split for n in "abdgx"} == {splits.QUARANTINE} and (got["a"].old_split, got["x"].old_split, got["g"].old_split) == ("train", "test", None)


def test_batches_make_the_components_of_one_run(spark, rows, tmp_path):
    import random

    rng = random.Random(11)
    targets = rows([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, target_share double")
    path, nodes, ties, before = f"file://{tmp_path}/components", [], [], {}
    for batch in range(4):
        new = [f"n{rng.randrange(10**6):06}" for _ in range(80)]
        nodes += new
        fresh = [(rng.choice(nodes), rng.choice(new)) for _ in range(30)]
        ties += fresh
        got = splits.add_batch(spark, path, rows([(n, 1) for n in new], "node string, size int"), rows(fresh, "a string, b string"), targets)
        table = {r.node: r for r in got.collect()}
        assert {n: r.component for n, r in table.items()} == union_find(nodes, ties)
        for n, r in before.items():  # nobody moves between splits
            assert table[n].split == r.split or table[n].split == splits.QUARANTINE and table[n].old_split == r.split
        before = table
    _, version = splits.load_components(spark, path)
    assert version == 4 and splits.load_components(spark, path + "-none") == (None, 0)
    empty = splits.add_batch(spark, path, rows([], "node string, size int"), rows([], "a string, b string"), targets)
    assert sorted(empty.collect()) == sorted(before.values())


def test_one_component_of_a_third_of_all_rows(spark, rows):
    targets = rows([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, target_share double")
    table = splits.update_components(rows([("big", 500)] + [(f"n{k}", 1) for k in range(1000)], "node string, size int"), rows([], "a string, b string"), targets)
    assert {r.node: r.split for r in table.collect()}["big"] == "train"


def test_files_with_nulls_and_spellings(spark, rows, listed):
    bank = rows(
        [("1", "A b.pdf", "one two three four"), ("2", "a B.pdf", "five six seven eight"), ("3", "c.pdf", "one two three four"), ("4", None, "one two three four"), ("5", "d.pdf", None), ("5", "d.pdf", None)],
        "question_id string, source_file string, question_text string",
    )
    records, nodes, ties = splits.bank_graph(bank)
    targets = rows([("train", 1.0)], "split_name string, target_share double")
    table = splits.update_components(nodes, ties, targets)
    assert listed(splits.file_pairs(records, table)) == [("A b.pdf", "a B.pdf"), ("A b.pdf", "c.pdf"), ("a B.pdf", "c.pdf")]


def test_two_batches_of_the_bank_are_one_run(spark, root):
    from quernstone.llm import queries

    both = queries.p2_batches(spark, root).collect()
    records, nodes, ties = splits.bank_graph(spark.read.parquet(f"{root}/random_sources_preview.parquet"))
    one = {r.id: r.component for r in records.select("id", "node").distinct().join(splits.components(nodes.select("node"), ties), "node").collect()}
    assert {r.question_id: r.component for r in both} == one and {r.batch for r in both} == {1, 2}
    per = {}
    for r in both:
        per.setdefault(r.component, set()).add(r.split)
    assert all(len(x) == 1 for x in per.values())
    assert all(r.split == splits.QUARANTINE for r in both if r.old_split)
