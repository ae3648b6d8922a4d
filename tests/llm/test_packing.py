from collections import Counter

from quernstone.llm import encoding, packing


def check(rows_, documents, capacity):
    words = encoding.vocabulary(encoding.vocabulary_path())
    sizes = {k: len(encoding.encode(t, words)) for k, t in documents.items()}
    load, seen = Counter(), {}
    for r in rows_:
        seen.setdefault(r.doc_id, []).append((r.first_token, r.n_tokens))
        if r.container is not None:
            load[r.container] += r.n_tokens
    assert max(load.values(), default=0) <= capacity
    for k, size in sizes.items():
        parts = sorted(seen[k])
        assert sum(n for _, n in parts) == size and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
        assert len(parts) == 1 or size > capacity  # never split without need
    return load


def test_every_token_once_and_full_containers(spark, rows):
    import random

    rng = random.Random(6)
    topics = [[f"{t}word{k}" for k in range(40)] for t in "abc"]
    documents = {k: " ".join(rng.choices(topics[k % 3], k=rng.choice([3, 10, 25, 60]))) for k in range(400)}
    documents |= {900: None, 901: "", 902: " ".join(topics[0]) * 12}
    frame = rows([(k, t, "x") for k, t in documents.items()] * 2, "doc_id long, text string, container string")
    out = packing.pack(frame, capacity=300, shard=150).collect()
    load = check(out, documents, 300)
    assert sum(load.values()) / (300 * len(load)) > 0.95
    assert {r.container for r in out if r.doc_id in (900, 901)} == {None}


def test_neighbours_share_words(spark, rows):
    documents = {k: f"{'apple pear plum' if k % 2 else 'engine wheel brake'} " * 8 for k in range(20)}
    out = packing.pack(rows(list(documents.items()), "doc_id long, text string"), capacity=128).collect()
    groups = {}
    for r in out:
        groups.setdefault(r.container, set()).add(r.doc_id % 2)
    assert sum(len(g) == 1 for g in groups.values()) >= len(groups) - 1


def test_empty(spark, rows):
    assert packing.pack(rows([], "doc_id long, text string")).count() == 0


def test_windows_hold_related_texts(spark, rows):
    """Words in common of two texts of one window, against two texts of any windows."""
    import random

    rng = random.Random(8)
    topics = [[f"topic{t}word{k}" for k in range(30)] for t in range(12)]
    common = [f"common{k}" for k in range(15)]
    documents = {k: " ".join(rng.choices(topics[k % 12], k=14) + rng.choices(common, k=6)) for k in range(960)}
    out = packing.pack(rows(list(documents.items()), "doc_id long, text string"), capacity=512, shard=120).collect()
    check(out, documents, 512)
    groups = {}
    for r in out:
        groups.setdefault(r.container, []).append(set(documents[r.doc_id].split()))

    def shared(pairs):
        return sum(len(a & b) / len(a | b) for a, b in pairs) / len(pairs)

    inside = [(g[0], g[k]) for g in groups.values() for k in range(1, len(g))]
    every = [s for g in groups.values() for s in g]
    anywhere = [rng.sample(every, 2) for _ in range(2000)]
    assert shared(inside) > 2 * shared(anywhere)


def test_copies_are_no_hot_shard(spark, rows):
    from pyspark.sql import functions as F

    pieces = rows([(k, 5, 7) for k in range(3000)] + [(3000 + k, k % 40, k % 7) for k in range(2000)], "doc_id long, first int, second int")
    dealt = packing._dealt(pieces, 100)
    assert dealt.count() == 5000
    assert dealt.groupBy("shard", "part").count().agg(F.max("count")).first()[0] <= 300
    documents = {k: "the same words in every copy" for k in range(500)}
    check(packing.pack(rows(list(documents.items()), "doc_id long, text string"), capacity=64, shard=50).collect(), documents, 64)
