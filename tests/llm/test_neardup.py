import random

import numpy as np

from quernstone.llm import neardup


def brute(texts, threshold):
    sets = {k: neardup.word_set(t) for k, t in texts.items() if t is not None and neardup.word_set(t)}
    keys = sorted(sets)
    return [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    texts = {}
    for k in range(n):
        base = rng.sample(words, 60)
        texts[f"d{k:04}"] = " ".join(base)
        if k % 3 == 0:
            copy = base[:]
            for _ in range(rng.randrange(0, 8)):
                copy[rng.randrange(60)] = rng.choice(words)
            rng.shuffle(copy)
            texts[f"e{k:04}"] = " ".join(copy).upper()
    return texts


def test_pairs_agree_with_brute_force(spark, rows, listed):
    texts = corpus(300) | {"n1": None, "n2": "", "n3": "?!", "n4": "w1", "n5": "W1", "n6": "w1"}
    frame = rows([(k, t, 1) for k, t in texts.items()] * 2, "id string, text string, band int")
    got = listed(neardup.record_pairs(*neardup.near_duplicates(frame)))
    assert got == brute(texts, 0.7)
    empty = neardup.record_pairs(*neardup.near_duplicates(frame.limit(0)))
    assert empty.count() == 0 and empty.columns == ["id_a", "id_b"]


def test_hot_nodes_are_joined_in_blocks(spark, rows, listed, monkeypatch):
    monkeypatch.setattr(neardup, "HOT", 8)
    base = [f"w{k}" for k in range(100)]
    texts = {f"h{k:03}": " ".join(base[:k] + ["x%d" % k] + base[k + 1 :]) for k in range(40)}
    frame = rows(list(texts.items()), "id string, text string")
    assert listed(neardup.record_pairs(*neardup.near_duplicates(frame))) == brute(texts, 0.7)


def test_trie_join_finds_all_pairs_within_the_budget():
    rng = np.random.default_rng(5)
    n = 400
    high, low = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
    for k in range(0, n, 4):  # relatives of their neighbour
        flips = rng.integers(0, 64, 12)
        high[k + 1] = high[k] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))
        low[k + 1] = low[k]
    groups = np.sort(rng.integers(0, 3, n))
    order = np.lexsort((low, high, groups))
    groups, high, low = groups[order], high[order], low[order]
    for leaf in (1, 64):
        got = {(int(a), int(b)) for x, y in neardup.trie_self_join(groups, high, low, 20, leaf) for a, b in zip(x, y, strict=True)}
        meant = {
            (a, b) for a in range(n) for b in range(a + 1, n)
            if groups[a] == groups[b] and int(high[a] ^ high[b]).bit_count() + int(low[a] ^ low[b]).bit_count() <= 20
        }
        assert got == meant and len(meant) >= 20


def test_copies_are_one_class(spark, rows):
    members, links = neardup.near_duplicates(rows([(str(k), "the same words here") for k in range(50)], "id string, text string"))
    assert members.select("h1", "h2").distinct().count() == 1 and links.count() == 0


def test_pairs_just_at_the_threshold_are_found(spark, rows, listed):
    """70 of 100 words in common: none may be lost, however many there are."""
    rng = random.Random(7)
    words = [f"w{k}" for k in range(100_000)]
    texts, meant = [], []
    for k in range(2500):
        picked = rng.sample(words, 100)
        texts += [(f"a{k:04}", " ".join(picked[:85])), (f"b{k:04}", " ".join(picked[15:]))]
        meant.append((f"a{k:04}", f"b{k:04}"))
    assert listed(neardup.record_pairs(*neardup.near_duplicates(rows(texts, "id string, text string")))) == meant


def test_fingerprints_drop_no_pair_of_the_threshold():
    rng = np.random.default_rng(3)
    for n in (3, 10, 30, 100, 400):
        for _ in range(200):
            pool = rng.integers(-(1 << 31), 1 << 31, n, dtype=np.int64).astype(np.int32)
            only = n - -(-7 * n // 10)  # words that one of the two has
            cut = int(rng.integers(0, only + 1))
            x, y = pool[cut:], pool[: n - (only - cut)]
            bits = neardup._parities(np.concatenate([x, y]), np.array([0, len(x)]))
            order = np.lexsort((bits[:, 1], bits[:, 0]))
            sizes = np.array([len(x), len(y)])[order]
            found = list(neardup.trie_self_join(np.zeros(2), bits[order, 0], bits[order, 1], 128, sizes=sizes, threshold=0.7))
            assert sum(len(a) for a, _ in found) == 1


def test_whole_groups_keep_no_more_of_a_large_one_than_allowed():
    import numpy as np
    import pyarrow as pa

    keys = np.sort(np.random.default_rng(1).choice([1, 2, 3, 4, 5], 300, p=[0.02, 0.6, 0.03, 0.3, 0.05]))
    for step in (1, 7, 50, 300):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[k : k + step]), pa.array(np.arange(k, min(k + step, 300)))], names=["k", "v"]) for k in range(0, 300, step)]
        small, large = [], {}
        for (band, *rest), n in neardup._whole_groups(iter(batches), 40):
            if n is None:
                small += list(zip(band, rest[0], strict=True))
            else:
                large[int(band[0])] = n
        counts = {int(k): int((keys == k).sum()) for k in np.unique(keys)}
        assert {k: n for k, n in large.items() if k} == {k: counts[k] for k in large} and set(large) <= {k for k, n in counts.items() if n > 40}
        assert sorted(small) == [(k, v) for v, k in enumerate(keys) if k not in large]


def test_pairs_of_large_classes_spread_over_cells(rows, listed, monkeypatch):
    from quernstone.llm import cells

    texts = ["one two three four five six seven eight nine ten"] * 30 + ["one two three four five six seven eight nine eleven"] * 20 + ["other words here"] * 3
    frame = rows([(f"{k:03}", t) for k, t in enumerate(texts)], "id string, text string")
    whole = listed(neardup.record_pairs(*neardup.near_duplicates(frame)))
    monkeypatch.setattr(cells, "HOT", 6)
    monkeypatch.setattr(neardup, "HOT_CLASS", 6)
    assert listed(neardup.record_pairs(*neardup.near_duplicates(frame))) == whole and len(whole) == 50 * 49 // 2 + 3


def sizes_of(members, links):
    by = {}
    for r in members.collect():
        by.setdefault((r.h1, r.h2), []).append(r.id)
    return {tuple(sorted((min(by[a]), min(by[b])))) for a, b in (((r.a1, r.a2), (r.b1, r.b2)) for r in links.collect())}


def test_exact_mode_and_bands_find_what_brute_force_finds(spark, root):
    """All questions of the smallest tables, and pairs made just at and below the threshold."""
    from quernstone.llm import queries

    frame = queries._questions(spark, root)
    rng = random.Random(13)
    made = []
    for k in range(60):
        words = [f"w{rng.randrange(10**9)}" for _ in range(85)]
        made += [(f"x{k:03}", " ".join(words)), (f"y{k:03}", " ".join(words[:70] + [f"v{rng.randrange(10**9)}" for _ in range(15 + (k % 3))]))]
    frame = frame.unionByName(spark.createDataFrame(made, "id string, text string"))
    rows = [(r.id, r.text) for r in frame.distinct().collect() if r.id and r.text]
    sets = {}
    for key, text in rows:
        found = frozenset(neardup.word_set(text))
        if found:
            sets.setdefault(found, []).append(key)
    distinct = sorted(sets, key=lambda s: min(sets[s]))
    meant = set()
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if min(len(a), len(b)) >= 0.7 * max(len(a), len(b)):
                both = len(a & b)
                if both >= 0.7 * (len(a) + len(b) - both) - 1e-12:
                    meant.add(tuple(sorted((min(sets[a]), min(sets[b])))))
    assert len(meant) > 20 and sum(x[0] == "x" for x, _ in meant) == 20
    assert sizes_of(*neardup.near_duplicates(frame, exact=True)) == meant
    assert sizes_of(*neardup.near_duplicates(frame)) == meant
