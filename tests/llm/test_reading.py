from quernstone.llm import reading


def sample(level, k):
    vocabulary = {1: "cat dog ball sun red", 2: "fraction lesson market survey recycle", 3: "derivative argument metaphor logarithm vector", 4: "topology homomorphism epistemic measure manifold"}[level].split()
    return " ".join(vocabulary[(k + j * (j + k)) % 5] for j in range(30)) + f" shared words here {k}"


def test_levels_of_held_out_texts(rows, listed):
    documents = [(level * 100 + k, sample(level, k), "x") for level in reading.LEVELS for k in range(20)]
    labels = [(d, level, "r", None) for d, _, _ in documents for level in [d // 100] if d % 100 < 10]
    labels += [(100, 2, "s", None), (100, 1, "t", None), (None, 1, "r", None), (205, None, "r", None)]
    documents += [(1, None, "x"), (2, "", "x"), (3, "too short", "x"), (119, sample(1, 19), "x"), (999, "neverseen " * 30, "x")]
    frame, judged = rows(documents, "doc_id long, text string, reading_level string"), rows(labels, "doc_id long, reading_level int, rater string, labelled_at timestamp")
    models = reading.train(reading.labelled(frame, judged))
    got = {r.doc_id: r.reading_level for r in reading.with_level(frame, models).collect()}
    assert all(got[d] == d // 100 for d, _, _ in documents if 100 <= d < 900) and not {1, 2, 3} & set(got) and 999 in got


def test_without_labels_no_level(rows):
    frame = rows([(1, "word " * 40)], "doc_id long, text string")
    none = rows([], "doc_id long, reading_level int, rater string, labelled_at timestamp")
    assert reading.with_level(frame, reading.train(reading.labelled(frame, none))).count() == 0


def test_words_are_pieces_with_a_letter():
    assert reading.n_words("a 1 b2 -- ? c") == 3 and reading.n_words(None) == 0
