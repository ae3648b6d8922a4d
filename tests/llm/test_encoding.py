import random
import sys

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quernstone.llm import encoding

WORDS = encoding.vocabulary(encoding.vocabulary_path())
#: The library is only the check: the package doesn't use it.
LIBRARY = tiktoken.Encoding("check", pat_str=encoding.PATTERN, mergeable_ranks=WORDS.ranks, special_tokens={})


@pytest.fixture(scope="module")
def words():
    return WORDS


def fed(text, size):
    stream, ids = encoding.Encoder(WORDS), []
    for k in range(0, len(text), size):
        ids += stream.feed(text[k : k + size])
    return ids + stream.finish()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200) | st.text(alphabet="'slvret \n12!", max_size=80))
def test_blocks_give_the_ids_of_the_library(text):
    ids = LIBRARY.encode_ordinary(text)
    assert encoding.encode(text, WORDS) == ids
    for size in (1, 3, 7):
        assert fed(text, size) == ids
    decoder = encoding.Decoder(WORDS)
    assert "".join([decoder.feed([i]) for i in ids] + [decoder.finish()]) == text


def test_long_pieces_are_streamed_exactly_in_bounded_memory(words):
    rng = random.Random(3)
    for text in ("a" * 9000, "".join(rng.choice("abcdeêộn") for _ in range(6000)), "=" * 7000, "đ" * 5000, " " * 5000 + "x", "\n" * 4000, " " * 4001 + "!" * 3000 + "'s"):
        for size in (1, 500, 1 << 16):
            stream, ids, held, early = encoding.Encoder(words), [], 0, 0
            for k in range(0, len(text), size):
                ids += stream.feed(text[k : k + size])
                early = max(early, len(ids))
                held = max(held, len(stream.rest) + (len(stream.open.last) if stream.open else 0))
            ids += stream.finish()
            assert ids == LIBRARY.encode_ordinary(text)
            assert early > 0 and held <= encoding.LONG + 6 * words.longest + size


def test_memory_stays_flat_on_a_text_without_white_space(words):
    """A million characters without a break: what the transducer keeps doesn't grow."""
    rng = random.Random(5)
    block = "".join(rng.choice("abcdeghinotu") for _ in range(1 << 14))
    stream, held, n = encoding.Encoder(words), [], 0
    for _ in range(64):
        n += len(stream.feed(block))
        held.append(len(stream.open.last) + len(stream.open.tail) + len(stream.rest) if stream.open else 0)
    assert n > 64 * len(block) / 8 and max(held) < 8 * words.longest and sys.getsizeof(stream.open.tail) < 4096


def test_the_merges_make_every_token_and_bound_the_lookahead(words):
    rng = random.Random(6)
    some = rng.sample(sorted(words.ranks), 3000)
    assert all(words.merged(token) == [words.ranks[token]] for token in some)
    assert 0 < words.lookahead < words.longest
    assert all(words.ends[token] == rank for token, rank in words.ranks.items())


def test_every_text_of_the_table_goes_through_the_transducer(root, monkeypatch):
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table(f"{root}/documents.parquet")["text"].to_pylist() if t]
    fresh, seen = encoding.Vocabulary(encoding.vocabulary_path()), []
    feed = encoding.PieceTransducer.feed
    monkeypatch.setattr(encoding.PieceTransducer, "feed", lambda self, data: seen.append(data) or feed(self, data))
    for text in texts:
        assert encoding.encode(text, fresh) == LIBRARY.encode_ordinary(text)
        assert all(piece in fresh._ids or len(piece) > encoding.SHORT for piece in fresh.split(text))  # each came out of the transducer once
    assert len(seen) >= len(fresh._ids) > 0


def test_whole_texts(words):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcđêộ,.") for _ in range(rng.randrange(1, 9))) for _ in range(40_000))
    assert encoding.encode(text, words) == LIBRARY.encode_ordinary(text)
    assert encoding.n_tokens(text, words) == len(LIBRARY.encode_ordinary(text))


def test_operator(rows, words):
    frame = rows([(1, "Xin chào <|endoftext|>", 5), (2, "", 6), (3, None, 7), (4, " \n", 8)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in encoding.with_ids(frame).collect()}
    assert got[2].ids == [] and got[3].ids == [] and got[4].ids and got[1].n_chars == 5 and 50256 not in got[1].ids
    assert encoding.Decoder(words).feed(got[1].ids) == "Xin chào <|endoftext|>"
    counts = {r.doc_id: r.n for r in encoding.with_ids(frame, into="n", count_only=True).collect()}
    assert counts == {k: len(r.ids) for k, r in got.items()}
    assert encoding.with_ids(frame.where(F.lit(False))).count() == 0
