import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opinara.llm import simple8b, tokens

from .conftest import ODD_TEXTS


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1), st.just(0)), max_size=700))
def test_round_trip(values):
    payload = simple8b.encode(np.array(values, np.uint64))
    assert simple8b.decode(payload).tolist() == values
    assert simple8b.decode(payload, 5, 9).tolist() == values[5:14]


def test_blocks_and_runs():
    values = np.concatenate([np.zeros(10_000, np.uint64), np.arange(10_000, dtype=np.uint64), np.full(3, 2**64 - 1, np.uint64)])
    payload = simple8b.encode(values)
    assert simple8b.decode(payload, 9_990, 3_000).tolist() == values[9_990:12_990].tolist()
    assert len(payload) < 10_000 * 8 / 3
    with pytest.raises(ValueError):
        simple8b.decode(b"xxxx" + payload[4:])


def test_files_equal_tokenizer(spark, odd_docs, tmp_path):
    simple8b.write(odd_docs, str(tmp_path / "ids"), tokens.path(), end_id=1)
    rows = simple8b.read(spark, str(tmp_path / "ids")).orderBy("doc_id").collect()
    coder, at = tokens.PieceTokenizer.load(tokens.path()), 0
    for row, text in zip(rows, ODD_TEXTS, strict=True):
        ids = np.append(coder.whole(text or ""), 1).astype("<u4")
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_empty_and_repeated(spark, make_docs, tmp_path):
    simple8b.write(make_docs([]), str(tmp_path / "none"), tokens.path())
    assert simple8b.read(spark, str(tmp_path / "none")).count() == 0
    simple8b.write(make_docs([(1, "b"), (1, "a"), (None, "x"), (0, None)]), str(tmp_path / "some"), tokens.path())
    rows = simple8b.read(spark, str(tmp_path / "some")).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 0, 1, 1]
    assert [r["start"] for r in rows] == [0, 2, 3, 5]


def test_each_letter_is_coded_as_by_the_tokenizer():
    coder = tokens.PieceTokenizer.load(tokens.path())
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}" for c in [*range(0x260), 0x301, 0x3A3, 0x4E00]]
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == coder.whole(text).tolist(), text


@pytest.mark.parametrize("limit", [3, 10, 1000])
def test_ragged_cache_gives_what_was_made(limit):
    from opinara.llm.wordcache import RaggedCache

    cache, rng = RaggedCache(limit), np.random.default_rng(limit)
    for _ in range(60):
        hashes = np.unique(rng.integers(0, 30, 8).astype(np.uint64))
        sizes, flat = cache.get(hashes, lambda new: [[int(hashes[i])] * int(hashes[i] % 4) for i in new])
        assert sizes.tolist() == [int(h % 4) for h in hashes]
        assert flat.tolist() == [int(h) for h in hashes for _ in range(int(h % 4))]
        assert len(cache.hashes) <= max(limit, limit // 2 + 16)


def test_a_small_cache_changes_no_ids(monkeypatch, odd_docs):
    coder = tokens.PieceTokenizer(tokens.path())
    coder.known = tokens.RaggedCache(2)
    texts = [t or "" for t in ODD_TEXTS]
    for _ in range(2):
        assert [x.tolist() for x in coder.encode(texts)] == [coder.whole(t).tolist() for t in texts]
