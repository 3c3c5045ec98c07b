import random
import zlib

import numpy as np

from opinara.llm import packing, tokens


def best_fit_by_piece(lengths, capacity):
    """Bins by plain best-fit decreasing, one piece at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            _, i = min(fits)
            rooms[i] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_plan_is_best_fit():
    rng = random.Random(5)
    for trial in range(60):
        capacity = rng.choice([7, 16, 50, 128])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        runs = packing.plan(counts, capacity)
        used = {}
        for n, rank, first, each, offset in runs:
            later = [r[1] for r in runs if r[0] == n and r[1] > rank]
            for i in range(min(later, default=counts[n]) - rank):
                used.setdefault(first + i // each, []).append((offset + i % each * n, n))
        for places in used.values():
            at = 0
            for offset, n in sorted(places):
                assert offset == at
                at += n
            assert at <= capacity
        assert sum(map(len, used.values())) == len(lengths)
        rooms = sorted(capacity - sum(n for _, n in p) for p in used.values())
        assert rooms == best_fit_by_piece(lengths, capacity)


def test_tree():
    tree = packing.CapacityTree(10)
    assert tree.tightest(0) is None
    for n in (3, 7, 10):
        tree.set(n, True)
    assert [tree.tightest(n) for n in (0, 3, 4, 8, 10)] == [3, 3, 7, 10, 10]
    tree.set(7, False)
    assert tree.tightest(4) == 10


def test_pieces_fill_sequences(odd_docs, spark):
    rows = packing.best_fit(odd_docs, tokens.path(), capacity=64).collect()
    coder = tokens.PieceTokenizer.load(tokens.path())
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    for doc, text in texts.items():
        ids = np.append(coder.whole(text or ""), 0).astype("<u4")
        mine = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in mine] == [
            (i, s, min(64, len(ids) - s)) for i, s in enumerate(range(0, len(ids), 64))
        ]
        assert [r["ids_crc32"] for r in mine] == [zlib.crc32(ids[r["start"] : r["start"] + 64].tobytes()) for r in mine]
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        ends = [o + n for o, n in sorted(places)]
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 64


def test_no_documents(make_docs):
    assert packing.best_fit(make_docs([]), tokens.path()).count() == 0
