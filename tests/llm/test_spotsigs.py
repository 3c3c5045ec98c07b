import hashlib
import itertools
import random

import numpy as np
import pytest

from opinara.llm import spotsigs as S

from .conftest import ODD_TEXTS


def edited_texts(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (-r[0], r[1]))
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        k = len(text) // 3
        yield doc, text, text[: len(text) - k] + following[:k], following


@pytest.mark.parametrize("n", [1, 2, 9, 60])
def test_edits_and_likeness(make_docs, n):
    rng = random.Random(n)
    words = [*S.ANCHORS[:10], *(f"w{i}é😀" for i in range(300))]
    rows = [(rng.randrange(10**6) * 7, " ".join(rng.choice(words) for _ in range(rng.randrange(200)))) for _ in range(n)]
    got = {(r["doc_id"], r["n_chars"]): r for r in S.fingerprint_edits(make_docs(rows)).collect()}
    assert len(got) == n
    for doc, text, edited, following in edited_texts(rows):
        r = got[doc, len(text)]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, other, nxt = S.signatures([text, edited, following])
        assert (r["fingerprint"], r["edited_fingerprint"]) == (S.as_text(own), S.as_text(other))
        assert r["near_edited"] == S.jaccard(own, other) and r["near_next"] == S.jaccard(own, nxt)
        if len(text) > 400 and n > 2:
            assert r["near_edited"] > 0.3 > r["near_next"]


def test_signatures_by_hand():
    a, b = S.signatures(["The quick brown fox jumps", "of THE quick, brown fox ..."])
    assert len(np.intersect1d(a, b)) == 1  # the + quick brown fox
    assert S.signatures(["", "  ", "!"]) == [pytest.approx([])] * 3 or [len(x) for x in S.signatures(["", "  ", "!"])] == [0, 0, 0]
    assert len(S.signatures(["one two"])[0]) == 1
    long = S.signatures([" ".join(f"x{i}" for i in range(80))])[0]
    assert 8 <= len(long) <= 11


def test_odd_rows(make_docs):
    rows = sorted(S.fingerprint_edits(make_docs(ODD_TEXTS)).collect(), key=lambda r: r["doc_id"])
    assert [r["n_chars"] for r in rows] == [len(t or "") for t in ODD_TEXTS]
    assert rows[7]["fingerprint"] == rows[8]["fingerprint"] and rows[8]["near_next"] == 1
    assert rows[0]["fingerprint"] == "" and rows[1]["near_next"] == 1
    assert S.fingerprint_edits(make_docs([])).count() == 0
    twins = S.fingerprint_edits(make_docs([(1, "a b c d"), (1, "a b c d"), (None, "x"), (2, None)])).collect()
    assert len(twins) == 4


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_near_duplicates_equal_brute_force(spark, threshold):
    rng = random.Random(12)
    sets = []
    for _ in range(25):
        base = [rng.randrange(2**32) for _ in range(rng.randrange(1, 40))]
        for _ in range(4):
            some = [x for x in base if rng.random() < 0.95] + [rng.randrange(2**32)] * (rng.random() < 0.3)
            sets.append(S.as_text(np.unique(np.array(some, np.uint32))))
    table = spark.createDataFrame([(s,) for s in sets + [""]], "fingerprint string")
    got = {tuple(sorted((r["a"], r["b"]))): r["similarity"] for r in S.near_duplicates(table, threshold).collect()}
    parts = {s: {s[i : i + 8] for i in range(0, len(s), 8)} for s in sets if s}
    want = {}
    for a, b in itertools.combinations(sorted(parts), 2):
        j = len(parts[a] & parts[b]) / len(parts[a] | parts[b])
        if j >= threshold:
            want[a, b] = pytest.approx(j)
    assert got == want and len(want) > 20
