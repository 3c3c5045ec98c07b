import random

from hypothesis import given, settings
from hypothesis import strategies as st

from opinara.llm import line_dedup as L

from .conftest import ODD_TEXTS


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!\n\té", max_size=60))
def test_lines_cover_the_text(text):
    begin, end, hashes, words = L.lines(text)
    assert "".join(text[a:b] for a, b in zip(begin, end)) == text
    assert int(words.sum()) == len(text.split()) and len(hashes) == len(begin)
    by_hash = {}
    for a, b, h in zip(begin, end, hashes.tolist()):
        assert by_hash.setdefault(h, text[a:b].strip()) == text[a:b].strip()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=25), st.lists(st.integers(0, 9), max_size=25))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = L.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert len(L.align(a, a)) == len(a)


def sentence(rng, n=12):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n)) + "."


def test_passages_go_from_later_documents(make_docs):
    rng = random.Random(2)
    passage = [sentence(rng) for _ in range(6)]
    short = [sentence(rng) for _ in range(2)]
    texts = {}
    for i in range(40):
        own = [sentence(rng) for _ in range(rng.randint(3, 8))]
        at = rng.randrange(len(own))
        joint = rng.choice([" ", "\n"])
        extra = passage if i % 3 == 1 else short if i % 3 == 2 else []
        texts[i] = (joint.join(own[:at]), joint + joint.join(extra) + joint if extra else joint, joint.join(own[at:]), i % 3)
    docs = make_docs([(i, a + b + c) for i, (a, b, c, _) in texts.items()])
    rows = {r["doc_id"]: r for r in L.remove_repeated(docs).collect()}
    for i, (a, b, c, kind) in texts.items():
        if kind == 1 and i > 1:
            assert rows[i]["text"].split() == (a + " " + c).split() and rows[i]["words_removed"] == 72
        else:
            assert rows[i]["text"] == a + b + c and rows[i]["lines_removed"] == 0


def test_copies_and_a_chain(make_docs):
    rng = random.Random(3)
    parts = [sentence(rng, 20) for _ in range(12)]
    texts = ["\n".join(parts[:6]), "\n".join(parts[:6]), "\n".join(parts[3:9]), "\n".join(parts[6:12]), "\n".join(reversed(parts[:6]))]
    rows = sorted(L.remove_repeated(make_docs(texts)).collect())
    by = [(r["lines"], r["lines_removed"]) for r in rows]
    assert by[:3] == [(6, 0), (6, 6), (6, 3)] and rows[1]["text"] == ""
    assert by[3] == (6, 3)  # lines 6 to 8 stand in document 2 as well
    assert by[4] == (6, 0)  # no two lines in the same order: no block of 50 words


def test_odd_rows(make_docs):
    rows = {r["doc_id"]: r["text"] for r in L.remove_repeated(make_docs([*ODD_TEXTS, (None, "x " * 80), (3, "a")])).collect()}
    assert {i: t for i, t in rows.items() if i is not None} == dict(enumerate(ODD_TEXTS))
    assert L.remove_repeated(make_docs([])).count() == 0
    same = [(1, "x y. " * 60), (1, "x y. " * 60), (2, "x y. " * 60), (2, None)]
    got = sorted((r["doc_id"], r["text"] or "") for r in L.remove_repeated(make_docs(same)).collect())
    assert got == [(1, same[0][1]), (1, same[0][1]), (2, ""), (2, "")]


def kept_words(texts, min_words):
    """Words left of every text, by comparing all runs with those of all earlier texts."""
    seen, out = set(), []
    for text in texts:
        words = text.split()
        runs = [tuple(words[i : i + min_words]) for i in range(len(words) - min_words + 1)]
        gone = {i + k for i, run in enumerate(runs) if run in seen for k in range(min_words)}
        seen |= set(runs)
        out.append([w for i, w in enumerate(words) if i not in gone])
    return out


def test_passages_of_lines_that_each_occurred_earlier(make_docs):
    rng = random.Random(5)
    parts = [sentence(rng) for _ in range(6)]
    texts = ["\n".join(parts[:3]), "\n".join(parts[3:])]
    texts += ["\n".join([sentence(rng), *parts, sentence(rng)]) for _ in range(30)]
    rows = sorted(L.remove_repeated(make_docs(texts)).collect())
    assert [r["words_removed"] for r in rows] == [0, 0, 0] + [72] * 29
    assert all(r["lines_removed"] == 6 and len(r["text"].split()) == 24 for r in rows[3:])


def test_a_document_that_repeats_its_own_passage(make_docs):
    rng = random.Random(6)
    p = [sentence(rng) for _ in range(6)]
    x, y, z, u, v, w = ([sentence(rng)] for _ in range(6))
    texts = ["\n".join(t) for t in (x + p + y + p + z, u + p + v, w + p + p + u[:0] + v[:0], p)]
    rows = sorted(L.remove_repeated(make_docs(texts)).collect())
    assert [r["words_removed"] for r in rows] == [0, 72, 144, 72]
    assert rows[1]["text"].split() == "\n".join(u + v).split() and rows[2]["text"].split() == w[0].split()


def test_passages_that_begin_and_end_inside_lines(make_docs):
    rng = random.Random(7)
    word = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    inside, bare = sentence(rng, 60).rstrip("."), word(55)
    texts = []
    for _ in range(2):
        texts.append(" ".join([*word(9), *inside.split(), *word(9)]) + ". " + sentence(rng))
        texts.append(" ".join([*word(30), *bare, *word(30)]))
        texts.append(" ".join([*word(5), *bare[:49], *word(5)]))  # one word less than a passage
    rows = sorted(L.remove_repeated(make_docs(texts)).collect())
    assert [r["words_removed"] for r in rows] == [0, 0, 0, 60, 55, 0]
    assert rows[3]["lines_removed"] == 0 and rows[4]["text"].split() == [w for w in texts[4].split() if w not in bare]


def test_equals_comparing_all_runs(make_docs):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += [texts[3], "  " + texts[5] + "\n", *(" ".join(rng.sample(texts, 2)) for _ in range(10))]
    for n in (1, 2, 5, 8):
        rows = sorted(L.remove_repeated(make_docs(texts), n).collect())
        want = kept_words(texts, n)
        assert [r["text"].split() for r in rows] == want
        assert [r["words_removed"] for r in rows] == [len(t.split()) - len(w) for t, w in zip(texts, want)]


def test_deleting_needs_no_line_hashes(monkeypatch):
    texts = ["", "  \n ", "a", "One two. Three!\n\n four  five? ", "\n\n x\ty " + "word " * 60]
    want = [(len(L.lines(t)[0]), 0, 0, t) for t in texts]
    monkeypatch.setattr(L.W, "run_hashes", None)
    monkeypatch.setattr(L, "lines", None)
    assert [L.cut(t, [], 50) for t in texts] == want
