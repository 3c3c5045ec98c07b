import hashlib
from collections import Counter, defaultdict, deque

import numpy as np
import pyarrow as pa
import pytest

from opinara.llm import alignment, tokens


def whole_tokens(aligner, text):
    """Both tokenizers over the whole text, bytes of every token."""
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    return [(t, aligner.a_bytes[t]) for t in a], [(t, aligner.b_bytes[t]) for t in b]


def ends(coded):
    out, at = [], 0
    for _, some in coded:
        at += len(some)
        out.append(at)
    return out


def brute_force(aligner, texts):
    """Groups by decoded bytes of whole texts, links one by one."""
    all_groups = []
    for text in texts:
        groups = []
        if text:
            a, b = whole_tokens(aligner, text)
            want = (" " + text).encode()
            if b"".join(x for _, x in a) == want and b"".join(x for _, x in b) == want:
                a_ends, b_ends = ends(a), ends(b)
                left, right = deque(zip(a, a_ends)), deque(zip(b, b_ends))
                for stop in sorted(set(a_ends) & set(b_ends)):
                    groups.append(([], []))
                    for own, side in zip(groups[-1], (left, right)):
                        while side and side[0][1] <= stop:
                            own.append(side.popleft()[0][0])
        all_groups.append(groups)
    held = Counter()
    for groups in all_groups:
        held.update({(x, y) for left, right in groups for x in left for y in right})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    rows = []
    for i, groups in enumerate(all_groups):
        links = [(x, y) for left, right in groups for x in left for y in right]
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        rows.append((
            i, sum(len(left) for left, _ in groups), sum(len(right) for _, right in groups), len(groups), len(links),
            sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return rows


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
HARD = [
    "  two spaces first", "ends with space ", " ", "\n\n\n", "tab\t tab \t x", "a  b   c    d", "it's we'll I'M 'tis",
    "日本語のテキスト と 中文", "😀😀 👩‍👩‍👧 flags 🇫🇷", "é combining   nbsp em　wide", "▁ piece space", "null \x00 byte \x1c \x85",
    "<|endoftext|> <s> </s> <unk> <0x0A>", "ꙮ ᚠᛇᚻ 𐍈 unusual", "x" * 5000, " " * 300 + "deep", "word,word.word;word", "1234567 3.14 1e9 x1",
    "﻿bom ​ zero​width", "ÀÉÎ ß ﬁ Ǆ İ ı", "line one\nline two\r\n line three ",
]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner.load(tokens.path("byte_bpe_50k.json"), tokens.path("piece_bpe_32k.model"))


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_equals_whole_texts(spark, sf_dir, make_docs, odd_docs, aligner):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    odd = [r["text"] for r in odd_docs.orderBy("doc_id").collect()]
    texts = [*HARD, *odd, *texts]
    assert got(alignment.align(make_docs(texts))) == brute_force(aligner, texts)


def test_chunks_share_their_counts(make_docs, aligner, monkeypatch):
    """Many chunks, and one text in a third of the rows."""
    texts = [f"word{i % 7} shared words here {i}" if i % 3 else "the very same text" for i in range(90)]
    docs = make_docs(texts)
    batch = docs.toArrow().combine_chunks().to_batches()[0]
    parts = [x for at in range(0, 90, 10) for x in alignment._documents(
        aligner, at, batch.column("doc_id").slice(at, 10), batch.column("text").slice(at, 10).to_pylist())]
    rows = docs.sparkSession.createDataFrame(pa.Table.from_batches(parts), alignment.ALIGNED)
    monkeypatch.setattr(alignment, "aligned_chunks", lambda *a: rows)
    assert got(alignment.align(docs)) == brute_force(aligner, texts)


def test_units_fall_out_of_memory(aligner, monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_UNITS", 6)
    aligner.forget()
    want = {w: [x.codes.tolist() for x in aligner.align([w])] for w in (f"word{i}" for i in range(40))}
    for turn in range(60):
        texts = [f"word{(turn * 3 + i) % 40}" for i in range(5)]
        hashes = np.sort(np.array([int(t[4:]) for t in texts], np.uint64))
        found = aligner.units(hashes, lambda i: f"word{hashes[i]}")
        for row, h in enumerate(hashes.tolist()):
            assert [x.rows(np.array([row])).codes.tolist() for x in found] == want[f"word{h}"]
        assert len(aligner.hashes) <= 11
    aligner.forget()


def test_large_groups_are_counted_before_they_are_paired(aligner, monkeypatch):
    units = ["word", "日本語のテキスト", "xxxxxxxxxxxxxxxxx", "é" * 30, "ꙮꙮꙮꙮ"]
    want = [x.tolist() for x in alignment.unit_links(*aligner.align(units))]
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    assert [x.tolist() for x in alignment.unit_links(*aligner.align(units))] == want


def test_ends_by_spans_and_by_bytes():
    ends = lambda spans, sizes: alignment.token_ends(*np.array(spans).T, np.array(sizes)).tolist()
    assert ends([(0, 1), (1, 4), (1, 4), (4, 6)], [1, 2, 1, 2]) == [1, 3, 4, 6]
    assert ends([(1, 1), (1, 3)], [1, 2]) == [1, 3]


def test_empty_table_and_other_columns(spark, make_docs, aligner):
    assert alignment.align(make_docs(["x"]).limit(0)).count() == 0
    clash = make_docs(["a b", None, "a b"]).selectExpr(
        "doc_id", "text", "1 AS chunk", "2 AS pairs", "3 AS n_a", "4 AS docs", "5 AS best", "6 AS units")
    assert got(alignment.align(clash)) == brute_force(aligner, ["a b", None, "a b"])
    same = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "x")], "doc_id long, text string")
    rows = alignment.align(same).collect()
    assert sorted((r["doc_id"] or 0, r["count_sum"]) for r in rows) == [(0, 3), (1, 5), (1, 5)]
