import random
import re

from opinara.llm import licenses

from .conftest import ODD_TEXTS

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute_force(text):
    w = words(text)
    hits = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    shares = []
    for start in range(0, len(w), licenses.STRIDE):
        for label, template in licenses.TEMPLATES:
            t = set(template.split())
            both = len(t & set(w[start : start + licenses.WINDOW]))
            if 100 * both >= licenses.PERCENT * len(t):
                shares.append((label, both / len(t)))
    places = [i for i, _ in hits]
    base = {x for _, x in hits}
    return (
        len(w), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
        ",".join(sorted(base | {x for x, _ in shares})), 1.0 if hits else max((s for _, s in shares), default=0.0),
    )


def test_equals_brute_force(make_docs):
    rng = random.Random(8)
    texts = [*ODD_TEXTS, "MIT License", "mit license mit license cc by cc by", "cc\nby", "Apache-License!", "(mit) (license)",
             "gnu general public license gnu", "cc by", "xcc by", "cc byx", "permission"]
    for _ in range(150):
        lines = []
        for _ in range(rng.randint(1, 4)):
            line = ["lorem", "Été", "the", "cc", "by"][: rng.randint(0, 5)]
            if rng.random() < 0.7:
                t = rng.choice(licenses.TEMPLATES)[1].split()
                for _ in range(rng.randint(0, 3)):
                    t[rng.randrange(len(t))] = rng.choice(["x", "license", "by"])
                line += t
            if rng.random() < 0.4:
                line += rng.choice(list(licenses.PHRASES)).upper().split()
            lines.append(rng.choice([" ", ", ", "-"]).join(line))
        texts.append("\n".join(lines))
    rows = licenses.scan(make_docs(texts)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == [brute_force(t) for t in texts]
    assert len({r["labels"] for r in rows}) > 10


def test_no_python_on_the_way(make_docs):
    plan = licenses.scan(make_docs(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_no_documents(make_docs):
    assert licenses.scan(make_docs([])).count() == 0


def test_wrapped_and_commented_notices(make_docs):
    """A notice is found across lines and comment marks, wherever it begins; words far apart are none."""
    grant = next(t for x, t in licenses.TEMPLATES if x == "mit" and "granted" in t).split()
    wrapped = "\n".join(" ".join(grant[i : i + 6]) for i in range(0, len(grant), 6))
    bsd = next(t for x, t in licenses.TEMPLATES if x == "bsd").split()
    commented = " * " + " ".join(bsd[:11]) + ",\n * " + " ".join(bsd[11:])
    filler = " ".join(f"filler{i}" for i in range(35))
    texts = [wrapped, commented, f"{filler} {wrapped} {filler}", f"{filler}\n{filler} # {commented}",
             f" {filler} {filler} {filler} ".join(grant)]
    rows = licenses.scan(make_docs(texts)).orderBy("doc_id").collect()
    assert [r["labels"] for r in rows] == ["mit", "bsd", "mit", "bsd", ""]
    assert max(len(t.split()) for _, t in licenses.TEMPLATES) <= licenses.STRIDE
