"""License scan against counting by hand."""

import random
import re

from llm_cases import prose

from cytoframe.llm import licenses

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(text, templates, phrases=licenses.PHRASES, share=licenses.SHARE):
    words = re.findall(licenses.WORD, (text or "").translate(FOLD))
    places = [(i, label) for p, label in phrases for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    labels, score = {label for _, label in places}, 0.0
    for label, t in templates:
        want, size = set(licenses.words_of(t)), licenses.reach(t)
        blocks = max(1, -(-len(words) // size) - 1)
        for b in range(blocks):
            have = len(want & set(words[b * size : (b + 2) * size])) / len(want)
            if have >= share:
                labels.add(label)
                score = max(score, have)
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places})), ",".join(sorted(labels)), score


def found(df, **kw):
    cols = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return sorted(((r["doc_id"], *(r[c] for c in cols)) for r in licenses.license_scan(df, **kw).collect()), key=repr)


def planted(seed=1, n=120):
    r = random.Random(seed)
    out = []
    for i in range(n):
        label, t = r.choice(licenses.TEMPLATES)
        words = t.split()
        for _ in range(int(len(words) * r.choice([0, 0.05, 0.2, 0.35]))):
            words[r.randrange(len(words))] = f"w{r.randrange(99)}"
        text = f"{prose(i, r.randrange(700))} {r.choice([' ', chr(10), ' -- '])}{' '.join(words)} {prose(i + 999, r.randrange(400))}"
        out.append((i, r.choice([text, text.upper(), text.replace(" ", "\n")])))
    return out


def test_planted_by_hand(spark):
    rows = planted() + [(500, "MIT License"), (501, "the mit mit license, Apache-License! General  Public\nLicense"), (502, "mit licenses"), (503, "Public License"), (504, "é mit License é"), (505, None), (506, "")]
    want = sorted(((i, *by_hand(t, licenses.TEMPLATES)) for i, t in rows), key=repr)
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert got == want
    assert sum(1 for w in want if w[-1] > 0) > 50 and {x for w in want for x in w[-2].split(",")} >= {label for label, _ in licenses.TEMPLATES}


def test_whole_notices_are_found_anywhere(spark):
    rows = [(k * 1000 + at, f"{prose(at, at)} {t} {prose(at + 5, 90)}") for k, (_, t) in enumerate(licenses.TEMPLATES) for at in (0, 1, 31, 63, 64, 127, 128, 200)]
    got = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, r in got.items():
        assert licenses.TEMPLATES[i // 1000][0] in r["labels"].split(",") and r["score"] == 1.0


def test_other_templates_and_shares(spark):
    r = random.Random(5)
    templates = [(f"t{k}", " ".join(f"v{r.randrange(30)}" for _ in range(n))) for k, n in enumerate((1, 2, 5, 9, 16, 17, 40))] + [("none", "--")]
    rows = [(i, " ".join(f"v{r.randrange(60)}" for _ in range(r.randrange(90)))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for share in (0.3, 0.8, 1.0):
        want = sorted(((i, *by_hand(t, templates[:-1], [("v1 v2", "x"), ("v3", "a'b")], share)) for i, t in rows), key=repr)
        assert found(df, templates=templates, phrases=[("v1 v2", "x"), ("v3", "a'b")], share=share) == want
    assert {x[-2] for x in found(df, templates=[])} == {""}


def test_edges(edges, nothing):
    want = sorted(((r["doc_id"], *by_hand(r["text"], licenses.TEMPLATES)) for r in edges.collect()), key=repr)
    assert found(edges) == want
    assert found(nothing) == []


def test_least_overlap():
    for n in range(1, 200):
        for share in (0.3, 0.8, 1.0):
            t = licenses.least_overlap(n, share)
            assert t / n >= share and (t == 1 or (t - 1) / n < share)
