"""Added spans against planted ones: names, numbers and secrets among decoys of the same shapes."""

import random

import pytest

from cytoframe.llm import pii

WORDS = "river market letter garden winter music paper window travel bridge engine field story light metal".split()
PLACES = "North Harbor|Green Valley|Silver Lake|Grand Hotel|Monday Morning|Royal Museum|Central Station|Winter Palace|Old Bridge|Blue Mountain".split("|")


def planted(n: int, seed: int):
    """(rows, truth): texts of lower-case words; every sixth kind of text holds a span to find or a decoy to leave."""
    r = random.Random(seed)
    some = lambda k: " ".join(r.choice(WORDS) for _ in range(k))
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    rows, truth = [], set()
    for i in range(n):
        kind, before, span = None, "", ""
        turn = i % 6
        if turn == 0:
            kind, before, span = "name", r.choice(("signed ", "please contact ", "my name is ", "the author ")), f"{r.choice(pii.GIVEN_NAMES)} {r.choice(pii.FAMILY_NAMES + ['Okafor', 'Lindqvist'])}"
        elif turn == 1:
            before, span = r.choice(("near ", "at the ", "from ")), r.choice(PLACES)
        elif turn == 2:
            kind, before, span = "id", r.choice(("ssn ", "social security ", "tax id ")), f"{r.randint(100, 660)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}"
        elif turn == 3:
            before, span = r.choice(("order ", "invoice ", "version ")), f"{r.choice(('000', '1' + num(2)))}-{r.randint(100, 199)}-{num(4)}"
        elif turn == 4:
            kind, before, span = "secret", r.choice(("token ", "api_key ", "secret ")), "".join(r.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789") for _ in range(40))
        else:
            before, span = r.choice(("https://x/ ", "version ")), "aaaa-bbbb__cccc--dddd-1-" + r.choice(("aa", "bb"))
        head = f"{some(r.randint(5, 12))} {before}"
        rows.append((i, f"{head}{span} {some(6)}"))
        if kind:
            truth.add((i, kind, len(head), len(head) + len(span)))
    return rows, truth


@pytest.fixture(scope="module")
def found(spark):
    rows, truth = planted(1800, 7)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = pii.pii_spans(docs, pii.pii_fit(docs)).select("doc_id", "added").collect()
    return {(r.doc_id, s.kind, s.start, s.stop) for r in got for s in r.added}, truth


@pytest.mark.parametrize("kind", pii.ADDED_KINDS)
def test_planted_spans_are_found_and_decoys_left(found, kind):
    got, truth = ({x for x in z if x[1] == kind} for z in found)
    assert len(got & truth) >= 0.9 * len(truth), "recall"
    assert len(got & truth) >= 0.95 * len(got), "precision"


def test_gazetteer_votes_both_ways(spark):
    names = ["Maria Okafor", "Tobias Lopez", "Dr. Karen", "Dr Okafor", "Grand Hotel"]
    numbers = ["219-09-9999", "666-09-9999", "219-00-9999", "(907) 234-5678", "907-555-0123", "123-456-7890"]
    texts = spark.createDataFrame([(i, f"x {m} x") for i, m in enumerate(names + numbers)], "i int, text string")
    votes = lambda known: [r.cands[0].v1 for r in pii.examined(texts, known=known).orderBy("i").select("cands").collect()]
    assert votes(pii.KNOWN) == [1, 1, 1, 0, -1, 1, -1, -1, 1, -1, -1]
    many = pii.Gazetteer(given=tuple(f"Name{i}" for i in range(5000)) + ("Grand",), family=())
    assert votes(many)[:5] == [-1, -1, 0, 0, 1]
