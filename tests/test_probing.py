"""Feature search by packed tables against comparing every window with every feature."""

import random

import pytest

from cytoframe.operators import matching, probing


def differ(a, b):
    return sum(x != y or x not in "ACGT" for x, y in zip(a, b))


def alone(hits):
    """(feature, distance, place) of the one nearest feature; hits are (distance, place, feature)."""
    if not hits:
        return None
    low = min(h[0] for h in hits)
    near = {h[2] for h in hits if h[0] == low}
    return (near.pop(), low, min(h[1] for h in hits if h[0] == low)) if len(near) == 1 else None


def scan(read, feats, d):
    return alone([(n, p + 1, f) for f, s in feats for p in range(len(read) - len(s) + 1) if (n := differ(read[p : p + len(s)], s)) <= d])


def fixed(read, feats, at, d, max_n):
    here = [(f, s, read[at - 1 : at - 1 + len(s)]) for f, s in feats if len(read) >= at - 1 + len(s)]
    exact = [(0, at, f) for f, s, w in here if w == s]
    if exact:
        return alone(exact)
    blank = [(0, at, f) for f, s, w in here if 0 < sum(c not in "ACGT" for c in w) <= max_n and all(x == y or x not in "ACGT" for x, y in zip(w, s))]
    return alone(blank) or alone([(n, at, f) for f, s, w in here if (n := differ(w, s)) <= d])


def cases(seed, letters="ACGT"):
    r = random.Random(seed)
    seq = lambda n: "".join(r.choice(letters) for _ in range(n))
    feats = [(f"f{i}", "".join(r.choice("ACGT") for _ in range(r.choice([1, 3, 6, 8, 8, 8, 33, 70])))) for i in range(40)]
    feats += [("same", feats[3][1]), ("empty", "")]
    reads = [(i, seq(r.choice([0, 2, 8, 20, 60, 120]))) for i in range(150)]
    for i in range(60):
        f = list(r.choice(feats[:-1])[1])
        for _ in range(r.randrange(4)):
            f[r.randrange(len(f))] = r.choice("ACGTN")
        reads.append((200 + i, seq(3) + "".join(f) + seq(r.randrange(5))))
    return [f for f in feats if f[1]], [*reads, (7, "ACGTACGT"), (7, "ACGTACGT"), (900, None), (None, "acgtACéGTACGT")]


@pytest.mark.parametrize("seed,letters", [(1, "ACGT"), (2, "ACGTN")])
def test_by_hand(spark, seed, letters, monkeypatch):
    feats, reads = cases(seed, letters)
    f, df = spark.createDataFrame(feats, "feature string, sequence string"), spark.createDataFrame(reads, "read_id bigint, read string").repartition(3)
    show = lambda found: sorted(((i, *x) for i, x in found if x), key=repr)
    got = lambda out: sorted(((r["read_id"], r["feature"], r["distance"], r["place"]) for r in out.collect()), key=repr)
    plan = matching.match_reads(df, f, 4, 2, 2)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Join" not in plan
    for d in (0, 1, 2, 5):
        assert got(matching.match_features(df, f, d)) == show((i, scan(t or "", feats, d)) for i, t in reads)
    for d, n in ((0, 0), (1, 3), (3, 1)):
        want = {k: fixed(t or "", feats, 4, d, n) for k, (_, t) in enumerate(reads)}
        assert got(matching.match_at(df, f, 4, d, n)) == show((i, want[k]) for k, (i, _) in enumerate(reads))
        both = [(i, s if (s := scan(t or "", feats, d)) and (not want[k] or s[1] < want[k][1]) else want[k]) for k, (i, t) in enumerate(reads)]
        assert got(matching.match_reads(df, f, 4, d, n)) == show(both)
    inside = sorted(((i, name) for i, t in reads for name, s in feats if s in (t or "")), key=repr)
    assert sorted(((r[0], r[1]) for r in matching.contained_features(df, f).collect()), key=repr) == inside


def test_pairs_in_parts_and_many_features(spark, monkeypatch):
    feats, reads = cases(3)
    table = probing.Features([s for _, s in feats], 2)
    codes, size = probing.codes_of([t for _, t in reads])
    whole = table.scan(codes, size, 2)
    monkeypatch.setattr(probing, "PAIRS", 5)
    parts = table.scan(codes, size, 2)
    assert (whole.key == parts.key).all() and (whole.shared == parts.shared).all() and (whole.place == parts.place).all()
    # beyond the table's bound reads and features are joined
    monkeypatch.setattr(probing, "MOST_FEATURES", 3)
    one = [(n, s) for n, s in feats if len(s) == 8 and n != "same"]
    f, df = spark.createDataFrame(one, "feature string, sequence string"), spark.createDataFrame([(k, t) for k, (_, t) in enumerate(reads) if t and set(t) <= set("ACGT")], "read_id bigint, read string")
    out = matching.match_features(df, f, 1)
    assert "MapInArrow" not in out._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in out.collect()) == sorted((k, *x) for k, t in [tuple(r) for r in df.collect()] if (x := scan(t, one, 1)))


def test_nothing(spark):
    f, df = spark.createDataFrame([], "feature string, sequence string"), spark.createDataFrame([("a", "ACGT")], "read_id string, read string")
    assert matching.match_features(df, f, 2).count() == matching.contained_features(df, f).count() == matching.match_reads(df.limit(0), f, 1, 1).count() == 0


def looked_at(monkeypatch):
    """Counts the pairs of a window and a feature that a search compares."""
    seen = []
    for name in ("pairs", "at_distance"):
        if whole := getattr(probing.Group, name, None):

            def counted(self, *args, whole=whole):
                for found in whole(self, *args):
                    seen.append(len(found[0]))
                    yield found

            monkeypatch.setattr(probing.Group, name, counted)
    return seen


def test_many_features_cost_little(monkeypatch):
    """With every word a feature, or every fourth, reads are settled by their exact or nearest features, not compared with thousands."""
    r = random.Random(5)
    words = ["".join(r.choice("ACGT") for _ in range(8)) for _ in range(16000)]
    feats = [(k, s) for k, s in enumerate(sorted(set(words)))]
    texts = ["".join(r.choice("ACGTTTN" if i % 5 == 0 else "ACGT") for _ in range(20)) for i in range(60)]
    table = probing.Features([s for _, s in feats], 3)
    codes, size = probing.codes_of(texts)
    seen = looked_at(monkeypatch)
    best, here = table.scan(codes, size, 3), table.fixed(codes, size, 3, 3, 3)
    assert sum(seen) < 200 * 60
    got = lambda b, i: None if b.shared[i] or b.key[i] == probing._FAR else (int(b.key[i]) & 0xFFFFFFFF, int(b.key[i]) >> 32, int(b.place[i]))
    for i, t in enumerate(texts):
        assert got(here, i) == fixed(t, feats, 3, 3, 3)
        if i % 4 == 0:
            assert got(best, i) == scan(t, feats, 3)


@pytest.mark.parametrize("seed", range(4))
def test_words_at_a_distance(seed):
    """Lookup of near words, with repeated features, several lengths and letters that are no base."""
    r = random.Random(seed)
    seq = lambda n, letters="ACGT": "".join(r.choice(letters) for _ in range(n))
    sequences = [seq(r.choice((6, 6, 9, 13))) for _ in range(1500)]
    sequences += sequences[:5]
    feats = list(enumerate(sequences))
    texts = [seq(r.choice((4, 13, 18)), "ACGTNn" if i % 2 else "ACGT") for i in range(40)]
    table = probing.Features(sequences, 3)
    assert any(g.by_words(2) for g in table.groups)
    codes, size = probing.codes_of(texts)
    got = lambda b, i: None if b.shared[i] or b.key[i] == probing._FAR else (int(b.key[i]) & 0xFFFFFFFF, int(b.key[i]) >> 32, int(b.place[i]))
    for d, n in ((1, 2), (3, 0), (2, 3)):
        best, here = table.scan(codes, size, d), table.fixed(codes, size, 2, d, n)
        for i, t in enumerate(texts):
            assert got(best, i) == scan(t, feats, d) and got(here, i) == fixed(t, feats, 2, d, n)


def test_more_features_than_before_fit_the_table(spark):
    names, sequences = probing.collected(spark.range(700_000).selectExpr("concat('F', id) as feature", "lpad(conv(id, 10, 4), 10, '0') as sequence"))
    assert len(names) == len(sequences) == 700_000 and names[1].as_py() == "F1" and sequences[1].as_py() == "0000000001"
