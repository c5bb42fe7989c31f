"""The directory of the shards against brute force, over several rounds of splits, without a collected or broadcast directory."""

from collections import Counter

import pytest

from cytoframe.llm import sharding


def brute(rows, limit):
    """Shortest fitting prefix of each hash; None where the hash itself exceeds the limit."""
    out = {}
    sums = [Counter() for _ in range(33)]
    for h, n in rows:
        for d in range(33):
            sums[d][h >> (32 - d)] += n
    for h, _ in rows:
        out[h] = next(((d, sums[d][h >> (32 - d)]) for d in range(33) if sums[d][h >> (32 - d)] <= limit), None)
    return out


def test_many_cells_split_for_several_rounds(spark, monkeypatch):
    import random

    from pyspark.sql import DataFrame

    r = random.Random(1)
    # 2**12 cells of the first round, each with two to four rows that part late
    rows = []
    for cell in range(1 << 12):
        base = cell << 20
        for k in range(r.randrange(2, 5)):
            rows.append((base + (k << r.choice((0, 3, 9, 15))), 40 + r.randrange(30)))
    seen = []
    plain = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(len(got := plain(self))) or got)
    df = spark.createDataFrame([(h, n) for h, n in rows], "h bigint, size bigint")
    out = sharding.with_shards(df, 100)
    assert max(seen, default=0) <= 1, "no table of the directory comes to the driver"
    monkeypatch.undo()
    got = out.collect()
    assert Counter((x["h"], x["size"]) for x in got) == Counter(rows)
    want = brute(rows, 100)
    for x in got:
        if want[x["h"]] is None:
            assert x["depth"] == 32 and "-" in x["shard"]
        else:
            assert (x["depth"], x["shard_bytes"]) == want[x["h"]] and x["shard"] == format(x["h"], "032b")[: x["depth"]]


def test_blocks_that_fit_whole_go_up(spark):
    """One crowded region asks for many bits while the rest fits into few buckets."""
    rows = [((5 << 28) + i, 30) for i in range(3000)] + [(i << 27, 1) for i in range(32)]
    got = sharding.with_shards(spark.createDataFrame(rows, "h bigint, size bigint"), 60).collect()
    want = brute(rows, 60)
    assert all((x["depth"], x["shard_bytes"]) == want[x["h"]] for x in got) and len(got) == len(rows)


@pytest.mark.parametrize("parts", (1, 7))
def test_repeats_of_one_row_become_pages(spark, parts):
    df = spark.createDataFrame([(1, "x" * 10)] * 1000 + [(i, "y" * 10) for i in range(2, 50)], "doc_id bigint, text string").repartition(parts)
    got = sharding.assign_shards(df, 105).collect()
    size = Counter()
    for r in got:
        size[r["shard"]] += r["n_bytes"]
    assert all(size[r["shard"]] == r["shard_bytes"] <= 105 for r in got) and not any(r["over"] for r in got)
    assert sum(r["doc_id"] == 1 for r in got) == 1000 and len({r["shard"] for r in got if r["doc_id"] == 1}) == 100
