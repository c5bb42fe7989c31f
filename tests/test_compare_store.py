"""Whole data sets compared, stores that change at once, sampled profiles, and windows in blocks."""

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cytoframe.operators import metrics, profile
from cytoframe.operators.compare import compare_bundles, differing_rows
from cytoframe.operators.components import components
from cytoframe.operators.ranking import in_blocks
from cytoframe.sinks import committed, files
from cytoframe.sources.matrix import Bundle


def test_differing_rows(spark):
    r = random.Random(1)
    rows = lambda n: [(r.randrange(60), r.choice([None, 1.0, 2.5, float("nan")]), r.choice(["a", None]), [r.randrange(2)]) for _ in range(n)]
    same = rows(500)
    one, two = same + rows(20) + [same[0]] * 3, same + rows(20)
    r.shuffle(two)
    kind = "k int, v double, s string, a array<int>"
    got = differing_rows(spark.createDataFrame(one, kind).repartition(5), spark.createDataFrame(two, kind), buckets=50)
    shown = lambda x: (x[0], repr(x[1]), x[2], tuple(x[3]))
    a, b = Counter(map(shown, one)), Counter(map(shown, two))
    assert {shown(x): (x["only_left"], x["only_right"]) for x in got.collect()} == {k: (max(0, a[k] - b[k]), max(0, b[k] - a[k])) for k in a | b if a[k] != b[k]}


def test_bundles(spark):
    obs, var = spark.createDataFrame([("a", 1), ("b", 2)], "cell string, n int"), spark.createDataFrame([("g",)], "gene string")
    x = spark.createDataFrame([("a", "g", 1.0), ("b", "g", 2.0)], "cell string, gene string, value double")
    layers = x.withColumn("layer", F.lit("s"))
    near = x.withColumn("value", F.col("value") + 1e-9)
    get = lambda a, b, **kw: {r["part"]: r for r in compare_bundles(a, b, **kw).collect()}
    same = get(Bundle(obs, var, x, layers), Bundle(obs.orderBy(F.desc("cell")).withColumn("n", F.col("n").cast("bigint")), var, x.repartition(3), layers))
    assert set(same) == {"obs", "var", "x", "layers"} and all(r["same"] for r in same.values())
    assert not get(Bundle(obs, var, x), Bundle(obs, var, near))["x"]["same"] and get(Bundle(obs, var, x), Bundle(obs, var, near), digits=6)["x"]["same"]
    got = get(Bundle(obs, var, x, layers), Bundle(obs.drop("n").union(obs.select("cell").limit(1)), var, x))
    assert (got["obs"]["only_left"], got["obs"]["only_right"], got["obs"]["columns_left"], got["layers"]["only_left"]) == (0, 1, "n", 2)


def test_store_changes_at_once(spark, tmp_path):
    path = str(tmp_path / "store")
    table = lambda v: spark.createDataFrame([(v,)], "v int")
    assert committed.manifest(spark, path) is None
    with pytest.raises(FileNotFoundError):
        committed.read_committed(spark, path, "a")
    first = committed.commit(spark, path, {"a": table(1), "b": table(1)}, {"b": "csv"})
    broken = table(2).select(F.when(F.col("v") == 2, F.raise_error(F.lit("the job dies here"))).otherwise(F.lit(0)).cast("int").alias("v"))
    with pytest.raises(Exception, match="dies"):
        committed.commit(spark, path, {"a": table(2), "b": broken})
    assert committed.manifest(spark, path)["version"] == first
    assert [committed.read_committed(spark, path, n).collect()[0]["v"] for n in ("a", "b")] == [1, 1]
    committed.commit(spark, path, {"a": table(3), "b": table(4)})
    assert [committed.read_committed(spark, path, n).collect()[0]["v"] for n in ("a", "b")] == [3, 4]
    assert len(list((tmp_path / "store").glob("manifest.json*"))) == 1


def test_denoised_store(spark, tmp_path):
    raw = spark.createDataFrame([("a", "g", 5), ("b", "g", 3), ("c", "g", 9)], "cell string, gene string, n bigint")
    noise = spark.createDataFrame([("a", "g", 2), ("c", "g", 1)], "cell string, gene string, noise bigint")
    p = spark.createDataFrame([("a", 0.9), ("b", 0.5), ("c", 0.51)], "cell string, p double")
    path = str(tmp_path / "out")
    committed.write_denoised(raw, noise, p, path, expected_cells=4, fpr=0.1)
    get = lambda n: committed.read_committed(spark, path, n)
    assert sorted(map(tuple, get("filtered").collect())) == [("a", "g", 3), ("c", "g", 8)] == sorted(map(tuple, get("denoised").collect()))
    assert [r["barcode"] for r in get("cell_barcodes").collect()] == ["a", "c"]
    told = dict(map(tuple, get("metrics").collect()))
    assert told["total_raw_counts"] == 17 and told["total_output_counts"] == 11 and told["found_cells"] == 2 and len(told) == 15


def test_sampled_profile(spark):
    r = random.Random(2)
    n = 4000
    rows = [(i, r.choice([0, 1]), r.random(), None if i % 400 else float(i), f"t{i}", r.choice("xyz"), None, float(r.randrange(9)), [i], True) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, b int, u double, rare double, t string, c string, none string, w double, a array<int>, y boolean").repartition(6)
    got = {x["col_name"]: x for x in profile.sampled_profile(df, ["k"], sample=300).collect()}
    assert {c: got[c]["kind"] for c in got} == {"k": "count data", "b": "binary (0/1)", "u": "normalized/probability values", "rare": "float-stored integers", "t": "text", "c": "categorical", "none": "all missing", "w": "float-stored integers", "a": "text", "y": "binary"}
    assert all(got[c]["n_rows"] == n for c in got) and got["rare"]["nulls"] == n - 10 and got["rare"]["n_sampled"] == 10 and got["t"]["n_sampled"] == 300
    # the same sample whatever the partitions, and never a prefix
    again = {x["col_name"]: x for x in profile.sampled_profile(df.repartition(1), ["k"], sample=300).collect()}
    assert again == got and max(int(v[1:]) for v in got["t"]["examples"]) > 100
    assert profile.sampled_profile(df.limit(0)).where("kind = 'all missing'").count() == 10
    assert profile.sampled_profile(spark.createDataFrame([(1,)] * 5, "v int"), sample=3).first()["n_sampled"] == 3


def test_profile_of_a_bundle(spark):
    obs, var = spark.createDataFrame([("a", 1), ("b", 2)], "cell string, n int"), spark.createDataFrame([("g",), ("h",)], "gene string")
    x = spark.createDataFrame([("a", "g", 1.0)], "cell string, gene string, value double")
    got = {(r["part"], r["col_name"]): r for r in profile.profile_bundle(Bundle(obs, var, x, x.withColumn("layer", F.lit("s")))).collect()}
    assert set(got) == {("obs", "cell"), ("obs", "n"), ("var", "gene"), ("x", "value"), ("layer s", "value"), ("matrix", "sparsity")}
    assert got["matrix", "sparsity"]["most"] == 0.75 and got["x", "value"]["n_rows"] == 1


def test_windows_in_blocks(spark):
    r = random.Random(3)
    v = [r.randrange(100) for _ in range(137)]
    df = spark.createDataFrame([(i + 1, x) for i, x in enumerate(v)], "i bigint, v int")
    for block in (10, 25, 1000):
        back = Window.partitionBy("_b").orderBy("i").rowsBetween(-7, 0)
        got = in_blocks(df, "i", 7, block).withColumn("s", F.sum("v").over(back)).where("_own")
        assert [x["s"] for x in got.orderBy("i").collect()] == [sum(v[max(0, i - 7) : i + 1]) for i in range(len(v))]


def test_convergence(spark):
    r = random.Random(4)
    v = [r.random() for _ in range(60)]
    import statistics

    got = metrics.convergence_indicator(spark.createDataFrame(list(enumerate(v)), "epoch int, train double")).first()
    want = (abs(v[-2] - v[-3]) + abs(v[-3] - v[-4])) / 2 / statistics.pstdev(v[-20:])
    assert abs(got[0] - want) < 1e-9 and abs(got[1] - (v[-1] - v[0])) < 1e-12
    assert metrics.convergence_indicator(spark.createDataFrame(list(enumerate(v[:20])), "epoch int, train double")).first()[0] is None


def test_components_with_hubs(spark, monkeypatch):
    from cytoframe.operators import components as module

    monkeypatch.setattr(module, "HUB_EDGES", 3)
    r = random.Random(5)
    edges = [(0, i) for i in range(1, 60)] + [(r.randrange(100, 400), r.randrange(100, 400)) for _ in range(150)] + [(900, 900), (59, None)]
    root = {}
    find = lambda a: a if root.setdefault(a, a) == a else find(root[a])
    for a, b in edges:
        if b is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "u int, v int")).collect()} == {a: find(a) for a in list(root)}


def test_stats_lines(spark):
    df = spark.createDataFrame([(200, 50, 120, 40, 30, 10), (0, 0, 0, 0, 0, 0)], "total_counts bigint, deduped_counts bigint, distinct_keys bigint, cells bigint, unmatched bigint, cells_with_feature bigint")
    got = [r["value"] for r in files.stats_lines(df.limit(1)).orderBy("line").collect()]
    assert got == ["Total feature counts 200", "Total deduped feature counts 50", "Total unique barcode UMIs 120", "Total whitelisted barcodes 40", "Percentage features assigned to barcode 85.00", "Percentage barcodes assigned feature 25.00"]
    assert [r["value"] for r in files.stats_lines(df.where("total_counts = 0")).orderBy("line").collect()][-2:] == ["Percentage features assigned to barcode 0.00", "Percentage barcodes assigned feature 0.00"]
