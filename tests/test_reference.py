"""A reference from folders of samples, end to end."""

import math

import pytest

from cytoframe.operators import reference
from cytoframe.sinks.files import write_bundle
from cytoframe.sources.matrix import Bundle


def part(spark, cells, genes, entries, kind="cell string, celltype string, singlet_filtered boolean"):
    return Bundle(spark.createDataFrame(cells, kind), spark.createDataFrame(genes, "gene string, kind string"), spark.createDataFrame(entries, "cell string, gene string, n bigint"))


def test_end_to_end(spark, tmp_path):
    one = part(spark, [("a", "T", True), ("b", "nan", True), ("c", "", True), ("d", None, True), ("e", "B", False), ("f", "B", None)], [("g", "x"), ("h", "y")], [("a", "g", 3), ("a", "h", 1), ("b", "g", 5), ("e", "g", 7)])
    two = part(spark, [("a", "T", True), ("z", "B", True)], [("g", "x"), ("h", "other"), ("i", "z")], [("a", "i", 2), ("z", "g", 4)])
    for k, (sample, method, p) in enumerate([("s1", "solo", one), ("s2", "solo", two), ("s2", "fry", two)]):
        write_bundle(p, str(tmp_path / "in" / sample / method / "labelled"))
        (tmp_path / "in" / sample / method / f"other{k}").mkdir()
    parts = reference.find_parts(spark, str(tmp_path / "in"), "labelled")
    assert [(s, m) for s, m, _ in parts] == [("s1", "solo"), ("s2", "fry"), ("s2", "solo")]
    reference.write_reference(reference.build_reference(parts), str(tmp_path / "ref"))
    got = reference.read_reference(spark, str(tmp_path / "ref"))
    assert sorted((r["cell"], r["celltype"], r["sample"], r["method"]) for r in got.obs.collect()) == [("a_s1", "T", "s1", "solo"), ("a_s2_fry", "T", "s2", "fry"), ("a_s2_solo", "T", "s2", "solo"), ("z_s2_fry", "B", "s2", "fry"), ("z_s2_solo", "B", "s2", "solo")]
    assert sorted(map(tuple, got.var.collect())) == [("g", "x"), ("h", None), ("i", "z")]
    x = {(r["cell"], r["gene"]): r["value"] for r in got.x.collect()}
    assert set(x) == {("a_s1", "g"), ("a_s1", "h"), ("a_s2_fry", "i"), ("a_s2_solo", "i"), ("z_s2_fry", "g"), ("z_s2_solo", "g")}
    assert abs(x["a_s1", "g"] - math.log1p(7500)) < 1e-9 and abs(x["a_s2_fry", "i"] - math.log1p(10000)) < 1e-9
    assert [tuple(r) for r in reference.cells_by_label(got).collect()] == [("T", 3), ("B", 2)]


def test_parts_without_labels_or_masks(spark):
    bare = Bundle(spark.createDataFrame([("a",)], "cell string"), spark.createDataFrame([("g",)], "gene string"), spark.createDataFrame([("a", "g", 3)], "cell string, gene string, n bigint"))
    got = reference.build_reference([("s", "m", bare)])
    assert got.obs.columns == ["cell", "sample", "method"] and got.x.count() == 1
    with pytest.raises(ValueError):
        reference.build_reference([])
