"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Every document of a source asks for the same number of copies, target / source size, which is rarely whole. The whole
part is taken at once; the fractional parts are rounded together. In a group of documents of one source, largest first,
each document is paired with the bundle of all smaller ones that are still open: the two move words between each other,
one up and one down, until a fraction becomes 0 or 1; which way is drawn so that every document keeps its expectation.
The words of the pair never change. As a large document is settled against many small ones, what a group leaves over is
one fractional document, nearly always its smallest. Groups have a bounded expected size; what they leave over goes into
the next level of a reduction tree, until one document is left for each source, which a last draw decides: a source
misses its target by less than that one document. Draws are hashes of ids, so reruns agree.

Defined results: a null text has size 0; a null source is a source, ordered last; a source of size 0 has target 0 and
its documents are never taken; repeated rows count as so many documents and share their copies as evenly as whole
numbers allow; null ids are documents like others; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.llm.common import checkpoint

WORD = r"[^\x20\x09-\x0D]+"
#: Expected documents of a source in one group of the reduction tree.
FAN = 128
_NEAR = 1e-9


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """(src, source_size, target, n) from rows (src, size, m): shares by weight, none above `cap` times its source's size.

    Reshaping the excess by weight until none is above ends where every source gets min(cap * size, level * weight);
    the level is read off running sums over the sources in the order in which they reach their cap.
    """
    total = sized.groupBy("src").agg(F.sum(F.col("size") * F.col("m")).cast("bigint").alias("source_size"), F.count("*").alias("n"))
    rank = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last()))
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    ranked = total.withColumn("w", F.element_at(kinds, ((rank - 1) % len(weights) + 1).cast("int")))
    by_cap = Window.orderBy(F.lit(cap) * F.col("source_size") / F.col("w"), F.col("src").asc_nulls_last())
    every = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum(F.lit(cap) * F.col("source_size")).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("w").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    found = ranked.withColumn("level", level).withColumn("level", F.when(F.col("level") <= F.lit(cap) * F.col("source_size") / F.col("w"), F.col("level")))
    settled = found.withColumn("level", F.first("level", ignorenulls=True).over(every))
    return settled.select("src", "n", "source_size", F.least(F.lit(cap) * F.col("source_size"), F.coalesce(F.col("level") * F.col("w"), F.lit(cap) * F.col("source_size"))).alias("target"))


def _let(value: Column, use) -> Column:
    """Evaluate `value` once and hand it to `use`."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _snap(p: Column) -> Column:
    return F.when(p < _NEAR, F.lit(0.0)).when(p > 1 - _NEAR, F.lit(1.0)).otherwise(p)


def _round_group(units: DataFrame, share: int, level: int, seed: int) -> DataFrame:
    """(src, x) of every unit with its new fraction x.p: 0 or 1 for all but one of each group at most.

    The bundle's fractions have all gone through the same affine map p -> al * p + be since the start of the group, so
    the fold carries al, be and the bundle's size and words rather than its members.
    """
    item = F.struct("size", "h", "id", "m", "n", "sure", "p")
    own = units.groupBy("src", F.pmod(F.xxhash64(F.lit(level), "h"), F.ceil(F.col("n") / F.lit(share))).alias("g")).agg(
        F.sort_array(F.collect_list(item), asc=False).alias("xs"), F.sum(F.col("size").cast("double")).alias("b"), F.sum(F.col("size") * F.col("p")).alias("w")
    )
    kind = units.select(item.alias("x")).schema["x"].dataType.simpleString()

    def pair(acc, x):
        size = x["size"].cast("double")
        p, rest, words = acc["al"] * x["p"] + acc["be"], acc["b"] - size, acc["w"] - size * x["p"]
        return _let(F.struct(size.alias("size"), _snap(p).alias("p"), rest.alias("b"), words.alias("w"), F.greatest(acc["al"] * words + acc["be"] * rest, F.lit(0.0)).alias("full")), lambda s: draw(acc, x, s))

    def draw(acc, x, s):
        up, down = F.least((1 - s["p"]) * s["size"], s["full"]), F.least(s["p"] * s["size"], F.greatest(s["b"] - s["full"], F.lit(0.0)))
        u = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), x["h"]), F.lit(1 << 53)).cast("double") / float(1 << 53)
        return _let(F.struct(up.alias("up"), down.alias("down"), (u * (up + down) < down).alias("rise")), lambda d: move(acc, x, s, d))

    def move(acc, x, s, d):
        part = lambda n, of: F.when(of > 0, F.least(n / of, F.lit(1.0))).otherwise(F.lit(0.0))
        t = F.when(d["rise"], part(d["up"], s["full"])).otherwise(part(d["down"], s["b"] - s["full"]))
        p = F.when(d["rise"], s["p"] + d["up"] / s["size"]).otherwise(s["p"] - d["down"] / s["size"])
        settled = F.struct(x["size"].alias("size"), x["h"].alias("h"), x["id"].alias("id"), x["m"].alias("m"), x["n"].alias("n"), x["sure"].alias("sure"), _snap(p).alias("p"))
        return _let(t, lambda k: F.struct((acc["al"] * (1 - k)).alias("al"), (acc["be"] * (1 - k) + F.when(d["rise"], F.lit(0.0)).otherwise(k)).alias("be"), s["b"].alias("b"), s["w"].alias("w"), F.concat(acc["out"], F.array(settled)).alias("out")))

    start = F.struct(F.lit(1.0).alias("al"), F.lit(0.0).alias("be"), F.col("b").alias("b"), F.col("w").alias("w"), F.array().cast(f"array<{kind}>").alias("out"))
    folded = own.select("src", F.aggregate("xs", start, pair, lambda acc: acc["out"]).alias("out"))
    return folded.select("src", F.explode("out").alias("x")).select("src", "x.h", "x.id", "x.size", "x.m", "x.n", "x.sure", "x.p")


def mix_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (1, 2, 3), cap: float = 3.0, seed: int = 20, fan: int = FAN) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for every row."""
    narrow = docs.select(F.col(doc_id).alias("id"), F.col(source).alias("src"), size_in_words(F.col(text)).alias("size"))
    sized = checkpoint(narrow.groupBy("id", "src", "size").agg(F.count("*").alias("m")))
    targets = checkpoint(source_targets(sized, weights, cap))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    base = F.floor(rate + _NEAR)
    key = lambda c: F.struct(F.col(c).isNull().alias("n"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("v"))
    ruled = targets.select(key("src").alias("_s"), "n", "source_size", "target", base.alias("base"), F.greatest(rate - base, F.lit(0.0)).alias("part"))
    units = sized.withColumn("_s", key("src")).join(ruled, "_s").withColumn("all", F.when(F.col("size") > 0, F.col("m") * F.col("part")).otherwise(F.lit(0.0)))
    sure = F.floor(F.col("all") + _NEAR)
    units = units.withColumn("sure", sure).withColumn("p", _snap(F.greatest(F.col("all") - sure, F.lit(0.0)))).withColumn("h", F.xxhash64(F.lit(seed), "id", "src", "size"))
    open_ = checkpoint(units.where("p > 0").select("src", "h", "id", "size", "m", "n", "sure", "p"))
    n = targets.agg(F.max("n")).first()[0]
    depth = max(1, math.ceil(math.log(max(n or 0, 2)) / math.log(fan)))
    decided, left = [units.where("p <= 0").select("src", "id", "size", "m", "sure", F.lit(0.0).alias("p"))], open_
    for level in range(1, depth + 1):
        rounded = _round_group(left, fan**level, level, seed)
        if level == 1:
            rounded = checkpoint(rounded)
        whole = (F.col("p") == 0) | (F.col("p") == 1)
        decided.append(rounded.where(whole).select("src", "id", "size", "m", "sure", "p"))
        left = rounded.where(~whole)
    last = F.pmod(F.xxhash64(F.lit(seed), F.lit("last"), "h"), F.lit(1 << 53)).cast("double") / float(1 << 53)
    decided.append(left.select("src", "id", "size", "m", "sure", (last < F.col("p")).cast("double").alias("p")))
    rows = decided[0]
    for d in decided[1:]:
        rows = rows.unionByName(d)
    spread = rows.withColumn("_s", key("src")).join(ruled.drop("n"), "_s").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m"))))
    copies = F.when(F.col("size") > 0, F.col("base") + (F.col("_i") <= F.col("sure") + F.col("p")).cast("bigint")).otherwise(F.lit(0))
    return spread.select(F.col("id").alias("doc_id"), F.col("src").alias("source"), "size", "source_size", "target", copies.cast("bigint").alias("copies"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of docs, each as often as its copies say, with all columns.

    Rows meet their copies by id, source and size, so null ids spread over these too. Rows that agree in all three take
    the copies in order of a hash of their text, the larger numbers first; equal texts are interchangeable. Extra columns
    of any name pass through.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    own = {c: F.col(names[docs.columns.index(c)]) for c in (doc_id, text, source)}
    key = lambda c: F.struct(c.isNull().alias("n"), F.coalesce(c.cast("string"), F.lit("")).alias("v"))
    numbered = lambda df, i, s, n, order: df.withColumns({"_id": key(i), "_s": key(s), "_n": n}).withColumn("_o", F.row_number().over(Window.partitionBy("_id", "_s", "_n").orderBy(order)))
    left = numbered(docs.toDF(*names), own[doc_id], own[source], size_in_words(own[text]), F.xxhash64(own[text]))
    copies = mix_copies(docs, doc_id, text, source, **options)
    right = numbered(copies, F.col("doc_id"), F.col("source"), F.col("size"), F.col("copies").desc()).where("copies > 0").select("_id", "_s", "_n", "_o", "copies")
    met = left.join(right, ["_id", "_s", "_n", "_o"]).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return met.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
