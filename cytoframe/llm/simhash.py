"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints that differ in at most two bits both lie within one bit of some third word. Every distinct
fingerprint therefore emits itself and its 64 one-bit variants; fingerprints that share a variant are candidates, and
no pair within the radius is missed. Rows of a variant collapse, before and after the shuffle, into a bit mask that
names its members: a bucket has 65 members at most, however many documents there are, and copies of a text count once.
Members of one bucket differ in two bits at most, so linking them to the smallest one keeps every component.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; a null id takes no part in
the smallest id (a component of null ids alone has a null component); repeated rows give repeated result rows; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.common import by_text, checkpoint, joined_by_key
from cytoframe.llm.components import connected_components

BITS = 64
RADIUS = 2
_BLOCK = 1 << 15


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash over the XXH64 (seed 42) of word shingles with repeats; A-Z are lower-cased, nothing else."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    # starts[i] is where word i begins; the shingle i..i+n-1 ends before the blank ahead of word i+n
    starts = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words]))).tolist()
    total, ones = len(words) - shingle + 1, np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _BLOCK):
        end = min(total, at + _BLOCK)
        h = np.fromiter((digest(joined[p : q - 1], 42) for p, q in zip(starts[at:end], starts[at + shingle : end + shingle])), "<u8", end - at)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def simhash_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint of every whole text as a signed 64-bit integer, with the text's plain hash."""
    out = by_text(docs, F.col(text), [F.col(doc_id), F.xxhash64(F.col(text).cast("string"))], lambda ts: [pa.array(np.array([fingerprint_of(t, shingle) for t in ts], np.uint64).view(np.int64))], "fp bigint")
    return out.select(F.col("_k0").alias("doc_id"), F.col("_k1").alias("text_hash"), "fp")


def ball_links(fps: DataFrame, fp: str = "fp") -> DataFrame:
    """(a, b): links between distinct fingerprints within two bits, a star around the smallest member of each bucket."""
    one = F.lit(1).cast("bigint")
    # each row becomes 65, so partitions stay as many as the session asks for instead of being merged by their small size;
    # dealing by the bare fingerprint would be dropped as redundant, and the exchange below it merged
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    node = fps.select(F.col(fp).alias("fp")).distinct().repartition(parts, F.xxhash64("fp"))
    spread = node.select("fp", F.explode(F.sequence(F.lit(-1), F.lit(BITS - 1))).alias("i"))
    flip = F.when(F.col("i") < 0, F.lit(0).cast("bigint")).otherwise(F.expr("shiftleft(1L, i)"))
    rows = spread.select(F.col("fp").bitwiseXOR(flip).alias("variant"), flip.alias("mask"), (F.col("i") < 0).cast("int").alias("own"))
    hit = rows.groupBy("variant").agg(F.bit_or("mask").alias("mask"), F.max("own").alias("own")).where(F.bit_count("mask") + F.col("own") > 1)
    flipped = F.transform(F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.expr("mask").bitwiseAND(F.call_function("shiftleft", one, i)) != 0), lambda i: F.col("variant").bitwiseXOR(F.call_function("shiftleft", one, i)))
    members = F.concat(F.when(F.col("own") == 1, F.array("variant")).otherwise(F.array().cast("array<bigint>")), flipped)
    star = hit.select(members.alias("m")).select(F.array_min("m").alias("a"), F.explode("m").alias("b")).where("a <> b").distinct()
    return star.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, root) for every row: component_id is the smallest id reachable over links of
    two bits, root the smallest fingerprint (signed) of the component.

    Ids are of any type with an order. Rows of a fingerprint that very many share (that of empty texts, or of one copied
    text) are not brought together.
    """
    fps = checkpoint(simhash_fingerprints(docs, doc_id, text, shingle))
    node = fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    comp = connected_components(ball_links(fps))
    # fingerprints without a link are components of their own and skip the join over roots
    rooted = node.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
    ids = rooted.where("root is not null").groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root", "left").select(F.col("fp").alias("node"), "n", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("root", "fp").alias("root"))
    return joined_by_key(fps, checkpoint(named), {"fp": "node"}, "n", fps.count()).select("doc_id", "text_hash", "fp", "component_id", "root")


def hex_of(fp: str = "fp"):
    """16 lowercase hex digits of a signed 64-bit column."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest id stays, all columns intact.

    Rows of the component that repeat that id shrink to one, of the text with the least hash (a signed number), and of
    equal texts the row with the least hash over all columns; documents with a null id stay only where their whole
    component has no id, one of them. Ids are of any type with an order, extra columns have any names. Rows of an id and
    text that very many repeat are not brought together.
    """
    groups = simhash_groups(docs, doc_id, text, shingle)
    # of each component one pair of id and text; `n` tells how many rows repeat that pair
    pairs = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    stay = checkpoint(pairs.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash", "n")).alias("x")).select("x.*"))
    names = [f"_c{i}" for i in range(len(docs.columns))]
    own = names[docs.columns.index(doc_id)]
    keyed = docs.toDF(*names).withColumn("_h", F.xxhash64(F.col(names[docs.columns.index(text)]).cast("string")))
    held = joined_by_key(keyed, stay, {own: "doc_id", "_h": "text_hash"}, "n", stay.agg(F.sum("n")).first()[0] or 0)
    # almost every pair stands once; only repeated ones are aggregated
    once = held.where("n = 1").select(*names)
    again = held.where("n > 1").groupBy(own, "_h").agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias("_r")).select("_r.*")
    return once.unionByName(again).toDF(*docs.columns)
