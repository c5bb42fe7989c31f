"""Sharding by extendible hashing under a byte limit.

A row's hash is the first 32 bits of md5(id, text). The directory is indexed by the leading bits of that hash; a bucket
that holds more than the limit splits on its next bit, all others stay as they are. Whether a bucket splits depends on
its bytes alone, so the directory is computed from bytes by hash prefix: the bucket of a row is its shortest prefix whose
rows fit.

The directory is a table throughout. Rows collapse to one for each hash, these to cells of about a sixteenth of a shard;
blocks of 4096 neighbouring cells are halved up by numpy, a block that fits whole is a cell of the next block up, and
cells that are too large get further bits in rounds of their own. The driver learns the total of bytes and whether a
round has left anything, nothing that grows with the shards.

Defined results: a null text has 0 bytes and null ids hash like an empty one; a single text above the limit is a shard of
its own with `over` set; rows that share all 32 bits (in practice, repeats of one row) and exceed the limit together
become numbered pages of their bucket; an empty table gives an empty result; all input columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.llm.common import checkpoint

HASH_BITS = 32
#: Bits that one block of cells spans, and that a round adds to cells which are too large.
BLOCK_BITS, ROUND_BITS = 12, 6
#: A hash with more rows than both is hot; of n rows, MOST_HOT hashes at most have more than n / MOST_HOT.
HOT_ROWS, MOST_HOT = 256, 1024


def row_hash(doc_id: Column, text: Column) -> Column:
    joined = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")


def depths(sums: np.ndarray, bits: int, limit: int, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For each cell of `bits` more bits: the depth (from `least` up) of its bucket, -1 where the cell itself is too large, and the bucket's bytes."""
    cell = np.arange(len(sums))
    depth, held = np.full(len(sums), -1), np.zeros(len(sums), np.int64)
    level = sums.astype(np.int64)
    for d in range(bits, least - 1, -1):
        mine = level[cell >> (bits - d)]
        fits = mine <= limit
        depth[fits], held[fits] = d, mine[fits]
        if d:
            level = level.reshape(-1, 2).sum(axis=1)
    return depth, held


def _blocks(bits: int, step: int, limit: int):
    """(cell, depth, bytes) from (cell, n) in order: cells of `bits` bits in blocks that agree in all but the last `step`."""

    def block(cell: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        sums = np.zeros(1 << step, np.int64)
        at = cell & ((1 << step) - 1)
        sums[at] = n
        depth, held = depths(sums, step, limit)
        absolute = np.where(depth < 0, -1, depth + bits - step)
        return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(absolute[at], pa.int32()), pa.array(held[at])], names=["cell", "depth", "bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            cell, n = (np.concatenate((old, b.column(i).to_numpy(zero_copy_only=False))) for i, old in enumerate((cell, n)))
            ends = np.flatnonzero(np.diff(cell >> step)) + 1
            for lo, hi in zip([0, *ends.tolist()], ends.tolist()):
                yield block(cell[lo:hi], n[lo:hi])
            if len(ends):
                cell, n = cell[ends[-1] :], n[ends[-1] :]
        if len(cell):
            yield block(cell, n)

    return run


def _resolved(cells: DataFrame, bits: int, limit: int, least: int) -> DataFrame:
    """(cell, depth, bytes) of cells (cell, n) of `bits` bits: depth of the bucket, `least` at the least, or -1 where the cell is too large itself."""
    step = min(BLOCK_BITS, bits - least)
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = F.shiftright(F.col("cell"), step)
    found = cells.repartition(parts, top).sortWithinPartitions("cell").mapInArrow(_blocks(bits, step, limit), "cell bigint, depth int, bytes bigint")
    if bits - step <= least:
        return found
    # blocks that fit whole go on as cells of the level above
    above = _resolved(cells.groupBy(top.alias("cell")).agg(F.sum("n").alias("n")), bits - step, limit, least).select(F.col("cell").alias("top"), F.col("depth").alias("up"), F.col("bytes").alias("held"))
    whole = F.col("depth") == bits - step
    both = found.withColumn("top", top).join(above, "top")
    return both.select("cell", F.when(whole, F.col("up")).otherwise(F.col("depth")).alias("depth"), F.when(whole, F.col("held")).otherwise(F.col("bytes")).alias("bytes"))


def shard_table(hashes: DataFrame, limit: int) -> DataFrame:
    """hashes (h, n, ...), unique h, with depth and bytes of their buckets; depth is -1 where one hash exceeds the limit."""
    total = hashes.agg(F.sum("n")).first()[0] or 0
    bits = min(HASH_BITS, max(4, math.ceil(math.log2(max(1, total / limit))) + 4))
    names, least, out, left = hashes.columns, 0, None, hashes
    while True:
        tagged = left.withColumn("cell", F.shiftright(F.col("h"), HASH_BITS - bits))
        cells = _resolved(tagged.groupBy("cell").agg(F.sum("n").alias("n")), bits, limit, least)
        both = checkpoint(tagged.join(cells, "cell").select(*names, "depth", "bytes"))
        if bits == HASH_BITS or not both.where("depth < 0").limit(1).count():
            return both if out is None else out.unionByName(both)
        done = both.where("depth >= 0")
        out, left = done if out is None else out.unionByName(done), both.where("depth < 0").select(*names)
        least, bits = bits, min(HASH_BITS, bits + ROUND_BITS)


def _by_hash(rows: DataFrame, buckets: DataFrame, h: str, n_rows: int) -> DataFrame:
    """rows with the columns of buckets. Rows of a hot hash stay where they are; its bucket comes by broadcast."""
    named = buckets.withColumnRenamed("h", "__h")
    hot = F.col("__c") > max(HOT_ROWS, n_rows // MOST_HOT)
    # bounded: MOST_HOT rows
    split = rows.join(F.broadcast(named.where(hot)), F.col(h) == F.col("__h"), "left")
    rest = split.where("__h is null").select(*rows.columns).join(named.where(~hot), F.col(h) == F.col("__h"))
    return split.where("__h is not null").unionByName(rest).drop("__h")


def _pages(stuck: DataFrame, h: str, size: str, limit: int) -> DataFrame:
    """Rows that agree in all bits, in pages of limit // largest row rows (one at least), without bringing a hash's rows together.

    Rows are numbered inside each hash and partition, and shifted by the hash's rows in the partitions before.
    """
    placed = checkpoint(stuck.withColumn("__p", F.spark_partition_id()))
    before = Window.partitionBy(h).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(h, "__p").agg(F.count("*").alias("__c2"))
    shift = counts.withColumn("__shift", F.coalesce(F.sum("__c2").over(before), F.lit(0))).drop("__c2")
    order = Window.partitionBy(h, "__p").orderBy(F.col(size).desc(), F.xxhash64(*stuck.columns))
    room = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("__max"), F.lit(1))))
    numbered = placed.withColumn("__i", F.row_number().over(order)).join(shift, [h, "__p"])
    paged = numbered.withColumn("__page", F.floor((F.col("__shift") + F.col("__i") - 1) / room))
    held = paged.groupBy(h, "__page").agg(F.sum(size).alias("__held"))
    return paged.join(held, [h, "__page"])


def with_shards(rows: DataFrame, limit: int, h: str = "h", size: str = "size") -> DataFrame:
    """Add shard (the bits of the prefix; '-page' where needed), depth, shard_bytes and over."""
    hashes = checkpoint(rows.groupBy(F.col(h).alias("h")).agg(F.sum(size).alias("n"), F.count("*").alias("__c"), F.max(size).alias("__max")))
    table = shard_table(hashes, limit).select("h", "__c", "__max", F.col("depth").alias("__d"), F.col("bytes").alias("__b"))
    cur = _by_hash(rows, table, h, hashes.agg(F.sum("__c")).first()[0] or 0)
    bits = F.lpad(F.bin(F.col(h)), HASH_BITS, "0")
    fine = cur.where("__d >= 0").select(*rows.columns, F.substring(bits, F.lit(1), F.col("__d")).alias("shard"), F.col("__d").alias("depth"), F.col("__b").alias("shard_bytes"), F.lit(False).alias("over"))
    if not table.where("__d < 0").limit(1).count():
        return fine
    paged = _pages(cur.where("__d < 0").select(*rows.columns, "__max"), h, size, limit)
    paged = paged.select(*rows.columns, F.concat(bits, F.lit("-"), F.col("__page").cast("string")).alias("shard"), F.lit(HASH_BITS).alias("depth"), F.col("__held").alias("shard_bytes"), (F.col("__held") > limit).alias("over"))
    return fine.unionByName(paged)


def assign_shards(docs: DataFrame, limit: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, shard, depth, shard_bytes, over) of every row."""
    narrow = checkpoint(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("bigint").alias("size"), row_hash(F.col(doc_id), F.col(text)).alias("h")))
    out = with_shards(narrow, limit)
    return out.select("doc_id", F.col("size").alias("n_bytes"), "shard", "depth", "shard_bytes", "over")


def write_shards(docs: DataFrame, path: str, limit: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the rows as Parquet, a folder for each shard; all columns pass through (one named shard excepted)."""
    # the row travels as one column, so that no name of it can clash
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("bigint").alias("size"), row_hash(F.col(doc_id), F.col(text)).alias("h"))
    out = with_shards(sized, limit).select("row.*", "shard")
    out.repartition("shard").write.partitionBy("shard").parquet(path)
