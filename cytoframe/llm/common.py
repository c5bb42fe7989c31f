"""Small helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: UTF-8 bytes of text that one Python call turns into numpy arrays at a time.
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset in local mode (tests)."""
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not known:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        known = tempfile.mkdtemp(prefix="cytoframe-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(known)
    return known


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable copy in the shared folder, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Narrow rows that are broadcast at most.
SMALL = 1 << 19


def if_small(narrow: DataFrame, most: int = SMALL) -> DataFrame:
    """A table of one or two numbers a row, to be broadcast if it has `most` rows at most, and joined by shuffle beyond that."""
    return F.broadcast(narrow) if narrow.limit(most + 1).count() <= most else narrow


#: A key with more rows than both is hot; of n rows, MOST_HOT keys at most have more than n / MOST_HOT.
HOT_ROWS, MOST_HOT = 256, 1024


def joined_by_key(rows: DataFrame, table: DataFrame, on: dict[str, str], weight: str, most: int) -> DataFrame:
    """rows with the columns of table, which has one row for each key and in `weight` how many of rows hold it, about.

    `on` names a column of table for each key column of rows; nulls are equal. `most` bounds the number of rows. Rows of a
    hot key stay where they are and its entry comes to them by broadcast; all others meet theirs by shuffle.
    """
    entry = table.withColumnRenamed(weight, "__w")
    keys = [rows[r].eqNullSafe(entry[t]) for r, t in on.items()]
    hot = F.col("__w") > max(HOT_ROWS, most // MOST_HOT)
    # bounded: MOST_HOT rows
    split = rows.join(F.broadcast(entry.where(hot)), keys, "left")
    rest = split.where("__w is null").select(*[rows[c] for c in rows.columns])
    rest = rest.join(entry.where(~hot), [rest[r].eqNullSafe(entry[t]) for r, t in on.items()])
    return split.where("__w is not null").unionByName(rest).withColumnRenamed("__w", weight)


def fold_of(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds


def least_hashes(rows: DataFrame, counts: dict, sample: int) -> DataFrame:
    """Of rows (y, h, ...), of which a class y has counts[y], the `sample` with the least hashes in each class.

    What lies far above the sample's share of the hashes goes first, so the window sees little more than the sample.
    """
    whole = 1 << 30
    wide = sample + 8 * sample**0.5 + 16
    share = F.create_map(*[F.lit(v) for y, n in sorted(counts.items()) for v in (y, min(whole, int(wide / n * whole) + 1))])
    place = F.pmod("h", F.lit(whole))
    near = rows.where(place < F.element_at(share, F.col("y")))
    return near.withColumn("_r", F.row_number().over(Window.partitionBy("y").orderBy(place, "h"))).where(F.col("_r") <= sample).drop("_r")


def runs_by_bytes(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(offset, texts) of consecutive rows with about `limit` bytes together; null becomes the empty text. One row may exceed it."""
    start, held, size = 0, [], 0
    for i in range(0, len(texts), 256):
        for t in texts.slice(i, 256).to_pylist():
            t = t or ""
            n = len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass"))
            if held and size + n > limit:
                yield start, held
                start, held, size = start + len(held), [], 0
            held.append(t)
            size += n
    if held:
        yield start, held


def by_text(df: DataFrame, text: Column, keep: list[Column], work: Callable[[list[str]], list[pa.Array]], schema: str) -> DataFrame:
    """Map texts in bounded runs: `work` turns a list of texts into new columns, `keep` passes through untouched.

    Columns get internal names on their way, so that extra input columns of any name do no harm.
    """
    names = [f"_k{i}" for i in range(len(keep))]
    narrow = df.select(text.cast("string").alias("_t"), *[c.alias(n) for c, n in zip(keep, names, strict=True)])
    kinds = ", ".join(f"{n} {t}" for n, t in narrow.dtypes[1:])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, texts in runs_by_bytes(b.column(0)):
                cols = [b.column(i).slice(start, len(texts)) for i in range(1, b.num_columns)]
                made = work(texts)
                yield pa.RecordBatch.from_arrays([*cols, *made], names=[*names, *[f"_o{i}" for i in range(len(made))]])

    outs = [p.strip().split(" ", 1) for p in schema.split(";")]
    full = ", ".join([*([kinds] if kinds else []), *[f"_o{i} {t}" for i, (_, t) in enumerate(outs)]])
    made = narrow.mapInArrow(mapped, full)
    return made.select(*[F.col(n) for n in names], *[F.col(f"_o{i}").alias(n) for i, (n, _) in enumerate(outs)])
