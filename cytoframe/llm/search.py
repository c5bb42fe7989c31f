"""Ranked lexical search with block-max pruning over a forward index.

Index. Documents stay where they are read and are cut into blocks of consecutive rows (`BLOCK_DOCS` rows or `BLOCK_BYTES` of
text at most, a longer text alone). A block's row holds a summary - its terms as 64-bit hashes, and for each the number of
documents that hold it, the most occurrences in one document and the least length of a document with it - and the forward
index: the terms and occurrences of each document. Nothing is shuffled; the index is a Parquet table in the shared folder.

Search, for a bounded number of items at a time:
1. Summaries give document frequencies, the number of documents and their length, hence the weights of terms.
2. Summaries give each block's bound for each item: no document can gain more from a term than the most occurrences at the
   least length would. Each item's best blocks by bound are scored first; their `best`-th score is a first threshold.
3. Every task sorts the blocks at hand by an item's bound and scores their forward index until the bound falls below the
   item's threshold, which rises with what the task finds. Equal scores are kept, so ties are settled by document.
4. The best of all tasks are ranked.

A bound is never below a score, so the result equals that of scoring every document. Scores are integers throughout.

Defined results: a null text has no terms and is no hit; an item without terms has no hits; every row is a document of its own,
also where ids repeat, and a null id ranks after all ids of its score; rows that repeat an item's id and text give its hits
once; items of one id and several texts are ranked each by itself; an empty table gives an empty result; ids are integers;
extra columns of any name are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.llm.common import runs_by_bytes, shared_dir
from cytoframe.llm.tokens import table_of, words_of

BLOCK_DOCS, BLOCK_BYTES = 128, 1 << 20
BEST = 50
#: Bytes of text that are split into words at a time.
RUN_BYTES = 2 << 20
#: Items, and bytes of their texts, that one search carries to its tasks, about.
ITEMS, ITEM_BYTES = 1024, 4 << 20
#: Blocks that give an item its first threshold.
FIRST_BLOCKS = 2
#: Weight of occurrences, share of a document's length.
ONE, SCALE, HALF, SATURATION = 1_000_000_000, 1000, 50, 20
_SEPARATE = table_of((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_INDEX = "block bigint, docs bigint, length bigint, terms binary, df binary, most binary, least binary, ids binary, sizes binary, starts binary, which binary, times binary"
_NONE = np.iinfo(np.int64).min
_TYPES = (np.uint8, np.uint16, np.uint32, np.uint64)


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest type that holds them, which the first byte names."""
    top = int(values.max()) if len(values) else 0
    kind = next(i for i, t in enumerate(_TYPES) if top <= np.iinfo(t).max)
    return bytes([kind]) + values.astype(_TYPES[kind]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, _TYPES[data[0]], offset=1).astype(np.int64)


def _block(ids: np.ndarray, sizes: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray) -> tuple:
    """An index row but its number: postings (doc, term, times) are sorted by doc; docs without terms have none."""
    terms, which, df = np.unique(term, return_inverse=True, return_counts=True)
    order = np.argsort(which, kind="stable")
    first = np.cumsum(df) - df
    most = np.maximum.reduceat(times[order], first) if len(terms) else times
    least = np.minimum.reduceat(sizes[doc[order]], first) if len(terms) else times
    starts = np.searchsorted(doc, np.arange(len(ids) + 1))
    return int((sizes > 0).sum()), int(sizes.sum()), terms.tobytes(), pack(df), pack(most), pack(least), ids.tobytes(), pack(sizes), pack(starts), pack(which), pack(times)


def _indexed(block_docs: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for start, texts in runs_by_bytes(b.column(1), RUN_BYTES):
                words = words_of(texts, _SEPARATE)
                terms, which = np.unique(words.hash, return_inverse=True)
                pairs, times = np.unique(words.text * max(1, len(terms)) + which, return_counts=True)
                doc, term = pairs // max(1, len(terms)), terms[pairs % max(1, len(terms))]
                sizes = np.bincount(words.text, minlength=len(texts))
                rows, at = [], 0
                while at < len(texts):
                    end, held = at, 0
                    while end < len(texts) and end - at < block_docs and (end == at or held + len(texts[end]) <= block_bytes):
                        held += len(texts[end])
                        end += 1
                    lo, hi = np.searchsorted(doc, [at, end])
                    rows.append((number, *_block(ids[start + at : start + end], sizes[at:end], doc[lo:hi] - at, term[lo:hi], times[lo:hi])))
                    number, at = number + 1, end
                names = [c.split()[0] for c in _INDEX.split(", ")]
                kinds = [pa.int64()] * 3 + [pa.binary()] * 9
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The index of all documents, written to the shared folder and read again."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NONE)).alias("i"), F.col(text).cast("string").alias("t"))
    path = f"{shared_dir(docs.sparkSession).rstrip('/')}/search-{uuid.uuid4().hex}"
    rows.mapInArrow(_indexed(block_docs, block_bytes), _INDEX).write.parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path)


@dataclass
class Queries:
    """Items as positions of their terms in a sorted vocabulary, with what the corpus says of the terms."""

    vocabulary: np.ndarray
    flat: np.ndarray
    starts: np.ndarray
    weight: np.ndarray | None = None
    docs: int = 0
    length: int = 1

    @classmethod
    def of(cls, texts: list[str]) -> Queries:
        words = words_of(texts, _SEPARATE)
        own = [np.unique(h) for h in np.split(words.hash, np.searchsorted(words.text, np.arange(1, len(texts))))] if texts else []
        vocabulary = np.unique(words.hash)
        flat = [np.searchsorted(vocabulary, o) for o in own]
        return cls(vocabulary, np.concatenate(flat) if flat else np.zeros(0, np.int64), np.cumsum([0, *map(len, flat)]))

    def weigh(self, df: np.ndarray, docs: int, length: int) -> Queries:
        weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        return Queries(self.vocabulary, self.flat, self.starts, weight, docs, max(1, length))

    def __len__(self) -> int:
        return len(self.starts) - 1

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in terms, position in the vocabulary) of the terms that some item has."""
        at = np.searchsorted(self.vocabulary, terms)
        at[at == len(self.vocabulary)] = 0
        hit = np.flatnonzero(self.vocabulary[at] == terms) if len(self.vocabulary) else np.zeros(0, np.int64)
        return hit, at[hit]

    def damp(self, sizes: np.ndarray) -> np.ndarray:
        """m of documents with so many terms; in Python's integers where 50 * n * N may pass 64 bits."""
        if len(sizes) and int(sizes.max()) * HALF * max(1, self.docs) >= 1 << 63:
            return np.array([100 - HALF + HALF * n * self.docs // self.length for n in sizes.tolist()], np.int64)
        return 100 - HALF + HALF * sizes * self.docs // self.length

    def gain(self, at: np.ndarray, times: np.ndarray, damp: np.ndarray) -> np.ndarray:
        """What so many occurrences of vocabulary terms give a document."""
        return self.weight[at] * (ONE * times // (SCALE * times + SATURATION * damp))

    def bounds(self, terms: bytes, most: bytes, least: bytes) -> np.ndarray:
        """For each item, no less than the score of any document of a block."""
        hit, at = self.find(np.frombuffer(terms, np.uint64))
        gain = np.zeros(len(self.vocabulary) + 1, np.int64)
        gain[at] = self.gain(at, unpack(most)[hit], self.damp(unpack(least)[hit]))
        total = np.concatenate(([0], np.cumsum(gain[self.flat])))
        return total[self.starts[1:]] - total[self.starts[:-1]]


class Block:
    """The postings of a block's documents for the terms of the items, sorted by vocabulary position."""

    def __init__(self, queries: Queries, terms: bytes, ids: bytes, sizes: bytes, starts: bytes, which: bytes, times: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        hit, at = queries.find(np.frombuffer(terms, np.uint64))
        place = np.full(len(terms) // 8 + 1, -1)
        place[hit] = at
        which, damp = unpack(which), queries.damp(unpack(sizes))
        doc = np.repeat(np.arange(len(self.ids)), np.diff(unpack(starts)))
        term = place[which]
        keep = np.flatnonzero(term >= 0)
        keep = keep[np.argsort(term[keep], kind="stable")]
        self.doc, term = doc[keep], term[keep]
        self.gain = queries.gain(term, unpack(times)[keep], damp[self.doc])
        self.lo, self.hi = np.searchsorted(term, np.arange(len(queries.vocabulary))), np.searchsorted(term, np.arange(len(queries.vocabulary)), side="right")

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """The score of every document for an item with these terms."""
        lo, size = self.lo[terms], self.hi[terms] - self.lo[terms]
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        out = np.zeros(len(self.ids), np.int64)
        np.add.at(out, self.doc[at], self.gain[at])
        return out


class Best:
    """The best documents of each item so far, and the score that a further one must reach."""

    def __init__(self, floor: np.ndarray, best: int):
        self.floor, self.best = floor.copy(), best
        self.held: list[list[tuple[int, int]]] = [[] for _ in floor]

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        at = np.flatnonzero(scores >= max(1, self.floor[q]))
        if not len(at):
            return
        own = self.held[q]
        # smallest ids first; the least integer stands for null, which comes last
        own.extend(zip((-scores[at]).tolist(), (ids[at].view(np.uint64) + np.uint64((1 << 63) - 1)).tolist()))
        if len(own) > 4 * self.best or len(own) >= self.best > len(own) - len(at):
            own.sort()
            del own[self.best :]
            if len(own) == self.best:
                self.floor[q] = max(int(self.floor[q]), -own[-1][0])

    def rows(self) -> pa.RecordBatch:
        q, score, doc = [], [], []
        for i, own in enumerate(self.held):
            for s, d in sorted(own)[: self.best]:
                q.append(i)
                score.append(-s)
                doc.append(d)
        back = (np.array(doc, np.uint64) - np.uint64((1 << 63) - 1)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(score, pa.int64()), pa.array(back)], names=["q", "score", "d"])


def _totals(queries: Queries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(queries.vocabulary) + 2, np.int64)
        for b in batches:
            for docs, length, terms, own in zip(*(b.column(i).to_pylist() for i in range(4))):
                hit, at = queries.find(np.frombuffer(terms, np.uint64))
                df[at] += unpack(own)[hit]
                df[-2:] += (docs, length)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], names=["t", "n"])

    return run


def _foremost(queries: Queries, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound, block = np.zeros((blocks, len(queries)), np.int64), np.full((blocks, len(queries)), -1)
        for b in batches:
            for number, terms, most, least in zip(*(b.column(i).to_pylist() for i in range(4))):
                new, which = queries.bounds(terms, most, least), np.full(len(queries), number)
                for k in range(blocks):  # sift the new bound down the sorted ones
                    up = new > bound[k]
                    bound[k], new = np.where(up, new, bound[k]), np.where(up, bound[k], new)
                    block[k], which = np.where(up, which, block[k]), np.where(up, block[k], which)
        k, q = np.nonzero(block >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(block[k, q]), pa.array(bound[k, q])], names=["q", "block", "bound"])

    return run


def _searched(queries: Queries, floor: np.ndarray, best: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = Best(floor, best)
        for b in batches:
            columns = {n: b.column(n) for n in ("terms", "most", "least", "ids", "sizes", "starts", "which", "times")}
            bounds = np.array([queries.bounds(*(columns[c][i].as_py() for c in ("terms", "most", "least"))) for i in range(b.num_rows)]).reshape(b.num_rows, len(queries))
            opened: dict[int, Block] = {}
            for q in range(len(queries)):
                terms = queries.flat[queries.starts[q] : queries.starts[q + 1]]
                for i in np.argsort(-bounds[:, q], kind="stable").tolist():
                    if bounds[i, q] < max(1, top.floor[q]):
                        break
                    if i not in opened:
                        opened[i] = Block(queries, *(columns[c][i].as_py() for c in ("terms", "ids", "sizes", "starts", "which", "times")))
                    top.add(q, opened[i].ids, opened[i].scores(terms))
        yield top.rows()

    return run


_HITS = "q int, score bigint, d bigint"


def _order() -> list:
    return [F.col("score").desc(), F.col("d") == _NONE, F.col("d")]


def ranked(index: DataFrame, queries: Queries, best: int = BEST) -> DataFrame:
    """(q, rank, d, score): the best documents for each of a bounded list of queries, d the least integer for a null id."""
    seen = index.select("docs", "length", "terms", "df").mapInArrow(_totals(queries), "t int, n bigint").groupBy("t").agg(F.sum("n").alias("n"))
    df = np.zeros(len(queries.vocabulary) + 2, np.int64)
    # bounded: the terms of the queries at hand
    for r in seen.collect():
        df[r["t"]] = r["n"]
    known = queries.weigh(df[:-2], int(df[-2]), int(df[-1]))
    per = Window.partitionBy("q").orderBy(F.col("bound").desc(), "block")
    first = index.select("block", "terms", "most", "least").mapInArrow(_foremost(known, FIRST_BLOCKS), "q int, block bigint, bound bigint")
    # bounded: FIRST_BLOCKS blocks for each query
    chosen = sorted({r["block"] for r in first.withColumn("r", F.row_number().over(per)).where(F.col("r") <= FIRST_BLOCKS).select("block").distinct().collect()})
    floor = np.zeros(len(queries), np.int64)
    place = F.row_number().over(Window.partitionBy("q").orderBy(*_order()))
    if chosen:
        hits = index.where(F.col("block").isin(chosen)).mapInArrow(_searched(known, floor, best), _HITS)
        for r in hits.withColumn("r", place).where(F.col("r") == best).collect():
            floor[r["q"]] = r["score"]
    hits = index.mapInArrow(_searched(known, floor, best), _HITS)
    return hits.withColumn("rank", place).where(F.col("rank") <= best).select("q", "rank", "d", "score")


def ranked_search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", best: int = BEST, index: DataFrame | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `best` documents with a score above 0."""
    index = build_index(docs, doc_id, text) if index is None else index
    asked = items.select(F.col(item_id).alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("t"))
    texts = asked.groupBy(F.sha2("t", 256).alias("k")).agg(F.min("t").alias("t"))
    n, size = texts.agg(F.count("*"), F.sum(F.octet_length("t"))).first()
    rounds = max(1, -(-n // ITEMS), -(-(size or 0) // ITEM_BYTES))
    out = None
    for part in range(rounds):
        # bounded: about ITEMS items, whose texts are dealt by their hashes
        own = texts.where(F.pmod(F.xxhash64("k"), F.lit(rounds)) == part).orderBy("k").collect()
        if not own:
            continue
        names = docs.sparkSession.createDataFrame([(q, r["k"]) for q, r in enumerate(own)], "q int, k string")
        hits = ranked(index, Queries.of([r["t"] for r in own]), best).join(F.broadcast(names), "q").drop("q")
        out = hits if out is None else out.unionByName(hits)
    who = asked.select("item", F.sha2("t", 256).alias("k")).distinct()
    if out is None:
        return who.select(F.col("item").alias("item_id"), F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).limit(0)
    return who.join(out, "k").select(F.col("item").alias("item_id"), "rank", F.when(F.col("d") != _NONE, F.col("d")).alias("doc_id"), "score")


SEARCH_SQL = rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM t),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM t) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT item_id, term, floor(1000 * ln((2.0 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM q JOIN f USING (term), s),
m AS (SELECT r, doc_id, {100 - HALF} + ({HALF} * len(w) * n) // l AS m FROM t, s),
scored AS (
  SELECT item_id, r, doc_id, sum(w * (({ONE} * tf) // ({SCALE} * tf + {SATURATION} * m)))::BIGINT AS score FROM w JOIN p USING (term) JOIN m USING (r) GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= {BEST}
"""
