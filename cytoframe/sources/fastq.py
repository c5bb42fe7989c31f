"""FASTQ files as a Spark data source: splits start at record borders, and the two files of a pair are read in lock step.

Plain files and blocked gzip (BGZF) are splittable; other gzip files are read by one task each. A first job counts the lines of
every chunk (a byte range, or the blocks that start in it), one narrow row a chunk. From those counts the place of any record
is known in either file, although records of R1 and R2 have different lengths: the chunk that holds its first line, and how
many lines to skip there. A task then opens both files at its first record and reads them side by side, so nothing is
shuffled. A record that is cut short, or a file of a pair that ends before the other, is an error.

Files are opened through pyarrow's file systems, in tasks and never in the driver; listing goes through Hadoop's.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of one chunk, bytes read at once, and records of one batch.
CHUNK, PIECE, BATCH = 64 << 20, 1 << 20, 8192
INCOMPLETE = "incomplete FASTQ record"
_BLOCK = b"\x1f\x8b\x08\x04"


def open_file(path: str) -> pa.NativeFile:
    if "://" in path and not path.startswith("file:"):
        files, inner = pa.fs.FileSystem.from_uri(path)
        return files.open_input_file(inner)
    return pa.fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path)


def block_size(head: bytes) -> int:
    """Size of the BGZF block that starts with these bytes, 0 if none does."""
    if len(head) < 18 or head[:4] != _BLOCK:
        return 0
    extra, at = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]], 0
    while at + 4 <= len(extra):
        size = struct.unpack_from("<H", extra, at + 2)[0]
        if extra[at : at + 2] == b"BC" and size == 2 and at + 6 <= len(extra):
            return struct.unpack_from("<H", extra, at + 4)[0] + 1
        at += 4 + size
    return 0


def kind_of(path: str) -> str:
    with open_file(path) as f:
        head = f.read(64)
    return "blocks" if block_size(head) else "gzip" if head[:2] == b"\x1f\x8b" else "plain"


def first_block(f: pa.NativeFile, lo: int, hi: int, size: int) -> int:
    """Where the first block that starts in [lo, hi) starts, hi if none does. A true block is followed by another or by the end."""
    if lo == 0:
        return 0
    f.seek(lo)
    # a header that starts before hi may reach beyond it
    data = f.read(min(hi - lo + 64, size - lo))
    at = data.find(_BLOCK)
    while 0 <= at < hi - lo:
        n = block_size(data[at : at + 64])
        if n:
            f.seek(lo + at + n)
            follow = f.read(64)
            if block_size(follow) or not follow:
                return lo + at
        at = data.find(_BLOCK, at + 1)
    return hi


def lines_of_chunk(path: str, kind: str, lo: int, hi: int) -> tuple[int, int]:
    """(offset where reading of a chunk starts, line ends in it)."""
    with open_file(path) as f:
        size = f.size()
        if kind == "plain":
            f.seek(lo)
            n, left = 0, min(hi, size) - lo
            while left > 0 and (piece := f.read(min(PIECE, left))):
                n, left = n + piece.count(b"\n"), left - len(piece)
            return lo, n
        at = start = first_block(f, lo, min(hi, size), size)
        n = 0
        while at < min(hi, size):
            f.seek(at)
            own = block_size(f.read(64))
            if not own:
                raise ValueError(f"{path}: no block at {at}")
            f.seek(at)
            n, at = n + zlib.decompress(f.read(own), 31).count(b"\n"), at + own
        return start, n


def pieces(path: str, kind: str, offset: int) -> Iterator[bytes]:
    """The uncompressed bytes from an offset to the end of the file."""
    with open_file(path) as f:
        f.seek(offset)
        if kind == "plain":
            while piece := f.read(PIECE):
                yield piece
            return
        member, begun = zlib.decompressobj(31), False
        while piece := f.read(PIECE):
            while piece:
                begun = True
                yield member.decompress(piece)
                piece = member.unused_data
                if member.eof:
                    member, begun = zlib.decompressobj(31), False
                else:
                    break
        if begun:
            raise ValueError(f"{INCOMPLETE}: {path} ends inside compressed data")


class Track:
    """Whole lines of a file from a place on, by the thousand."""

    def __init__(self, path: str, kind: str, offset: int, skip: int):
        self.path, self.rest, self.lines, self.ended = path, b"", [], False
        self._pieces = pieces(path, kind, offset)
        while skip and not self.ended:
            self.fill()
            skip -= (n := min(skip, len(self.lines)))
            self.lines = self.lines[n:]

    def fill(self) -> None:
        piece = next(self._pieces, None)
        if piece is None:
            self.ended = True
            if self.rest:
                raise ValueError(f"{INCOMPLETE} at the end of {self.path}")
            return
        *more, self.rest = (self.rest + piece).split(b"\n")
        self.lines += [x[:-1] for x in more] if more and more[0].endswith(b"\r") else more

    def records(self) -> int:
        """Whole records at hand, at least one unless the file has ended."""
        while len(self.lines) < 4 and not self.ended:
            self.fill()
        if self.ended and len(self.lines) % 4 and len(self.lines) < 4:
            raise ValueError(f"{INCOMPLETE} at the end of {self.path}")
        return len(self.lines) // 4

    def take(self, n: int) -> tuple[list[bytes], list[bytes], list[bytes]]:
        own, self.lines = self.lines[: 4 * n], self.lines[4 * n :]
        return own[0::4], own[1::4], own[3::4]


@dataclass
class Split(InputPartition):
    """Records [lo, hi) of one file or pair; hi is -1 to read to the end. places are (path, kind, offset, lines to skip)."""

    key: str
    lo: int
    hi: int
    places: list


@dataclass
class Chunk(InputPartition):
    path: str
    lo: int
    hi: int


def records_of(split: Split, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of key, record number, and name, bases and quality of the first file, bases and quality of a second one."""
    tracks, at = [Track(*p) for p in split.places], split.lo
    while split.hi < 0 or at < split.hi:
        have = [t.records() for t in tracks]
        n = min(*have, BATCH) if len(have) > 1 else min(have[0], BATCH)
        if not n:
            if any(have):
                raise ValueError(f"{INCOMPLETE}: {tracks[have.index(0)].path} has fewer records than the other file of its pair")
            if split.hi >= 0:
                raise ValueError(f"{INCOMPLETE}: {tracks[0].path} ends before record {split.hi}")
            return
        n = n if split.hi < 0 else min(n, split.hi - at)
        columns = [pa.array([split.key] * n), pa.array(range(at, at + n), pa.int64())]
        for i, t in enumerate(tracks):
            columns += [pa.array(c, pa.string()) for c in t.take(n)[min(i, 1) :]]
        yield pa.RecordBatch.from_arrays(columns, names=names)
        at += n


class _Chunks(DataSourceReader):
    def __init__(self, options):
        self.chunks = [Chunk(*c) for c in json.loads(options["chunks"])]

    def partitions(self):
        return self.chunks

    def read(self, chunk: Chunk):
        kind = kind_of(chunk.path)
        # other gzip files are one chunk, which needs no count
        start, n = (0, -1) if kind == "gzip" else lines_of_chunk(chunk.path, kind, chunk.lo, chunk.hi)
        yield chunk.path, kind, chunk.lo, start, n


class FastqChunks(DataSource):
    """(path, kind, lo, start, lines) of every chunk of the files."""

    @classmethod
    def name(cls):
        return "cytoframe_fastq_chunks"

    def schema(self):
        return "path string, kind string, lo bigint, start bigint, lines bigint"

    def reader(self, schema):
        return _Chunks(self.options)


class _Records(DataSourceReader):
    def __init__(self, options, names):
        self.splits, self.names = [Split(*s) for s in json.loads(options["splits"])], names

    def partitions(self):
        return self.splits

    def read(self, split: Split):
        yield from records_of(split, self.names)


class FastqRecords(DataSource):
    """(file, rec, name, seq, qual) of single files."""

    @classmethod
    def name(cls):
        return "cytoframe_fastq"

    def schema(self):
        return "file string, rec bigint, name string, seq string, qual string"

    def reader(self, schema):
        return _Records(self.options, ["file", "rec", "name", "seq", "qual"])


class FastqPairs(DataSource):
    """(pair, rec, r1_name, r1_seq, r1_qual, r2_seq, r2_qual) of pairs of files."""

    @classmethod
    def name(cls):
        return "cytoframe_fastq_pairs"

    def schema(self):
        return "pair string, rec bigint, r1_name string, r1_seq string, r1_qual string, r2_seq string, r2_qual string"

    def reader(self, schema):
        return _Records(self.options, ["pair", "rec", "r1_name", "r1_seq", "r1_qual", "r2_seq", "r2_qual"])


def listed(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int]]:
    """(path, bytes) of the files that paths, folders or patterns name, by name; hidden files and markers are left out."""
    out = []
    for one in [path] if isinstance(path, str) else path:
        p = spark._jvm.org.apache.hadoop.fs.Path(one)
        files = p.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in files.globStatus(p) or []:
            inner = files.listStatus(found.getPath()) if found.isDirectory() else [found]
            out += sorted((s.getPath().toString(), s.getLen()) for s in inner if not s.isDirectory() and not s.getPath().getName().startswith(("_", ".")))
    if not out:
        raise FileNotFoundError(f"no FASTQ file at {path}")
    return out


def _place(chunks: list[tuple[str, int, int]], record: int) -> tuple[int, int]:
    """(offset, lines to skip) of a record: the last chunk that starts inside an earlier line, or the first one."""
    before, best = 0, (chunks[0][1], 4 * record)
    for _, start, lines in chunks:
        if before < 4 * record:
            best = (start, 4 * record - before)
        before += lines
    return best


def splits_of(key: str, tracks: list[tuple[str, list[tuple[str, int, int]]]]) -> list[list]:
    """Splits of a file or pair, one for each chunk of the first file in which a record starts; tracks are (path, chunks as (kind, start, lines))."""
    if any(c[0][0] == "gzip" for _, c in tracks):
        starts = [0]
    else:
        before, starts = 0, []
        for _, _, lines in tracks[0][1]:
            starts.append(-(-before // 4))
            before += lines
        starts = sorted(s for s in set(starts) if s == 0 or 4 * s < before)
    ends = [*starts[1:], -1]
    return [[key, lo, hi, [[path, c[0][0], *(_place(c, lo) if c[0][0] != "gzip" else (0, 4 * lo))] for path, c in tracks]] for lo, hi in zip(starts, ends)]


def read_fastq(spark: SparkSession, files: list[tuple[str, list[tuple[str, int]]]], chunk: int = CHUNK) -> DataFrame:
    """Records of files or pairs; files are (key, one or two (path, bytes)), all alike."""
    for source in (FastqChunks, FastqRecords, FastqPairs):
        spark.dataSource.register(source)
    sizes = {path: size for _, own in files for path, size in own}
    asked = [[path, lo, lo + chunk] for path, size in sizes.items() for lo in range(0, max(1, size), chunk)]
    # one row for each chunk, so what comes to the driver is a few bytes for every CHUNK of them
    found: dict[str, list] = {}
    for r in sorted(spark.read.format(FastqChunks.name()).option("chunks", json.dumps(asked)).load().collect(), key=lambda r: (r["path"], r["lo"])):
        found.setdefault(r["path"], []).append((r["kind"], r["start"], r["lines"]))
    splits = [s for key, own in files for s in splits_of(key, [(path, found[path]) for path, _ in own])]
    kind = FastqRecords if len(files[0][1]) == 1 else FastqPairs
    return spark.read.format(kind.name()).option("splits", json.dumps(splits)).load()
