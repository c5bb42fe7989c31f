"""FASTQ files in splits of any size, in every packing, against the records that were written."""

import gzip
import random
import struct
import zlib

import pytest

from cytoframe.sources import fastq as source
from cytoframe.sources import reads


def block(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def blocked(data: bytes, size: int = 700) -> bytes:
    return b"".join(block(data[i : i + size]) for i in range(0, len(data), size)) + block(b"")


PACK = {"plain": lambda d: d, "gzip": gzip.compress, "members": lambda d: gzip.compress(d[: len(d) // 3]) + gzip.compress(d[len(d) // 3 :]), "blocks": blocked}


def some(n: int, seed: int = 1, longest: int = 60):
    r = random.Random(seed)
    seq = lambda k: "".join(r.choice("ACGTN") for _ in range(k))
    # names and qualities may start with the record's own mark
    return [(f"@r{i} {'x' * r.randrange(9)}", seq(28), "@" * 28, seq(k := r.randrange(longest)), "".join(r.choice("@+I#") for _ in range(k))) for i in range(n)]


def text(rows, second=False, end="\n"):
    pick = (0, 3, 4) if second else (0, 1, 2)
    return "".join(f"{r[pick[0]]}{end}{r[pick[1]]}{end}+{end}{r[pick[2]]}{end}" for r in rows).encode()


def put(path, data):
    path.write_bytes(data)
    return str(path)


@pytest.mark.parametrize("one,two", [("plain", "plain"), ("blocks", "blocks"), ("plain", "blocks"), ("gzip", "gzip"), ("members", "plain")])
def test_pairs_in_any_split(spark, tmp_path, one, two):
    rows = some(300)
    r1, r2 = put(tmp_path / "s_R1_001.fastq", PACK[one](text(rows))), put(tmp_path / "s_R2_001.fastq", PACK[two](text(rows, True)))
    want = [(i, r[0], r[1], r[2], r[3], r[4]) for i, r in enumerate(rows)]
    size = (tmp_path / "s_R1_001.fastq").stat().st_size
    for chunk in (1 << 20, -(-size // 7), 97):
        df = reads.fastq_pairs(spark, r1, r2, chunk)
        assert "Exchange" not in df._jdf.queryExecution().toString()
        parts = df.rdd.getNumPartitions()
        assert parts == (1 if "gzip" in (one, two) or "members" in (one, two) or chunk == 1 << 20 else parts)
        if one == two and one in ("plain", "blocks") and chunk == -(-size // 7):
            assert parts == 7
        assert sorted(tuple(r)[1:] for r in df.collect()) == want
        assert {r["pair"] for r in df.select("pair").distinct().collect()} == {"s_R?_001.fastq"}


def test_every_split_of_a_small_file(tmp_path):
    """Every chunk size, without Spark: the same records, each once."""
    rows = some(9, longest=7)
    for name in ("plain", "blocks"):
        pack = (lambda d: blocked(d, 40)) if name == "blocks" else PACK[name]
        paths = [put(tmp_path / f"{name}{k}", pack(text(rows, k == 1))) for k in (0, 1)]
        for chunk in range(1, 200, 3 if name == "plain" else 11):
            tracks = []
            for p in paths:
                size = len(open(p, "rb").read())
                tracks.append((p, [(name, *source.lines_of_chunk(p, name, lo, lo + chunk)) for lo in range(0, size, chunk)]))
            got = []
            for s in source.splits_of("k", tracks):
                for b in source.records_of(source.Split(*s), ["k", "rec", "n", "s1", "q1", "s2", "q2"]):
                    got += list(zip(*(b.column(i).to_pylist() for i in range(1, 7))))
            assert got == [(i, *r) for i, r in enumerate(rows)]


def test_unequal_pairs_and_cut_records(spark, tmp_path):
    rows = some(50)
    whole = put(tmp_path / "whole", text(rows))
    for n, cut in enumerate((text(rows[:-1], True), text(rows, True) + text(rows[:2], True), text(rows, True)[:-3], b"\n".join(text(rows, True).split(b"\n")[:-3]) + b"\n", text(rows, True)[:-1])):
        for pack in ("plain", "gzip", "blocks"):
            other = put(tmp_path / f"other{n}{pack}", PACK[pack](cut))
            for chunk in (1 << 20, 500):
                with pytest.raises(Exception, match="incomplete"):
                    reads.fastq_pairs(spark, whole, other, chunk).collect()
    torn = put(tmp_path / "torn", gzip.compress(text(rows))[:-20])
    with pytest.raises(Exception, match="incomplete"):
        reads.fastq(spark, torn).collect()


def test_single_files_folders_and_line_ends(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = some(40)
    put(tmp_path / "in/a.fastq", text(rows, end="\r\n"))
    put(tmp_path / "in/b.fastq.gz", gzip.compress(text(rows[:5])))
    put(tmp_path / "in/_SUCCESS", b"")
    put(tmp_path / "in/empty.fastq", b"")
    got = reads.fastq(spark, str(tmp_path / "in"), 300).collect()
    assert sorted((r["file"].rsplit("/")[-1], r["rec"], r["name"], r["seq"], r["qual"]) for r in got) == sorted([("a.fastq", i, *r[:3]) for i, r in enumerate(rows)] + [("b.fastq.gz", i, *r[:3]) for i, r in enumerate(rows[:5])])
    with pytest.raises(FileNotFoundError):
        reads.fastq(spark, str(tmp_path / "none*"))
    with pytest.raises(ValueError, match="R2"):
        reads.fastq_pairs(spark, str(tmp_path / "in"), str(tmp_path / "in/a.fastq"))
