"""Nucleotide sequences as strings, compared by built-in higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = ("A", "C", "G", "T")


def _positions(s: Column) -> Column:
    return F.sequence(F.lit(1), F.length(s))


def _at(s: Column, i: Column) -> Column:
    return F.substring(s, i, F.lit(1))


def hamming(a: Column, b: Column) -> Column:
    """Number of differing positions of two sequences of one length; null if lengths differ."""
    differ = F.size(F.filter(_positions(a), lambda i: _at(a, i) != _at(b, i)))
    return F.when(F.length(a) == F.length(b), F.when(F.length(a) == 0, F.lit(0)).otherwise(differ))


def hamming_up_to(a: Column, b: Column, longest: int) -> Column:
    """Hamming distance of sequences of one length, `longest` at most, as a plain sum: compiled, unlike a higher-order function."""
    total = F.lit(0)
    for i in range(1, longest + 1):
        total = total + F.when(F.substring(a, i, 1) != F.substring(b, i, 1), 1).otherwise(0)
    return total


def packed(s: Column) -> Column:
    """Two bits for each base, A 0, C 1, G 2, T 3, of up to 31 bases, as a bigint."""
    code = lambda c: F.when(c == "A", 0).when(c == "C", 1).when(c == "G", 2).otherwise(3).cast("bigint")
    return F.aggregate(_positions(s), F.lit(0).cast("bigint"), lambda acc, i: acc * 4 + code(_at(s, i)))


def packed_hamming(a: Column, b: Column) -> Column:
    """Hamming distance of packed sequences by one XOR and a bit count."""
    x = a.bitwiseXOR(b)
    low = F.lit(0x5555555555555555)
    return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(low))


def neighbours(s: Column) -> Column:
    """All sequences at Hamming distance one: 3 for each position."""
    swap = lambda i, b: F.concat(F.substring(s, F.lit(1), i - 1), b, F.substring(s, i + 1, F.length(s)))
    return F.flatten(F.transform(_positions(s), lambda i: F.transform(F.filter(F.array(*map(F.lit, BASES)), lambda b: b != _at(s, i)), lambda b: swap(i, b))))


def expand_n(s: Column, max_n: int) -> Column:
    """All ways to replace N by bases; empty where the sequence has more than max_n of them."""
    n = F.length(s) - F.length(F.replace(s, F.lit("N"), F.lit("")))
    grown = F.aggregate(
        F.split(s, ""),
        F.array(F.lit("")),
        lambda acc, c: F.when(c == "", acc).otherwise(F.flatten(F.transform(acc, lambda p: F.when(c == "N", F.transform(F.array(*map(F.lit, BASES)), lambda b: F.concat(p, b))).otherwise(F.array(F.concat(p, c)))))),
    )
    return F.when(n <= max_n, grown).otherwise(F.array().cast("array<string>"))


def substrings(s: Column, length: Column) -> Column:
    """array<struct<at, part>> of all substrings of a length, positions from 1."""
    starts = F.when(F.length(s) >= length, F.sequence(F.lit(1), F.length(s) - length + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.substring(s, i, length).alias("part")))


def lowercase_mismatches(ref: Column, query: Column) -> Column:
    """The query with bases in lower case where they differ from the reference."""
    return F.array_join(F.transform(_positions(query), lambda i: F.when(_at(ref, i) == _at(query, i), _at(query, i)).otherwise(F.lower(_at(query, i)))), "")


def error_probability(qual: Column) -> Column:
    """10 ** (-(Q - 33) / 10) of a quality character."""
    return F.pow(F.lit(10.0), -(F.ascii(qual) - 33) / 10.0)
