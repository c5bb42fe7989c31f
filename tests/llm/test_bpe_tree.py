"""The codec's own merges and joins against the library, which only tests call."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cytoframe.llm import bpe, queries


@pytest.fixture(scope="module")
def codec():
    return bpe.TreeCodec(queries.ranks_path(), queries.split_pattern())


def test_operators_never_call_the_library(codec, monkeypatch):
    monkeypatch.setattr(bpe, "encoding", None)
    ids = codec.encode("Some words, 12 of them; naïve 日本語 text.\n" * 40)
    assert codec.decode(ids).decode() == "Some words, 12 of them; naïve 日本語 text.\n" * 40


def test_every_character(codec):
    for k in [*range(0, 0x3100), *range(0x3100, 0x110000, 97)]:
        if not 0xD800 <= k < 0xE000:
            c = chr(k)
            text = f"a{c}1{c} {c}{c}  {c}x"
            assert codec.encode(text) == codec.base.encode_ordinary(text), hex(k)


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=60) | st.text("abeinrst", min_size=1, max_size=60).map(str.encode))
def test_halves_equal_one_merge_loop(data):
    codec = bpe.TreeCodec(queries.ranks_path(), queries.split_pattern())
    ids = codec._halves(data)
    assert ids == codec._merged(data)
    assert all(codec._apart(a, b) for a, b in zip(ids, ids[1:]))


def test_long_runs_take_near_linear_time(codec):
    r = random.Random(1)
    for text in ("a" * 200_000, "".join(r.choice("abcdefg") for _ in range(200_000)), "pre fix " + "é" * 100_000 + " and after"):
        start = time.perf_counter()
        ids = codec.encode(text)
        assert time.perf_counter() - start < 30 and codec.decode(ids).decode() == text


@pytest.mark.parametrize("leaf", (1, 7, 64))
def test_mixed_long_texts(leaf):
    codec = bpe.TreeCodec(queries.ranks_path(), queries.split_pattern(), leaf)
    r = random.Random(leaf)
    for _ in range(20):
        text = "".join(r.choice(["word ", "\n", "  ", "12345", "é", "aaaa" * r.randrange(20), "'ll", "...", "日本", "\x1c", "　"]) for _ in range(200))
        assert codec.encode(text) == codec.base.encode_ordinary(text)
