"""A quality score written out by hand, and the settings against others within the training folds."""

import math

import pytest
import zstandard
from llm_cases import prose

from cytoframe.llm import quality

GOOD = [prose(i, 80) for i in range(40)]
BAD = ["!! buy %d now $$$ cheap %d " % (i, i * 7) * 30 for i in range(40)]


@pytest.mark.parametrize("text", ["", "a", prose(99, 30), prose(98, 900), BAD[3], "é東😀" * 5000])
def test_score(text):
    model = quality.fit_texts(GOOD, BAD, 0.7)
    kind = zstandard.DICT_TYPE_RAWCONTENT if model.raw else zstandard.DICT_TYPE_AUTO
    sizes = []
    data = text.encode()
    blocks = [data[i : i + 1024] for i in range(0, len(data), 1024)] or [b""]
    for d in (model.good, model.bad):
        pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d, dict_type=kind), write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes.append([len(pack.compress(b)) for b in blocks])
    n = max(1, len(data))
    mean = sum(min(0.1, max(-0.1, (y - x) / max(1, len(b)))) * len(b) for x, y, b in zip(*sizes, blocks, strict=True)) / n
    terms = [1, mean, sum(sizes[0]) / n, math.log(n), mean * math.log(n)]
    z = sum(w * t for w, t in zip(model.weights, terms, strict=True))
    assert quality.Scorer(model).scores([text])[0] == pytest.approx(1 / (1 + math.exp(-max(-500, min(500, z)))), rel=1e-9)


def test_length_does_not_saturate():
    scorer = quality.fit_texts(GOOD, BAD, 0.7).scorer()
    a, b = (scorer.features("word " * n)[3] for n in (2000, 20000))
    assert b - a == pytest.approx(math.log(10))


def test_little_text_keeps_whole_blocks():
    model = quality.fit_texts(["a" * 300, "b" * 700], ["c" * 400, "d" * 900], 0.5)
    assert model.raw and model.good == b"a" * 300 and model.bad == b"c" * 300


def test_cross_validation_tells_settings_apart():
    assert quality.cross_validated(GOOD, BAD) < math.log(2)
    assert quality.cross_validated(GOOD, GOOD) > math.log(2) - 0.05
