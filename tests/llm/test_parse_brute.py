"""The parse of op6 against one written symbol by symbol, and the gradients of op1 against differences."""

import numpy as np
import pytest
from llm_cases import prose

from cytoframe.llm import fingerprints, langid

WORD = (1 << 64) - 1


def mix(x):
    x = ((x ^ x >> 32) * 0x9E3779B97F4A7C15) & WORD
    x = ((x ^ x >> 29) * 0xD6E8FEB86659FD93) & WORD
    return x ^ x >> 32


def label(left, own):
    """Position and value of the lowest bit in which a symbol differs from its left neighbour."""
    low = 0
    while (left >> low & 1) == (own >> low & 1):
        low += 1
    return 2 * low + (own >> low & 1)


def brute_levels(text):
    """Names of each level, one list a level."""
    symbols, levels = [ord(c) for c in text], []
    while symbols:
        runs = []
        for s in symbols:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1])
        symbols = [s if n == 1 else mix((s * 3 + mix(n)) & WORD) for s, n in runs]
        labels = [label(symbols[i - 1], s) if i else s & 1 for i, s in enumerate(symbols)]
        for _ in range(3):
            labels = [label(labels[i - 1] if i else v ^ 1, v) for i, v in enumerate(labels)]
        begins = [i for i in range(len(symbols)) if i == 0 or (i < len(symbols) - 1 and labels[i - 1] < labels[i] > labels[i + 1])]
        weights = [mix(i) | 1 for i in range(1, 257)]
        names = []
        for a, b in zip(begins, [*begins[1:], len(symbols)], strict=True):
            names.append(mix((sum(mix(s) * weights[i & 255] for i, s in enumerate(symbols[a:b])) + b - a) & WORD))
        levels.append(names)
        symbols = names if len(names) > 1 else []
    return levels


def brute_bins(text):
    least = {}
    for level, names in enumerate(brute_levels(text)):
        for n in names:
            h = mix(n ^ 0xA5A5A5A5)
            bin_ = 48 + (h >> 32) * 16 // 2**32 if level == 0 else (h >> 32) * 48 // 2**32
            least[bin_] = min(least.get(bin_, WORD), h << 32 & WORD)
    return [mix(least[b]) & 0xFFFF if b in least else -1 for b in range(64)]


TEXTS = ["", "a", "ab", "aaaa", "ab" * 40, "x" * 127, prose(4, 20)[:126], prose(4, 20)[:129], prose(5, 300), "häuser 東京 😀 " * 12, "\ud800 lone"]


@pytest.mark.parametrize("text", TEXTS)
def test_parse(text):
    got = [n.tolist() for _, n in fingerprints.levels([text])]
    assert got == brute_levels(text)
    assert [n.tolist() for _, n in fingerprints.signatures([text])] == got[1:]
    assert fingerprints.fingerprint_bins(["other text", text])[1].tolist() == brute_bins(text)


def test_one_rule_for_all_lengths():
    """Texts just below and above 128 characters that differ in their ends are alike."""
    text = prose(6, 40)
    bins = fingerprints.fingerprint_bins([text[:126], text[:130]])
    assert fingerprints.likeness(bins[:1], bins[1:])[0] > 0.6


@pytest.mark.parametrize("back", (False, True))
def test_gradients_against_differences(back):
    """Back-propagation through time against central differences, at every recurrent weight and the inputs in use."""
    rng = np.random.default_rng(3)
    hidden, steps, n = 3, 6, 4
    x = rng.integers(0, 5, (steps, n))
    w = np.zeros((langid.PAD + 1, 2 * hidden))
    w[:5] = rng.standard_normal((5, 2 * hidden)) * 0.5
    u = rng.standard_normal((hidden, 2 * hidden)) * 0.5
    weight = rng.standard_normal((steps, n, hidden))
    order = range(steps - 1, -1, -1) if back else range(steps)

    def loss():
        kept = langid._forward(x, w, u, order)
        return sum(float((weight[t] * kept[t][4]).sum()) for t in order)

    dw, du = langid._backward(x, langid._forward(x, w, u, order), weight, w, u, order)
    for table, grad, rows in ((w, dw, 5), (u, du, hidden)):
        for i in range(rows):
            for j in range(2 * hidden):
                was, step = table[i, j], 1e-5
                table[i, j] = was + step
                up = loss()
                table[i, j] = was - step
                down = loss()
                table[i, j] = was
                assert grad[i, j] == pytest.approx((up - down) / (2 * step), rel=2e-3, abs=2e-4)
