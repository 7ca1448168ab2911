"""The Viterbi readings against all paths of short lattices."""

import itertools

import numpy as np
import pytest

from strata.llm import toxicity as t


@pytest.fixture(scope="module")
def model():
    """Log probabilities of a random character model."""
    p = np.random.default_rng(5).gamma(0.7, size=(t.CLASSES, t.CLASSES, t.CLASSES))
    return np.log(p / p.sum(axis=2, keepdims=True) + 1e-3).tolist()


def scored(letters, cost, model):
    a = b = 0
    total = -cost
    for c in [*letters, None]:
        k = 0 if c is None else t.CLASS.get(c, t.OTHER)
        total += model[a][b][k]
        a, b = b, k
    return total


def readings(token, model, joins=0):
    """(score, letters) of every path of a token's lattice."""
    for path in itertools.product(*t.lattice(token)):
        yield scored("".join(x for x, _ in path), sum(c for _, c in path), model), "".join(x for x, _ in path)


@pytest.mark.parametrize("token", ["idiot", "1d10t", "m0r0n", "st@@rr", "l0ooo$er", "i.d.i.o.t", "66", "b-1-t", "éé3", "!!!", "a", "|o|"])
def test_restore_is_the_best_path(model, token):
    best = max(s for s, _ in readings(token, model))
    got = t.restore(token, model)
    assert got in {x for s, x in readings(token, model) if s >= best - 1e-9}


@pytest.mark.parametrize("pieces", [("a", "b"), ("y", "o", "u"), ("st", "up", "1d"), ("a", "l", "0", "s", "3"), ("i", "am", "a", "m", "@")])
def test_likely_spans_are_those_of_all_readings(model, pieces):
    """Every division of a row into words, each word by its best path; spans of those not more than MARGIN below the best."""
    n = len(pieces)
    word = {}
    for i in range(n):
        for j in range(i + 1, n + 1):
            lattice = [step for p in pieces[i:j] for step in t.lattice(p)]
            best = max(scored("".join(x for x, _ in path), sum(c for _, c in path), model) for path in itertools.product(*lattice))
            word[i, j] = best - t.JOINED * (j - i - 1)
    rows = []
    for cuts in itertools.product([False, True], repeat=n - 1):
        edge = [0, *(i + 1 for i, c in enumerate(cuts) if c), n]
        spans = list(zip(edge[:-1], edge[1:], strict=True))
        rows.append((sum(word[s] for s in spans), spans))
    best = max(s for s, _ in rows)
    want = {span for s, spans in rows if s >= best - t.MARGIN + 1e-9 for span in spans if span[1] - span[0] > 1}
    assert set(t.likely_spans(pieces, model)) == want
