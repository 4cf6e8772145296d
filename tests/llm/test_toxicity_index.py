"""The nearest labelled examples against brute force over every term of every example."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ternion.llm import toxicity


def corpus(n, seed):
    rng = random.Random(seed)
    common, rare, bad = [f"c{i}" for i in range(30)], [f"r{i}" for i in range(3000)], ["scum", "moron", "trash"]
    rows = []
    for i in range(n):
        words = rng.choices(common, k=rng.randint(0, 60)) + rng.choices(rare, k=rng.randint(0, 30))
        mark = i % 9 == 0
        rows.append((i, " ".join([*words, *([rng.choice(bad)] if mark else [])]), mark))
    return [*rows, (n, "", False), (n + 1, "c1 c1 c1", False), (n + 2, "c1 c1 c1", True)]


def naive(rows):
    """(doc_id -> unit vector) by dictionary arithmetic, and the factor of each term."""
    bags = {i: Counter(t.split()) for i, t, _ in rows}
    marks = {i: m for i, _, m in rows}
    df, pos, n = Counter(), Counter(), len(rows)
    for i, b in bags.items():
        for w in b:
            df[w] += 1
            pos[w] += marks[i]
    share = (sum(marks.values()) + 0.5) / (n + 1)
    factor = {}
    for w in df:
        odds = math.log((pos[w] + toxicity.SHRINK * share) / (df[w] - pos[w] + toxicity.SHRINK * (1 - share))) - math.log(share / (1 - share))
        factor[w] = (math.log((n + 1) / (df[w] + 1)) + 1) * abs(odds) ** toxicity.POWER
    return {i: unit(b, factor) for i, b in bags.items()}, factor


def unit(bag, factor):
    v = {w: (1 + math.log(c)) * factor[w] for w, c in bag.items() if w in factor}
    size = math.sqrt(sum(x * x for x in v.values()))
    return {w: x / size for w, x in v.items()} if size else {}


@pytest.mark.parametrize("n", [3, 40, 1100])
def test_exact(n):
    rows = corpus(n, n)
    vectors, factor = naive(rows)
    ids, marks = np.array([r[0] for r in rows]), np.array([float(r[2]) for r in rows])
    index = toxicity.build(ids, marks, *toxicity.term_counts(pa.array([r[1] for r in rows])))
    asked = corpus(60, 99) + [(0, "unknown words only", False)]
    hashes, owner, count = toxicity.term_counts(pa.array([r[1] for r in asked]))
    cols, owner, v = index.known(hashes, owner, count)
    for k, (_, text, _) in enumerate(asked):
        q = unit(Counter(text.split()), factor)
        want = sorted((sum(x * d.get(w, 0.0) for w, x in q.items()) for d in vectors.values()), reverse=True)[: toxicity.NEIGHBOURS]
        found, sims = index.nearest(cols[owner == k], v[owner == k])
        assert np.allclose(sims, want[: len(sims)], atol=1e-5) and all(x < 1e-5 for x in want[len(sims) :])
        for i, s in zip(index.ids[found].tolist(), sims, strict=True):
            assert abs(sum(x * vectors[i].get(w, 0.0) for w, x in q.items()) - s) < 1e-5


def test_rare_terms_of_more_rows_teach():
    """A word of four rows decides as one of a hundred does: no term is left out."""
    rows = [(i, "plain words here " + ("zzz" if i < 4 else f"n{i}"), i < 4) for i in range(200)]
    ids, marks = np.array([r[0] for r in rows]), np.array([float(r[2]) for r in rows])
    index = toxicity.learn(ids, marks, *toxicity.term_counts(pa.array([r[1] for r in rows])))
    votes, _ = toxicity._votes(index, *toxicity.term_counts(pa.array(["other zzz text", "plain words", "never seen"])), 3)
    assert votes[0] > 0.9 and votes[1] < 0.3 and np.isnan(votes[2])
