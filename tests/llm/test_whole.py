"""Results over large groups, where a cut would show."""

import random

import numpy as np
import pytest

pytest.importorskip("xxhash")

from spliceloom.llm import minhash


def test_links_of_a_hot_group_are_whole(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8))
    template = [word() for _ in range(80)]
    rows = []
    for i in range(250):
        own = [word() for _ in range(10)]
        rows += [(2 * i, " ".join(template + own + [word() for _ in range(10)])), (2 * i + 1, " ".join(template + own + [word() for _ in range(10)]))]
    monkeypatch.setattr(minhash, "SMALL", 20)
    monkeypatch.setattr(minhash, "FEW", 1)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()}
    assert got == {i: i - i % 2 for i in range(500)}


@pytest.mark.parametrize("sides", [False, True])
def test_spanning_links_join_what_all_links_join(sides):
    rng = np.random.default_rng(5)
    base = rng.choice(1 << 40, 60, replace=False).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, int(rng.integers(45, 60)), replace=False), rng.integers(1 << 41, 1 << 42, int(rng.integers(0, 4))).astype(np.uint64)])) for _ in range(60)]
    label, side = rng.integers(0, 45, 60), rng.integers(0, 2, 60) if sides else np.full(60, -1)

    def joined(links):
        of = label.copy()
        for i, j in links:
            of[of == of[j]] = of[i]
        return {frozenset(np.flatnonzero(of == x).tolist()) for x in of}

    every = [(i, j) for i in range(60) for j in range(i) if label[i] != label[j] and not (sides and side[i] == side[j]) and 100 * len(set(sets[i]) & set(sets[j])) >= 80 * len(set(sets[i]) | set(sets[j]))]
    some = minhash.spanning(sets, side, label, 80)
    assert {(max(p), min(p)) for p in some} <= set(every) and joined(some) == joined(every)


def test_stated_recall_holds_over_shared_coordinates():
    trees, bits, two = minhash.tree_count(0.8, 0.99999), minhash.most_bits(0.8), 0.25
    rng = np.random.default_rng(0)
    agree = rng.binomial(minhash.COORDS, 0.8, 2_000_000)
    meet = np.ones(len(agree))
    for _ in range(minhash.DEPTH):
        one = agree / minhash.COORDS * meet
        meet = (1 - two) * one + two * (1 - (1 - one) ** 2)
    assert np.mean((1 - meet) ** trees) < 1e-5
    assert np.mean(rng.binomial(minhash.COORDS - agree, 0.5) > bits) < 3e-6
