"""Word vectors of the quality classifier against a brute-force sum over all texts."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np

from urbanweave.llm import quality_model as q
from urbanweave.llm.shared_arrays import load, word_hashes


def brute(texts):
    """Unit vectors, as whole numbers, of all words that occur at least twice."""
    sums, counts = defaultdict(lambda: np.zeros(q.DIMS)), Counter()
    for text in texts:
        words = (text or "").encode().lower().split()
        counts.update(words)
        for k, word in enumerate(words):
            for j in range(max(k - q.REACH, 0), min(k + q.REACH + 1, len(words))):
                if j != k:
                    sums[word] += q.index_vectors(word_hashes([words[j]]))[0]
    unit = lambda v: np.rint(q.UNIT * v / (np.sqrt((v * v).sum()) or 1))
    return {int(word_hashes([w])[0]): unit(sums[w]) for w, n in counts.items() if n >= q.MIN_COUNT}


def stored_vectors(vectors):
    files = [load(vectors.folder, str(s)) for s in sorted(vectors.filled)]
    return {int(h): v for f in files for h, v in zip(f["hash"], f["vector"].reshape(-1, q.DIMS), strict=True)}


def test_vectors_equal_brute_force(spark):
    pick = random.Random(5)
    words = [f"W{k}" for k in range(300)] + ["été", "#tag", "once-only"]
    texts = [" ".join(pick.choices(words, k=pick.randint(0, 60))) for _ in range(120)]
    texts += [None, "", " \t\n", "alone", "the " * 5000 + "end"] + ["same text twice"] * 2
    rows = spark.createDataFrame([(t, k) for k, t in enumerate(texts)], "text string, hash long").repartition(5)
    want = brute(texts)
    got = stored_vectors(q.learn_vectors(rows))
    assert got.keys() == want.keys()
    assert all(np.array_equal(got[h], want[h]) for h in want)
    assert stored_vectors(q.learn_vectors(rows.coalesce(1))).keys() == want.keys()
    assert q.learn_vectors(rows.limit(0)).filled == frozenset()


def test_steps_and_blocks_change_nothing(monkeypatch):
    texts = [" ".join(f"w{(k * j) % 37}" for j in range(k)) for k in range(60)]
    whole = q.block_sums(t.encode() for t in texts)
    x = q.Pooler(q.Vectors("", 8, frozenset())).pooled(texts)
    monkeypatch.setattr(q, "STEP", 7)
    monkeypatch.setattr(q, "BLOCK", 50)
    parts = q.block_sums(t.encode() for t in texts)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))
    assert np.array_equal(x, q.Pooler(q.Vectors("", 8, frozenset())).pooled(texts))


def test_pooled_features_of_single_texts():
    pooler = q.Pooler(q.Vectors("", 8, frozenset()))
    assert not pooler.pooled([""]).any() and not pooler.pooled([" \n"]).any() and pooler.pooled([]).shape == (0, q.WIDTH + q.STATS)
    row = pooler.pooled(["", "a a b #", ""])[1]
    assert not row[: q.DIMS].any() and np.isclose(row[q.DIMS : q.WIDTH].sum(), 1)
    assert np.allclose(row[q.WIDTH :], [3 / 4**0.8, 1 / 3, 2 / 4, np.log1p(4) / 5, 1 / 7])


def test_index_vectors_are_independent():
    words = [f"{a}{b}{c}xyz".encode() for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    v = q.index_vectors(word_hashes(words)).astype("f8")
    v /= np.sqrt((v * v).sum(1, keepdims=True)) + 1e-9
    cosines = np.abs(v @ v.T)[np.triu_indices(len(v), 1)]
    assert cosines.mean() < 0.12 and (cosines > 0.9).mean() < 1e-3


def test_shapes_of_ascii_words():
    for w in ["abc", "ABC", "A", "a!!", "!!", "12", "x-1", "#A", "AB#!!c", "é1", "Ünder", "word.", "a,b.", "\x00x"]:
        assert q.shape_place(w.encode()) == q.hashed_place(q.shape_of(w))
