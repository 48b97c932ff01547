"""Language-model scores, phrases and hard negatives against brute force, and awkward rows."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from urbanweave.llm import hard_negatives, lm_score, phrases, shared_arrays
from urbanweave.llm.common import table
from urbanweave.llm.ngram_trie import EliasFano, Level, level_arrays, restored

DOCS = "doc_id long, text string, lang string, held_out string, tokens string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def words_of(text):
    return WORD.findall((text or "").translate(LOW))


class Counts:
    """The same model from plain counters."""

    def __init__(self, texts, order):
        self.order, self.c = order, [Counter() for _ in range(order + 1)]
        for t in texts:
            seq = ["\n", *words_of(t), "\n"]
            for k in range(1, order + 1):
                self.c[k].update(tuple(seq[i - k + 1 : i + 1]) for i in range(1, len(seq)) if i - k + 1 >= 0)
        self.n, self.v = sum(self.c[1].values()), len(self.c[1])
        self.below = [defaultdict(list) for _ in range(order + 1)]
        for k in range(2, order + 1):
            for g, n in self.c[k].items():
                self.below[k][g[:-1]].append(n)

    def p(self, g):
        if len(g) == 1:
            return (self.c[1][g] + 1) / (self.n + self.v + 1)
        below = self.below[len(g)].get(g[:-1])
        if not below:
            return self.p(g[1:])
        d = lm_score.DISCOUNT
        return max(self.c[len(g)][g] - d, 0) / sum(below) + d * len(below) / sum(below) * self.p(g[1:])

    def score(self, text):
        seq = ["\n", *words_of(text), "\n"]
        return sum(math.log10(self.p(tuple(seq[max(0, i - self.order + 1) : i + 1]))) for i in range(1, len(seq)))

    def base(self, text):
        return sum(math.log10(self.p((w,))) for w in [*words_of(text), "\n"])


ROWS = [
    (1, None, None, "h", "t"), (2, "", "en", "h", "t"), (None, "a b a b a", "en", "h", "t"), (3, " \n\t ", "en", None, None), (4, "A b\x0bc A b x", "en", "h", "t"),
    (4, "A b\x0bc A b x", "en", "h", "t"), (5, "b a the a b " * 3000, "de", "h", "t"), (6, "the a", None, "h", "t"), (7, "a the", "en", "h", "t"), (9, "unseen wörter É é", "en", "h", "t"),
]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_counters(spark, order):
    rows = ROWS + [(r["doc_id"] + 100, r["text"], "en", "", "") for r in table(spark, SF, "documents").limit(60).collect()]
    got = lm_score.score_corpus(spark.createDataFrame(rows, DOCS), order=order).collect()
    model = Counts([r[1] for r in rows if not held(r[0])], order)
    want = defaultdict(list)
    for r in rows:
        toks = [*words_of(r[1]), "\n"]
        want[r[0]].append((held(r[0]), len(toks), sum(model.c[1][(w,)] > 0 for w in toks), model.n, model.base(r[1]), model.score(r[1])))
    assert len(got) == len(rows) and any(r["held_out"] for r in got)
    for r in got:
        w = want[r["doc_id"]][0]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert r["base_score"] == pytest.approx(w[4], rel=1e-9)
        assert r["score"] == pytest.approx(w[5], abs=3e-4 * r["n_tokens"])  # two 16-bit codes a token


def test_default_model_uses_five_words(spark):
    rows = [(k, "the cat sat on the mat and the cat sat on a hat " * 2 + "w" * (k % 3), "en", "", "") for k in range(12)]
    got = lm_score.score_corpus(spark.createDataFrame(rows, DOCS)).collect()
    model = Counts([r[1] for r in rows if not held(r[0])], 5)
    assert all(r["score"] == pytest.approx(model.score(rows[r["doc_id"]][1]), abs=3e-4 * r["n_tokens"]) for r in got)


def test_contexts_sum_to_one():
    model = Counts(["a b a c", "b a", "c c a"], 3)
    words = [*{g[0] for g in model.c[1]}, "unknown"]
    for context in (("a",), ("b", "a"), ("zz",), ("\n",)):
        assert sum(model.p((*context, w)) for w in words) == pytest.approx(1.0)


def test_scores_of_empty_tables_and_untrained_models(spark):
    none = spark.createDataFrame([], DOCS)
    assert lm_score.score_corpus(none).count() == 0
    model = lm_score.train(none)
    got = lm_score.score(spark.createDataFrame(ROWS[:5], DOCS), model).collect()
    assert all(r["score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in got)


def test_heavy_contexts_are_split_and_stay_whole(spark):
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(f"hot w{rng.integers(0, 900)}" for _ in range(200)), "en", "", "") for k in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    model = lm_score.train(docs)
    assert len(model.heavy[0][0]) >= 1
    counts = Counts([r[1] for r in rows], 2)
    got = lm_score.score(docs, model).collect()
    assert all(r["score"] == pytest.approx(counts.score(rows[r["doc_id"]][1]), abs=3e-4 * r["n_tokens"]) for r in got)


def test_elias_fano_against_sorted_arrays():
    rng = np.random.default_rng(0)
    for n, top in [(0, 1), (1, 5), (1000, 100), (5000, 10**12), (3, 2**62)]:
        v = np.sort(rng.integers(0, top, n)).astype("u8")
        e = EliasFano(*(EliasFano.code(v)[k] for k in ("low", "high", "ones", "meta")))
        assert not n or (e[np.arange(n)] == v).all()
        q = np.concatenate([v, rng.integers(0, 2 * top, 500).astype("u8")])
        at, there = e.find(q)
        assert (at == np.searchsorted(v, q)).all() and (there == np.isin(q, v)).all()


def test_level_finds_children_of_a_context_only():
    parents, words = np.array([2, 2, 7, 7, 9]), np.array([1, 5, 0, 5, 3])
    level = Level(level_arrays(parents, words, np.array([0.1, 0.2, 0.3, 0.4, 0.5]), np.array([0.5, 0.25, 0.125])))
    rank, there = level.contexts(np.array([2, 3, 7, 9], "u8"))
    assert there.tolist() == [True, False, True, True]
    at, seen = level.children(rank[[0, 0, 2, 2, 3, 3]], np.array([5, 0, 0, 1, 3, 5]))
    assert seen.tolist() == [True, False, True, False, True, False] and at[seen].tolist() == [1, 2, 4]
    assert np.allclose(restored(level.p), [0.1, 0.2, 0.3, 0.4, 0.5], rtol=3e-4)


def test_packed_keys_round_trip_and_files(tmp_path):
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000).astype("u8"))
    assert (shared_arrays.unpacked_keys(shared_arrays.packed_keys(keys)) == keys).all()
    k, c = shared_arrays.merged([shared_arrays.packed_keys(keys)] * 2, [shared_arrays.byte_planes(np.ones(len(keys), "i8"))] * 2)
    assert (k == keys).all() and (c == 2).all()
    shared_arrays.save(f"file://{tmp_path}", "x", {"a": keys, "none": np.zeros(0, "u2")})
    back = shared_arrays.load(f"file://{tmp_path}", "x")
    assert (back["a"] == keys).all() and len(back["none"]) == 0


def brute_phrases(rows, least, best):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        gone = {g[i : i + k] for g, a in found.items() for k in range(2, len(g)) for i in range(len(g) - k + 1) if 100 * a >= 80 * found[g[i : i + k]]}
        ranked = []
        for g in found.keys() - gone:
            a, cuts = found[g], range(1, len(g))
            score, k = min((2_000_000 * a // (c[g[:k]] + c[g[k:]]), k) for k in cuts)
            ranked.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:best])]
    return sorted(out)


@pytest.mark.parametrize(("least", "best"), [(30, 2000), (3, 40)])
def test_phrases_equal_brute_force(spark, least, best):
    rows = [(r["lang"], r["text"]) for r in table(spark, SF, "documents").collect()]
    rows += [(None, "New  York\tcity. new york"), ("xx", None), ("xx", ""), ("xx", "x y\x00 z, x y\x00 z;x y\x00 z"), ("xx", "a b É é")] * 3
    docs = spark.createDataFrame([(0, t, g, None, None) for g, t in rows], DOCS)
    got = sorted(tuple(r) for r in phrases.collocations(docs, least=least, best=best).collect())
    assert got == brute_phrases(rows, least, best) and got


def test_phrases_of_an_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, "a b", "en", "", "")], DOCS)).count() == 0


def brute_negatives(rows):
    q = {i: ((l + 1) % 10 if i % 7 == 0 else l, [math.floor(256 * x) for x in v]) for i, l, v in rows}
    out = []
    for a, (label, v) in q.items():
        if a % 100 == 0:
            scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), b, m) for b, (m, w) in q.items() if b != a and len(w) == len(v)]
            scored.sort()
            for p, pid, _ in [s for s in scored if s[2] == label][:5]:
                hard = [(-s, b) for s, b, m in scored if m != label and 80 * -p <= 100 * -s <= 100 * -p][:5]
                out += [(a, pid, k + 1, b, -p, s) for k, (s, b) in enumerate(hard)]
    return sorted(out)


def test_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (6, 12))
    rows = [(k, int(rng.integers(0, 4)), (centres[rng.integers(0, 6)] + rng.normal(0, 0.3, 12)).round(2).tolist()) for k in range(1500)]
    rows += [(k, int(k % 3), [0.5] * 12) for k in range(1500, 1900)]  # ties
    rows += [(k, 1, [0.25, -0.5]) for k in range(2000, 2005)] + [(2100, 1, [-1.0, 3.0]), (2107, 2, [-0.5, 2.0]), (-100, 3, [0.1] * 12), (3000, 5, [1.0, 0.0, 0.0])]
    out = [(None, 1, [1.0] * 12, 0), (4000, None, [1.0] * 12, 0), (4100, 1, None, 0), (4200, 1, [math.nan] * 12, 0), (4300, 1, [math.inf] * 12, 0), (4400, 1, [None] * 12, 0)]
    data = [(i, l, v, 7) for i, l, v in rows] + out + [(100, rows[100][1], rows[100][2], 7)]  # a repeated row
    docs = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>, chunk int").repartition(5)
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(docs).collect())
    assert got == brute_negatives(rows) and got


def test_negatives_of_an_empty_table(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


def test_zone_maps_skip_far_blocks(spark):
    rows = [(k, k % 2, [10.0 + k % 5, 0.0] if k < 700 else [0.0, 10.0 + k % 5]) for k in range(1400)]
    docs = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    curve = hard_negatives.on_curve(hard_negatives.rows_of(docs, "vec_id", "embedding", "label"))
    blocks = curve.repartitionByRange(2, "curve", "vec_id").sortWithinPartitions("curve", "vec_id").mapInPandas(hard_negatives.block_rows, hard_negatives.BLOCKS).cache()
    anchors, n = hard_negatives.anchors_of(blocks)
    read = hard_negatives.needed(anchors, blocks, n, hard_negatives.wants_positives).count()
    assert n == 1 and 0 < read
    one = anchors.where("anchor_id = 800")
    assert 0 < hard_negatives.needed(one, blocks, 1, hard_negatives.wants_positives).count() < blocks.count()


def test_hilbert_places_are_neighbours():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    place = hard_negatives.hilbert(grid, 3)
    assert sorted(place.tolist()) == list(range(512))
    walk = grid[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()
