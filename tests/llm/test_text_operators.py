"""The text operators against brute force, round trips, held-out accuracy and awkward rows."""

import base64
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF
from urbanweave.llm import (
    byte_bpe, chat_format, embedding_dedup, html_text, line_dedup, minhash_dedup, packing, quality_model, quality_rules, token_counts,
)
from urbanweave.llm.common import table
from urbanweave.llm.queries import ORACLES, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string, words string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "tea for two and two for tea, said the cat on the mat. " * 400


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (None, "a b c d e f", "en", "a"), (3, " \n\n x \n", "en", None), (4, LONG, "en", "a"),
        (5, "Zwölf Boxkämpfer 🙂 don't  stop now\n<|endoftext|> x", "de", "a"), (6, LONG, "en", "b"), (6, LONG, "en", "b"),
        (7, LONG.replace("cat on", "dog in", 3), "en", "b"), (8, "one two", "en", "a"), (9, "ONE two", "en", "a"),
    ]
    return spark.createDataFrame([(i, t, g, s, 0, "r", "k", "w") for i, t, g, s in rows], DOCS)


@pytest.fixture(scope="module")
def sample(spark):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twins(spark, name):
    assert difference(QUERIES[name](spark, SF).toPandas(), connect(SF).execute(ORACLES[name]).fetchdf()) is None


def test_lines_of_awkward_rows(docs):
    out = line_dedup.dedup_lines(docs.unionByName(docs.where("doc_id = 3")), min_docs=2).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    by = defaultdict(list)
    for r in out:
        by[r[0]].append(tuple(r[1:]))
    assert len(out) == docs.count() + 1
    assert by[1] == by[2] == [(1, 0, "")]
    assert by[3] == [(4, 1, " \n\n")] * 2  # empty keys stay
    assert by[8] == by[9] == [(1, 1, "")]
    assert by[None] == [(1, 0, "a b c d e f")]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_chat_round_trip_and_parts(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|end|>\n<|user|>\nhi", "\\e\\l \\", None, "", "a|>\nb"]
    rows = [(1, k, "assistant" if k % 2 else "us|>er<", t) for k, t in enumerate(nasty)] + [(None, None, None, "x")]
    out = chat_format.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = out.withColumn("t", chat_format.read_back(F.col("formatted"))).withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("loss_spans")))
    got = {r["id"]: r for r in out.collect()}
    assert [(x["role"], x["text"]) for x in got[1]["t"]] == [(r, t or "") for _, _, r, t in rows[:-1]]
    assert got[1]["loss"] == "".join(t or "" for k, t in enumerate(nasty) if k % 2)
    assert [(x["role"], x["text"]) for x in got[None]["t"]] == [("", "x")]
    part = lambda k, **v: {"type": k, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None} | v
    parts = [part("text", text="see <|image|> "), part("image", ref="i.png", width=57, height=28), part("audio", ref="a.wav", seconds=1.1), part("document", ref="d", pages=2)]
    df = spark.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts {chat_format.PART_TYPE}")
    r = chat_format.format_chat(df, text_col=None, parts_col="parts").first()
    assert r["formatted"].endswith("see \\l\\pimage\\p> <|image|><|audio|><|document|><|end|>\n")
    assert [(a["ref"], a["n_tokens"]) for a in r["attachments"]] == [("i.png", 3), ("a.wav", 28), ("d", 1200)]
    assert chat_format.format_chat(df.limit(0), text_col=None, parts_col="parts").count() == 0


def rule_numbers(text):
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    seen, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if seen[w] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_rules_against_brute_force(spark, docs, sample):
    out = quality_rules.quality_verdicts(table(spark, SF, "documents")).collect()
    for r in out:
        want = rule_numbers(sample[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    assert sum(r["kept"] for r in out) > 0.7 * len(out)
    odd = quality_rules.quality_rules(docs)
    assert odd.count() == docs.count() and odd.where("n_words = 0 and kept").count() == 0
    assert quality_rules.quality_rules(docs.limit(0)).count() == 0


def test_rules_reject_planted_repetition(spark):
    pick = random.Random(3)
    word = lambda: "".join(pick.choices("abcdefghijklmnopqrst", k=pick.randint(2, 8)))
    plain = lambda n: "\n".join(" ".join(word() for _ in range(10)) for _ in range(n))
    rows = [(k, plain(12)) for k in range(200)]
    rows += [(1000, plain(10) + "\nRead more" * 20)]  # most lines and more than a quarter of the words
    rows += [(1001, "\n".join(f"{' '.join(word() for _ in range(4))}\nMore" for _ in range(40)))]  # lines alone
    once, twice = plain(8).replace("\n", " "), plain(3).replace("\n", " ")
    rows += [(1002, f"{twice} {once} {twice}")]  # words alone, all on one line
    same = plain(1)
    rows += [(1003, "\n".join([plain(1), same, plain(1), plain(1), plain(1), plain(1), same]))]  # one repeated line is no fault
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules.quality_verdicts(df).collect()}
    assert all(got[k]["kept"] for k in [*range(200), 1003])
    assert not any(got[k]["kept"] for k in (1000, 1001, 1002))
    assert not any(got[k]["base_failed"] for k in (1000, 1001, 1002))
    # 24% of a group that lies together pulls the mean of the whole group, not the estimate that is kept
    bad = [(2000 + k, plain(10) + f"\n{' '.join(f'{word()}#$%' for _ in range(30))}") for k in range(63)]
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in rows[:200] + bad], df.schema)
    kept = {r["doc_id"] for r in quality_rules.quality_verdicts(df).where("kept").collect()}
    assert kept == set(range(200))


def test_classifier_on_held_out_rows(spark, docs):
    sf = SF.replace("0.001", "0.01")
    raw, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality_model.train(raw, labels)
    scored = quality_model.score_quality(raw, model).select("row.doc_id", "held_out", "score", "predicted").join(labels, "doc_id")
    rows = scored.where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    odd = quality_model.score_quality(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert quality_model.score_quality(docs.limit(0), model).count() == 0
    assert quality_model.train(raw, labels.limit(0)).scores(np.zeros((1, quality_model.WIDTH + quality_model.STATS)))[0] == 0.5


def test_bpe_equals_the_library(spark, docs, sample):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    few = spark.createDataFrame([(i, t) for i, t in sorted(sample.items())[:30]], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(few)
    out = byte_bpe.decode(byte_bpe.encode(rows, path, P.PATTERN), path).collect()
    want = Counter(np.array(library.encode_ordinary(r["text"] or ""), "<u4").tobytes() for r in rows.collect())
    assert Counter(bytes(r["ids"]) for r in out) == want
    assert Counter(bytes(r["decoded"]) for r in out) == Counter((r["text"] or "").encode() for r in rows.collect())
    assert byte_bpe.encode(docs.limit(0), path, P.PATTERN).count() == 0


def test_counts_equal_the_lattice(spark, docs, sample):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        unigram = sentencepiece.SentencePieceProcessor(model_proto=f.read() + b"\x12\x02\x18\x01")
    counter = token_counts.Counter(token_counts.read_vocabulary(path))
    for text in [x for t in list(sample.values())[:40] for x in t.split("\n")[:3]]:
        for word in text.split(" ")[:12]:
            if word:
                assert counter.count(word) == len(unigram.nbest_encode_as_pieces(word, 2)[0]), word
    whole = lambda t: counter.viterbi("▁" + t.replace(" ", "▁")) if t else 0
    out = {(r["doc_id"], r["n_tokens"]) for r in token_counts.count_tokens(docs, spark, path).collect()}
    assert out == {(r["doc_id"], whole(r["text"])) for r in docs.collect()}
    # of equal scores the earliest start wins
    tie = token_counts.Counter([("▁a", -1.0), ("b", -1.0), ("▁ab", -2.0), ("a", -1.0), ("▁", -1.0)])
    assert tie.count("ab") == 1
    assert token_counts.count_tokens(docs.limit(0), spark, path).count() == 0


def test_packing_covers_each_id_once(spark, docs, sample):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    pieces = defaultdict(list)
    out = packing.pack(table(spark, SF, "documents"), spark, path).collect()
    for r in out:
        pieces[r["doc_id"]].append(r)
    for doc, text in sample.items():
        ids, at = library.encode(text, add_special_tokens=False).ids + [1], 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    rows = defaultdict(list)
    for r in out:
        rows[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in rows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["length"] for r in out) > 0.95 * 2048 * len(rows)
    odd = packing.pack(docs, spark, path)
    assert odd.select("doc_id", "start").count() >= docs.count()
    assert packing.pack(docs.limit(0), spark, path).count() == 0


def test_words_encode_as_the_library():
    from tokenizers import Tokenizer

    path, pick = P.path("word_bpe_49k.json"), random.Random(5)
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    with open(path, "rb") as f:
        encoder = packing.word_encoder(f.read())
    marks = ["'s", "'t", "'re", "'LL", "'", "<|startoftext|>", "</w>", "\t", "\r", "\x1c", "\x00", "zz", "Hello", "12", "e\u0301", " ", "\n", " "]
    alphabet = [*marks, *map(chr, range(0x80, 0x260)), "\u03a3", "\u2003", "\U0001f600"]
    for _ in range(5_000):
        text = "".join(pick.choices(alphabet, k=pick.randint(0, 9)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def set_of(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(map(tuple, [words[k : k + width] for k in range(len(words) - width + 1)] or ([words] if words else [])))


def grouped(ids, linked):
    group = {i: i for i in ids}
    moved = True
    while moved:
        moved = False
        for a, b in linked:
            low = min(group[a], group[b])
            moved |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    return group


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_documents_against_brute_force(spark, width, percent):
    base = [f"w{k * 7 % 101}" for k in range(60)]
    texts = {k: " ".join(base[:40] + [f"z{k}"] + base[40:]) for k in range(80)}  # one long list of near copies
    texts |= {100 + k: " ".join([f"p{j}" for j in range(30)] + [f"q{k}x{j}" for j in range(30)]) for k in range(60)}  # a shared passage
    texts |= {200: texts[5], 201: "a b", 202: "A  b", 203: "", 204: texts[101] + " more", 205: texts[101]}
    got = minhash_dedup.near_documents(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string"), rule=minhash_dedup.Rule(width, percent)
    ).collect()
    sets = {i: set_of(t, width) for i, t in texts.items()}
    near = lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)
    want = grouped(texts, [(a, b) for a in texts for b in texts if a < b and near(sets[a], sets[b])])
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in texts
    }


def test_near_documents_of_awkward_rows(docs):
    out = minhash_dedup.near_documents(docs).collect()
    assert len(out) == docs.count()
    by = {r["doc_id"]: r for r in out}
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert by[6]["component_id"] == by[4]["component_id"] == 4 and by[1]["n_shingles"] == 0 and by[1]["kept"]
    assert minhash_dedup.near_documents(docs.limit(0)).count() == 0


def test_near_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(40, 24))
    rows = [(k, (centre[k % 40] + rng.normal(size=24) * 0.2 * (k % 4)).tolist(), k % 3) for k in range(400)]
    rows += [(1000 + k, rows[0][1], 0) for k in range(5)]
    rows += [(2000, None, 1), (2001, [0.0] * 24, 1), (2002, [float("nan")] * 24, 1), (2003, rows[1][1], None), (2004, [None] * 24, 1), (2005, [1.0], 1)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, g in rows if i < 2000}
    label = {i: g for i, _, g in rows}
    links = [(a, b) for a in unit for b in unit if a < b and label[a] == label[b] and unit[a] @ unit[b] >= 0.93]
    degree, group = Counter(x for p in links for x in p), grouped(label, links)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == {i: (degree[i], group[i], group[i] == i) for i in label}
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")).count() == 0


def test_near_vectors_of_extreme_size_and_mixed_length(spark):
    rows = [(1, [1.0, 0.0, 1.0], 0), (2, [1e-200, 0.0, 1e-200], 0), (3, [1e200, 0.0, 1e200], 0), (4, [5e-324, 0.0, 5e-324], 0), (5, [0.0, 1e308, 0.0], 0)]
    rows += [(10, [1.0, 0.0], 0), (11, [1.0, 0.0], 0), (12, [2.0, 0.0], 0), (13, [0.0, 1.0], 0), (14, [3.0, 0.1], 1), (20, [4.0], 0), (21, [5.0], 0), (22, [-5.0], 0)]
    schema = "vec_id long, embedding array<double>, label int, rep string, v long, cell int"
    df = spark.createDataFrame([(*r, "x", None, 1) for r in rows], schema)  # names that the operator uses itself
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(df).collect()}
    want = {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 10: (2, 10), 11: (2, 10), 12: (2, 10), 13: (0, 13), 14: (0, 14)}
    assert got == want | {20: (1, 20), 21: (1, 20), 22: (0, 22)}


PAGE = """<!doctype html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body class="post-with-sidebar">
<header>Site</header><nav><ul><li>Menu<li>Two</ul></nav><div class="cookie-notice">We use cookies.</div>
<article><h1>Ti&amp;tle</h1><p>First <b>line</b>
 goes &lt;on&gt;.<p>Second, less &amp; more<br>here.</p><ul><li>item one<li>item two</ul><div class="ad">Buy!</div>
<form>Name <input></form></article><aside>Side</aside><div id="comments"><p>Nice post, I think so too, really.</p></div><footer>Foot</footer>"""


def test_page_text(spark):
    assert html_text.main_text(PAGE) == "Ti&tle\nFirst line goes <on>.\nSecond, less & more here.\nitem one\nitem two"
    plain = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    kept = html_text.main_text(plain)
    assert "First line goes" in kept and "cookies" not in kept and "Nice post" not in kept and "Foot" not in kept
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p>a < b<p>c"), (None, "u", PAGE), (4, "u", "<p>" + "x. " * 50_000)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == by[2] == "" and by[3] == "a < b\nc" and len(by[4]) == 150_000 - 1 and len(got) == 5
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


STORY = "<h2>Head</h2><p>" + "A long line of the story, with some commas, goes on here. " * 6 + "</p><p>Short end.</p>"


def test_page_text_is_not_chosen_by_names():
    text = "Head\n" + "A long line of the story, with some commas, goes on here. " * 5 + "A long line of the story, with some commas, goes on here.\nShort end."
    side = '<div class="sidebar">Side, of it.</div>'
    for page in (
        f'<div class="layout with-sidebar"><article>{STORY}</article>{side}</div>',
        f'<div class="entry-content paywall">{STORY}</div>{side}',
        f'<div class="post-meta">May</div><div>{STORY}</div>{side}',
        f'<form id="aspnetForm"><main>{STORY}</main>{side}</form>',
        f'<article>{STORY}</article><div id="comments"><p>{"I think so too, really, yes. " * 90}</p></div>',
    ):
        got = html_text.main_text(f"<html><body><nav>Menu</nav>{page}<footer>Foot</footer></body></html>")
        assert got.removeprefix("May\n") == text, page


def test_page_text_keeps_whole_elements():
    wrap = lambda x: html_text.main_text(f"<html><body><nav>Menu</nav><article>{STORY}{x}</article><footer>Foot</footer></body></html>")
    story = wrap("")
    for x, more in (
        ("<figure><img src=a><figcaption>A caption.</figcaption></figure>", "A caption."),
        ("<p>Sum <math><mi>x</mi><mo>+</mo><mi>y</mi></math> holds.</p>", "Sum x+y holds."),
        ("<dir><li>one<li>two</dir>", "one\ntwo"),
        ("<noscript><p>Without script.</p></noscript>", "Without script."),
        ("<p><object data=a>Instead of it.</object></p>", "Instead of it."),
        ("<xmp>a <b> c</xmp>", "a <b> c"),
        ("<script>no</script><template><p>Not shown.</p></template><p>Shown.", "Shown."),
        *((f"<p>Open <{tag}>end</p><p>The rest, in full.</p>", "Open end\nThe rest, in full.") for tag in ("svg", "math", "object", "canvas")),
    ):
        assert wrap(x) == f"{story}\n{more}", x


def test_pipeline(spark, sample):
    raw = table(spark, SF, "documents")
    docs, sizes = raw, [raw.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == raw.columns, name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    texts = {r["doc_id"]: set_of(r["text"], 5) for r in docs.collect()}
    for a in texts:
        for b in texts:
            assert a >= b or not texts[a] or not 5 * len(texts[a] & texts[b]) >= 4 * len(texts[a] | texts[b])
    out = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == set(texts)
    assert out.columns[0] == "doc_id"
