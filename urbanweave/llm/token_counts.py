"""Token counts under a unigram vocabulary, by a Viterbi pass that carries scores and counts only."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanweave.llm.common import text_of

# Fixed values of the tokenizer: the mark that stands for a space, the penalty of an unknown character, piece kinds.
MARK = "▁"
UNKNOWN_PENALTY = 10.0
NORMAL, USER_DEFINED = 1, 4
CACHED_WORDS = 300_000


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol-buffer message: number and value."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < end:
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            n = varint()
            yield key >> 3, data[at : at + n]
            at += n
        else:
            n = 4 if key & 7 == 5 else 8
            yield key >> 3, data[at : at + n]
            at += n


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces that match text, with their scores, from a model file of the sentencepiece format."""
    import struct

    with open(path, "rb") as f:
        data = f.read()
    pieces = []
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            if piece.get(3, NORMAL) in (NORMAL, USER_DEFINED):
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]))
    return pieces


class Counter:
    """Counts the pieces of the best-scored segmentation.

    Matches come from an Aho-Corasick automaton. Per end position the best score and its piece count are kept. Of equal
    scores the earliest start wins, as in the tokenizer, which visits starts in order and replaces only by a higher
    score. A character that no single-character piece covers may be taken alone for ``UNKNOWN_PENALTY`` below the
    lowest score; it counts as its UTF-8 bytes.

    If no piece has the space mark after another character, every such mark starts a word, words are segmented alone
    and their counts are cached (a bounded cache; emptied when full, which costs time only).
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((float(s) for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.by_word = not any(MARK in p.lstrip(MARK) for p, _ in pieces)
        self.words = re.compile(f"{MARK}+[^{MARK}]*")
        self.cache: dict[str, int] = {}

    def viterbi(self, text: str) -> int:
        n = len(text)
        best, count = [None] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        found: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for last, (size, score) in self.automaton.iter(text):
            found[last].append((size, score))
        for end in range(1, n + 1):
            ways = found[end - 1]
            ways.sort(reverse=True)  # longest first: the earliest start
            top, pieces = None, 0
            for size, score in ways:
                value = best[end - size] + score
                if top is None or value > top:
                    top, pieces = value, count[end - size] + 1
            char = text[end - 1]
            if char not in self.single:
                value = best[end - 1] + self.unknown
                if top is None or value > top:
                    top, pieces = value, count[end - 1] + len(char.encode())
            best[end], count[end] = top, pieces
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_word:
            return self.viterbi(MARK + text.replace(" ", MARK))
        cache, total = self.cache, 0
        for word in self.words.findall(MARK + text.replace(" ", MARK)):
            n = cache.get(word)
            if n is None:
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                n = cache[word] = self.viterbi(word)
            total += n
        return total


def count_tokens(
    docs: DataFrame, spark: SparkSession, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every whole text; null and empty texts have 0 tokens.

    ``vocabulary`` is the path of the model file, read once on the driver and sent to the executors (its size is that
    of a vocabulary). Each row is counted alone, so repeated rows and null ids keep a count of their own, an empty table
    gives an empty one and other columns are not read. No shuffle.
    """
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            counts = [counter.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long")
