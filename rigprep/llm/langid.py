"""Language of texts by a linear-chain CRF over words, which may switch language inside a text.

Affixes, character n-grams and a lexicon describe each word; learned moves say how seldom the
language changes from word to word. Forward-backward gives each word a probability of each
language, and a text's language is the one with the highest mean.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize
from rigprep.llm import crf
from rigprep.llm.text import map_texts, slices

FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: What is no letter; other numerals than digits are left to `normal`.
_OTHER = re.compile(r"[^\w\n]+|[\d_]+")
CACHE_WORDS = 400_000
#: Longer runs of letters are cut into pieces of so many, which share their last two letters, so that
#: each bigram and trigram is in a piece. So many pieces are described at a time.
PIECE, CHUNK = 23, 20_000
#: The model is fitted on so many documents of each language, taken by a hash of their id, and on
#: so many words of each of them, drawn over the whole text, for so many languages at most.
FIT_DOCS, FIT_WORDS, MAX_LANGS = 60, 320, 200
UNKNOWN = "und"


def held_out(id_col: str = "doc_id"):
    """Documents that are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def normal(word: str) -> str:
    """The letters of a word, lower-cased; empty if it has none."""
    return "".join(c for c in word if c.isalpha()).lower()


def normals(words: list[str]) -> list[str]:
    """`normal` of many words, none of which has white space."""
    letters = _OTHER.sub("", "\n".join(words)).lower().split("\n") if words else []
    return [n if n.isalpha() or not n else normal(w) for w, n in zip(words, letters, strict=True)]


def _number(kind: int, *letters: np.ndarray) -> np.ndarray:
    """Feature numbers of equal-length strings, given letter by letter; 0 stands for no letter."""
    h = np.full(len(letters[0]), kind + 1, dtype=np.uint64)
    for x in letters:
        h = (h ^ x) * _ODD
        h ^= h >> np.uint64(29)
    return ((h * _ODD) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of words of letters, word after word, and how many each word has.

    A word has itself (if it has four letters at most), its first and last one, two and three letters, and
    all bigrams and trigrams of it between two marks.
    """
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    marked = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    marked = np.concatenate([marked, np.zeros(3, dtype=np.uint64)])
    first = np.cumsum(size + 2) - size - 1  # place of each word's first letter

    def letter(k: int) -> np.ndarray:
        """Each word's letter k, from its end if k is negative."""
        at = first + (k if k >= 0 else size + k)
        return np.where(size >= (k + 1 if k >= 0 else -k), marked[at], 0)

    n = 2 * size + 8
    begin = np.cumsum(n) - n
    out = np.empty(int(n.sum()), dtype=np.int64)
    head, tail = [letter(k) for k in range(4)], [letter(-k) for k in (1, 2, 3)]
    out[begin] = np.where(size <= 4, _number(0, *head), 0)
    for k in (1, 2, 3):
        out[begin + k] = _number(k, *head[:k])
        out[begin + 3 + k] = _number(3 + k, *tail[:k])
    for kind, count, skip in ((7, size + 1, 7), (8, size, 8 + size)):
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(first - 1, count) + place
        out[np.repeat(begin + skip, count) + place] = _number(kind, *(marked[at + k] for k in range(kind - 5)))
    return out, n


def cut(letters: str) -> list[str]:
    """The letters of a word, or pieces of a long one; none if it has none."""
    if len(letters) <= PIECE:
        return [letters] if letters else []
    return [letters[at : at + PIECE] for at in range(0, len(letters) - 2, PIECE - 2)]


def pieces(word: str) -> list[str]:
    return cut(normal(word))


def _words(text: bytes) -> list[str]:
    """Pieces of the words between white space, also of other scripts."""
    return [p for n in normals(text.decode("utf-8", "replace").split()) for p in cut(n)]


def drawn(text: bytes) -> list[list[str]]:
    """At most about FIT_WORDS words of a text, in blocks drawn over the whole of it by a hash of the text."""
    words = _words(text)
    n = -(-len(words) // crf.BLOCK)
    order = np.random.default_rng(zlib.crc32(text)).permutation(n)
    return [words[k * crf.BLOCK : (k + 1) * crf.BLOCK] for k in sorted(order[: max(1, FIT_WORDS // crf.BLOCK)])]


def fit(rows: list[tuple[str, str]], seed: int = 5) -> crf.Crf:
    """Train on (text, language) rows."""
    return fit_runs([(run, lang) for text, lang in rows for run in drawn(text.encode())], seed)


def fit_runs(found: list[tuple[list[str], str]], seed: int = 5) -> crf.Crf:
    """Train on (words, language) runs; a third of the sequences are spliced from two languages."""
    r = np.random.default_rng(seed)
    labels = sorted({lang for _, lang in found})
    runs = [(words, labels.index(lang)) for words, lang in found]
    sequences = []
    for k, (words, y) in enumerate(runs):
        marks = [y] * len(words)
        if k % 3 == 0 and len(runs) > 1:
            other, z = runs[int(r.integers(len(runs)))]
            cut, cut2 = len(words) // 2, len(other) // 2
            words, marks = words[:cut] + other[cut2:], [y] * cut + [z] * (len(other) - cut2)
        flat, size = features(words)
        sequences.append(([f.tolist() for f in np.split(flat, np.cumsum(size)[:-1])], marks))
    return crf.train(sequences, labels, FEATURES, rounds=40)


class Reader:
    def __init__(self, model: crf.Crf):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.count = np.empty(0, dtype=np.int64)
        self.start = np.empty(0, dtype=np.int64)
        self.table = np.empty((0, len(self.model.labels)))

    def learn(self, words: set[str]) -> None:
        """A word's pieces are ``count`` rows of the table from ``start``; none without letters."""
        if max(len(self.number), len(self.table)) > CACHE_WORDS:
            self.forget()
        new = [w for w in words if w not in self.number]
        split = [cut(n) for n in normals(new)]
        known = [p for ps in split for p in ps]
        parts = [crf.factors(self.model.sums(*features(known[at : at + CHUNK]))) for at in range(0, len(known), CHUNK)]
        count = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        self.start = np.concatenate([self.start, len(self.table) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.table = np.concatenate([self.table, *parts])
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))

    def rows(self, words: list[str]) -> np.ndarray:
        ids = np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))
        count, start = self.count[ids], self.start[ids]
        return np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())

    def label(self, text: bytes) -> list[tuple[str, str, float]]:
        """(piece of a word, language, probability) along a text that may switch language: forward-backward word by word."""
        found = _words(text)
        if not found:
            return []
        local = crf.factors(self.model.sums(*features(found)))
        run, length = crf.blocks(np.array([len(found)]))
        rows, filled = crf.padded(local, length)
        marginal = crf.chained_marginals(rows, filled, self.model.moves, run)[filled]
        best = marginal.argmax(axis=1)
        return [(w, self.model.labels[k], float(p)) for w, k, p in zip(found, best, marginal.max(axis=1), strict=True)]

    def read(self, texts: list[bytes]) -> list[tuple[str, float]]:
        split = [x.decode("utf-8", "replace").split() for x in texts]
        self.learn(set().union(*split))
        ids = [self.rows(w) for w in split]
        count = np.array([len(x) for x in ids], dtype=np.int64)
        total = np.zeros((len(texts), len(self.model.labels)))
        if count.sum():
            run, length = crf.blocks(count)
            local, filled = crf.padded(self.table[np.concatenate(ids)], length)
            marginal = crf.chained_marginals(local, filled, self.model.moves, run)
            np.add.at(total, run, (marginal * filled[:, :, None]).sum(axis=1))
        out = []
        for row, n in zip(total, count, strict=True):
            best = int(row.argmax())
            out.append((self.model.labels[best], min(1.0, float(row[best] / n))) if n else (UNKNOWN, 0.0))
        return out


_READERS: dict[bytes, Reader] = {}


def reader(labels: list[str], weights: bytes, moves: bytes) -> Reader:
    """One for each Python worker and model."""
    if moves not in _READERS:
        _READERS.clear()
        k = len(labels)
        _READERS[moves] = Reader(crf.Crf(labels, np.frombuffer(weights, dtype=np.float32).reshape(-1, k), np.frombuffer(moves, dtype=np.float64).reshape(k, k)))
    return _READERS[moves]


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, n: int, max_langs: int) -> list[tuple[list[str], str]]:
    """(words, language) runs of n documents of each language that may be learned from, of the ``max_langs`` most frequent ones.

    The n smallest hashes of a language are found in each task first, so a hot language sends n
    rows a task. Words are drawn where the texts are: the driver gets FIT_WORDS words of n documents of each language at most.
    """
    may = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col) & (F.length(F.trim(text_col)) > 0))
    may = may.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    known = may.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).select("lang")
    order = Window.partitionBy("lang").orderBy("h", "id")
    ids = may.join(F.broadcast(known), "lang").select("id", "lang", F.xxhash64("id").alias("h")).withColumn("k", F.row_number().over(order)).where(F.col("k") <= n)
    picked = F.broadcast(materialize(ids.select("id", "lang").distinct(), "picked"))  # n * max_langs rows at most

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [(run, lang) for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True) for run in drawn(text.encode())]
            yield pa.RecordBatch.from_pydict({"words": pa.array([f[0] for f in found], pa.list_(pa.string())), "lang": pa.array([f[1] for f in found], pa.string())})

    runs = may.join(picked, ["id", "lang"]).select("lang", "text").mapInArrow(draw, "words array<string>, lang string").collect()
    return sorted((list(r["words"]), r["lang"]) for r in runs if r["words"])


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_docs: int = FIT_DOCS, max_langs: int = MAX_LANGS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, lang_pred, score.

    The CRF learns from ``fit_docs`` documents of each language value that are not held out, of the ``max_langs`` most frequent values; the
    language column, ids and anything but the text take no part in a prediction. Whole texts are
    read, each as one sequence. Texts that are null, empty or without letters get ``und`` and score
    0, as do all if there is nothing to learn from. A null id is never held out and never learned
    from. Repeated rows get equal results; an empty table gives an empty table.
    """
    runs = sample(docs, id_col, text_col, lang_col, fit_docs, max_langs)
    model = fit_runs(runs) if runs else None
    labels, weights, moves = (model.labels, model.weights.tobytes(), model.moves.tobytes()) if model else ([], b"", b"")

    def start():
        known = reader(labels, weights, moves) if labels else None

        def work(cols, texts):
            found = []
            for at in range(0, len(texts), 256):
                part = texts[at : at + 256]
                found += known.read(part) if known else [(UNKNOWN, 0.0)] * len(part)
            return {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "lang_pred": pa.array([f[0] for f in found], pa.string()), "score": pa.array([f[1] for f in found], pa.float64())}

        return work

    marked = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return map_texts(marked, {"doc_id": "doc_id", "held_out": "held_out"}, "text", start, f"doc_id {dict(marked.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")
