"""Quality rules: base counts, and tokeniser fertility with rejection bands per language.

Two public vocabularies split every word of a text. Text that they fit has several characters a
token, few tokens that fall back to bytes, and varied tokens; encoded blobs, symbol noise and
wrongly decoded text do not. Three measures are held against bands:

* chars_per_token: characters of words for each token of the multilingual byte-level vocabulary,
* byte_share: share of the piece vocabulary's tokens that stand for single bytes,
* token_entropy: bits of the distribution of the piece vocabulary's tokens in the text.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigprep.llm.text import ASCII_SPACE, CONTINUATION, give_back, keeps, map_texts, slices

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
#: Words that a Python worker remembers, and bytes of text that it takes at a time.
CACHE_WORDS, BLOCK_BYTES = 200_000, 1 << 20
#: Bands by language, or by script where the language is not listed: least and most characters a
#: token, most byte-fallback share, least token entropy in bits. The bands of the four languages are
#: fitted on the labelled texts of sf0.1 (3,243 good ones past the base rule): least characters a
#: token of a good text less 0.05 (or the earlier floor, if higher), no byte tokens and a margin of 0.02, and an
#: entropy curve, a + b x + c x x with x = log2(n_tokens) held to CURVE, least good text less 0.05.
CURVE = (6.5, 13.0)
BANDS = {
    "en": (1.93, 9.0, 0.02, (0.984, 0.9171, -0.0375)),
    "de": (2.11, 9.0, 0.02, (1.713, 0.777, -0.0319)),
    "fr": (1.78, 9.0, 0.02, (1.672, 0.7577, -0.0314)),
    "es": (1.86, 9.0, 0.02, (0.977, 0.9159, -0.0386)),
    "latin": (1.5, 9.0, 0.20, 3.0),
    "cyrillic": (0.8, 9.0, 0.30, 3.0),
    "cjk": (0.3, 4.0, 0.60, 3.0),
    "other": (0.3, 9.0, 0.90, 3.0),
}


#: Longer words are tokenised in parts of so many code points, which the vocabularies can take.
WORD_PART = 100_000


class Vocabulary:
    """Numbers of the words met so far, and for each its tokens, in flat arrays that grow."""

    def __init__(self, byte_vocab: str, piece_vocab: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(public_tokenizers.path(byte_vocab), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_vocab))
        self.is_byte = np.array([self.sp.is_byte(i) for i in range(self.sp.get_piece_size())])
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.pieces, self.start, self.byte_tokens = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64), np.empty(0, dtype=np.int64)

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.number]
        if not new:
            return
        texts = [w.decode("utf-8", "replace") for w in new]
        split = self.sp.encode([x if len(x) <= WORD_PART else "" for x in texts], num_threads=1)
        for k, x in enumerate(texts):
            if len(x) > WORD_PART:
                split[k] = [i for part in parts(x) for i in self.sp.encode(part)]
        bpe = np.fromiter((sum(len(self.bpe.encode_ordinary(part)) for part in parts(" " + x)) for x in texts), dtype=np.int64, count=len(texts))
        self.byte_tokens = np.concatenate([self.byte_tokens, bpe])
        n = len(self.number)
        self.number.update(zip(new, range(n, n + len(new)), strict=True))
        lengths = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        flat = np.fromiter((x for s in split for x in s), dtype=np.int32, count=int(lengths.sum()))
        self.pieces = np.concatenate([self.pieces, flat])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lengths)])

    def tokens(self, ids: np.ndarray) -> np.ndarray:
        """The tokens of a sequence of word numbers."""
        first = self.start[ids]
        length = self.start[ids + 1] - first
        ends = np.cumsum(length)
        return self.pieces[np.repeat(first - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]


def parts(word: str) -> list[str]:
    return [word] if len(word) <= WORD_PART else [word[k : k + WORD_PART] for k in range(0, len(word), WORD_PART)]


@lru_cache(maxsize=1)
def vocabulary(byte_vocab: str, piece_vocab: str) -> Vocabulary:
    """One for each Python worker, kept from task to task."""
    return Vocabulary(byte_vocab, piece_vocab)


def repeat_words(ids: np.ndarray) -> int:
    """Words that lie in a window of three words that is found twice or more."""
    if len(ids) < 4:
        return 0
    if ids.max() >= 1 << 21:
        ids = np.unique(ids, return_inverse=True)[1]
    if ids.max() < 1 << 21:
        keys = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:
        pairs = np.unique((ids[:-2] << 31) | ids[1:-1], return_inverse=True)[1]
        keys = (pairs << 31) | ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(len(keys), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def script_of(text: bytes) -> str:
    """The script most letters of the text's first differing bytes belong to, by UTF-8 lead bytes."""
    lead = np.frombuffer(text, dtype=np.uint8)
    count = np.bincount(lead, minlength=256)
    latin = count[65:91].sum() + count[97:123].sum() + count[0xC3:0xCA].sum()
    cyrillic, cjk, other = count[0xD0:0xD4].sum(), count[0xE3:0xEE].sum(), count[0xCE:0xD0].sum() + count[0xD4:0xE3].sum()
    return max(((latin, "latin"), (cyrillic, "cyrillic"), (cjk, "cjk"), (other, "other")), key=lambda x: x[0])[1]


def base_counts(text: bytes, words: list[bytes], ids: np.ndarray) -> tuple:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text.translate(None, ASCII_SPACE + CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(ids),
    )


def entropy(pieces: np.ndarray) -> float:
    if not len(pieces):
        return 0.0
    n = np.bincount(pieces)
    p = n[n > 0] / len(pieces)
    return float(-(p * np.log2(p)).sum())


def least_entropy(bits, n_tokens: int) -> float:
    """A number, or a curve over the length of the text."""
    if not isinstance(bits, tuple):
        return bits
    x = min(max(float(np.log2(max(n_tokens, 1))), CURVE[0]), CURVE[1])
    return bits[0] + bits[1] * x + bits[2] * x * x


def verdict(lang, script, n_words, n_tokens, chars_per_token, byte_share, token_entropy, bands) -> str | None:
    """The rule that rejects the text, or null."""
    if not n_words:
        return None
    least, most, most_bytes, least_bits = bands.get(lang) or bands.get(script) or bands["other"]
    if not least <= chars_per_token <= most:
        return "chars_per_token"
    if byte_share > most_bytes:
        return "byte_share"
    if token_entropy < least_entropy(least_bits, n_tokens):
        return "token_entropy"
    return None


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by", "script", "n_tokens", "chars_per_token", "byte_share", "token_entropy")
TYPES = ("long",) * 5 + ("boolean", "boolean", "string", "string", "long", "double", "double", "double")
ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "double": pa.float64()}


def judge(text: bytes, words: list[bytes], lang: str | None, vocab: Vocabulary, bands: dict) -> tuple:
    ids = np.fromiter(map(vocab.number.__getitem__, words), dtype=np.int64, count=len(words))
    base = base_counts(text, words, ids)
    tokens, n_tokens = vocab.tokens(ids), int(vocab.byte_tokens[ids].sum())
    measures = (base[1] / n_tokens, float(vocab.is_byte[tokens].mean()), entropy(tokens)) if len(tokens) else (0.0, 0.0, 0.0)
    script = script_of(text)
    failed = base[0] < MIN_WORDS or 100 * base[4] > 50 * base[0]
    why = "base" if failed else verdict(lang, script, base[0], n_tokens, *measures, bands)
    return (*base, failed, why is None, why, script, n_tokens, *measures)


KEPT = NAMES.index("kept")


def _judges(bands: dict, byte_vocab: str, piece_vocab: str):
    """A function that a task calls once for one that judges texts (bytes) with their languages."""

    def start():
        keeps("quality", vocabulary.cache_clear)
        known = vocabulary(byte_vocab, piece_vocab)

        def work(texts: list[bytes], langs: list) -> list[tuple]:
            rows, at = [], 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK_BYTES):
                    size += len(texts[end])
                    end += 1
                split = [x.split() for x in texts[at:end]]
                if len(known.number) > CACHE_WORDS:
                    known.forget()
                known.learn(set().union(*split))
                rows += [judge(*x, known, bands) for x in zip(texts[at:end], split, langs[at:end], strict=True)]
                at = end
            return rows

        return work

    return start


def fertility_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bands: dict | None = None,
                    byte_vocab: str = "byte_bpe_multi_50k.tiktoken", piece_vocab: str = "piece_bpe_32k.model") -> DataFrame:
    """One row for each document: the base counts, base_failed, the measures, and kept.

    Words are runs of bytes outside ASCII white space. base_failed: fewer than 50 words, or over
    half of the words in three-word windows that repeat. kept is false for these, and for texts
    whose measures leave the band of their language (or of their script, where the language is
    null, absent or has no band). A null or empty text has no words, so it fails. Every row is
    judged by itself: repeated rows get equal verdicts, and one pass needs no shuffle.
    """
    given = docs if lang_col in docs.columns else docs.withColumn(lang_col, F.lit(None).cast("string"))
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, " + ", ".join(f"{n} {t}" for n, t in zip(NAMES, TYPES, strict=True))
    verdicts = _judges(bands or BANDS, byte_vocab, piece_vocab)

    def start():
        known = verdicts()

        def work(cols, texts):
            rows = known(texts, cols["lang"].to_pylist())
            return {"doc_id": cols["doc_id"]} | {n: pa.array(c, type=ARROW[t]) for n, c, t in zip(NAMES, zip(*rows), TYPES, strict=True)}

        return work

    return map_texts(given, {"doc_id": id_col, "lang": lang_col}, text_col, start, schema)


def drop_rejected(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", bands: dict | None = None,
                  byte_vocab: str = "byte_bpe_multi_50k.tiktoken", piece_vocab: str = "piece_bpe_32k.model") -> DataFrame:
    """``docs`` without the rows that the rules reject; all columns stay.

    Each row is judged by its own text and language and goes or stays by itself, so null and repeated ids need no
    care. Rows pass through the judging tasks whole; nothing is joined or shuffled. An empty table stays empty.
    """
    verdicts, number = _judges(bands or BANDS, byte_vocab, piece_vocab), {c: i for i, c in enumerate(docs.columns)}
    text_at, lang_at = number[text_col], number.get(lang_col)

    def run(batches):
        known = None
        for batch in slices(batches):
            known = known or verdicts()
            texts = [t or b"" for t in batch.column(text_at).cast(pa.string()).cast(pa.binary()).to_pylist()]
            langs = [None] * len(texts) if lang_at is None else batch.column(lang_at).cast(pa.string()).to_pylist()
            kept = pa.array([row[KEPT] for row in known(texts, langs)], pa.bool_())
            yield batch.filter(kept)
        give_back()

    return docs.mapInArrow(run, docs.schema)
