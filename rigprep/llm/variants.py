"""Spelling variants: words one edit apart, found by pivotal grams.

Bigrams are ordered by the number of words that have them, rarest first. A word's gram prefix is its
three rarest bigrams (with every bigram that ties with the third); out of it, dynamic programming
chooses two disjoint pivots. One edit spares a pivot: it lies behind the first one or before the second.
In the word of the two whose prefix ends first in the order, that pivot is also in the other word's
prefix, at the same distance from the start (first pivot) or the end (second). So pivots are looked
up among prefixes with that position and the text on the spared side as key, and every pair found is
verified by its edit distance. No link is lost and none is invented.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize
from rigprep.llm.text import keeps, slices

#: Letters of a word after lower-casing A-Z; 26 + 64 of them, so there are 8,100 bigrams at most.
LETTERS = "a-zÀ-ÿ"
MIN_CHARS, MIN_COUNT = 6, 5
#: A form is so many times as frequent as its variant, at least.
FORM_RATIO = 5
#: One run in so many loses a code point, by the hash of document and run.
DAMAGE = 199
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 200_000
#: By so much each further code point of a key is taken to cut the words that share it.
DECAY = 6.0


def damaged(run: str, crc: int, every: int) -> str:
    """The run without one code point, where ``every`` divides the hash."""
    if crc % every:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, damage: int = DAMAGE) -> DataFrame:
    """``(word, n)``: words of at least ``min_chars`` code points with at least ``min_count`` occurrences.

    Words are maximal runs of letters of the whole texts. A task counts up to HELD_WORDS words before it hands them
    on, and Spark adds them up. Null texts have none, and a null id hashes as an empty one. Repeated rows count again.
    """
    picked = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    runs = re.compile(f"[{LETTERS}]{{{min_chars},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeps("variants", lambda: None)
        held: Counter[str] = Counter()
        give = lambda: pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
        for batch in slices(batches):
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                start = zlib.crc32(f"{doc}:".encode())
                for run, n in Counter(runs.findall(text.as_py().lower().decode("utf-8", "replace"))).items():
                    word = damaged(run, zlib.crc32(run.encode(), start), damage)
                    if len(word) >= min_chars:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield give()
                    held.clear()
        yield give()

    return picked.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def gram_order(vocab: DataFrame) -> dict[str, tuple[int, int]]:
    """Bigram to (place in the order, words that have it); the alphabet bounds it to 8,100 entries."""
    at = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = vocab.where(F.char_length("word") > 1).select(F.explode(F.array_distinct(F.transform(at, lambda i: F.substring("word", i, F.lit(2))))).alias("gram"))
    rows = grams.groupBy("gram").count().collect()
    return {r["gram"]: (k, r["count"]) for k, r in enumerate(sorted(rows, key=lambda r: (r["count"], r["gram"])))}


def gram_prefix(word: str, order: dict[str, tuple[int, int]]) -> tuple[int, list[int]]:
    """(place of the last gram, positions of the grams up to it): the three rarest bigrams and ties."""
    places = [order[word[i : i + 2]][0] for i in range(len(word) - 1)]
    last = sorted(places)[min(3, len(places)) - 1]
    return last, [i for i, p in enumerate(places) if p <= last]


def pivots(word: str, prefix: list[int], order: dict[str, tuple[int, int]]) -> tuple[int, int]:
    """Two disjoint bigrams of the prefix, first and second, under which the fewest words are expected.

    Dynamic programming from left to right: the cheapest first pivot that ends before each second one.
    The first is met by the text up to its end, the second by the text from its start.
    """
    load = lambda i, side: order[word[i : i + 2]][1] * DECAY**-side
    best: tuple[float, int, int] | None = None
    first: tuple[float, int] | None = None
    waiting = 0
    for at in prefix:
        while prefix[waiting] + 2 <= at:
            cost = (load(prefix[waiting], prefix[waiting]), prefix[waiting])
            first = cost if first is None else min(first, cost)
            waiting += 1
        if first is not None:
            both = (first[0] + load(at, len(word) - 2 - at), first[1], at)
            best = both if best is None else min(best, both)
    return best[1], best[2]


def _key(side: str, text: str, size: int) -> int:
    return xxhash.xxh64_intdigest(f"{side}{size}:{text}") - (1 << 63)


def _index(vocab: DataFrame, order: dict[str, tuple[int, int]], of_pivots: bool) -> DataFrame:
    """``(key, word, n, last)``: pivots with every length that the other word may have, or gram prefixes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, row, lasts = [], [], []
            for k, word in enumerate(batch.column("word").to_pylist()):
                last, prefix = gram_prefix(word, order)
                if of_pivots:
                    a, b = pivots(word, prefix, order)
                    made = [_key(side, text, len(word) + d) for side, text in (("l", word[: a + 2]), ("r", word[b:])) for d in (-1, 0, 1)]
                else:
                    made = [key for i in prefix for key in (_key("l", word[: i + 2], len(word)), _key("r", word[i:], len(word)))]
                keys += made
                row += [k] * len(made)
                lasts += [last] * len(made)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int64()), "word": batch.column("word").take(take), "n": batch.column("n").take(take), "last": pa.array(lasts, pa.int32())})

    return vocab.select("word", "n").mapInArrow(build, "key long, word string, n long, last int")


def near_words(vocab: DataFrame) -> DataFrame:
    """``(word, n, near, near_n)``: every two words of ``vocab`` (word, n) exactly one edit apart, in both directions.

    Words have four code points or more, so that a prefix has two disjoint bigrams.
    """
    order = gram_order(vocab)
    a = _index(vocab, order, True).toDF("key", "word", "n", "last")
    b = _index(vocab, order, False).toDF("key", "near", "near_n", "near_last")
    found = a.join(b, "key").where((F.col("near_last") >= F.col("last")) & (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1))
    turned = F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.select(F.explode(F.array(F.struct("word", "n", "near", "near_n"), turned)).alias("p")).select("p.*").distinct()


def followed(links: DataFrame) -> DataFrame:
    """``(word, root)``: each word's last form. Links double each round; they rise, so there is no circle."""
    links = materialize(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = links.select(F.col("word").alias("via"), F.col("root").alias("far"))
        links = materialize(links.join(on, F.col("root") == F.col("via"), "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "forms")
        if links.where("moved").limit(1).count() == 0:
            return links.select("word", "root")
        links = links.select("word", "root")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, damage: int = DAMAGE, ratio: int = FORM_RATIO) -> DataFrame:
    """One row for each word: word, n, n_near, form, form_n, root.

    A word's form is its near word of largest n (of equals the first in code-point order), if that is
    at least ``ratio`` times its own n; ``root`` follows the forms to the last, and is the word itself without one. Null
    and empty texts have no words; an empty table gives an empty table; other columns are not looked at.
    """
    if min_chars < 4:
        raise ValueError("min_chars must be 4 or more: a gram prefix needs two disjoint bigrams")
    vocab = materialize(word_counts(docs, id_col, text_col, min_chars, min_count, damage), "words")
    top = F.min(F.struct((-F.col("near_n")).alias("down"), F.col("near").alias("near")))
    best = near_words(vocab).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), top.alias("top")).select("word", "n_near", F.col("top.near").alias("near"), (-F.col("top.down")).alias("near_n"))
    enough: Column = F.col("near_n") >= ratio * F.col("n")
    words = vocab.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n"))
    words = materialize(words, "variants")
    roots = followed(words.where("form is not null"))
    return words.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
