"""Phrase collocations from sorted count streams.

Counting goes length by length: a phrase can be frequent only if its parts are, so texts are read once for each
length and only phrases whose parts pass a filter of bounded size are counted. What is
frequent enough becomes a count stream. The stream is kept twice: in prefix order (words from the
first on) and in suffix order (words from the last back). In prefix order a phrase comes after its own first
words and before its extensions to the right, so one lockstep pass gives each phrase the counts of its
first parts and of its most frequent extension; suffix order gives the same on the other side. No count is
looked up by hash. Where a range ends amid a phrase's extensions, the next one asks for the few counts
that lie before it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize
from rigprep.llm.text import keeps, slices

MIN_COUNT = 10
MAX_WORDS = 3
#: The first phrases of a language that are reported.
TOP = 2000
#: Phrases of a language are ranked in so many parts first.
RANK_PARTS = 64
#: Texts are counted so many bytes at a time.
CHUNK_BYTES = 4 << 20
#: A filter has 16 bits for each phrase of its stream, and so many bits at most.
FILTER_BITS, MOST_BITS, BLOCK_BITS = 16, 1 << 29, 32768
#: What ends a piece, and what lies between words.
ENDS = b".,;:!?\n\x0b\x0c\r"
TO_STOP = bytes.maketrans(ENDS, b"." * len(ENDS))
GAP = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
ROTATE = 17


# --- the filter of what is frequent ---------------------------------------------------------


def fold(before: Column, word: Column) -> Column:
    """The hash of a phrase from that of its first words and its last word; ``_fold`` does the same in numpy."""
    turned = F.shiftleft(before, ROTATE).bitwiseOR(F.shiftrightunsigned(before, 64 - ROTATE))
    return turned.bitwiseXOR(F.xxhash64(word))


def _fold(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (before << np.uint64(ROTATE) | before >> np.uint64(64 - ROTATE)) ^ word


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)  # the seed of Spark's xxhash64


def frequent_filter(stream: DataFrame, words: int) -> Broadcast:
    """A bitmap of the phrases of a written stream, at most 64 MB; it errs only towards "frequent"."""
    bits = max(BLOCK_BITS, min(MOST_BITS, 1 << (FILTER_BITS * max(stream.count(), 1) - 1).bit_length()))
    h, cut = F.xxhash64("lang"), F.split("phrase", " ")
    for k in range(words):
        h = fold(h, F.get(cut, F.lit(k)))
    slot = stream.select((h.bitwiseAND(F.lit(bits - 1)) + 1).alias("slot"))
    blocks = slot.groupBy(F.bitmap_bucket_number("slot").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")).collect()
    whole = np.zeros(bits // 8, dtype=np.uint8)
    for r in blocks:
        at = (r["block"] - 1) * BLOCK_BITS // 8
        whole[at : at + BLOCK_BITS // 8] = np.frombuffer(r["bitmap"], dtype=np.uint8)
    return stream.sparkSession.sparkContext.broadcast(whole)


def _passes(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = (h & np.uint64(len(bitmap) * 8 - 1)).astype(np.int64)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


# --- counting -------------------------------------------------------------------------------


def chunks(text: bytes, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    """``text`` in runs of about ``size`` bytes that end between words; a longer word stays whole."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + size)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def phrase_counts(text: bytes, lang: bytes, words: int, bitmaps: list[np.ndarray]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """(phrases, counts) of each chunk of texts of one language, for phrases of so many words whose parts pass.

    The last words of a chunk, one less than a phrase has, come again before the next one.
    """
    carry: list[bytes] = []
    for chunk in chunks(text):
        tokens = carry + chunk.lower().translate(TO_STOP).replace(b".", b" . ").split()
        carry = tokens[len(tokens) - words + 1 :] if words > 1 else []
        index: dict[bytes, int] = {b".": 0}
        for t in set(tokens) - {b"."}:
            index[t] = len(index)
        names = list(index)
        ids = np.fromiter(map(index.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        good = ids > 0
        if words > 1:
            hashes = np.fromiter(map(_hash, names), dtype=np.uint64, count=len(names))
            start = np.full(len(names), _hash(lang), dtype=np.uint64)
            word = _fold(start, hashes)
            good &= _passes(bitmaps[0], word)[ids]
            h = word[ids]
            for bitmap in bitmaps[1:]:
                h = _fold(h[:-1], hashes[ids[len(ids) - len(h) + 1 :]])
                good = good[:-1] & good[1:]
                good[good] = _passes(bitmap, h[good])
            good = good[:-1] & good[1:]
        at = np.flatnonzero(good)
        if len(at):
            key, top = ids[at], len(names)
            for k in range(1, words):
                if top * len(names) >= 1 << 62:
                    _, key = np.unique(key, return_inverse=True)
                    top = len(at)
                key, top = key * len(names) + ids[at + k], top * len(names)
            _, firsts, n = np.unique(key, return_index=True, return_counts=True)
            parts = [[names[i] for i in ids[at[firsts] + k]] for k in range(words)]
            yield [b" ".join(p) for p in zip(*parts, strict=True)] if words > 1 else parts[0], n


def count_stream(docs: DataFrame, lang_col: str, text_col: str, words: int, filters: list[Broadcast], min_count: int) -> DataFrame:
    """The written stream ``(lang, phrase, n)`` of phrases of so many words with ``min_count`` or more.

    The stream of single words has one row more for each language: the empty phrase, with all its words.
    """
    picked = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).cast("binary").alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeps("collocations", lambda: None)
        bitmaps = [f.value for f in filters]
        for batch in slices(batches):
            by_lang: dict[bytes, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for phrases, n in phrase_counts(b".".join(texts), lang, words, bitmaps):
                    if words == 1:
                        phrases, n = [*phrases, b""], [*n, n.sum()]
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(phrases), pa.binary()), "phrase": pa.array(phrases, pa.binary()), "n": pa.array(n, pa.int64())})

    found = picked.mapInArrow(run, "lang binary, phrase binary, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return materialize(found.where(F.col("n") >= min_count).select(F.col("lang").cast("string").alias("lang"), F.col("phrase").cast("string").alias("phrase"), "n"), f"phrases{words}")


# --- lockstep passes over sorted streams ------------------------------------------------------


def lockstep(words: int, side: str, cols: list[str]) -> Callable:
    """A pass over phrases in order: ``{side}1``, ... are the counts of the parts before it, ``{side}x`` that of its most frequent extension.

    A part's row precedes its extensions, so the part of k words is always the last row of k words. A range that begins
    amid extensions leaves their parts null and adds a row without count for the part whose extensions it has seen.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, int | None] = dict.fromkeys(range(1, words))
        open_rows: dict[int, tuple[pa.RecordBatch, int] | None] = dict.fromkeys(range(2, words))

        def closed(k: int) -> Iterator[pa.RecordBatch]:
            if open_rows[k] is not None:
                row, most = open_rows[k]
                yield put(row, f"{side}x", pa.array([most], pa.int64()))
                open_rows[k] = None

        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names)  # all columns may be null
            size, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("size", "n"))
            place = np.arange(len(size))
            most = np.zeros(len(size), dtype=np.int64)
            stay = np.ones(len(size), dtype=bool)
            for k in range(1, words):
                owner = np.maximum.accumulate(np.where(size == k, place, -1))
                known = (owner >= 0) | (last[k] is not None)
                part = np.where(owner >= 0, n[np.maximum(owner, 0)], last[k] or 0)
                batch = put(batch, f"{side}{k}", pa.array(part, pa.int64(), mask=(size <= k) | ~known))
                if owner[-1] >= 0:
                    last[k] = int(n[owner[-1]])
                if k == 1:
                    continue
                longer = size == k + 1
                np.maximum.at(most, owner[longer & (owner >= 0)], n[longer & (owner >= 0)])
                before = np.flatnonzero(longer & (owner < 0))
                if len(before):
                    top = int(n[before].max())
                    if open_rows[k] is None:  # its row lies in an earlier range
                        open_rows[k] = (orphan(batch.slice(int(before[0]), 1), k, cols, words), top)
                    else:
                        open_rows[k] = (open_rows[k][0], max(open_rows[k][1], top))
                if owner[-1] >= 0:
                    yield from closed(k)
                    stay[owner[-1]] = False
            for k in range(2, words):
                at = np.flatnonzero((size == k) & ~stay)
                if len(at):
                    open_rows[k] = (batch.slice(int(at[0]), 1), int(most[at[0]]))
            yield put(batch, f"{side}x", pa.array(most, pa.int64())).filter(pa.array(stay))
        for k in range(2, words):
            yield from closed(k)

    return run


def put(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return batch.set_column(batch.schema.get_field_index(name), name, values)


def orphan(row: pa.RecordBatch, k: int, cols: list[str], words: int) -> pa.RecordBatch:
    """The row of a phrase's first k words in this order, of which only the extensions are known."""
    for i in range(k, words):
        row = put(row, cols[i], pa.array([None], pa.string()))
    return put(put(row, "size", pa.array([k], pa.int32())), "n", pa.array([None], pa.int64()))


def with_side(rows: DataFrame, side: str, words: int) -> DataFrame:
    """``rows`` (a written stream: lang, w1, ..., size, n) with the counts of its parts and extensions on one side.

    side ``l``: in prefix order; side ``r``: in suffix order. Ranges are cut anywhere, so a hot word's
    phrases spread over tasks. What a range asks of earlier ones is two rows for each range at most.
    """
    # in this order the first column is the first word (prefix) or the last one (suffix)
    at = [F.col(f"w{k + 1}") if side == "l" else F.get(F.reverse(F.array_compact(F.array(*[f"w{i + 1}" for i in range(words)]))), F.lit(k)) for k in range(words)]
    cols = [f"o{k + 1}" for k in range(words)]
    counts = [f"{side}{k}" for k in range(1, words)]
    ordered = rows.withColumns(dict(zip(cols, at, strict=True)) | {c: F.lit(None).cast("long") for c in [*counts, f"{side}x"]})
    ordered = ordered.repartitionByRange("lang", *cols).sortWithinPartitions("lang", *cols)
    types = dict(ordered.dtypes)
    seen = materialize(ordered.mapInArrow(lockstep(words, side, cols), ", ".join(f"{c} {t}" for c, t in types.items())), "stream")
    out = seen.where("n is not null")
    for k in range(1, words):  # at most one part of each length for each range
        key = ["lang", *cols[:k]]
        asked = materialize(seen.where(f"n is not null and size > {k} and {side}{k} is null").select(*key).distinct(), "asked")
        if asked.limit(1).count():
            known = materialize(seen.where(f"n is not null and size = {k}").join(F.broadcast(asked), key).select(*key, F.col("n").alias("found")), "parts")
            out = out.join(F.broadcast(known), key, "left").withColumn(f"{side}{k}", F.when(F.col("size") > k, F.coalesce(f"{side}{k}", "found")).otherwise(F.col(f"{side}{k}"))).drop("found")
    late = seen.where("n is null").groupBy("lang", *cols).agg(F.max(f"{side}x").alias("found"))
    late = materialize(late.toDF("late_lang", *[f"late_{c}" for c in cols], "found"), "late")
    if late.limit(1).count():
        same = [F.col(c).eqNullSafe(F.col(f"late_{c}")) for c in ("lang", *cols)]
        out = out.join(F.broadcast(late), same, "left").withColumn(f"{side}x", F.greatest(f"{side}x", "found")).drop(*late.columns)
    return out.drop(*cols)


# --- phrases ----------------------------------------------------------------------------------


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> DataFrame:
    """``(lang, phrase, words, a, l, r, n, score)`` of all phrases of 2 to ``max_words`` words that stay.

    A phrase has at least ``min_count`` occurrences inside pieces (texts cut at ``.,;:!?`` and line ends; words cut
    at spaces and tabs; only A-Z are lower-cased). Its score is floor(1000000 a a / (l r)) at its weakest cut, the first
    of equals. A phrase goes where a longer candidate has it and half its occurrences; as counts never rise with length,
    only extensions by one word need be asked. Everything is per language; a null one is ``und``. Null and
    empty texts have no words, repeated rows count again, an empty table gives none, other columns are not looked at.
    """
    if max_words < 2:
        raise ValueError("max_words must be 2 or more")
    streams, filters = [], []
    for k in range(1, max_words + 1):
        streams.append(count_stream(docs, lang_col, text_col, k, filters, min_count))
        if k < max_words:
            filters.append(frequent_filter(streams[-1], k))
    for f in filters:
        f.unpersist()
    total = streams[0].where("phrase = ''").select("lang", F.col("n").alias("total"))
    names = [f"w{k + 1}" for k in range(max_words)]
    rows = None
    for k, s in enumerate(streams):
        cut = F.split("phrase", " ")
        one = s.where("phrase <> ''").select("lang", *[(F.get(cut, F.lit(i)) if i <= k else F.lit(None).cast("string")).alias(c) for i, c in enumerate(names)], F.lit(k + 1).alias("size"), "n")
        rows = one if rows is None else rows.unionByName(one)
    both = with_side(materialize(with_side(rows, "l", max_words), "prefix"), "r", max_words).where("size > 1")
    # a part of k words on the left leaves size - k on the right
    wide = lambda c: F.col(c).cast("decimal(14,0)")
    cuts = []
    for k in range(1, max_words):
        right = F.coalesce(*[F.when(F.col("size") == s, wide(f"r{s - k}")) for s in range(k + 1, max_words + 1)])
        score = _score(wide("n"), wide(f"l{k}"), right)
        cuts.append(F.when(F.col("size") > k, F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), right.cast("long").alias("r"))))
    kept = both.where(100 * F.greatest(F.coalesce("lx", F.lit(0)), F.coalesce("rx", F.lit(0))) < 50 * F.col("n"))
    best = kept.withColumn("cut", F.array_min(F.array_compact(F.array(*cuts)))).join(total, "lang")
    return best.select("lang", F.concat_ws(" ", *names).alias("phrase"), F.col("size").alias("words"), F.col("n").alias("a"), "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of 37 digits; counts have 14 at most."""
    over, under = F.lit(1000000).cast("decimal(7,0)") * a * a, left * right
    return F.call_function("div", over, under)


def top_collocations(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language, with their ``rank``: by score, occurrences and the phrase's bytes.

    Parts of a language are ranked first, so that one task ranks RANK_PARTS * top rows at most.
    """
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    some = found.withColumn("__part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top).drop("__part")
