"""Packing token pieces into sequences by cutting-stock column generation.

A document's ids (its tokens and a closing 0) are cut every ``length`` ids. Full pieces fill a
sequence each; the rest are the items of a cutting-stock problem. Only the histogram of item
lengths, which has ``length`` entries at any input size, goes to the driver: a linear program
over patterns (how many items of each length share a sequence) is solved by column generation,
with a knapsack dynamic program to price new columns. Rounded patterns are given to the items by
their rank within their length, so that the assignment is a join and not a search.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rigprep.functions.shared import materialize
from rigprep.llm.text import give_back, keeps, map_texts

LENGTH = 1024
#: Items are planned by their length rounded up to a multiple of this.
CLASS_WIDTH = 8
#: Rows that are ranked together in one task, about.
RANK_ROWS = 50_000
MAX_COLUMNS = 3000
#: Fixed value: the added token of the vocabulary's tokenizers file, which that library finds in texts by default.
SPECIAL = {"<|endoftext|>": 50256}


# --- tokens ------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def encoder(vocab: str):
    """The byte-level vocabulary; one for each Python worker. The special string has its own id in a text too."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocab), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def forget() -> None:
    encoder.cache_clear()
    full_tokenizer.cache_clear()


@lru_cache(maxsize=1)
def full_tokenizer(vocab: str):
    """The tokenizers file of the same vocabulary, which takes any text."""
    import public_tokenizers
    import tokenizers

    return tokenizers.Tokenizer.from_file(public_tokenizers.path(vocab))


def token_ids(text: str, vocab: str, full_vocab: str) -> list[int]:
    """The ids of a text. ``encoder`` gives up on runs of about a million white-space characters; the tokenizers file then gives the same ids."""
    try:
        return encoder(vocab).encode(text, allowed_special="all")
    except (ValueError, RuntimeError):
        return full_tokenizer(full_vocab).encode(text, add_special_tokens=False).ids


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, vocab: str = "byte_bpe_50k.tiktoken", full_vocab: str = "byte_bpe_50k.json") -> DataFrame:
    """``(doc_id, start, length, doc_tokens, ids)``: each document's ids and a closing 0, cut every ``length``.

    ids are little-endian unsigned 32-bit numbers. ``vocab`` is the rank file of the byte-level
    vocabulary, whose ids equal those of its tokenizers file ``full_vocab`` (`<|endoftext|>` in a text is id 50256), which
    serves texts that the former cannot take. A null or empty text is the piece [0];
    repeated rows give repeated pieces; an empty table gives none.
    """

    def start():
        keeps("packing", forget)

        def work(cols, texts):
            doc, begin, size, total, ids = [], [], [], [], []
            for k, text in enumerate(texts):
                tokens = np.array([*token_ids(text.decode("utf-8", "replace"), vocab, full_vocab), 0], dtype="<u4")
                for at in range(0, len(tokens), length):
                    piece = tokens[at : at + length]
                    doc.append(k)
                    begin.append(at)
                    size.append(len(piece))
                    total.append(len(tokens))
                    ids.append(piece.tobytes())
            return {"doc_id": cols["doc_id"].take(pa.array(doc, type=pa.int64())), "start": pa.array(begin, pa.int64()), "length": pa.array(size, pa.int64()), "doc_tokens": pa.array(total, pa.int64()), "ids": pa.array(ids, pa.binary())}

        return work

    return map_texts(docs, {"doc_id": id_col}, text_col, start, f"doc_id {dict(docs.dtypes)[id_col]}, start long, length long, doc_tokens long, ids binary", give_back)


# --- the plan, on a histogram ---------------------------------------------------------------


def knapsack(value: np.ndarray, size: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: how many of each class, any number of times, fit in ``room``."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    fits = np.argsort(size)
    sizes, values = size[fits], value[fits]
    for r in range(1, room + 1):
        k = np.searchsorted(sizes, r, side="right")
        best[r] = best[r - 1]
        if k:
            gain = best[r - sizes[:k]] + values[:k]
            j = int(gain.argmax())
            if gain[j] > best[r] + 1e-12:
                best[r], pick[r] = gain[j], fits[j]
    pattern, r = np.zeros(len(size), dtype=np.int64), room
    while r > 0:
        if pick[r] < 0:
            r -= 1
        else:
            pattern[pick[r]] += 1
            r -= size[pick[r]]
    return float(best[room]), pattern


def solve_lp(size: np.ndarray, demand: np.ndarray, room: int, max_columns: int = MAX_COLUMNS) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used in the linear program's optimum.

    Revised simplex on the square basis: it starts from the patterns of one class, the knapsack
    prices the next column, and the basis inverse is updated by one pivot. The bound that each
    pricing proves ends the search when the program is within a thousandth of its optimum.
    Columns are priced at duals drawn towards those of the best bound so far, which keeps them
    from swinging; a column that does not help at the true duals is priced again at these.
    """
    m = len(size)
    basis = np.diag(room // size).astype(float)
    inverse = np.diag(1.0 / (room // size))
    x = inverse @ demand
    centre, bound = None, 0.0
    for _ in range(max_columns):
        duals = inverse.sum(axis=0)
        for at in (duals if centre is None else 0.7 * centre + 0.3 * duals, duals):
            worth, column = knapsack(at, size, room)
            if (proved := float(at @ demand) / max(worth, 1e-9)) > bound:
                bound, centre = proved, at / max(worth, 1e-9)
            if duals @ column > 1 + 1e-7:
                break
        if duals @ column <= 1 + 1e-7 or x.sum() <= bound * 1.001:
            break
        d = inverse @ column
        up = d > 1e-9
        ratio = np.where(up, x / np.where(up, d, 1), np.inf)
        out = int(ratio.argmin())
        move = ratio[out]
        x -= move * d
        x[out] = move
        x = np.maximum(x, 0)
        basis[:, out] = column
        row = inverse[out] / d[out]
        inverse -= np.outer(d, row)
        inverse[out] = row
    return basis.T.astype(np.int64), x


def plan(histogram: dict[int, int], room: int = LENGTH, width: int = CLASS_WIDTH) -> list[tuple[dict[int, int], int]]:
    """Patterns ``{class size: items}`` with whole counts that use up a histogram of item lengths.

    ``width`` divides ``room``. The program's counts are rounded down; what is left is filled greedily, each sequence with
    the largest items that still fit.
    """
    need: dict[int, int] = {}
    for n, count in histogram.items():
        k = -(-n // width) * width
        need[k] = need.get(k, 0) + count
    out: list[tuple[dict[int, int], int]] = []
    if not need:
        return out
    size = np.array(sorted(need), dtype=np.int64)
    left = np.array([need[k] for k in size], dtype=np.int64)
    patterns, x = solve_lp(size // width, left.astype(float), room // width)
    for p, times in sorted(zip(patterns.tolist(), np.floor(x + 1e-9).astype(np.int64).tolist(), strict=True), key=lambda y: -y[1]):
        p = np.array(p)
        if p.any() and times > 0:
            times = min(times, int((left[p > 0] // p[p > 0]).min()))
            if times > 0:
                left -= times * p
                out.append(({int(s): int(c) for s, c in zip(size, p, strict=True) if c}, times))
    while left.any():
        r, p = room, np.zeros_like(left)
        while (ok := (left - p > 0) & (size <= r)).any():
            j = int(np.flatnonzero(ok)[-1])
            take = min(int((left - p)[j]), int(r // size[j]))
            p[j] += take
            r -= take * int(size[j])
        times = int((left[p > 0] // p[p > 0]).min())
        left -= times * p
        out.append(({int(s): int(c) for s, c in zip(size, p, strict=True) if c}, times))
    return out


# --- ranks and assignment ---------------------------------------------------------------------


def with_rank(rows: DataFrame, key: str, order: list[str], total: int, size: str | None = None) -> DataFrame:
    """``rows`` with ``rank``: a gapless number from 0 within ``key``, whatever the key's share.

    A key's rows are split by a hash into parts of bounded size; parts are counted first, and a
    row's rank is the count of the parts before plus its number in its part.
    """
    parts = max(1, total // RANK_ROWS)
    cut = rows.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(cut.groupBy(key, "part").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"), "ranks")
    inside = Window.partitionBy(key, "part").orderBy(*order)
    return cut.withColumn("inside", F.row_number().over(inside) - 1).join(counts, [key, "part"]).withColumn("rank", F.col("before") + F.col("inside")).drop("part", "before", "inside")


def pack(pieces: DataFrame, room: int = LENGTH, width: int = CLASS_WIDTH) -> DataFrame:
    """``pieces`` (doc_id, start, length and any others) with sequence_id and offset.

    Every piece is in one sequence; the lengths of a sequence add up to ``room`` at most, and
    offsets are gapless from 0. Pieces of full length have a sequence of their own. The plan that
    is broadcast has a row for each pattern and class, which ``room`` bounds. Ties are ordered by
    document, start and position in the table. A sequence that ends at a power of two needs no padding; the plan
    does not aim at that, as most sequences end within a few ids of ``room``. Items are planned by lengths
    rounded up to ``width``, which costs at most ``width`` - 1 ids an item. An empty table gives an
    empty table. Other columns stay, whatever their names (but for __pack_row and __pack_class); a sequence_id or
    offset that is there is replaced.
    """
    others = [c for c in pieces.columns if c not in ("doc_id", "start", "length", "sequence_id", "offset")]
    rows = materialize(pieces.withColumn("__pack_row", F.monotonically_increasing_id()).withColumn("__pack_class", F.least(F.ceil(F.col("length") / width) * width, F.lit(room)).cast("long")), "pieces")
    histogram = {r["length"]: r["count"] for r in rows.where(F.col("length") < room).groupBy("length").count().collect()}  # room entries at most
    total = rows.count()
    taken, uses, base = {}, [], 0
    for pattern, times in plan(histogram, room, width):
        for k, n in pattern.items():
            first = taken.get(k, 0)
            uses.append((k, first, first + n * times, n, base))
            taken[k] = first + n * times
        base += times
    spark = pieces.sparkSession
    fields = [T.StructField(c, T.LongType()) for c in ("class", "first", "last", "each", "base")]
    uses = spark.createDataFrame(uses, T.StructType(fields))
    full = F.col("length") >= room
    ranked = with_rank(rows.select(F.when(full, -1).otherwise(F.col("__pack_class")).alias("class"), "doc_id", "start", "length", "__pack_row"), "class", ["doc_id", "start", "__pack_row"], total)
    alone = ranked.where(full).select("doc_id", "start", "length", "__pack_row", (F.col("rank") + base).alias("sequence_id"))
    shared = ranked.where(~full).join(F.broadcast(uses), "class").where("rank >= first and rank < last")
    shared = shared.select("doc_id", "start", "length", "__pack_row", (F.col("base") + F.floor((F.col("rank") - F.col("first")) / F.col("each"))).cast("long").alias("sequence_id"))
    together = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "__pack_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = alone.withColumn("offset", F.lit(0).cast("long")).unionByName(shared.withColumn("offset", F.coalesce(F.sum("length").over(together), F.lit(0)).cast("long")))
    if not others:
        return placed.drop("__pack_row")
    return placed.join(rows.select("__pack_row", *others), "__pack_row").select("doc_id", "start", "length", *others, "sequence_id", "offset")


def packed_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", room: int = LENGTH) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids, packed."""
    pieces = token_pieces(docs, id_col, text_col, room)
    return pack(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"), room)
