"""Repeated 200-byte strings by a depth-limited radix sort of sampled suffixes.

Strings are compared through 200 bytes only, most significant digit first; after each pass groups of
one are dropped, and groups that are equal to the end are exactly the repeated strings.

The first digit is the CORE of a string: of its runs of CORE bytes, the one whose hash is the least
(of equal ones the first). It is found in the string alone, so equal strings have equal cores at equal
places, and neighbouring strings share theirs: a row is an anchor (a core's position) with the range
of the strings that it is the core of, fifty on average. The passes:

1. by core: anchors are dealt by it, and groups of one are dropped;
2. by hull, the bytes of all an anchor's strings (128 bits): rows with equal hulls are repeated
   throughout, and one of them stays as a partner of the others;
3. byte by byte outwards from the core, in groups that are still of several hulls: to its left and
   to its right, each pass refines the classes of equal bytes by one byte and drops classes of one.
   A string is repeated if two rows agree in its left and its right class.

Groups of very many hulls are not gathered: their strings are dealt out one by one (128 bits), and
counted. A passage of very many documents is thus counted, never paired.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize, superseded
from rigprep.llm.text import map_texts

LENGTH, CORE = 200, 100
WINDOW = LENGTH - CORE + 1
#: Texts are hashed in pieces of so many bytes (and an overlap), which bounds a task's memory.
PIECE = 1 << 20
#: Hulls of a core that are gathered in one task at most, and rows that are sorted together, about.
GROUP, ROWS = 4096, 16384

_R = np.random.default_rng(20240502)
_BYTE = _R.integers(1, 1 << 63, size=256, dtype=np.uint64)
_B = np.uint64(int(_R.integers(1, 1 << 62)) * 2 + 1)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of any substring of a text, from prefix sums of byte values times powers of an odd base."""

    _up = _down = np.ones(1, dtype=np.uint64)

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._up) <= n:
            size = 1 << max(12, (n + 1).bit_length())
            inverse = np.uint64(pow(int(_B), -1, 1 << 64))
            one = np.ones(1, dtype=np.uint64)
            cls._up = np.cumprod(np.concatenate([one, np.full(size - 1, _B)]), dtype=np.uint64)
            cls._down = np.cumprod(np.concatenate([one, np.full(size - 1, inverse)]), dtype=np.uint64)
        return cls._up, cls._down

    def __init__(self, text: bytes):
        data = np.frombuffer(text, dtype=np.uint8)
        up, self.down = self.powers(len(data))
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hashes of the substrings [start, end); the length takes part."""
        return _mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * _M1)


def _sliding(x: np.ndarray, n: int, op) -> np.ndarray:
    """``op`` over each run of n values; len(x) - n + 1 results."""
    width, out = 1, x
    while 2 * width <= n:
        out = op(out[:-width], out[width:])
        width *= 2
    return out if width == n else op(out[: len(out) - (n - width)], out[n - width :])


def anchors(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(position, core hash, lo, hi), piece by piece: the core of the strings that start lo..hi bytes before it."""
    n = len(text)
    if n < LENGTH:
        return
    margin = 2 * LENGTH
    for first in range(0, n, PIECE):
        low, high = max(0, first - margin), min(n, first + PIECE + margin)
        h = Hashes(text[low:high])
        m = high - low
        if m < LENGTH:
            continue
        at = np.arange(m - CORE + 1)
        core = h.of(at, at + CORE)
        least = _sliding(core, WINDOW, np.minimum)  # one for each string
        pad = np.zeros(WINDOW - 1, dtype=np.uint64)
        pos = np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), WINDOW, np.maximum) == core)
        own = np.zeros(m, dtype=np.int64)
        own[pos + 1] = 1
        own = np.cumsum(own)[: len(least)]  # the first anchor at or after the string's start
        wrong = np.flatnonzero(core[pos[own]] != least)
        while len(wrong):
            own[wrong] += 1
            wrong = wrong[core[pos[own[wrong]]] != least[wrong]]
        new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        last = np.concatenate([new[1:], [len(own)]]) - 1
        pos = pos[own[new]]
        inside = (pos + low >= first) & (pos + low < first + PIECE)
        yield (pos + low)[inside], core[pos[inside]], (pos - last)[inside], (pos - new)[inside]


def _key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """d and t (96 bits of id and text) stand for a document; rows that repeat both share them."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    kept = docs.select(F.col(id_col).alias("doc_id"), text)
    return kept.withColumn("d", F.xxhash64(F.col("doc_id").cast("string"), "text")).withColumn("t", F.hash("text", F.col("doc_id").cast("string")))


def _cat(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts).astype(kind) if parts else np.empty(0, dtype=kind)


def _digests(parts: list[bytes]) -> tuple[pa.Array, pa.Array]:
    both = np.frombuffer(b"".join(parts), dtype=np.int64).reshape(-1, 2)
    return pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))


def _core_rows(keyed: DataFrame) -> DataFrame:
    def start():
        def work(cols, texts):
            return {"core": pa.array(_cat([x[1] for text in texts for x in anchors(text)], np.uint64).view(np.int64))}

        return work

    return map_texts(keyed, {}, "text", start, "core long")


def _anchor_rows(keyed: DataFrame) -> DataFrame:
    """(d, t, pos, lo, hi, core, h1, h2): h1 and h2 are 128 bits of the hull's bytes and its place."""

    def start():
        import xxhash

        def work(cols, texts):
            which, pos, core, lo, hi, hulls = [], [], [], [], [], []
            for k, text in enumerate(texts):
                for p, c, a, b in anchors(text):
                    which.append(np.full(len(p), k))
                    for out, x in ((pos, p), (core, c), (lo, a), (hi, b)):
                        out.append(x)
                    hulls += [xxhash.xxh3_128_digest(text[x - z : x - y + LENGTH], seed=y << 8 | z) for x, y, z in zip(p.tolist(), a.tolist(), b.tolist(), strict=True)]
            take, (h1, h2) = pa.array(_cat(which, np.int64)), _digests(hulls)
            numbers = {"pos": pa.array(_cat(pos, np.int64)), "lo": pa.array(_cat(lo, np.int16)), "hi": pa.array(_cat(hi, np.int16)), "core": pa.array(_cat(core, np.uint64).view(np.int64))}
            return {"d": cols["d"].take(take), "t": cols["t"].take(take), **numbers, "h1": h1, "h2": h2}

        return work

    return map_texts(keyed, {"d": "d", "t": "t"}, "text", start, "d long, t int, pos long, lo short, hi short, core long, h1 long, h2 long")


def _hulls_of(texts: DataFrame, partners: DataFrame) -> DataFrame:
    """``partners`` with the bytes of their hulls."""
    lists = partners.groupBy("d", "t").agg(F.collect_list(F.struct("pos", "lo", "hi", "core", "single", "hot")).alias("parts"))
    rows = texts.where(F.octet_length("text") >= LENGTH).join(lists, ["d", "t"])

    def run(batches):
        for batch in batches:
            which, flat, hulls = [], [], []
            for k, (text, parts) in enumerate(zip(batch.column("text").to_pylist(), batch.column("parts"), strict=True)):
                part = parts.values
                pos, lo, hi = (part.field(c).to_numpy() for c in ("pos", "lo", "hi"))
                which.append(np.full(len(part), k))
                flat.append(part)
                hulls += [text[a:b] for a, b in zip((pos - hi).tolist(), (pos - lo + LENGTH).tolist(), strict=True)]
            if not which:
                continue
            take, part = pa.array(np.concatenate(which)), pa.concat_arrays(flat)
            got = {"d": batch.column("d").take(take), "t": batch.column("t").take(take)}
            yield pa.RecordBatch.from_pydict(got | {c: part.field(c) for c in ("pos", "lo", "hi", "core", "single", "hot")} | {"hull": pa.array(hulls, pa.binary())})

    return rows.select("d", "t", "parts", F.col("text").cast("binary").alias("text")).mapInArrow(run, "d long, t int, pos long, lo short, hi short, core long, single boolean, hot boolean, hull binary")


def _refined(classes: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """One radix pass: classes of equal class and digit, numbered anew; -1 for those of one row."""
    out = np.full(len(classes), -1, dtype=np.int64)
    live = np.flatnonzero(classes >= 0)
    if len(live):
        _, code, times = np.unique((classes[live] << 8) | digit[live], return_inverse=True, return_counts=True)
        out[live] = np.where(times[code] > 1, code, -1)
    return out


def repeated_starts(hulls: list[bytes], lo: np.ndarray, hi: np.ndarray, core: np.ndarray) -> np.ndarray:
    """Rows x WINDOW booleans: which string, so many bytes before the core, another row of the core also has.

    Hulls are laid out with their cores in one column; a radix pass for each byte outwards from the
    core, first of the core itself, keeps for each depth the classes of rows that agree so far.
    """
    n, side = len(hulls), LENGTH - CORE
    field = np.zeros((LENGTH + side, n), dtype=np.uint8)  # transposed: a digit is a run of memory
    for i, (hull, z) in enumerate(zip(hulls, hi.tolist(), strict=True)):
        field[side - z : side - z + len(hull), i] = np.frombuffer(hull, dtype=np.uint8)
    classes = np.unique(core, return_inverse=True)[1].astype(np.int64)
    # the core's hash has dealt it; its bytes confirm it
    bytes_ = np.ascontiguousarray(field[side:LENGTH].T).view(f"V{CORE}").ravel()
    same = np.unique(bytes_, return_inverse=True)[1].astype(np.int64)
    classes = np.unique(classes * n + same, return_inverse=True)[1].astype(np.int64)
    left, right = [classes], [classes]
    for k in range(side):
        # rows whose strings end here have nothing to add: lo and hi bound what a row asks of each side
        left.append(_refined(np.where(hi > k, left[-1], -1), field[side - 1 - k]))
        right.append(_refined(np.where(side - lo > k, right[-1], -1), field[LENGTH + k]))
    found = np.zeros((n, WINDOW), dtype=bool)
    for a in range(WINDOW):
        x, y = left[a], right[side - a]
        live = np.flatnonzero((x >= 0) & (y >= 0) & (lo <= a) & (a <= hi))
        if len(live):
            _, code, times = np.unique(x[live] * n + y[live], return_inverse=True, return_counts=True)
            found[live, a] = times[code] > 1
    return found


SPANS = "d long, t int, start long, end long"


def _gathered(rows: DataFrame) -> DataFrame:
    """Repeated strings of rows of bounded groups: rows are dealt and sorted by core, and some ROWS are taken at a time."""

    def work(table: pa.Table) -> pa.RecordBatch:
        lo, hi, core, pos = (table.column(c).to_numpy().astype(np.int64) for c in ("lo", "hi", "core", "pos"))
        found = repeated_starts(table.column("hull").to_pylist(), lo, hi, core) & table.column("single").to_numpy(zero_copy_only=False)[:, None]
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        _, after = np.nonzero(edge == -1)
        take = pa.array(row)
        return pa.RecordBatch.from_pydict({"d": table.column("d").take(take).combine_chunks(), "t": table.column("t").take(take).combine_chunks(), "start": pa.array(pos[row] - after + 1), "end": pa.array(pos[row] - first + LENGTH)})

    def run(batches):
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            core = batch.column("core").to_numpy()
            held.append(pa.Table.from_batches([batch]))
            if sum(x.num_rows for x in held) >= ROWS and core[0] != core[-1]:
                cut = int(np.flatnonzero(core != core[-1])[-1]) + 1  # whole groups only
                rest = held[-1].slice(cut)
                held[-1] = held[-1].slice(0, cut)
                yield work(pa.concat_tables(held))
                held = [rest]
        if held:
            yield work(pa.concat_tables(held))

    return rows.repartition("core").sortWithinPartitions("core").select("d", "t", "pos", "lo", "hi", "core", "single", "hull").mapInArrow(run, SPANS)


def _dealt(rows: DataFrame) -> DataFrame:
    """Repeated strings of groups that are too large to gather: every string is a row, counted by 128 bits."""

    def run(batches):
        import xxhash

        for batch in batches:
            which, start, digests = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("hull", "pos", "lo", "hi")]
            for k, (hull, pos, lo, hi) in enumerate(zip(*columns, strict=True)):
                for a in range(lo, hi + 1):
                    which.append(k)
                    start.append(pos - a)
                    digests.append(xxhash.xxh3_128_digest(hull[hi - a : hi - a + LENGTH]))
            take, (h1, h2) = pa.array(which, pa.int64()), _digests(digests)
            yield pa.RecordBatch.from_pydict({"d": batch.column("d").take(take), "t": batch.column("t").take(take), "start": pa.array(start, pa.int64()), "single": batch.column("single").take(take), "h1": h1, "h2": h2})

    strings = materialize(rows.mapInArrow(run, "d long, t int, start long, single boolean, h1 long, h2 long"), "strings")
    again = materialize(strings.groupBy("h1", "h2").count().where("count > 1").select("h1", "h2"), "again")
    return strings.where("single").join(again, ["h1", "h2"]).select("d", "t", "start", (F.col("start") + LENGTH).alias("end"))


def covered_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, t, start, end): stretches of bytes, which may overlap, that repeated strings cover."""
    keyed = _key(docs, id_col, text_col)
    cores = materialize(_core_rows(keyed).groupBy("core").count().where("count > 1").select("core"), "cores")
    rows = materialize(_anchor_rows(keyed).join(cores, "core"), "anchors")
    superseded(cores)
    # counts are combined in each task, so a hull of very many rows is a few records
    hulls = rows.groupBy("core", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("d", "t", "pos", "lo", "hi")).alias("one"))
    hulls = materialize(hulls, "hulls")
    several = hulls.groupBy("core").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).where("k > 1 and least = 1").select("core", (F.col("k") > GROUP).alias("hot"))
    partners = materialize(hulls.join(several, "core").select("core", "one.*", (F.col("n") == 1).alias("single"), "hot"), "partners")
    covered = rows.join(hulls.where("n > 1").select("core", "h1", "h2"), ["core", "h1", "h2"])
    covered = materialize(covered.select("d", "t", (F.col("pos") - F.col("hi")).alias("start"), (F.col("pos") - F.col("lo") + LENGTH).alias("end")), "covered")
    superseded(rows, hulls)
    known = materialize(_hulls_of(keyed.select("d", "t", "text"), partners), "partner_hulls")
    superseded(partners)
    out = covered.unionByName(materialize(_gathered(known.where("not hot")), "gathered"))
    if known.where("hot").limit(1).count():
        out = out.unionByName(materialize(_dealt(known.where("hot")), "dealt"))
    superseded(known)
    return out


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, t, n_removed, spans): the maximal runs of covered bytes of each document that has any."""
    lists = covered_bytes(docs, id_col, text_col).groupBy("d", "t").agg(F.collect_set(F.struct("start", "end")).alias("parts"))

    def run(batches):
        for batch in batches:
            removed, spans = [], []
            for parts in batch.column("parts"):
                start, end = (x.to_numpy() for x in parts.values.flatten())
                order = np.argsort(start, kind="stable")
                start, end = start[order], np.maximum.accumulate(end[order])
                new = np.concatenate([[True], start[1:] > end[:-1]])
                starts, ends = start[new], end[np.concatenate([new[1:], [True]])]
                removed.append(int((ends - starts).sum()))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(starts, ends, strict=True)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_pydict({"d": batch.column("d"), "t": batch.column("t"), "n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, kind)})

    return materialize(lists.mapInArrow(run, "d long, t int, n_removed long, spans array<struct<start:long,end:long>>"), "spans")


def cut_spans(texts: DataFrame) -> DataFrame:
    """``texts`` (d, t, text, spans) as (d, t, kept): the bytes outside the spans, concatenated."""

    def run(batches):
        for batch in batches:
            kept = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                at, out = 0, []
                for s in spans:
                    out.append(text[at : s["start"]])
                    at = s["end"]
                kept.append(b"".join([*out, text[at:]]))
            yield pa.RecordBatch.from_pydict({"d": batch.column("d"), "t": batch.column("t"), "kept": pa.array(kept, pa.binary())})

    return texts.select("d", "t", F.col("text").cast("binary").alias("text"), "spans").mapInArrow(run, "d long, t int, kept binary")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Texts are UTF-8 bytes; a null text is empty. Every byte is removed that a 200-byte string covers
    which also starts elsewhere, in the same document or another; strings are judged on the input.
    Texts under 200 bytes lose nothing. Rows that repeat a text lose all of it if it has 200 bytes.
    Ids may be of any type, null or repeated. An empty table gives an empty table.
    """
    keyed = _key(docs, id_col, text_col)
    facts = materialize(keyed.select("doc_id", "d", "t", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "facts")
    spans = repeated_spans(docs, id_col, text_col)
    found = materialize(facts.join(spans, ["d", "t"], "left"), "found")
    part = found.where("n_removed < n_bytes").select("d", "t", "spans").dropDuplicates(["d", "t"])
    texts = keyed.select("d", "t", "text").join(materialize(part, "part"), ["d", "t"])
    kept = materialize(cut_spans(texts).select("d", "t", F.sha2("kept", 256).alias("cut_sha")).dropDuplicates(["d", "t"]), "kept")
    sha = F.when(F.col("n_removed").isNull(), F.col("sha")).when(F.col("n_removed") == F.col("n_bytes"), F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("cut_sha"))
    return found.join(kept, ["d", "t"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), sha.alias("kept_sha256"), "spans"
    )
