"""Near duplicates by SetSketch: mergeable registers, banding, joint likelihood, exact check.

A document's set is its distinct 5-word shingles. Each register holds an exponentially spaced,
truncated minimum over the set: floor(1 - log_B(x)) of the least exponential variate x. Registers
of a union are the maxima of the registers. Equal registers in a band put two sets in one bucket.
A bucket never yields all its pairs: its members are compared with one hub. Pairs whose Jaccard
similarity cannot be near the threshold, by the likelihood of their registers, are dropped; the
rest are checked on the full sets. Sets of a bucket that are still in different components after
some hubs, and whose shingles are shared widely enough to allow a link, are dealt into blocks. A
tile holds two blocks, gets all their intersections from one matrix product, and returns no more
links than join its components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigprep.functions.graph import connected_components
from rigprep.functions.shared import materialize
from rigprep.llm.exact_dedup import possibly_among
from rigprep.llm.text import give_back, keeps, map_texts, text_hash, without_rows

WORDS = 5
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: 32 bands of 4 registers: a pair at the threshold shares no band with probability below 1e-5.
REGISTERS, BAND = 128, 4
BAND_BITS = (REGISTERS // BAND - 1).bit_length()
#: Base of the register spacing. Near 1, a register agrees about as often as the sets' similarity.
BASE = 1.01
#: A pair is checked if its likeliest similarity is at least this: 5 standard errors below 0.75.
LEAST_ESTIMATE = 0.55
#: Members of a bucket that are compared with one copy of the hub's text.
BLOCK = 256
#: Shingles, about, of the sets that are compared with one hub's, or that make a block of a tile.
BLOCK_SHINGLES = 1 << 20
#: Columns of the matrices of a tile that are multiplied at a time.
COLUMNS = 1 << 12
#: Words whose hashes a Python worker remembers.
CACHE_WORDS = 100_000
#: A family is compared as a whole if that sends out at most so many times the sets that its buckets do.
FAMILY_COST = 1.0
#: Rounds of comparing with hubs, and hubs of a bucket in each round but the first, which has one.
HUB_ROUNDS, HUBS = 2, 2
PEELS = 2

_ODD = np.random.default_rng(20240501).integers(1, 1 << 63, size=(2, REGISTERS), dtype=np.uint64) | np.uint64(1)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE_WORDS:
            self[word] = h
        return h


@lru_cache(maxsize=1)
def word_hashes() -> _WordHashes:
    """One for each Python worker; bounded, as other words are hashed anew."""
    return _WordHashes()


def shingles(text: bytes, n: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct n-word shingles; A-Z is lower-cased.

    Fewer words make one shingle of the whole sequence; no words, no shingles.
    """
    words = text.lower().split()  # of bytes: touches A-Z only, and splits at ASCII white space
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(word_hashes().__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, np.uint64(k), dtype=np.uint64)
    for i in range(k):
        out = _mix(out * _M2 + h[i : len(h) - k + 1 + i])
    return np.unique(out)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set, as unsigned 16-bit registers; 0 for the empty set."""
    if not len(hashes):
        return np.zeros(REGISTERS, dtype=np.uint16)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):
        part = hashes[at : at + 2048, None]
        least = np.minimum(least, (((part ^ (part >> np.uint64(31))) + _ODD[1]) * _ODD[0]).min(axis=0))
    x = -np.log1p(-(least.astype(np.float64) + 1) / 2.0**64 * (1 - 2.0**-53))
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 65535).astype(np.uint16)


def likeliest_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Joint maximum likelihood of the Jaccard similarity, from which registers are larger or equal."""
    up, down = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - up - down
    u = na / (na + nb)
    v = 1 - u

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1 - 1e-12) * (BASE - 1) / BASE) / np.log(BASE)

    def score(j):
        pu, pv = p(u - v * j), p(v - u * j)
        return up * np.log(pu) + down * np.log(pv) + same * np.log(np.clip(1 - pu - pv, 1e-12, 1))

    low, high = np.zeros(len(a)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood is concave enough for a ternary search
        m1, m2 = low + (high - low) / 3, high - (high - low) / 3
        rise = score(m1) < score(m2)
        low, high = np.where(rise, m1, low), np.where(rise, high, m2)
    return (low + high) / 2


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_key, registers); set_key is equal exactly for equal sets (128 bits)."""

    def start():
        import xxhash

        keeps("shingles", word_hashes.cache_clear)

        def work(cols, texts):
            n, key, regs = [], [], []
            for text in texts:
                s = shingles(text)
                n.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.tobytes()))
                regs.append(registers(s).tobytes())
            return {**cols, "n_shingles": pa.array(n, pa.int64()), "set_key": pa.array(key, pa.binary()), "registers": pa.array(regs, pa.binary())}

        return work

    given = docs.select(F.col(id_col).alias("doc_id"), text_hash(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return map_texts(given, {"doc_id": "doc_id", "text_hash": "text_hash"}, "text", start, f"doc_id {dict(docs.dtypes)[id_col]}, text_hash long, n_shingles long, set_key binary, registers binary", give_back)


def buckets(classes: DataFrame) -> DataFrame:
    """(bucket, rep, hub) for each band; buckets of one set are left out. The last bits of a bucket are its band, its hub is the smallest rep."""
    bands = F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)), lambda i: F.shiftleft(F.xxhash64(F.substring(F.col("registers"), i * (2 * BAND) + 1, F.lit(2 * BAND))), BAND_BITS).bitwiseOR(i.cast("long")))
    rows = classes.select("rep", F.explode(bands).alias("bucket"))
    several = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("hub")).where("size > 1").select("bucket", "hub")
    return rows.join(materialize(several, "buckets"), "bucket").select("bucket", "rep", "hub")


def _to_hubs(here: DataFrame, step: int) -> DataFrame:
    """Pairs (a, b) of a hub and a set of its bucket in ``here`` (bucket, rep, label) whose labels differ; hubs are taken by chance."""
    first = [F.min(F.struct(F.xxhash64("rep", F.lit(HUBS * step + i)).alias("rank"), "rep", "label")) for i in range(HUBS)]
    mixed = here.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.array(*first).alias("hubs"))
    hubs = materialize(mixed.where("low < high").select("bucket", "hubs"), "bucket_hubs")
    pairs = here.join(hubs, "bucket").select("rep", "label", F.col("hubs")[0]["rep"].alias("before"), F.posexplode("hubs").alias("place", "hub"))
    # two hubs of a bucket are one pair, not two
    return pairs.where("label <> hub.label and (place = 0 or rep <> before)").select(F.col("hub.rep").alias("a"), F.col("rep").alias("b"))


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b, nb) whose sizes allow the threshold and whose likeliest similarity is near it."""
    kind, side = dict(pairs.dtypes)["a"], classes.select("rep", "n", "registers")
    both = pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b").where(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)")

    def estimate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            if len(x):
                ra, rb = (np.frombuffer(b"".join(x[c]), dtype=np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
                j = likeliest_similarity(ra, rb, x.na.to_numpy(float), x.nb.to_numpy(float))
                x = x[j >= LEAST_ESTIMATE]
            yield x[["a", "b", "nb"]]
        give_back()

    return both.mapInPandas(estimate, f"a {kind}, b {kind}, nb long")


def _n_blocks(n: str) -> Column:
    """Blocks that hold BLOCK sets and BLOCK_SHINGLES shingles, about, of a group's sets of size ``n``."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(n) / BLOCK_SHINGLES), F.lit(1)).cast("int").alias("blocks")


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, by their full sets.

    ``a`` is the hub. Its text goes once with each block of its partners, so a hub of very many
    partners is many small groups; both sides of the join are written tables, so AQE can split it.
    """
    kind = dict(pairs.dtypes)["a"]
    counted = pairs.groupBy("a").agg(_n_blocks("nb"))
    counted = materialize(counted, "hubs")
    mates = pairs.join(counted, "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), F.col("b").alias("id"))
    hubs = counted.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("a").alias("id"))
    wanted = materialize(mates.unionByName(hubs), "wanted")
    rows = wanted.join(texts.select(F.col("rep").alias("id"), "text"), "id")

    def check(x: pd.DataFrame) -> pd.DataFrame:
        hub = x["a"].iloc[0]
        ids, sets = x["id"].tolist(), None
        for i, t in zip(ids, x["text"], strict=True):
            if i == hub:
                sets = shingles(bytes(t))
                break
        out = []
        for i, t in zip(ids, x["text"], strict=True):
            if i != hub:
                other = shingles(bytes(t))
                inter = len(np.intersect1d(sets, other, assume_unique=True))
                if 100 * inter >= PERCENT * (len(sets) + len(other) - inter):
                    out.append(i)
        return pd.DataFrame({"a": pd.Series([hub] * len(out), dtype=x["a"].dtype), "b": pd.Series(out, dtype=x["a"].dtype)})

    return rows.select("a", "block", "id", "text").groupBy("a", "block").applyInPandas(check, f"a {kind}, b {kind}")


def _sets(reps: DataFrame, texts: DataFrame) -> DataFrame:
    """(rep, n, shingles) of the wanted sets."""

    def start():
        def work(cols, batch):
            rows = [shingles(t) for t in batch]
            size = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
            values = np.concatenate(rows).view(np.int64) if rows else np.empty(0, dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(values))
            return {"rep": cols["rep"], "n": pa.array(size), "shingles": lists}

        return work

    return materialize(map_texts(texts.join(reps, "rep", "left_semi"), {"rep": "rep"}, "text", start, f"rep {dict(texts.dtypes)['rep']}, n long, shingles array<long>", give_back), "sets")


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with the sets ``right``, by products of 0/1 matrices."""
    size = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    known, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    several = (times > 1)[code]
    owner, code = owner[several], (np.cumsum(times > 1) - 1)[code[several]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    out = np.zeros((len(left), len(right)))
    for first in range(0, int(code[-1]) + 1 if len(code) else 0, COLUMNS):
        low, high = np.searchsorted(code, (first, first + COLUMNS))
        has = np.zeros((len(sets), min(COLUMNS, int(code[-1]) + 1 - first)), dtype=np.float32)
        has[owner[low:high], code[low:high] - first] = 1
        out += has[left] @ has[right].T
    return out.astype(np.int64)


def _forest(labels: np.ndarray, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Those of the pairs of places that join labels which earlier ones have not joined."""
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in pairs.tolist():
        a, b = find(labels[i]), find(labels[j])
        if a != b:
            root[b] = a
            out.append((i, j))
    return out


def tile_links(bucket: int | None, left: np.ndarray, right: np.ndarray, label: np.ndarray, n: np.ndarray, share: np.ndarray, regs: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (i, j) between the sets ``left`` and ``right`` of a bucket (or family: null) that join different labels.

    In buckets a pair belongs to the first band that it has in common, so that one tile of its up to 32 looks at it.
    """
    most = np.minimum(share[left][:, None], share[right])
    open_ = (label[left][:, None] != label[right]) & (100 * most >= PERCENT * (n[left][:, None] + n[right] - most))
    if bucket is not None:
        values = np.ascontiguousarray(regs).view(np.uint64)  # one for each band of four 16-bit registers
        for k in range(bucket & ((1 << BAND_BITS) - 1)):
            open_ &= values[left, k][:, None] != values[right, k]
    rows, columns = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
    if not len(rows):
        return []
    left, right, open_ = left[rows], right[columns], open_[np.ix_(rows, columns)]
    used = np.unique(np.concatenate([left, right]))
    inter = intersections([sets[i] for i in used], np.searchsorted(used, left), np.searchsorted(used, right))
    linked = np.argwhere(open_ & (100 * inter >= PERCENT * (n[left][:, None] + n[right] - inter)))
    return _forest(label, np.stack([left[linked[:, 0]], right[linked[:, 1]]], axis=1))


def _cells(here: DataFrame) -> DataFrame:
    """(family, bucket, blocks, rep, label, n, share): the groups whose sets are compared with each other.

    Sets that buckets connect are a family. A family is compared as a whole (bucket is null) or bucket by bucket,
    whichever sends its sets to fewer tiles: families of one origin are in many buckets together, while
    large families that chance buckets connect are best left in their buckets. Both look at every pair.
    """
    by_bucket = here.groupBy("bucket").agg(F.min("rep").alias("first"), _n_blocks("n"), F.count(F.lit(1)).alias("size"))
    by_bucket = materialize(by_bucket, "bucket_blocks")
    # a set is connected with the first sets of its buckets
    star = here.select("bucket", "rep").join(by_bucket.select("bucket", "first"), "bucket")
    family = materialize(connected_components(star, "rep", "first").toDF("rep", "family"), "families")
    once = materialize(here.select("rep", "label", "n", "share").distinct().join(family, "rep"), "family_sets")
    by_bucket = by_bucket.join(family.toDF("first", "family"), "first").select("family", "bucket", "blocks", "size")
    by_bucket = materialize(by_bucket, "family_buckets")
    by_family = once.groupBy("family").agg(_n_blocks("n"), F.count(F.lit(1)).alias("size"))
    cost = by_bucket.groupBy("family").agg(F.sum(F.col("size") * F.col("blocks")).alias("split"))
    whole = materialize(by_family.join(cost, "family").where(F.col("size") * F.col("blocks") <= FAMILY_COST * F.col("split")).select("family", "blocks"), "whole")
    apart = by_bucket.join(whole, "family", "left_anti").select("family", "bucket", "blocks")
    columns = ["family", "bucket", "blocks", "rep", "label", "n", "share"]
    return once.join(whole, "family").withColumn("bucket", F.lit(None).cast("long")).select(*columns).unionByName(here.join(apart, "bucket").select(*columns))


def _tiled(here: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) that join the components of ``here`` (bucket, rep, label, n, share) as all links of a bucket would.

    A group's sets are dealt into blocks by a hash, and each two blocks (and each alone) are one tile of
    bounded size. No row is a pair: a set goes to as many tiles as its group has blocks.
    """
    kind = dict(here.dtypes)["rep"]
    dealt = _cells(here).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = materialize(dealt.select("family", "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "label", "n", "share"), "tiles")
    rows = dealt.join(classes.select("rep", "registers"), "rep").join(sets.select("rep", "shingles"), "rep")

    def work(x: pd.DataFrame) -> pd.DataFrame:
        i, j, block, bucket = int(x["i"].iloc[0]), int(x["j"].iloc[0]), x["block"].to_numpy(), x["bucket"].iloc[0]
        regs = np.frombuffer(b"".join(x["registers"]), dtype=np.uint16).reshape(-1, REGISTERS)
        label, n, share = (x[c].to_numpy() for c in ("label", "n", "share"))
        band = None if bucket is None else int.from_bytes(bucket, "big")
        got = tile_links(band, np.flatnonzero(block == i), np.flatnonzero(block == j), label, n, share, regs, list(map(np.asarray, x["shingles"])))
        rep = x["rep"]
        return pd.DataFrame({"a": rep.iloc[[p for p, _ in got]].to_numpy(), "b": rep.iloc[[q for _, q in got]].to_numpy()})

    band = F.when(F.col("bucket").isNotNull(), F.unhex(F.hex(F.col("bucket").bitwiseAND((1 << BAND_BITS) - 1))))  # binary: pandas would turn a nullable number into a float
    return rows.select("family", F.col("bucket").alias("cell"), band.alias("bucket"), "i", "j", "block", "rep", "label", "n", "share", "registers", "shingles").groupBy("family", "cell", "i", "j").applyInPandas(work, f"a {kind}, b {kind}")


def _peeled(here: DataFrame, sets: DataFrame) -> DataFrame:
    """``here`` (bucket, rep, label) with n and share, without sets that cannot have a link left.

    share is how many of a set's shingles any other of these sets has. Two sets have at most the
    lesser share in common, so a set with a share under the threshold has no partner and leaves,
    as does a bucket with one component; others' shares then fall, and the count is made again.
    This exact bound parts sets that share a passage, or that stem from one text and were each
    changed too much.
    """
    for _ in range(PEELS):
        known = sets.join(here.select("rep").distinct(), "rep", "left_semi")
        lone = known.select("rep", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("k"), F.min("rep").alias("rep")).where("k = 1").groupBy("rep").count()
        share = F.col("n") - F.coalesce("count", F.lit(0))
        able = materialize(known.select("rep", "n").join(lone, "rep", "left").select("rep", "n", share.alias("share")).where(f"100 * share >= {PERCENT} * n"), "able")
        here = materialize(here.select("bucket", "rep", "label").join(able, "rep"), "able_members")
        mixed = materialize(here.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("bucket"), "mixed")
        here = materialize(here.join(mixed, "bucket"), "peeled")
    return here


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept, text_hash.

    component_id is the smallest doc_id that links reach. Documents with equal sets are one class
    and take part once, under the number of one of its rows, so ids may be of any type and repeated: rows of
    one id with different texts are different documents. Null and empty texts, and those without words,
    have no shingles and are linked with nothing. A null id is its own component and is kept. text_hash
    tells rows of one id apart. Other columns are not looked at; an empty table gives an empty table.
    """
    sketched = materialize(sketches(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "sketches")
    live = sketched.where("n_shingles > 0 and doc_id is not null")
    classes = live.groupBy("set_key").agg(F.min("row").alias("rep"), F.min("doc_id").alias("least_id"), F.max("n_shingles").alias("n"), F.first("registers").alias("registers"))
    classes = materialize(classes, "classes")
    rows = materialize(buckets(classes), "members")
    near = materialize(rows.select("rep").distinct(), "near")
    wanted = materialize(live.select("row", "doc_id", "text_hash").join(near, live.row == near.rep).select("rep", "doc_id", "text_hash"), "near_rows")
    texts = docs.select(F.col(id_col).alias("doc_id"), text_hash(text_col).alias("text_hash"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    keys = ["doc_id", "text_hash"]
    texts = materialize(possibly_among(texts, wanted, keys).join(wanted, keys).select("rep", "text"), "texts")
    near_classes = materialize(classes.join(near, "rep", "left_semi"), "near_classes")

    labels, here = near.select("rep", F.col("rep").alias("label")), rows.select("bucket", "rep", F.col("rep").alias("label"))
    tried = None
    for step in range(HUB_ROUNDS + 1):
        if step < HUB_ROUNDS:  # hubs for each bucket: first the smallest id, then some by chance
            pairs = (rows.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")) if step == 0 else _to_hubs(here, step)).distinct()
            if tried is not None:
                pairs = pairs.join(tried.unionByName(tried.toDF("b", "a")), ["a", "b"], "left_anti")
            pairs = materialize(_estimated(pairs, near_classes), "pairs")
            found = materialize(_linked(pairs, texts), "links")
            pairs = pairs.select("a", "b")
            tried = pairs if tried is None else tried.unionByName(pairs)
        else:  # what is left: sets of one bucket that are still in different components
            mixed = here.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("bucket")
            mixed = materialize(mixed, "mixed")
            if mixed.limit(1).count() == 0:
                break
            here = materialize(here.join(mixed, "bucket"), "mixed_members")
            sets = _sets(here.select("rep").distinct(), texts)
            found = materialize(_tiled(_peeled(here, sets), sets, near_classes), "links")
        if found.limit(1).count():  # components of before are the nodes now, so only new links are gone through
            joins = found.join(labels.toDF("a", "la"), "a").join(labels.toDF("b", "lb"), "b")
            joined = materialize(connected_components(joins, "la", "lb").toDF("label", "component"), "joined")
            labels = materialize(labels.join(joined, "label", "left").select("rep", F.coalesce("component", "label").alias("label")), "labels")
            if step < HUB_ROUNDS:
                here = materialize(rows.select("bucket", "rep").join(labels, "rep"), "labelled_members")

    named = labels.join(classes.select("rep", "least_id"), "rep")
    named = materialize(named, "named")
    least = materialize(named.groupBy("label").agg(F.min("least_id").alias("component_id")), "least")
    named = named.join(least, "label").select("rep", "component_id")
    members = materialize(classes.join(named, "rep", "left").select("set_key", F.coalesce("component_id", "least_id").alias("component_id")), "components")
    own = live.join(members, "set_key").select("doc_id", "n_shingles", "component_id", "text_hash")
    alone = sketched.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_hash")
    out = own.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", "kept", "text_hash")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; all columns stay.

    A row goes by its id and text together: other texts of the same id stay. Of rows that repeat an id and its text one
    stays, which one is not promised. Null ids are linked with nothing: each of their texts stays, in one row.
    """
    found = materialize(near_components(docs, id_col, text_col).groupBy("doc_id", "text_hash", "kept").count(), "near")
    gone, twice = (materialize(found.where(x).select("doc_id", "text_hash"), "gone") for x in ("not kept", "kept and count > 1"))
    return without_rows(docs, id_col, text_col, gone, twice)
