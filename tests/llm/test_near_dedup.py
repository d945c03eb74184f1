from collections import defaultdict

import numpy as np
import pytest

from rigprep.functions import graph
from rigprep.functions.shared import materialize
from rigprep.llm import near_dedup

from .docs import documents


def brute(rows):
    """Components by an inverted index over exact shingles."""
    sets, ids = {}, []
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        k = min(5, len(words))
        sets[doc] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()
        ids.append(doc)
    where = defaultdict(list)
    for doc, s in sets.items():
        for x in s:
            where[x].append(doc)
    shared = defaultdict(int)
    for docs in where.values():
        for i, a in enumerate(docs):
            for b in docs[i + 1 :]:
                shared[a, b] += 1
    up = {d: d for d in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return {(d, len(sets[d]), root(d), root(d) == d) for d in ids}


def drifting(n, seed, words=60, chain=1):
    """Copies with a few words changed: of one text (chain=0) or each of the one before."""
    r = np.random.default_rng(seed)
    text = [f"w{x}" for x in r.integers(0, 10**6, words)]
    out = []
    for _ in range(n):
        changed = list(text)
        for at in r.integers(0, words, 2):
            changed[at] = f"n{r.integers(0, 10**6)}"
        out.append(" ".join(changed))
        if chain:
            text = changed
    return out


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE  two"), (6, "one two three four five"), (7, "é two"), (8, "É two"), (9, "one two")]


@pytest.mark.parametrize("extra", [False, True])
def test_edges(spark, extra):
    got = {tuple(r) for r in near_dedup.near_components(documents(spark, EDGES, extra)).drop("text_hash").collect()}
    assert got == brute(EDGES)


def test_chains_stars_and_hot_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    texts = drifting(40, 1, chain=1) + drifting(60, 2, chain=0) + drifting(30, 3, words=25, chain=0) + ["the very same text in many rows here"] * 40 + drifting(1, 4, words=3000)
    rows = [(int(i), t) for i, t in zip(np.random.default_rng(5).permutation(len(texts)), texts, strict=True)]
    got = {tuple(r) for r in near_dedup.near_components(documents(spark, rows)).drop("text_hash").collect()}
    assert got == brute(rows)


def test_few_tables_are_written(spark, monkeypatch):
    written = []
    for module in (near_dedup, graph):
        monkeypatch.setattr(module, "materialize", lambda df, name: (written.append(name), materialize(df, name))[1])
    texts = drifting(300, 1, chain=1) + drifting(500, 2, words=25, chain=0) + family(60, 9)
    rows = [(int(i), t) for i, t in zip(np.random.default_rng(5).permutation(len(texts)), texts, strict=True)]
    assert {tuple(r) for r in near_dedup.near_components(documents(spark, rows)).drop("text_hash").collect()} == by_matrix(rows)[0]
    assert len(written) <= 100


def test_empty_table_and_repeated_ids(spark):
    assert near_dedup.near_components(documents(spark, [])).count() == 0
    rows = near_dedup.near_components(documents(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f")])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in rows) == [(0, 0, True), (1, 1, True), (1, 1, True)]


def test_the_sketch_merges_and_estimates():
    r = np.random.default_rng(0)
    u = r.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = np.unique(u[:2000]), np.unique(u[500:2500])
    ra, rb = near_dedup.registers(a), near_dedup.registers(b)
    assert (np.maximum(ra, rb) == near_dedup.registers(np.union1d(a, b))).all()
    j = near_dedup.likeliest_similarity(ra[None], rb[None], np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(j - 0.6) < 0.15


def test_the_smallest_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {tuple(r) for r in near_dedup.near_components(docs).drop("text_hash").collect()} == brute(rows)


def family(n, seed, words=170):
    """Texts that stem from one by four changed words each, 0.6 to 0.75 alike; every tenth is linked to the one before."""
    r = np.random.default_rng(seed)
    text = [f"w{x}" for x in r.integers(0, 10**6, words)]
    out, spots = [], None
    for i in range(n):
        if i % 10 or spots is None:
            spots = 5 + 40 * np.arange(4) + r.integers(0, 36, 4)
        changed = list(text)
        for at in spots:
            changed[at] = f"v{i}x{at}"
        out.append(" ".join(changed))
    return out


def by_matrix(rows):
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (t.split() for _, t in rows)]
    number = {x: k for k, x in enumerate(set().union(*sets))}
    has = np.zeros((len(rows), len(number)), dtype=np.float32)
    for i, s in enumerate(sets):
        has[i, [number[x] for x in s]] = 1
    inter = (has @ has.T).astype(int)
    n = np.array(list(map(len, sets)))
    alike = inter / (n[:, None] + n - inter)
    linked = 100 * inter >= 75 * (n[:, None] + n - inter)
    best = np.array([d for d, _ in rows])
    while ((new := np.where(linked, best, best.max()).min(axis=1)) != best).any():
        best = new
    return {(d, int(k), int(c), d == c) for (d, _), k, c in zip(rows, n, best, strict=True)}, alike


def test_a_family_below_the_threshold_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 128)
    texts = family(1100, 6)
    rows = [(int(i), t) for i, t in zip(np.random.default_rng(7).permutation(len(texts)), texts, strict=True)]
    wanted, alike = by_matrix(rows)
    assert (((alike > 0.6) & (alike < 0.75)).sum(axis=1) > 500).sum() >= 1000
    assert 10 < len({c for *_, c, _ in wanted}) < 1100
    assert {tuple(r) for r in near_dedup.near_components(documents(spark, rows)).drop("text_hash").collect()} == wanted


@pytest.mark.parametrize("cost", [0, 1])
def test_text_ids_and_large_sets_of_one_bucket(spark, monkeypatch, cost):
    monkeypatch.setattr(near_dedup, "FAMILY_COST", cost)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(near_dedup, "COLUMNS", 64)
    monkeypatch.setattr(near_dedup, "HUB_ROUNDS", 0)
    rows = [(10 + i, t) for i, t in enumerate(drifting(30, 8, chain=1) + family(60, 9))]
    docs = documents(spark, rows)
    wanted = {(str(a), n, str(b), k) for a, n, b, k in brute(rows)}
    assert {tuple(r) for r in near_dedup.near_components(docs.withColumn("doc_id", docs.doc_id.cast("string"))).drop("text_hash").collect()} == wanted


def test_rows_of_one_id_or_none_are_dropped_by_their_texts(spark):
    long = "a b c d e f g h i j k l m n o p q r s t"
    rows = [(3, long), (5, long + " u"), (5, "quite another text of several words"), (None, long), (None, "no id at all"), (7, "no id at all"), (5, None)]
    got = near_dedup.drop_near_duplicates(documents(spark, rows, True))
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == sorted((d or 0, t or "") for d, t in rows if t != long + " u")
    assert near_dedup.drop_near_duplicates(documents(spark, [])).count() == 0
