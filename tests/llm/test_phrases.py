"""Collocations, spelling variants and decontamination against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from rigprep.llm import collocations, decontaminate, queries, variants
from tests.llm.docs import documents

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_collocations", "op13_decontamination"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    want = con.sql(queries.oracle_sql()[name]).select(*df.columns).fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr) and want


# --- collocations ---------------------------------------------------------------------------


def brute_collocations(rows, least, longest):
    counts = Counter()
    for text, lang in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            for k in range(1, longest + 1):
                counts.update((lang or "und", tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    n = Counter()
    for (lang, g), c in counts.items():
        if len(g) == 1:
            n[lang] += c
    some = {g: c for g, c in counts.items() if len(g[1]) > 1 and c >= least}
    part = defaultdict(int)
    for (lang, g), c in some.items():
        for i in range(len(g)):
            for j in range(i + 1, len(g) + 1):
                if j - i < len(g):
                    part[lang, g[i:j]] = max(part[lang, g[i:j]], c)
    out = []
    for (lang, g), a in some.items():
        if 100 * part[lang, g] >= 50 * a:
            continue
        score, _, left, r = min((10**6 * a * a // (counts[lang, g[:k]] * counts[lang, g[k:]]), k, counts[lang, g[:k]], counts[lang, g[k:]]) for k in range(1, len(g)))
        out.append((lang, " ".join(g), a, left, r, n[lang], score))
    return sorted(out)


def made_texts(seed, docs):
    rng = random.Random(seed)
    words = ["a", "b", "c", "dd", "É", "Ab", "ab", "\x1c", " x"]
    gaps = [" ", " ", " ", "\t", "  ", ". ", "\n", "!"]
    return [("".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(40))), rng.choice(["en", "fr", None])) for _ in range(docs)]


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_equal_brute_force(spark, longest, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 64)
    rows = [*made_texts(longest, 300), ("", "en"), (None, "en"), ("x " * 30, "it"), ("x " * 30, "it")]
    docs = documents(spark, [(k, t, lang, "s") for k, (t, lang) in enumerate(rows)], extra=True)
    got = collocations.collocations(docs, min_count=3, max_words=longest)
    assert sorted(map(tuple, got.select("lang", "phrase", "a", "l", "r", "n", "score").collect())) == brute_collocations(rows, 3, longest)


def test_ranges_may_end_anywhere(spark):
    rows = made_texts(9, 300)
    docs = documents(spark, [(k, t, lang, "s") for k, (t, lang) in enumerate(rows)])
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = collocations.collocations(docs, min_count=2, max_words=3).select("lang", "phrase", "a", "l", "r", "n", "score").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, got)) == brute_collocations(rows, 2, 3)


def test_long_texts_are_counted_by_chunks_and_filters_only_err_upwards(spark):
    text = b"a bb. c a bb " * 2000 + b"long" * 3000 + b" a bb"
    for size in (7, 50, 10**6):
        got = Counter()
        for k in (1, 2):
            for phrases, n in _counted(text, k, size):
                got.update(dict(zip(phrases, n.tolist(), strict=True)))
        assert got[b"a bb"] == 4001 and got[b"c a"] == 2000 and got[b"bb c"] == 0 and got[b"a"] == 4001
    assert len(b"".join(collocations.chunks(text, 10))) == len(text)


def _counted(text, words, size):
    import numpy as np

    full = [np.full(8, 255, dtype=np.uint8)] * (words - 1)
    cut = collocations.chunks
    collocations.chunks = lambda t: cut(t, size)
    try:
        yield from collocations.phrase_counts(text, b"en", words, full)
    finally:
        collocations.chunks = cut


def test_collocations_of_nothing_and_top(spark):
    assert collocations.collocations(documents(spark, [])).count() == 0
    assert collocations.collocations(documents(spark, [(1, None), (2, "")])).count() == 0
    found = spark.createDataFrame([("en", p, 5, s) for p, s in zip("abcdef", (3, 9, 9, 1, 2, 7), strict=True)], "lang string, phrase string, a long, score long")
    assert [(r.phrase, r["rank"]) for r in collocations.top_collocations(found, 3).orderBy("rank").collect()] == [("b", 1), ("c", 2), ("f", 3)]


# --- spelling variants ------------------------------------------------------------------------


def brute_variants(rows, least=variants.MIN_COUNT, chars=variants.MIN_CHARS, every=variants.DAMAGE):
    n = Counter()
    for doc, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= chars and c >= least}
    replaced, holes, near = defaultdict(set), defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            replaced[w[:i], w[i + 1 :]].add(w)
            holes[w[:i] + w[i + 1 :]].add(w)
    for ws in replaced.values():
        for w in ws:
            near[w] |= ws - {w}
    for w in n:
        for x in holes.get(w, ()):
            near[w].add(x)
            near[x].add(w)
    form = {}
    for w in n:
        best = min(((-n[x], x) for x in near[w]), default=None)
        if best and -best[0] >= 5 * n[w]:
            form[w] = best[1]
    out = []
    for w, c in n.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, c, len(near[w]), form.get(w), n.get(form.get(w)), root))
    return sorted(out, key=repr)


COLS = ("word", "n", "n_near", "form", "form_n", "root")


def test_variants_equal_brute_force_on_the_tables(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = queries.op12_spelling_variants(spark, "/root/testdata/sf0.01").select(*COLS).collect()
    want = brute_variants(rows)
    assert sorted(map(tuple, got), key=repr) == want and sum(w[3] is not None for w in want) > 20


def test_variants_of_dense_words(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, k]), " ".join("".join(rng.choice("abÿ") for _ in range(rng.choice((3, 4, 5, 6)))) * rng.choice((1, 1, 2)) for _ in range(60))) for k in range(200)]
    rows += [(7, "abcdef " * 600 + "abcdeg " * 100 + "abcdgg " * 15 + "abcggg " * 3), (8, None), (9, ""), (9, "É1x"), (10, "ABCDEF" + "q" * 50_000)]
    got = variants.spelling_groups(documents(spark, rows, extra=True), min_chars=4, min_count=2, damage=7)
    assert sorted(map(tuple, got.select(*COLS).collect()), key=repr) == brute_variants(rows, 2, 4, 7)
    assert variants.spelling_groups(documents(spark, [])).count() == 0


def test_pivots_are_disjoint_grams_of_the_prefix():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randrange(4, 12))) for _ in range(300)]
    n = Counter(g for w in words for g in {w[i : i + 2] for i in range(len(w) - 1)})
    order = {g: (k, c) for k, (g, c) in enumerate(sorted(n.items(), key=lambda x: (x[1], x[0])))}
    for w in words:
        _, prefix = variants.gram_prefix(w, order)
        cost = lambda i, s: order[w[i : i + 2]][1] * variants.DECAY**-s  # noqa: B023, E731
        a, b = variants.pivots(w, prefix, order)
        assert {a, b} <= set(prefix) and b >= a + 2
        assert cost(a, a) + cost(b, len(w) - 2 - b) == min(cost(i, i) + cost(j, len(w) - 2 - j) for i in prefix for j in prefix if j >= i + 2)


# --- decontamination --------------------------------------------------------------------------


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_contamination(docs, items, size):
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, t in items:
            x = words(t)
            k = min(size, len(x))
            for j in range(len(x) - k + 1 if x else 0):
                for i in range(len(w) - k + 1):
                    if w[i : i + k] == x[j : j + k]:
                        hit |= set(range(i, i + k))
                        ids.add(str(item))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_contamination_equals_brute_force(spark, size):
    rng = random.Random(size)
    text = lambda n: "".join(rng.choice(["a", "B", "c9", "É", "é", "zz", "İ", "ΑΣ"]) + rng.choice([" ", " ", ", ", "\n", "\x7f"]) for _ in range(n))
    items = [(k, text(rng.randrange(9))) for k in range(25)] + [(100, None), (101, "..."), (102, "a b c9 a b c9 a b c9"), (103, "A-B c9 A B C9 a b c9"), (104, "Zz")]
    docs = [(k, text(rng.randrange(30))) for k in range(60)] + [(3, text(20)), (3, None), (None, "a b"), (61, ""), (62, "?!"), (63, " zz"), (64, "a b c9 " * 30)]
    got = decontaminate.digests(decontaminate.contamination(documents(spark, docs, extra=True), spark.createDataFrame(items, "item_id long, text string"), size=size))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_contamination(docs, items, size)


def test_contamination_beyond_the_broadcast_bound_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "small", lambda df: df)
    docs, items = [(1, "x one two three y one two three"), (2, "three two one")], [(1, "one two three"), (12, "One, two; three!")]
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, decontaminate.digests(decontaminate.contamination(documents(spark, docs), tests)).collect())) == brute_contamination(docs, items, 10)
    assert decontaminate.contamination(documents(spark, []), tests).count() == 0
    assert [tuple(r) for r in decontaminate.contamination(documents(spark, docs), tests.where("false")).orderBy("doc_id").collect()] == [(1, 8, 0, 0, [], False), (2, 3, 0, 0, [], False)]


def test_proximity(spark):
    rng = random.Random(5)
    docs = [(k, " ".join(rng.choice("abcdefgh") for _ in range(40))) for k in range(20)]
    items = [(1, "a b c"), (2, "d d e"), (3, "f"), (4, "q a")]
    windows, _ = decontaminate.windows_of(spark.createDataFrame(items, "item_id long, text string"))
    terms = decontaminate.vocabulary(windows)
    postings = decontaminate.positional_index(documents(spark, docs), terms)
    ranked = decontaminate.ranked_terms(windows, terms, postings)
    rarest = {r.window: r.word for r in ranked.where("rank = 1").join(terms, "term").collect()}
    rows = {r.row: r.doc_id for r in postings.where("term = 0").collect()}
    got = {(r.window, rows[r.row], r.pos) for r in decontaminate.proximity_matches(postings, ranked, 4).collect()}
    want = set()
    for r in windows.collect():
        for doc, text in docs:
            w = text.split()
            for i, x in enumerate(w):
                if x == rarest[r.window] and set(r.words) <= set(w[max(0, i - 4) : i + 5]):
                    want.add((r.window, doc, i))
    assert got == want and len(want) > 20
