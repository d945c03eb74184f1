"""Mixing row by row, and the pipeline stage by stage, against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rigprep.llm import mixing, quality
from tests.llm.docs import documents


def test_rows_of_a_mixture(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 9), "en", rng.choice(["hot", "hot", "hot", "warm", "cold"])) for i in range(300)]
    docs, blocks, seed = documents(spark, rows), 8, 7
    out = [r.asDict() for r in mixing.mix(docs, budget_tokens=1500.0, blocks=blocks).collect()]
    # hashes come from Spark, everything else is worked out here
    epochs = 12
    at = {r.doc_id: (r.b, r.h) for r in docs.select("doc_id", mixing.block_of("doc_id", seed, blocks).alias("b"), F.array(*[F.xxhash64("doc_id", F.lit(e), F.lit(seed)) for e in range(epochs)]).alias("h")).collect()}
    turns = spark.createDataFrame([(s, b, e) for s in ("hot", "warm", "cold") for b in range(blocks) for e in range(epochs)], "s string, b int, e int")
    order = {(r.s, r.b, r.e): r.h for r in turns.select("s", "b", "e", F.xxhash64("s", "b", "e", F.lit(seed)).alias("h")).collect()}
    size, source = {i: len(t.split()) for i, t, _, _ in rows}, {i: s for i, _, _, s in rows}
    total = Counter()
    for i, n in size.items():
        total[source[i]] += n
    share = {s: n / sum(total.values()) for s, n in total.items()}
    a = min(1.0, max(0.0, 1 - math.log(1.5) / math.log(max(share.values()) / min(share.values()))))
    z = sum(x**a for x in share.values())
    want = Counter()
    for s, x in share.items():
        repeats = 1500 * x**a / z / total[s]
        mine = [r for r in out if r["mix_source"] == s]
        assert all(r["mix_weight"] == pytest.approx(x**a / z, abs=1e-6) and r["mix_repeats"] == pytest.approx(repeats, abs=1e-4) for r in mine)
        for e in range(math.ceil(repeats)):
            left = total[s] + 1.0 if e < math.floor(repeats) else (repeats - math.floor(repeats)) * total[s]
            for rank, b in enumerate(sorted(range(blocks), key=lambda b: (order[s, b, e], b))):  # noqa: B023
                for i in sorted((i for i in size if source[i] == s and at[i][0] == b), key=lambda i: (at[i][1][e], i)):  # noqa: B023
                    if left > 0:
                        want[i, s, e, b, rank] += 1
                    left -= size[i]
    assert Counter((r["doc_id"], r["mix_source"], r["mix_epoch"], r["mix_block"], r["mix_rank"]) for r in out) == want


def vocabulary(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en"]) for _ in range(rng.randrange(1, 4))) for _ in range(n)]


def text(seed, n=160):
    rng, words = random.Random(seed), vocabulary(1, 300)
    return " ".join(rng.choice(words) for _ in range(n))


def sets(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_every_stage_against_plain_python(spark):
    base = [text(k) for k in range(6)]
    near = base[1] + " " + text(99, 10)
    rows = [(4, base[0]), (2, base[0].replace(" ", "\n", 3)), (9, base[0]), (7, base[1]), (3, near), (5, base[2]), (5, base[2]), (None, base[3]), (None, base[3]), (None, base[2]), (6, None), (8, ""), (10, "too short"), (11, "a " * 400), (12, base[4] + " " + text(77, 60_000)), (13, base[5])]
    docs = documents(spark, [(i, t, "xx", f"s{k % 3}") for k, (i, t) in enumerate(rows)], extra=True)
    given = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    stages = dict(corpus_pipeline.STAGES)
    kept = {t for t, ok in ((r.doc_id, r.kept) for r in quality.fertility_rules(docs.select(F.struct("text").alias("doc_id"), "text", "lang")).collect()) if ok}
    judged = stages["quality"](spark, docs, "")
    want = Counter({(i, t): n for (i, t), n in Counter(rows).items() if (t,) in {tuple(k) for k in kept}})
    assert given(judged) == want and judged.columns == list(corpus_pipeline.COLUMNS) and sum(want.values()) >= 9
    once = stages["exact_dedup"](spark, judged, "")
    groups = defaultdict(list)
    for i, t in want:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append((i is None, i or 0, t))
    want = Counter({(None if none else i, t): 1 for none, i, t in map(min, groups.values())})
    assert given(once) == want
    apart = stages["near_dedup"](spark, once, "")
    ids = sorted(i for i, _ in want if i is not None)
    of = {i: sets(t) for i, t in want if i is not None}
    root = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if i < j and 100 * len(of[i] & of[j]) >= 75 * len(of[i] | of[j]):
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    want = Counter({(i, t): 1 for i, t in want if i is None or root[i] == i})
    assert given(apart) == want and 7 not in {i for i, _ in want} and 3 in {i for i, _ in want}
    mixed = stages["mixing"](spark, apart, "")
    assert set(given(mixed)) == set(want) and mixed.columns == list(corpus_pipeline.COLUMNS)
    packed = stages["packing"](spark, mixed, "").collect()
    pieces, fill = defaultdict(list), defaultdict(list)
    for r in packed:
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
        fill[r.sequence_id].append((r.offset, r.length))
    uses = Counter(i for i, t in given(mixed).elements())
    for i, n in uses.items():
        if i is not None:
            assert sum(x[1] for x in pieces[i]) == n * pieces[i][0][2]
    for of_sequence in fill.values():
        end = 0
        for offset, length in sorted(of_sequence):
            assert offset == end
            end += length
        assert end <= 1024


def test_stages_take_an_empty_table(spark):
    docs = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.count() == 0, name
