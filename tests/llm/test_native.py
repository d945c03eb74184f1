"""Exact dedup and mixing."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rigprep.llm import exact_dedup, mixing

from .docs import documents

ROWS = [(5, "a  b"), (3, "a b"), (9, "a\n\tb"), (4, None), (1, ""), (7, " "), (8, " "), (2, "x"), (2, "x"), (None, "a b"), (6, "long " * 5000)]


def brute(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    out = []
    for d, t in rows:
        n = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        out.append((d, min(x for x in groups[n] if x is not None), len(groups[n]), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("extra,bound", [(False, 1 << 26), (True, 1 << 26), (False, 0)])
def test_exact_duplicates_equal_brute_force(spark, extra, bound):
    got = exact_dedup.exact_duplicates(documents(spark, ROWS, extra), broadcast_bytes=bound).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(ROWS)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and set(kept) == {r.text_sha256 for r in got}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_the_filter_never_misses_and_lets_most_pass(spark):
    hashes = spark.range(5000).select(F.when(F.col("id") < 50, F.col("id") % 10).otherwise(F.col("id")).cast("string").alias("h"))
    maybe = exact_dedup.with_possibly_repeated(hashes, "h").where("maybe").collect()
    found = Counter(r.h for r in maybe)
    assert all(found[str(i)] == 5 for i in range(10)) and len(maybe) < 50 + 500


def test_dropping_keeps_columns_and_empty_tables(spark):
    out = exact_dedup.drop_exact_duplicates(documents(spark, ROWS, True))
    assert sorted((r.doc_id for r in out.where("doc_id is not null").collect())) == [1, 2, 3, 6, 7, 8] and "kept" in out.columns
    assert exact_dedup.exact_duplicates(documents(spark, [])).count() == 0


def test_only_equal_texts_go_where_ids_repeat(spark):
    rows = [(3, "same text"), (5, "same  text"), (5, "unique text"), (None, "unique too"), (None, "same text")]
    left = exact_dedup.drop_exact_duplicates(documents(spark, rows, True)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, "unique too"), (3, "same text"), (5, "unique text")]


def test_slices_of_the_hashes_give_the_same_marks(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK_BITS", 32768)
    rows = [(i, f"text {i % 2900}") for i in range(3000)]
    got = exact_dedup.exact_duplicates(documents(spark, rows), broadcast_bytes=1).drop("text_hash").collect()
    assert len(got) == 3000 and sum(not r.kept for r in got) == 100
    hashes = spark.range(5000).select((F.col("id") % 4900).cast("string").alias("h"))
    maybe = exact_dedup.with_possibly_repeated(hashes, "h", 1).where("maybe").collect()
    assert {str(i) for i in range(100)} <= {r.h for r in maybe} and len(maybe) < 200 + 1000


def mixed(spark, **options):
    rows = [(i, "w " * (3 + i % 5), "en", "hot" if i < 600 else f"s{i % 4}") for i in range(1000)] + [(2000, "", "en", "hollow"), (2001, "a b", "en", None), (2002, "a b", "en", None)]
    docs = documents(spark, rows)
    return rows, [r.asDict() for r in mixing.mix(docs, **options).collect()]


def test_every_document_is_used_and_no_source_repeats_too_often(spark):
    rows, out = mixed(spark, target=mixing.Target(repetition=2.0), blocks=16)
    used = Counter(r["doc_id"] for r in out)
    assert set(used) == {r[0] for r in rows}
    repeats = {r["mix_source"]: r["mix_repeats"] for r in out if r["mix_weight"] > 0}
    assert max(repeats.values()) / min(repeats.values()) == pytest.approx(2.0, rel=1e-5) and min(repeats.values()) == pytest.approx(1.0)
    assert max(used.values()) <= 2 and all(used[i] == 1 for i in range(600))
    weight = {r["mix_source"]: r["mix_weight"] for r in out}
    assert sum(weight.values()) == pytest.approx(1)
    tokens = defaultdict(int)
    for r in out:
        tokens[r["mix_source"]] += len(r["text"].split())
    for s, w in weight.items():
        assert tokens[s] / sum(tokens.values()) == pytest.approx(w, abs=0.01)
    ranks = defaultdict(set)
    for r in out:
        ranks[r["mix_source"], r["mix_epoch"]].add((r["mix_block"], r["mix_rank"]))
    assert all(len({b for b, _ in x}) == len({k for _, k in x}) == len(x) for x in ranks.values())


def test_entropy_target_and_budget(spark):
    _, out = mixed(spark, target=mixing.Target(repetition=None, entropy_bits=2.0), budget_tokens=2000)
    weight = {r["mix_source"]: r["mix_weight"] for r in out}
    import math

    assert -sum(w * math.log2(w) for w in weight.values() if w) == pytest.approx(2.0, abs=1e-3)
    assert 2000 <= sum(len(r["text"].split()) for r in out) <= 2000 + 8 * len(weight)


def test_mixing_an_empty_table(spark):
    assert mixing.mix(documents(spark, [])).count() == 0


def test_mixing_replaces_columns_of_its_own_names(spark):
    docs = documents(spark, [(i, "a b c " * (1 + i % 3), "en", f"s{i % 3}") for i in range(60)])
    for c in ("mix_source", "mix_rank", "left", "cut", "before", "tokens"):
        docs = docs.withColumn(c, F.lit("x"))
    out = mixing.mix(docs, blocks=4)
    assert len(out.columns) == len(set(out.columns)) and out.where("left <> 'x' or mix_source = 'x'").count() == 0
    assert {r.doc_id for r in out.collect()} == set(range(60))
