import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rigprep.llm import packing

from .docs import documents

ROWS = [(1, None), (2, ""), (3, "a few words, <|endoftext|> and more"), (4, "x y'z don't " * 900), (5, "é 漢字 \t\n  end"), (6, "a few words"), (6, "a few words"), (7, "word " * 1023), (8, "word " * 2047), (9, "a<|endoftext|>b <|endoftext|>"), (10, "<|endoftext|>" * 3)]


@pytest.mark.parametrize("extra", [False, True])
def test_pieces_are_the_tokenizers_ids_and_fill_sequences(spark, extra):
    rows = packing.packed_digests(documents(spark, ROWS, extra)).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for doc, text in ROWS:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        expected += [(doc, at, len(p := ids[at : at + 1024]), zlib.crc32(np.array(p, "<u4").tobytes()), len(ids)) for at in range(0, len(ids), 1024)]
    assert sorted(r[:5] for r in rows) == sorted(expected)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_an_empty_table_and_one_of_full_pieces(spark):
    assert packing.packed_digests(documents(spark, [])).count() == 0
    full = spark.createDataFrame([(1, 0, 1024), (2, 0, 1024)], "doc_id long, start long, length long")
    assert sorted(r.sequence_id for r in packing.pack(full).collect()) == [0, 1]


def test_a_hot_length_is_ranked_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 50)
    pieces = spark.range(1000).selectExpr("id as doc_id", "0L as start", "cast(if(id % 3 = 0, 1 + id % 1024, 500) as long) as length")
    rows = packing.pack(pieces).collect()
    assert len(rows) == 1000
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 1024
    assert len(used) <= 1.1 * sum(used.values()) / 1024 + 2


@pytest.mark.parametrize("n", [1, 30, 5000])
def test_the_plan_uses_each_item_once_with_little_padding(n):
    lengths = np.random.default_rng(n).integers(1, 1024, n)
    histogram = {int(k): int(c) for k, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
    plan = packing.plan(histogram)
    made, need = defaultdict(int), defaultdict(int)
    for pattern, times in plan:
        assert sum(k * c for k, c in pattern.items()) <= 1024
        for k, c in pattern.items():
            made[k] += c * times
    for k, c in histogram.items():
        need[-(-k // 8) * 8] += c
    assert made == need
    if n > 1000:
        assert lengths.sum() / (1024 * sum(t for _, t in plan)) > 0.97


def test_full_pieces_with_ids_round_trip(spark):
    docs = documents(spark, ROWS)
    rows = packing.pack(packing.token_pieces(docs)).collect()
    enc = packing.encoder("byte_bpe_50k.tiktoken")
    text = {}
    for r in sorted(rows, key=lambda r: r.start):
        text.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert enc.decode(text[5][:-1]) == ROWS[4][1]


def test_other_columns_stay(spark):
    pieces = spark.createDataFrame([(1, 0, 10, "A", 1), (2, 0, 1024, "B", 2)], "doc_id long, start long, length long, class string, part int")
    assert sorted((r.doc_id, r["class"], r.part) for r in packing.pack(pieces).collect()) == [(1, "A", 1), (2, "B", 2)]
