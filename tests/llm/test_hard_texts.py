"""Texts that vocabularies cannot take at once, ids that headers change, rows that repeat."""

import random
from collections import Counter

import pytest

from rigprep.llm import exact_dedup, mixing, near_dedup, packing, quality, warc
from tests.llm.docs import documents

RUNS = [" " * 2_000_000, "\n" * 2_000_000, " " * 2_000_000, "a b " + " " * 1_000_001 + "z", " \t" * 1_000_000 + "end"]


def test_long_runs_have_the_ids_of_the_tokenizers_file():
    import public_tokenizers
    import tokenizers

    full = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in [*RUNS, "plain words", ""]:
        assert packing.token_ids(text, "byte_bpe_50k.tiktoken", "byte_bpe_50k.json") == full.encode(text, add_special_tokens=False).ids


def test_a_bad_text_ends_no_query(spark):
    docs = documents(spark, [(k, t) for k, t in enumerate([*RUNS, "a few words here"])])
    pieces = packing.packed_digests(docs).collect()
    assert {r.doc_id for r in pieces} == set(range(6))
    of = {r.doc_id: r for r in quality.fertility_rules(docs).collect()}
    assert len(of) == 6 and [of[k].n_words for k in range(6)] == [0, 0, 1, 3, 1, 4] and of[2].word_chars == 2_000_000


def test_long_words_are_tokenised_in_parts():
    assert quality.parts("x" * 250_001) == ["x" * 100_000, "x" * 100_000, "x" * 50_001] and quality.parts("word") == ["word"]


def test_ids_come_back_unchanged(spark):
    ids = [" c ", "\n", "a\tb", "%20", "é %", "", "1", "x" * 300]
    pages = spark.createDataFrame([(i, "http://a/ b", f"<p>{k % 3}</p>") for k, i in enumerate(ids)], "page_id string, url string, html string")
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert set(got) == set(ids)
    for k, i in enumerate(ids):
        first = min(ids[j] for j in range(len(ids)) if j % 3 == k % 3)
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if i == first else ("revisit", first))


def test_members_have_no_bound_but_a_given_one():
    payloads = [random.Random(k).randbytes(n) for k, n in ((1, 300_000), (2, 10))]
    long, short = (warc.member(warc.build_record(k + 1, "u", p, warc.sha1_base32(p))) for k, p in enumerate(payloads))
    ids = lambda **bound: [h["x-page-id"] for kind, _, _, h, _ in warc.salvage(long + short, **bound) if kind == "record"]
    gaps = [x[1:3] for x in warc.salvage(long + short, member_bytes=100_000) if x[0] == "gap"]
    assert ids() == ["1", "2"] and ids(member_bytes=100_000) == ["2"] and gaps == [(0, len(long))]


FIVE = [(1, "same"), (1, "same"), (None, "x"), (None, "x"), (2, "u")]


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact_duplicates, near_dedup.drop_near_duplicates])
def test_rows_that_repeat_an_id_and_its_text_leave_one(spark, drop):
    got = drop(documents(spark, FIVE, extra=True))
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(repr, [(1, "same"), (None, "x"), (2, "u")])) and "row" in got.columns


def test_exact_copies_by_row_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, *range(12)]), rng.choice(["a b", "a  b", " c", "\tc", "d", None, ""])) for _ in range(150)]
    got = Counter((r.doc_id, r.text) for r in exact_dedup.drop_exact_duplicates(documents(spark, rows)).collect())
    groups = {}
    for i, t in rows:
        groups.setdefault(" ".join(f"^{t or ''}$".split()), []).append((i is None, -1 if i is None else i))
    assert sum(got.values()) == len(groups) == len({" ".join(f"^{t or ''}$".split()) for _, t in got})
    for (i, t), n in got.items():
        assert n == 1 and (i is None, -1 if i is None else i) == min(groups[" ".join(f"^{t or ''}$".split())])


def test_near_copies_of_one_id_leave_one(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    rows = [(1, text), (1, text + " more"), (1, text), (2, text), (3, "other words"), (4, "other words!"), (None, text), (None, text)]
    got = [(r.doc_id, r.text) for r in near_dedup.drop_near_duplicates(documents(spark, rows)).collect()]
    assert Counter(i for i, _ in got) == {1: 2, 3: 1, 4: 1, None: 1}


def test_any_column_name_passes(spark):
    docs = documents(spark, [(k, "some words " * (k + 1), "en", f"s{k % 2}") for k in range(8)], extra=True)
    for c in ("sequence_id", "offset", "__cut", "__left", "__place", "before", "mix_row"):
        docs = docs.withColumn(c, docs.doc_id)
    mixed = mixing.mix(docs, budget_tokens=20.0)
    assert "__cut" in mixed.columns and mixed.count() >= 2 and mixing.mix(docs).select("doc_id").distinct().count() == 8
    pieces = packing.token_pieces(docs).withColumn("__cut", packing.F.lit(1)).withColumn("sequence_id", packing.F.lit(9)).withColumn("offset", packing.F.lit(9)).withColumn("class", packing.F.lit(9))
    packed = packing.pack(pieces)
    assert packed.count() == 8 and packed.where("offset = 0").count() >= 1 and packed.columns.count("sequence_id") == 1
