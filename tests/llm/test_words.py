"""Quality rules and language identification."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rigprep.llm import crf, langid, quality

from .docs import documents

TEXTS = [None, "", "one two", "a b c d " * 20, "x # $ | <y>\nline\nline\n \nline z", "é漢 " * 60, "word " * 49, "\x85 \x1c a\x0bb\x0cc " * 20, "### $$$ %%% " + " ".join(f"w{i}###" for i in range(200)), " ".join(f"sentence{i} the of and" for i in range(40))]


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


@pytest.mark.parametrize("extra", [False, True])
def test_base_counts_equal_brute_force(spark, extra):
    docs = documents(spark, [(i, t, "en") for i, t in enumerate(TEXTS)], extra)
    for r in quality.fertility_rules(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(TEXTS[r.doc_id])
        assert not (r.base_failed and r.kept)
    assert quality.fertility_rules(docs.limit(0)).count() == 0
    assert quality.fertility_rules(docs.drop("lang")).count() == len(TEXTS)


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    good = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    out = quality.fertility_rules(docs.join(good, "doc_id", "left_semi")).where("not base_failed")
    assert out.where("not kept").count() == 0
    assert quality.fertility_rules(docs).where("not kept and not base_failed").count() > 0


def test_forward_backward_and_viterbi_equal_enumeration():
    from itertools import product

    r = np.random.default_rng(0)
    e, m = r.normal(size=(1, 4, 3)), r.normal(size=(3, 3))
    score = {p: sum(e[0, t, y] for t, y in enumerate(p)) + sum(m[a, b] for a, b in zip(p, p[1:], strict=False)) for p in product(range(3), repeat=4)}
    z = np.log(sum(np.exp(s) for s in score.values()))
    padded, filled = np.concatenate([e, np.zeros((1, 2, 3))], axis=1), np.array([[True] * 4 + [False] * 2])
    marginal, log_z, moves = crf.forward_backward(padded, filled, m)
    assert log_z[0] == pytest.approx(z)
    for t in range(4):
        for y in range(3):
            assert marginal[0, t, y] == pytest.approx(sum(np.exp(s - z) for p, s in score.items() if p[t] == y))
    assert moves.sum() == pytest.approx(3)
    assert tuple(crf.viterbi(padded, filled, m)[0][:4]) == max(score, key=score.get)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.identify(docs).collect()
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97 and all(0 <= r.score <= 1 for r in rows)
    odd = [(1, "the of and to in", "en"), (2, "der und die", "de"), (3, None, None), (6, "123 !!", "en"), (None, "the of", None)]
    got = {r.doc_id: r.lang_pred for r in langid.identify(documents(spark, odd, True)).collect()}
    assert got[3] == got[6] == "und" and got[1] == "en"
    assert langid.identify(documents(spark, [])).count() == 0


def test_the_pipeline_hands_on_whole_documents(spark, tmp_path):
    import corpus_pipeline as p

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    (tmp_path / "documents.parquet").mkdir()
    docs.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    kept, ids = docs, []
    for k, (_, stage) in enumerate(p.STAGES):
        kept = stage(spark, kept, str(tmp_path))
        if k < len(p.STAGES) - 1:
            assert kept.columns == list(p.COLUMNS)
        kept.write.parquet(str(tmp_path / f"out{k}"))
        kept = spark.read.parquet(str(tmp_path / f"out{k}"))
        ids.append({r.doc_id for r in kept.select("doc_id").collect()})
    rejected = {r.doc_id for r in quality.fertility_rules(docs).where("not kept").collect()}
    assert ids[0] == {r.doc_id for r in docs.select("doc_id").collect()} - rejected
    assert ids[0] >= ids[1] >= ids[2] == ids[3] == ids[4]
