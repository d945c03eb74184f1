import hashlib
from collections import Counter

import numpy as np
import pytest

from rigprep.llm import repeats

from .docs import documents

LENGTH = 200


def brute(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + LENGTH] for _, b in texts for i in range(len(b) - LENGTH + 1))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - LENGTH + 1):
            if seen[b[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        spans = int((np.diff(np.concatenate([[False], gone])[: len(b) + 2].astype(int)) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, extra=False):
    return sorted((tuple(r) for r in repeats.without_repeats(documents(spark, rows, extra)).drop("spans").collect()), key=str)


def text(r, n):
    return "".join(map(chr, r.integers(97, 123, n)))


@pytest.mark.parametrize("extra", [False, True])
def test_planted_passages_equal_brute_force(spark, extra):
    r = np.random.default_rng(1)
    p, q = text(r, 260), text(r, 500)
    rows = [(i, text(r, int(r.integers(0, 400))) + (p if i % 3 else q[i * 5 :]) + text(r, int(r.integers(0, 300)))) for i in range(25)]
    rows += [(30, text(r, 900)), (31, None), (32, ""), (33, "é" * 150), (34, "é" * 150), (35, "a" * 700), (36, "ab" * 300), (37, p[:200]), (38, p[:199]), (39, p[5:205] + q[:199]), (40, q), (41, q), (42, "x" + q), (43, q[:250] + "!" + q[251:])]
    assert got(spark, rows, extra) == brute(rows)


def test_edited_copies_equal_brute_force(spark):
    r = np.random.default_rng(2)
    base = text(r, 1500)
    rows = []
    for i in range(40):
        t = list(base)
        for at in r.integers(0, len(t), int(r.integers(0, 6))):
            t[at] = "#"
        rows.append((i, "".join(t)[int(r.integers(0, 50)) :]))
    assert got(spark, rows) == brute(rows)


def test_pieces_repeated_ids_and_an_empty_table(spark, monkeypatch):
    r = np.random.default_rng(3)
    monkeypatch.setattr(repeats, "PIECE", 512)
    p = text(r, 900)
    whole = np.concatenate([x[0] for x in repeats.anchors((p * 3).encode())])
    monkeypatch.undo()
    assert (whole == np.concatenate([x[0] for x in repeats.anchors((p * 3).encode())])).all()
    rows = [(1, p), (1, p + "z"), (None, p[:300]), (2, text(r, 300))]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_the_smallest_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in repeats.without_repeats(docs).drop("spans").collect()), key=str) == brute(rows)


def test_several_anchors_of_one_short_text_equal_brute_force(spark):
    r = np.random.default_rng(4)
    p = text(r, 240)
    rows = [(1, "A" + "-" * 200 + "B"), (2, "A short title\n" + "=" * 220 + "\nclosing"), (3, "x" + "ab" * 120 + "y"), (4, "q" + "." * 201 + "r"), (5, p), (5, p), (6, text(r, 30) + "_" * 260 + "end"), (7, "z" * 199 + "y"), (8, "A title\n" + "=" * 190 + "\nend")]
    rows += [(9, "B" + "-" * 200 + "A"), (10, "u" + "+*" * 100), (11, "w" + "+*" * 100 + "v"), (12, "A" + "~" * 200 + "B"), (12, "A" + "~" * 200 + "B"), (None, "K" + "^" * 200 + "L"), (None, "K" + "^" * 200 + "L")]
    assert got(spark, rows) == brute(rows)
    for row in rows[:4]:
        assert got(spark, [row]) == brute([row])


def test_random_short_periodic_texts_equal_brute_force(spark):
    r = np.random.default_rng(5)
    parts = ["-", "ab", "xyz", "0123456789", "=" * 7 + "|"]
    rows = [(i, text(r, int(r.integers(0, 40))) + (parts[i % 5] * 300)[: int(r.integers(150, 320))] + text(r, int(r.integers(0, 40)))) for i in range(60)]
    assert got(spark, rows) == brute(rows)
    rows = [(i, text(r, int(r.integers(0, 40))) + (chr(0x4E00 + i) * 300)[: int(r.integers(50, 100))] + text(r, int(r.integers(0, 40)))) for i in range(60)]
    assert got(spark, rows) == brute(rows)


def test_string_ids_and_a_passage_of_very_many_texts_equal_brute_force(spark, monkeypatch):
    r = np.random.default_rng(6)
    p, q = text(r, 230), text(r, 400)
    rows = [(i, text(r, int(r.integers(90, 130))) + p[: 180 + i % 50] + text(r, 150)) for i in range(40)] + [(50 + i, text(r, 150) + q[i : 390 - i] + text(r, 120)) for i in range(30)]
    wanted = brute(rows)
    for group in (4096, 3):  # gathered, and dealt out one by one
        monkeypatch.setattr(repeats, "GROUP", group)
        assert got(spark, rows) == wanted
    docs = documents(spark, rows)
    named = sorted(tuple(x) for x in repeats.without_repeats(docs.withColumn("doc_id", docs.doc_id.cast("string"))).drop("spans").collect())
    assert named == sorted((str(d), *rest) for d, *rest in wanted)


def test_anchors_own_each_string_once():
    r = np.random.default_rng(7)
    for t in (text(r, 900), "a" * 500, "ab" * 300, "y" * 200, "hello world, " * 50 + text(r, 300)):
        own = sorted(int(p - a) for pos, _, lo, hi in repeats.anchors(t.encode()) for p, x, y in zip(pos, lo, hi, strict=True) for a in range(x, y + 1))
        assert own == list(range(len(t) - LENGTH + 1))
