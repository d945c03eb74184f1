"""Texts that are one word at ASCII white space are read to their end."""

import numpy as np
import pytest

from rigprep.llm import langid

EN, DE = "the of and that with this there which would", "der und nicht eine werden auch über durch zwischen"


@pytest.fixture(scope="module")
def reader():
    r = np.random.default_rng(0)
    rows = [(" ".join(r.permutation(t.split() * 10)), lang) for t, lang in ((EN, "en"), (DE, "de")) for _ in range(20)]
    return langid.Reader(langid.fit(rows))


@pytest.mark.parametrize("joint", ["\u00a0", "\u3000"])
def test_other_white_space_parts_words(reader, joint):
    plain, joined = ((EN + " " + DE + " " + DE), joint.join((EN + " " + DE + " " + DE).split()))
    assert reader.read([joined.encode()]) == reader.read([plain.encode()])
    assert reader.read([joined.encode()])[0][0] == "de"


def test_a_switch_far_into_a_long_word_is_seen(reader):
    one = lambda t, n: "".join(t.split()) * n
    got = reader.read([(one(EN, 2) + one(DE, 20)).encode(), (one(DE, 2) + one(EN, 20)).encode(), one(EN, 2000).encode()])
    assert [g[0] for g in got] == ["de", "en", "en"] and all(0 <= g[1] <= 1 for g in got)


def test_every_bigram_and_trigram_is_in_a_piece():
    for n in (1, 2, 3, 22, 23, 24, 25, 44, 45, 100):
        word = "".join(chr(0x4E00 + i) for i in range(n))
        cut = langid.pieces(word)
        assert all(any(word[i : i + k] in p for p in cut) for k in (1, 2, 3) for i in range(n - k + 1)) and max(map(len, cut)) <= 23
    assert langid.pieces("12 !") == []


def test_words_are_described_alike_alone_and_together():
    words = ["don't", "x", "Straße,", "a1b²c", "İstanbul", "ΟΔΟΣ", "12", "ab", "internationalisierung", "日本語", "été"]
    letters = langid.normals(words)
    assert letters == [langid.normal(w) for w in words] and langid.normals([]) == []
    known = [p for n in letters for p in langid.cut(n)]
    flat, size = langid.features(known)
    alone = [langid.features([p]) for p in known]
    assert flat.tolist() == [x for f, _ in alone for x in f.tolist()] and size.tolist() == [int(n[0]) for _, n in alone]
    assert size.tolist() == [2 * len(p) + 8 for p in known] and flat.min() >= 0 and flat.max() < langid.FEATURES
    a, b = (set(langid.features([w])[0].tolist()) for w in ("trinken", "trank"))
    assert len(a & b) >= 4  # first letter, first two letters and both of their grams


def test_words_of_switched_text_have_the_labels_that_enumeration_gives(reader):
    from itertools import product

    from rigprep.llm import crf

    for text in ("the of and nicht eine werden", "der und that with there", "which", "über the durch would und"):
        words = text.split()
        local = np.log(crf.factors(reader.model.sums(*langid.features(words))))
        moves = np.asarray(reader.model.moves)
        total = np.zeros((len(words), len(reader.model.labels)))
        for path in product(range(total.shape[1]), repeat=len(words)):
            weight = np.exp(sum(local[t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
            for t, y in enumerate(path):
                total[t, y] += weight
        total /= total.sum(axis=1, keepdims=True)
        got = reader.label(text.encode())
        assert [(w, lang) for w, lang, _ in got] == [(w, reader.model.labels[k]) for w, k in zip(words, total.argmax(axis=1), strict=True)]
        assert np.allclose([p for _, _, p in got], total.max(axis=1), atol=1e-5)
    assert [lang for _, lang, _ in reader.label(b"the of and that with der und nicht eine werden")] == ["en"] * 5 + ["de"] * 5
    assert reader.label(b"12 !") == []


def test_the_driver_gets_a_bounded_sample(spark):
    from tests.llm.docs import documents

    rows = [(k, f"{EN} " * 4000, f"l{k % 5}", "s") for k in range(60)] + [(k, DE, "rare", "s") for k in range(60, 63)] + [(100, DE, None, "s"), (None, DE, "l0", "s"), (101, "", "l0", "s")]
    runs = langid.sample(documents(spark, rows), "doc_id", "text", "lang", 3, 5)
    assert {lang for _, lang in runs} == {f"l{k}" for k in range(5)} and sum(len(w) for w, _ in runs) <= 5 * 3 * langid.FIT_WORDS
    assert langid.sample(documents(spark, []), "doc_id", "text", "lang", 3, 5) == []
