from collections import Counter

import numpy as np
import pytest

from rigprep.llm import crf, pii

from .docs import documents


def one_by_one(emission, moves):
    """Forward-backward and Viterbi of one sequence, word by word, in logarithms."""
    n, k = emission.shape
    a, b = np.empty((n, k)), np.zeros((n, k))
    a[0] = emission[0]
    for t in range(1, n):
        a[t] = np.logaddexp.reduce(a[t - 1][:, None] + moves, axis=0) + emission[t]
    for t in range(n - 2, -1, -1):
        b[t] = np.logaddexp.reduce(moves + (emission[t + 1] + b[t + 1])[None], axis=1)
    m = np.exp(a + b - np.logaddexp.reduce(a[-1]))
    score, back = emission[0], np.zeros((n, k), dtype=int)
    for t in range(1, n):
        through = score[:, None] + moves
        back[t] = through.argmax(axis=0)
        score = through.max(axis=0) + emission[t]
    path = [int(score.argmax())]
    for t in range(n - 1, 0, -1):
        path.append(int(back[t, path[-1]]))
    return m, np.array(path[::-1])


@pytest.mark.parametrize("seed", range(6))
def test_whole_sequences_equal_one_by_one(seed):
    r = np.random.default_rng(seed)
    k = 4
    count = np.array([0, 1, 63, 64, 65, 0, 200, 3, 129, 700])
    moves = r.normal(0, 1.5, (k, k)) + 2 * np.eye(k)
    emission = r.normal(0, 2, (count.sum(), k)).astype(np.float32)
    emission[:, 0] += seed  # from texts full of labels to hardly any
    run, length = crf.blocks(count)
    rows, filled = crf.padded(emission, length)
    marginal = crf.chained_marginals(crf.factors(rows), filled, moves, run)[filled]
    labels = crf.whole_viterbi(emission, count, moves)
    at = 0
    for n in count:
        if n:
            m, path = one_by_one(emission[at : at + n].astype(float), moves)
            assert np.allclose(marginal[at : at + n], m, atol=1e-6)
            assert (labels[at : at + n] == path).all()
        at += n


def test_a_spelled_out_email_is_found_alike_at_every_offset(spark):
    rows = [(k, " ".join(["word"] * k + ["mail bob at hosting dot com"] + ["and", "more"])) for k in range(131)]
    found = {r.doc_id: r.spans for r in pii.personal_data(documents(spark, rows)).collect()}
    for k, text in rows:
        assert [(s.kind, text[s.start : s.end], s.start - 5 * k) for s in found[k]] == [("email", "bob at hosting dot com", 5)], k


def test_labels_of_other_sentences_by_kind():
    tagger = pii.Tagger(pii.fit(pii.labelled_rows()))
    right, total = Counter(), Counter()
    for words, marks in pii.labelled_rows(400, seed=99):
        got = dict(tagger.tag([" ".join(words).encode()])[0])
        for i, y in enumerate(marks):
            total[y] += 1
            right[y] += got.get(i, "O") == y
    assert set(total) == set(pii.LABELS)
    assert all(right[y] / total[y] > 0.9 for y in total), right
