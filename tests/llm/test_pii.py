import hashlib
import re

import pytest

from rigprep.llm import pii

from .docs import documents


def plain_rules(text):
    """The contract's expressions as they stand, on short texts."""
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return out


TEXTS = [
    None, "", "no data", "mail a.b+c@x-y.example.com, b@c, @d.com, e@f.g@h.i.j", "é x@y.z and 10.0.0.1 10.0.0.256 1.2.3.4.5.6.7.8 001.2.3.4",
    "card 4539 1488 0343 6467 and 4539148803436467, 4539148803436468, 1-2-3", "call +1 (017) 555-7713 or +49 30 1234567, + 1, +12", "١٢٣ 4٣2 a@b..c x@y.z.", "a" * 3000 + "@" + "b" * 50 + ".c", "9" * 3000 + ".1.1.1",
]


@pytest.mark.parametrize("extra", [False, True])
def test_rules_equal_the_plain_expressions(spark, extra):
    docs = documents(spark, list(enumerate(TEXTS)), extra)
    for r in pii.span_digests(pii.personal_data(docs)).collect():
        base = plain_rules(TEXTS[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert set(f"{k}:{a}:{b}" for k, a, b in base) <= set(r.spans.split(","))


def test_the_crf_reads_held_out_rows_and_adds_spans(spark):
    model = pii.Tagger(pii.fit(pii.labelled_rows()))
    good = n = 0
    for words, labels in pii.labelled_rows(200, seed=99):
        got = dict(model.tag([" ".join(words).encode()])[0])
        good += sum(got.get(i, "O") == x for i, x in enumerate(labels))
        n += len(labels)
    assert good / n > 0.97
    text = 'note token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" here and some more words'
    spans = pii.personal_data(documents(spark, [(1, text)])).first().spans
    assert [(s.kind, text[s.start : s.end], s.by_rule) for s in spans] == [("secret", "04dbebab91ab85687d33eeaaf9ac699e1188f962", False)]
    assert pii.personal_data(documents(spark, [])).count() == 0
