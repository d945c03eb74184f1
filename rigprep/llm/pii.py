"""Personal data: exact rules, and a linear-chain CRF over word shapes that adds to them.

The rules find emails, IP addresses, card numbers and phone numbers as written. The CRF finds what
they miss (spelled-out emails, phone numbers without a plus, secrets) from the shapes of words and
their neighbours. It is trained on a small labelled table and decoded by Viterbi in batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigprep.llm import crf
from rigprep.llm.text import map_texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ["O", "email", "ip", "card", "phone", "secret"]
FEATURES = 1 << 14
CACHE_WORDS = 500_000

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What a run must hold besides the right shapes.
_EVIDENCE = {"email": re.compile(r"@|(?i:\bdot\b)|\(at\)"), "ip": re.compile(r"[0-9][.:][0-9]+[.:][0-9]"), "card": re.compile(r"(?:[0-9][\x20-]?){12}"), "phone": re.compile(r"(?:[0-9][^0-9]{0,3}){7}"), "secret": re.compile(r"[0-9]")}
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- rules --------------------------------------------------------------------------------


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ is tried once, leftwards over the local part, so long words cost no more than others."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", m.end() if m else at + 1)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start; what fails a kind's test is dropped."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not re.search("[0-9]", text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# --- the labelled table ---------------------------------------------------------------------


def labelled_rows(n: int = 2400, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """Made-up sentences with a label for each word, from templates and a seed."""
    r = np.random.default_rng(seed)

    def pick(*xs):
        return xs[int(r.integers(len(xs)))]

    def word(low=2, high=12):
        w = "".join(chr(x) for x in r.integers(97, 123, int(r.integers(low, high))))
        return pick(w, w, w, w.capitalize(), w + pick(",", ".", "!", ".'"))

    def digits(k):
        return "".join(map(str, r.integers(0, 10, k)))

    def personal():
        kind = pick("email", "email", "email", "phone", "ip", "card", "card", "secret")
        name, host = word(3, 8).lower().strip(",."), word(3, 9).lower().strip(",.")
        if kind == "email":
            form = pick(f"{name}@{host}.com", f"{name} at {host} dot com", f"{name} [at] {host} [dot] org", f"{name}(at){host}.net", f"{name} (at) {host} (dot) de")
        elif kind == "phone":
            form = pick(f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"+{digits(2)} {digits(3)} {digits(7)}")
        elif kind == "ip":
            form = ".".join(str(x) for x in r.integers(0, 256, 4))
        elif kind == "card":
            form = pick(digits(16), " ".join(digits(4) for _ in range(4)), "-".join(digits(4) for _ in range(4)))
        else:
            code = "".join("0123456789abcdef"[x] for x in r.integers(0, 16, 40))
            return pick("token", "key", "secret", "password") + pick(" = ", ": "), f'"{code}"', "secret"
        return pick("", "call ", "mail ", "from ", "card ", "host "), form + pick("", ".", ","), kind

    rows = []
    for _ in range(n):
        words, marks = [], []
        for part in range(int(r.integers(1, 4))):
            for _ in range(int(r.integers(4, 20))):
                w = word()
                if r.random() < 0.3:
                    w = pick("at", "the", "of", "to", "in", "is", "At", "de", "it")
                    w = "dot" if r.random() < 0.02 else w
                elif r.random() < 0.12:
                    w = pick(digits(int(r.integers(1, 7))), "19" + digits(2), digits(2) + "%", f"{digits(1)}.{digits(2)}", w.upper(), w + "###", w + "$$$", w.upper() + "!!", "|", f"{digits(1)}.0", "x-" + w, f"v{digits(1)}.{digits(1)}")
                times = int(r.integers(3, 9)) if r.random() < 0.02 else 1
                words += [w] * times
                marks += ["O"] * times
            if r.random() < 0.5:
                lead, form, kind = personal()
                words += lead.split()
                marks += ["O"] * len(lead.split())
                words += form.split()
                marks += [kind] * len(form.split())
        rows.append((words, marks))
    return rows


def labelled_table(spark: SparkSession) -> DataFrame:
    """The default table that the CRF is trained on: words and labels of a sentence in each row."""
    return spark.createDataFrame(labelled_rows(), "words array<string>, labels array<string>")


# --- features -------------------------------------------------------------------------------

_CUES = frozenset(["token", "key", "secret", "password", "call", "phone", "tel", "mail", "email", "card", "host", "ip", "at", "dot", "=", ":"])


def shape(word: str) -> tuple[str, ...]:
    """What the CRF knows of a word; words of one shape are one class."""
    bare = word.strip(".,;:!?\"'()[]<>")
    runs = re.sub(r"[^\W\d_]", "x", re.sub(r"[^\W\d_a-z]", "X", re.sub(r"[0-9]", "d", word)))
    short = re.sub(r"(.)\1+", r"\1+", runs)
    n_digits = sum(c.isdigit() for c in word)
    hexes = len(bare) >= 16 and all(c in "0123456789abcdefABCDEF" for c in bare)
    cue = bare.lower() if bare.lower() in _CUES else word.lower() if word.lower() in _CUES else ""
    plain = "@" not in word and not n_digits and not hexes
    return (
        short[:16],
        f"n{min(n_digits, 17)}",
        f"l{min(len(bare), 20) // 2}",
        f"h{hexes}",
        f"a{'@' in word}{'.' in bare}{'-' in bare}{word[:1] in '+(['}",
        f"e{bare[:1].isdigit()}{bare[-1:].isdigit()}",
        f"c{cue}",
        "plain" if plain else "odd",
    )


def _features(s: tuple[str, ...], where: str) -> list[int]:
    return [crf.feature(f"{where}{k}{x}", FEATURES) for k, x in enumerate(s)]


EDGE = ("<edge>",)
#: Of words this far away the CRF knows the cue alone.
FAR = (-3, -2, 2, 3)


def _cue_feature(s: tuple[str, ...], away: int) -> list[int]:
    return [crf.feature(f"far{away}{s[6] if s != EDGE else s[0]}", FEATURES)]


def fit(rows: list[tuple[list[str], list[str]]]) -> crf.Crf:
    sequences = []
    for words, marks in rows:
        s = [EDGE, *map(shape, words), EDGE]
        far = [EDGE, EDGE, *s, EDGE, EDGE]
        feats = [_features(s[i], "w") + _features(s[i - 1], "p") + _features(s[i + 1], "n") + [f for k in FAR for f in _cue_feature(far[i + 2 + k], k)] for i in range(1, len(s) - 1)]
        sequences.append((feats, [LABELS.index(m) for m in marks]))
    return crf.train(sequences, LABELS, FEATURES)


class Tagger:
    """Words to classes to emissions, and the decoding of a batch of texts."""

    def __init__(self, model: crf.Crf):
        self.model = model
        self.classes: dict[tuple, int] = {}
        self.words: dict[bytes, int] = {}
        self.tables = [np.empty((0, len(LABELS)), dtype=np.float32)] * (3 + len(FAR))
        self.class_of(EDGE)

    def class_of(self, s: tuple) -> int:
        if s not in self.classes:
            self.classes[s] = len(self.classes)
            new = [self.model.emissions([f]) for f in (*(_features(s, w) for w in "wpn"), *(_cue_feature(s, k) for k in FAR))]
            self.tables = [np.concatenate([t, x]) for t, x in zip(self.tables, new, strict=True)]
        return self.classes[s]

    def ids(self, words: list[bytes]) -> np.ndarray:
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        for w in {w for w in words if w not in self.words}:
            self.words[w] = self.class_of(shape(w.decode("utf-8", "replace")))
        return np.fromiter(map(self.words.__getitem__, words), dtype=np.int64, count=len(words))

    def tag(self, texts: list[bytes]) -> list[list[tuple[int, str]]]:
        """(word number, label) of the labelled words of each text, each text decoded as one sequence."""
        split = [x.split() for x in texts]
        count = np.array([len(w) for w in split], dtype=np.int64)
        if not count.sum():
            return [[] for _ in texts]
        edge = self.classes[EDGE]
        ids = np.concatenate([self.ids(w) for w in split])
        after_first = np.arange(len(ids)) - np.repeat(np.cumsum(count) - count, count)
        to_last = np.repeat(count, count) - 1 - after_first
        own, *others = self.tables
        local = own[ids]
        for away, table in zip((-1, 1, *FAR), others, strict=True):
            local += table[np.where((after_first if away < 0 else to_last) >= abs(away), np.roll(ids, -away), edge)]
        best = crf.whole_viterbi(local, count, self.model.moves)
        out: list[list[tuple[int, str]]] = [[] for _ in texts]
        first, places = np.cumsum(count) - count, np.flatnonzero(best)
        for p, t in zip(places.tolist(), np.repeat(np.arange(len(texts)), count)[places].tolist(), strict=True):
            out[t].append((int(p - first[t]), LABELS[best[p]]))
        return out


_TAGGERS: dict[bytes, Tagger] = {}


def tagger(weights: bytes, moves: bytes) -> Tagger:
    """One for each Python worker and model."""
    key = weights[:64] + moves
    if key not in _TAGGERS:
        _TAGGERS.clear()
        k = len(LABELS)
        _TAGGERS[key] = Tagger(crf.Crf(LABELS, np.frombuffer(weights, dtype=np.float32).reshape(-1, k), np.frombuffer(moves, dtype=np.float64).reshape(k, k)))
    return _TAGGERS[key]


def added_spans(text: str, tags: list[tuple[int, str]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Runs of equally labelled words, without outer punctuation, that touch no span of the rules."""
    if not tags:
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    runs: list[list] = []
    for k, label in tags:
        if runs and runs[-1][0] == label and runs[-1][2] == k - 1:
            runs[-1][2] = k
        else:
            runs.append([label, k, k])
    out = []
    for label, i, j in runs:
        a, b = words[i][0], words[j][1]
        while a < b and text[a] in "\"'[<,;:=":
            a += 1
        while b > a and text[b - 1] in ".,;:!?\"'>":
            b -= 1
        if a < b and _EVIDENCE[label].search(text, a, b) and not any(a < y and x < b for _, x, y in base):
            out.append((label, a, b))
    return out


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: DataFrame | None = None, max_labelled: int = 5000) -> DataFrame:
    """One row for each row of ``docs``: doc_id and spans (kind, start, end, by_rule), by kind and start.

    Offsets are code points, ends exclusive. A text of any length is one sequence of the CRF. Spans of the rules always stay; the CRF adds spans that
    do not touch them. ``labelled`` (words, labels) trains the CRF; at most ``max_labelled`` of its
    rows are used. Null and empty texts have no spans. Every row is judged by itself, without a
    shuffle; an empty table gives an empty table.
    """
    labelled = labelled_table(docs.sparkSession) if labelled is None else labelled
    rows = [(r["words"], r["labels"]) for r in labelled.select("words", "labels").limit(max_labelled).collect()]
    model = fit(rows)
    weights, moves = model.weights.tobytes(), model.moves.tobytes()
    order = {k: i for i, k in enumerate([*KINDS, *(x for x in LABELS[1:] if x not in KINDS)])}
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("by_rule", pa.bool_())]))

    def start():
        known = tagger(weights, moves)

        def work(cols, texts):
            out = []
            for at in range(0, len(texts), 256):
                part = texts[at : at + 256]
                for raw, tags in zip(part, known.tag(part), strict=True):
                    text = raw.decode("utf-8", "replace")
                    base = base_spans(text)
                    spans = [(*s, True) for s in base] + [(*s, False) for s in added_spans(text, tags, base)]
                    spans.sort(key=lambda s: (order[s[0]], s[1]))
                    out.append([dict(zip(("kind", "start", "end", "by_rule"), s, strict=True)) for s in spans])
            return {"doc_id": cols["doc_id"], "spans": pa.array(out, kind)}

        return work

    return map_texts(docs, {"doc_id": id_col}, text_col, start, f"doc_id {dict(docs.dtypes)[id_col]}, spans array<struct<kind:string,start:int,end:int,by_rule:boolean>>")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts of the rules' spans, the SHA-256 of their list, and the list of all spans."""
    ruled = F.filter("spans", lambda s: s["by_rule"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(kind: str):
        return F.size(F.filter(ruled, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of_kind(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(ruled), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), (F.size("spans") - F.size(ruled)).cast("long").alias("n_added"))
