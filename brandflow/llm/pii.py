"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base patterns find e-mail addresses, IPv4 addresses, card numbers and phone
numbers. Looser patterns propose further spans of the same kinds (addresses
with "(at)", numbers with other groupings or without a plus sign). Labelers of
three sorts vote for, against or not at all on every span, base or loose:
patterns (strict form, check digits, group lengths), gazetteers (top-level
domains, cue words in front) and context (letters or digits that touch the
span, assignment signs, lists of numbers).

Expectation-maximisation over the vote patterns (a Dawid-Skene model with
"no vote" as a third answer) estimates each labeler's reliability per kind and
the probability that a span is personal data. A logistic classifier over the
span's shape and context is then trained on those probabilities. It decides on
the loose spans; base spans always stay.

Votes and features are small fixed tuples, so the corpus reaches the driver
only as counts of the distinct (kind, votes, features) it contains: their number
is bounded by the labelers and features, not by the corpus, and every span of
every document is counted.

Defined results: null text counts as empty; rows are judged by themselves, so
repeated rows repeat their results. Positions are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import free_name

KINDS = ("email", "ip", "card", "phone")

# Base patterns. A run of digits or name characters is entered at its start only:
# a match never ends inside a run, so later entries would fail just the same.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_NAME_END = re.compile(r"[A-Za-z0-9._%+-]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Loose patterns.
_AT = re.compile(r"[ ]?[\[(<{] ?(?:at|AT) ?[\])>}][ ]?")
_DOT_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|[ ]?[\[(<{] ?(?:dot|DOT) ?[\])>}][ ]?)[A-Za-z0-9-]+)+")
_LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+.@-])(?:00|0|\()?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){2,4}(?![0-9A-Za-z@])")
_LOOSE_CARD = re.compile(r"(?<![0-9.])[0-9]{4}(?:([./_]|  )[0-9]{4}){2}\1[0-9]{3,4}(?![0-9])")

# fixed values: words that announce a kind, and common top-level domains
_CUES = {
    "email": {"mail", "email", "e-mail", "contact", "write", "correo", "courriel", "adresse"},
    "ip": {"ip", "host", "server", "address", "ipv4", "client"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta"},
    "phone": {"phone", "tel", "tel.", "telephone", "call", "mobile", "fax", "cell", "telefon", "teléfono", "téléphone", "anruf"},
}
_ENDINGS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "eu", "us", "ch", "at"}
_LAST_WORD = re.compile(r"([^\s:]+)[\s:]*$")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _run_start(text: str, at: int, least: int) -> int:
    """Start of the run of name characters that ends before ``at``."""
    size = 64
    while True:
        low = max(least, at - size)
        tail = text[low:at][::-1]
        n = _NAME_END.match(tail).end()
        if n < len(tail) or low == least:
            return at - n
        size *= 4


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, in order."""
    found = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = _run_start(text, at, end)
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            found.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and _luhn(d):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates, outside the base spans."""
    found = []
    for m in _AT.finditer(text):
        start = _run_start(text, m.start(), 0)
        host = _DOT_HOST.match(text, m.end())
        if start < m.start() and host:
            found.append((start, 0, host.end()))
    found += [(m.start(), 3, m.end()) for m in _LOOSE_PHONE.finditer(text) if 7 <= len(_digits(m.group())) <= 15]
    found += [(m.start(), 2, m.end()) for m in _LOOSE_CARD.finditer(text)]
    found.sort()
    out, k = [], 0
    for s in found:
        while k < len(base) and base[k][2] <= s[0]:
            k += 1
        if any(b[0] < s[2] and s[0] < b[2] for b in base[k : k + 4]):
            continue
        if not out or out[-1][2] <= s[0]:
            out.append(s)
    return out


def evidence(text: str, start: int, kind: int, end: int, base: bool) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Votes (1 for, -1 against, 0 none) and features of a span."""
    span, name = text[start:end], KINDS[kind]
    before, after = text[max(0, start - 24) : start], text[end : end + 8]
    digits = _digits(span)
    m = _LAST_WORD.search(before)
    last = m.group(1).lower().strip("([\"'") if m else ""
    cue = last in _CUES[name]
    other_cue = any(last in words for k, words in _CUES.items() if k != name)
    touches = bool(before[-1:].isalnum() or after[:1].isalnum())
    assigned = before.rstrip()[-1:] in ("=", "#", "/", "_") or before[-1:] in ("-", ".")
    number_near = bool(re.search(r"[0-9][ ,;|]*$", before) or re.match(r"[ ,;|]*[0-9]", after))
    ending = span.rsplit(".", 1)[-1].lower() in _ENDINGS if kind == 0 else False
    groups = [len(g) for g in re.split(r"[^0-9]+", span) if g]
    if kind == 0:
        sound = bool(re.search(r"\.[A-Za-z]{2,}$", span)) or ending
    elif kind == 1:
        sound = span not in ("0.0.0.0", "127.0.0.1") and not span.startswith("0")
    elif kind == 2:
        sound = 14 <= len(digits) <= 19 and _luhn(digits)
    else:
        sound = 9 <= len(digits) <= 15 and groups[-1] >= 3
    date_like = kind == 3 and len(groups) == 3 and sorted(groups) in ([1, 1, 4], [1, 2, 4], [2, 2, 4], [2, 2, 2])
    votes = (
        1 if base else 0,  # strict pattern
        1 if sound else -1,  # check digits, lengths
        1 if cue else (-1 if other_cue else 0),  # gazetteer of cue words
        1 if ending else 0,  # gazetteer of endings
        -1 if touches else 0,  # part of something longer
        -1 if assigned else 0,  # the value of a setting, a path, a decimal
        -1 if number_near else 0,  # in a list of numbers
        -1 if date_like else 0,
    )
    features = (int(base), int(sound), int(cue), int(other_cue), int(ending), int(touches), int(assigned), int(number_near), int(date_like), min(len(digits), 20) // 4, min(len(groups), 6))
    return votes, features


@dataclass
class SpanModel:
    """Reliabilities by kind (labeler x class x answer) and the weights of the span classifier."""

    reliability: dict[int, np.ndarray]
    weights: np.ndarray | None
    threshold: float = 0.5

    def accepts(self, kind: int, features: tuple[int, ...]) -> bool:
        if self.weights is None:
            return False
        return float(1 / (1 + np.exp(-_design(np.array([kind]), np.array([features])) @ self.weights))[0]) >= self.threshold

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """Base spans and accepted loose spans, in order."""
        base = base_spans(text)
        extra = [s for s in loose_spans(text, base) if self.accepts(s[1], evidence(text, *s, False)[1])]
        return sorted(base + extra)


def _design(kinds: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Indicators of kind and of each feature's value, and of the yes/no features by kind."""
    n = len(kinds)
    kind = np.eye(len(KINDS))[kinds]
    flags = features[:, :9].astype(float)
    lengths, groups = np.eye(6)[features[:, 9].clip(0, 5)], np.eye(7)[features[:, 10].clip(0, 6)]
    return np.hstack([np.ones((n, 1)), kind, flags, lengths, groups, (kind[:, :, None] * flags[:, None, :]).reshape(n, -1)])


def _span_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple, int] = {}
    for batch in batches:
        for text in batch.column(0):
            text = text.as_py() or ""
            base = base_spans(text)
            for spans, strict in ((base, True), (loose_spans(text, base), False)):
                for s in spans:
                    votes, features = evidence(text, *s, strict)
                    key = (s[1], *votes, *features)
                    counts[key] = counts.get(key, 0) + 1
    yield pa.RecordBatch.from_arrays([pa.array([list(k) for k in counts], pa.list_(pa.int32())), pa.array(list(counts.values()), pa.int64())], names=["key", "n"])


N_VOTES, N_FEATURES = 8, 11


def fit_span_model(docs: DataFrame) -> SpanModel:
    """EM over the votes on all spans of ``docs`` (text), then the classifier."""
    rows = docs.select("text").mapInArrow(_span_counts, "key array<int>, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").collect()
    if not rows:
        return SpanModel({}, None)
    keys, n = np.array([r["key"] for r in rows]), np.array([r["n"] for r in rows], float)
    kinds, votes, features = keys[:, 0], keys[:, 1 : 1 + N_VOTES], keys[:, 1 + N_VOTES :]
    truth, reliability = np.zeros(len(n)), {}
    for kind in np.unique(kinds):
        of = kinds == kind
        truth[of], reliability[int(kind)] = _expectation_maximisation(votes[of], n[of])
    return SpanModel(reliability, _logistic(_design(kinds, features), truth, n))


def _expectation_maximisation(votes: np.ndarray, n: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each vote pattern marks a true span, and P(answer | class) of the labelers."""
    truth = 1 / (1 + np.exp(-1.5 * votes.sum(axis=1) - 0.5))  # starts from labelers that beat chance
    table = np.zeros((votes.shape[1], 2, 3))
    for _ in range(rounds):
        prior = ((n * truth).sum() + 1) / (n.sum() + 2)
        for j in range(votes.shape[1]):
            for a in (-1, 0, 1):
                hit = n * (votes[:, j] == a)
                # a labeler's answers are smoothed towards beating chance, which keeps the classes from swapping
                table[j, 1, a + 1] = (hit * truth).sum() + (1.0, 1.0, 2.0)[a + 1]
                table[j, 0, a + 1] = (hit * (1 - truth)).sum() + (2.0, 1.0, 1.0)[a + 1]
        table /= table.sum(axis=2, keepdims=True)
        log_odds = np.log(prior / (1 - prior)) + sum(np.log(table[j, 1, votes[:, j] + 1] / table[j, 0, votes[:, j] + 1]) for j in range(votes.shape[1]))
        new = 1 / (1 + np.exp(-log_odds.clip(-50, 50)))
        if np.abs(new - truth).max() < 1e-6:
            return new, table
        truth = new
    return truth, table


def _logistic(x: np.ndarray, truth: np.ndarray, n: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton steps of a ridge logistic regression on probabilistic labels with counts."""
    n = n * min(1.0, 10000 / n.sum())  # the ridge keeps its share whatever the size of the corpus
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (n * (truth - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_personal_data(docs: DataFrame, model: SpanModel) -> DataFrame:
    """The columns of ``docs`` other than text, with the counts of base spans, their digest, and all spans.

    spans_found is an array of (kind, start, end); spans its text form.
    """
    found = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    keep = [f for f in docs.schema.fields if f.name not in ("text", *[f.name for f in found])]
    names, schema = [f.name for f in keep], T.StructType([*keep, *found])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [[] for _ in KINDS], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                for k, c in enumerate(counts):
                    c.append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(model.spans(text)))
            arrays = [batch.column(c) for c in names] + [pa.array(c, pa.int64()) for c in counts] + [pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(*names, "text").mapInArrow(run, schema)


def redacted_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans count as the first."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: SpanModel) -> DataFrame:
    """The rows of ``docs`` with personal data replaced in text; n_chars, if there, follows the new text."""
    lengths = free_name(docs.columns, "length")
    schema = T.StructType([*docs.schema.fields, T.StructField(lengths, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes = [], []
            for text in batch.column("text"):
                text = text.as_py()
                spans = model.spans(text) if text else []
                texts.append(redacted_text(text, spans) if spans else text)
                sizes.append(len(texts[-1]) if spans else None)
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64())], names=schema.names)

    out = docs.mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.col(lengths), "n_chars").cast(docs.schema["n_chars"].dataType))
    return out.drop(lengths)
