import hashlib
import re

import numpy as np

from brandflow.llm import pii
from brandflow.llm.queries import QUERIES

PATTERNS = [
    re.compile(p)
    for p in (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )
]


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in p.finditer(text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = (True, k == 1 and all(int(x) <= 255 for x in m.group().split(".")), 14 <= len(d) <= 19 and luhn(d), 10 <= len(d) <= 15)[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_on_tricky_texts():
    rnd = np.random.default_rng(2)
    texts = ["a@b.co@c.de", "@x.y", "a@b", "é.a@b.c-d.e.", "1.2.3.4.5.6.7.8.9", "256.1.1.1 01.002.3.255", "4111 1111 1111 1111", "41111111111111111111111", "+1 (988) 555-2485", "++4912345678901", "+1 2", "1" * 5000, "a." * 3000 + "@", "x" * 3000 + "@y.z"]
    alphabet = list("a1.@+- ()Z_9é0")
    texts += ["".join(rnd.choice(alphabet, 60)) for _ in range(3000)]
    for t in texts:
        assert pii.base_spans(t) == brute(t), t


def test_query_equals_brute_force(spark, docs):
    got = {r["doc_id"]: r for r in QUERIES["op8_personal_data"](spark, "/root/testdata/sf0.001").collect()}
    for r in docs.select("doc_id", "text").collect():
        spans, g = brute(r["text"]), got[r["doc_id"]]
        text = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert [g[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == j for s in spans) for j in range(4)]
        assert g["base_sha256"] == hashlib.sha256(",".join(text).encode()).hexdigest()
        assert set(text) <= set(g["spans"].split(",")) | {""}


def test_loose_spans_are_learned_from_votes(spark):
    """Numbers without a plus after a cue word are accepted, numbers in lists are not."""
    rows = [(k, f"write to john{k}@mail.example.com or phone 212-555-{1000 + k} or tel: +1 212 555 {2000 + k}") for k in range(40)]
    rows += [(100 + k, f"values 12.5 {k} 10-20-30-{k:02d} 40-50-60 7{k:02d} 1.2.3.{k}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit_span_model(docs)
    assert pii.fit_span_model(docs).weights.tolist() == model.weights.tolist()
    text = "my phone 212-555-7777, or x@y.com"
    assert [text[a:b] for a, k, b in model.spans(text)] == ["212-555-7777", "x@y.com"]
    strict = model.reliability[3][0]
    assert strict[1, 2] > strict[0, 2]  # the strict pattern votes more often for true spans
    assert model.spans("values 12.5 3 10-20-30-03 40-50-60 703") == []


def test_odd_rows_and_redaction(odd, empty):
    model = pii.fit_span_model(odd)
    assert pii.find_personal_data(odd.select("doc_id", "text", "spans"), model).count() == odd.count()
    out = pii.redact(odd, model)
    assert out.columns == odd.columns
    key = lambda r: str(r)
    assert sorted(out.collect(), key=key) == sorted(odd.collect(), key=key)  # nothing personal there
    assert pii.redact(empty, pii.fit_span_model(empty)).collect() == []


def test_redaction_replaces_and_counts(spark):
    docs = spark.createDataFrame([(1, "mail a.b@c.example.com now", 26), (2, "call +1 (988) 555-2485", 22)], "doc_id long, text string, n_chars int")
    out = {r["doc_id"]: r for r in pii.redact(docs, pii.fit_span_model(docs)).collect()}
    assert out[1]["text"] == "mail [EMAIL] now" and out[2]["text"] == "call [PHONE]"
    assert out[1]["n_chars"] == 16 and out[2]["n_chars"] == 12
    assert pii.redacted_text("abcdef", [(0, 0, 3), (2, 2, 5)]) == "[EMAIL]f"
