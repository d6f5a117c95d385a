import hashlib
import re

from brandflow.llm import oph


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else ({tuple(w)} if w else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edits_and_likeness(docs):
    rows = sorted([(r["doc_id"], r["text"] or "") for r in docs.collect()], reverse=True)
    got = {r["doc_id"]: r for r in oph.edited_fingerprints(docs).collect()}
    errors, prints = [], {}
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(text) // 3
        edited, g = text[: len(text) - n] + after[:n], got[i]
        assert (g["n_chars"], g["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        errors += [abs(g["near_edited"] - likeness(shingles(text), shingles(edited))), abs(g["near_next"] - likeness(shingles(text), shingles(after)))]
        assert prints.setdefault(text, g["fingerprint"]) == g["fingerprint"]
        assert prints.setdefault(edited, g["edited_fingerprint"]) == g["edited_fingerprint"]
    assert max(errors) < 0.16 and sum(errors) / len(errors) < 0.03
    assert {len(p) for p in prints.values()} <= {0, 2 * oph.BINS}


def test_odd_rows(odd, empty):
    got = oph.edited_fingerprints(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert by[1][0] == by[1][1]  # repeated rows repeat
    assert by[2][0]["fingerprint"] == by[3][0]["fingerprint"] == "" and by[3][0]["near_next"] == 1.0
    assert by[5][0]["n_chars"] > 300_000
    assert oph.edited_fingerprints(empty).collect() == []


def test_a_single_row_follows_itself(spark):
    r = oph.edited_fingerprints(spark.createDataFrame([(9, "a b c d e f")], "doc_id long, text string")).first()
    assert r["edited_sha256"] == hashlib.sha256(b"a b c d a b").hexdigest() and r["near_next"] == 1.0


def test_small_changes_of_short_texts(spark):
    """Sparse sketches: nearly all bins are filled by densification."""
    rows = [(k, " ".join(f"w{(k // 2) * 50 + j}" for j in range(20 + k % 2))) for k in range(40)]
    prints = {r["doc_id"]: r for r in oph.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    pairs = lambda p: re.findall("..", p)
    same = [sum(a == b for a, b in zip(pairs(prints[k]["fingerprint"]), pairs(prints[k + 1]["fingerprint"]))) / oph.BINS for k in range(0, 40, 2)]
    assert abs(sum(same) / len(same) - 16 / 17) < 0.05
