"""Held-out accuracy of the toxicity query on the given tables."""

from brandflow.llm.queries import QUERIES


def test_query_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op3_toxicity"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    toxic = [r for r in rows if labels[r["doc_id"]] == 1]
    clean = [r for r in rows if labels[r["doc_id"]] == 0]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    # some documents are labelled toxic without a toxic word in them
    assert sum(r["predicted"] for r in toxic) >= 0.6 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
