import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickwell.llm import simhash


def brute_fingerprint(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(items, near):
    """items: (id, value); the smallest id reachable over near()."""
    best = {i: i for i, _ in items}
    while True:
        now = {a: min([best[a]] + [best[b] for b, y in items if near(x, y)]) for a, x in items}
        if now == best:
            return best
        best = now


def test_fingerprints_and_components(docs, awkward):
    rows = simhash.near_duplicates(docs(awkward)).collect()
    assert len(rows) == len(awkward)
    own = sorted((r.doc_id or -1, r.fingerprint) for r in rows)
    assert own == sorted((i or -1, format(brute_fingerprint(t), "016x")) for i, t in awkward)
    named = [(i, brute_fingerprint(t)) for i, t in dict(r for r in awkward if r[0] is not None).items()]
    expected = brute_components(named, lambda x, y: (x ^ y).bit_count() <= 4)
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == expected
    assert all(r.component_id is None for r in rows if r.doc_id is None)


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).collect() == []


@pytest.mark.parametrize("hot, four, three", [(4096, 1 << 22, 1 << 25), (6, 1 << 22, 1 << 25), (4096, 0, 1 << 25), (4096, 0, 0)])
def test_any_segments_link_alike(spark, monkeypatch, hot, four, three):
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    monkeypatch.setattr(simhash, "FOUR_SEGMENTS", four)
    monkeypatch.setattr(simhash, "THREE_SEGMENTS", three)
    rng = np.random.default_rng(3)
    made = set()
    for base in rng.integers(-(2**62), 2**62, 4):
        for _ in range(30):
            x = int(base) & (1 << 64) - 1
            for bit in rng.choice(64, rng.integers(0, 6), replace=False):
                x ^= 1 << int(bit)
            made.add(x)
    items = list(enumerate(sorted(made)))
    nodes = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in items], "node long, fp long")
    got = {i: i for i, _ in items} | {r.node: r.component for r in simhash.link(nodes, "fp", 4).collect()}
    assert got == brute_components(items, lambda x, y: (x ^ y).bit_count() <= 4)


def test_carried_columns_and_repeated_ids(docs):
    texts = [(1, "a b c d e f"), (1, "wholly other words stand here now"), (2, "A b c d e f"), (2, "A b c d e f"), (None, "a b c d e f")]
    rows = simhash.near_duplicates(docs(texts), carry=["text", "fp"]).select("doc_id", "component_id", F.col("rest.text").alias("text"), "rest.fp")
    assert sorted((r.doc_id or 0, r.component_id or 0, r.text, r.fp) for r in rows.collect()) == sorted(
        (i or 0, 1 if i else 0, t, 2) for i, t in texts
    )
