import random
from collections import Counter

import numpy as np
import pytest

from tickwell.llm import cover_tree, seed_extend, suffix_dedup, windows


def corpus():
    """Texts that share passages at their starts, ends and middles, overlap themselves, and repeat whole."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)] + ["é", "the"]
    free = lambda n: rng.choices(words, k=n)
    passage, other = free(40), free(25)
    rows = [free(rng.randint(0, 30)) + passage[rng.randint(0, 20) :] + free(rng.randint(0, 30)) for _ in range(25)]
    rows += [free(10) + other + free(10) + other + free(3) for _ in range(4)] + [["the"] * 60, ["the"] * 14, rows[0], rows[0], passage]
    return [(i, " ".join(r) + rng.choice(["", "\n", "  "])) for i, r in enumerate(rows)]


def brute_words(rows, length):
    ids = [(1 << 62 if i is None else i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in ids:
        for at in range(len(w) - length + 1):
            key = tuple(w[at : at + length])
            first[key] = min(first.get(key, i), i)
    made = []
    for i, w in ids:
        gone = [False] * len(w)
        for at in range(len(w) - length + 1):
            if first[tuple(w[at : at + length])] < i:
                gone[at : at + length] = [True] * length
        made.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g)))
    return made


def brute_bytes(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[at : at + length] for _, t in data for at in range(len(t) - length + 1))
    made = []
    for i, t in data:
        gone = bytearray(len(t))
        for at in range(len(t) - length + 1):
            if count[t[at : at + length]] > 1:
                gone[at : at + length] = b"\1" * length
        runs = len([r for r in bytes(gone).split(b"\0") if r])
        made.append((-1 if i is None else i, len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone) if not g)))
    return made


@pytest.mark.parametrize("crowded", [8, 1])
def test_words_against_brute_force(docs, awkward, sha, monkeypatch, crowded):
    monkeypatch.setattr(windows, "CROWDED", crowded)
    rows = [(i + 100, t) for i, t in corpus()] + awkward
    found = seed_extend.dedup(docs(rows), 13, with_text=True).collect()
    expected = sorted((i, n, r, sha(k), k.decode()) for i, n, r, k in brute_words(rows, 13))
    assert sorted((r.doc_id or 1 << 62, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in found) == expected
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in found)
    assert seed_extend.dedup(docs([])).collect() == []


def test_anchor_crowded_in_every_block(docs, sha, monkeypatch):
    monkeypatch.setattr(seed_extend, "BLOCK_BYTES", 1 << 15)
    rng = random.Random(17)
    fresh = lambda n: [f"f{rng.randrange(1 << 40)}" for _ in range(n)]
    rows = []
    for i in range(0, 80, 2):  # a phrase in 30 surroundings of each text; in 10 of them the texts share 14 words
        phrase = fresh(8)
        shared = [fresh(3) + phrase + fresh(3) for _ in range(10)]
        for j in (i, i + 1):
            around = shared + [fresh(3) + phrase + fresh(3) for _ in range(20)]
            rows.append((j, " ".join(w for a in around for w in [*fresh(6), *a, *fresh(6)])))
    found = seed_extend.dedup(docs(rows), 13, with_text=True).collect()
    expected = sorted((i, n, r, sha(k)) for i, n, r, k in brute_words(rows, 13))
    assert sum(r for _, _, r, _ in expected) == 40 * 10 * 14
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == expected


@pytest.mark.parametrize("crowded, contexts", [(8, 1024), (1, 1024), (8, 1), (1, 1)])
def test_bytes_against_brute_force(docs, awkward, sha, monkeypatch, crowded, contexts):
    monkeypatch.setattr(windows, "CROWDED", crowded)
    monkeypatch.setattr(suffix_dedup, "CONTEXTS", contexts)
    rows = [(i + 100, t) for i, t in corpus()] + [r for r in awkward if len(r[1] or "") < 1000]
    found = suffix_dedup.dedup(docs(rows), 50, 12).collect()
    expected = sorted((i, n, r, s, sha(k)) for i, n, r, s, k in brute_bytes(rows, 50))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found) == expected


def test_long_text_and_empty_table(docs, awkward):
    rows = [r for r in awkward if len(r[1] or "") > 1000] * 2
    found = suffix_dedup.dedup(docs(rows), 400, with_kept=True, carry=["source"]).collect()
    assert [(r.n_removed, r.kept, r.rest.source) for r in found] == [(len(rows[0][1]), "", "s")] * 2
    assert suffix_dedup.dedup(docs([])).collect() == []


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(150):
        s = [rng.randint(1, rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 60))] + [0]
        order = suffix_dedup.suffix_array(np.array(s))
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        shared = suffix_dedup.common_prefixes(np.array(s), order, 100)
        for x, y in zip(order[:-1], order[1:]):
            n = 0
            while max(x, y) + n < len(s) and s[x + n] == s[y + n]:
                n += 1
            assert shared[y] == n


@pytest.mark.parametrize("cell", [4096, 16])
def test_vectors_against_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(cover_tree, "CELL", cell)
    rng = np.random.default_rng(6)
    rows = []
    for label in (1, 2):
        for _ in range(12):
            center = rng.normal(size=8)
            rows += [(len(rows) + i, (center + rng.normal(scale=s, size=8)).tolist(), label) for i, s in enumerate((0.05, 0.2, 0.2, 0.4))]
    rows += [(900, rows[0][1], 1), (901, [2 * x for x in rows[0][1]], 1), (902, rows[0][1], 2), (903, rows[0][1], None), (904, None, 1),
             (905, [0.0] * 8, 1), (906, [None] + [1.0] * 7, 1), (907, [float("nan")] * 8, 1), (908, [float("inf")] * 8, 1), (909, [1e200] * 8, 1),
             (910, [1.0] * 8, 1), (911, [1.0] * 3, 1), (912, [], 1), (913, rows[0][1], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    fit = [(i, np.array(e), y) for i, e, y in rows if e and y and None not in e and np.isfinite(e).all() and any(e)]
    unit = {i: (e / np.abs(e).max(), y) for i, e, y in fit}

    def near(a, b):
        (x, s), (z, t) = unit[a], unit[b]
        return a != b and s == t and len(x) == len(z) and x @ z / np.sqrt((x @ x) * (z @ z)) >= 0.93

    links = {i: [j for j in unit if near(i, j)] for i in unit}
    best = {i: i for i, _, _ in rows}
    for _ in rows:
        best = {i: min([best[i]] + [best[j] for j in links.get(i, [])]) for i in best}
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_vectors(table).collect()}
    assert found == {i: (len(links.get(i, [])), best[i], best[i] == i) for i in best}
    assert cover_tree.near_vectors(table.limit(0)).collect() == []
