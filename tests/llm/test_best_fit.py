"""Bin completion against exhaustive search, and packing on Spark against the tokenizer itself."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tickwell.llm import best_fit

PATH = public_tokenizers.path("word_bpe_49k.json")


def count(lengths, limit):
    return np.bincount(lengths, minlength=limit + 1) if lengths else np.zeros(limit + 1, dtype=np.int64)


def sequences(packing, counts):
    """How many sequences a packing takes; it must hold each piece once and nothing too long."""
    held = Counter()
    for copies, need in packing:
        assert copies > 0 and sum(length * n for length, n in need.items()) < len(counts)
        for length, n in need.items():
            held[length] += copies * n
    assert [held[i] for i in range(1, len(counts))] == list(counts[1:])
    return sum(copies for copies, _ in packing)


def fewest(lengths, limit):
    best, bins = [len(lengths)], []

    def go(i):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k, held in enumerate(bins):
            if held + lengths[i] <= limit and held not in bins[:k]:
                bins[k] += lengths[i]
                go(i + 1)
                bins[k] -= lengths[i]
        bins.append(lengths[i])
        go(i + 1)
        bins.pop()

    lengths = sorted(lengths, reverse=True)
    go(0)
    return best[0]


def test_small_sets_take_the_fewest_sequences():
    rng = random.Random(5)
    better = 0
    for trial in range(150):
        limit = rng.choice([17, 50, 100])
        low, high = (1, limit) if trial % 2 else (limit // 5, limit // 2)
        lengths = [rng.randint(low, high) for _ in range(rng.randint(0, 11))]
        counts = count(lengths, limit)
        found = sequences(best_fit.plan(counts), counts)
        assert best_fit.least_sequences(counts) <= found == fewest(lengths, limit)
        better += found < sequences(best_fit.best_fit(counts), counts)
    assert better  # the search betters what it starts from


def test_many_pieces_stay_near_the_bound():
    counts = count(np.random.default_rng(2).integers(1, 2048, 100_000).tolist(), 2048)
    found = sequences(best_fit.plan(counts, steps=1000), counts)
    assert found <= 1.001 * best_fit.least_sequences(counts)
    grown = sequences(best_fit.plan(counts * 1000, steps=1000), counts * 1000)
    assert grown <= 1000 * found


def packed(spark_docs, **options):
    return [r.asDict() for r in best_fit.pack(spark_docs, PATH, **options).collect()]


def check(rows, texts, limit):
    """Pieces against the tokenizer, and the places of every sequence."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    expected = Counter()
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), limit)):
            part = ids[start : start + limit]
            expected[doc_id, piece, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= limit
    return len(by)


ODD = [
    (20, "It's 3 o'clock; don't  we'll\tsay\n\n'twas?"), (21, "a <|endoftext|> b<|startoftext|>"), (22, "É İstanbul Σίσυφος ΣΑΣ x y\x1cz"),
    (23, "é ́a ẛ̣ K ﬁ ① 한국어 한국"), (24, "日本語のテキスト 12345 !!!--??"), (25, "x" * 3000), (26, "\x00 a\x07b"),
]


def test_pieces_and_places(spark, docs, awkward):
    texts = [*awkward, *ODD, *((100 + i, f"word{i} " * (i % 40)) for i in range(120))]
    for limit in (2048, 64):
        rows = packed(docs(texts).repartition(5), limit=limit)
        n = check(rows, texts, limit)
        counts = count([r["length"] for r in rows], limit)
        assert n == sequences(best_fit.plan(counts), counts) <= 1 + 1.02 * best_fit.least_sequences(counts)


def test_ids_and_empty_tables(spark, docs):
    rows = packed(docs([(1, "the cat sat"), (2, None)]), with_ids=True)
    assert sorted((r["doc_id"], len(r["ids"]), r["ids"][-1]) for r in rows) == [(1, 4, 0), (2, 1, 0)]
    assert len({r["sequence_id"] for r in rows}) == 1
    assert packed(docs([(1, "x")]).limit(0)) == []


@pytest.mark.parametrize("name", ["sf0.001"])
def test_query(spark, name):
    from tickwell.llm.queries import QUERIES

    folder = f"/root/testdata/{name}"
    rows = [r.asDict() for r in QUERIES["op13_best_fit"](spark, folder).collect()]
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    n = check(rows, texts, 2048)
    assert n <= 1 + 1.01 * best_fit.least_sequences(count([r["length"] for r in rows], 2048))


def test_words_part_and_shrink_where_the_tokenizer_does():
    """Case and punctuation make no new words, and ids stay those of the tokenizer, marks and contractions included."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    words, runs, ends = best_fit._words_of(pa.array(["Fox, fox. FOX", "fox's fox"], pa.large_string()))
    assert sorted(words.to_pylist()) == ["'s", ",", ".", "fox"]
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    rng = random.Random(3)
    parts = ["H̱", "İ", "å", "A", "Q", "'S", "'re", "'LL", "don't", ".", "###", "≠", "…", "\x01", "\x00", "7", "١", "\xdf", "\xc9", "Σ", "\xa0", " ", "\t", "<|endoftext|>", "<unk>", "漢", "\U0001f600", "x", "fox"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(4000)]
    ids, bounds = best_fit._Coder(PATH).ids(pa.array(texts, pa.large_string()), 0)
    for text, a, b in zip(texts, bounds.tolist(), bounds[1:].tolist()):
        assert ids[a:b].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0], repr(text)
