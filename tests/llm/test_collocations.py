"""Phrase streams against counting every phrase by its words, and against SQL."""

import random
import re
from collections import Counter

import oracle
import pytest

from tickwell.llm import collocations as C


def plain(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) by counting all phrases in dictionaries."""
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        own = counts.setdefault(lang or "und", Counter())
        lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            own.update(tuple(words[i : i + k]) for i in range(len(words)) for k in range(1, 6) if i + k <= len(words))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        within = {p[i : i + k] for p, a in often.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if f[p[i : i + k]] == a}
        found = []
        for p, a in often.items():
            if p not in within:
                cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], totals[lang], score))
        found.sort()
        out += [(lang, i, row[2].decode(), *row[3:]) for i, row in enumerate(found[:top], 1)]
    return sorted(out)


def made(df):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert df.columns == columns
    return sorted(tuple(r) for r in df.collect())


def texts(n, seed):
    rng = random.Random(seed)
    words = ["a", "The", "b\x01", "b", "c-d", "é", "fox", "in", "of", "漢字", "x" * 40, "\x00", "A\xa0b"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for i in range(n):
        chosen = rng.choices(words, weights, k=rng.randint(0, 60))
        gaps = rng.choices([" ", "\t", "  ", ". ", ",", "\n", "\x0b", "!?"], [12, 2, 2, 1, 1, 1, 0.3, 0.3], k=60)
        rows.append((i, "".join(w + g for w, g in zip(chosen, gaps)), rng.choice(["en", "en", "en", "fr", None])))
    return rows


@pytest.mark.parametrize("least,top", [(3, 2000), (7, 25), (1, 10_000)])
def test_against_dictionaries(spark, docs, least, top):
    rows = texts(120, least) + [(None, "of the fox in the", "en"), (5, None, None), (6, "", "de"), (6, " \n", "de")]
    rows += [(900, "hot passage of seven words in here. " * 300, "en")] * 3
    assert made(C.collocations(docs(rows).repartition(9), least, top)) == plain(rows, least, top)


def test_blocks_and_ranges_change_nothing(spark, docs, monkeypatch):
    rows = texts(150, 8)
    monkeypatch.setattr(C, "_BATCH_BYTES", 2000)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert made(C.collocations(docs(rows), 4, 500)) == plain(rows, 4, 500)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_awkward_texts(spark, docs, awkward):
    rows = [(i, t, "en") for i, t in awkward]
    assert made(C.collocations(docs(awkward), 2)) == plain(rows, 2, 2000)
    assert made(C.collocations(docs(awkward).limit(0))) == []


def test_query_equals_its_sql(spark):
    from tickwell.llm.queries import QUERIES, SQL

    folder = "/root/testdata/sf0.01"
    assert oracle.compare(QUERIES["op11_collocations"](spark, folder), oracle.connect(folder), SQL["op11_collocations"]) is None
