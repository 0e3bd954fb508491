import base64
import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
import tiktoken

from tickwell.llm import byte_bpe, chat_format, decontaminate, hmm_lm, language_id, license_scan
from tickwell.llm.queries import SQL

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_as_the_library_and_back(docs, awkward, tokenizer, sha):
    odd = ["  a", "x\n\n y\x85z\xa0 \x1c q", "don't I'll  ", "a" * 3000, "ab12½ III²  \t\n x", "<|endoftext|>", "\x00\x01", "qwerty" * 30]
    given = awkward + [(100 + i, t) for i, t in enumerate(odd)]
    rows = byte_bpe.code(docs(given), PATH, public_tokenizers.PATTERN, with_ids=True).collect()
    assert len(rows) == len(given)
    for (doc_id, text), row in zip(given, rows):
        ids = tokenizer.encode_ordinary(text or "")
        assert (row.doc_id, row.ids, row.n_tokens) == (doc_id, ids, len(ids))
        assert row.ids_sha256 == sha(" ".join(map(str, ids)))
        assert row.decoded_sha256 == sha(text or "")
    decoded = byte_bpe.decode(byte_bpe.encode(docs(given), PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert [bytes(r.bytes).decode() for r in decoded.collect()] == [t or "" for _, t in given]
    assert byte_bpe.code(docs([]), PATH, public_tokenizers.PATTERN).collect() == []


LANGUAGES = {"xx": "ba be bi bo bu", "yy": "ka ke ki ko ku", "zz": "ša še ši šo šu"}


def language_rows(n):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        lang = rng.choice(list(LANGUAGES))
        parts = LANGUAGES[lang].split()
        rows.append((i, " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(40)), lang))
    return rows


def test_language_held_out_accuracy_and_edge_cases(docs, awkward):
    rows = language_rows(120)
    edge = [(1000 + i, t, None) for i, (_, t) in enumerate(awkward)] + [(2000, "12 !? 34", None), (2001, "ka" * 5000, None)]
    found = {r.doc_id: r for r in language_id.identify(docs(rows + edge)).collect()}
    assert len(found) == len(rows) + len(edge)
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in found)
    assert sum(found[i].lang_pred == lang for i, _, lang in held) / len(held) > 0.95
    assert found[2000].lang_pred == "und" and found[2000].score == 0
    assert found[1000].lang_pred == "und" and found[2001].lang_pred == "yy"
    assert all(0 <= r.score <= 1 for r in found.values())
    assert language_id.identify(docs([])).collect() == []


def test_long_texts_teach_beyond_their_beginning(docs, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_CHARS", 200)
    late = {"aa": "kaka lolo mimi ", "bb": "strx wrnk plpt "}
    rows = [(i, "0 " * 1000 + late[lang] * 400, lang) for i in range(80) for lang in late]
    spark = docs([]).sparkSession
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language_id.train(given)
    found = language_id.predict(docs([(1, "lolo kaka"), (2, "plpt strx")]), net).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {1: "aa", 2: "bb"}


def test_backpropagation_matches_differences():
    net = language_id.Network(["a", "b"], hidden=3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    codes, lengths = np.array([[1, 2, 3], [4, 5, 256]]), np.array([3, 2])
    mask, truth = (np.arange(3) < lengths[:, None]).astype(float), np.array([0, 1])

    def loss():
        p = net.probabilities(codes, mask)[np.arange(2), :, truth]
        return -(np.log(p) * mask).sum() / mask.sum()

    grad = net.gradients(codes, mask, truth)
    for name, at in (("xf", (2, 4)), ("xb", (4, 1)), ("hf", (1, 7)), ("hb", (0, 2)), ("out", (4, 1)), ("bias", (0,))):
        keep = net.w[name][at]
        net.w[name][at] = keep + 1e-4
        above = loss()
        net.w[name][at] = keep - 1e-4
        below = loss()
        net.w[name][at] = keep
        assert abs((above - below) / 2e-4 - grad[name][at]) < 1e-4


def test_hidden_markov_scores(docs, awkward):
    rng = random.Random(4)
    kinds = [["a", "b", "c"], ["x", "y", "z"]]
    rows = [(i + 100, " ".join(rng.choices(kinds[i % 2], k=rng.randint(1, 150)))) for i in range(80)] + awkward
    found = hmm_lm.score(docs(rows)).collect()
    assert len(found) == len(rows)
    end = object()
    tokens = [(i, (t or "").encode().lower().split() + [end]) for i, t in rows]
    learned = [w for i, w in tokens if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(t for w in learned for t in w)
    total, types = sum(c.values()), len(c)
    expected = sorted(
        (i or -1, len(w), sum(c[t] > 0 for t in w), round(sum(np.log10((c[t] + 1) / (total + types + 1)) for t in w), 6)) for i, w in tokens
    )
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == expected
    assert {r.train_tokens for r in found} == {total}
    plain = [r for r in found if r.held_out and r.doc_id and r.doc_id >= 100]
    assert sum(r.score for r in plain) > sum(r.base_score for r in plain)
    assert hmm_lm.score(docs([])).collect() == []


def test_scores_against_plain_recursions_with_emissions_per_word(docs, awkward, monkeypatch):
    monkeypatch.setattr(hmm_lm, "BLOCK_BYTES", 1 << 10)  # several blocks
    rng = random.Random(8)
    rows = [(i + 100, " ".join(rng.choices("abcdefghij"[i % 2 * 5 :][:5], k=rng.randint(0, 90)))) for i in range(60)] + awkward
    given = docs(rows)
    training = given.filter(~hmm_lm.held_out(F.col("doc_id")))
    tokens, distinct = hmm_lm._totals(training)
    model = hmm_lm.train(training, tokens, 3)
    read = [hmm_lm.Tokens([(t or "").encode()]) for _, t in rows]
    emitted, c = {}, Counter()
    for (doc_id, _), found in zip(rows, read):
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2:
            continue
        emit = model.emit[:, found.classes]
        a = [model.start * emit[:, 0]]
        for t in range(1, len(found.classes)):
            a.append((a[-1] / a[-1].sum()) @ model.move * emit[:, t])
        b = np.ones(len(model.start))
        for t in reversed(range(len(found.classes))):
            share = np.rint(a[t] * b / (a[t] * b).sum() * 1024) / 1024
            share[-1] = 1 - share[:-1].sum()
            word = int(found.hashes[t])
            emitted[word] = emitted.get(word, 0) + share
            c[word] += 1
            b = model.move @ (emit[:, t] * b)
            b /= b.sum()
    assert (sum(c.values()), len(c)) == (tokens.sum(), distinct.sum())
    rare = sum(emitted[w] for w in c if c[w] == 1) + 1e-3
    rare /= rare.sum()
    whole = sum(emitted.values()) + (len(c) + 1) * rare
    chance = {w: (g + rare) / whole for w, g in emitted.items()}
    assert np.allclose(sum(chance.values()) + rare / whole, 1)
    expected = []
    for (doc_id, _), found in zip(rows, read):
        state, log = model.start, 0.0
        for t, word in enumerate(found.hashes):
            state = (state @ model.move if t else state) * chance.get(int(word), rare / whole)
            log += np.log10(state.sum())
            state = state / state.sum()
        expected.append((doc_id or -1, len(found.hashes), log))
    made = sorted((r.doc_id or -1, r.n_tokens, r.score) for r in hmm_lm.score(given).collect())
    for row, plain in zip(made, sorted(expected), strict=True):
        assert row[:2] == plain[:2] and row[2] == pytest.approx(plain[2], rel=1e-5)


def test_forward_and_baum_welch_against_plain_recursions():
    rng = np.random.default_rng(0)
    k, c = 3, 5
    model = hmm_lm.Hmm(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(c), k))
    texts = [rng.integers(0, c, n) for n in (1, 2, 64, 65, 200)]
    classes, bounds = np.concatenate(texts), np.append(0, np.cumsum([len(t) for t in texts]))
    logs, total = model.log_likelihood(classes, bounds), np.zeros((k, 1 + k + c))
    for text, log in zip(texts, logs):
        a = [model.start * model.emit[:, text[0]]]
        for o in text[1:]:
            a.append((a[-1] @ model.move) * model.emit[:, o])
        assert np.log(a[-1].sum()) == pytest.approx(log)
        b = [np.ones(k)]
        for o in text[:0:-1]:
            b.insert(0, model.move @ (model.emit[:, o] * b[0]))
        for t, o in enumerate(text):
            share = a[t] * b[t] / a[-1].sum()
            total[:, 1 + k + o] += share
            if t:
                total[:, 1 : 1 + k] += model.move * np.outer(a[t - 1], model.emit[:, o] * b[t]) / a[-1].sum()
            else:
                total[:, 0] += share
    assert np.allclose(model.expected(classes, bounds), total)


def test_chat_examples_and_read_back(spark, sha):
    control = r"\### Assistant: </turn> ok"
    rows = [(1, 0, "system", "s"), (1, 1, "user", control), (1, 2, "assistant", control), (1, 3, "user", "a\nb"), (1, 4, "assistant", ""),
            (1, 5, "user", "tail"), (2, 0, "user", None), (3, 0, "assistant", "only"), (None, 0, "odd: role\\", "x"), (4, 1, "user", "b"), (4, 1, "user", "a"),
            (5, None, None, "é" * 50_000), (5, 2, "assistant", "z")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat_format.examples(table)
    shown = sorted((r for r in made.collect() if r.conv_id == 1), key=lambda r: r.example)
    assert [r.loss_start is None for r in shown] == [False, False, True]
    assert chat_format.unescape(shown[0].text[shown[0].loss_start : shown[0].loss_end]) == control
    assert shown[1].text.startswith(shown[0].text)
    found = {r.conv_id: r for r in chat_format.read_back(made).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        loss = "".join(t for _, role, t in turns if role == "assistant")
        got = found[conv]
        assert (got.n_turns, got.turns_sha256) == (len(turns), sha("".join(f"{role}\n{t}\n" for _, role, t in turns)))
        assert (got.loss_chars, got.loss_sha256) == (len(loss), sha(loss))
        assert got.formatted_chars == sum(len(r.text) for r in made.collect() if r.conv_id == conv)
    assert chat_format.read_back(chat_format.examples(table.limit(0))).collect() == []


def test_license_texts_in_any_spelling(docs, awkward):
    mit = license_scan._MIT.upper().replace("SUBLICENSE", "sub-licence").replace(",", " ;")
    rows = awkward + [
        (20, "Copyright (c) 2020 Somebody\n\n" + mit), (21, "x\nlicensed under the  apache LICENCE version 2.0!\ny"),
        (22, "We are not licensed under the MIT License."), (23, "Released under the MIT License.\nReleased under the MIT License"),
    ]
    table = docs(rows)
    found = sorted(tuple(r) for r in license_scan.scan(table).collect())
    assert found == [(20, "document", "MIT", "permissive", 1), (21, "line", "Apache-2.0", "permissive", 1), (23, "line", "MIT", "permissive", 2)]
    con = duckdb.connect()
    con.register("documents", table.toPandas())
    assert sorted(con.sql(SQL["op6_license_scan"]).fetchall()) == found
    assert license_scan.scan(docs([])).collect() == []


def test_reparameterised_questions(spark, docs, awkward):
    item = "Anna buys 12 apples and 12 pears for 3 dollars each day, how much does Anna spend in a week on fruit?"
    short = "What do seven red foxes eat"
    bench = spark.createDataFrame([(1, item), (2, short), (3, None), (4, "")], "item_id long, text string")
    rows = awkward + [
        (20, "noise here. " + item + " more noise"),
        (21, item.replace("12", "250").replace("Anna", "Bob").replace("3", "7")),
        (22, item.replace("12 apples", "13 apples")),  # two amounts where the question has one
        (23, "Anna buys 12 apples and then goes home to read a book about pears"),
        (24, "what do NINE red foxes eat"), (25, "what do red foxes eat"),
    ]
    found = {(r.doc_id, r.item_id): r.n_windows for r in decontaminate.contaminated(docs(rows), bench).collect()}
    assert {k for k in found if k[0] != 22} == {(20, 1), (21, 1), (24, 2)}
    # A name that begins a sentence cannot be told from a word, so the first window of 21 differs.
    assert found[21, 1] == found[20, 1] - 1 > found.get((22, 1), 0)
    assert decontaminate.contaminated(docs([]), bench).collect() == []
    assert decontaminate.contaminated(docs(rows), bench.limit(0)).collect() == []


def test_verbatim_questions_whatever_their_slots(spark, docs):
    sums, coins = "What is 17 times 24?", "Tom, Ann, Bob, Eve and Max have 3, 5, 7, 9 and 11 coins"
    foxes = "What do seven red foxes eat"
    bench = spark.createDataFrame([(1, sums), (2, coins), (3, foxes), (4, "Who ran?"), (5, "?!")], "item_id long, text string")
    rows = [(1, "so. " + sums), (2, "Then " + sums.lower()), (3, "we know " + coins + " now"), (4, "as we asked " + foxes + " at night"),
            (5, "What is 18 times 24?"), (6, "as we asked who Ran away"), (7, "!! ??"), (8, sums + " And again: " + sums)]
    found = {(r.doc_id, r.item_id): r.n_windows for r in decontaminate.contaminated(docs(rows), bench).collect()}
    assert found == {(1, 1): 1, (2, 1): 1, (3, 2): 5, (4, 3): 1, (6, 4): 1, (8, 1): 2}


def plainly_contaminated(docs, items, window=10):
    """Every window of every text against every window of every item, word by word."""
    import regex

    numbers, units = "|".join(decontaminate.NUMBER_WORDS), "|".join(decontaminate.UNITS)

    def words(text):
        plain = (text or "").replace("^", " ")
        plain = regex.sub(r"([0-9])[.,]([0-9])", r"\1\2", plain)
        plain = regex.sub(r"(^|[.!?:;\n])([^\p{L}\p{N}]*)(\p{Lu})", r"\1\2^\3", plain)
        plain = regex.sub(r"[^\p{L}\p{M}\p{N}^]+", " ", plain).strip(" ")
        shape = regex.sub(rf"(?<![^ ])\^?(?:[0-9][^ ]*|(?i:{numbers})(?![^ ]))", "<num>", plain)
        shape = regex.sub(rf"<num> (?i:{units})(?![^ ])", "<num> <unit>", shape)
        shape = regex.sub(r"(?<![^ ])\p{Lu}[^ ]*", "<name>", shape)
        return plain.lower().replace("^", "").split(" "), shape.lower().replace("^", "").split(" ")

    found = {}
    cut = [(i, *words(t)) for i, t in items]
    for doc_id, text in docs:
        if doc_id is None or text is None:
            continue
        own, shape = words(text)
        for item_id, wanted, pattern in cut:
            n = min(window, len(wanted))
            if wanted == [""]:
                continue
            literal = decontaminate.LITERAL if n == window else decontaminate.SHORT_LITERAL
            for p in range(len(own) - n + 1):
                hits, equal = set(), False
                for q in range(len(wanted) - n + 1):
                    equal |= own[p : p + n] == wanted[q : q + n]
                    if pattern[q : q + n] == shape[p : p + n] and sum(w[0] != "<" for w in pattern[q : q + n]) >= literal:
                        pairs = {(s, i, d) for s, i, d in zip(pattern[q:], wanted[q : q + n], own[p:]) if s[0] == "<"}
                        if len({x[:2] for x in pairs}) == len(pairs):
                            hits.add((tuple(pattern[q : q + n]), tuple(wanted[q : q + n])))
                if hits or equal:
                    found[doc_id, item_id] = found.get((doc_id, item_id), 0) + max(1, len(hits))
    return found


def test_windows_against_a_plain_search(spark, docs):
    import random

    rng = random.Random(4)
    plain = ["red", "fox", "eats", "apples", "and", "goes", "home"]
    slots = ["7", "12", "three", "km", "days", "Tom", "Ann", "What", "Is"]
    marks = ["", "", "", "", ".", "?", ",", ";"]

    def text(n):
        return " ".join(rng.choice(plain if rng.random() < 0.75 else slots) + rng.choice(marks) for _ in range(n))

    items = [(i, text(rng.randint(1, 16))) for i in range(24)] + [(30, None), (31, ""), (32, "?")]
    changed = lambda t: t.replace("7", "9").replace("Tom", "Bob").replace("12", "40")
    rows = [(i, f"{text(rng.randint(0, 12))} {rng.choice([str, changed, str.lower])(rng.choice(items)[1] or '')} {text(rng.randint(0, 12))}") for i in range(60)]
    rows += [(100, None), (101, ""), (None, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for window in (10, 4):
        got = {(r.doc_id, r.item_id): r.n_windows for r in decontaminate.contaminated(docs(rows).filter("doc_id is not null"), bench, window).collect()}
        assert got == plainly_contaminated(rows, items, window)


def test_native_plans_have_no_python(spark, docs, awkward):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id long, text string")
    for df in (license_scan.scan(docs(awkward)), decontaminate.contaminated(docs(awkward), bench)):
        assert not any(n in df._jdf.queryExecution().toString() for n in ("Python", "Pandas", "InArrow"))


def test_licence_files_with_titles_and_at_any_width(spark, docs):
    import textwrap

    rows, expected = [], set()
    for i, (name, category, text) in enumerate(k for k in license_scan.KNOWN if len(k[2]) > 400):
        for j, width in enumerate((40, 60, 72, 80, 1000)):
            body = textwrap.fill(" ".join(text.split()), width)
            for k, head in enumerate(("", f"{name} License\n\n", f"The {name} Licence ({name})\n\nCopyright (c) 2020 Some Body\n\n", "Copyright 2019 A. Uthor\nAll rights reserved.\n\n")):
                rows.append((1000 * i + 10 * j + k, head + body))
                expected.add((rows[-1][0], name))
    found = license_scan.scan(docs(rows)).filter("scope = 'document'").collect()
    assert expected and {(r.doc_id, r.license) for r in found} == expected


def test_known_texts_of_your_own(spark, docs):
    text = F.lit("Do as you wish with this.")
    known = spark.range(1).select(F.sha2(license_scan.canonical(text), 256).alias("digest"), F.lit("own").alias("license"), F.lit("free").alias("category"))
    found = license_scan.scan(docs([(1, "do AS you -- wish\nwith this"), (2, "x\nDo as you wish with this"), (3, "else")]), known)
    assert {(r.doc_id, r.scope) for r in found.collect()} == {(1, "document"), (2, "line")}
