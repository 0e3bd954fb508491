"""Language-model scoring with a hidden Markov model over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.spark import by_blocks, written
from tickwell.llm.text import byte_spans, split_words
from tickwell.llm.windows import parts

# Latent states and rounds of training. All rounds but the last tie the emissions of words that share a class
# (a hash of the word chooses one; the end has its own); the last one gives every word emissions of its own.
STATES = 4
CLASSES = 4096
ROUNDS = 4
BLOCK_BYTES = 24 << 20
_PARTS = 1 << 10  # a token's state shares are whole parts of it: their sums are exact in any order, and short
_PART_BYTES = 2 << 20
_CHUNK = 64  # tokens whose transition products are taken side by side
_ROWS = 8192  # chunks worked on at a time
_END = np.uint64(0)


class Tokens:
    """Word hashes and classes of some texts, each text closed by an end token."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts).lower(), dtype=np.uint8)
        starts, ends = split_words(raw)
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        words = np.diff(np.searchsorted(starts, begins))
        self.counts = words + 1
        self.bounds = np.append(0, np.cumsum(self.counts))
        self.hashes = np.empty(self.bounds[-1], dtype=np.uint64)
        last = np.zeros(len(self.hashes), dtype=bool)
        last[self.bounds[1:] - 1] = True
        self.hashes[last] = _END
        self.hashes[~last] = byte_spans(raw, 29).of(starts, ends) | np.uint64(1)
        self.classes = np.where(last, CLASSES, (self.hashes >> np.uint64(40)) % np.uint64(CLASSES)).astype(np.int64)


def word_class(h: Column) -> Column:
    """The class of a word hash, as Tokens has it."""
    return F.when(h == 0, F.lit(CLASSES)).otherwise(F.shiftrightunsigned(h, 40) % CLASSES)


class Hmm:
    """Start, transition and class emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit
        self.by_class = np.ascontiguousarray(emit.T)

    @classmethod
    def initial(cls, totals: np.ndarray, states: int = STATES, seed: int = 5) -> Hmm:
        """Sticky states whose emissions are the class totals, each unsettled by fixed noise."""
        rng = np.random.default_rng(seed)
        emit = (totals + 1) * np.exp(rng.normal(0, 0.5, (states, len(totals))))
        move = np.full((states, states), 0.05 / max(1, states - 1))
        np.fill_diagonal(move, 0.95)
        return cls(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    def next(self, counts: np.ndarray) -> Hmm:
        """Re-estimated from expected counts (states x [start, moves, emissions]), each count raised a little."""
        k = len(self.start)
        start, move, emit = counts[:, 0] + 0.1, counts[:, 1 : k + 1] + 0.1, counts[:, k + 1 :] + 0.01
        return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    def _chunks(self, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, lengths and texts of the chunks, and of each text its first chunk, the end added."""
        number = -(-np.diff(bounds) // _CHUNK)
        first = np.append(0, np.cumsum(number))
        text = np.repeat(np.arange(len(number)), number)
        starts = bounds[text] + (np.arange(first[-1]) - first[text]) * _CHUNK
        return starts, np.minimum(_CHUNK, bounds[text + 1] - starts), text, first

    def _products(self, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, opening: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each chunk the product of its steps, scaled, and the log of the scale."""
        k = len(self.start)
        products, scales = np.empty((len(starts), k, k)), np.zeros(len(starts))
        for at in range(0, len(starts), _ROWS):
            order = at + np.argsort(-lengths[at : at + _ROWS], kind="stable")
            long, begin, head = lengths[order], starts[order], opening[order]
            x, log = np.tile(np.eye(k), (len(order), 1, 1)), np.zeros(len(order))
            for t in range(int(long[0])):
                n = int(np.searchsorted(-long, -t, side="left"))  # rows with more than t tokens
                moved = (x[:n].reshape(-1, k) @ self.move).reshape(n, k, k)
                if t == 0:
                    moved[head[:n]] = x[:n][head[:n]]
                x[:n] = moved * self.by_class[classes[begin[:n] + t]][:, None, :]
                if t % 16 == 15 or t == long[0] - 1:
                    top = x.max((1, 2))
                    x /= top[:, None, None]
                    log += np.log(top)
            products[order], scales[order] = x, log
        return products, scales

    def _ahead(self, products: np.ndarray, first: np.ndarray, scales: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """State weights before each chunk, and of each text the log likelihood."""
        number = np.diff(first)
        order = np.argsort(-number, kind="stable")
        v, log = np.tile(self.start, (len(number), 1)), np.zeros(len(number))
        before = np.empty((len(products), len(self.start)))
        for j in range(int(number.max(initial=0))):
            n = int(np.searchsorted(-number[order], -j, side="left"))
            row = first[order[:n]] + j
            before[row] = v[:n]
            v[:n] = np.einsum("nk,nkl->nl", v[:n], products[row])
            total = v[:n].sum(1)
            v[:n] /= total[:, None]
            log[:n] += np.log(total) + (scales[row] if scales is not None else 0)
        made = np.empty(len(number))
        made[order] = log
        return before, made

    def _behind(self, products: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Weights of what follows each chunk."""
        number = np.diff(first)
        order = np.argsort(-number, kind="stable")
        v = np.ones((len(number), len(self.start)))
        after = np.empty((len(products), len(self.start)))
        for j in range(int(number.max(initial=0))):
            n = int(np.searchsorted(-number[order], -j, side="left"))
            row = first[order[:n] + 1] - 1 - j
            after[row] = v[:n]
            v[:n] = np.einsum("nkl,nl->nk", products[row], v[:n])
            v[:n] /= v[:n].sum(1, keepdims=True)
        return after

    def log_likelihood(self, classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Natural logs of the probabilities of the texts' class sequences, by the scaled forward recursion."""
        starts, lengths, text, first = self._chunks(bounds)
        products, scales = self._products(classes, starts, lengths, starts == bounds[text])
        return self._ahead(products, first, scales)[1]

    def expected(self, classes: np.ndarray, bounds: np.ndarray, shares: np.ndarray | None = None) -> np.ndarray:
        """Expected counts of starts, moves and emissions over the texts (states x [1 + states + classes]).

        shares (tokens x states), if given, receives each token's state probabilities.
        """
        k = len(self.start)
        counts = np.zeros((k, 1 + k + self.emit.shape[1]))
        starts, lengths, text, first = self._chunks(bounds)
        opening = starts == bounds[text]
        products, _ = self._products(classes, starts, lengths, opening)
        before, after = self._ahead(products, first, None)[0], self._behind(products, first)
        for at in range(0, len(starts), _ROWS):
            order = at + np.argsort(-lengths[at : at + _ROWS], kind="stable")
            long, begin, head = lengths[order], starts[order], opening[order]
            most = int(long[0])
            live = [int(np.searchsorted(-long, -t, side="left")) for t in range(most)]
            alpha, state = [], before[order]
            seen = [classes[begin[: live[t]] + t] for t in range(most)]
            for t, n in enumerate(live):
                moved = state[:n] @ self.move
                if t == 0:
                    moved[head] = state[head]
                state = moved * self.by_class[seen[t]]
                state /= state.sum(1, keepdims=True)
                alpha.append(state)
            beta = after[order]
            for t in range(most - 1, -1, -1):
                n = live[t]
                share = alpha[t] * beta[:n]
                share /= share.sum(1, keepdims=True)
                if shares is not None:
                    shares[begin[:n] + t] = share
                for s in range(k):
                    counts[s, 1 + k :] += np.bincount(seen[t], share[:, s], self.emit.shape[1])
                ahead = beta[:n] * self.by_class[seen[t]]
                previous = alpha[t - 1][:n] if t else before[order]
                if t == 0:
                    counts[:, 0] += share[head].sum(0)
                    previous, ahead = previous[~head], ahead[~head]
                total = ((previous @ self.move) * ahead).sum(1, keepdims=True)
                counts[:, 1 : 1 + k] += self.move * (previous.T @ (ahead / total))
                if t:
                    beta[:n] = ahead @ self.move.T
                    beta[:n] /= beta[:n].sum(1, keepdims=True)
        return counts


def held_out(doc_id: Column, fold: int = 2, folds: int = 7) -> Column:
    """crc32 of the id as text, modulo folds, is the fold; a row without id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def _encoded(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [(t or "").encode() for t in batch.column(column).to_pylist()]


def _totals(training: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Per class, the tokens and the distinct words of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

        for batch in batches:
            texts = _encoded(batch, 0)
            for part in parts(texts, _PART_BYTES):
                held.append(Tokens(texts[part]).hashes)
                size += len(held[-1])
                if size > 1 << 22:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    words = training.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = words.groupBy(word_class(F.col("h")).alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    tokens, distinct = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for r in rows:
        tokens[r.c], distinct[r.c] = r.n, r.v
    return tokens, distinct


def train(training: DataFrame, tokens: np.ndarray, rounds: int = ROUNDS) -> Hmm:
    """Baum-Welch over all training texts: each round's expected counts are summed across partitions.

    What returns to the driver is one table of STATES * (1 + STATES + CLASSES + 1) numbers a round.
    """
    model = Hmm.initial(tokens)
    width = 1 + STATES + CLASSES + 1

    def expect(model: Hmm):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros((STATES, width))
            for batch in batches:
                texts = _encoded(batch, 0)
                for part in parts(texts, _PART_BYTES):
                    tokens = Tokens(texts[part])
                    counts += model.expected(tokens.classes, tokens.bounds)
            flat = counts.ravel()
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(flat[at])], ["i", "n"])

        return run

    for _ in range(rounds):
        rows = training.select("text").mapInArrow(expect(model), "i int, n double").groupBy("i").agg(F.sum("n").alias("n")).collect()
        counts = np.zeros(STATES * width)
        for r in rows:
            counts[r.i] = r.n
        model = model.next(counts.reshape(STATES, width))
    return model


def _summed(block: np.ndarray, h: np.ndarray, n: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, ...]:
    """Counts and state shares added up per block and word."""
    order = np.lexsort((h, block))
    block, h = block[order], h[order]
    starts = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (h[1:] != h[:-1])))
    return block[starts], h[starts], np.add.reduceat(n[order], starts), np.add.reduceat(shares[order], starts, axis=0)


def _block_words(blocked: DataFrame, model: Hmm) -> DataFrame:
    """(block, h, n, g0, g1, ...): per block and distinct word its training tokens and how many of them, in _PARTS of a
    token, each state but the last is expected to emit."""
    states = [f"g{s}" for s in range(STATES - 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def made() -> pa.RecordBatch:
            block, h, n, shares = _summed(*(np.concatenate(c) for c in zip(*held)))
            columns = [block, h.view(np.int64), n, *shares.T]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["block", "h", "n", *states])

        for batch in batches:
            texts, blocks = _encoded(batch, 1), batch.column(0).to_numpy()
            learn = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            for part in parts(texts, _PART_BYTES):
                found = Tokens(texts[part])
                counted = np.repeat(learn[part], found.counts)
                shares = np.zeros((len(found.hashes), STATES))
                model.expected(found.classes, found.bounds, shares)
                whole = np.rint(shares[:, :-1] * _PARTS).astype(np.int64) * counted[:, None]
                held.append(_summed(np.repeat(blocks[part], found.counts), found.hashes, counted, whole))
                size += len(held[-1][0])
                if size > 1 << 20:
                    yield made()
                    held, size = [], 0
        if held:
            yield made()

    schema = "block long, h long, n long, " + ", ".join(f"{g} long" for g in states)
    return blocked.select("block", "text", "learn").mapInArrow(run, schema)


def score(docs: DataFrame, id_col="doc_id", text_col="text", rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row's whole text.

    Tokens are the words, A-Z lower-cased, and one end; null is empty. c, N and V count tokens of
    the rows that are not held out. base_score sums log10((c + 1) / (N + V + 1)). score is the log10 of the
    text's probability, summed over all state paths, where state s emits a word with
    (g + r) / (G + (V + 1) r): g is how many of the word's c tokens the state is expected to emit, G their sum
    over all words, and r the state's share of the tokens of words seen once, which stand for unseen words (of
    which one counts as a word, with g = 0). With a single state that is the base.

    All rounds of training but the last tie words of a class, so that the model is small enough to send around. The
    last gathers g for every word of the training texts: a table of a row per word that grows with the vocabulary
    and never passes the driver. It returns to the texts by blocks: each block sends its distinct words once, gets
    their rows back, and meets them in one task. Words are told apart by 64-bit hashes. Repeated rows and ids are
    scored each by its own text; a row without id is not held out; an empty table gives no rows.
    """
    doc_id, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    training = docs.filter(~held_out(doc_id)).select(text.alias("text"))
    tokens, distinct = _totals(training)
    model = train(training, tokens, rounds - 1)
    total, types = int(tokens.sum()), int(distinct.sum())
    base = float(np.log10(total + types + 1))
    blocked = by_blocks(docs, id_col, text_col, BLOCK_BYTES)
    states = [f"g{s}" for s in range(STATES - 1)]
    given = written(_block_words(blocked.withColumn("learn", ~held_out(F.col("doc_id"))), model), "hmm-blocks")
    summed = given.filter("n > 0").groupBy("h").agg(F.sum("n").alias("c"), *[F.sum(g).alias(g) for g in states])
    words = written(summed, "hmm-words")

    def spread(c: np.ndarray, *parts: np.ndarray) -> np.ndarray:
        """Expected tokens (states x words); the last state has what the others leave."""
        g = np.array(parts, dtype=float).reshape(STATES - 1, -1) / _PARTS
        return np.maximum(np.vstack([g, c - g.sum(0)]), 0)

    def added(*columns: Column) -> list[Column]:
        return [F.coalesce(F.sum(c.cast("double")), F.lit(0.0)) for c in columns]

    seen = [F.col(c) for c in ("c", *states)]
    sums = words.agg(*added(*seen), *added(*[F.when(F.col("c") == 1, c) for c in seen])).first()
    whole, rare = spread(*sums[:STATES])[:, 0], spread(*sums[STATES:])[:, 0] + 1e-3
    rare /= rare.sum()
    # Emissions relative to the base: the base's part of a text's probability is summed apart.
    factor = (total + types + 1) / (whole + (types + 1) * rare)
    counts = given.select("block", "h").join(words, "h")

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        h = right["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        h = np.append(h[order], np.uint64(0))  # the last row is any unseen word
        c = np.append(right["c"].to_numpy()[order], 0)
        g = spread(c, *[np.append(right[name].to_numpy()[order], 0) for name in states])
        own = Hmm(model.start, model.move, (g + rare[:, None]) * factor[:, None] / (c + 1.0))
        logs = np.log10(c + 1.0) - base
        made: list[list[np.ndarray]] = [[], [], [], []]
        texts = [(t or "").encode() for t in left["text"].to_pylist()]
        for part in parts(texts, _PART_BYTES):
            found = Tokens(texts[part])
            row = np.searchsorted(h[:-1], found.hashes)
            row = np.where(h[row] == found.hashes, row, len(h) - 1)
            at = found.bounds[:-1]
            known = np.add.reduceat((c[row] > 0).astype(np.int64), at)
            plain = np.add.reduceat(logs[row], at)
            likely = plain + own.log_likelihood(row, found.bounds) / np.log(10)
            for column, values in zip(made, (found.counts, known, plain, likely)):
                column.append(values)
        n_tokens, n_known, plain, likely = (np.concatenate(m) if m else np.zeros(0) for m in made)
        return pa.table(
            {
                "doc_id": left["doc_id"],
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "train_tokens": pa.array(np.full(len(n_tokens), total), pa.int64()),
                "base_score": pa.array(plain, pa.float64()),
                "score": pa.array(likely, pa.float64()),
            }
        )

    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    texts = blocked.select("block", "doc_id", "text")
    rated = texts.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(rate, schema)
    return rated.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
