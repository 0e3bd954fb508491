"""Language identification with a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.text import byte_spans, give_back, normal_words, start_afresh

# The network reads one sequence per run of non-space bytes; longer runs continue in further sequences.
PIECE = 32
SAMPLE_PER_LABEL = 300
SAMPLE_CHARS = 20_000
_TEXT_BYTES = 2 << 20
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Bytes to hidden states in both directions to label probabilities at every position."""

    def __init__(self, labels: list[str], hidden: int = 16, seed: int = 1):
        rng = np.random.default_rng(seed)
        k = len(labels)
        self.labels, self.hidden = labels, hidden
        scale = 1 / np.sqrt(hidden)
        self.w = {}
        for way in "fb":  # input table (gates z, r and the candidate), recurrent weights
            self.w[f"x{way}"] = rng.normal(0, 0.3, (257, 3 * hidden)).astype(np.float32)
            self.w[f"h{way}"] = rng.normal(0, scale, (hidden, 3 * hidden)).astype(np.float32)
        self.w["out"] = rng.normal(0, scale, (2 * hidden, k)).astype(np.float32)
        self.w["bias"] = np.zeros(k, dtype=np.float32)

    def _pass(self, way: str, codes: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states (rows, time, hidden); a masked position leaves the state as it is."""
        n, time = codes.shape
        size = self.hidden
        state = np.zeros((n, size), dtype=np.float32)
        states = np.empty((n, time, size), dtype=np.float32)
        tape = []
        recurrent = self.w[f"h{way}"]
        for t in range(time) if way == "f" else range(time - 1, -1, -1):
            given = self.w[f"x{way}"][codes[:, t]]
            gates = _sigmoid(given[:, : 2 * size] + state @ recurrent[:, : 2 * size])
            z, r = gates[:, :size], gates[:, size:]
            new = np.tanh(given[:, 2 * size :] + (r * state) @ recurrent[:, 2 * size :])
            live = mask[:, t : t + 1]
            following = state + live * z * (new - state)
            if keep:
                tape.append((t, state, z, r, new, live))
            state = following
            states[:, t] = state
        return states, tape

    def probabilities(self, codes: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._pass(way, codes, mask, False)[0] for way in "fb"], axis=2)
        scores = both @ self.w["out"] + self.w["bias"]
        scores = np.exp(scores - scores.max(2, keepdims=True))
        return scores / scores.sum(2, keepdims=True)

    def gradients(self, codes: np.ndarray, mask: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over positions, by backpropagation through time."""
        size = self.hidden
        passes = {way: self._pass(way, codes, mask, True) for way in "fb"}
        both = np.concatenate([passes[way][0] for way in "fb"], axis=2)
        scores = both @ self.w["out"] + self.w["bias"]
        scores = np.exp(scores - scores.max(2, keepdims=True))
        error = scores / scores.sum(2, keepdims=True)
        np.put_along_axis(error, truth[:, None, None], np.take_along_axis(error, truth[:, None, None], 2) - 1, 2)
        error *= (mask / mask.sum())[:, :, None]
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        flat = error.reshape(-1, error.shape[2])
        grad["out"], grad["bias"] = both.reshape(-1, 2 * size).T @ flat, flat.sum(0)
        back = error @ self.w["out"].T
        for way, part in (("f", back[:, :, :size]), ("b", back[:, :, size:])):
            recurrent = self.w[f"h{way}"]
            above = np.zeros((len(codes), size), dtype=np.float32)
            for t, state, z, r, new, live in reversed(passes[way][1]):
                above = above + part[:, t]
                d_new = above * live * z * (1 - new * new)
                d_reset = d_new @ recurrent[:, 2 * size :].T
                d_z = above * live * (new - state) * z * (1 - z)
                d_r = d_reset * state * r * (1 - r)
                gates = np.concatenate([d_z, d_r, d_new], axis=1)
                np.add.at(grad[f"x{way}"], codes[:, t], gates)
                grad[f"h{way}"][:, : 2 * size] += state.T @ gates[:, : 2 * size]
                grad[f"h{way}"][:, 2 * size :] += (r * state).T @ d_new
                above = above * (1 - live * z) + d_reset * r + gates[:, : 2 * size] @ recurrent[:, : 2 * size].T
        return grad

    def fit(self, codes: np.ndarray, lengths: np.ndarray, truth: np.ndarray, weights: np.ndarray, steps=350, rows=384, seed=2) -> None:
        """Adam on batches drawn by weight; the rate falls to a tenth over the run."""
        rng = np.random.default_rng(seed)
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.w.items()}
        chance = weights / weights.sum()
        for step in range(1, steps + 1):
            pick = rng.choice(len(codes), rows, p=chance)
            longest = int(lengths[pick].max())
            mask = (np.arange(longest) < lengths[pick, None]).astype(np.float32)
            grad = self.gradients(codes[pick, :longest], mask, truth[pick])
            rate = 0.02 * (1 - 0.9 * step / steps)
            for k, g in grad.items():
                first, second = moment[k]
                first += 0.1 * (g - first)
                second += 0.001 * (g * g - second)
                self.w[k] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-7)


def pieces(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sequences of a text: bytes, starts and ends, none longer than PIECE."""
    kept, starts, ends = normal_words(data)
    counts = -(-(ends - starts) // PIECE)
    if len(counts) and counts.max() > 1:
        first = np.repeat(starts, counts)
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        ends = np.minimum(np.repeat(ends, counts), first + (place + 1) * PIECE)
        starts = first + place * PIECE
    return kept, starts, ends


def _padded(kept: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, lengths): a row per sequence, 256 after its end."""
    lengths = ends - starts
    place = np.arange(int(lengths.max()))
    codes = kept[np.minimum(starts[:, None] + place, len(kept) - 1)].astype(np.int16)
    codes[place >= lengths[:, None]] = 256
    return codes, lengths


def has_letter(text: str | None) -> bool:
    """Whether any character of the text is a letter of any script."""
    return text is not None and any(map(str.isalpha, text))


class Pooled:
    """Label probabilities pooled over the letter positions of texts; equal sequences are read once."""

    def __init__(self, net: Network):
        self.net = net

    def _sums(self, kept: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Per sequence, the sums over letters of the label probabilities, and the number of letters."""
        made = np.zeros((len(starts), len(self.net.labels) + 1))
        order = np.argsort(ends - starts, kind="stable")
        for at in range(0, len(order), 4096):
            part = order[at : at + 4096]
            codes, lengths = _padded(kept, starts[part], ends[part])
            mask = (codes < 256).astype(np.float32)
            letters = np.append(LETTER, False)[codes]
            found = self.net.probabilities(codes, mask) * letters[:, :, None]
            made[part, :-1] = found.sum(1)
            made[part, -1] = letters.sum(1)
        return made

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        parts = [pieces((t or "").encode()) for t in texts]
        kept = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint8)
        shift = np.cumsum([0, *[len(p[0]) for p in parts]])
        starts = np.concatenate([p[1] + s for p, s in zip(parts, shift)]) if parts else np.zeros(0, np.int64)
        ends = np.concatenate([p[2] + s for p, s in zip(parts, shift)]) if parts else np.zeros(0, np.int64)
        counts = np.array([len(p[1]) for p in parts])
        sums = np.zeros((len(texts), len(self.net.labels) + 1))
        if len(starts):
            _, first, index = np.unique(byte_spans(kept, 11).of(starts, ends), return_index=True, return_inverse=True)
            each = self._sums(kept, starts[first], ends[first])[index]
            full = np.flatnonzero(counts)
            sums[full] = np.add.reduceat(each, (np.cumsum(counts) - counts)[full], axis=0)
        made = []
        for text, row in zip(texts, sums):
            if not row[-1] or not has_letter(text):
                made.append(("und", 0.0))
            else:
                best = int(row[:-1].argmax())
                made.append((self.net.labels[best], float(min(1.0, row[best] / row[-1]))))
        return made


def held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    """crc32 of the id as text, modulo folds, is the fold; a row without id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def train(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", per_label=SAMPLE_PER_LABEL) -> Network | None:
    """A network fitted on about per_label labelled documents of each language, None without any.

    The documents are those with the least hashes of their ids, so the sample is the same on each
    run; of a text of over SAMPLE_CHARS characters a stretch of so many is learned from, which may lie anywhere in it
    (a hash of the text tells where). Labels are counted over all rows, and
    a row is drawn by comparing its hash with per_label / count, so nothing is sorted and what
    reaches the driver is bounded by labels * per_label * SAMPLE_CHARS.
    Repeated rows are drawn together and count each; rows without text or label teach nothing.
    """
    doc_id, text, lang = F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.col(f"`{lang_col}`").cast("string")
    labelled = docs.filter(~held_out(doc_id) & lang.isNotNull() & text.isNotNull() & (lang != "und"))
    labelled = labelled.select(F.xxhash64(doc_id, text).alias("h"), text.alias("text"), lang.alias("lang"))
    counts = dict(labelled.groupBy("lang").count().collect())
    if not counts:
        return None
    bar = F.lit(None)
    for label, count in counts.items():
        bar = F.when(F.col("lang") == label, F.lit(min(1.0, per_label / count))).otherwise(bar)
    drawn = labelled.filter(F.pmod("h", F.lit(1 << 30)) < bar * (1 << 30))
    begin = 1 + F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1)
    rows = drawn.select("lang", F.substring("text", begin.cast("int"), F.lit(SAMPLE_CHARS)).alias("text"), "h").collect()
    labels = sorted(counts)
    net = Network(labels)
    total: dict[tuple[int, bytes], int] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.h, r.text)):
        kept, starts, ends = pieces(row.text.encode())
        data, label = kept.tobytes(), labels.index(row.lang)
        for a, b in zip(starts.tolist(), ends.tolist()):
            if LETTER[kept[a:b]].any():
                key = (label, data[a:b])
                total[key] = total.get(key, 0) + 1
    if total and len(labels) > 1:
        joined = np.frombuffer(b"".join(w for _, w in total), dtype=np.uint8)
        lengths = np.array([len(w) for _, w in total])
        ends = np.cumsum(lengths)
        codes, lengths = _padded(joined, ends - lengths, ends)
        truth = np.array([label for label, _ in total])
        weights = np.array(list(total.values()), dtype=float) ** 0.5 * lengths
        weights /= np.bincount(truth, weights, len(labels))[truth]  # every language alike
        net.fit(codes, lengths, truth, weights)
    return net


def _labelled(batches: Iterator[pa.RecordBatch], net: Network | None, column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches of some megabytes of text with the (label, score) of each row."""
    start_afresh()
    pooled = Pooled(net) if net else lambda texts: [("und", 0.0)] * len(texts)
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        at = 0
        while at < len(sizes):
            end, size = at, 0
            while end < len(sizes) and (size == 0 or size < _TEXT_BYTES):
                size += sizes[end] + 1
                end += 1
            part = batch.slice(at, end - at)
            yield part, pooled(part.column(column).to_pylist())
            at = end
    give_back()


def accepted(docs: DataFrame, net: Network | None, least: float, text_col="text") -> DataFrame:
    """The rows of docs, all their columns, whose text has a language with a score of at least `least`."""
    column = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _labelled(batches, net, column):
            yield batch.filter(pa.array([label != "und" and score >= least for label, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, net: Network | None, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row's whole text.

    Every byte gets label probabilities from both directions; those of letters are averaged over
    the text. `und` with score 0 if the text is null or has no letter, or nothing was learned.
    Of labels with equal means the first in order counts. Repeated rows and ids give a row each, equal texts the
    same label; texts of any length are read whole, some megabytes at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _labelled(batches, net, 1):
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "lang_pred", "score"])

    chosen = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score): a network trained on the rows that are not held out labels all."""
    found = predict(docs, train(docs, id_col, text_col, lang_col), id_col, text_col)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
