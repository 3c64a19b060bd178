"""Toxicity by a bidirectional gated recurrent network with attention over windows of words.

A word enters the network as the sum of an embedding of the word (by hash) and the mean of
embeddings of its character runs of 3 to 5 (by hash, word ends marked). A word of more than
``LONG`` bytes is read as overlapping pieces, each a word of its own. Two gated recurrent
layers read a window of words forwards and backwards, attention pools their states, and a
linear unit gives the window's logit. Windows of ``width`` words start every ``width / 2``
words, so each word is read in two of them; a document's score is the largest window's.

The network is written in numpy, with its gradients, and trained on a bounded sample of
labelled documents: at most ``per_label`` of each label with at most ``longest``
characters, those with the smallest hash of their id. A document's label says only that
some window is toxic, so training goes in rounds: the windows a model finds worst stand for
their document, first by the log odds of their character runs, then by the network itself.
Scores are moved by the share of toxic rows among all labelled training rows.

Only texts are inputs. Null and empty texts have one window without words, whose logit is
the bias of the classes. Without toxic or without clean training rows every score is that
share. Repeated rows are scored alike.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm.common import arrow_types, words
from cohortloom.llm.tokens import scramble

WIDTH = 24
SIZE = 12
HIDDEN = 10
WORD_BUCKETS = 1 << 14
RUN_BUCKETS = 1 << 16
RUNS = (3, 4, 5)
# Bytes of a piece of a long word; pieces overlap so that every character run lies in one.
LONG = 64
PER_LABEL = 2000
LONGEST = 6000
ROUNDS = 3
EPOCHS = 4
BATCH = 256
RATE = 0.01
# Words a worker keeps ready, and windows it reads at once.
CACHE = 1 << 18
AT_ONCE = 2048
FOLDS, HELD_OUT = 5, 0

Weights = dict[str, np.ndarray]


def pieces(found: list[bytes]) -> list[bytes]:
    """The words, long ones cut into overlapping pieces."""
    if all(len(w) <= LONG for w in found):
        return found
    overlap = max(RUNS) - 1
    return [w[i : i + LONG] for w in found for i in range(0, max(1, len(w) - overlap), LONG - overlap)]


def runs_of(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' character runs of 3 to 5, the ends marked, and where each word's start."""
    marked = [b"^" + w + b"$" for w in found]
    length = np.array([len(m) for m in marked], np.int64)
    text = np.frombuffer(b"".join(marked) + bytes(8), np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(found)), length)
    left = np.repeat(np.cumsum(length), length) - np.arange(len(word))
    buckets, owner = [], []
    for k in RUNS:
        at = np.flatnonzero(left >= k)
        value = np.full(len(at), k, np.uint64)
        for j in range(k):
            value = value * np.uint64(257) + text[at + j]
        buckets.append((scramble(value) % np.uint64(RUN_BUCKETS)).astype(np.int64))
        owner.append(word[at])
    owner_all = np.concatenate(owner)
    order = np.argsort(owner_all, kind="stable")
    start = np.append(0, np.cumsum(np.bincount(owner_all, minlength=len(found))))
    return np.concatenate(buckets)[order], start


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def new_weights(random: np.random.Generator) -> Weights:
    def draw(*shape: int, scale: float = 0.1) -> np.ndarray:
        return (random.standard_normal(shape) * scale).astype(np.float32)

    out: Weights = {"word": draw(WORD_BUCKETS, SIZE, scale=0.02), "run": draw(RUN_BUCKETS, SIZE)}
    for side in "fb":
        out[f"x{side}"] = draw(SIZE, 3 * HIDDEN, scale=0.4)
        out[f"h{side}"] = draw(HIDDEN, 3 * HIDDEN, scale=0.3)
        out[f"c{side}"] = np.zeros(3 * HIDDEN, np.float32)
    out["attend"] = draw(2 * HIDDEN, HIDDEN, scale=0.4)
    out["pick"] = draw(HIDDEN, scale=0.4)
    out["out"] = draw(2 * HIDDEN, scale=0.4)
    out["bias"] = np.zeros(1, np.float32)
    return out


def read_side(given: np.ndarray, mask: np.ndarray, u: np.ndarray, back: bool, keep: bool) -> tuple[np.ndarray, list]:
    """States of one direction; ``given`` holds the projected inputs by (time, window)."""
    steps, n, _ = given.shape
    h = np.zeros((n, HIDDEN), np.float32)
    states = np.empty((steps, n, HIDDEN), np.float32)
    past = []
    for t in range(steps - 1, -1, -1) if back else range(steps):
        hu = h @ u
        gates = 1.0 / (1.0 + np.exp(-(given[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])))
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = np.tanh(given[t, :, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
        m = mask[t][:, None]
        after = h + m * (1.0 - z) * (new - h)
        if keep:
            past.append((t, h, hu, z, r, new, m))
        h = after
        states[t] = h
    return states, past


def forward(w: Weights, given: dict[str, np.ndarray], mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
    """Window logits; mask and inputs by (time, window)."""
    front, past_f = read_side(given["f"], mask, w["hf"], False, keep)
    back, past_b = read_side(given["b"], mask, w["hb"], True, keep)
    states = np.concatenate([front, back], axis=2)
    hidden = np.tanh(states @ w["attend"])
    energy = hidden @ w["pick"] + (mask - 1.0) * 30.0
    energy = np.exp(energy - energy.max(axis=0))
    share = energy / energy.sum(axis=0)
    pooled = (share[:, :, None] * states).sum(axis=0)
    return pooled @ w["out"] + w["bias"][0], (states, hidden, share, pooled, past_f, past_b)


def back_side(w: Weights, side: str, past: list, grad: np.ndarray, out: Weights, given: np.ndarray) -> np.ndarray:
    """Gradients of one direction; returns that of the projected inputs."""
    u = w[f"h{side}"]
    to_given = np.zeros_like(given)
    carry = np.zeros(grad.shape[1:], np.float32)
    for t, h, hu, z, r, new, m in reversed(past):
        g = grad[t] + carry
        to_new = g * m * (1.0 - z) * (1.0 - new * new)
        to_z = g * m * (h - new) * z * (1.0 - z)
        to_r = to_new * hu[:, 2 * HIDDEN :] * r * (1.0 - r)
        to_given[t] = np.concatenate([to_z, to_r, to_new], axis=1)
        to_hu = np.concatenate([to_z, to_r, to_new * r], axis=1)
        out[f"h{side}"] += h.T @ to_hu
        carry = g * (1.0 - m * (1.0 - z)) + to_hu @ u.T
    return to_given


def gradients(w: Weights, given: dict[str, np.ndarray], mask: np.ndarray, label: np.ndarray) -> tuple[Weights, dict[str, np.ndarray], float]:
    """Gradients of the mean log loss to the small weights and the projected inputs."""
    logit, (states, hidden, share, pooled, past_f, past_b) = forward(w, given, mask, keep=True)
    p = sigmoid(logit)
    d = ((p - label) / len(label)).astype(np.float32)
    out = {k: np.zeros_like(v) for k, v in w.items() if k not in ("word", "run")}
    out["out"] += pooled.T @ d
    out["bias"][0] = d.sum()
    to_pooled = d[:, None] * w["out"]
    to_states = share[:, :, None] * to_pooled
    to_share = (states * to_pooled).sum(axis=2)
    to_energy = share * (to_share - (share * to_share).sum(axis=0))
    out["pick"] += np.einsum("tn,tnh->h", to_energy, hidden)
    to_hidden = to_energy[:, :, None] * w["pick"] * (1.0 - hidden * hidden)
    out["attend"] += np.einsum("tni,tnj->ij", states, to_hidden)
    to_states = to_states + to_hidden @ w["attend"].T
    to_given = {
        "f": back_side(w, "f", past_f, to_states[:, :, :HIDDEN], out, given["f"]),
        "b": back_side(w, "b", past_b, to_states[:, :, HIDDEN:], out, given["b"]),
    }
    for side in "fb":
        out[f"c{side}"] += to_given[side].sum(axis=(0, 1))
    loss = float(-(label * np.log(p + 1e-9) + (1 - label) * np.log(1 - p + 1e-9)).mean())
    return out, to_given, loss


class Vocabulary(dict):
    """Word to its number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number

    def ids(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word buckets, all run buckets one after the other, and where each word's start."""
        found = list(self)
        return np.array([zlib.crc32(w) % WORD_BUCKETS for w in found], np.int64), *runs_of(found)


def word_vectors(w: Weights, word: np.ndarray, runs: np.ndarray, start: np.ndarray) -> np.ndarray:
    sums = np.add.reduceat(w["run"][runs], start[:-1], axis=0)
    return w["word"][word] + sums / np.diff(start)[:, None].astype(np.float32)


def window_starts(n: int, width: int = WIDTH) -> list[int]:
    """Starts of the overlapping windows of a text of ``n`` words."""
    return list(range(0, max(1, n - width // 2), width // 2))


def cut_windows(ids: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Windows of a text as rows, padded with -1."""
    starts = np.array(window_starts(len(ids), width))
    padded = np.append(ids, np.full(width, -1, ids.dtype))
    return padded[np.minimum(starts[:, None] + np.arange(width), len(padded) - 1)]


class Adam:
    def __init__(self, w: Weights, rate: float) -> None:
        self.m, self.v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
        self.rate, self.t = rate, 0

    def step(self, w: Weights, grads: Weights) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            w[k] -= scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)


def log_odds(docs: list[np.ndarray], labels: np.ndarray, runs: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each word the largest log odds of its character runs, by documents that hold them."""
    seen = np.ones((2, RUN_BUCKETS))
    for ids, label in zip(docs, labels):
        held = [runs[start[i] : start[i + 1]] for i in np.unique(ids)]
        seen[int(label), np.unique(np.concatenate(held)) if held else []] += 1
    n = np.bincount(labels.astype(np.int64), minlength=2) + 2.0
    odds = np.log(seen[1] / n[1]) - np.log(seen[0] / n[0])
    return np.maximum.reduceat(odds[runs], start[:-1])


def train(texts: list[str], labels: np.ndarray, seed: int = 5, rounds: int = ROUNDS, epochs: int = EPOCHS) -> Weights:
    """Weights from documents and their labels."""
    random = np.random.default_rng(seed)
    vocabulary = Vocabulary()
    docs = [vocabulary.ids(pieces(words(t.lower()))) for t in texts]
    w = new_weights(random)
    adam = Adam(w, RATE)
    word, runs, start = vocabulary.flat()
    length = np.diff(start)
    cut = [cut_windows(d) for d in docs]
    odds = log_odds(docs, labels, runs, start)
    for turn in range(rounds):
        if turn == 0:
            worth = np.append(odds, -9.0)
            judged = [worth[c].max(axis=1) for c in cut]
        else:
            judged = _judge(w, cut, word, runs, start)
        rows, label = [], []
        for c, j, y in zip(cut, judged, labels):
            worst = np.argsort(-j, kind="stable")
            # a clean document is clean throughout, a toxic one at its worst
            picked = worst[:1] if y else np.append(worst[:2], random.integers(len(c)))
            rows.append(c[picked])
            label += [y] * len(picked)
        windows, label = np.concatenate(rows), np.array(label, np.float32)
        for _ in range(epochs):
            order = random.permutation(len(windows))
            for lo in range(0, len(order), BATCH):
                part = order[lo : lo + BATCH]
                ids = windows[part].T
                mask = (ids >= 0).astype(np.float32)
                own, place = np.unique(np.maximum(ids, 0), return_inverse=True)
                place = place.reshape(ids.shape)
                own_runs = np.concatenate([runs[start[i] : start[i + 1]] for i in own])
                own_start = np.append(0, np.cumsum(length[own]))
                vectors = word_vectors(w, word[own], own_runs, own_start)
                x = vectors[place]
                given = {s: x @ w[f"x{s}"] + w[f"c{s}"] for s in "fb"}
                grads, to_given, _ = gradients(w, given, mask, label[part])
                to_x = np.zeros_like(x)
                for s in "fb":
                    grads[f"x{s}"] += np.einsum("tni,tnj->ij", x, to_given[s])
                    to_x += to_given[s] @ w[f"x{s}"].T
                to_vector = np.zeros_like(vectors)
                np.add.at(to_vector, place.ravel(), (to_x * mask[:, :, None]).reshape(-1, SIZE))
                adam.step(w, grads)
                # the embeddings take a plain scaled step, as most of them rest
                np.add.at(w["word"], word[own], -RATE * 20 * to_vector)
                np.add.at(w["run"], own_runs, np.repeat(-RATE * 200 * to_vector / length[own][:, None], length[own], axis=0).astype(np.float32))
    return w


def _judge(w: Weights, cut: list[np.ndarray], word: np.ndarray, runs: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    """Logits of all windows of the sample's documents."""
    vectors = word_vectors(w, word, runs, start)
    given = {s: np.concatenate([vectors @ w[f"x{s}"] + w[f"c{s}"], w[f"c{s}"][None]]) for s in "fb"}
    logits = logits_of(w, given, np.concatenate(cut))
    return np.split(logits, np.cumsum([len(c) for c in cut])[:-1])


def logits_of(w: Weights, given: dict[str, np.ndarray], windows: np.ndarray) -> np.ndarray:
    out = []
    for lo in range(0, len(windows), AT_ONCE):
        ids = windows[lo : lo + AT_ONCE].T
        out.append(forward(w, {s: given[s][ids] for s in "fb"}, (ids >= 0).astype(np.float32))[0])
    return np.concatenate(out)


class Scorer:
    """Scores texts; projected inputs of known words are kept in a bounded table."""

    def __init__(self, w: Weights) -> None:
        self.w = w
        self.empty()

    def empty(self) -> None:
        self.number: dict[bytes, int] = {}
        self.given = {s: np.empty((CACHE + 1, 3 * HIDDEN), np.float32) for s in "fb"}
        for s in "fb":
            self.given[s][-1] = self.w[f"c{s}"]

    def learn(self, new: list[bytes]) -> None:
        first = len(self.number)
        flat, start = runs_of(new)
        vectors = word_vectors(self.w, np.array([zlib.crc32(x) % WORD_BUCKETS for x in new]), flat, start)
        for s in "fb":
            self.given[s][first : first + len(new)] = vectors @ self.w[f"x{s}"] + self.w[f"c{s}"]
        self.number.update(zip(new, range(first, first + len(new))))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The largest window logit of each text."""
        out = np.empty(len(texts))
        lot: list[np.ndarray] = []
        owner: list[int] = []

        def flush() -> None:
            if lot:
                logits = logits_of(self.w, self.given, np.concatenate(lot))
                who = np.repeat(owner, [len(x) for x in lot])
                np.maximum.at(out, who, logits)
                lot.clear()
                owner.clear()

        out[:] = -np.inf
        held = 0
        for i, text in enumerate(texts):
            found = pieces(words(text.lower() if text else None))
            if len(self.number) + len(found) > CACHE:
                flush()
                held = 0
            for block in self.windows(found, flush):
                lot.append(block)
                owner.append(i)
                held += len(block)
            if held >= AT_ONCE:
                flush()
                held = 0
        flush()
        return out

    def windows(self, found: list[bytes], flush) -> Iterator[np.ndarray]:
        """Windows of a text as word numbers, stretch by stretch if it is very long."""
        step = CACHE // 2 // WIDTH * WIDTH
        for lo in range(0, max(1, len(found)), step):
            part = found[lo : lo + step + WIDTH // 2]
            new = list({x for x in part if x not in self.number})
            if len(self.number) + len(new) > CACHE:
                flush()
                self.empty()
                new = list(set(part))
            if new:
                self.learn(new)
            yield cut_windows(np.fromiter(map(self.number.__getitem__, part), np.int64, len(part)))


def remainder(id_column: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % FOLDS


def training_rows(documents: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str) -> DataFrame:
    """(doc_id, key, chars, toxic) of the labelled documents that are not held out; texts stay where they are."""
    named = labels.select(F.col(id_column).cast("long").alias("_id"), (F.col(label_column) > 0).cast("int").alias("toxic"))
    named = named.filter("toxic is not null").groupBy("_id").agg(F.max("toxic").alias("toxic"))
    rows = _texts(documents, id_column, text_column).select("doc_id", "key", F.length("text").alias("chars"))
    return rows.join(named, rows["doc_id"] == F.col("_id")).select("doc_id", "key", "chars", "toxic")


def _texts(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, text, key) of the documents that may be learned from; the key is a hash of the text."""
    return documents.filter(remainder(id_column) != HELD_OUT).select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.xxhash64(text_column).alias("key")
    )


def fit(rows: DataFrame, texts: DataFrame, per_label: int = PER_LABEL, longest: int = LONGEST) -> tuple[bytes | None, float]:
    """Trained weights as bytes (None if a label is missing), and the log odds of a toxic row.

    ``rows`` has no texts: at most ``per_label`` rows of each label are chosen by a hash of
    their id, sent to the tasks, and only their texts are read.
    """
    n, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = float(np.log((toxic + 0.5) / (n - toxic + 0.5)))
    able = rows.filter(F.col("chars") <= longest).select("doc_id", "key", "toxic").distinct()
    place = F.md5(F.col("doc_id").cast("string"))
    picked = able.filter("toxic = 1").orderBy(place, "key").limit(per_label).unionByName(
        able.filter("toxic = 0").orderBy(place, "key").limit(per_label)
    )
    # at most 2 * per_label rows of three numbers
    picked = rows.sparkSession.createDataFrame(picked.collect(), picked.schema)
    met = texts.join(F.broadcast(picked), ["doc_id", "key"]).groupBy("doc_id", "key").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic"))
    chosen = met.select("doc_id", "text", "toxic")
    schema = "weights binary, n long, toxic long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((r for b in batches for r in zip(*[c.to_pylist() for c in b.columns])), key=lambda r: (r[0], r[1]))
        labels = np.array([r[2] for r in found], np.float32)
        if not found or labels.min() == labels.max():
            return
        file = io.BytesIO()
        np.savez(file, **train([r[1] for r in found], labels))
        yield pa.RecordBatch.from_arrays(
            [pa.array([file.getvalue()], pa.binary()), pa.array([len(found)], pa.int64()), pa.array([int(labels.sum())], pa.int64())],
            names=["weights", "n", "toxic"],
        )

    # at most 2 * per_label rows of bounded length
    row = chosen.coalesce(1).mapInArrow(run, schema).first()
    if row is None:
        return None, prior
    return bytes(row["weights"]), prior - float(np.log((row["toxic"] + 0.5) / (row["n"] - row["toxic"] + 0.5)))


def toxicity(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    per_label: int = PER_LABEL,
    longest: int = LONGEST,
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document."""
    spark = documents.sparkSession
    rows = training_rows(documents, labels, id_column, text_column, label_column)
    weights, shift = fit(rows, _texts(documents, id_column, text_column), per_label, longest)
    sent = spark.sparkContext.broadcast(weights)
    schema = "doc_id long, held_out boolean, score double, predicted int"
    kinds = arrow_types(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(dict(np.load(io.BytesIO(sent.value)))) if sent.value else None
        for batch in batches:
            logits = scorer.scores(batch.column(1).to_pylist()) if scorer else np.zeros(batch.num_rows)
            score = sigmoid(logits + shift)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(score, kinds["score"]), pa.array((score >= 0.5).astype(np.int32))],
                names=list(kinds),
            )

    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), (remainder(id_column) == HELD_OUT).alias("held_out")
    )
    return rows.mapInArrow(run, schema)
