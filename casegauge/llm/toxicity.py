"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained in numpy.

A text is cut into windows of ``WINDOW`` words. A window is the bag of the character
n-grams (3 to 5, word edges included) of its words; each n-gram's hash names a row of an
embedding table, the rows are averaged, and a linear softmax reads the average. Table and
softmax are trained jointly, so a misspelling that was never seen scores by the n-grams it
shares. A document scores as its most toxic window, so length doesn't dilute a passage.

Labels stand for documents, not windows: training starts from every window of a labelled
document, then keeps, of toxic ones, the windows that the model finds most toxic, weighs
those of clean ones that it finds most toxic ``HARD`` times, and trains on (``ROUNDS``
rounds in all).

The model is fitted on a bounded sample of labelled rows: at most ``TOXIC_ROWS`` toxic and
``CLEAN_ROWS`` other documents, of at most ``TRAIN_CHARS`` characters each, the first by a
hash of the id. Scoring reads every text whole; averaging and softmax being linear up to the
last step, a task carries one number per table row.

Defined results: null, empty and wordless texts score as the share of toxic rows among
clean windows (the model's bias alone); a null id is not held out; several labels of an id
count as toxic if one is; null labels are ignored; without labels of both kinds every text
scores 0; repeated rows are scored one by one; an empty table gives an empty result; extra
columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegauge.llm.common import mix64, text_batches
from casegauge.operators.joins import broadcast_if_small

WINDOW = 8
GRAMS = (3, 4, 5)
BUCKET_BITS = 17
DIM = 8
TOXIC_ROWS, CLEAN_ROWS, TRAIN_CHARS = 1200, 2400, 20_000
ROUNDS, EPOCHS, TOP, HARD = 4, 4, 2, 5.0
THRESHOLD = 0.3
_U = np.uint64


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points of the basic plane are letters or digits (others: all)."""
    return np.fromiter((chr(c).isalnum() for c in range(0x10000)), bool, 0x10000)


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-gram rows of all texts, one flat array in window order; the first n-gram of each
    window; and the first window of each text (one more entry at the end)."""
    points = np.frombuffer("".join(f"  {t.lower()}   " for t in texts).encode("utf-32-le"),
                           np.uint32)
    sizes = np.fromiter((len(t.lower()) + 5 for t in texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    letter = np.ones(len(points), bool)
    low = points < 0x10000
    letter[low] = _letters()[points[low]]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    word = np.cumsum(begins)  # number of words begun up to here
    text = np.repeat(np.arange(len(texts)), sizes)
    words_before = np.concatenate([[0], word[ends[:-1] - 1]]) if len(texts) else np.zeros(0, int)
    in_text = word - words_before[text]
    windows = np.maximum(1, -(-(word[ends - 1] - words_before) // WINDOW)) if len(texts) \
        else np.zeros(0, int)
    first_window = np.concatenate([[0], np.cumsum(windows)])
    codes = mix64(np.where(letter, points, 0).astype(np.uint64) + _U(1))
    rows, at = [], []
    for n in GRAMS:
        m = len(points) - n + 1
        if m <= 0:
            continue
        inside = letter[1:m + 1].copy()
        for k in range(2, n - 1):
            inside &= letter[k:m + k]
        start = np.flatnonzero(inside)
        h = np.full(len(start), n, np.uint64)
        for k in range(n):
            h = h * _U(0x9E3779B97F4A7C15) + codes[start + k]
        rows.append((mix64(h) >> _U(64 - BUCKET_BITS)).astype(np.int64))
        middle = start + 1
        at.append(first_window[text[middle]] + (np.maximum(in_text[middle], 1) - 1) // WINDOW)
    rows, at = np.concatenate(rows), np.concatenate(at)
    order = np.argsort(at, kind="stable")
    return rows[order], np.searchsorted(at[order], np.arange(first_window[-1] + 1)), first_window


@dataclass
class Model:
    """The trained softmax folded into the table: one number per n-gram row."""
    weights: np.ndarray
    bias: float

    def windows(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log-odds of each window (in pieces, for memory)."""
        out = np.full(len(first) - 1, self.bias)
        for a in range(0, len(out), 50_000):
            at = first[a:a + 50_001]
            total = np.concatenate([[0.0], np.cumsum(self.weights[rows[at[0]:at[-1]]],
                                                     dtype=np.float64)])
            at = at - at[0]
            out[a:a + 50_000] += (total[at[1:]] - total[at[:-1]]) / np.maximum(np.diff(at), 1)
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        rows, first, windows = bags(texts)
        odds = self.windows(rows, first)
        top = np.maximum.reduceat(odds, windows[:-1]) if len(odds) else odds
        return 1 / (1 + np.exp(-np.clip(top, -50, 50)))


class _Trainer:
    """Joint training of table and softmax by Adagrad on mini-batches of windows."""

    def __init__(self, seed: int):
        self.rng = np.random.Generator(np.random.PCG64(seed))
        self.table = self.rng.uniform(-1 / DIM, 1 / DIM, (1 << BUCKET_BITS, DIM)).astype(np.float32)
        self.soft = np.zeros((2, DIM), np.float32)
        self.soft[1] = self.rng.uniform(-1, 1, DIM)
        self.soft[0] = -self.soft[1]
        self.bias = np.zeros(2)
        self.seen_table = np.full(1 << BUCKET_BITS, 1e-8)
        self.seen_soft = np.full((2, DIM), 1e-8)

    def epoch(self, rows, first, chosen, label, weight, rate: float, batch: int = 1024) -> None:
        lengths = np.diff(first)
        for part in np.array_split(self.rng.permutation(chosen), -(-len(chosen) // batch)):
            n = lengths[part]
            part, n = part[n > 0], n[n > 0]
            if not len(part):
                continue
            ends = np.cumsum(n)
            take = np.repeat(first[part] - (ends - n), n) + np.arange(ends[-1])
            grams = rows[take]
            mean = np.add.reduceat(self.table[grams], ends - n, axis=0) / n[:, None]
            odds = mean @ self.soft.T + self.bias
            odds -= odds.max(1, keepdims=True)
            p = np.exp(odds)
            p /= p.sum(1, keepdims=True)
            error = p
            error[np.arange(len(part)), label[part]] -= 1
            error *= weight[part, None]
            grad = error.T @ mean / len(part)
            # every n-gram's gradient lies along the softmax rows' directions
            pull = np.stack([np.bincount(grams, np.repeat(error[:, c] / n, n),
                                         minlength=len(self.table)) for c in (0, 1)], 1)
            hit = np.flatnonzero(pull.any(1))
            step = pull[hit] @ self.soft
            self.seen_table[hit] += (step ** 2).mean(1)
            self.table[hit] -= (rate * step / np.sqrt(self.seen_table[hit])[:, None]).astype(np.float32)
            self.seen_soft += grad ** 2
            self.soft -= (rate * grad / np.sqrt(self.seen_soft)).astype(np.float32)
            self.bias -= 0.1 * rate * error.mean(0)

    def model(self) -> Model:
        return Model((self.table @ (self.soft[1] - self.soft[0])).astype(np.float32),
                     float(self.bias[1] - self.bias[0]))


def _all_bags(texts: list[str], step: int = 100) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``bags`` of many texts, a few at a time, with rows kept as 32-bit numbers."""
    rows, first, windows = [], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    for i in range(0, len(texts), step):
        r, f, w = bags(texts[i:i + step])
        rows.append(r.astype(np.int32))
        first.append(f[1:] + first[-1][-1])
        windows.append(w[1:] + windows[-1][-1])
    return np.concatenate(rows), np.concatenate(first), np.concatenate(windows)


def fit(texts: list[str], toxic: np.ndarray, seed: int = 11, rate: float = 0.05) -> Model:
    """Train on labelled texts (see the module's text). Classes weigh alike per window."""
    toxic = np.asarray(toxic, bool)
    if toxic.all() or not toxic.any():
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), -50.0)
    rows, first, windows = _all_bags(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(windows))
    label = toxic[owner].astype(np.int64)
    trainer = _Trainer(seed)
    chosen = np.arange(len(owner))
    hard = np.zeros(len(owner), bool)
    for turn in range(ROUNDS):
        if turn:
            odds = trainer.model().windows(rows, first)
            order = np.lexsort((-odds, owner))
            rank = np.empty(len(owner), np.int64)
            rank[order] = np.arange(len(owner)) - windows[owner[order]]
            chosen = np.flatnonzero((label == 0) | (rank < TOP))
            hard = (label == 0) & (rank < TOP)
        share = label[chosen].mean()
        weight = np.where(label == 1, min(0.25 / share, 20.0), np.where(hard, HARD, 1.0))
        for _ in range(EPOCHS):
            trainer.epoch(rows, first, chosen, label, weight, rate)
    return trainer.model()


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2,
                      F.lit(False))


def sample(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[list[str], np.ndarray]:
    """The training sample: bounded numbers of ids per class, the first by hash among rows that
    aren't held out, then a text of each (a join with at most that many ids; of an id that
    repeats, the text that sorts first)."""
    one = labels.where(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull()) \
        .where(~held_out(id_col)) \
        .groupBy(F.col(f"`{id_col}`").alias("__id")).agg(F.max(f"`{label_col}`").alias("toxic"))
    ordered = one.orderBy(F.xxhash64(F.lit(5), "__id"), "__id")
    ids = ordered.where("toxic = 1").limit(TOXIC_ROWS).unionByName(
        ordered.where("toxic = 0").limit(CLEAN_ROWS))
    texts = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("text")) \
        .where(F.length("text").between(1, TRAIN_CHARS))
    rows = texts.join(broadcast_if_small(ids)[0], "__id").groupBy("__id", "toxic").agg(
        F.min("text").alias("text")).orderBy("__id").collect()
    return [r["text"] for r in rows], np.array([r["toxic"] for r in rows], np.int64)


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    texts, toxic = sample(df, labels, id_col, text_col, label_col)
    return fit(texts, toxic) if texts else Model(np.zeros(1 << BUCKET_BITS, np.float32), -50.0)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row; texts are read whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, "text", 1 << 20):
            scores = model.score([t.decode() for t in texts])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])
    texts = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    out = texts.mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
