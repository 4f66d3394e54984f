"""Text quality by a small convolutional network over bytes, in numpy (operator 12)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices

WIDTH, CHUNK = 8, 512  # bytes of a filter and of a chunk; neighbouring chunks share WIDTH - 1 bytes
STEP = CHUNK - WIDTH + 1  # so that every WIDTH bytes in a row lie in just one chunk
FOLDS = 5


def fold(doc_id: Column) -> Column:
    """Documents of fold 0 are held out."""
    return F.crc32(doc_id.cast("string")) % FOLDS


def chunked(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(rows of CHUNK bytes that cover every whole text, first row of each text plus the end); an empty text has one row."""
    data = [(t or "").encode() for t in texts]
    counts = [max(1, -(-(len(d) - WIDTH + 1) // STEP)) for d in data]
    first = np.r_[0, np.cumsum(counts)].astype(np.int64)
    out = np.zeros((int(first[-1]), CHUNK), np.uint8)
    for d, at, n in zip(data, first[:-1].tolist(), counts, strict=True):
        flat = np.zeros(n * STEP + WIDTH - 1, np.uint8)
        flat[: len(d)] = np.frombuffer(d, np.uint8)
        out[at : at + n] = np.lib.stride_tricks.as_strided(flat, (n, CHUNK), (STEP, 1))
    return out, first


class ByteNet:
    """Byte vectors, filters over WIDTH bytes, and one weight for the maximum and the mean of each filter's peaks.

    A filter's answer in a chunk is its greatest value there, not below 0. A text has per filter the greatest and the
    mean answer of its chunks; their weighted sum gives the probability.
    """

    def __init__(self, filters: int, dims: int, seed: int):
        rng = np.random.default_rng(seed)
        self.p = {
            "vectors": rng.normal(0, 0.5, (256, dims)),
            "kernel": rng.normal(0, 1 / math.sqrt(WIDTH * dims), (WIDTH * dims, filters)),
            "bias": np.zeros(filters),
            "weights": rng.normal(0, 0.1, 2 * filters),
            "shift": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def peaks(self, rows: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Greatest value of each filter in each chunk before the floor at 0, and where it begins if asked for.

        Windows that begin WIDTH bytes apart lie one after another, so each of the WIDTH phases is one product of matrices
        without a copy.
        """
        n, dims = len(rows), self.p["vectors"].shape[1]
        flat = np.zeros((n * CHUNK + WIDTH, dims), np.float32)
        np.take(self.p["vectors"], rows.ravel(), axis=0, out=flat[: n * CHUNK])
        best = at = None
        for phase in range(WIDTH):
            windows = flat[phase : phase + n * CHUNK].reshape(-1, WIDTH * dims)
            value = (windows @ self.p["kernel"]).reshape(n, CHUNK // WIDTH, -1)
            if phase:
                value = value[:, :-1]  # the last one would reach into the next chunk
            peak = value.max(axis=1)
            if places:
                where = value.argmax(axis=1) * WIDTH + phase
                at = where if at is None else np.where(peak > best, where, at)
            best = peak if best is None else np.maximum(best, peak)
        return best + self.p["bias"], at

    def features(self, peaks: np.ndarray, first: np.ndarray) -> np.ndarray:
        answer = np.maximum(peaks, 0)
        mean = np.add.reduceat(answer, first[:-1]) / np.diff(first)[:, None]
        return np.hstack([np.maximum.reduceat(answer, first[:-1]), mean])

    def logits(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.features(self.peaks(rows)[0], first) @ self.p["weights"] + self.p["shift"][0]

    def gradients(self, rows: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted log loss of some texts; only the peaks of the filters carry any."""
        p, n = self.p, np.diff(first)
        filters, dims = len(p["bias"]), p["vectors"].shape[1]
        peaks, at = self.peaks(rows, True)
        found = self.features(peaks, first)
        z = found @ p["weights"] + p["shift"][0]
        dz = weight * (1 / (1 + np.exp(-z)) - y)
        text = np.repeat(np.arange(len(n)), n)
        answer = np.maximum(peaks, 0)
        greatest = answer == found[text, :filters]
        ties = np.add.reduceat(greatest, first[:-1], dtype=np.float32)
        share = greatest / ties[text] * p["weights"][:filters] + p["weights"][filters:] / n[text, None]
        d = (dz[text, None] * share * (peaks > 0)).astype(np.float32)  # chunks x filters
        windows = np.arange(WIDTH)[None, None] + at[:, :, None]
        byte = rows[np.arange(len(rows))[:, None, None], windows]  # chunks x filters x WIDTH
        spread = (d[:, :, None] * p["kernel"].T[None]).reshape(-1, dims)
        sums = [np.bincount(byte.ravel(), spread[:, k], minlength=256) for k in range(dims)]
        kernel = np.einsum("cf,cfx->xf", d, p["vectors"][byte].reshape(*d.shape, -1), optimize=True)
        return {
            "vectors": np.stack(sums, axis=1), "kernel": kernel, "bias": d.sum(axis=0),
            "weights": dz @ found, "shift": np.array([dz.sum()]),
        }

    def train(self, texts: list[str], y: np.ndarray, epochs: int, rate: float, decay: float, seed: int, size: int = 32) -> ByteNet:
        """Adam over mixed batches of texts; both labels weigh the same."""
        rng = np.random.default_rng(seed)
        weight = np.where(y == 1, 0.5 / max(1, int((y == 1).sum())), 0.5 / max(1, int((y == 0).sum()))) * len(y)
        mean, square, step = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        total = epochs * -(-len(texts) // size)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for low in range(0, len(order), size):
                some = order[low : low + size]
                step += 1
                rows, first = chunked([texts[i] for i in some])
                found = self.gradients(rows, first, y[some], weight[some] / len(some))
                now = rate * 0.5 * (1 + math.cos(math.pi * step / total))
                for k, g in found.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    move = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
                    self.p[k] = (self.p[k] - now * (move + decay * self.p[k])).astype(np.float32)
        return self

    def score(self, texts: list[str | None], share: float) -> np.ndarray:
        """Probability of label 1 where ``share`` of all rows have it; a few rows are held at a time."""
        rows, first = chunked(texts)
        peaks = np.concatenate([self.peaks(rows[i : i + 256])[0] for i in range(0, len(rows), 256)])
        z = self.features(peaks, first).astype(np.float64) @ self.p["weights"] + self.p["shift"][0]
        z += math.log(share / (1 - share))
        return np.where(z >= 0, 1 / (1 + np.exp(-np.abs(z))), np.exp(-np.abs(z)) / (1 + np.exp(-np.abs(z))))


def examples(
    docs: DataFrame, labels: DataFrame, max_examples: int, max_bytes: int, label: str, text: str
) -> tuple[DataFrame, float | None]:
    """(y, text) of the rows to learn from, and the share of label 1 in all labels outside fold 0 (None: no label)."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("label_id"), (F.col(label) > 0).cast("int").alias("y")
    )
    train = known.filter(fold(F.col("label_id")) != 0).distinct()
    share = train.agg(F.avg("y")).first()[0]
    mark = F.xxhash64(F.lit(label), "label_id")
    picked = None
    for y in (0, 1):
        part = train.filter(F.col("y") == y).orderBy(mark, "label_id").limit(max_examples)
        picked = part if picked is None else picked.union(part)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # A few thousand ids at most, by the limits above.
    found = rows.join(F.broadcast(picked), F.col("doc_id") == F.col("label_id")).filter(F.col("text").isNotNull())
    one = found.groupBy("label_id", "y").agg(F.min("text").alias("text"))
    before = Window.partitionBy("y").orderBy(mark, "label_id")
    sized = one.withColumn("upto", F.sum(F.octet_length("text").cast("bigint")).over(before))
    return sized.filter(F.col("upto") <= max_bytes // 2).orderBy(mark, "label_id", "y").select("y", "text"), share


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_examples: int = 1000,
    max_bytes: int = 6_000_000,
    filters: int = 32,
    dims: int = 8,
    epochs: int = 12,
    rate: float = 0.02,
    decay: float = 1e-4,
    seed: int = 12,
    label: str = "quality",
    text: str = "text",
) -> tuple[ByteNet | None, float]:
    """(network, share of label 1), learned from labelled rows outside fold 0.

    Bounded: ``max_examples`` rows of each label in the order of a hash of the id, and of these the whole texts that fit
    half of ``max_bytes`` in that order; only they reach the driver. Of repeated rows with one id the smallest text
    teaches; an id with both labels teaches both. Without rows of both labels there is no network, only the share,
    0.5 without any label.
    """
    rows, share = examples(docs, labels, max_examples, max_bytes, label, text)
    if not share or share == 1:
        return None, 0.5 if share is None else float(share)
    taught = rows.collect()
    y = np.array([r["y"] for r in taught], np.int64)
    if len(set(y.tolist())) < 2:
        return None, float(share)
    net = ByteNet(filters, dims, seed).train([r["text"] for r in taught], y, epochs, rate, decay, seed + 1)
    return net, float(share)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, text: str = "text", **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; ``options`` go to ``fit``.

    The network reads every byte of every text in overlapping chunks; each task holds the network (some 20 KB) and one
    slice of texts. Null and empty texts score as a text without bytes. Repeated rows come out once each; a null id is not
    held out; columns other than id and text are not read; an empty table gives an empty result. Without rows of both
    labels every score is the share of label 1.
    """
    net, share = fit(docs, labels, text=text, **options)
    shared = docs.sparkSession.sparkContext.broadcast((net, share))  # its size is that of the parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, base = shared.value
        for whole in batches:
            for batch in slices(whole, "text"):
                score = np.full(batch.num_rows, base) if own is None else own.score(batch.column(1).to_pylist(), base)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id bigint, score double")
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
