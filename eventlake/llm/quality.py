"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded and cut into overlapping chunks that cover
all of it.  Learned filters slide over each chunk; a filter's largest answer in
a chunk is its chunk value.  One more input map marks bytes that equal the byte
some lag before them; its chunk value is the best lag's mean, which is high
where words repeat.  A document is described by the largest and the mean of
each chunk value, which a logistic layer combines into one probability.  All weights (embedding, filters, last layer) are fitted together
by gradient descent on labelled rows; the gradient of a maximum reaches only
the window that gave it, so the backward pass touches few windows.

Fitting uses a bounded sample (``Recipe.rows`` labelled documents, of each at
most ``Recipe.train_bytes`` bytes in evenly spread chunks), read from a
seeded hash order.  Scoring reads every byte of every text.

Defined results: null and empty texts are scored as one chunk of padding;
repeated rows each get a score; documents without a label, with several labels
(the smallest counts) or a null id are scored like others and null ids are not
held out (``held_out`` false) nor learned from; without any label, or with one
class only, every score is the share of that class (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_fold, small_batches, spare, table

STRIDE, WIDTH = 4, 8  # a window is two strides wide
LAGS = range(2, 34)  # distances at which a chunk is compared with itself
PAD = 256  # the embedding row of no byte
FILL = LAGS.stop  # padding after each text, so that no lag reaches into the text before


@dataclass(frozen=True)
class Recipe:
    rows: int = 3000
    train_bytes: int = 4096
    chunk: int = 256
    dims: int = 8
    filters: int = 32
    epochs: int = 14
    batch: int = 64
    rate: float = 0.01
    seed: int = 7
    threshold: float = 0.3


@dataclass
class ByteNet:
    embed: np.ndarray  # (257, dims)
    kernel: np.ndarray  # (WIDTH * dims, filters)
    bias: np.ndarray  # (filters,)
    out: np.ndarray  # (2 * filters + 2,)
    base: float
    chunk: int

    def windows(self, codes: np.ndarray) -> np.ndarray:
        """Filter answers at every stride of padded codes."""
        half = STRIDE * self.embed.shape[1]
        x = self.embed[codes].reshape(-1, half)
        return x[:-1] @ self.kernel[:half] + x[1:] @ self.kernel[half:] + self.bias

    def score(self, texts: list[bytes], most: int = 1 << 20) -> np.ndarray:
        """Probability for each text; long texts go through in pieces."""
        result = np.empty(len(texts))
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= most):
                size += len(texts[end])
                end += 1
            result[at:end] = self._score(texts[at:end], most)
            at = end
        return result

    def _score(self, texts: list[bytes], most: int) -> np.ndarray:
        if len(texts) == 1 and len(texts[0]) > most:  # chunk by chunk, the same chunks
            top, total, n, raw = None, 0.0, 0, texts[0]
            step = most // self.chunk * self.chunk
            for a in range(0, len(raw), step):
                # a chunk before and the overlap after are seen, and belong to the neighbours
                values = self._chunks([raw[max(0, a - self.chunk) : a + step + WIDTH - STRIDE]])[0][a > 0 :]
                if a + step < len(raw):
                    values = values[: step // self.chunk]
                top = values.max(0) if top is None else np.maximum(top, values.max(0))
                total, n = total + values.sum(0), n + len(values)
            features = _order(top[None], (total / n)[None])
        else:
            values, starts = self._chunks(texts)
            counts = np.diff(np.append(starts, len(values)))[:, None]
            features = _order(np.maximum.reduceat(values, starts), np.add.reduceat(values, starts) / counts)
        return 1 / (1 + np.exp(-np.clip(features @ self.out + self.base, -30, 30)))

    def _chunks(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Chunk values of all texts, and where each text's begin.

        Chunk k sees the bytes from k * chunk on, and WIDTH - STRIDE bytes of
        the next one, so that no window is lost at a border.
        """
        codes, sizes = pad_texts(texts, self.chunk)
        answers = self.windows(codes)
        per = self.chunk // STRIDE
        answers = closed(answers, sizes * per)
        values = answers.reshape(-1, per, answers.shape[1]).max(1)
        return np.concatenate([values, echo(codes, self.chunk)], 1), np.cumsum(sizes) - sizes


def echo(codes: np.ndarray, chunk: int) -> np.ndarray:
    """(chunks, 1): the share of bytes equal to the byte a lag earlier, at the
    best lag.  Bytes before the chunk are seen too."""
    small = np.where(codes == PAD, 0, codes).astype(np.uint8)
    real = codes != PAD
    best = np.zeros(len(codes) // chunk, np.float32)
    same = np.empty(len(codes), bool)
    for lag in LAGS:
        same[:lag] = False
        np.equal(small[lag:], small[:-lag], out=same[lag:])
        same &= real
        best = np.maximum(best, np.count_nonzero(same.reshape(-1, chunk), 1) / np.float32(chunk))
    return best[:, None].astype(np.float32)


def _order(top: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Features of documents: largest and mean of the filters, then of the echo."""
    return np.concatenate([top[:, :-1], mean[:, :-1], 16 * top[:, -1:], 16 * mean[:, -1:]], 1)


def closed(answers: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Positive answers; the last window of each text, which would look into the
    next text, gives none."""
    answers = np.maximum(np.concatenate([answers, np.zeros((1, answers.shape[1]), answers.dtype)]), 0)
    answers[np.cumsum(windows) - 1] = 0
    return answers


def pad_texts(texts: list[bytes], chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts end to end, each filled up to whole chunks with at
    least FILL of padding, and each one's number of chunks."""
    sizes = np.array([max(1, -(-(len(t) + FILL) // chunk)) for t in texts], np.int64)
    codes = np.full(int(sizes.sum()) * chunk, PAD, np.int16)
    at = 0
    for t, n in zip(texts, sizes, strict=True):
        codes[at : at + len(t)] = np.frombuffer(t, np.uint8)
        at += int(n) * chunk
    return codes, sizes


def spread(raw: bytes, most: int, chunk: int) -> bytes:
    """At most ``most`` bytes of a long text for fitting: evenly spread runs."""
    if len(raw) <= most:
        return raw
    runs = max(1, most // (4 * chunk))
    step = (len(raw) - 4 * chunk) / max(1, runs - 1)
    return b"".join(raw[int(i * step) : int(i * step) + 4 * chunk] for i in range(runs))


def fit(texts: list[bytes], labels: np.ndarray, recipe: Recipe) -> ByteNet:
    rng = np.random.default_rng(recipe.seed)
    d, f = recipe.dims, recipe.filters
    share = float(np.mean(labels)) if len(labels) else 0.5
    prior = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    net = ByteNet(rng.normal(0, 0.5, (257, d)).astype(np.float32), rng.normal(0, (WIDTH * d) ** -0.5, (WIDTH * d, f)).astype(np.float32), np.zeros(f, np.float32), np.zeros(2 * f + 2, np.float32), prior, recipe.chunk)
    net.embed[PAD] = 0
    if len(set(labels.tolist())) < 2:
        net.base = 0.0 if not len(labels) else (30.0 if share > 0.5 else -30.0)
        return net
    net.out[: 2 * f] = rng.normal(0, 0.1, 2 * f)
    texts = [spread(t, recipe.train_bytes, recipe.chunk) for t in texts]
    # both classes weigh the same in the slope; the prior is put back afterwards
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    net.base = 0.0
    params = {"embed": net.embed, "kernel": net.kernel, "bias": net.bias, "out": net.out, "base": np.zeros(1, np.float32)}
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in params.items()}
    step, per = 0, recipe.chunk // STRIDE
    echoes = [echo(pad_texts([t], recipe.chunk)[0], recipe.chunk) for t in texts]
    for epoch in range(recipe.epochs):
        rate = recipe.rate * (1 - epoch / recipe.epochs) + 1e-4
        order = rng.permutation(len(texts))
        for a in range(0, len(order), recipe.batch):
            pick = order[a : a + recipe.batch]
            codes, sizes = pad_texts([texts[i] for i in pick], recipe.chunk)
            starts = np.cumsum(sizes) - sizes
            answers = net.windows(codes)
            answers = closed(answers, sizes * per).reshape(-1, per, f)
            best = answers.argmax(1)  # (chunks, filters)
            raw = np.take_along_axis(answers, best[:, None], 1)[:, 0]
            values = np.maximum(raw, 0)
            top = np.maximum.reduceat(values, starts)
            mean = np.add.reduceat(values, starts) / sizes[:, None]
            heard = [echoes[i] for i in pick]
            features = np.concatenate([top, mean, [[16 * e.max(), 16 * e.mean()] for e in heard]], 1).astype(np.float32)
            p = 1 / (1 + np.exp(-np.clip(features @ net.out + params["base"][0], -30, 30)))
            error = ((p - labels[pick]) * weight[pick] / len(pick)).astype(np.float32)
            doc = np.repeat(np.arange(len(pick)), sizes)
            first = np.zeros_like(values)  # which chunk gave the document's largest value
            hit = values == top[doc]
            first[hit] = 1
            ties = np.add.reduceat(first, starts)
            slope = error[doc, None] * (net.out[:f] * first / np.maximum(ties, 1)[doc] + net.out[f : 2 * f] / sizes[doc, None]) * (raw > 0)
            rows, cols = np.nonzero(slope)
            at = (rows * per + best[rows, cols]) * STRIDE
            bytes_at = codes[np.minimum(at[:, None] + np.arange(WIDTH), len(codes) - 1)]  # (n, WIDTH)
            seen = net.embed[bytes_at].reshape(-1, WIDTH * d)
            g = slope[rows, cols].astype(np.float32)
            grads = {"out": features.T @ error + 1e-4 * net.out, "base": np.array([error.sum()], np.float32), "bias": np.bincount(cols, g, f).astype(np.float32)}
            by_filter = np.argsort(cols, kind="stable")
            kernel = np.zeros((f, WIDTH * d), np.float32)
            used, begin = np.unique(cols[by_filter], return_index=True)
            if len(used):
                kernel[used] = np.add.reduceat((seen * g[:, None])[by_filter], begin)
            grads["kernel"] = kernel.T + 1e-4 * net.kernel
            back = (g[:, None] * net.kernel.T[cols]).reshape(-1, d)
            flat = bytes_at.reshape(-1)
            grads["embed"] = np.stack([np.bincount(flat, back[:, j], 257) for j in range(d)], 1).astype(np.float32)
            grads["embed"][PAD] = 0
            step += 1
            for k, v in params.items():
                m, s = moments[k]
                m += 0.1 * (grads[k] - m)
                s += 0.001 * (grads[k] ** 2 - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net.base = float(params["base"][0]) + prior
    return net


def labelled_sample(docs: DataFrame, labels: DataFrame, recipe: Recipe, learn: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """At most ``recipe.rows`` labelled documents (text, label), the first of a
    seeded hash order.  Ids are chosen without texts; few texts are then read."""
    marks = labels.select(F.col(f"`{key}`").alias("_key"), F.col("quality").cast("int").alias("_label")).where("_key is not null and _label in (0, 1)").groupBy("_key").agg(F.min("_label").alias("_label"))
    ids = docs.select(F.col(f"`{key}`").alias("_key")).where(learn).join(marks, "_key", "left_semi")
    order = F.xxhash64(F.lit(recipe.seed), "_key")
    chosen = ids.distinct().orderBy(order, "_key").limit(recipe.rows).join(marks, "_key")
    # chosen has at most recipe.rows rows of two numbers
    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).join(F.broadcast(chosen), "_key").select("_key", "_text", "_label")


def train(docs: DataFrame, labels: DataFrame, recipe: Recipe, learn: Column, text: str = "text", key: str = "doc_id") -> ByteNet:
    """``learn``: the condition on ``_key`` under which labels may be learned.

    Of each chosen document only ``spread`` bytes reach the driver: at most
    ``rows * train_bytes`` bytes in all.
    """
    most, chunk = recipe.train_bytes, recipe.chunk

    @F.pandas_udf("binary")
    def part(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: spread((t or "").encode("utf-8"), most, chunk))

    rows = labelled_sample(docs, labels, recipe, learn, text, key).select("_key", part("_text").alias("_bytes"), "_label").dropDuplicates(["_key"]).collect()
    rows.sort(key=lambda r: r["_key"])
    return fit([bytes(r["_bytes"]) for r in rows], np.array([r["_label"] for r in rows], np.int64), recipe)


def score_quality(docs: DataFrame, net: ByteNet, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that its quality label is 1."""
    small_batches(docs.sparkSession)
    # a few kilobytes; plain values, as a worker may not know the class
    shared = docs.sparkSession.sparkContext.broadcast((net.embed, net.kernel, net.bias, net.out, net.base, net.chunk))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = ByteNet(*shared.value)
        for batch in batches:
            texts = [(t or "").encode("utf-8") for t in batch]
            order = np.argsort([len(t) for t in texts], kind="stable")  # long texts on their own
            scores = np.empty(len(texts))
            scores[order] = model.score([texts[i] for i in order])
            yield pd.Series(scores, batch.index)

    return docs.withColumn(out, run(F.col(f"`{text}`")))


def classify_quality(docs: DataFrame, labels: DataFrame, recipe: Recipe = Recipe(), folds: int = 5, fold: int = 0) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``; documents of the
    held-out fold are never learned from."""
    net = train(docs, labels, recipe, crc_fold(F.col("_key"), folds) != fold)
    scored = score_quality(docs, net)
    return scored.withColumns({"held_out": F.coalesce(crc_fold(F.col("doc_id"), folds) == fold, F.lit(False)), "predicted": (F.col("score") >= recipe.threshold).cast("int")})


def accepted(docs: DataFrame, labels: DataFrame, recipe: Recipe = Recipe(), folds: int = 5, fold: int = 0) -> DataFrame:
    """The rows of ``docs`` that are accepted, their columns as they are."""
    mark = spare(docs, "_quality")
    net = train(docs, labels, recipe, crc_fold(F.col("_key"), folds) != fold)
    return score_quality(docs, net, out=mark).where(F.col(mark) >= recipe.threshold).select(*docs.columns)


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = classify_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return done.select("doc_id", "held_out", "score", "predicted")
