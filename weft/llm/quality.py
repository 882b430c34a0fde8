"""Quality classifier: naive Bayes support vectors.

Indicators of n-grams (words, pairs of words, pairs and triples of word shapes) are scaled by the
log-ratio of their class counts; a linear hinge-loss model over the scaled indicators is fitted by
dual coordinate descent, and its margin is turned into a probability on rows kept out of the fit.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.llm.common import text_or_empty, worker_cache

#: Hashed indicators.
DIMS = 1 << 18
#: Labelled rows the model is fitted on, at most: those whose ids have the smallest hashes.
MAX_TRAIN = 10_000
#: Words whose hashes a worker keeps.
CACHED_WORDS = 150_000


@dataclass
class Model:
    """Scaled weights, the log-count ratios (for the norm of a row), and the line from margin to logit."""

    weights: object
    ratios: object
    slope: float
    shift: float


def shape(word: bytes) -> bytes:
    """What kind of word: runs of lower case, capitals, digits and other letters, and its punctuation."""
    out = bytearray()
    for c in word:
        k = 97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c
        if not out or out[-1] != k:
            out.append(k)
    return bytes(out[:12])


class WordKeys(dict):
    """Word to one 64-bit number: the hash of the lower-cased word over the hash of its shape."""

    def __missing__(self, word):
        key = (zlib.crc32(word.lower()) << 32 | zlib.crc32(shape(word))) & 0x7FFFFFFFFFFFFFFF
        if len(self) >= CACHED_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = key
        return key


def indicators(text: bytes, keys: WordKeys):
    """The distinct hashed n-grams of a text, as sorted indices below DIMS."""
    import numpy as np

    words = text.split()
    if not words:
        return np.empty(0, np.int32)
    key = np.fromiter(map(keys.__getitem__, words), np.uint64, len(words))
    word, form = key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    # A word that repeats the one before it has a shape of its own.
    same = np.zeros(len(words), bool)
    same[1:] = word[1:] == word[:-1]
    form = np.where(same, np.uint64(7), form)
    grams = [word * a, form * b + np.uint64(1)]
    if len(words) > 1:
        grams += [(word[:-1] * a + word[1:]) * b, (form[:-1] * a + form[1:]) * a + np.uint64(2)]
    if len(words) > 2:
        grams.append(((form[:-2] * a + form[1:-1]) * b + form[2:]) * a + np.uint64(3))
    return np.unique(np.concatenate(grams) >> np.uint64(46)).astype(np.int32)


def log_ratios(rows, labels, alpha: float = 1.0):
    import numpy as np

    counts = []
    for label in (1, 0):
        own = [r for r, y in zip(rows, labels, strict=True) if y == label]
        p = np.full(DIMS, alpha)
        if own:
            p += np.bincount(np.concatenate(own), minlength=DIMS)
        counts.append(p / p.sum())
    return np.log(counts[0] / counts[1])


def fit_hinge(rows, labels, ratios, cost: float = 1.0, epochs: int = 20, seed: int = 7):
    """Dual coordinate descent for the squared hinge loss; classes weigh equally in total."""
    import numpy as np

    y = np.where(np.asarray(labels) == 1, 1.0, -1.0)
    share = {s: len(y) / (2 * max(1, int((y == s).sum()))) for s in (1.0, -1.0)}
    xs = [unit(ratios[r]).astype(np.float32) for r in rows]
    w, alpha, rng = np.zeros(DIMS), np.zeros(len(y)), np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(y)):
            if not len(rows[i]):
                continue
            r, x, d = rows[i], xs[i], 1 / (2 * cost * share[y[i]])
            grad = y[i] * (w[r] @ x) - 1 + d * alpha[i]
            new = max(0.0, alpha[i] - grad / (1 + d))
            if new != alpha[i]:
                worst = max(worst, abs(new - alpha[i]))
                w[r] += (new - alpha[i]) * y[i] * x
                alpha[i] = new
        if worst < 1e-3:
            break
    return w


def unit(x):
    import numpy as np

    n = np.sqrt((x * x).sum())
    return x / n if n else x


def margin(r, weights, ratios) -> float:
    import numpy as np

    x = ratios[r]
    n = np.sqrt((x * x).sum())
    return float(weights[r] @ x / n) if n else 0.0


def fit_line(margins, labels, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of logit(P(label 1)) in the margin, by Newton steps with a weak prior."""
    import numpy as np

    m, y = np.asarray(margins), np.asarray(labels, float)
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, beta = np.stack([m, np.ones_like(m)], 1), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (p - t) + 1e-3 * beta
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        beta = beta - np.clip(step, -5, 5)
        if abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled rows for which ``use`` (over the id column) holds.

    Three quarters fit the ratios and the hinge model, a quarter the probability. Null labels and ids
    are passed over; of repeated labels the greatest counts, of rows that repeat an id one. Without both classes the model gives
    every text the share of label 1 (a half with no labels).
    """
    import numpy as np

    keys = labels.select(F.col(id_col).cast("long").alias("k"), F.col(label_col).cast("int").alias("y")).filter("k is not null and y in (0, 1)").filter(use(F.col("k")))
    keys = keys.groupBy("k").agg(F.max("y").alias("y")).orderBy(F.xxhash64("k"), "k").limit(max_train)
    src = docs.select(F.col(id_col).cast("long").alias("k"), text_or_empty(text_col).alias("text")).join(F.broadcast(keys), "k").select("k", "y", "text")

    def features(batches):
        words = worker_cache("quality_words", WordKeys)
        for b in batches:
            rows = [indicators(t, words).tobytes() for t in b.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.binary())], ["k", "y", "x"])

    got = sorted((k, y, x) for k, y, x in src.mapInArrow(features, "k long, y int, x binary").groupBy("k", "y").agg(F.min("x")).collect())  # max_train rows at most
    rows, y = [np.frombuffer(x, np.int32) for _, _, x in got], [v for _, v, _ in got]
    fit = [i for i, (k, _, _) in enumerate(got) if zlib.crc32(b"fit%d" % k) % 4]
    if len({y[i] for i in fit}) < 2:
        share = (sum(y) + 1) / (len(y) + 2)
        return Model(np.zeros(DIMS, np.float32), np.zeros(DIMS, np.float32), 0.0, float(np.log(share / (1 - share))))
    ratios = log_ratios([rows[i] for i in fit], [y[i] for i in fit])
    w = fit_hinge([rows[i] for i in fit], [y[i] for i in fit], ratios)
    rest = sorted(set(range(len(y))) - set(fit)) or fit
    slope, shift = fit_line([margin(rows[i], w, ratios) for i in rest], [y[i] for i in rest])
    return Model(w.astype(np.float32), ratios.astype(np.float32), slope, shift)


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs``, all columns and rows in place, with the probability of label 1; null texts are empty ones.

    Empty texts have the score of a zero margin. An existing column named ``out_col`` is replaced.
    """
    docs = docs.drop(out_col)
    at = docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.ratios, model.slope, model.shift))

    def run(batches):
        import math

        weights, ratios, slope, shift = sent.value
        words = worker_cache("quality_words", WordKeys)
        for b in batches:
            out = []
            for t in b.column(at).cast(pa.binary()).to_pylist():
                z = slope * margin(indicators(t or b"", words), weights, ratios) + shift
                out.append(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))))
            yield b.append_column(out_col, pa.array(out, pa.float64()))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out_col, T.DoubleType())]))
