"""Quality classifier: random-indexing word vectors, a two-layer network and
temperature calibration.

Tokens of a text are its words, plus tokens for what surrounds them: letter
case, marks at the end, length, and whether the word repeats an earlier one.
Tokens are hashed into ``BINS``. Every bin has a sparse random index vector;
the vector of a bin is its own index vector plus the mean index vector of the
tokens next to it in the training texts. A text is the mean of the vectors of
its tokens and the rates of the token kinds. The network has one hidden layer;
a temperature fitted on rows that were not trained on makes its outputs
probabilities.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from reelhouse.llm.common import GOLDEN, materialize, mix64
from reelhouse.llm.words import word_hashes

#: Labelled rows that the classifier is fitted on at most (by order of a hash of the id): the documented bound.
SAMPLE_ROWS = 12_000
#: Tasks that read the sample.
SAMPLE_TASKS = 12
BINS, DIM, SPARSE, WINDOW, HIDDEN = 1 << 13, 96, 6, 2, 48
EPOCHS, BATCH, RATE, DECAY, SEED = 40, 256, 2e-3, 1e-4, 7
#: Rows of the sample that fit the temperature only.
CALIBRATION = 0.15
THRESHOLD = 0.3
#: Vectors of ``DIM`` values gathered at once: a few MB, however many different tokens a run of texts has.
GATHER = BINS

_KINDS = 24


def index_vectors() -> np.ndarray:
    """Sparse random vectors of the bins: SPARSE places of +1 or -1."""
    out = np.zeros((BINS, DIM), np.float32)
    rows = np.arange(BINS, dtype=np.uint64)
    for s in range(SPARSE):
        x = mix64(rows * np.uint64(SPARSE) + np.uint64(s) + GOLDEN)
        np.add.at(out, (np.arange(BINS), (x % np.uint64(DIM)).astype(np.int64)), np.where(x >> np.uint64(63), 1, -1))
    return out / np.sqrt(SPARSE)


def features(column: pa.Array):
    """Yields (first row, rows, row of each token, bins, rates) for runs of
    rows. Rates are per row: kinds of tokens in shares of the words."""
    for lo, n, rows, hashes, a, b, buf in word_hashes(column, spans=True):
        if not len(rows):
            yield lo, n, rows, rows, np.zeros((n, _KINDS), np.float32)
            continue
        first, second, last = buf[a], buf[np.minimum(a + 1, b - 1)], buf[b - 1]
        before_last = buf[np.maximum(b - 2, a)]
        size = b - a
        up1, up2 = (first >= 65) & (first <= 90), (second >= 65) & (second <= 90) & (size > 1)
        letter_end = ((last | 32) >= 97) & ((last | 32) <= 122) | (last >= 128)
        digit = (first >= 48) & (first <= 57)
        plain = (last == 44) | (last == 46)
        same = np.zeros(len(rows), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
        # words that occurred before in the row
        order = np.lexsort((np.arange(len(rows)), hashes, rows))
        again = np.zeros(len(rows), bool)
        again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (rows[order[1:]] == rows[order[:-1]])
        new_line = np.zeros(len(rows), bool)
        gap = np.zeros(len(rows), np.int64)
        gap[1:] = a[1:] - b[:-1]
        new_line[1:] = buf[np.maximum(a[1:] - 1, 0)] == 10
        twin = (last == before_last) & ~letter_end & (size > 1)
        kinds = np.stack([
            up1, up1 & up2, ~letter_end & ~plain, plain, last == 46, last == 44, twin, digit, size == 1, size == 2, size <= 4,
            size >= 9, size >= 14, size >= 20, same, again, again & (size >= 6), new_line, gap > 1, first == 124,
            (last == 33) | (last == 63), first >= 128, (first < 48) | (first == 60) | (first == 64), last == 59], 1)
        words = np.maximum(np.bincount(rows, minlength=n), 1)
        rates = np.stack([np.bincount(rows, kinds[:, k], n) / words for k in range(_KINDS)], 1).astype(np.float32)
        bins = (hashes % np.uint64(BINS)).astype(np.int64)
        # tokens of a shape (case, end mark, repetition) share a bin of their own for all words
        shape = (up1 + 2 * (up1 & up2) + 4 * same + 8 * twin + 16 * plain).astype(np.uint64) * np.uint64(256) + \
            np.where(letter_end, 0, last).astype(np.uint64)
        shape_bins = (mix64(shape + GOLDEN) % np.uint64(BINS)).astype(np.int64)
        yield lo, n, np.repeat(rows, 2), np.stack([bins, shape_bins], 1).ravel(), rates


@dataclass
class Network:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector and rates of each row (zeros for no words)."""
    out = np.zeros((len(column), DIM + _KINDS + 2), np.float32)
    for lo, n, rows, bins, rates in features(column):
        if len(rows):
            key, count = np.unique(rows * BINS + bins, return_counts=True)
            row, b = key // BINS, key % BINS
            total = np.bincount(row, count, n)
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            ends, at = np.append(starts[1:], len(key)), 0
            while at < len(starts):      # some rows at a time; a row has at most BINS keys
                to = max(at + 1, int(np.searchsorted(ends, starts[at] + GATHER, "right")))
                part = slice(starts[at], ends[to - 1])
                out[lo + row[starts[at:to]], :DIM] = np.add.reduceat(
                    vectors[b[part]] * count[part, None].astype(np.float32), starts[at:to] - starts[at])
                at = to
            out[lo:lo + n, :DIM] /= np.maximum(total, 1)[:, None]
            distinct = np.bincount(row, minlength=n)
            out[lo:lo + n, DIM + _KINDS] = np.log1p(total)
            out[lo:lo + n, DIM + _KINDS + 1] = distinct / np.maximum(total, 1)
        out[lo:lo + n, DIM:DIM + _KINDS] = rates
    return out


def _neighbours(batches):
    """Sums of the index vectors next to each bin, and its count."""
    index = index_vectors()
    total, count = np.zeros((BINS, DIM), np.float32), np.zeros(BINS, np.int64)
    for batch in batches:
        for _, _, rows, bins, _ in features(batch.column("_llm_text")):
            for step in range(1, WINDOW + 1):
                if len(bins) <= step:
                    continue
                ok = np.flatnonzero(rows[step:] == rows[:-step])
                for x, y in ((bins[ok], bins[ok + step]), (bins[ok + step], bins[ok])):
                    key, n = np.unique(x * BINS + y, return_counts=True)
                    for at in range(0, len(key), GATHER):
                        part = slice(at, at + GATHER)
                        np.add.at(total, key[part] // BINS, index[key[part] % BINS] * n[part, None].astype(np.float32))
                    np.add.at(count, key // BINS, n)
    used = np.flatnonzero(count)
    for at in range(0, len(used), 1024):
        part = used[at:at + 1024]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(count[part]),
                                          pa.array([total[i].tobytes() for i in part], pa.binary())],
                                         names=["bin", "n", "total"])


def _pool(vectors):
    def run(batches):
        for batch in batches:
            x = pooled(batch.column("_llm_text"), vectors.value)
            yield pa.RecordBatch.from_arrays([batch.column("_llm_o"), batch.column("_llm_y"),
                                              pa.array([r.tobytes() for r in x], pa.binary())], names=["o", "y", "x"])
    return run


def train(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Two layers by Adam on the mean cross entropy."""
    rng = np.random.default_rng(SEED)
    d = x.shape[1]
    p = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            xb, yb = x[order[at:at + BATCH]], y[order[at:at + BATCH]]
            h = np.maximum(xb @ p[0] + p[1], 0)
            g = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - yb) / len(xb)
            gh = np.outer(g, p[2]) * (h > 0)
            t += 1
            for k, grad in enumerate((xb.T @ gh + DECAY * p[0], gh.sum(0), h.T @ g + DECAY * p[2], g.sum(keepdims=True))):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                p[k] -= RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return tuple(p)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least cross entropy on a fixed grid."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    loss = [np.mean(np.logaddexp(0, -np.where(y > 0, 1, -1) * logits / t)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(labelled: DataFrame, id_col: str, text_col: str, label_col: str) -> Network | None:
    """A network from rows with a 0/1 label, one row for an id; None if a class
    is missing. The caller bounds the ids, so what comes to
    the driver (features of the sample, sums of ``BINS`` bins) is bounded."""
    spark = labelled.sparkSession
    rows = (labelled.where(F.col(label_col).isin(0, 1))
            .select(F.xxhash64(F.col(id_col).cast("string"), F.lit(SEED)).alias("_llm_o"),
                    F.col(text_col).alias("_llm_text"), F.col(label_col).cast("int").alias("_llm_y"))
            .dropDuplicates(["_llm_o"]))
    sample = materialize(rows.repartition(SAMPLE_TASKS, "_llm_o"), "quality-sample")
    found = sample.select("_llm_text").mapInArrow(_neighbours, "bin int, n long, total binary").toArrow().to_batches()
    total, count = np.zeros((BINS, DIM), np.float32), np.zeros(BINS, np.int64)
    for batch in found:
        bins = batch.column("bin").to_numpy()
        sums = np.stack([np.frombuffer(x.as_py(), np.float32) for x in batch.column("total")])
        np.add.at(total, bins, sums)
        np.add.at(count, bins, batch.column("n").to_numpy())
    vectors = index_vectors() + total / np.maximum(count, 1)[:, None]
    shared = spark.sparkContext.broadcast(vectors.astype(np.float32))
    got = sample.select("_llm_o", "_llm_text", "_llm_y").mapInArrow(_pool(shared), "o long, y int, x binary").toArrow()
    got = got.sort_by("o")
    y = got.column("y").to_numpy().astype(np.float64)
    if len(set(y.tolist())) < 2:
        return None
    x = np.stack([np.frombuffer(r.as_py(), np.float32) for r in got.column("x")]).astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = np.clip((x - mean) / scale, -8, 8)
    cut = len(y) - int(CALIBRATION * len(y))
    if len(set(y[:cut].tolist())) < 2:
        cut = len(y)
    w1, b1, w2, b2 = train(z[:cut], y[:cut])
    net = Network(vectors.astype(np.float32), mean, scale, w1, b1, w2, float(b2[0]))
    net.temperature = fit_temperature(net.logits(x[cut:]), y[cut:])
    return net


def _score(net):
    def run(batches):
        model: Network | None = net.value
        for batch in batches:
            column = batch.column("_llm_text")
            parts = [model.scores(pooled(column.slice(at, 512), model.vectors).astype(np.float64))
                     for at in range(0, len(column), 512)] if model else [np.full(len(column), 0.5)]
            rest = [c for c in batch.schema.names if c != "_llm_text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest],
                                              pa.array(np.concatenate([np.zeros(0), *parts]))], names=[*rest, "score"])
    return run


def held_out(id_col: str):
    """crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All columns of ``docs`` plus ``held_out``, ``score`` (0 to 1, higher:
    label 1 likelier) and ``predicted`` (1 if score >= 0.3).

    Labels of held-out ids are never read. Only the text is scored; null counts
    as empty and gets the score of a text without words. A null id is not held
    out and has no label. Rows that repeat an id each get a row; an id with
    several labels is not trained on unless they agree. Without labels of both
    classes all scores are 0.5. Input columns of these names are replaced."""
    names = {"held_out", "score", "predicted"}
    keep = [c for c in docs.columns if c.lower() not in names]
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("_llm_id")).agg(F.min(label_col).alias("_llm_y"), F.max(label_col).alias("_llm_z"))
             .where(F.col("_llm_y") == F.col("_llm_z")))
    chosen = known.orderBy(F.xxhash64(F.col("_llm_id").cast("string"), F.lit(SEED)), "_llm_id").limit(sample_rows)
    # the sample is bounded, so it may be sent to the tasks that read the texts
    labelled = docs.select(F.col(id_col).alias("_llm_id"), F.col(text_col).alias("_llm_t")).join(
        F.broadcast(chosen.select("_llm_id", "_llm_y")), "_llm_id")
    net = fit(labelled, "_llm_id", "_llm_t", "_llm_y")
    shared = docs.sparkSession.sparkContext.broadcast(net)
    slim = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("_llm_text"))
    schema = StructType([*[docs.schema[c] for c in keep], StructField("score", DoubleType())])
    return (slim.mapInArrow(_score(shared), schema)
            .withColumn("held_out", F.coalesce(held_out(id_col), F.lit(False)))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))
