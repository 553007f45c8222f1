"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on toxic
text. A window of a text (a word with its neighbouring blanks; longer words are
cut into overlapping windows of ``PIECE`` bytes) is compressed with both; the
difference of the two lengths says which text it is more like. How much a
difference means is calibrated for each window length on documents that the
dictionaries have not seen, and a logistic curve over the windows' evidence
turns it into the probability that a document has label 1.

Labels are on documents, and most windows of a toxic document are ordinary. So
the toxic dictionary is trained on those windows of toxic documents that hold a
byte run of ``GRAM`` bytes found in many more toxic documents than ordinary
ones would give; the ordinary dictionary is trained on the windows of ordinary
documents. Copies count once.
"""
from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from reelhouse.llm.common import materialize, texts

#: Labelled rows that the model is fitted on at most (by order of a hash of the id): the documented bound.
SAMPLE_ROWS = 12_000
#: Tasks that read the sample.
SAMPLE_TASKS = 12
#: Bytes of a window without its blanks, of a run, and of the padding that lets short windows compress.
PIECE, GRAM, PAD = 24, 5, 40
#: Least number of toxic documents and of standard deviations over the expected number for a run to be typical.
LEAST, DEVIATIONS = 3, 6.0
#: Least ratio of its rates in toxic and ordinary documents.
ODDS = 4.0
#: A run or window counts this often in a document at most.
TIMES = 3
#: Least window lengths of the groups that are calibrated together.
SIZES = (0, 5, 7, 10, 15)
#: Typical runs and windows that train a dictionary at most: what comes to the driver is bounded.
RUNS, WINDOWS = 4096, 40_000
TOXIC_BYTES, ORDINARY_BYTES, LEVEL = 8192, 32_768, 5
#: A window counts this often in training at most.
REPEAT = 20
#: Windows whose lengths a task remembers.
CACHE = 400_000
#: Marks of a document by which copies are known.
MARKS = 3
SPAN, SEED, THRESHOLD = 24, 11, 0.7


def held_out(id_col: str):
    """crc32 of the id as text, modulo 3, is 1; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def windows(text: bytes) -> Counter:
    """Windows of a whole text in lower case, with their numbers."""
    words = Counter(text.decode().lower().encode().split())
    long = [w for w in words if len(w) > PIECE]
    for w in long:
        n = words.pop(w)
        for at in range(0, len(w) - PIECE // 2, PIECE // 2):
            words[w[at:at + PIECE]] += n
    return words


def runs(window: bytes) -> set[bytes]:
    padded = b" " + window + b" "
    return {padded[i:i + GRAM] for i in range(max(1, len(padded) - GRAM + 1))}


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary of windows; with too little for the trainer, the windows
    themselves are the dictionary. The trainer looks at places with eight bytes
    to come, so short windows get blanks."""
    padded = [b" " + w + b"   " for w in samples]
    room = sum(map(len, padded))
    try:
        return zstandard.train_dictionary(min(size, max(512, room // 2)), padded, d=6, k=16, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(padded)[-size:]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, dict_size=len(dictionary), source_size=PIECE + PAD, write_content_size=0, write_checksum=0,
        write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=params)


def lengths(packer: zstandard.ZstdCompressor, found: list[bytes]) -> np.ndarray:
    """Compressed length of each window."""
    if not found:
        return np.zeros(0, np.int64)
    padded = [b" " + w + b" " * PAD for w in found]
    n = np.fromiter(map(len, padded), np.uint64, len(padded))
    spans = np.stack([np.cumsum(n) - n, n], 1)
    packed = packer.multi_compress_to_buffer(zstandard.BufferWithSegments(b"".join(padded), spans.tobytes()), threads=1)
    return np.fromiter(map(len, packed), np.int64, len(padded))


@dataclass
class Dictionaries:
    ordinary: bytes
    toxic: bytes
    _packers: Any = None

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic, "_packers": None}

    def distances(self, found: list[bytes]) -> np.ndarray:
        """Length with the ordinary less length with the toxic dictionary, within -SPAN..SPAN."""
        if self._packers is None:
            self._packers = compressor(self.ordinary), compressor(self.toxic)
        a, b = self._packers
        return np.clip(lengths(a, found) - lengths(b, found), -SPAN, SPAN)


@dataclass
class Half:
    """Dictionaries trained on one half of the sample, and what their
    distances mean, found on the other half."""
    dictionaries: Dictionaries
    table: np.ndarray | None = None      # by window length and distance

    def evidence(self, found: list[bytes]) -> np.ndarray:
        return self.table[np.fromiter(map(len, found), np.int64, len(found)), self.dictionaries.distances(found) + SPAN]


@dataclass
class Model:
    halves: list[Half]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def evidence(self, found: list[bytes]) -> np.ndarray:
        return (self.halves[0].evidence(found) + self.halves[1].evidence(found)) / 2

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def measured(column, measure, memory: dict):
    """Yields (first row, windows of each row) for runs of rows, with the
    measure of each of their windows in ``memory``, which is kept between calls."""
    rows, at, new, size = [], 0, {}, 0
    for text in texts(column):
        row = windows(text)
        rows.append(row)
        size += len(row)
        new.update((w, None) for w in row if w not in memory)
        if size > CACHE // 2:
            memory.update(zip(new, measure(list(new)).tolist(), strict=True))
            yield at, rows
            at, rows, new, size = at + len(rows), [], {}, 0
            if len(memory) > CACHE:
                memory.clear()
    memory.update(zip(new, measure(list(new)).tolist(), strict=True))
    yield at, rows


def features(rows: list[Counter], memory: dict[bytes, float]) -> np.ndarray:
    """Of each row: the largest evidence, its sum, its mean and the number of windows above 1, in logarithms."""
    out = np.zeros((len(rows), 4))
    for k, row in enumerate(rows):
        if row:
            n = np.minimum(np.fromiter(row.values(), np.float64, len(row)), TIMES)
            e = np.fromiter((memory[w] for w in row), np.float64, len(row))
            total = float(e @ n)
            out[k] = e.max(), np.log1p(total), np.log1p(50 * total / n.sum()), np.log1p(float(n[e > 1].sum()))
    return out


def _signature(batches):
    """Three smallest hashes, each under its own seed, of the pairs of
    neighbouring words: near copies share at least one but for a small chance."""
    for batch in batches:
        marks = []
        for text in texts(batch.column("t")):
            words = text.lower().split()
            pairs = {a + b" " + b for a, b in zip(words, words[1:], strict=False)} or {b" ".join(words)}
            marks.append([min(xxhash.xxh64_intdigest(x, seed) for x in pairs) - (1 << 63) for seed in range(MARKS)])
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("o", "y", "t")],
                                          *[pa.array([m[k] for m in marks], pa.int64()) for k in range(MARKS)]],
                                         names=["o", "y", "t", *[f"m{k}" for k in range(MARKS)]])


def _table(seen: dict, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in seen], pa.binary()), pa.array([k[1] for k in seen], pa.int32()),
         pa.array([k[2] for k in seen], pa.int32()), pa.array([v[0] for v in seen.values()], pa.int64()),
         pa.array([v[1] for v in seen.values()], pa.int64())], names=[name, "y", "half", "docs", "n"])


def _add(seen: dict, held: Counter, y: int, half: int) -> None:
    for x, n in held.items():
        total = seen.setdefault((x, y, half), [0, 0])
        total[0] += 1
        total[1] += min(n, TIMES)


def _documents(batch):
    return zip(batch.column("o").to_pylist(), batch.column("y").to_pylist(), texts(batch.column("t")), strict=True)


def _runs(batches):
    """Documents and number of each run by label and half."""
    seen: dict = {}
    for batch in batches:
        for o, y, text in _documents(batch):
            held: Counter = Counter()
            for w, n in windows(text).items():
                for r in runs(w):
                    held[r] += n
            _add(seen, held, y, o & 1)
            if len(seen) > CACHE:
                yield _table(seen, "r")
                seen.clear()
    yield _table(seen, "r")


def _windows(typical):
    def run(batches):
        """Documents and number of each window by label and half: of toxic documents those with a typical run, of
        others those without."""
        marks: set[bytes] = typical.value
        seen: dict = {}
        for batch in batches:
            for o, y, text in _documents(batch):
                _add(seen, Counter({w: n for w, n in windows(text).items() if marks.isdisjoint(runs(w)) != bool(y)}),
                     y, o & 1)
                if len(seen) > CACHE:
                    yield _table(seen, "w")
                    seen.clear()
        yield _table(seen, "w")
    return run


def _by_half(batch):
    """Rows of either half with the number of the other one, whose dictionaries have not seen them."""
    half = np.asarray(batch.column("o")) & 1
    for h in (0, 1):
        yield 1 - h, batch.filter(pa.array(half == h))


def _distances(shared):
    def run(batches):
        """Numbers of windows by label, dictionaries, window length and distance."""
        total = np.zeros((2, 2, PIECE + 1, 2 * SPAN + 1), np.int64)
        memories: tuple[dict, dict] = ({}, {})
        for batch in batches:
            for h, part in _by_half(batch):
                label = part.column("y").to_pylist()
                for at, rows in measured(part.column("t"), shared.value[h].dictionaries.distances, memories[h]):
                    for k, row in enumerate(rows):
                        np.add.at(total[label[at + k], h],
                                  (np.fromiter(map(len, row), np.int64, len(row)),
                                   np.fromiter((memories[h][w] for w in row), np.int64, len(row)) + SPAN),
                                  np.minimum(np.fromiter(row.values(), np.int64, len(row)), TIMES))
        found = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([*map(pa.array, found), pa.array(total[found])],
                                         names=["y", "half", "size", "d", "n"])
    return run


def _features(shared):
    def run(batches):
        memories: tuple[dict, dict] = ({}, {})
        for batch in batches:
            for h, part in _by_half(batch):
                for at, rows in measured(part.column("t"), shared.value[h].evidence, memories[h]):
                    yield pa.RecordBatch.from_arrays(
                        [part.column("o").slice(at, len(rows)), part.column("y").slice(at, len(rows)),
                         pa.array(list(features(rows, memories[h])), pa.list_(pa.float64()))], names=["o", "y", "x"])
    return run


def typical_runs(names: list[bytes], n: np.ndarray, docs: np.ndarray, volume: np.ndarray) -> list[set[bytes]]:
    """Runs typical of toxic documents, by half. ``n`` are their numbers,
    ``volume`` those of all runs, by half and label, ``docs`` the toxic
    documents by half."""
    found = []
    for h in (0, 1):
        ordinary, toxic = n[:, h, 0], n[:, h, 1]
        expected = volume[h, 1] * (ordinary + 0.5) / max(volume[h, 0], 1)
        z = (toxic - expected) / np.sqrt(2 * expected + 1)
        order = np.argsort(-z, kind="stable")
        order = order[(docs[order, h] >= LEAST) & (z[order] >= DEVIATIONS) & (toxic[order] >= ODDS * expected[order])]
        found.append({names[i] for i in order[:RUNS]})
    return found


def evidence_table(total: np.ndarray) -> np.ndarray:
    """Log of how much likelier a distance at least so large is in toxic than
    in ordinary documents, by window length, taken from a cautious number of
    the toxic ones. Without data it is 0."""
    group = np.searchsorted(SIZES, np.arange(PIECE + 1), "right") - 1
    grouped = np.zeros((2, len(SIZES), 2 * SPAN + 1))
    np.add.at(grouped, (slice(None), group), total)
    tail = grouped[:, :, ::-1].cumsum(2)[:, :, ::-1]
    ratio = total[1].sum() / max(total[0].sum(), 1)
    if not ratio:
        return np.zeros(total.shape[1:])
    sure = np.maximum(tail[1] - 1.5 * np.sqrt(tail[1]), 0)
    return np.maximum(np.log((sure + ratio) / (tail[0] + 1)) - np.log(ratio), 0)[group]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights and intercept by Newton steps on the penalised log-likelihood."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty + 1e-9), x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(labelled: DataFrame) -> Model | None:
    """A model from rows (o: hash of the id, y: 0 or 1, t: text); None without
    both labels. The caller bounds the rows."""
    context = labelled.sparkSession.sparkContext
    marked = labelled.repartition(SAMPLE_TASKS, "o").mapInArrow(
        _signature, "o long, y int, t string, " + ", ".join(f"m{k} long" for k in range(MARKS)))
    # of rows that share a mark and the label the one with the smallest hash stays
    first = [F.min("o").over(Window.partitionBy("y", f"m{k}")) for k in range(MARKS)]
    sample = materialize(marked.withColumn("first", F.least(*first)).where("o = first").dropDuplicates(["o"])
                         .select("o", "y", "t").repartition(SAMPLE_TASKS, "o"), "toxic-sample")
    if sample.select("y").distinct().count() < 2:
        return None
    spread = sample.mapInArrow(_runs, "r binary, y int, half int, docs long, n long").groupBy("r").agg(
        *[F.sum(F.when((F.col("half") == h) & (F.col("y") == y), F.col(c)).otherwise(0)).alias(f"{c}{h}{y}")
          for c in ("n", "docs") for h in (0, 1) for y in (0, 1)])
    spread = materialize(spread, "toxic-runs")
    cells = ("n00", "n01", "n10", "n11")
    volume = np.array(spread.agg(*[F.sum(c) for c in cells]).first(), dtype=np.int64).reshape(2, 2)
    # the most typical of a half or of both, of which typical_runs() takes its own
    toxic, ordinary = F.col("n01") + F.col("n11"), F.col("n00") + F.col("n10")
    expected = ordinary * float(volume[:, 1].sum() / max(volume[:, 0].sum(), 1))
    top = (spread.where((F.col("docs01") + F.col("docs11") >= LEAST) & (toxic >= expected * ODDS / 2)).orderBy(((toxic - expected) / F.sqrt(2 * expected + 1)).desc(), "r")
           .limit(4 * RUNS).toArrow())
    counts = np.stack([top.column(c).to_numpy() for c in cells], 1).reshape(-1, 2, 2)
    held_by = np.stack([top.column(f"docs{h}1").to_numpy() for h in (0, 1)], 1)
    typical = typical_runs(top.column("r").to_pylist(), counts, held_by, volume)
    marks = context.broadcast(set().union(*typical))
    held = (sample.mapInArrow(_windows(marks), "w binary, y int, half int, docs long, n long").groupBy("w", "y").agg(
        *[F.sum(F.when(F.col("half") == h, F.col("n")).otherwise(0)).alias(f"n{h}") for h in (0, 1)]))
    best = [held.where(F.col("y") == y).orderBy((F.col("n0") + F.col("n1")).desc(), "w").limit(WINDOWS).toArrow()
            for y in (0, 1)]

    def pick(y: int, h: int) -> list[bytes]:
        """Windows of a half, each as often as it is found, in a fixed order."""
        out = [w for w, c in zip(best[y].column("w").to_pylist(), best[y].column(f"n{h}").to_pylist(), strict=True)
               if c and typical[h].isdisjoint(runs(w)) != bool(y) for _ in range(min(c, REPEAT))]
        return [out[i] for i in np.random.default_rng(SEED).permutation(len(out))]

    halves = [Half(Dictionaries(train(pick(0, h), ORDINARY_BYTES), train(pick(1, h), TOXIC_BYTES))) for h in (0, 1)]
    total = np.zeros((2, 2, PIECE + 1, 2 * SPAN + 1), np.int64)
    for r in (sample.mapInArrow(_distances(context.broadcast(halves)), "y long, half long, size long, d long, n long")
              .groupBy("y", "half", "size", "d").agg(F.sum("n").alias("n")).collect()):
        total[r["y"], r["half"], r["size"], r["d"]] = r["n"]
    for h in (0, 1):
        halves[h].table = evidence_table(total[:, h])
    got = sample.mapInArrow(_features(context.broadcast(halves)), "o long, y int, x array<double>").toArrow().sort_by("o")
    x = np.array(got.column("x").to_pylist())
    mean, scale = x.mean(0), x.std(0) + 1e-6
    return Model(halves, mean, scale, logistic((x - mean) / scale, got.column("y").to_numpy()))


def _score(shared):
    def run(batches):
        model: Model | None = shared.value
        memory: dict[bytes, float] = {}
        for batch in batches:
            rest = [c for c in batch.schema.names if c != "_llm_text"]
            scores = [np.full(0, 0.5)]
            if model is None:
                scores.append(np.full(batch.num_rows, 0.5))
            else:
                for _, rows in measured(batch.column("_llm_text"), model.evidence, memory):
                    scores.append(model.score(features(rows, memory)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(np.concatenate(scores))],
                                             names=[*rest, "score"])
    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All columns of ``docs`` plus ``held_out``, ``score`` (0 to 1, higher:
    label 1 likelier) and ``predicted`` (1 if score >= 0.7).

    Labels of held-out ids are never read, and only the text is scored. A null
    text counts as empty and gets the score of a text without windows. A null
    id is not held out and has no label. Rows that repeat an id each get a row;
    an id whose labels disagree is not trained on. Without labels of both
    classes all scores are 0.5. Input columns of these names are replaced."""
    names = {"held_out", "score", "predicted"}
    keep = [c for c in docs.columns if c.lower() not in names]
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("_llm_id")).agg(F.min(label_col).alias("_llm_y"), F.max(label_col).alias("_llm_z"))
             .where(F.col("_llm_y") == F.col("_llm_z")))
    chosen = known.orderBy(F.xxhash64(F.col("_llm_id").cast("string"), F.lit(SEED)), "_llm_id").limit(sample_rows)
    # the sample is bounded, so it may be sent to the tasks that read the texts
    labelled = docs.select(F.col(id_col).alias("_llm_id"), F.col(text_col).alias("t")).join(
        F.broadcast(chosen.select("_llm_id", "_llm_y")), "_llm_id")
    model = fit(labelled.select(F.xxhash64(F.col("_llm_id").cast("string"), F.lit(SEED)).alias("o"),
                                F.col("_llm_y").cast("int").alias("y"), "t"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("_llm_text"))
    schema = StructType([*[docs.schema[c] for c in keep], StructField("score", DoubleType())])
    return (slim.mapInArrow(_score(shared), schema).withColumn("held_out", held_out(id_col))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))
