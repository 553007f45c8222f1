"""LM scoring by subword lattice likelihood.

The pieces of a public vocabulary and its scores give a first unigram model;
``ROUNDS`` of expectation over all segmentations of all training words give the
weights learned from the corpus, with the first model as prior. Words seen in
training are one more edge of the lattice that spans the whole word, with the
discounted share of the word; the pieces have the mass that the discount frees
(so every distinct word weighs the same when the pieces are learned):

    P(word) = max(c - D, 0) / (N + 1) + (D * words + 1) / (N + 1) * sum over segmentations of prod P(piece)

A text's score is the log probability of its words and of the end.

Counts of words are looked up in two ways. Words with at least 1/HEAD of all
training tokens are sent to the tasks: there are at most HEAD of them whatever
the corpus. All others go through a join on the word's hash; no such key is
frequent.
"""
from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.bpe import tokenizer_path
from reelhouse.llm.common import materialize, texts
from reelhouse.llm.lattice import Lattice, vocabulary
from reelhouse.llm.words import word_hashes

#: Words sent to the tasks at most (24 bytes each).
HEAD = 1 << 21
ROUNDS = 2
#: Weight of the first model in the learned one; discount of a word's count.
PRIOR, DISCOUNT = 1e-4, 0.75
#: Distinct words a task counts before it passes them on.
FLUSH = 300_000
_LN10 = float(np.log(10))


def held_out(id_col: str):
    """crc32 of the id as text, modulo 7, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


def _count(batches):
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()).cast(pa.string()),
                                            pa.array(list(seen.values()), pa.int64())], names=["w", "c"])
        seen.clear()
        return batch

    for batch in batches:
        for text in texts(batch.column("_llm_text")):
            seen.update(text.lower().split())        # bytes: A-Z and [\x20\x09-\x0D] only
            if len(seen) > FLUSH:
                yield out()
    if seen:
        yield out()


def _hash(batches):
    for batch in batches:
        h = np.concatenate([np.zeros(0, np.uint64), *[x[3] for x in word_hashes(batch.column("w"))]])
        yield pa.RecordBatch.from_arrays([batch.column("w"), batch.column("c"), pa.array(h.view(np.int64))],
                                         names=["w", "c", "h"])


def _expect(lattice):
    def run(batches):
        model: Lattice = lattice.value
        total = np.zeros(len(model.pieces))
        for batch in batches:
            total += model.expected(batch.column("w").to_pylist(), np.ones(batch.num_rows))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "uses"])
    return run


def learn(counts: DataFrame, tokenizer: str) -> Lattice:
    """The lattice with learned weights. Only one number per piece comes to the
    driver."""
    context = counts.sparkSession.sparkContext
    pieces, byte_pieces, prior = vocabulary(tokenizer_path(tokenizer))
    lattice = Lattice(pieces, byte_pieces, prior)
    for _ in range(ROUNDS):
        rows = counts.select("w").mapInArrow(_expect(context.broadcast(lattice)), "piece long, uses double")
        rows = rows.groupBy("piece").agg(F.sum("uses").alias("uses")).toArrow()
        uses = np.zeros(len(pieces))
        uses[rows.column("piece").to_numpy()] = rows.column("uses").to_numpy()
        if not uses.sum():
            break
        p = uses + PRIOR * uses.sum() * np.exp(prior)
        lattice = Lattice(pieces, byte_pieces, np.log(p / p.sum()))
    return lattice


def _head(lattice):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("c"), pa.array(lattice.value.log_prob(batch.column("w").to_pylist()))],
                names=["h", "c", "lp"])
    return run


PARTS = ("_llm_id {}, words long, known long, base double, lp double, tail_h array<bigint>, tail_n array<int>, tail_lp array<double>")


def _score(lattice, head):
    def run(batches):
        model: Lattice = lattice.value
        known, log_count, log_p = head.value
        for batch in batches:
            ids = batch.column("_llm_id")
            for lo, n, rows, h, a, b, buf in word_hashes(batch.column("_llm_text"), spans=True):
                at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                hit = known[at] == h if len(known) else np.zeros(len(h), bool)
                r, at = rows[hit], at[hit]
                base, lp = np.bincount(r, log_count[at], n), np.bincount(r, log_p[at], n)  # of frequent words
                rest = np.flatnonzero(~hit)
                new, first, back = np.unique(h[rest], return_index=True, return_inverse=True)
                first = rest[first]
                words = [buf[s:e].tobytes().lower().decode() for s, e in zip(a[first], b[first], strict=True)]
                tail_lp = model.log_prob(words)
                key, times = np.unique(rows[rest] * max(len(new), 1) + back, return_counts=True)
                ends = np.searchsorted(key // max(len(new), 1), np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, n), pa.array(np.bincount(rows, minlength=n)), pa.array(np.bincount(r, minlength=n)),
                     pa.array(base), pa.array(lp),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(new[key % max(len(new), 1)].view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(tail_lp[key % max(len(new), 1)]))],
                    names=["_llm_id", "words", "known", "base", "lp", "tail_h", "tail_n", "tail_lp"])
    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              tokenizer: str = "piece_bpe_32k.model") -> DataFrame:
    """id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one word unigrams) and ``score`` (lattice), both log10,
    of every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; every text ends with
    one end token. The model is learned from rows that are not held out. Null
    and empty texts are the end alone. A null id is not held out; rows that
    repeat an id count and are scored one by one. Without training rows the
    vocabulary's own scores are used. An empty table gives an empty table.
    Other columns are not read."""
    context = docs.sparkSession.sparkContext
    slim = docs.select(F.col(id_col).alias("_llm_id"), F.col(text_col).alias("_llm_text"))
    train = slim.where(~held_out("_llm_id"))
    n_train = train.count()
    counts = train.select("_llm_text").mapInArrow(_count, "w string, c long").groupBy("w").agg(F.sum("c").alias("c"))
    counts = materialize(counts.mapInArrow(_hash, "w string, c long, h long"), "word-counts")
    distinct, total = counts.agg(F.count(F.lit(1)), F.sum("c")).first()
    n_tokens, n_types = (total or 0) + n_train, distinct + (n_train > 0)
    lattice = learn(counts, tokenizer)
    shared = context.broadcast(lattice)
    least = max(1, -(-n_tokens // HEAD))
    free = float(DISCOUNT * distinct + 1) / (n_tokens + 1) if n_train else 0.5
    log_end = float(np.log(n_train / (n_tokens + 1))) if n_train else float(np.log(0.5))
    top = counts.where(F.col("c") >= least).mapInArrow(_head(shared), "h long, c long, lp double").toArrow()
    h, c = top.column("h").to_numpy().view(np.uint64), top.column("c").to_numpy()
    log_p = np.log((c - DISCOUNT) / (n_tokens + 1) + free * np.exp(top.column("lp").to_numpy()))
    order = np.argsort(h)
    head = context.broadcast((h[order], np.log10(c[order] + 1), log_p[order]))
    kind = slim.schema["_llm_id"].dataType.simpleString()
    parts = materialize(slim.mapInArrow(_score(shared, head), PARTS.format(kind)).withColumn(
        "_llm_row", F.monotonically_increasing_id()), "score-parts")
    zipped = F.explode(F.arrays_zip("tail_h", "tail_n", "tail_lp")).alias("t")
    tail = parts.select("_llm_row", zipped).select("_llm_row", F.col("t.tail_h").alias("h"), "t.tail_n", "t.tail_lp")
    seldom = counts.where(F.col("c") < least).select("h", "c")
    # log of a sum, taken so that a very small share of the pieces does not vanish
    pieces = F.col("tail_lp") + float(np.log(free))
    own = F.log((F.col("c") - DISCOUNT) / float(n_tokens + 1))
    both = F.greatest(own, pieces) + F.log1p(F.exp(-F.abs(own - pieces)))
    tail = tail.join(seldom, "h", "left").groupBy("_llm_row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("tail_n"))).alias("tail_known"),
        F.sum(F.col("tail_n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("tail_base"),
        F.sum(F.col("tail_n") * F.coalesce(both, pieces)).alias("tail_lp"))
    out = parts.drop("tail_h", "tail_n", "tail_lp").join(tail, "_llm_row", "left")
    words = F.col("words") + 1
    end_base = float(np.log10(n_train + 1))
    return out.select(
        F.col("_llm_id").alias(id_col), held_out("_llm_id").alias("held_out"), words.alias("n_tokens"),
        (F.col("known") + F.coalesce("tail_known", F.lit(0)) + int(n_train > 0)).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", F.lit(0.0)) + end_base
         - words * float(np.log10(n_tokens + n_types + 1))).alias("base_score"),
        ((F.col("lp") + F.coalesce("tail_lp", F.lit(0.0)) + log_end) / _LN10).alias("score"))
