"""Source divergence audit over a minimal acyclic transducer vocabulary.

1. Terms are counted by language and document; each language keeps those in at
   least ``LEAST`` of its documents.
2. The kept terms, sorted, are cut into ranges of about ``SHARD_TERMS``; a task
   builds the transducer of a range, which turns a term into its lexicographic
   ordinal in the language.
3. The texts are streamed through the transducers and recounted by ordinal;
   a task passes its counts on as arrays, one for each source and range of
   ordinals, which are added up range by range.
   Transducers of up to ``BROADCAST_BYTES`` in all are sent to the tasks that
   read the texts; larger ones stay where they are, and the texts' term counts
   are dealt to them by range.
4. Divergences are integer sums. In a block of terms only what differs from
   "no occurrence" is computed, for pairs of sources that hold a term; blocks
   give sums by pair of sources, which are added.
"""
from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.common import materialize, texts
from reelhouse.llm.transducer import Transducer

#: Documents of the language that a kept term is in at least; rows of a term part.
LEAST, RANKS = 3, 200
SHARD_TERMS = 1 << 17
BROADCAST_BYTES = 64 << 20
#: Terms of a block whose divergences a task sums, and parts that sources are dealt in.
BLOCK_TERMS, SALTS = 1 << 14, 16
#: Distinct terms a task counts before it passes them on.
FLUSH = 600_000
#: Ordinals of an array of counts.
COUNT_ORDS = 1 << 11
#: Lowers A-Z and blanks the ASCII bytes that are no letters: what is left between blanks is the terms.
_LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in bytes(range(256)).lower())


def _terms(text: bytes) -> list[bytes]:
    """The matches of [^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+ with A-Z lowered."""
    return text.translate(_LETTERS).split()


def _held(batches):
    """Documents of each language that hold a term."""
    seen: dict[str, Counter] = {}
    size = 0

    def out():
        for lang, held in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(held)), pa.array(list(held), pa.binary()).cast(pa.string()),
                 pa.array(list(held.values()), pa.int64())], names=["lang", "term", "docs"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch.column("text")), strict=True):
            held = seen.setdefault(lang, Counter())
            size -= len(held)
            held.update(set(_terms(text)))
            size += len(held)
            if size > FLUSH:
                yield from out()
                seen, size = {}, 0
    yield from out()


def _build(batches):
    """A transducer of each language of a range of sorted terms."""
    lang, held = None, []

    def out():
        made = Transducer.build(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang], pa.string()), pa.array([held[0]], pa.binary()), pa.array([made.n], pa.int64()),
             pa.array([made.to_bytes()], pa.binary())], names=["lang", "first", "n", "states"])

    for batch in batches:
        for at, term in zip(batch.column("lang").to_pylist(), texts(batch.column("term")), strict=True):
            if at != lang and held:
                yield out()
                held = []
            lang = at
            held.append(term)
    if held:
        yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """lang, first, n, states, base: transducers by language and range of
    terms, with the number of the language's terms before them."""
    kept = (docs.select("lang", "text").mapInArrow(_held, "lang string, term string, docs long")
            .groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= LEAST).select("lang", "term"))
    kept = materialize(kept, "kept-terms")
    shards = max(1, -(-kept.count() // SHARD_TERMS))
    built = (kept.repartitionByRange(shards, "lang", "term").sortWithinPartitions("lang", "term")
             .mapInArrow(_build, "lang string, first binary, n long, states binary"))
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(materialize(built, "transducers").withColumn(
        "base", F.coalesce(F.sum("n").over(before), F.lit(0))), "vocabulary")


def _look_up(shards: list, found: list[bytes]) -> np.ndarray:
    """Ordinals of sorted terms in a language's transducers [(first, base, transducer)]."""
    if len(shards) == 1:
        local = shards[0][2].ordinals(found)
        return np.where(local >= 0, local + shards[0][1], -1)
    out = np.full(len(found), -1, np.int64)
    cut = [*[bisect_left(found, first) for first, _, _ in shards], len(found)]
    for (_, base, made), a, b in zip(shards, cut[:-1], cut[1:], strict=True):
        local = made.ordinals(found[a:b])
        out[a:b] = np.where(local >= 0, local + base, -1)
    return out


def _streamed(batches, done):
    """Counts of terms by language and source of whole texts, passed on when they are many."""
    seen: dict[tuple[str, str], Counter] = {}
    size = 0
    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(),
                                      texts(batch.column("text")), strict=True):
            held = seen.setdefault((lang, source), Counter())
            size -= len(held)
            held.update(_terms(text))
            size += len(held)
            if size > FLUSH:
                yield from done(seen)
                seen, size = {}, 0
    yield from done(seen)


def _recount(shared):
    def run(batches):
        made = {lang: [(first, base, Transducer.from_bytes(states)) for first, base, states in shards]
                for lang, shards in shared.value.items()}

        def done(seen):
            for (lang, source), held in seen.items():
                if lang in made and held:
                    found = sorted(held)
                    at = _look_up(made[lang], found)
                    n = np.fromiter((held[t] for t in found), np.int64, len(found))
                    at, n = at[at >= 0], n[at >= 0]          # in ascending order, as the terms are
                    span, first = np.unique(at // COUNT_ORDS, return_index=True)
                    ends = pa.array(np.append(first, len(at)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(lang, len(span)), pa.repeat(source, len(span)), pa.array(span),
                         pa.ListArray.from_arrays(ends, pa.array((at % COUNT_ORDS).astype(np.int32))),
                         pa.ListArray.from_arrays(ends, pa.array(n))], names=["lang", "source", "span", "ords", "n"])

        yield from _streamed(batches, done)
    return run


def _added(batches):
    """Counts by ordinal from arrays sorted by language, source and range; only the sums of one range are held."""
    last, total = None, np.zeros(COUNT_ORDS, np.int64)

    def out():
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays(
            [pa.repeat(last[0], len(at)), pa.repeat(last[1], len(at)), pa.array(at + last[2] * COUNT_ORDS), pa.array(total[at])],
            names=["lang", "source", "ord", "n"])

    for batch in batches:
        ords = batch.column("ords")
        cut = np.concatenate([[0], np.cumsum(pc.list_value_length(ords).to_numpy(zero_copy_only=False))]).astype(np.int64)
        at, uses = ords.flatten().to_numpy(), batch.column("n").flatten().to_numpy()
        keys = zip(*(batch.column(k).to_pylist() for k in ("lang", "source", "span")), strict=True)
        for key, a, b in zip(keys, cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if key != last:
                if last is not None:
                    yield out()
                last = key
                total[:] = 0
            total[at[a:b]] += uses[a:b]          # an ordinal is in an array once
    if last is not None:
        yield out()


def _dealt(firsts):
    def run(batches):
        def done(seen):
            for (lang, source), held in seen.items():
                if lang in firsts.value and held:
                    found = list(held)
                    shard = [max(bisect_right(firsts.value[lang], t) - 1, 0) for t in found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(lang, len(found)), pa.repeat(source, len(found)),
                         pa.array(found, pa.binary()), pa.array(shard, pa.int32()), pa.array(list(held.values()), pa.int64())],
                        names=["lang", "source", "term", "shard", "n"])

        yield from _streamed(batches, done)
    return run


def _at_shard(terms: pa.Table, shard: pa.Table) -> pa.Table:
    base, states = shard.column("base")[0].as_py(), shard.column("states")[0].as_py()
    found = terms.column("term").to_pylist()
    at = Transducer.from_bytes(states).ordinals(found) if found else np.zeros(0, np.int64)
    ok = pa.array(at >= 0)
    return pa.table({"lang": terms.column("lang").filter(ok), "source": terms.column("source").filter(ok),
                     "ord": pa.array((at + base)[at >= 0]), "n": terms.column("n").filter(ok)})


def recount(docs: DataFrame, words: DataFrame) -> DataFrame:
    """lang, source, ord, n: occurrences of each kept term."""
    rows = docs.select("lang", "source", "text")
    if (words.agg(F.sum(F.octet_length("states"))).first()[0] or 0) <= BROADCAST_BYTES:
        made: dict = {}
        for r in words.select("lang", "first", "base", "states").orderBy("lang", "first").collect():
            made.setdefault(r["lang"], []).append((bytes(r["first"]), r["base"], bytes(r["states"])))
        parts = rows.mapInArrow(_recount(docs.sparkSession.sparkContext.broadcast(made)),
                                "lang string, source string, span long, ords array<int>, n array<long>")
        place = ["lang", "source", "span"]
        return parts.repartition(*place).sortWithinPartitions(*place).mapInArrow(
            _added, "lang string, source string, ord long, n long")
    else:
        # one first term a shard: one for SHARD_TERMS terms
        firsts: dict = {}
        for r in words.select("lang", "first").orderBy("lang", "first").collect():
            firsts.setdefault(r["lang"], []).append(bytes(r["first"]))
        found = rows.mapInArrow(_dealt(docs.sparkSession.sparkContext.broadcast(firsts)),
                                "lang string, source string, term binary, shard int, n long")
        found = (found.groupBy("lang", "source", "term", "shard").agg(F.sum("n").alias("n"))
                 .withColumn("salt", F.pmod(F.xxhash64("source"), F.lit(SALTS))))
        place = Window.partitionBy("lang").orderBy("first")
        shards = (words.withColumn("shard", F.row_number().over(place) - 1)
                  .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))))
        parts = found.groupBy("lang", "shard", "salt").cogroup(shards.groupBy("lang", "shard", "salt")).applyInArrow(
            _at_shard, "lang string, source string, ord long, n long")
    return parts.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n"))


def _div(a: Column, b: Column) -> Column:
    """Quotient of whole numbers that are not negative."""
    return F.call_function("div", a, b)


def share(n: Column, total: Column) -> Column:
    """1 + floor(10^9 * n / total), by long division in steps of 1000 so that
    nothing overflows below 9e15."""
    total = F.greatest(total, F.lit(1).cast("long"))
    q, r = _div(n, total), n % total
    for _ in range(3):
        r = r * 1000
        q, r = q * 1000 + _div(r, total), r % total
    return q + 1


def distance(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _pairs(block: pa.Table, profile: pa.Table) -> pa.Table:
    """Of a block of terms: by pair of sources the sum of the divergences less
    what they would be without any occurrence."""
    none = np.array(profile.column("none")[0].as_py(), np.int64)     # p of a term without occurrence, by source
    s = len(none)
    total = np.zeros((s, s), np.int64)
    base = _f(none[:, None], none[None])
    held = pa.concat_arrays(block.column("held").chunks or [pa.array([], block.schema.field("held").type)])
    counts = pc.list_value_length(held).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = held.flatten()
    at, p = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    start = np.cumsum(counts) - counts
    # one side has the term: equal (source, p) are computed once
    both, times = np.unique(np.stack([at, p], 1).reshape(-1, 2), axis=0, return_counts=True)
    for lo in range(0, len(both), 4096):
        g, x, m = both[lo:lo + 4096, 0], both[lo:lo + 4096, 1], times[lo:lo + 4096, None]
        np.add.at(total, g, m * (_f(x[:, None], none[None]) - base[g]))
        np.add.at(total.T, g, m * (_f(none[None], x[:, None]) - base.T[g]))
    # both sides have it
    for k in np.unique(counts[counts > 1]).tolist():
        rows = start[counts == k]
        step = max(1, (1 << 20) // (k * k))
        for lo in range(0, len(rows), step):
            take = rows[lo:lo + step, None] + np.arange(k)
            g, x = at[take], p[take]
            gi, gj, xi, xj = g[:, :, None], g[:, None], x[:, :, None], x[:, None]
            more = _f(xi, xj) - _f(xi, none[gj]) - _f(none[gi], xj) + base[gi, gj]
            np.add.at(total, (np.broadcast_to(gi, more.shape), np.broadcast_to(gj, more.shape)), more)
    i, j = np.nonzero(~np.eye(s, dtype=bool))
    lang = profile.column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(i), pa.string()), "i": pa.array(i), "j": pa.array(j),
                     "more": pa.array(total[i, j])})


def _spell(batches):
    for batch in batches:
        for lang, base, states in zip(batch.column("lang").to_pylist(), batch.column("base").to_pylist(),
                                      batch.column("states").to_pylist(), strict=True):
            names = list(Transducer.from_bytes(states).terms())
            for lo in range(0, len(names), 1 << 16):
                part = names[lo:lo + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array(np.arange(len(part)) + base + lo),
                     pa.array(part, pa.binary()).cast(pa.string())], names=["lang", "ord", "item"])


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                      source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: item is each other source of the language, value the sum of
    the divergences of the source's term shares from that source's over all
    kept terms (0 if the language keeps none). Part ``term``: the ``RANKS``
    terms that stand out most against the language. Ranks go by value
    descending; ties by ordinal, which is the terms' UTF-8 order, or by UTF-8
    order of the source. Null text, language and source are ''. Rows are
    documents, so repeated rows count again. A group whose texts have no terms
    is in part ``pair``; a language with one source has no pairs. An empty
    table gives an empty table. Other columns are not read."""
    empty = F.lit("")
    rows = docs.select(F.coalesce(F.col(text_col), empty).alias("text"), F.coalesce(F.col(lang_col), empty).alias("lang"),
                       F.coalesce(F.col(source_col), empty).alias("source"))
    words = vocabulary(rows)
    counts = materialize(recount(rows, words), "term-counts")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("v"))
    zero = F.lit(0).cast("long")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (rows.groupBy("lang", "source").count().drop("count").join(totals, ["lang", "source"], "left")
              .join(sizes, "lang", "left").select("lang", "source", F.coalesce("total", zero).alias("total"),
                                                  F.coalesce("v", zero).alias("v")))
    place = Window.partitionBy("lang").orderBy("source")
    groups = groups.withColumn("at", (F.row_number().over(place) - 1).cast("long")).withColumn(
        "none", share(F.lit(1).cast("long"), F.col("total") + F.col("v")))
    groups = materialize(groups, "groups")

    held = counts.join(groups.select("lang", "source", "at", "total", "v"), ["lang", "source"]).withColumn(
        "p", share(F.col("n") + 1, F.col("total") + F.col("v")))
    # a term's sources, in one row
    terms = held.groupBy("lang", "ord").agg(F.collect_list(F.struct("at", "p", "source")).alias("held"),
                                            F.sum("n").alias("n"))
    terms = materialize(terms, "term-sources")
    n_terms = words.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-n_terms // BLOCK_TERMS))
    block = F.pmod(F.xxhash64("lang", "ord"), F.lit(blocks)).alias("block")
    profile = (groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "none"))).alias("g"))
               .select("lang", F.col("g.none").alias("none"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")))
    sums = (terms.select("lang", block, F.transform("held", lambda x: F.struct(x["at"], x["p"])).alias("held"))
            .groupBy("lang", "block").cogroup(profile.groupBy("lang", "block"))
            .applyInArrow(_pairs, "lang string, i long, j long, more long")
            .groupBy("lang", "i", "j").agg(F.sum("more").alias("more")))
    a = groups.select("lang", "source", F.col("at").alias("i"), F.col("none").alias("p"), "v")
    b = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("j"), F.col("none").alias("q"))
    pairs = a.join(b, (a["lang"] == b["lang"]) & (a["i"] != b["j"])).drop(b["lang"])      # as many as the result has
    pairs = pairs.join(sums, ["lang", "i", "j"], "left").withColumn(
        "value", F.col("v") * distance(F.col("p"), F.col("q")) + F.coalesce("more", zero))
    first = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                         F.row_number().over(first).alias("rank"))

    of_lang = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("v").alias("v"))
    marked = terms.join(of_lang, "lang").withColumn(
        "q", share(F.col("n") + 1, F.col("total") + F.col("v")))
    marked = (marked.select("lang", "ord", "q", F.explode("held").alias("h")).select("lang", "ord", "q", "h.source", "h.p")
              .where("p > q").withColumn("value", distance(F.col("p"), F.col("q"))))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "ord")
    marked = marked.select("lang", "source", "ord", "value", F.row_number().over(best).alias("rank")).where(
        F.col("rank") <= RANKS)
    names = words.select("lang", "base", "states").mapInArrow(_spell, "lang string, ord long, item string")
    marked = marked.join(names, ["lang", "ord"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(marked)
