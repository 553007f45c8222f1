"""Toxicity, spelling variants and source divergence against brute force and held-out labels."""
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from reelhouse.llm import op12_variants, op13_divergence, queries
from reelhouse.llm.op11_toxic import Dictionaries, toxicity_scores, train, windows
from reelhouse.llm.op12_variants import spelling_variants
from reelhouse.llm.op13_divergence import source_divergence
from reelhouse.llm.transducer import Transducer

COLUMNS = "doc_id long, text string, lang string, source string, word string, score string, held string"


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty texts, repeated rows and ids, ties, a long run, clashing columns."""
    rng = random.Random(5)
    words = ["variante", "varianten", "varianté", "Variante", "VARIANTES", "short", "à×÷ÿabcd",
             "aaaaaaa", "aaaaaaaa", "baaaaaaa", "aaaabaaa"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60))), rng.choice(["xx", "yy", None]),
             rng.choice(["s1", "s2", "s3", None])) for i in range(60)]
    rows += [(i, "variante " * 40, "xx", "s1") for i in (7, 7, 61)]
    rows += [(None, "variante varianten", None, None), (62, None, "xx", "s4"), (63, "", "zz", "s1"), (64, "1 2 3", "zz", "s2"),
             (65, "w" * 30_000 + " " + "w" * 29_999 + "x " + "w" * 30_000 + " " + "w" * 29_999 + "x", "xx", "s1"),
             (66, "日本 日本 x́\u0000y \U0001d11e", "yy", "s1")]
    return spark.createDataFrame([(*r, "w", "s", "h") for r in rows], COLUMNS)


def near_by_deletion(words):
    """Words one edit apart, from shared deletions."""
    near, holes = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            rest = w[:k] + w[k + 1:]
            holes[k, rest].add(w)
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute_variants(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if n >= 2 and len(w) >= 7}
    near, form, out = near_by_deletion(words), {}, set()
    for w, n in words.items():
        top = min(((-words[x], x) for x in near[w]), default=(0, None))
        form[w] = top[1] if top[1] and -top[0] >= 10 * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n, len(near[w]), form[w], words.get(form[w]), root))
    return out


@pytest.mark.parametrize("block, cells", [(2048, 1 << 23), (2, 1 << 10)])
def test_spelling_variants(spark, edge, monkeypatch, block, cells):
    """With small blocks every group is cut and meets by pairs of blocks."""
    monkeypatch.setattr(op12_variants, "BLOCK", block)
    monkeypatch.setattr(op12_variants, "CELLS", cells)
    rng = random.Random(9)
    base = ["".join(rng.choice("abc") for _ in range(rng.randrange(7, 10))) for _ in range(150)]
    rows = [(i, " ".join(rng.choice(base) for _ in range(300))) for i in range(20)]
    rows += [(100, "keyboard " * 3000 + "keybord " * 200 + "keybrd " * 15)]
    rows += [(r.doc_id, r.text if len(r.text or "") < 1000 else r.text[:900]) for r in edge.collect()]
    got = spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == brute_variants(rows) and len(got) == len({r.word for r in got})


def test_spelling_variants_of_long_runs(edge):
    found = {(len(r.word), r.n, r.n_near) for r in spelling_variants(edge).collect() if len(r.word) > 1000}
    assert found == {(30_000, 2, 1), (30_000, 2, 1)}


def test_transducer():
    rng = random.Random(3)
    terms = sorted({bytes(rng.choice(b"abz\xc3\xa9") for _ in range(rng.randrange(1, 9))) for _ in range(3000)})
    made = Transducer.from_bytes(Transducer.build(terms).to_bytes())
    assert list(made.terms()) == terms and made.n == len(terms)
    assert made.ordinals(terms).tolist() == list(range(len(terms)))
    others = [t + b"q" for t in terms[:50]] + [b"", b"q", b"a" * 100_000]
    assert (made.ordinals(others) == -1).all()
    # equal endings are one state: far fewer than the bytes of all terms
    assert len(made.final) < len({t[:k] for t in terms for k in range(len(t) + 1)})
    assert Transducer.build([]).ordinals([b"a", b""]).tolist() == [-1, -1]
    assert list(Transducer.build([b"", b"a"]).terms()) == [b"", b"a"]


@pytest.mark.parametrize("way", ["broadcast", "dealt", "many"])
def test_source_divergence(edge, monkeypatch, way):
    """One transducer, many of them, and transducers that are not sent to the texts."""
    if way != "broadcast":
        monkeypatch.setattr(op13_divergence, "SHARD_TERMS", 2)
    if way == "dealt":
        monkeypatch.setattr(op13_divergence, "BROADCAST_BYTES", 0)
    documents = edge.select("text", "lang", "source").toPandas()      # noqa: F841
    want = duckdb.sql(queries.ORACLE["op13_source_divergence"])
    got = source_divergence(edge)
    names = sorted(got.columns)
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == \
        sorted(map(str, want.project(",".join(names)).fetchall()))


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    out = queries.op11_toxicity(spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    assert len(out) == 10_000 and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.doc_id]).all()
    assert (out.predicted == (out.score >= 0.7)).all()
    seen = out[out.held_out].merge(labels, on="doc_id")
    bad, good = seen[seen.toxic == 1], seen[seen.toxic == 0]
    assert (bad.score.values[:, None] > good.score.values[None]).mean() > 0.95
    assert bad.predicted.mean() > 0.6 and good.predicted.mean() < 0.01
    # calibration: the mean score is near the share of label 1, also among the likely ones
    assert abs(seen.score.mean() - seen.toxic.mean()) < 0.03
    assert seen[seen.score >= 0.7].toxic.mean() > 0.9


def test_toxicity_edges(spark, edge):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = toxicity_scores(edge, labels).collect()
    assert {r.score for r in out} == {0.5} and len(out) == edge.count()
    # few labels: a score for every row, the same for empty and null texts
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    out = toxicity_scores(edge, labels).collect()
    assert len(out) == edge.count() and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if not r.text}) == 1 and all(r.word == "w" for r in out)


def test_dictionaries_tell_texts_apart():
    pair = Dictionaries(train([b"ordinary", b"plainly"] * 200, 4096), train([b"nastyword"] * 200, 4096))
    d = pair.distances([b"nastyword", b"ordinary"])
    assert d[0] > 2 and d[1] < -2
    assert windows(b"a" * 60 + b" B b") == Counter({b"b": 2, b"a" * 24: 4})


def test_empty_tables(edge, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (toxicity_scores(edge.limit(0), labels), spelling_variants(edge.limit(0)), source_divergence(edge.limit(0))):
        assert out.count() == 0
