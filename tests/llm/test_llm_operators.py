"""The ten operators against brute force, on small hand-made and given tables."""
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_brute import brute_near, low
from reelhouse.llm import op2_neardup, op8_warc, queries
from reelhouse.llm.bpe import StreamDecoder, decode, load, tokenizer_path
from reelhouse.llm.components import components, union_find
from reelhouse.llm.lattice import MARK, Lattice, vocabulary
from reelhouse.llm.op1_lines import MinimalPerfectHash, line_dedup
from reelhouse.llm.op10_decontam import MASKS, decontaminate
from reelhouse.llm.op2_neardup import near_duplicates, signatures
from reelhouse.llm.op3_bpe import bpe_documents
from reelhouse.llm.op4_quality import quality_scores
from reelhouse.llm.op5_exact import DigestIndex, exact_dedup
from reelhouse.llm.op6_counts import TokenCounter, token_counts
from reelhouse.llm.op7_lm import lm_scores
from reelhouse.llm.op9_html import extract_pages, main_text
from reelhouse.llm.words import word_hashes

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, n_lines string, n_tokens string, contaminated string, score string"
LONG = "a line that is long enough to count"


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and odd texts, repeated rows and ids, clashing columns."""
    texts = [(1, f"{LONG}\nown line of the first document"), (2, f"  {LONG.upper()}\t\nshort"), (3, LONG),
             (3, LONG), (4, None), (5, ""), (6, "\n\n"), (None, LONG), (7, "word " * 4000 + "\n" + "x" * 70000),
             (8, "one"), (9, "one"), (10, "Ünï <|endoftext|> 'S ΑΣ\x1c\x85 z"), (11, None)]
    return spark.createDataFrame([(i, t, None, "n", None, "c", "s") for i, t in texts], DOCS)


@pytest.fixture(scope="module")
def empty(edge):
    return edge.limit(0)


def test_empty_tables_give_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for out in (line_dedup(empty), near_duplicates(empty), bpe_documents(empty), quality_scores(empty, labels),
                exact_dedup(empty), token_counts(empty), lm_scores(empty), decontaminate(empty, bench),
                op8_warc.warc_pages(pages), extract_pages(pages)):
        assert out.count() == 0


def test_minimal_perfect_hash():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, (5000, 2)).astype(np.uint64)
    h[:2500, 0] = h[0, 0]                             # equal first halves
    mph = MinimalPerfectHash.build(h[:, 0], h[:, 1])
    again = MinimalPerfectHash.from_bytes(mph.to_bytes())
    assert sorted(again.number(h[:, 0], h[:, 1]).tolist()) == list(range(5000))


def test_line_dedup(edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    key = lambda x: x.strip(b" \t\n\x0b\x0c\r").lower()
    held = {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").encode().split(b"\n")}:
            if len(k.decode()) >= 20:
                held.setdefault(k, []).append(-1 if i is None else i)
    want = []
    for i, t in rows:
        lines = (t or "").encode().split(b"\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 3 or max(held[key(x)]) == i]
        want.append((i, b"\n".join(kept).decode(), len(lines), len(lines) - len(kept), None))
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped, r.lang) for r in line_dedup(edge).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert (3, LONG, 1, 0, None) in got and (None, "", 1, 1, None) in got


def near_rows(out):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in out.collect()}


def test_near_duplicates_edges(edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert near_rows(near_duplicates(edge, k=2)) == brute_near(rows, 2, 80)


@pytest.mark.parametrize("open_", [op2_neardup.OPEN, 3])
def test_near_duplicates_hot_group(spark, monkeypatch, open_):
    """A group around the threshold, mostly linked through others; with a small
    OPEN the rounds of centres run."""
    monkeypatch.setattr(op2_neardup, "OPEN", open_)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(70):
        words = list(base)
        for _ in range(rng.choice([0, 1, 3, 4, 5])):
            words[rng.randrange(60)] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2)
    assert near_rows(out) == brute_near(rows, 2, 80)


def test_superminhash_estimates():
    rng = np.random.default_rng(0)
    for n, j in ((5, 0.6), (200, 0.8), (3000, 0.5)):
        found = []
        for _ in range(20):
            u = rng.integers(0, 2**63, n).astype(np.uint64)
            c = int(n * j)
            a, b = np.sort(u[:c + (n - c) // 2]), np.sort(np.concatenate([u[:c], u[c + (n - c) // 2:]]))
            s = signatures([a, b])
            found.append((s[0] == s[1]).mean())
        assert abs(np.mean(found) - c / n) < 0.03


def test_components_by_stars(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    frame = spark.createDataFrame(links, "a long, b long").where("a <> b")
    for size in (10**6, 40):
        got = {r.node: r.top for r in components(frame, size).collect()}
        assert got == {k: v for k, v in union_find([x for x in links if x[0] != x[1]]).items()}


def odd_texts():
    rng = random.Random(1)
    letters = "abcdefghijklmnoprstuvwxyzéßthe"
    return ["", "  ", "it's 'sing !!'s <|endoftext|><|startoftext|> x", "ΑΣ İstanbul ﬁ é", "a\x1cb\x85c​d",
            "日本語 12345 ½", "".join(rng.choice(letters) for _ in range(9000)), "ab" * 4000, "!?" * 2000 + "'s" * 900,
            "<|endof <|endoftext|", " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 12)))
                                             for _ in range(30000))]


def test_bpe_and_counts_as_the_library():
    from tokenizers import Tokenizer
    path = tokenizer_path("word_bpe_49k.json")
    library, (table, encoder), counter = Tokenizer.from_file(path), load(path), TokenCounter(path)
    texts = odd_texts()
    for text, raw, n in zip(texts, encoder.encode(texts), counter.count(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        ids = np.frombuffer(raw, "<u4")
        assert ids.tolist() == want and n == len(want)
        assert decode(table, ids) == library.decode(want, skip_special_tokens=False)
        assert counter.count_huge(text, 2500, 1100) == len(want)


def test_byte_decoder_is_incremental():
    table, encoder = load(tokenizer_path("word_bpe_49k.json"))
    ids = np.frombuffer(encoder.encode(["日本 é 𝄞 it's"])[0], "<u4").tolist()
    machine = StreamDecoder(table, "text")
    assert "".join([*[machine.feed([i]) for i in ids], machine.close()]) == "日本 é 𝄞 it 's "


def test_bpe_documents(edge):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    for r in bpe_documents(edge, keep=["doc_id", "text"]).collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
    for r in token_counts(edge.withColumn("n_bytes", F.lit(1))).join(edge.select("doc_id", "text"), "doc_id").collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((r.text or "").encode()), n > 2048)


def test_quality_held_out(spark):
    out = queries.op4_quality(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    assert len(out) == 1000 and out.score.between(0, 1).all() and out.score.notna().all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    assert (out.predicted == (out.score >= 0.3)).all()
    seen = out[out.held_out].merge(labels, on="doc_id")
    good, bad = seen[seen.quality == 1].score.values, seen[seen.quality == 0].score.values
    assert (good[:, None] > bad[None]).mean() > 0.85 and (seen.predicted == seen.quality).mean() > 0.9


def test_quality_without_labels(spark, edge):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_scores(edge, labels).collect()} == {0.5}


def test_exact_dedup(spark, edge):
    rows = [(r.doc_id, low(r.text)) for r in edge.collect()]
    groups = {}
    for i, t in rows:
        groups.setdefault(t, []).append(i)
    top = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    want = sorted((str(i), str(top[t]), len(groups[t]), i == top[t], hashlib.sha256(t).hexdigest()) for i, t in rows)
    got = exact_dedup(edge).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got) == want


def test_exact_dedup_goes_on_with_an_index(spark):
    index = DigestIndex(spark, buckets=4)
    first = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(9, "a"), (10, "c"), (11, "C")], "doc_id long, text string")
    assert {(r.doc_id, r.kept) for r in exact_dedup(first, index).collect()} == {(1, False), (2, True), (3, True)}
    got = {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup(second, index).collect()}
    assert got == {(9, 2, False), (10, 11, False), (11, 11, True)}
    assert index.table().count() == 3
    # both batches again: the same answers, nothing added
    assert {(r.doc_id, r.kept) for r in exact_dedup(first, index).collect()} == {(1, False), (2, True), (3, True)}
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup(second, index).collect()} == got
    assert index.table().count() == 3


def test_lattice_against_all_segmentations():
    pieces, byte_pieces, log_p = vocabulary(tokenizer_path("piece_bpe_32k.model"))
    lattice, known = Lattice(pieces, byte_pieces, log_p), {p: i for i, p in enumerate(pieces) if p}

    def brute(word):
        if not word:
            return 1.0
        total = 0.0
        for n in range(1, len(word) + 1):
            if word[:n] in known:
                total += np.exp(log_p[known[word[:n]]]) * brute(word[n:])
            elif n == 1:
                total += np.exp(sum(log_p[byte_pieces[b]] for b in word[:1].encode())) * brute(word[1:])
        return total

    words = ["the", "hello", "éouß", "日𝄞", "x"]
    assert np.allclose(lattice.log_prob(words), [np.log(brute(MARK + w)) for w in words])
    assert np.isfinite(lattice.log_prob(["a" * 3000])).all()
    uses = lattice.expected(["the"], np.ones(1))
    assert np.isclose(sum(u * len(p) for u, p in zip(uses, pieces, strict=True)), 4)


def test_lm_base_scores(edge):
    rows = [(r.doc_id, [*low(r.text).split(), "end"]) for r in edge.collect()]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = {}
    for (_, words), h in zip(rows, held, strict=True):
        for w in [] if h else words:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), h, len(w), sum(x in counts for x in w), n,
                   round(sum(np.log10((counts.get(x, 0) + 1) / (n + v + 1)) for x in w), 4))
                  for (i, w), h in zip(rows, held, strict=True))
    got = lm_scores(edge).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
                  for r in got) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_lm_tail_join(spark, monkeypatch):
    """With a small head most words go through the join; scores stay the same."""
    from reelhouse.llm import op7_lm
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {r.doc_id: r for r in lm_scores(docs).collect()}
    monkeypatch.setattr(op7_lm, "HEAD", 200)
    for r in lm_scores(docs).collect():
        w = whole[r.doc_id]
        assert r.n_known == w.n_known and np.isclose(r.base_score, w.base_score) and np.isclose(r.score, w.score)


def test_warc(spark):
    big = "<p>" + "x" * 1200
    rows = [(1, "http://a/ b", big, 0), (2, None, big, 0), (3, "u", "small", 0), (4, "u", "small", 0), (5, "u", None, 0),
            (None, "u", big, 0), (6, "u", "é" * 600, 0), (6, "u", "é" * 600, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, size int")
    want = []
    for i, _, h, _ in rows:
        raw = (h or "").encode()
        other = h == big and i != 2
        want.append((str(i), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if other else "response",
                     2 if other else None))
    got = op8_warc.warc_pages(pages).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == sorted(
        want, key=lambda x: x[:4])


def test_warc_refuses_broken_archives():
    payload = b"<html>" + b"y" * 300
    raw = op8_warc.record(1, "u", payload, len(payload), hashlib.sha1(payload).hexdigest(), "response", None)
    data = op8_warc.write_archive([raw] * 20)
    assert [op8_warc.parse(x)["payload"] for x in op8_warc.frames(data)] == [payload] * 20
    for broken in (b"", data[8:], data[:-3], b"\0" + data[1:]):
        with pytest.raises(op8_warc.BadRecord):
            list(op8_warc.frames(broken))
    for bad in (raw[:-1], raw.replace(b"yyy", b"yyz"), raw.replace(b"WARC/1.1", b"WARC/9"),
                re.sub(rb"\r\nContent-Length: \d+\r\nWARC", b"\r\nContent-Length: 7\r\nWARC", raw)):
        with pytest.raises(op8_warc.BadRecord):
            op8_warc.parse(bad)


def test_html_text():
    page = """<html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body><header>top</header>
<nav><a href=x>menu</a></nav><div class="ad">Buy</div><div class="cookie-notice">We</div><article><h1>Title</h1>
<p>One &amp; two<br>three <b>x</b>  y</p><!-- no --><p></p><aside>side</aside><p>Z.<p>last &lt;p&gt; 3 < 4</p>
<form><p>f</p></form><section id="comments"><div>first!</div></section></article><footer>foot</footer></body></html>"""
    assert main_text(page) == "Title\n\nOne & two three x y\n\nZ.\n\nlast <p> 3 < 4"
    body = "This is a long sentence of the text that goes on for quite a while, and then some more of it. " * 3
    assert main_text(f"<body><ul><li><a>a</a><li><a>b</a></ul><div><p>{body}</p><p>short</p></div></body>") == \
        f"{body.strip()}\n\nshort"
    assert main_text(None) == main_text("") == main_text("<p></p>") == ""


def test_html_queries(spark):
    out = queries.op9_html_text(spark, SF).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(out) == len(pages)
    import html
    for r in out:
        inner = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split("</?p>|</?h1>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_masks_find_all_pairs_of_substitutions():
    for gone in [s for k in (0, 1, 2) for s in itertools.combinations(range(13), k)]:
        assert any(not any(m[g - o] == "1" for g in gone if o <= g < o + len(m))
                   for m in MASKS for o in range(13 - len(m) + 1)), gone


def test_decontaminate(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**5)}"
    items = [(1, " ".join(word() for _ in range(30))), (2, "Short item here"), (3, ""), (None, None), (3, "x y")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    long_item = items[0][1].split()
    near = list(long_item)
    near[3], near[11], near[20] = "a", "b", "c"
    clean = " ".join(word() for _ in range(300))
    docs = [(1, clean, "x"), (2, f"{clean} {' '.join(long_item).upper()} {clean}", "x"), (3, " ".join(near), "x"),
            (4, " ".join(long_item[:12]), "x"), (5, " ".join(long_item[5:18]), "x"), (6, "a SHORT\nitem here b", "x"),
            (7, None, "x"), (8, "", "x"), (2, clean, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_ids string")
    got = sorted((r.doc_id, r.contaminated, r.item_ids) for r in decontaminate(frame, bench).collect())
    assert got == [(1, False, []), (2, False, []), (2, True, [1]), (3, True, [1]), (4, False, []), (5, True, [1]),
                   (6, True, [2]), (7, False, []), (8, False, [])]


def test_word_hashes_of_pieces(monkeypatch):
    from reelhouse.llm import words
    column = pa.array(["Ab ab\x0bAB", None, "", "é" * 9 + " b " * 50, "x" * 300, " \n"])
    whole = [h for *_, h in word_hashes(column)][0]
    monkeypatch.setattr(words, "CHUNK", 16)
    parts = list(word_hashes(column))
    assert np.concatenate([p[3] for p in parts]).tolist() == whole.tolist() and len(set(whole[:3].tolist())) == 1
    assert np.concatenate([p[0] + p[2] for p in parts]).tolist() == [0] * 3 + [3] * 51 + [4]


def test_oracle_queries(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in queries.ORACLE.items():
        got = queries.QUERIES[name](spark, SF)
        want = con.sql(sql)
        names = sorted(got.columns)
        assert names == sorted(want.columns)
        a = sorted(map(str, (tuple(r[n] for n in names) for r in got.collect())))
        b = sorted(map(str, want.project(",".join(names)).fetchall()))
        assert a == b, name
