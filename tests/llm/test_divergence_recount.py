"""The recount of the source divergence passes on arrays of counts."""
import random
import re

import pyarrow as pa
import pytest

from reelhouse.llm import op13_divergence
from reelhouse.llm.transducer import Transducer


def test_divergence_terms():
    """Blanking and splitting finds what the contract's pattern finds."""
    rng = random.Random(5)
    signs = [chr(c) for c in range(128)] + list("\x80\x85\xa0ÀßéſK\u2003\u3000日𝄞")
    for _ in range(300):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(80)))
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        low = "".join(map(chr, range(65, 91)))
        assert [t.decode() for t in op13_divergence._terms(text.encode())] == [
            t.translate(str.maketrans(low, low.lower())) for t in found]


@pytest.mark.parametrize("flush", [1, 50, 1 << 20])
def test_recount_passes_on_arrays(spark, monkeypatch, flush):
    """A task's counts are a row for each source and range of ordinals, not for each term."""
    monkeypatch.setattr(op13_divergence, "COUNT_ORDS", 16)
    monkeypatch.setattr(op13_divergence, "FLUSH", flush)
    rng = random.Random(1)
    names = sorted({"".join(rng.choice("abcé") for _ in range(6)).encode() for _ in range(90)})
    kept = names[::2]
    made = {"x": [(kept[0], 0, Transducer.build(kept[:20]).to_bytes()), (kept[20], 20, Transducer.build(kept[20:]).to_bytes())]}
    docs = [("xy"[rng.random() < 0.1], rng.choice("st"), b" ".join(rng.choice(names) for _ in range(40)).decode())
            for _ in range(30)]
    want = {}
    for lang, source, text in docs:
        for t in text.encode().split() if lang == "x" else []:
            if t in kept:
                want[source, kept.index(t)] = want.get((source, kept.index(t)), 0) + 1
    batch = pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), d, strict=True)) for d in docs])
    parts = list(op13_divergence._recount(spark.sparkContext.broadcast(made))(iter([batch.slice(0, 11), batch.slice(11)])))
    table = pa.Table.from_batches(parts)
    if flush > 50:
        assert table.num_rows <= 2 * -(-len(kept) // 16)
    table = table.sort_by([(k, "ascending") for k in ("lang", "source", "span")])
    for size in (3, 1000):
        got = [r for b in op13_divergence._added(iter(table.combine_chunks().to_batches(size))) for r in b.to_pylist()]
        assert {(r["source"], r["ord"]): r["n"] for r in got} == want and len(got) == len(want)
    assert not list(op13_divergence._added(iter(table.slice(0, 0).to_batches())))
