"""BPE encoding and decoding of whole documents by a bounded-lookahead
streaming transducer (``bpe.py``)."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from reelhouse.llm.bpe import decode, load, take, tokenizer_path

#: Text characters per output batch, so that a batch stays a few MB.
OUT_CHARS = 1 << 20


def _run(tokenizer: str, form: str, names: list[str]):
    def encode(batches):
        table, encoder = load(tokenizer_path(tokenizer))
        for batch in batches:
            texts = batch.column("_llm_text")
            at, n = 0, batch.num_rows
            while at < n:
                part, size, stop = [], 0, at
                while stop < n and (size < OUT_CHARS or stop == at):
                    part += take([texts[stop].as_py()])
                    size += len(part[-1])
                    stop += 1
                ids = encoder.encode(part)
                counts = [len(x) >> 2 for x in ids]
                decoded = [decode(table, np.frombuffer(x, "<u4"), form) for x in ids]
                rest = [batch.column(x).slice(at, stop - at) for x in names]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(ids, pa.binary()), pa.array(counts, pa.int64()), pa.array(decoded, pa.string())],
                    names=[*names, "ids", "n_tokens", "decoded"])
                at = stop
    return encode


def bpe_documents(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                  tokenizer: str = "word_bpe_49k.json", form: str = "library") -> DataFrame:
    """The ``keep`` columns (default: all but the text), ``ids`` (token ids,
    little-endian unsigned 32-bit), ``n_tokens`` and ``decoded`` (the ids
    turned back to text; ``form`` as in ``StreamDecoder``).

    Null and empty texts have no ids and an empty decoded text. Every row gives
    one row, repeated ones too; null ids stay null; an empty table gives an
    empty table. Input columns of these names are replaced. Strings of special
    tokens inside texts become the special ids."""
    made = {"ids", "n_tokens", "decoded"}
    keep = [c for c in (keep if keep is not None else [c for c in docs.columns if c != text_col])
            if c.lower() not in made]
    slim = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("_llm_text"))
    schema = StructType([*[docs.schema[c] for c in keep], StructField("ids", BinaryType()),
                         StructField("n_tokens", LongType()), StructField("decoded", StringType())])
    return slim.mapInArrow(_run(tokenizer, form, keep), schema)
