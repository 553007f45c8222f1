"""Token counts by overlap resynchronisation.

A text of more than one chunk is encoded by the library in overlapping chunks with offsets.
Two neighbours are spliced where both have a token that starts at the same
place after one that ends at the same place, at least the merge list's
sufficient lookahead before the left chunk's end:

* what the left chunk says up to there is final (nothing further right can
  change it), so the place is a token boundary of the whole text;
* merges never cross a token boundary, so after one the encoding depends only
  on what follows; the right chunk has that boundary too, hence its tokens
  after it are those of the whole text.

Where no such place lies in the overlap, the right chunk starts earlier (the
overlap doubles), in the end at the document's start. Shorter texts are one
chunk: they are cut at white space, which no token, special string or composed
character crosses, and each distinct run is merged once (``bpe.py``).
"""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from reelhouse.llm.bpe import load, take, tokenizer_path

#: Characters of a chunk and of the first overlap. Longer texts are cut.
CHUNK, OVERLAP = 16_384, 2_048
_loaded: dict[str, "TokenCounter"] = {}


class TokenCounter:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        table, self.encoder = load(path)
        self.lookahead = table.lookahead

    def count(self, texts: list[str]) -> list[int]:
        """Token counts of texts."""
        small = iter(self.encoder.encode([t for t in texts if len(t) <= CHUNK]))
        return [len(next(small)) >> 2 if len(t) <= CHUNK else self.count_huge(t) for t in texts]

    def count_huge(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Tokens of a text encoded in overlapping chunks."""
        overlap = max(overlap, 2 * self.lookahead)
        chunk = max(chunk, 2 * overlap)
        encode = self.library.encode
        n, stop = len(text), min(len(text), chunk)
        left, at, first, done = encode(text[:stop], add_special_tokens=False), 0, 0, 0
        floor = 0                               # where the token ``first`` of the left chunk begins
        while stop < n:
            more, wide = min(n, stop + chunk - overlap), overlap
            while True:
                start = max(floor, stop - wide)
                right = encode(text[start:more], add_special_tokens=False)
                place = self._splice(left, at, right, start, stop)
                if place is not None or start == floor:
                    break
                wide *= 2
            if place is None:                   # from a true boundary on there is nothing to align
                first = 0
            else:
                ended, begun, floor = place
                done += ended - first
                first = begun
            left, at, stop = right, start, more
        return done + len(left) - first

    def _splice(self, left, at: int, right, start: int, stop: int) -> tuple[int, int, int] | None:
        """The last stable boundary that both chunks have: the index of the
        token after it in either one, and its place. Only tokens of the overlap
        are looked at; a token that begins inside a character is no boundary."""
        have, i, (s, _) = {}, len(left) - 1, left.token_to_chars(len(left) - 1) if len(left) else (0, 0)
        while i > 0 and at + s >= start:
            before = left.token_to_chars(i - 1)
            if before[1] <= s:
                have[at + before[1], at + s] = i
            i, s = i - 1, before[0]
        found, end = None, -1
        for j in range(len(right)):
            s, e = right.token_to_chars(j)
            if start + s + self.lookahead > stop:
                break
            if 0 <= end <= s and (start + end, start + s) in have:
                found = have[start + end, start + s], j, start + s
            end = e
        return found


def _counter(path: str) -> TokenCounter:
    if path not in _loaded:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded[path] = TokenCounter(path)
    return _loaded[path]


def _run(tokenizer: str, names: list[str]):
    def count(batches):
        counter = _counter(tokenizer_path(tokenizer))
        for batch in batches:
            column, counts = batch.column("_llm_text"), []
            for at in range(0, batch.num_rows, 1024):
                counts += counter.count(take(column.slice(at, 1024).to_pylist()))
            yield pa.RecordBatch.from_arrays([*[batch.column(x) for x in names], pa.array(counts, pa.int64())],
                                             names=[*names, "n_tokens"])
    return count


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than
    ``limit`` tokens) of every row.

    Null and empty texts have 0 bytes and 0 tokens. Every row gives one row,
    repeated ones too; a null id stays null; an empty table gives an empty
    table. Other input columns are not read, so their names do not matter."""
    slim = docs.select(F.col(id_col).alias("_llm_id"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("_llm_bytes"),
                       F.col(text_col).alias("_llm_text"))
    names = ["_llm_id", "_llm_bytes"]
    schema = StructType([*[slim.schema[c] for c in names], StructField("n_tokens", LongType())])
    return slim.mapInArrow(_run(tokenizer, names), schema).select(
        F.col("_llm_id").alias(id_col), F.col("_llm_bytes").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"))
