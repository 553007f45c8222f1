"""The own encoder and the tokenizers library agree on every character."""
from __future__ import annotations

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from reelhouse.llm.bpe import load, tokenizer_path
from reelhouse.llm.op6_counts import CHUNK, TokenCounter

PATH = tokenizer_path("word_bpe_49k.json")
SURROGATES = range(0xD800, 0xE000)
MARK_BELOW, ACUTE = "\u0323", "\u0301"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def differing(library, texts: list[str]) -> list[str]:
    own = load(PATH)[1].encode(texts)
    theirs = library.encode_batch(texts, add_special_tokens=False)
    return [t for t, a, b in zip(texts, own, theirs, strict=True) if a != np.array(b.ids, "<u4").tobytes()]


@pytest.mark.parametrize("context", ["a{0}b ?1{0}? ", "a {0}1 A{0}s" + MARK_BELOW + ACUTE + ". ", "e{0}" + ACUTE + MARK_BELOW + "b "])
def test_every_code_point(library, context):
    letters = [chr(c) for c in range(0x110000) if c not in SURROGATES]
    texts = ["".join(context.format(x) for x in letters[i:i + 64]) for i in range(0, len(letters), 64)]
    assert not differing(library, texts)


def test_random_strings(library):
    rand = random.Random(3)
    pool = [range(32, 127), range(9, 33), range(0x80, 0x3000), range(0x300, 0x370), range(0xD800), range(0xE000, 0x20000)]
    texts = ["".join(chr(rand.choice(rand.choice(pool))) for _ in range(rand.randint(1, 40))) for _ in range(20_000)]
    assert not differing(library, texts)


def test_counts_of_odd_characters_over_several_chunks(library):
    rand = random.Random(5)
    odd = ["a\u0558b", "a\ua7cbb", "e\u07fd\u0301", "\U0001f600 x", "<|endoftext|>", "word", "\u1c89z"]
    texts = [" ".join(rand.choice(odd) for _ in range(n)) for n in (1, 500, CHUNK // 3, CHUNK)]
    assert TokenCounter(PATH).count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
