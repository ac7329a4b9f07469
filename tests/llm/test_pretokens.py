"""Pre-token borders against the pattern itself."""

import random

import numpy as np
import public_tokenizers
import regex

from snapstats.llm.pretokens import PreTokens

PATTERN = regex.compile(public_tokenizers.PATTERN)


def split(texts):
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    joined = b"".join(data)
    p = PreTokens(np.frombuffer(joined, np.uint8), offsets)
    tokens = [joined[a:b].decode() for a, b in zip(p.start, p.end)]
    return [tokens[a:b] for a, b in zip(p.offsets[:-1], p.offsets[1:])], p, tokens


def test_borders():
    rng = random.Random(6)
    parts = list("ab1 2\n\t'.,!é日٣½   ́ǅ_") + ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'S", "''", "  ", "re", "\r\n", "😀", "\x1c", "\x85", "ll"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(30000)]
    got, p, tokens = split(texts)
    for t, g in zip(texts, got):
        assert g == PATTERN.findall(t), (t, g, PATTERN.findall(t))
    by = {}
    for h, t in zip(p.hash.tolist(), tokens):
        assert by.setdefault(h, t) == t
    assert len(by) == len(set(tokens))


def test_nothing():
    assert split([])[0] == [] and split(["", ""])[0] == [[], []]
