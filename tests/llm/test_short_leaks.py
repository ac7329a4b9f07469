"""Leaks that have lost words and end or fill their document, per number of lost words."""

import random

import numpy as np
import pytest

from snapstats.llm import decontaminate as dc
from snapstats.llm import scan


def recall(sizes, lost, before, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    items, texts = [], []
    for n in sizes:
        item = [rng.choice(vocabulary) for _ in range(n)]
        gone = set(rng.sample(range(n), lost))
        items.append(" ".join(item))
        texts.append(" ".join([rng.choice(vocabulary) for _ in range(before)] + [w for k, w in enumerate(item) if k not in gone]).encode())
    words = scan.Words(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), True, scan.ALPHANUMERIC)
    got = {(d, k) for d, k, *_ in dc.Items(list(range(len(items))), items).matches(words)}
    return sum((k, k) in got for k in range(len(items))) / len(items)


@pytest.mark.parametrize("before", [0, 40])
@pytest.mark.parametrize("lost", [0, 1, 2, 3, 4, 6])
def test_recall_per_number_of_lost_words(lost, before):
    sizes = [n for n in range(14, 60) if dc.tolerance(n) >= lost] * 2
    assert recall(sizes, lost, before, 7 * lost + before) >= dc.TARGET_RECALL


@pytest.mark.parametrize("size", [16, 22, 32, 45])
def test_document_is_an_item_without_one_word(size):
    assert recall([size] * 30, 1, 0, size) >= dc.TARGET_RECALL
