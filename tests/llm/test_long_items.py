"""Items of several windows with as many edits as the tolerance allows, inside, at the start of and filling a document."""

import random

import numpy as np
import pytest

from snapstats.llm import decontaminate as dc
from snapstats.llm import scan


def changed(rng, item, kind, edits, vocabulary):
    item = list(item)
    if kind == "insert":
        for _ in range(edits):
            item.insert(rng.randrange(len(item) + 1), rng.choice(vocabulary))
        return item
    for a in sorted(rng.sample(range(len(item)), edits), reverse=True):
        if kind == "delete":
            del item[a]
        else:
            item[a] = rng.choice(vocabulary)
    return item


@pytest.mark.parametrize("kind", ["delete", "insert", "replace"])
@pytest.mark.parametrize("size, trials", [(45, 50), (63, 30), (64, 30), (90, 30), (127, 20), (256, 6)])
def test_recall_at_the_tolerance(size, trials, kind):
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(3000)]
    items, texts = [], []
    for k in range(trials):
        item = [rng.choice(vocabulary) for _ in range(size)]
        before, after = ((40, 40), (0, 40), (0, 0))[k % 3]
        leak = changed(rng, item, kind, dc.tolerance(size), vocabulary)
        items.append(" ".join(item))
        texts.append(" ".join([rng.choice(vocabulary) for _ in range(before)] + leak + [rng.choice(vocabulary) for _ in range(after)]).encode())
    words = scan.Words(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), True, scan.ALPHANUMERIC)
    got = {(d, k) for d, k, *_ in dc.Items(list(range(trials)), items).matches(words)}
    assert sum((k, k) in got for k in range(trials)) / trials >= dc.TARGET_RECALL


@pytest.mark.parametrize("words", [32, 33, 63, 64, 65, 500])
def test_windows_cover_the_item(words):
    places = dc.window_places(words, 32)
    assert {p + k for p in places for k in range(32)} == set(range(words))
