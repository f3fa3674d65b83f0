import random

import numpy as np
import pyarrow as pa

from edgeloom.llm.shingles import hashed_words, text_slices, word_hashes


def plain(texts, lower):
    found = [((t or "").encode().lower() if lower else (t or "").encode()).split() for t in texts]
    return word_hashes([w for words in found for w in words]).tolist(), [len(w) for w in found]


def test_words_of_slices_of_columns():
    rng = random.Random(1)
    texts = [None, "A" * 3_000_000 + " b", "", None] + [
        "".join(rng.choice(" \t\n\x0b\x0c\r\x1cabABéÉ\u3000\x85") for _ in range(rng.randrange(40))) for _ in range(300)
    ]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts, kind)
        for start in (0, 1, 2, 5, 150, 304):
            for lower in (False, True):
                hashes, n = hashed_words(column.slice(start), lower)
                assert (hashes.tolist(), n.tolist()) == plain(texts[start:], lower)


def test_slices_cover_the_rows():
    column = pa.array(["x" * n for n in (5, 0, 100, 3, 3, 3, 50)] + [None])
    found = list(text_slices(column, 10))
    assert np.concatenate([np.arange(a, b) for a, b in found]).tolist() == list(range(8))
    assert len(found) > 3 and list(text_slices(column.slice(0, 0))) == []
