import hashlib
import random
import re

import numpy as np
import pytest
from helpers import awkward, clashing, frame, prose

from edgeloom.llm import substring_dedup
from edgeloom.llm.queries import QUERIES
from edgeloom.llm.tables import word_lists

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rank(doc):
    return (doc is not None, doc or 0)


def brute(rows):
    first, found = {}, []
    texts = [(d, WORD.findall(t or "")) for d, t, *_ in rows]
    for d, words in texts:
        for i in range(len(words) - 12):
            window = tuple(words[i:i + 13])
            first[window] = min(first.get(window, rank(d)), rank(d))
    for d, words in texts:
        gone = set()
        for i in range(len(words) - 12):
            if first[tuple(words[i:i + 13])] < rank(d):
                gone.update(range(i, i + 13))
        kept = [w for i, w in enumerate(words) if i not in gone]
        found.append((d, len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(found, key=str)


def result(df):
    assert df.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sum(r[2] > 0 for r in expected) > 50
    assert result(QUERIES["op11_substring_dedup"](spark, sf_dir)) == expected


def shared_passages():
    """Few words, so that much repeats; a line in very many texts; copies with edits."""
    rng = random.Random(8)
    line = prose(rng, 15)
    rows, base = [], prose(rng, 200).split()
    for d in range(300):
        kind, own = d % 3, prose(rng, rng.randrange(40))
        if kind == 0:
            rows.append((d, f"{prose(rng, 9)} {line} {own} {line}"))
        elif kind == 1:
            words = list(base)
            for _ in range(rng.randrange(6)):
                words[rng.randrange(200)] = rng.choice("abc")
            rows.append((d, " ".join(words[rng.randrange(50):rng.randrange(60, 200)])))
        else:
            rows.append((d, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))))
    rows += [(5, rows[4][1] + " more"), (5, rows[4][1]), (7, line * 3), (301, f"{line} " * 40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("crowd", [0, 2, 4096])
def test_shared_passages(spark, crowd):
    rows = shared_passages()
    assert result(substring_dedup.substring_report(frame(spark, rows), crowd)) == brute(rows)


def test_awkward_and_no_rows(spark):
    rows = awkward()
    assert result(substring_dedup.substring_report(clashing(frame(spark, rows)))) == brute(rows)
    assert result(substring_dedup.substring_report(frame(spark, []))) == []


def test_very_long_texts(spark):
    rng = random.Random(1)
    long = prose(rng, 300_000)
    rows = [(2, long), (1, long[5_000:400_000]), (3, "x" * 3_000_000), (4, prose(rng, 50) + long[-900:])]
    assert result(substring_dedup.substring_report(frame(spark, rows))) == brute(rows)
    text = long.encode()
    assert [w for words in word_lists(text, 1000) for w in words] == text.split()


@pytest.mark.parametrize("letters", [2, 3, 20])
def test_factors_are_longest_and_windows_complete(letters):
    rng = np.random.default_rng(letters)
    sizes = rng.integers(13, 22, 200)
    words = rng.integers(0, letters, sizes.sum()).astype(np.uint64)
    for _ in range(60):
        a, b = rng.integers(0, len(words) - 15, 2)
        words[a:a + 15] = words[b:b + 15]
    places = rng.integers(0, 40, 200)
    block = substring_dedup.Block(words, sizes, places)
    runs = np.split(words, np.cumsum(sizes)[:-1])
    first = {}
    for run, place in zip(runs, places):
        for n in range(1, 17):
            for i in range(len(run) - n + 1):
                key = run[i:i + n].tobytes()
                first[key] = min(first.get(key, place), place)
    run, start, length = block.factors()
    for r, s, n in zip(run, start - block.start[run], length):
        own = runs[r]
        best = max((k for k in range(1, min(16, len(own) - s) + 1)
                    if first[own[s:s + k].tobytes()] < places[r]), default=0)
        assert n == best
    found = set(zip(*(x.tolist() for x in block.repeated_windows())))
    assert found == {(r, i) for r, own in enumerate(runs) for i in range(len(own) - 12)
                     if first[own[i:i + 13].tobytes()] < places[r]}
