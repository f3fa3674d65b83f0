import hashlib
import random
import subprocess
import sys
import zlib

import numpy as np
import pytest
from helpers import awkward, clashing, frame, prose

from edgeloom.llm import repeats
from edgeloom.llm.queries import QUERIES


def brute(rows, length=repeats.LENGTH):
    docs = sorted({(d is not None, d or 0, zlib.crc32((t or "").encode()) >> 1, (t or "").encode())
                   for d, t, *_ in rows})
    seen, result = set(), {}
    for known, d, tie, text in docs:
        gone = bytearray(len(text))
        for p in range(len(text) - length + 1):
            window = text[p:p + length]
            if window in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(window)
        left = bytes(c for c, g in zip(text, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        result[(d if known else None, text)] = (len(text), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return sorted(((d, *result[(d, (t or "").encode())]) for d, t, *_ in rows), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def tangled():
    """Passages shared in part, shifted, nested, across documents and within them."""
    rng = random.Random(6)
    passages = [prose(rng, n) for n in (18, 25, 40, 90, 300)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            text = rng.choice(passages)
            start = rng.randrange(len(text) // 2)
            parts += [prose(rng, rng.randrange(6)), text[start:start + rng.randrange(60, len(text) + 1)]]
        docs.append((i * 3, " ".join(parts)))
    docs += [(500, "ab" * 400), (501, "z" * 99), (502, "z" * 100), (503, "z" * 101), (504, "ab" * 300 + "c")]
    return docs


@pytest.mark.parametrize("crowd", [repeats.CROWD, 2])
def test_tangled_passages(spark, crowd):
    rows = tangled()
    assert rows_of(repeats.repeat_report(frame(spark, rows), crowd)) == brute(rows)


def test_awkward_rows(spark):
    assert rows_of(repeats.repeat_report(clashing(frame(spark, awkward())))) == brute(awkward())
    assert repeats.repeat_report(frame(spark, [])).collect() == []


def test_texts_longer_than_a_segment(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 257)
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    texts = [t for _, t in tangled()]
    for text in [t for t in texts if len(t) >= 257][:20]:
        bucket, start, size = repeats.anchors(text.encode())
        covered = np.concatenate([np.arange(a, a + s - repeats.LENGTH + 1) for a, s in zip(start, size)])
        assert covered.tolist() == list(range(len(text.encode()) - repeats.LENGTH + 1))


def test_refinement_tells_equal_strings():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1300], data[2000:2200] = data[100:400], data[150:350]
    places = np.arange(len(data) - repeats.LENGTH + 1)
    again = repeats.refine(data, places)
    seen, expected = set(), []
    for p in places:
        expected.append((window := data[p:p + repeats.LENGTH].tobytes()) in seen)
        seen.add(window)
    assert again.tolist() == expected


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op4_repeats"](spark, sf_dir)) == brute(docs)


@pytest.mark.parametrize("letters", [1, 2, 3, 30])
def test_refinement_by_pointers_equals_comparison(letters):
    rng = np.random.default_rng(letters)
    data = rng.integers(0, letters, 5000).astype(np.uint8)
    for _ in range(20):
        a, b, n = (*rng.integers(0, 4000, 2), int(rng.integers(50, 400)))
        data[a:a + n] = data[b:b + n].copy()
    places = np.flatnonzero(rng.random(len(data) - 99) < 0.8)
    seen, expected = set(), []
    for p in places:
        own = data[p:p + 100].tobytes()
        expected.append(own in seen)
        seen.add(own)
    assert repeats.refine(data, places).tolist() == expected


def test_refinement_of_4_mb_stays_below_300_mb():
    code = """
import resource, sys
sys.path[:0] = %r
import numpy as np
from edgeloom.llm import repeats
block = np.random.default_rng(1).integers(97, 123, 1 << 20).astype(np.uint8)
data = np.concatenate([block, block, block, block])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
again = repeats.refine(data, np.arange(len(data) - 99))
assert again.sum() == len(again) - (1 << 20), again.sum()
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code % sys.path], capture_output=True, text=True, check=True)
    assert int(done.stdout) < 300
