import random
import re
import zlib
from collections import Counter

import pytest
from helpers import awkward, clashing, frame

from edgeloom.llm import spelling_variants
from edgeloom.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    """One letter inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            mark = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if mark % 97 == 0:
                at = mark % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def neighbours(words):
    """Words by each of their deletions, then compared."""
    by = {}
    for w in words:
        for i in range(len(w)):
            by.setdefault(w[:i] + w[i + 1:], set()).add(w)
        by.setdefault(w, set()).add(w)
    found = {w: set() for w in words}
    for group in by.values():
        for a in group:
            found[a] |= {b for b in group if a != b and near(a, b)}
    return found


def brute(words):
    found, forms = neighbours(words), {}
    for w, others in found.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best and words[best] >= 2 * words[w] else None
    rows = []
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, forms[w], root, words[w], len(found[w]), words.get(forms[w])))
    return sorted(rows, key=str)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def result(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = brute(brute_words([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert len(expected) > 500 and any(r[1] for r in expected)
    assert result(QUERIES["op13_spelling_variants"](spark, sf_dir)) == expected


def test_awkward_and_no_rows(spark):
    odd = [(30, "Straße STRASSE Straße straße Strasse " * 4), (31, "×××××÷ ÀÀÀÀÀ aaaaa aaaaaa aaaab " * 3),
           (None, "zebra zebras zebrās " * 5), (32, "abcde" * 40000 + " tail"), (33, "naïve " * 5)]
    rows = awkward() + odd
    expected = brute(brute_words(rows))
    assert {"straße", "×××××÷", "zebra"} <= {r[0] for r in expected}
    assert result(spelling_variants.variant_report(clashing(frame(spark, rows)))) == expected
    assert result(spelling_variants.variant_report(frame(spark, []))) == []


@pytest.mark.parametrize("letters", ["ab", "abc", "abcdefghij"])
def test_no_pair_is_missed(spark, letters):
    """Few letters make ties and repeated bigrams; chains of forms grow long."""
    rng = random.Random(len(letters))
    words = {}
    for _ in range(400):
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(5, 10)))
        for _ in range(3):
            words[w] = 3 * 2 ** rng.randrange(12)
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
    rows = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert result(spelling_variants.variants(rows)) == brute(words)


def test_pivots_are_the_lightest_disjoint_pair():
    rng = random.Random(3)
    for _ in range(500):
        places = sorted(rng.sample(range(9), rng.randrange(3, 7)))
        weights = [rng.randrange(1, 30) for _ in places]
        a, b = spelling_variants.pivots(places, weights)
        weight = dict(zip(places, weights))
        least = min(weight[x] + weight[y] for x in places for y in places if y >= x + 2)
        assert b >= a + 2 and weight[a] + weight[b] == least
