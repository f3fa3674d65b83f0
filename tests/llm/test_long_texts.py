"""Texts of 10 MB in every operator over documents: whole, and with the expected figures."""

import hashlib
import random
from collections import Counter

import pytest
from helpers import frame, prose

from edgeloom.llm import decontaminate, license_scan, quality_rules, repeats, sharding, simhash, spelling_variants

SIZE = 10_000_000


@pytest.fixture(scope="module")
def docs(spark):
    text = prose(random.Random(12), 2_300_000)[:SIZE]
    rows = [(1, text), (2, text), (3, "x" * SIZE), (4, "a short text of some words")]
    return frame(spark, rows).cache(), {d: t for d, t in rows}


def test_simhash(docs):
    found = {r["doc_id"]: tuple(r)[1:] for r in simhash.near_duplicates(docs[0]).collect()}
    assert found[1] == found[2] and found[1][1] == 1 and len({f for f, _ in found.values()}) == 3


def test_repeats(docs):
    found = {r["doc_id"]: tuple(r)[1:] for r in repeats.repeat_report(docs[0]).collect()}
    assert found[2] == (SIZE, SIZE, 1, hashlib.sha256(b"").hexdigest())
    # One letter only: all but the first hundred bytes start a string that started before.
    assert found[3] == (SIZE, SIZE - 1, 1, hashlib.sha256(b"x").hexdigest())
    assert found[1][0] == SIZE and found[4][1] == 0


def test_quality_rules(spark, docs):
    labels = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, quality int")
    found = {r["doc_id"]: r for r in quality_rules.quality_report(docs[0], labels).collect()}
    words = docs[1][1].split()
    assert found[1]["n_words"] == len(words) and found[1]["word_chars"] == sum(map(len, words))
    assert found[3]["n_words"] == 1 and found[3]["base_failed"]


def test_decontamination(spark, docs):
    words = docs[1][1].split()
    items = [(1, " ".join(words[1_000_000:1_000_030])), (2, prose(random.Random(1), 30)), (3, "of some words")]
    found = decontaminate.leak_report(docs[0], spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(1, 1), (2, 1), (4, 3)]


def test_license_scan(spark, docs):
    notice = license_scan.NOTICES["isc-text"]
    rows = [(1, docs[1][1] + " " + notice), (2, docs[1][1])]
    found = license_scan.license_report(frame(spark, rows)).collect()
    assert [(r["doc_id"], r["license"]) for r in found] == [(1, "isc-text")]


def test_spelling_variants(spark):
    text = "letter lettre letters " * 400_000
    found = {r["word"]: tuple(r)[1:] for r in spelling_variants.variant_report(frame(spark, [(1, text)])).collect()}
    assert found["letters"][1:4] == ("letters", 400_000, 1) and found["lettre"][3] == 0


def test_sharding(docs):
    found = {r["doc_id"]: r for r in sharding.shard_report(docs[0], 4).collect()}
    assert [found[d]["size"] for d in (1, 3, 4)] == [SIZE + 1, SIZE + 1, 27]
    assert Counter(r["shard"] for r in found.values()).most_common(1)[0][1] <= 2
