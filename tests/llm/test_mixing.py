import struct

import numpy as np
import pytest
import xxhash
from helpers import awkward, clashing, frame, prose
from pyspark.sql import functions as F

from edgeloom.llm import mixing
from edgeloom.llm.queries import QUERIES


def test_raked_weights_have_the_targets():
    rng = np.random.default_rng(1)
    tokens = rng.integers(1, 1000, 60).astype(float)
    codes = [np.arange(60) % 3, np.arange(60) // 3 % 4, np.arange(60) // 12]
    shares = [np.array([.5, .3, .2]), np.array([.4, .3, .2, .1]), np.array([1, 2, 3, 2, 1.])]
    raked = mixing.rake(tokens, codes, shares)
    assert raked.sum() == pytest.approx(tokens.sum())
    for code, share in zip(codes, shares):
        assert np.bincount(code, raked) / raked.sum() == pytest.approx(share / share.sum())
    # Odds ratios of the cells are those of the counts: nothing but the margins has moved.
    factor = raked / tokens
    a, b, c, d = 0, 1, 3, 4
    assert factor[a] * factor[d] == pytest.approx(factor[b] * factor[c])


def brute_chances(rows, margins):
    """Weights and probabilities by the definition, cell by cell in plain Python."""
    cells = {}
    for cell, n in rows:
        cells[cell] = cells.get(cell, 0) + n
    total = sum(cells.values())
    weights = {c: float(n) for c, n in cells.items()}
    for _ in range(2000):
        for m, target in enumerate(margins):
            now = {}
            for c, w in weights.items():
                now[c[m]] = now.get(c[m], 0) + w
            present = {k: target(k, {c: n for c, n in cells.items()}, m) for k in now if now[k] > 0}
            goal = {k: v / sum(present.values()) * total for k, v in present.items()}
            weights = {c: w * goal[c[m]] / now[c[m]] if now[c[m]] else w for c, w in weights.items()}
    return {c: (weights[c] / n if n else 1.0) for c, n in cells.items()}


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op6_mixing"](spark, sf_dir).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(found) == len(docs)
    tempers = (mixing.SOURCE_TEMPER, mixing.LANGUAGE_TEMPER, mixing.TOPIC_TEMPER)

    def target(temper):
        return lambda k, cells, m: sum(n for c, n in cells.items() if c[m] == k) ** temper

    cells = [((r["source"], r["lang"], r["topic"]), r["tokens"]) for r in found]
    expected = brute_chances(cells, [target(t) for t in tempers])
    for r in found:
        text = docs[r["doc_id"]]["text"]
        assert r["tokens"] == len(text.encode().split())
        assert r["mix_weight"] == pytest.approx(expected[(r["source"], r["lang"], r["topic"])], rel=1e-6)
    # Sampled tokens have the targets in expectation, by every category of every margin.
    for column, temper in zip(("source", "lang", "topic"), tempers):
        actual, expected_tokens = {}, {}
        for r in found:
            actual[r[column]] = actual.get(r[column], 0) + r["tokens"]
            expected_tokens[r[column]] = expected_tokens.get(r[column], 0) + r["tokens"] * r["mix_probability"]
        wanted = {c: n ** temper for c, n in actual.items()}
        for c, n in expected_tokens.items():
            share = wanted[c] / sum(wanted.values())
            assert n / sum(expected_tokens.values()) == pytest.approx(share, abs=1e-6)
    # Decisions are the documents' own: a hash of seed, id and text against the cell's chance.
    for r in found:
        mark = xxhash.xxh64_intdigest(struct.pack("<i", 17), 42)
        mark = xxhash.xxh64_intdigest(struct.pack("<q", r["doc_id"]), mark)
        mark = xxhash.xxh64_intdigest(docs[r["doc_id"]]["text"].encode(), mark)
        assert r["mix_sampled"] == ((mark >> 11) * 2.0 ** -53 < r["mix_probability"])
    drawn = sum(r["mix_sampled"] for r in found)
    assert drawn == pytest.approx(sum(r["mix_probability"] for r in found), abs=80)


def test_sampled_tokens_have_stated_shares(spark):
    rng = __import__("random").Random(4)
    rows = [(i, prose(rng, 20), "en" if i % 5 else "de", f"src{i % 3 if i % 2 else 0}", 0)
            for i in range(6000)]
    margins = {
        "s": mixing.Margin(F.col("source"), ["src0", "src1"], {"src0": .3, "src1": .4, "*": .3}),
        "l": mixing.Margin(F.col("lang"), ["de"], {"de": .5, "*": .5}),
    }
    mixed = mixing.mix(frame(spark, rows), margins, F.lit(20), [F.col("doc_id")])
    kept = mixed.where("mix_sampled")
    n = kept.count()
    shares = {r["source"]: r["count"] / n for r in kept.groupBy("source").count().collect()}
    assert shares["src0"] == pytest.approx(.3, abs=.04) and shares["src1"] == pytest.approx(.4, abs=.04)
    assert kept.where("lang = 'de'").count() / n == pytest.approx(.5, abs=.04)
    again = mixing.mix(frame(spark, rows).repartition(3), margins, F.lit(20), [F.col("doc_id")])
    assert again.where("mix_sampled").select("doc_id").exceptAll(kept.select("doc_id")).isEmpty()


def test_targets_from_a_table(spark):
    rows = [("source", "src0", 0.25), ("source", "src1", 0.25), ("source", "src1", 0.25), ("source", "src2", None),
            ("source", "src3", 0.25), ("lang", "en", 3.0), ("lang", None, 1.0)]
    shares = mixing.shares_of(spark.createDataFrame(rows, "margin string, category string, share double"))
    assert shares == {"source": {"src0": .25, "src1": .5, "src2": 0.0, "src3": .25}, "lang": {"en": 3.0, "*": 1.0}}
    rng = __import__("random").Random(7)
    docs = [(i, prose(rng, 30), "en" if i % 3 else None, f"src{rng.randrange(4)}", 0) for i in range(600)]
    mixed = mixing.mix_documents(frame(spark, docs), shares=shares).withColumn(
        "expected", F.col("tokens") * F.col("mix_probability"))
    total = mixed.agg(F.sum("expected")).first()[0]
    for column in shares:
        found = {r[column] or "*": r["n"] / total for r in mixed.groupBy(column).agg(
            F.sum("expected").alias("n")).collect()}
        whole = sum(shares[column].values())
        assert found == pytest.approx({c: s / whole for c, s in shares[column].items()}, abs=1e-6)


def test_awkward_rows(spark):
    docs = clashing(frame(spark, awkward()))
    report = mixing.mix_report(docs).collect()
    assert len(report) == docs.count()
    assert all(0 <= r["mix_probability"] <= 1 and r["mix_weight"] > 0 for r in report)
    assert all(r["mix_sampled"] for r in report if r["tokens"] == 0 and r["mix_probability"] == 1)
    kept = mixing.sample_mix(docs, 0.0)
    assert kept.columns == docs.columns
    assert kept.exceptAll(docs).isEmpty()
    assert kept.count() == sum(r["mix_sampled"] for r in report)
    assert mixing.mix_report(frame(spark, [])).collect() == []


def test_too_many_cells_and_impossible_targets(spark):
    many = {f"m{i}": mixing.Margin(F.col("source"), [str(k) for k in range(99)]) for i in range(3)}
    with pytest.raises(ValueError, match="cells"):
        mixing.mix(frame(spark, awkward()), many, F.lit(1), [F.col("doc_id")])
    nothing = {"m": mixing.Margin(F.col("source"), ["absent"], {"absent": 1.0})}
    with pytest.raises(ValueError, match="target share"):
        mixing.mix(frame(spark, awkward()), nothing, F.lit(1), [F.col("doc_id")])
