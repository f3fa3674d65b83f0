"""Sources and languages are those of the corpus, whatever their names."""

import random

import pytest
from helpers import frame, prose
from test_mixing import brute_chances

from edgeloom.llm import mixing


def test_sources_of_any_name_are_balanced(spark):
    rng = random.Random(4)
    sources = ["web.example"] * 60 + ["Bücher"] * 20 + ["src3"] * 15 + ["code"] * 4 + [None]
    rows = [(i, prose(rng, rng.randrange(20, 60)), rng.choice(["ja", "pt", "en", None]), s, 0)
            for i, s in enumerate(sources)]
    found = mixing.mix_report(frame(spark, rows)).collect()
    cells = [((r["source"], r["lang"], r["topic"]), r["tokens"]) for r in found]
    tempers = (mixing.SOURCE_TEMPER, mixing.LANGUAGE_TEMPER, mixing.TOPIC_TEMPER)

    def target(temper):
        return lambda k, cells, m: sum(n for c, n in cells.items() if c[m] == k) ** temper

    expected = brute_chances(cells, [target(t) for t in tempers])
    for r in found:
        assert r["mix_weight"] == pytest.approx(expected[r["source"], r["lang"], r["topic"]], rel=1e-6)
    weight = {s: sum(r["tokens"] * r["mix_weight"] for r in found if r["source"] == s)
              / sum(r["tokens"] for r in found if r["source"] == s) for s in set(sources)}
    assert weight["web.example"] < 1 < weight["Bücher"] < weight["code"]


def test_too_many_categories_raise(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_CELLS", 30)
    rows = [(i, "some words", "en", f"s{i}", 10) for i in range(31)]
    assert mixing.mix_report(frame(spark, rows[:30])).count() == 30
    with pytest.raises(ValueError, match="cells"):
        mixing.mix_report(frame(spark, rows))
