import random
import re

from helpers import awkward, clashing, frame, prose

from edgeloom.llm import decontaminate
from edgeloom.llm.queries import QUERIES


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    words = words_of(text)
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    found = set()
    for d, t, *_ in docs:
        own, words = shingles(t), words_of(t)
        for i, x in items:
            q, short = shingles(x), words_of(x)
            if 0 < len(short) < 5 and any(words[k:k + len(short)] == short for k in range(len(words))):
                found.add((d, i, 1, 1))
            if q and len(q & own) >= 0.8 * len(q):
                found.add((d, i, len(q), len(q & own)))
    return sorted(found, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in df.collect()),
                  key=repr)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_awkward_rows_and_items(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, n)) for i, n in enumerate([5, 6, 9, 14, 30, 60, 200])]
    items += [(90, None), (91, ""), (92, "too few words here"), (None, prose(rng, 20)), (0, items[3][1])]
    docs = awkward()
    for i, (_, text) in enumerate(items[:7]):
        words = text.split()
        docs.append((100 + i, " ".join([prose(rng, 3000), text, prose(rng, 500)])))
        docs.append((200 + i, " ".join([prose(rng, 40), *words[:-1], "changed", prose(rng, 900)])))
        docs.append((300 + i, text.upper()))
    found = result(decontaminate.leak_report(clashing(frame(spark, docs)), bench(spark, items)))
    assert found == brute(docs, items)


def test_short_items(spark):
    """Alone and beside long ones; at either end of a text, as the whole text, across others."""
    rng = random.Random(6)
    short = [(1, "w1"), (2, "W2 w3"), (3, "w4 w5 w6"), (4, "w7 w8 w9 w10"), (5, "once upon"), (5, "ends here"),
             (6, "É"), (None, "w11 w12"), (7, " \n "), (8, "w1")]
    docs = awkward() + [(20, "ends here"), (21, "so it ENDS HERE"), (22, "once upon a time"), (23, "here ends"),
                        (24, "w4 w5 x w6"), (25, "w7 w8 w9 w10"), (26, "w7 w8 w9"), (None, "w11 w12 w1")]
    docs += [(40 + i, prose(rng, 3000)) for i in range(6)]
    for items in (short, [*short, (30, prose(rng, 40)), (31, docs[-1][1][:400])]):
        found = result(decontaminate.leak_report(clashing(frame(spark, docs)), bench(spark, items)))
        assert set(found) == set(brute(docs, items)) and len(found) > 20


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    found = result(QUERIES["op10_decontamination"](spark, sf_dir))
    assert found == brute(docs, items) and found


def test_empty_tables_and_dropping(spark):
    items = bench(spark, [(1, "a b c d e f g h")])
    docs = clashing(frame(spark, [*awkward(), (50, "x a b c d e f g h y"), (51, None), (None, "a b c d e f g h")]))
    kept = decontaminate.drop_leaks(docs, items)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == docs.count() - 2 and 50 not in ids
    assert decontaminate.leak_report(frame(spark, []), items).collect() == []
    assert decontaminate.leak_report(docs, bench(spark, [])).collect() == []
    assert decontaminate.drop_leaks(docs, bench(spark, [])).count() == docs.count()
