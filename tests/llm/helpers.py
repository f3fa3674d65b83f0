"""Fixtures of the training-data tests: plain documents and documents of every awkward kind."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def frame(spark, rows, schema=DOC):
    """Rows of (doc_id, text), or whole rows, over several partitions."""
    full = [r if len(r) > 2 else (*r, "en", "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, schema).repartition(4)


def awkward():
    """Nulls in any column, empty, wordless, short, long and odd texts, ties, repeated rows."""
    rng = random.Random(5)
    base = prose(rng, 120)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, "a b c d e f"),
        (7, base), (8, base), (8, base), (9, base + " tail"), (10, "É " * 30), (None, base),
        (None, None), (11, prose(rng, 6000)), (12, "x" * 500), (13, ("line of words\n" * 60)),
        (8, "another text of the same id " * 8), (14, "<|end|> \\### </turn> <\\| | <"),
        (15, base, None, None, None), (16, "\x00 \x1c   odd space  two"),
    ]


def clashing(df):
    """The same documents with columns of names that operators might use."""
    from pyspark.sql import functions as F
    names = ["shard", "slot", "key", "hash", "row", "part", "seq", "weight", "words", "runs",
             "tokens", "topic", "n_words", "mix_sampled", "index", "fp", "text_hash", "content"]
    return df.withColumns({n: F.lit(f"own {n}") for n in names})
