"""Spelling variants of words: pivotal grams find words one letter apart, forms link them.

Bigrams are ordered by how many words hold them, rarest first. The *prefix* of a word is its
three rarest bigrams, and all that are as rare as the third. Two *pivots* that share no
letter are chosen from it by dynamic programming, so that together they are in as few words
as possible. One inserted, deleted or replaced letter leaves one of two disjoint pivots whole.
If the prefix of ``r`` ends no later in the order than that of ``s``, the whole pivot of
``r`` is in the prefix of ``s``, at most one place away. That is the lemma the index rests on.

Position limits make the index narrow. The edit lies before the left pivot, in it, between the
two, in the right one, or behind it, and all else stands unchanged: left of the edit counted
from the start, right of it counted from the end. So ``r`` asks with five keys, each for the
three lengths that ``s`` may have, and ``s`` is indexed by what it can know of them:

* behind a bigram of its prefix, that included (the edit is before the left pivot),
* up to such a bigram (behind the right pivot),
* around two of them, themselves included (between the pivots),
* around a gap of three letters that leaves one of them whole (in a pivot).

Two words meet only where at least four letters beside the length agree, or all but three. What
is found is verified by its edit distance. Nothing is capped: a key that many words share is
a join that Spark may split.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tables import text_bytes, written

#: Letters as the query's contract has them, in UTF-8 after A-Z were lower-cased: U+00C0 to
#: U+00FF are exactly the bytes C3 80 to C3 BF, and C3 never stands inside a letter.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A run loses a letter where this divides its checksum.
DROP = 97
#: A form occurs so many times as often.
TIMES = 2
#: Bigrams in a prefix: q letters times one edit, and one more.
PREFIX = 3
#: Different words that a task counts before it hands them on.
HELD = 200_000
#: Bytes of a text from which its runs are not listed at once.
LONG = 1 << 20
#: Words whose keys are made at a time.
WORDS_AT_A_TIME = 2_000


# ------------------------------------------------------------------------ words

def as_read(run: bytes, doc: bytes) -> bytes:
    """The run of letters as ``doc`` has it: one letter less where the checksum says so."""
    mark = crc32(doc + b":" + run)
    if mark % DROP:
        return run
    letters = run.decode()
    at = mark % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def _runs(text: bytes) -> Counter:
    text = text.lower()
    if len(text) < LONG:
        return Counter(RUN.findall(text))
    return Counter(found[0] for found in RUN.finditer(text))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        words = pa.array(list(held), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [words, pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    for batch in batches:
        ids = batch.column(0).to_pylist()
        for doc, text in zip(ids, text_bytes(batch.column(1))):
            doc = b"" if doc is None else b"%d" % doc
            for run, n in _runs(text).items():
                held[as_read(run, doc)] += n
            if len(held) > HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: words of at least five letters that occur three times or more."""
    runs = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _counted, "word string, n long"
    )
    return (
        runs.where(F.char_length("word") >= LEAST_LETTERS)
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    )


# ----------------------------------------------------------------- pivotal grams

def bigrams(word: str) -> list[str]:
    return [word[i:i + 2] for i in range(len(word) - 1)]


def prefix(word: str, ranks: dict[str, int]) -> tuple[list[int], int]:
    """Places of the rarest bigrams, ascending, and the rank of the last of them."""
    order = [ranks[gram] for gram in bigrams(word)]
    last = sorted(order)[PREFIX - 1]
    return [i for i, rank in enumerate(order) if rank <= last], last


def pivots(places: list[int], weights: list[int]) -> tuple[int, int]:
    """The two of ``places`` (ascending, at least three) without a common letter of least weight.

    One pass, that remembers the lightest place at least two before the one at hand.
    """
    best, lightest, waiting = None, None, 0
    for at, weight in zip(places, weights):
        while places[waiting] + 2 <= at:
            if lightest is None or weights[waiting] < lightest[0]:
                lightest = weights[waiting], places[waiting]
            waiting += 1
        if lightest and (best is None or lightest[0] + weight < best[0]):
            best = lightest[0] + weight, lightest[1], at
    return best[1], best[2]


def index_keys(word: str, places: list[int]) -> list[str]:
    """Under which keys a word with these prefix places is found."""
    size = len(word)
    keys = [f"<{word[:i + 2]}" for i in places] + [f">{word[i:]}" for i in places]
    keys += [f"={word[:i + 2]}-{word[j:]}" for i in places for j in places if j >= i + 2]
    keys += [
        f"{x}-{word[:max(x, 0)]}-{word[x + 3:]}" for x in range(-2, size)
        if places[-1] >= x + 3 or places[0] + 2 <= x
    ]
    return keys


def asked_keys(word: str, left: int, right: int, more: int) -> list[str]:
    """Keys of the words that have ``more`` letters more and are one edit away from ``word``."""
    gap = left - 1 + more
    return [
        f">{word[left:]}", f"<{word[:right + 2]}", f"={word[:left + 2]}-{word[right:]}",
        f"{gap}-{word[:max(gap, 0)]}-{word[left + 2:]}",
        f"{right}-{word[:right]}-{word[right + 3 - more:]}",
    ]


_KEYS = "word string, n long, last int, key long, asks boolean"


def _keys(held_by: dict[str, int]):
    ranks = {gram: i for i, gram in enumerate(sorted(held_by, key=lambda g: (held_by[g], g)))}

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = (batch.column(c).to_pylist() for c in (0, 1))
            for base in range(0, len(words), WORDS_AT_A_TIME):
                yield _key_rows(words[base:base + WORDS_AT_A_TIME], counts[base:], held_by, ranks)
    return keys


def _key_rows(words, counts, held_by: dict[str, int], ranks: dict[str, int]) -> pa.RecordBatch:
    last, keys, row, asks = [], [], [], []
    for k, word in enumerate(words):
        places, end = prefix(word, ranks)
        last.append(end)
        sets = [(False, len(word), index_keys(word, places))]
        left, right = pivots(places, [held_by[word[i:i + 2]] for i in places])
        for more in (-1, 0, 1):
            sets.append((True, len(word) + more, asked_keys(word, left, right, more)))
        for asked, size, found in sets:
            keys += [xxhash.xxh64_intdigest(f"{size}{key}") for key in found]
            row += [k] * len(found)
            asks += [asked] * len(found)
    take = pa.array(row, pa.int32())
    columns = [pa.array(words, pa.string()), pa.array(counts[:len(words)], pa.int64()), pa.array(last, pa.int32())]
    return pa.RecordBatch.from_arrays([
        *[c.take(take) for c in columns], pa.array(np.array(keys, np.uint64).view(np.int64)),
        pa.array(asks, pa.bool_()),
    ], names=[c.split()[0] for c in _KEYS.split(", ")])


def near_words(words: DataFrame) -> DataFrame:
    """``a, n_a, b, n_b``, once per pair of words (``word, n``) that are one edit apart.

    Words have at least five letters. The bigrams' counts go to every task: words are made
    of 90 letters, so there are at most 8,100.
    """
    letters = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = F.array_distinct(F.transform(letters, lambda i: F.substring("word", i, F.lit(2))))
    held_by = {
        r["gram"]: r["count"]
        for r in words.select(F.explode(grams).alias("gram")).groupBy("gram").count().collect()
    }
    keys = written(words.select("word", "n").mapInArrow(_keys(held_by), _KEYS), "spelling-keys")
    asking = keys.where("asks").selectExpr("word AS r", "n AS n_r", "last AS last_r", "key")
    index = keys.where("NOT asks").selectExpr("word AS s", "n AS n_s", "last AS last_s", "key")
    found = asking.join(index, "key").where(
        (F.col("last_r") <= F.col("last_s")) & (F.levenshtein("r", "s") == 1)
    )
    ordered = F.col("r") < F.col("s")
    return found.select(
        F.least("r", "s").alias("a"), F.when(ordered, F.col("n_r")).otherwise(F.col("n_s")).alias("n_a"),
        F.greatest("r", "s").alias("b"), F.when(ordered, F.col("n_s")).otherwise(F.col("n_r")).alias("n_b"),
    ).distinct()


# ------------------------------------------------------------------------- forms

def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word that has a form, from ``word, form, n``.

    Every round doubles how far a word sees. Counts at least double from word to form, so a
    chain is no longer than the binary logarithm of the largest count.
    """
    links = written(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")),
                    "spelling-roots")
    most = forms.agg(F.max("n")).first()[0] or 0
    for _ in range(most.bit_length().bit_length()):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = written(
            links.join(ahead, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root")
            ), "spelling-roots",
        )
    return links


def variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of ``word, n`` (words distinct)."""
    words = written(words.select("word", "n"), "spelling-words")
    pairs = written(near_words(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        pairs.select("b", "a", "n_a")
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"),
    )
    enough = -F.col("best.less") >= TIMES * F.col("n")
    forms = written(
        words.join(best, "word", "left").select(
            "word", F.when(enough, F.col("best.near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ), "spelling-forms",
    )
    return forms.join(_roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variant_report(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts.

    Words are runs of Latin letters (U+00C0 to U+00FF among them), A-Z in lower case; where 97
    divides the checksum of ``<doc_id>:<run>`` the run has lost a letter. ``form`` is the near
    word of largest count, the first in code-point order of several, if it occurs at least
    twice as often; ``root`` is the last word that forms lead to. Null texts have no words; a
    null id counts as empty text in the checksum. Repeated rows count again. An empty table
    gives no rows; other columns are not read.
    """
    return variants(word_counts(docs))
