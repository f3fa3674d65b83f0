import collections
import math
import re
import struct
import unicodedata

import xxhash
from helpers import awkward, clashing, frame, prose

from edgeloom.llm import quality_rules as rules
from edgeloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


def counted(df):
    return sorted((tuple(r)[:7] for r in df.collect()), key=repr)


def test_base_counts_of_awkward_rows(spark):
    docs = awkward() + [(30, "a b c d e f " * 40), (31, "a a a a a a"), (32, "a b c d e x a b c d e")]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = rules.quality_report(clashing(frame(spark, docs)), labels)
    assert counted(found) == sorted(((d, *brute(t)) for d, t, *_ in docs), key=repr)
    assert all(r["kept"] != r["base_failed"] for r in found.collect())
    assert rules.quality_report(frame(spark, []), labels).collect() == []


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = QUERIES["op7_quality_rules"](spark, sf_dir)
    assert counted(found) == sorted(((r["doc_id"], *brute(r["text"])) for r in docs), key=repr)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    verdicts = [(labels[r["doc_id"]], r["kept"]) for r in found.collect()
                if r["doc_id"] in labels and not r["base_failed"]]
    good = [kept for quality, kept in verdicts if quality]
    bad = [kept for quality, kept in verdicts if not quality]
    assert all(good) and sum(bad) <= 0.1 * len(bad)


def labelled(spark, n=600):
    """Bad documents are loud, or full of symbols; a few labels are wrong, null or repeated."""
    import random
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(n):
        text, kind = prose(rng, rng.randrange(20, 200)), i % 6
        if kind == 0:
            text = text.upper()
        if kind == 1:
            text = text.replace(" ", "## ")
        docs.append((i, text))
        labels.append((i, int(kind > 1), 0))
    labels += [(1, None, 0), (None, 1, 0), (2, 1, 0), (99999, 0, 0)]
    return frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learned_list_tells_held_out_documents_apart(spark):
    docs, labels = labelled(spark)
    train = labels.where("floor(doc_id / 6) % 2 = 0 OR doc_id IS NULL")
    kept = {r["doc_id"]: r["kept"] for r in rules.quality_report(docs, train).collect()}
    held = [i for i in range(600) if i // 6 % 2]
    assert sum(kept[i] == (i % 6 > 1) for i in held) > 0.98 * len(held)


def test_an_ordered_list_of_conditions(spark):
    first = (rules.Condition("n_words", True, 100.0),)
    second = (rules.Condition("upper_share", True, 0.5), rules.Condition("n_words", False, 50.0))
    data = spark.createDataFrame(
        [(1, 120, 1, 100, 0), (2, 40, 90, 100, 0), (3, 60, 90, 100, 0), (4, 0, 0, 0, 0)],
        "id int, n_words long, n_upper long, word_chars long, n_lines long")
    data = data.selectExpr("*", "0L n_symbols", "0L n_dup_lines", "0L n_repeat_words")
    assert [r[0] for r in data.orderBy("id").select(rules.verdict([first, second])).collect()] == [
        False, False, True, True]
    assert data.where(rules.verdict([])).count() == 4


def test_keeping_leaves_columns_and_good_documents(spark):
    docs, labels = labelled(spark)
    whole = clashing(docs)
    kept = rules.keep_good(whole, labels)
    assert kept.columns == whole.columns
    assert {r["doc_id"] for r in kept.collect()} == {
        r["doc_id"] for r in rules.quality_report(docs, labels).where("kept").collect()}


class PlainLearner:
    """The decision list from the rule's own words: row by row, no cells and no Spark."""

    def __init__(self, rows):
        # Rows of (features, good, held back).
        self.cuts = {}
        for f in rules.FEATURES:
            kinds = {k: sorted(x[f] for x, good, _ in rows if good == k) for k in (True, False)}
            at = lambda values, q: values[max(math.ceil(q * len(values)), 1) - 1]
            self.cuts[f] = sorted({(at(kinds[True], g) + at(kinds[False], b)) / 2 for g, b in rules.MIDPOINTS})
        self.rules = []
        while len(self.rules) < rules.MAX_RULES:
            rule = self.prune(self.grow([r for r in rows if not r[2]]), [r for r in rows if r[2]])
            bad, fine = self.kinds([r for r in rows if r[2] and self.met(rule, r[0])])
            if not rule or bad < rules.LEAST_COVERED or bad < rules.PRECISION * (bad + fine):
                break
            self.rules.append(rule)
            rows = [r for r in rows if not self.met(rule, r[0])]

    @staticmethod
    def met(rule, features):
        return all((features[f] > cut) == above for f, above, cut in rule)

    @staticmethod
    def kinds(rows):
        fine = sum(good for _, good, _ in rows)
        return len(rows) - fine, fine

    def grow(self, rows):
        rule = ()
        while len(rule) < rules.MAX_CONDITIONS:
            bad, fine = self.kinds(rows)
            if not bad or not fine:
                break
            best, gain = None, 0.0
            for choice in [(f, above, cut) for f in rules.FEATURES for cut in self.cuts[f] for above in (True, False)]:
                hits, misses = self.kinds([r for r in rows if self.met([choice], r[0])])
                if hits:
                    value = hits * (math.log2(hits / (hits + misses)) - math.log2(bad / (bad + fine)))
                    if value > gain + 1e-9:
                        best, gain = choice, value
            if best is None:
                break
            rule = (*rule, best)
            rows = [r for r in rows if self.met([best], r[0])]
        return rule

    def prune(self, rule, rows):
        worths = []
        for end in range(1, len(rule) + 1):
            bad, fine = self.kinds([r for r in rows if self.met(rule[:end], r[0])])
            worths.append(((bad - fine) / (bad + fine) if bad + fine else -1.0, -end))
        return rule[:-max(worths)[1]] if worths else rule

    def kept(self, features):
        return not any(self.met(rule, features) for rule in self.rules)


def plain_features(text):
    n, chars, symbols, dups, repeats, _ = brute(text)
    lines = sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
    upper = sum(unicodedata.category(c) == "Lu" for c in text or "")
    share = lambda a, b: a / b if b else 0.0
    return {"symbol_share": share(symbols, chars), "repeat_share": share(repeats, n),
            "dup_line_share": share(dups, lines), "upper_share": share(upper, chars),
            "word_length": share(chars, n), "n_words": float(n)}


def plain_verdicts(docs, labels):
    known = {}
    for d, quality, *_ in labels:
        if d is not None and quality is not None:
            known.setdefault(d, []).append(quality > 0)
    rows = []
    for d, text in docs:
        if not brute(text)[5]:
            mark = xxhash.xxh64_intdigest(struct.pack("<q", d), 42)
            held = (mark - (mark >> 63 << 64)) % 3 == 0
            rows += [(plain_features(text), good, held) for good in known.get(d, ())]
    learner = PlainLearner(rows)
    return learner, {d: not brute(t)[5] and learner.kept(plain_features(t)) for d, t in docs}


def test_verdicts_equal_a_plain_learner(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").collect()]
    learner, expected = plain_verdicts(docs, labels)
    assert learner.rules
    assert {r["doc_id"]: r["kept"] for r in QUERIES["op7_quality_rules"](spark, sf_dir).collect()} == expected
    docs, labels = labelled(spark)
    plain = ([(r["doc_id"], r["text"]) for r in docs.collect()],
             [tuple(r) for r in labels.select("doc_id", "quality").collect()])
    learner, expected = plain_verdicts(*plain)
    assert len(learner.rules) > 1
    assert {r["doc_id"]: r["kept"] for r in rules.quality_report(docs, labels).collect()} == expected
