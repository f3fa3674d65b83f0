"""Quality rules: base counts, and a decision list learned from labelled statistics.

Sequential covering. Labelled documents are counted by cell, a cell being the
combination of intervals in which a document's features lie. Rules are grown on two
thirds of the counts by adding the threshold condition of highest information gain,
pruned on the last third, and kept while they are precise there; documents that a rule
covers are taken out before the next one is grown. The list becomes one ordered Spark
conditional expression. All of it is DataFrame expressions; the driver sees the cell
counts, whose number the intervals bound.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tables import SPACE_CLASS, WORD_CLASS, free_name, without, written
from edgeloom.operators.reconcile import possibly_among

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
SYMBOLS = r"[#*$%&|<>]"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features of the learned rules.
FEATURES = ("symbol_share", "repeat_share", "dup_line_share", "upper_share", "word_length", "n_words")
#: Where thresholds may lie: half way between a quantile of the good documents and one of
#: the bad, so that neither kind has to end exactly where the labelled ones do.
MIDPOINTS = ((0.001, 0.25), (0.001, 0.5), (0.999, 0.25), (0.999, 0.5), (0.999, 0.75))
#: A rule must reach this share of bad documents among what it covers on the held-back
#: third, and cover so many bad ones there.
PRECISION = 0.98
LEAST_COVERED = 5
MAX_CONDITIONS = 3
MAX_RULES = 12
#: Bits of the filter that finds labelled documents, as a power of two.
LABEL_BITS = 24


# ------------------------------------------------------------------ base counts

def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``COUNTS`` and the helper columns ``n_lines``, ``n_upper``.

    A null text has no words. Each intermediate array is a column of its own, since
    an expression inside a lambda would be computed for every element.
    """
    names = ("content", "words", "lines", "runs", "ordered", "places")
    content, words, lines, runs, ordered, places = (free_name(n, docs.columns) for n in names)
    keep = without(docs, *COUNTS, "n_lines", "n_upper")

    def count(pattern: str) -> Column:
        return F.regexp_count(F.col(content), F.lit(pattern)).cast("long")

    step = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias(content))
    step = step.select(
        "*", F.regexp_extract_all(F.col(content), F.lit(f"{WORD_CLASS}+"), F.lit(0)).alias(words),
        F.filter(F.split(content, "\n", -1), lambda x: x.rlike(WORD_CLASS)).alias(lines),
    )
    last = F.size(words) - WINDOW
    step = step.select(
        *keep, F.size(words).cast("long").alias("n_words"),
        (F.length(content) - count(SPACE_CLASS)).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"), count(r"\p{Lu}").alias("n_upper"),
        F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
            *[F.get(words, i + k) for k in range(WINDOW)]
        ))).alias(runs),
    )
    # Only texts that repeat a window have their windows put in order.
    step = step.select(
        *[c for c in step.columns if c != runs],
        F.when(
            F.size(F.array_distinct(runs)) < F.size(runs),
            F.sort_array(F.transform(runs, lambda x, i: F.struct(x.alias("run"), i.alias("at")))),
        ).alias(ordered),
    )
    run = lambda i: F.get(ordered, i)["run"]
    step = step.select(
        *[c for c in step.columns if c != ordered],
        F.sort_array(F.transform(
            F.filter(ordered, lambda x, i: F.coalesce(
                (x["run"] == F.when(i > 0, run(i - 1))) | (x["run"] == run(i + 1)),
                x["run"] == run(i + 1), x["run"] == F.when(i > 0, run(i - 1)), F.lit(False),
            )),
            lambda x: x["at"],
        )).alias(places),
    )
    covered = F.aggregate(
        places, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, at: F.struct(
            at.alias("last"),
            (acc["n"] + F.least(F.lit(WINDOW), at - acc["last"])).cast("long").alias("n"),
        ),
        lambda acc: acc["n"],
    )
    # A generator of one row: a filter on the counts stays above it. Pushed below, it
    # would hold all of these expressions, nested in each other.
    numbers = [F.col(c) for c in (*COUNTS[:-1], "n_lines", "n_upper")]
    return step.select(*keep, F.inline(F.array(F.struct(
        *numbers, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")
    ))))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )


def features() -> dict[str, Column]:
    """Features from the base counts; a share of nothing is 0."""
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "upper_share": share("n_upper", "word_chars"),
        "word_length": share("word_chars", "n_words"),
        "n_words": F.col("n_words").cast("double"),
    }


# ---------------------------------------------------------------- decision list

@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` if ``above``, else ``feature <= threshold``."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def learn_rules(labelled: DataFrame) -> list[Rule]:
    """Ordered rules for bad documents, from rows with base counts, ``good`` and ``fold``.

    ``fold`` 0 holds a row back for pruning. Without good or without bad rows there is
    nothing to tell apart and the list is empty.
    """
    rows = written(labelled.select(
        "good", (F.col("fold") == 0).alias("held"),
        *[v.alias(k) for k, v in features().items()],
    ), "labelled-features")
    cuts = _thresholds(rows)
    if cuts is None:
        return []
    # At most the product of the features' intervals, 46,656, whatever the number of rows.
    cells = (
        rows.groupBy(*[
            sum(((F.col(f) > c).cast("int") for c in cuts[f]), F.lit(0)).alias(f"in_{f}")
            for f in FEATURES
        ])
        .agg(*[
            F.count_if((F.col("good") == good) & (F.col("held") == held)).alias(name)
            for name, good, held in (("bad", False, False), ("fine", True, False),
                                     ("held_bad", False, True), ("held_fine", True, True))
        ])
        .collect()
    )
    cells = sorted(cells, key=tuple)
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        rule = _prune(_grow(cells, cuts), cells, cuts)
        inside = [c for c in cells if _covers(rule, c, cuts)]
        bad, fine = _sum(inside, "held_bad"), _sum(inside, "held_fine")
        if not rule or bad < LEAST_COVERED or bad < PRECISION * (bad + fine):
            return rules
        rules.append(rule)
        cells = [c for c in cells if not _covers(rule, c, cuts)]
    return rules


def _thresholds(rows: DataFrame) -> dict[str, list[float]] | None:
    """Thresholds per feature in ascending order; None if a kind has no rows."""
    good, bad = (sorted({m[i] for m in MIDPOINTS}) for i in (0, 1))
    found = rows.agg(*[
        F.percentile_approx(F.when(F.col("good") == kind, F.col(f)), q, 10_000)
        .alias(f"{f}_{kind}")
        for kind, q in ((True, good), (False, bad)) for f in FEATURES
    ]).first()
    if any(v is None for v in found):
        return None
    cuts = {}
    for f in FEATURES:
        of_good, of_bad = dict(zip(good, found[f"{f}_True"])), dict(zip(bad, found[f"{f}_False"]))
        cuts[f] = sorted({(of_good[g] + of_bad[b]) / 2 for g, b in MIDPOINTS})
    return cuts


def _sum(cells: list, name: str) -> int:
    return sum(c[name] for c in cells)


def _holds(condition: Condition, cell, cuts: dict[str, list[float]]) -> bool:
    interval = cell[f"in_{condition.feature}"]
    return (interval > cuts[condition.feature].index(condition.threshold)) == condition.above


def _covers(rule: Rule, cell, cuts: dict[str, list[float]]) -> bool:
    return all(_holds(c, cell, cuts) for c in rule)


def _grow(cells: list, cuts: dict[str, list[float]]) -> Rule:
    """Adds the condition of highest gain until no good document is covered or none helps."""
    rule: Rule = ()
    choices = [Condition(f, above, c) for f in FEATURES for c in cuts[f] for above in (True, False)]
    while len(rule) < MAX_CONDITIONS and _sum(cells, "fine"):
        bad, fine = _sum(cells, "bad"), _sum(cells, "fine")
        if not bad:
            break
        best, gain, left = None, 0.0, cells
        for choice in choices:
            inside = [c for c in cells if _holds(choice, c, cuts)]
            hits = _sum(inside, "bad")
            if hits:
                purity = log2(hits / (hits + _sum(inside, "fine"))) - log2(bad / (bad + fine))
                if hits * purity > gain + 1e-9:
                    best, gain, left = choice, hits * purity, inside
        if best is None:
            break
        rule, cells = (*rule, best), left
    return rule


def _prune(rule: Rule, cells: list, cuts: dict[str, list[float]]) -> Rule:
    """The beginning of the rule with the best balance on the held-back counts."""
    best, worth = rule, -1.0
    for end in range(len(rule), 0, -1):
        inside = [c for c in cells if _covers(rule[:end], c, cuts)]
        bad, fine = _sum(inside, "held_bad"), _sum(inside, "held_fine")
        value = (bad - fine) / (bad + fine) if bad + fine else -1.0
        if value >= worth:
            best, worth = rule[:end], value
    return best


def verdict(rules: list[Rule]) -> Column:
    """The list as an ordered conditional: false at the first rule that holds, else true."""
    column = F.lit(True)
    for rule in reversed(rules):
        met = F.lit(True)
        for condition in rule:
            met = met & condition.column()
        column = F.when(met, F.lit(False)).otherwise(column)
    return column


# --------------------------------------------------------------------- queries

def labelled_counts(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of labelled documents with ``good`` and ``fold``. Labels of null quality are none.

    Repeated labels and rows count as often as they pair up.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(
        "doc_id", (F.col("quality") > 0).alias("good")
    )
    return counts.join(known, "doc_id").withColumn(
        "fold", F.pmod(F.xxhash64("doc_id"), F.lit(3))
    )


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed`` and ``kept`` for every document.

    The list is learned from what passes the base rules. Null and empty texts have no
    words and fail the base rule. An empty table gives no rows; without labels the base
    rules alone decide.
    """
    counts = written(base_counts(docs.select("doc_id", "text")).drop("text"), "quality-counts")
    rules = learn_rules(labelled_counts(counts, labels).where(~base_failed()))
    return counts.select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents of ``docs`` that base rules and learned list keep, columns as they are.

    No text is shuffled: a filter of fixed size finds the labelled documents where they lie, and
    only ids and counts meet the labels. Texts that pass it are counted twice.
    """
    labelled = possibly_among(docs.select("doc_id", "text"), labels.select("doc_id"), ["doc_id"], LABEL_BITS)
    counts = written(base_counts(labelled).drop("text"), "quality-counts")
    rules = learn_rules(labelled_counts(counts, labels).where(~base_failed()))
    own = {c: free_name(f"own_{i}", COUNTS) for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[
        F.col(f"`{c.replace('`', '``')}`").alias(own[c]) for c in docs.columns
    ])
    counted = base_counts(renamed, own["text"])
    return counted.where(~base_failed() & verdict(rules)).select(
        *[F.col(own[c]).alias(c) for c in docs.columns]
    )
