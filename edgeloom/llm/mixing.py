"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted by cell (source x language x topic, say), each cell's tokens are
raked until every margin has its target shares, and a document is sampled with a
probability in proportion to the raked weight of its cell. The decision is a hash of
the document, so it is the same on every run, on every executor, after any loss.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from math import prod

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tables import WORD_CLASS, free_name, without

#: Category of every value without a target of its own, null among them.
OTHER = "*"
#: Cells that reach the driver at most.
MAX_CELLS = 200_000
ROUNDS = 1000
#: What the pipeline allows: cells that need the highest rates may miss this share of all raked
#: tokens, so that a few rare documents do not set the rate of all others.
SLACK = 0.02
TOLERANCE = 1e-10


@dataclass(frozen=True)
class Margin:
    """A column of categories, as strings, and its target shares of tokens.

    ``names`` are the categories told apart; all other values, null among them, are
    ``OTHER``. Where ``names`` is None every value is a category and only null is
    ``OTHER``. Target shares are those in ``shares`` (absent: 0), or, where that is None,
    the actual shares to the power of ``temper``, which below 1 lifts the small ones.
    Either is taken relative to its sum over the categories that have tokens.
    """

    value: Column
    names: Sequence[str] | None = None
    shares: Mapping[str, float] | None = None
    temper: float = 1.0

    def categories(self) -> list[str]:
        return list(dict.fromkeys([*(self.names or []), OTHER]))

    def category(self) -> Column:
        value = self.value.cast("string")
        if self.names is None:
            return F.coalesce(value, F.lit(OTHER))
        return F.when(value.isin(list(self.names)), value).otherwise(F.lit(OTHER))

    def targets(self, tokens: np.ndarray) -> np.ndarray:
        """Target per category; ``tokens`` has the actual ones."""
        if self.shares is None:
            return tokens ** self.temper
        return np.array([self.shares.get(c, 0.0) for c in self.categories()], float)


def rake(tokens: np.ndarray, codes: list[np.ndarray], shares: list[np.ndarray]) -> np.ndarray:
    """Cell weights with the margins' target shares, their sum that of ``tokens``.

    ``codes[m][c]`` is the category of cell ``c`` in margin ``m``, ``shares[m]`` its
    target per category. Stops when all margins hold to ``TOLERANCE``, or after
    ``ROUNDS`` rounds where empty cells make the targets contradict each other.
    """
    weights, total = tokens.astype(float), float(tokens.sum())
    if not total:
        return weights
    wanted = []
    for code, share in zip(codes, shares):
        present = np.bincount(code, weights, len(share)) > 0
        share = np.where(present, share, 0.0)
        if share.sum() <= 0:
            raise ValueError("no category with tokens has a target share")
        wanted.append(share / share.sum() * total)
    for _ in range(ROUNDS):
        worst = 0.0
        for code, goal in zip(codes, wanted):
            now = np.bincount(code, weights, len(goal))
            worst = max(worst, float(np.abs(now - goal).max()) / total)
            weights = weights * np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)[code]
        if worst < TOLERANCE:
            break
    return weights


def mix(
    docs: DataFrame, margins: Mapping[str, Margin], tokens: Column, identity: list[Column],
    seed: int = 17, slack: float = 0.0,
) -> DataFrame:
    """``docs`` with ``mix_weight``, ``mix_probability`` and ``mix_sampled``.

    ``mix_weight`` is the factor between the tokens of the document's cell and its raked
    tokens; the probability is the weight over the largest one, so sampled tokens have
    the target shares in expectation and no more documents are lost than that takes. With
    ``slack`` the heaviest cells may miss that share of all raked tokens between them: fewer
    documents are lost, and the margins hold to that share only.
    Rows of equal ``identity`` share a decision. A null or negative token count is 0; a
    cell without tokens has weight 1, and the smallest probability any cell has would not
    change its (absent) share, so its rows stay. An empty table gives no rows. Columns
    that already have these names are replaced.

    Cells reach the driver: the product of the named margins' categories is checked
    against ``MAX_CELLS``, and so are the cells counted, however large ``docs`` is.
    More raise an error; none is merged or left out.
    """
    bound = prod(len(m.categories()) for m in margins.values())
    if bound > MAX_CELLS:
        raise ValueError(f"{bound} cells; at most {MAX_CELLS} are mixed")
    out = ("mix_weight", "mix_probability", "mix_sampled")
    names = {m: free_name(f"cell_{i}", docs.columns) for i, m in enumerate(margins)}
    celled = docs.withColumns({names[m]: margin.category() for m, margin in margins.items()})
    counted = celled.groupBy(*names.values()).agg(
        F.sum(F.greatest(F.coalesce(tokens.cast("long"), F.lit(0)), F.lit(0))).alias("tokens")
    ).orderBy(*names.values()).limit(MAX_CELLS + 1).collect()
    if len(counted) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells; at most {MAX_CELLS} are mixed")
    margins = {
        m: margin if margin.names is not None
        else replace(margin, names=sorted({r[names[m]] for r in counted}))
        for m, margin in margins.items()
    }

    weight = free_name("weight", docs.columns)
    chance = free_name("chance", docs.columns)
    chances = _chances(counted, margins, names, slack)
    cells = [(*[r[n] for n in names.values()], *p) for r, p in zip(counted, chances)]
    schema = ", ".join([f"`{n}` string" for n in names.values()]
                       + [f"`{n}` double" for n in (weight, chance)])
    known = docs.sparkSession.createDataFrame(cells, schema)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *identity), 11) * F.lit(2.0 ** -53)
    return celled.join(F.broadcast(known), list(names.values())).select(
        *without(docs, *out), F.col(weight).alias(out[0]), F.col(chance).alias(out[1]),
        (draw < F.col(chance)).alias(out[2]),
    )


def shares_of(targets: DataFrame) -> dict[str, dict[str, float]]:
    """Target shares by margin and category, from a table ``margin, category, share``.

    A null category is ``OTHER``; rows of one category add up, null shares count as 0. At most
    ``MAX_CELLS`` rows reach the driver, more raise an error.
    """
    rows = targets.groupBy("margin", F.coalesce("category", F.lit(OTHER)).alias("category")).agg(
        F.coalesce(F.sum(F.col("share").cast("double")), F.lit(0.0)).alias("share")
    ).limit(MAX_CELLS + 1).collect()
    if len(rows) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} target shares")
    found: dict[str, dict[str, float]] = {}
    for row in rows:
        found.setdefault(row["margin"], {})[row["category"]] = row["share"]
    return found


def _chances(
    counted: list, margins: Mapping[str, Margin], names: Mapping[str, str], slack: float
) -> list[tuple]:
    """Weight and probability of each counted cell."""
    tokens = np.array([r["tokens"] for r in counted], float)
    codes, shares = [], []
    for m, margin in margins.items():
        place = {c: i for i, c in enumerate(margin.categories())}
        codes.append(np.array([place[r[names[m]]] for r in counted], int))
        shares.append(margin.targets(np.bincount(codes[-1], tokens, len(place))))
    raked = rake(tokens, codes, shares)
    weights = np.divide(raked, tokens, out=np.ones_like(tokens), where=tokens > 0)
    chances = np.where(tokens > 0, np.minimum(1.0, weights / _unit(weights, raked, slack)), 1.0)
    return list(zip(weights.tolist(), chances.tolist()))


def _unit(weights: np.ndarray, raked: np.ndarray, slack: float) -> float:
    """The weight that is sampled whole: heavier cells hold at most ``slack`` of the raked tokens."""
    order = np.argsort(-weights, kind="stable")
    before = np.cumsum(raked[order]) - raked[order]
    held = order[(raked[order] > 0) & (before <= slack * raked.sum())]
    return float(weights[held[-1]]) if len(held) else 1.0


# --- The mix of the tables at hand. ---
#: Documents have no topic of their own; the form of a text stands for it.
TOPICS = ["table", "note", "article", "book"]
SOURCE_TEMPER, LANGUAGE_TEMPER, TOPIC_TEMPER = 0.7, 0.9, 0.9


def words_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"{WORD_CLASS}+"))


def topic_of(text: Column, words: Column) -> Column:
    """``table`` if a word in twenty is a bar, else by length: ``note``, ``article``, ``book``."""
    bars = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r" \|"))
    return (
        F.when(20 * bars > words, "table").when(words < 100, "note")
        .when(words < 1500, "article").otherwise("book")
    )


def mix_documents(
    docs: DataFrame, slack: float = 0.0, shares: Mapping[str, Mapping[str, float]] | None = None
) -> DataFrame:
    """``docs`` with ``topic``, ``tokens`` (words) and what ``mix`` adds.

    Every source and every language that occurs is a category of its own. ``shares`` has the
    target shares of the margins ``source``, ``lang`` and ``topic`` (as from ``shares_of``); a
    margin without any keeps its actual ones, tempered.
    """
    shares = shares or {}
    text = F.col("text")
    out = docs.select(*without(docs, "topic", "tokens"), words_of(text).cast("long").alias("tokens"))
    out = out.withColumn("topic", topic_of(text, F.col("tokens")))
    margins = {
        "source": Margin(F.col("source"), None, shares.get("source"), SOURCE_TEMPER),
        "lang": Margin(F.col("lang"), None, shares.get("lang"), LANGUAGE_TEMPER),
        "topic": Margin(F.col("topic"), TOPICS, shares.get("topic"), TOPIC_TEMPER),
    }
    identity = [F.col("doc_id"), F.coalesce(text, F.lit(""))]
    return mix(out, margins, F.col("tokens"), identity, slack=slack)


def mix_report(docs: DataFrame, slack: float = 0.0) -> DataFrame:
    """One row per document: its cell, tokens, calibrated weight, probability and the decision."""
    return mix_documents(docs, slack).select(
        "doc_id", "source", "lang", "topic", "tokens", "mix_weight", "mix_probability",
        "mix_sampled",
    )


def sample_mix(docs: DataFrame, slack: float = SLACK) -> DataFrame:
    """The sampled documents with the columns of ``docs``."""
    used = {"doc_id", "text", "source", "lang"}
    own = {c: c if c in used else free_name(f"own_{i}", docs.columns)
           for i, c in enumerate(docs.columns)}
    sampled = mix_documents(docs.withColumnsRenamed(own), slack).where("mix_sampled")
    return sampled.select(*[F.col(n).alias(c) for c, n in own.items()])
