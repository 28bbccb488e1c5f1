"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic. The cells' token counts are raked: scaled to
the target share of each source, then of each language, then of each topic, again and again until all
three fit, never above the tokens a cell has. A cell's weight over its tokens is the probability with
which each of its documents is drawn; the draw is a hash of the id, so a rerun draws the same ones.

Only the cells pass through the driver: as many as there are combinations of the three labels.

The topic of a document without a topic column is the group of words, of `TOPICS` by hash, that most
of its long words fall into; its tokens are its words between white space. Both are DataFrame functions.

Defined results: null labels are a label of their own; null or empty texts have 0 tokens, topic -1 and
are drawn with their cell; repeated rows are drawn together; an empty table gives no rows. Other columns
are kept, those named `tokens`, `topic` or `probability` are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOPICS = 8
LONG_WORD = 6
DIMENSIONS = ("source", "lang", "topic")


def word_count(text: Column) -> Column:
    words = F.split(F.coalesce(text, F.lit("")), r"\s+")
    return F.size(F.filter(words, lambda w: w != "")).cast("long")


def hashed_topic(text: Column, topics: int = TOPICS) -> Column:
    """The word group that most long words fall into, the first of equals; -1 without one."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+")
    long_ = F.filter(words, lambda w: F.length(w) >= LONG_WORD)
    groups = F.transform(long_, lambda w: F.pmod(F.xxhash64(w), F.lit(topics)).cast("int"))

    def most(groups: Column) -> Column:
        counts = F.array(*[F.size(F.filter(groups, lambda g: g == k)) for k in range(topics)])
        best = F.transform(F.array(counts), lambda c: F.array_position(c, F.array_max(c)) - 1)[0]
        return F.when(F.size(groups) > 0, best.cast("int")).otherwise(F.lit(-1))

    return F.transform(F.array(groups), most)[0]


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `tokens` and `topic`."""
    return docs.withColumns({"tokens": word_count(F.col(text)), "topic": hashed_topic(F.col(text))})


def tempered(tokens: Mapping, power: float = 0.5) -> dict:
    """Shares in proportion to a power of the tokens, so that small labels gain."""
    raised = {k: float(v) ** power for k, v in tokens.items() if v > 0}
    total = sum(raised.values())
    return {k: v / total for k, v in raised.items()}


def rake(
    tokens: np.ndarray,
    labels: list[list],
    targets: list[Mapping],
    budget: float,
    rounds: int = 2000,
    close: float = 1e-9,
) -> np.ndarray:
    """Weights of cells (tokens to draw) whose marginals fit the targets, at most `tokens` each.

    Labels without a target get nothing. Where the tokens of a label don't suffice, what is left of
    the budget goes to the others in proportion.
    """
    weights = np.array(tokens, float)
    numbers, wanted = [], []
    for dimension, target in zip(labels, targets):
        names = list(dict.fromkeys(dimension))
        numbers.append(np.array([names.index(x) for x in dimension], int))
        share = np.array([target.get(x, 0.0) for x in names])
        wanted.append(budget * share / max(share.sum(), 1e-300))
    for _ in range(rounds):
        before = weights
        for number, want in zip(numbers, wanted):
            have = np.bincount(number, weights, len(want))
            factor = np.divide(want, have, out=np.zeros_like(want), where=have > 0)
            weights = np.minimum(weights * factor[number], tokens)
        if np.abs(weights - before).max(initial=0) <= close * max(budget, 1):
            break
    short = budget - weights.sum()
    room = tokens - weights
    wanted_cells = weights > 0
    if short > 0 and (room * wanted_cells).sum() > 0:
        # Spread what could not be met over cells with room, by their weight.
        for _ in range(100):
            grow = weights * (room > 0) * wanted_cells
            if short <= close * budget or grow.sum() <= 0:
                break
            weights = np.minimum(weights + short * grow / grow.sum(), tokens)
            short, room = budget - weights.sum(), tokens - weights
    return weights


def mix(
    docs: DataFrame,
    fraction: float = 0.5,
    power: float = 0.5,
    targets: Mapping[str, Mapping] | None = None,
    seed: int = 11,
) -> DataFrame:
    """Draw documents so that about `fraction` of all tokens are kept at the target shares.

    `docs` has `doc_id`, the `DIMENSIONS` and `tokens`; `targets` may give shares by label for any
    dimension, the others are tempered. Adds `probability`. A document is drawn by a hash of its id and,
    where `docs` has it, its `text`: rows without an id are drawn each by their text, equal rows together.
    """
    cells = (
        docs.groupBy(*DIMENSIONS)
        .agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
        .orderBy(*DIMENSIONS)
        .collect()
    )
    tokens = np.array([c["tokens"] for c in cells], float)
    labels = [[c[d] for c in cells] for d in DIMENSIONS]
    shares = []
    for dimension, values in zip(DIMENSIONS, labels):
        sums: dict = {}
        for value, count in zip(values, tokens):
            sums[value] = sums.get(value, 0.0) + count
        shares.append((targets or {}).get(dimension) or tempered(sums, power))
    weights = rake(tokens, labels, shares, fraction * tokens.sum())
    chance = np.divide(weights, tokens, out=np.full_like(tokens, fraction), where=tokens > 0)
    rows = [
        (*[c[d] for d in DIMENSIONS], float(p)) for c, p in zip(cells, np.clip(chance, 0, 1))
    ]
    schema = docs.select(*[F.col(d).alias(f"_mix_{d}") for d in DIMENSIONS]).schema
    table = docs.sparkSession.createDataFrame(
        rows, schema.add("probability", "double")
    )
    same = F.lit(True)
    for dimension in DIMENSIONS:
        same = same & F.col(dimension).eqNullSafe(F.col(f"_mix_{dimension}"))
    # The table has one row per cell and has just been on the driver.
    joined = docs.drop("probability").join(F.broadcast(table), same)
    joined = joined.drop(*[f"_mix_{d}" for d in DIMENSIONS])
    drawn_by = [c for c in ("doc_id", "text") if c in docs.columns]
    draw = F.pmod(F.xxhash64(*drawn_by, F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    return joined.filter(draw < F.col("probability"))
