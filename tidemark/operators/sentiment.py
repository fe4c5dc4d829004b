"""Lexicon sentiment.

Per post: ``s`` = sum of lexicon valences of its tokens (with multiplicity),
compound = ``s / sqrt(s^2 + alpha)`` rounded to 4 decimals, then its
absolute value.

A lexicon within the inline bounds (counted first; a published lexicon has
a few thousand words and a few dozen distinct valences) is applied inside
the projection: one literal key set per valence, tested as a hash set. A
larger one is joined on the exploded tokens and summed per post.

With :class:`SentimentRules` a token's valence depends on the tokens around it,
after the published rules of Hutto and Gilbert (2014): a booster within three
tokens before adds its weight, less with distance; a negator there turns and
damps the valence; what stands before a contrast word counts half, after it one
and a half times. On the projection path a token looks its neighbours up in the
post's arrays, on the join path by ``lag`` over the exploded tokens.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.fixed import SENTIMENT_ALPHA, SENTIMENT_DECIMALS
from tidemark.functions.text import normalise_sentiment, token_rows
from tidemark.operators.lookup import (
    DEFAULT_INLINE_KEYS,
    DEFAULT_INLINE_VALUES,
    join_lookup,
    value_sets,
)


@dataclass(frozen=True)
class SentimentRules:
    """Term tables (each may be None) and the rules' constants.

    ``boosters``: ``token, weight`` (negative weights damp); ``negators``,
    ``contrasts``: ``token``. A contrast word is the first of its kind in a post.
    """

    boosters: DataFrame | None = None
    negators: DataFrame | None = None
    contrasts: DataFrame | None = None
    decay: tuple[float, ...] = (1.0, 0.95, 0.9)      # of a booster one, two, three tokens before
    negation: float = -0.74
    before: float = 0.5
    after: float = 1.5

    def tables(self) -> dict[str, DataFrame]:
        """``token, value`` of every kind of term that is given."""
        one = lambda t: t.select("token", F.lit(1.0).alias("value")).distinct()
        out = {}
        if self.boosters is not None:
            out["__b"] = self.boosters.groupBy("token").agg(F.avg(F.col("weight").cast("double")).alias("value"))
        if self.negators is not None:
            out["__n"] = one(self.negators)
        if self.contrasts is not None:
            out["__c"] = one(self.contrasts)
        return out

    def valence(self, v: Column, back, place: Column, contrast: Column) -> Column:
        """A token's valence by the rules: ``back(kind, k)`` is the value ``k`` tokens before, ``contrast`` the place of the
        post's contrast word (null: none)."""
        total, negated = v, F.lit(0.0)
        for k, decay in enumerate(self.decay, 1):
            total = total + F.signum(v) * F.coalesce(back("__b", k), F.lit(0.0)) * F.lit(decay)
            negated = negated + F.coalesce(back("__n", k), F.lit(0.0))
        side = (F.when(place < contrast, self.before).when(place > contrast, self.after).otherwise(1.0))
        return F.when(v == 0, 0.0).otherwise(total * F.pow(F.lit(self.negation), negated) * side)


def _by_sets(sets: list[tuple[float, list[str]]], token: Column) -> Column:
    v = F.lit(0.0)
    for value, keys in reversed(sets):
        v = F.when(token.isin(keys), F.lit(value)).otherwise(v)
    return v


def _inline_total(df: DataFrame, sets: dict[str, list], tokens_col: str, rules: SentimentRules | None) -> DataFrame:
    """``__s``: sum over the tokens, inside the projection."""
    if rules is None:
        return df.withColumn("__s", F.aggregate(F.col(tokens_col), F.lit(0.0),
                                                lambda acc, t: acc + _by_sets(sets["__v"], t)))
    values = lambda found: F.transform(tokens_col, lambda t: _by_sets(found, t))
    arrays = {kind: values(found) for kind, found in sets.items()}
    out = df.withColumns(arrays)
    back = lambda kind, k, i: F.get(kind, i - k) if kind in sets else F.lit(0.0)
    contrast = F.nullif(F.array_position("__c", 1.0), F.lit(0)) - 1 if "__c" in sets else F.lit(None).cast("long")
    parts = F.transform("__v", lambda v, i: rules.valence(v, lambda kind, k: back(kind, k, i), i, F.col("__at")))
    return (out.withColumn("__at", contrast).withColumn("__s", F.aggregate(parts, F.lit(0.0), lambda a, x: a + x))
               .drop("__at", *arrays))


def _joined_total(df: DataFrame, tables: dict[str, DataFrame], tokens_col: str, key_col: str,
                  rules: SentimentRules | None) -> DataFrame:
    """``__s``: sum over the exploded tokens, joined with the term tables."""
    if rules is None:
        sums = (join_lookup(token_rows(df, [key_col], tokens_col), tables["__v"], "token")
                  .groupBy(key_col).agg(F.sum("value").alias("__s")))
        return df.join(sums, key_col, "left")
    rows = token_rows(df, [key_col], tokens_col, pos="__pos")
    for kind, table in tables.items():
        rows = join_lookup(rows, table.withColumnRenamed("value", kind), "token", "left")
    order = Window.partitionBy(key_col).orderBy("__pos")
    back = lambda kind, k: F.lag(kind, k).over(order) if kind in tables else F.lit(0.0)
    first = (F.min(F.when(F.col("__c").isNotNull(), F.col("__pos"))).over(Window.partitionBy(key_col))
             if "__c" in tables else F.lit(None).cast("int"))
    v = F.coalesce("__v", F.lit(0.0))
    scored = rows.select(key_col, rules.valence(v, back, F.col("__pos"), first).alias("__x"))
    return df.join(scored.groupBy(key_col).agg(F.sum("__x").alias("__s")), key_col, "left")


def sentiment_score(df: DataFrame, lexicon: DataFrame, tokens_col: str = "tokens",
                    out_col: str = "sentiment", absolute: bool = True,
                    key_col: str = "post_id", alpha: float = SENTIMENT_ALPHA,
                    decimals: int = SENTIMENT_DECIMALS,
                    inline_keys: int = DEFAULT_INLINE_KEYS,
                    inline_values: int = DEFAULT_INLINE_VALUES,
                    rules: SentimentRules | None = None) -> DataFrame:
    """Add ``out_col``; ``lexicon`` is ``token, valence``.

    A token listed more than once has the mean of its valences; rows without
    token or valence are ignored. So both paths see one valence per token.
    ``rules``: valences in context. ``key_col`` is unique per row.
    """
    tables = {"__v": lexicon.where(F.col("token").isNotNull() & F.col("valence").isNotNull())
              .groupBy("token").agg(F.avg(F.col("valence").cast("double")).alias("value"))}
    tables |= rules.tables() if rules else {}
    sets = {}
    for kind, table in tables.items():
        found = value_sets(table, "token", "value", inline_keys, inline_values)
        if found is None:
            out = _joined_total(df, tables, tokens_col, key_col, rules)
            break
        sets[kind] = found
    else:
        out = _inline_total(df, sets, tokens_col, rules)
    score = normalise_sentiment("__s", alpha, decimals)
    if absolute:
        score = F.abs(score)
    return out.withColumn(out_col, score).drop("__s")
