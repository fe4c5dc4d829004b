"""Lemma lookup for nouns.

Candidates are the word itself plus the noun suffix rules applied once;
if none is in the lemma vocabulary the rules are applied again to the
previous forms, until no form is left. The shortest candidate of the first
round with any hit wins (first in candidate order on ties); a word with no
hit is its own lemma. An exception table replaces the rules for the words it
lists. All of it is array expressions plus one join with the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixed import NOUN_SUFFIX_RULES
from tidemark.operators.lookup import join_lookup


def _apply_rules(forms: Column) -> Column:
    def one(x: Column) -> Column:
        outs = [F.when(x.endswith(old) & (F.length(x) >= len(old)),
                       F.concat(x.substr(F.lit(1), F.length(x) - len(old)), F.lit(new)))
                for old, new in NOUN_SUFFIX_RULES]
        return F.filter(F.array(*outs), lambda y: y.isNotNull())
    return F.flatten(F.transform(forms, one))


def lemma_candidates(word: Column) -> Column:
    """``array<struct<lvl, ord, form>>``: the word and one application of the rules (lvl 0), then
    each further application to the previous forms, until none is left.

    Every rule shortens the word or ends the chain, so a word of n characters
    has at most n rounds; a form that comes up again in a round counts once.
    """
    def struct(lvl: Column, i: Column, form: Column) -> Column:
        return F.struct(lvl.cast("int").alias("lvl"), i.cast("int").alias("ord"), form.alias("form"))

    def tag(forms: Column, lvl: Column) -> Column:
        return F.transform(forms, lambda x, i: struct(lvl, i, x))

    first = F.array_distinct(_apply_rules(F.array(word)))
    start = F.struct(first.alias("forms"), tag(F.concat(F.array(word), first), F.lit(0)).alias("all"))

    def round_(acc: Column, lvl: Column) -> Column:
        forms = F.array_distinct(_apply_rules(acc["forms"]))
        return F.when(F.size(acc["forms"]) == 0, acc).otherwise(
            F.struct(forms.alias("forms"), F.concat(acc["all"], tag(forms, lvl)).alias("all")))

    rounds = F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1)))
    return F.aggregate(rounds, start, round_)["all"]


def lemmatize_tokens(tokens: DataFrame, vocab: DataFrame,
                     exceptions: DataFrame | None = None) -> DataFrame:
    """``token, lemma`` for every distinct token.

    ``vocab``: one column of valid lemmas (first column is used).
    ``exceptions``: ``token, lemma`` irregular forms (several rows per token allowed).
    """
    tokens = tokens.select("token").distinct()
    vocab = vocab.select(F.col(vocab.columns[0]).alias("form")).distinct()
    tok, cands = tokens, lemma_candidates(F.col("token"))
    if exceptions is not None:
        exc = exceptions.groupBy("token").agg(F.collect_list("lemma").alias("__exc"))
        tok = join_lookup(tokens, exc, "token", "left")
        listed = F.transform(F.concat(F.array(F.col("token")), F.col("__exc")), lambda x, i: F.struct(
            F.lit(-1).alias("lvl"), i.cast("int").alias("ord"), x.alias("form")))
        cands = F.when(F.col("__exc").isNotNull(), listed).otherwise(cands)
    ex = tok.select("token", F.explode_outer(cands).alias("c")).select("token", "c.*")
    hits = join_lookup(ex, vocab, "form")
    best = hits.groupBy("token").agg(
        F.min_by("form", F.struct("lvl", F.length("form"), "ord")).alias("lemma"))
    return (tokens.join(best, "token", "left")
                  .select("token", F.coalesce("lemma", "token").alias("lemma")))
