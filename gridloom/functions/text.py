"""Text cleaning as column expressions, and the dictionary lemma join."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.sources.scratch import materialise

# The separator between messages and the patterns of the cleaning
# rules. Letters are basic Latin and Cyrillic a-ya without yo; words are any
# letters, digits and underscore.
SEPARATOR = "|"
REPEATED = "([a-zа-я])\\1{2,}"
TOKEN = "[\\p{L}\\p{N}_]+|[()?!]+"
WORD = "^[a-zа-я]+$"


def prefix(col: str | Column, n: int) -> Column:
    return F.substring(col, 1, n)


def clean_case(col: str | Column) -> Column:
    """Separators become blanks, letters lower case."""
    return F.lower(F.replace(_c(col), F.lit(SEPARATOR), F.lit(" ")))


def collapse_repeats(col: str | Column) -> Column:
    """Runs of three or more equal letters shrink to two."""
    return F.regexp_replace(_c(col), REPEATED, "$1$1")


def tokens(col: str | Column) -> Column:
    return F.regexp_extract_all(_c(col), F.lit(TOKEN), F.lit(0))


def keep_words(col: str | Column, min_length: int = 3) -> Column:
    """Tokens made of letters only and at least ``min_length`` long."""
    return F.filter(col, lambda t: t.rlike(WORD) & (F.length(t) >= min_length))


def raw_tokens(col: str | Column) -> Column:
    return tokens(collapse_repeats(clean_case(F.coalesce(_c(col), F.lit("")))))


def preprocess_text(col: str | Column, min_length: int = 3) -> Column:
    """The whole chain without a dictionary; null and empty give an empty list."""
    return keep_words(raw_tokens(col), min_length)


#: Parts that the occurrences of one token are dealt to.
SALTS = 16


def salted_tokens(df: DataFrame, key: str, col: str, salts: int = SALTS) -> DataFrame:
    """(key, token, __salt): each row's distinct tokens, a token's rows dealt to ``salts`` parts by their keys."""
    tokens = df.filter(F.col(key).isNotNull()).select(key, F.explode(F.array_distinct(col)).alias("token"))
    return tokens.withColumn("__salt", F.pmod(F.xxhash64(key, "token"), F.lit(salts)).cast("int"))


def lemmatise(
    df: DataFrame, key: str, col: str, dictionary: DataFrame, out: str = "lemmas", salts: int = SALTS
) -> DataFrame:
    """Replace tokens through a (token, lemma) table, keeping their order.

    A row sends each of its distinct tokens once and gets the lemmas of those it has any for back,
    as a list no longer than its own tokens. A token that most rows hold is spread: its
    rows are dealt to ``salts`` parts, and the dictionary has a copy for each part.
    Keys must be unique; a null key's tokens stay as they are; rows without tokens get an empty list; of
    several lemmas of a token the first in order counts.
    """
    lemmas = dictionary.groupBy("token").agg(F.min("lemma").alias("lemma")).filter("token IS NOT NULL AND lemma IS NOT NULL")
    # Written, its size is known: tokens are shuffled only where the dictionary is too large to go to them.
    lemmas = materialise(lemmas)
    copies = lemmas.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    found = salted_tokens(df, key, col, salts).join(copies, ["token", "__salt"])
    pairs = found.groupBy(key).agg(F.collect_list(F.struct("token", "lemma")).alias("__pairs"))
    tokens = F.coalesce(F.col(col), F.array().cast("array<string>"))
    replaced = F.when(F.col("__pairs").isNull(), tokens).otherwise(_replaced()(col, "__pairs.token", "__pairs.lemma"))
    return df.join(pairs, key, "left").withColumn(out, replaced).drop("__pairs")


def _replaced():
    """A row's tokens with the lemmas of some of them: hashed once a row, where a map column would be searched for every token."""

    @F.pandas_udf("array<string>")
    def replaced(tokens: pd.Series, known: pd.Series, lemmas: pd.Series) -> pd.Series:
        def of(words, token, lemma) -> list | None:
            if words is None or token is None:
                return None
            found = dict(zip(token, lemma, strict=True))
            return [found.get(t, t) for t in words]

        return pd.Series([of(*row) for row in zip(tokens, known, lemmas, strict=True)], dtype=object)

    return replaced


def preprocess_with_lemmas(
    df: DataFrame, key: str, col: str, dictionary: DataFrame, out: str = "lemmas", min_length: int = 3
) -> DataFrame:
    """Clean, tokenise, lemmatise, then keep words."""
    tokenised = materialise(df.withColumn("__tokens", raw_tokens(col)))  # read for the join and for the result
    done = lemmatise(tokenised, key, "__tokens", dictionary, out).drop("__tokens")
    return done.withColumn(out, keep_words(out, min_length))


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col
