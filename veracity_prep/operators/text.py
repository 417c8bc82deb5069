"""The configurable preprocessing of a text column."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep.functions import text as T
from veracity_prep.functions.stem import stem_tokens
from veracity_prep.operators.shared import fixed
from veracity_prep.options import TextOptions


def prepared_tokens(c: Column, options: TextOptions) -> Column:
    """Cleaned, tokenized text without stopwords, stemmed if so configured."""
    tokens = T.tokenize(T.clean_text(c), options.split_contractions)
    if options.remove_stopwords:
        tokens = T.drop_stopwords(tokens, T.stopword_list(options))
    return stem_tokens(tokens) if options.stemming else tokens


def finished_text(tokens: Column, options: TextOptions) -> Column:
    return T.truncate(T.join_tokens(tokens), options.max_length)


#: Words the summary of frequent words follows, and how many of them go to the map of a task.
FOLLOWED, FREQUENT = 20_000, 4_096
#: Entries a map of lemmas may have, and its parts: a lookup goes to one part by hash and meets a few entries there.
MAP_ROWS, PARTS = 50_000, 8_192


def lemma_changes(lexicon: DataFrame) -> DataFrame:
    """``_word, lemma`` of the words a lexicon changes. One lemma per form: the smallest, whatever the row order."""
    lemmas = lexicon.where("form is not null and lemma is not null").groupBy("form").agg(F.min("lemma").alias("lemma"))
    return lemmas.where("form <> lemma").withColumnRenamed("form", "_word")


def lookup(spark: SparkSession, pairs: Mapping[str, str]) -> Callable[[Column], Column]:
    """A function from a word column to its entry, NULL without one. ``pairs`` becomes one literal, so keep it small."""
    words = spark.createDataFrame([(w,) for w in pairs], "w string").select("w", _part(F.col("w")).alias("part")).collect()
    parts: list[dict[str, str]] = [{} for _ in range(PARTS)]
    for row in words:
        parts[row["part"]][row["w"]] = pairs[row["w"]]
    maps = F.from_json(F.lit(json.dumps(parts)), "array<map<string, string>>")
    return lambda word: F.try_element_at(maps[_part(word)], word)


def _part(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(PARTS)).cast("int")


def lemmatize(df: DataFrame, tokens: str, lexicon: DataFrame, key: Sequence[str], map_rows: int = MAP_ROWS) -> DataFrame:
    """Replace the tokens of an array column by their lemmas.

    A lexicon that changes at most ``map_rows`` words goes to the tasks as a map, and the rows stay where they are; a
    larger one is joined (:func:`lemmatize_by_join`). Both give the same rows.
    """
    changes = lemma_changes(lexicon)
    few = changes.limit(map_rows + 1).collect()
    if len(few) > map_rows:
        return lemmatize_by_join(df, tokens, lexicon, key)
    lemma = lookup(df.sparkSession, {r["_word"]: r["lemma"] for r in few})
    return df.withColumn(tokens, F.transform(tokens, lambda t: F.coalesce(lemma(t), t)))


def frequent_words(df: DataFrame, tokens: str) -> list[str]:
    """The most frequent words of a token column, at most ``FREQUENT``, from one pass with a mergeable summary.

    A word that makes up more than a ``FOLLOWED``-th of all tokens is among those the summary follows. A word it
    misses costs time, not correctness.
    """
    words = df.select(F.explode(tokens).alias("_word"))
    top = words.agg(F.expr(f"approx_top_k(_word, {FREQUENT}, {FOLLOWED})").alias("_top")).first()["_top"]
    return [t["item"] for t in top or () if t["item"] is not None]


def lemmatize_by_join(df: DataFrame, tokens: str, lexicon: DataFrame, key: Sequence[str]) -> DataFrame:
    """Replace the tokens of an array column by their lemmas, for lexicons of any size.

    The rows are written once with their tokens, so nothing is tokenized twice. Frequent words, which would stand out in
    a join, are looked up in a map of bounded size and never leave their row. Each row sends its distinct other words
    to the join with the lexicon; what changes in a row comes back as one map. ``key`` identifies the rows of ``df``;
    rows that share a key share the map.
    """
    key, changes = list(key), lemma_changes(lexicon)
    df = fixed(df, "tokens")
    spark, names = df.sparkSession, frequent_words(df, tokens)
    # At most FREQUENT rows, so they may go everywhere and come back.
    frequent = F.broadcast(spark.createDataFrame([(n,) for n in names], "_word string"))
    lemmas = {r["_word"]: r["lemma"] for r in changes.join(frequent, "_word").collect()}
    known = lookup(spark, {n: lemmas.get(n, n) for n in names})

    rare = F.filter(F.array_distinct(tokens), lambda t: known(t).isNull())
    words = df.select(*key, F.explode(rare).alias("_word"))
    maps = words.join(changes, "_word").groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)]).agg(
        F.map_from_entries(F.collect_set(F.struct("_word", "lemma"))).alias("_lemmas")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(key)]
    out = df.join(maps, reduce(and_, same), "left")
    replaced = F.transform(tokens, lambda t: F.coalesce(known(t), F.try_element_at("_lemmas", t), t))
    return out.withColumn(tokens, replaced).drop("_lemmas", *[f"_key_{i}" for i in range(len(key))])


def preprocess(
    df: DataFrame,
    column: str,
    output: str,
    options: TextOptions | None = None,
    lexicon: DataFrame | None = None,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``output``: ``column`` cleaned, tokenized, filtered, stemmed or lemmatized, joined and truncated.

    Without lemmatization this is one projection. A ``lexicon`` of ``(form, lemma)`` needs ``key``, the columns
    that identify a row.
    """
    options = options or TextOptions()
    tokens = prepared_tokens(F.col(column), options)
    if lexicon is None or options.stemming or not options.lemmatization:
        return df.withColumn(output, finished_text(tokens, options))
    if not key:
        raise ValueError("a lexicon needs the key columns of the rows")
    out = lemmatize(df.withColumn("_tokens", tokens), "_tokens", lexicon, key)
    return out.withColumn(output, finished_text(F.col("_tokens"), options)).drop("_tokens")
