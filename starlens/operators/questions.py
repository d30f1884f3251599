"""Question -> scope for a table of questions (J4), and the text helpers of
the scope extractor (H11, H12).

The vocabulary is the set of (scope key, value) pairs present in the star:
the values of every scope column.  A question names a value when the
value's words appear in it as consecutive words (case-insensitive, any
non-letter/digit character separates words, so ``NATION_2`` matches
"nation 2").  Matching is an equi-join of the questions' word n-grams with
the vocabulary, of the lengths that occur in it only.  A service keeps the
vocabulary as a small table (``refresh_vocabulary``, after each compaction)
and passes it in; then no fact is read for a question.  When a question names several values of one key, the longest wins,
then the smallest.  Only named keys enter the scope; none gives ``{}``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.functions.scope import SCOPE_KEYS
from starlens.session import shared_dir
from starlens.sources.star import Star

MAX_HINTED_VOCABULARY = 100_000  # entries; a larger vocabulary is joined without a broadcast hint
WORD_BREAK = r"[^\p{L}\p{N}]+"


def normalize(c: Column) -> Column:
    """Lower-cased words separated by single spaces."""
    return F.trim(F.regexp_replace(F.lower(c), WORD_BREAK, " "))


def strip_fences(c: Column) -> Column:
    """Drop markdown code fences around a JSON answer and trim."""
    return F.regexp_replace(F.regexp_replace(c, "```json|```", ""), r"^\s+|\s+$", "")


def parse_scope(c: Column) -> Column:
    """Scope JSON text -> map; invalid or non-object text -> empty map."""
    parsed = F.from_json(strip_fences(c), "map<string,string>")
    return F.coalesce(parsed, F.create_map().cast("map<string,string>"))


def props_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H11, H12 over the events' props: each answered in a code fence, as a
    model would, and read back as a map: (event_id, keys, k)."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    answer = F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```  "))
    return events.select("event_id", parse_scope(answer).alias("scope")).select(
        "event_id", F.size("scope").alias("keys"), F.col("scope")["k"].alias("k"))


def vocabulary(star: Star) -> DataFrame:
    """(key, value, norm, words): distinct values of every scope column."""
    parts = [
        star[table].select(F.lit(key).alias("key"), F.col(column).alias("value"))
        for key, (table, column) in SCOPE_KEYS.items()
    ]
    v = reduce(DataFrame.unionByName, parts).where(F.col("value").isNotNull()).distinct()
    v = v.withColumn("norm", normalize(F.col("value")))
    return v.where(F.col("norm") != "").withColumn("words", F.size(F.split("norm", " ")))


def refresh_vocabulary(star: Star, path: str) -> DataFrame:
    """Write the vocabulary of ``star`` to a new folder under ``path``, made
    of distinct values only, and return it as read back.  Folders of earlier
    refreshes stay for readers that still use them."""
    folder = f"{path.rstrip('/')}/vocabulary-{uuid.uuid4().hex}"
    vocabulary(star).write.parquet(folder)
    return star.spark.read.parquet(folder)


def user_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user turns of the conversations table: (conv_id, turn, text)."""
    conv = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return conv.where(F.col("role") == "user").select("conv_id", "turn", "text")


def question_scope(star: Star, questions: DataFrame, id_cols: tuple[str, ...] = ("conv_id", "turn"),
                   text_col: str = "text", vocab: DataFrame | None = None) -> DataFrame:
    """(id_cols..., scope_json, scope_keys) for every question.  Without a
    maintained ``vocab`` the star's is computed once and checkpointed."""
    ids = list(id_cols)
    if vocab is None:
        shared_dir(star.spark)
        vocab = vocabulary(star).checkpoint()
    lengths = vocab.select(F.array_sort(F.collect_set("words"))).scalar()
    toks = questions.select(*ids, F.split(normalize(F.col(text_col)), " ").alias("toks"))
    toks = toks.withColumn("_all", lengths).withColumn("_lengths", F.filter("_all", lambda n: n <= F.size("toks")))
    grams = toks.select(
        *ids,
        F.explode(
            F.flatten(
                F.transform(
                    "_lengths",
                    lambda n: F.transform(
                        F.sequence(F.lit(1), F.size("toks") - n + 1),
                        lambda i: F.array_join(F.slice("toks", i, n), " "),
                    ),
                )
            )
        ).alias("gram"),
    )
    words = vocab.select("key", "value", F.col("norm").alias("gram"))
    # Hinted, or the n-grams of all questions are shuffled before Spark sees how small the vocabulary is.
    few = words.limit(MAX_HINTED_VOCABULARY + 1).count() <= MAX_HINTED_VOCABULARY
    matched = grams.join(F.broadcast(words) if few else words, "gram")
    best = matched.groupBy(*ids, "key").agg(
        F.min(F.struct((-F.length("value")).alias("neg_len"), F.col("value"))).getField("value").alias("value")
    )
    scopes = best.groupBy(*ids).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("scope")
    )
    empty = F.create_map().cast("map<string,string>")
    out = questions.select(*ids).join(scopes, ids, "left")
    scope = F.coalesce(F.col("scope"), empty)
    return out.select(*ids, F.to_json(scope).alias("scope_json"), F.size(scope).alias("scope_keys"))
