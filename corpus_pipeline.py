"""The corpus pipeline: language, near-duplicates, repeated strings, benchmark passages, mix.

Every stage takes the documents its predecessor kept (written as Parquet and read again by
``run``) and returns documents with the same columns, whatever their names; the last returns the
mix. Stage by stage:

- language_id drops documents without letters, or whose main language labels under half of
  the letters;
- near_dedup keeps the smallest row of each group of near copies (similarity 0.8 or more);
- suffix_dedup takes out byte strings of 400 and more, and passages of over 50 words, that
  repeat, and sets n_chars anew;
- decontaminate drops documents that hold a benchmark window;
- mix gives each document its source's target and the words the mix takes of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinark.llm import contamination, language, mixing, near_dup, suffix_dedup
from clinark.llm.common import read_table, stored

MIN_LANGUAGE_SHARE = 0.5
NEAR_PERCENT = 80
PASSAGE_WORDS = 51
ORACLE_SQL = None


def _rows(docs: DataFrame, **own) -> DataFrame:
    """The documents as one struct ``row`` beside columns of a stage's own, so that no names meet."""
    return docs.select(F.struct(*docs.columns).alias("row"), *(c.alias(name) for name, c in own.items()))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of a language that labels at least half of their letters; NULL, empty and letterless texts go."""
    return language.keep_rows(docs, language.learn(docs.where(~language.held_out())), MIN_LANGUAGE_SHARE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest row, by doc_id and text, of each group of near copies. Rows that repeat a doc_id with other
    texts are documents of their own; of rows with equal doc_id and text one stays (the smallest by a hash of
    all columns); rows without an id and wordless ones are no copies."""
    found = near_dup.near_duplicates(docs, NEAR_PERCENT, by_id=False)
    dropped = found.where("not kept_row").select(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).distinct()
    again = (found.where("doc_id is not null").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select(F.col("doc_id").alias("d"), F.col("text_key").alias("k")))
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind]
    rows = _rows(docs, doc=F.col("doc_id"), key=near_dup.text_key(), place=F.xxhash64(*hashed))
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k"))
    rows = rows.join(dropped, same, "left_anti")
    one = F.row_number().over(Window.partitionBy("doc", "key").orderBy("place"))
    once = rows.join(again, same, "left_semi").withColumn("nth", one).where("nth = 1").drop("nth")
    return rows.join(again, same, "left_anti").unionByName(once).select("row.*")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its text without strings of 400 bytes and passages of 51 words that repeat; n_chars, if there,
    is the new text's length."""
    cut = suffix_dedup.cut_text(docs, PASSAGE_WORDS)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no window of a benchmark item."""
    key = F.xxhash64("doc_id", "text")
    found = contamination.contamination(docs.select(key.alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("hit")).distinct()
    return _rows(docs, key=key).join(hit, F.col("key") == F.col("hit"), "left_anti").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target and taken, the words that the mix takes of it."""
    return mixing.mixture(docs).drop("draws")


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("suffix_array_dedup", suffix_array_dedup),
          ("decontaminate", decontaminate), ("mix", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
