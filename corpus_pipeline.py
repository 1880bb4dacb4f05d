"""A training corpus from raw documents: five stages, each on what the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. ``run`` writes every stage as Parquet to the shared folder named in
``spark.checkpoint.dir`` and reads it again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.llm import bpe, decontaminate, minhash, quality, toxicity
from foretell.llm.common import remainder, stored, table, texts_of
from foretell.llm.learning import labelled_sample

#: Labelled rows that a classifier is fitted on, at most.
BOUND = 20_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject.

    Null and empty texts stay, as do rows without id and repeated rows; other columns, under any
    name, come through. Labels that give only one class, or none, reject nothing; an empty table
    stays empty.
    """
    learn = remainder(F.col("doc_id"), 3) != 1
    sample = labelled_sample(texts_of(docs, "doc_id", "text"), table(spark, sf_dir, "labels"), "toxic", learn, BOUND)
    return toxicity.keep_clean(docs, toxicity.fit(sample), threshold=0.7)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    A null text is judged as an empty one; rows without id and repeated rows are judged by their
    text; other columns, under any name, come through. Without labels every score is one half,
    and nothing goes; an empty table stays empty.
    """
    learn = remainder(F.col("doc_id"), 5) != 0
    sample = labelled_sample(texts_of(docs, "doc_id", "text"), table(spark, sf_dir, "labels"), "quality", learn, BOUND)
    return quality.keep_good(docs, quality.fit(sample), threshold=0.3)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def _text_key() -> Column:
    """A key of the row's own for a stage: of its text, so copies share it; there for rows without id too."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Of rows with equal id and text one stays; other columns, under any name, come through; an
    empty table stays empty. Documents without id are grouped among themselves, by a key of
    their text, and one of each group stays; they are not held against documents with id.
    """
    groups = minhash.near_groups(docs, width=5, percent=80)
    kept = groups.where("kept").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    unnamed = docs.where("doc_id is null")
    if unnamed.isEmpty():
        return named
    # one row for each text; a null text is the empty one
    key, text = _free(docs, "key"), _free(docs, "said")
    alone = stored(unnamed.withColumns({key: _text_key(), text: F.coalesce("text", F.lit(""))}).dropDuplicates([text]), "unnamed")
    groups = minhash.near_groups(alone, width=5, percent=80, id_col=key, text_col=text)
    kept = groups.where("kept").select(F.col("doc_id").alias(key)).distinct()
    return named.unionByName(alone.join(kept, key, "left_semi").select(*docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, whether they have an id or not.

    Null and empty texts stay; repeated rows go or stay together; other columns, under any name,
    come through. Without benchmark nothing goes; an empty table stays empty.
    """
    key = _free(docs, "key")
    keyed = docs.withColumn(key, _text_key())
    found = decontaminate.leaks(keyed, table(spark, sf_dir, "benchmark"), id_col=key)
    leaking = found.select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(leaking, key, "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the digests of ids and decoded text, and the ids: a row for each row.

    A null or empty text has no tokens; other columns are not read.
    """
    return bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]
#: Fitted classifiers and a tokenizer decide; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
