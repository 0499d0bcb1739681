"""Documents to training tokens: language, exact copies, near copies, mix, token ids. Each stage reads what the one before wrote.

All stages take empty tables, null and empty texts, texts of any length, null and repeated ids and repeated rows. All but the last
return the columns they got, under any names, unchanged; the last returns ids and digests, and doesn't look at other columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import bpe, exact_dedup, langid, mixing, ngram_join
from orderloom.llm.scratch import settle, stored
from orderloom.session import tune


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Profiles are learned from the documents that name their language; documents without a letter go, all others stay.

    Null and empty texts have no letter. Repeated rows stay as often as they came. Columns bear numbers while
    predictions stand beside them, so the table's own ``lang_pred`` or ``score`` keep their values. Where no document
    names its language, none can be predicted; then letters alone decide.
    """
    settle(tune(spark))
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*place.values())
    profiles = langid.learn(plain, place["text"], place["lang"])
    if not profiles.languages:
        return docs.where(F.coalesce("text", F.lit("")).rlike(r"\p{L}"))
    found = langid.predict(plain, profiles, place["text"])
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select([F.col(p).alias(c) for c, p in place.items()])


def one_of_equal_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays; of rows with one id and text, always the same one.

    A null text equals the empty one, a null id is below all others.
    """
    settle(tune(spark))
    return exact_dedup.drop_copies(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by a Jaccard similarity of 0.8 on five-word shingles, the smallest id stays."""
    settle(tune(spark))
    return ngram_join.drop_similar(docs, width=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is taken as often as its target asks, a document at most three times."""
    settle(tune(spark))
    return mixing.mixed_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text that they decode to."""
    settle(tune(spark))
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("language", known_language),
    ("exact_dedup", one_of_equal_texts),
    ("near_dedup", one_of_near_copies),
    ("mix", mixed),
    ("tokens", token_ids),
]

#: Language profiles, tokens and components of a similarity graph have no SQL here; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each one returns is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
