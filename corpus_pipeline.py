"""Corpus pipeline: toxicity, language, near-duplicates, personal data,
packing.  Each stage takes and keeps the columns of ``documents``; the last
returns the packed pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import ecoc, minhash, packing, pii, toxicity
from tabforge.llm.common import Scratch, crc_mod
from tabforge.llm.queries import PII_KEY, toxic_rows
from tabforge.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score half or more go; labels of rows that the
    operator's query holds out are not learned from here either."""
    lexicon = toxicity.fit(toxic_rows(docs.select("doc_id", "text"), spark, sf_dir))
    return toxicity.score(docs, lexicon, keep=(*COLUMNS,)).where("predicted = 0").select(*COLUMNS)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts and texts without a letter go.  The classifier rejects
    nothing else: letters in no learned language stay, and a text that is
    merely ambiguous (two languages in it) is a clean one."""
    model = ecoc.fit(docs.where(F.coalesce(crc_mod(F.col("doc_id"), 4) != 2, F.lit(True))))
    return ecoc.predict(docs, model, keep=(*COLUMNS,)).where("lang_pred != 'und'").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at a similarity of 0.8 over five-word shingles
    one row stays: the one with the smallest doc_id (null after all others),
    and of several rows with it one of the text with the smallest hash.
    Rows are told apart by a number of their own, so neither copies of a row,
    nor two texts under one doc_id, nor null ids are taken for one another.
    Texts without a word link with nothing and all stay."""
    scratch = Scratch(spark, "near-duplicates")
    rows = scratch.save(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "rows")
    group = minhash.classes(rows, key="row", k=5, percent=80, scratch=scratch).select("row", "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "row")
    kept = rows.select("row", order.alias("first")).join(group, "row") \
        .groupBy("component_id").agg(F.min("first")["row"].alias("row"))
    gone = rows.select("row").join(kept, "row", "left_anti")
    return rows.join(gone, "row", "left_anti").select(*COLUMNS)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms of the same layout and length."""
    return pii.pseudonymise(docs.select(*COLUMNS), PII_KEY, counts=None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 4096."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", hide_personal_data),
    ("packing", pack),
]

#: Models and tokenizers are in the stages, which SQL cannot express; the
#: tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each is written and reread."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
