"""The corpus pipeline: from raw documents to token ids, a written table between any two stages.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all that the one before it kept. All but the last return the columns of
documents. Null ids and texts, repeated rows and empty tables pass through by the rules of the operators the stages call.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from faremill.llm import bpe, decontaminate, langid, linededup, minhash
from faremill.llm.common import Written, free_names, table
from faremill.llm.queries import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language. The model is learned from the stage's own labelled rows; documents for which it finds none, those
    without a letter, go. A mixture stays, however many languages share it."""
    found, share = free_names(docs, "language", "share")
    scored = langid.predict(docs, langid.learn(docs), into=(found, share))
    return scored.where(scored[found] != langid.UNDETERMINED).drop(found, share)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that match an earlier one; documents that lose every line go, n_chars is counted anew."""
    return linededup.remove_lines(docs, num=80, den=100, short=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links by five-word shingles at a similarity of 0.8: the one with the smallest id."""
    return minhash.keep_one(docs, size=5, num=80, den=100)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text overlaps no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source with the text's ids and the number of them; what the ids decode to must be the text."""
    ranks = bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    decoded = bpe.encode_column(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN, decoded="decoded")
    return decoded.selectExpr("doc_id", "lang", "source", "cast(size(ids) as bigint) as n_tokens", "ids", "coalesce(cast(decoded as string) = coalesce(text, ''), false) as round_trip")


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("tokens", tokens)]

# Language shares, near-duplicate components and BPE merges are not expressible in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's result is written to the shared folder and read again."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        written = Written(stage(spark, docs, sf_dir), f"stage-{name}")
        if last:
            last.drop()
        docs, last = written.df, written
    return STAGES[-1][1](spark, docs, sf_dir)
