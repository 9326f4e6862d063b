"""A training corpus from raw documents: quality, near-duplicates, repeated passages, benchmark passages, piece ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelbook.llm import decontaminate, quality, repeats, sentence_pieces, simhash
from funnelbook.llm.common import table, written

#: Columns of documents that every stage but the last returns. Further columns of the input are left out.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. Every row is judged by itself, whatever its id."""
    judged = quality.judge(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), keep=COLUMNS[1:])
    return judged.where("NOT coalesce(rejected, false)").select(*COLUMNS)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints: that with the smallest id (null last), of several that with the smallest row number.

    Fingerprints are of four-word shingles and link at four or fewer differing bits, as in op9. Rows are told apart by a number
    of their own, so repeated rows and null ids are judged each by itself.
    """
    rows = written(docs.select(*COLUMNS).withColumn("__row", F.monotonically_increasing_id()))
    linked = simhash.near_duplicates(rows.select("__row", "text"), distance=4, shingle=4, id_col="__row")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    firsts = linked.join(rows.select("__row", "doc_id"), "__row").groupBy("component_id").agg(F.min(place).getField("__row").alias("__row"))
    return rows.join(firsts, "__row", "left_semi").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that an earlier passage of 100 bytes covers; ``n_chars`` follows. Every document stays."""
    docs = docs.select(*COLUMNS)
    return repeats.remove(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.keep_clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, the piece ids of the text, their number, and whether decoding gives the text back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentence_pieces.encode(docs.select(*COLUMNS), model, check="round_trip")
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").alias("n_tokens"), "round_trip")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_first),
    ("repeated_passages", cut_repeats),
    ("decontamination", keep_uncontaminated),
    ("pieces", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
