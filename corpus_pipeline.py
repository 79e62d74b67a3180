"""The corpus pipeline: STAGES in order, each over all rows that the one before it kept, as Parquet files.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents, with
whatever others docs has, under any name, as they are.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import packing, repeats, setsketch, toxicity
from skyloom.llm.queries import toxicity_model, vocabulary
from skyloom.llm.shared import lasting, seen_by_workers, spread


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with its columns of these names under others that it doesn't have, and what these were called."""
    here, moved = {c.lower() for c in docs.columns}, {}
    for c in [c for c in docs.columns if c.lower() in names]:
        other = f"_{c}"
        while other.lower() in here or other.lower() in names:
            other = f"_{other}"
        here.add(other.lower())
        moved[other] = c
    return docs.withColumnsRenamed({c: other for other, c in moved.items()}), moved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches 0.7 go.

    Null and empty texts have the score of no terms and stay; texts count whole; of repeated rows all go or all stay.
    """
    seen_by_workers(spark)
    plain, moved = _aside(docs, "score")
    kept = toxicity.score(plain, toxicity_model(spark, sf_dir)).where("score < 0.7").drop("score")
    return kept.withColumnsRenamed(moved).select(*(f"`{c}`" for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more over five-word shingles the one with the least doc_id stays.

    Texts without words (null and empty ones too) are linked with nothing and stay, as do rows without a doc_id; rows with
    the same doc_id are one document, and stay or go together.
    """
    seen_by_workers(spark)
    return setsketch.one_of_each(docs, setsketch.Settings(shingle=5, percent=80))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Characters in strings of 100 bytes that also start earlier go; every document stays, and n_chars, if there, follows its text.

    A character of which a byte is left stays. Null texts stay null, shorter ones as they are. Rows with the same doc_id are
    no earlier than each other, and rows without one lose only what they repeat of themselves.
    """
    seen_by_workers(spark)
    plain, moved = _aside(docs, "n_bytes", "spans", "kept", "_tag", "_cover", "_key")
    cut = repeats.without_repeats(plain, length=100, whole_characters=True)
    text = F.when(F.col("text").isNotNull(), F.decode("kept", "utf-8"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("spans") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumns(new).drop("n_bytes", "spans", "kept").withColumnsRenamed(moved).select(*(f"`{c}`" for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in buckets of powers of two, with their ids; null and empty texts are one piece of the end's id, repeated rows pack alike."""
    seen_by_workers(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("repeats", cut_repeats), ("packing", pack)]

#: Tokenising, a fitted model and sketches can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; what a stage returns is written and read again for the next one."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = lasting(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
