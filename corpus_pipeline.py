"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, decontamination and packing of documents.

Each stage takes (spark, docs, sf_dir), works on all rows of docs (doc_id, text, lang, source, n_chars) and returns
the rows it keeps with the same columns; the last returns packed pieces. run() writes what each stage returns as
Parquet to the shared folder and hands the reread table to the next; what a stage wrote for itself, and the table that it
read, go as soon as its own is written.

  language_id     documents whose language is unknown or rejected go
  line_dedup      repeated lines go from texts, n_chars follows; a document left without a word by that goes
  near_dedup      of each component, the document of the smallest doc_id stays; fingerprints are those of NEAR
  decontaminate   documents in which a window of a benchmark item occurs go
  pack            what is left is packed

A null doc_id is kept by near_dedup, since it names no smaller document. Null texts have no language and go first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import contamination, language, line_dedup, packing, simhash
from weir.llm.common import fold, without
from weir.sources.shared import remove, scope, scratch

#: For texts whose sets of five-word shingles have a similarity of 0.8 or more: a word that is changed touches fewer shingles
#: of two words, and of eight fingerprint words one is likely to come as close as four bits (recall: see the README).
NEAR = {"shingle": 2, "words": 8, "max_bits": 4, "check_bits": 20}
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    return language.keep_known(docs, language.fit(docs, ~fold(3, 1)))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(docs.select(*COLUMNS))
    left = (F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return kept.where(left).withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    of = simhash.near_duplicates(docs.select("doc_id", "text"), **NEAR)
    # a document goes if its component has a smaller doc_id; rows that share the smallest stay, each a row of that document
    return without(docs.select(*COLUMNS), of.where("doc_id > component_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.drop_contaminated(docs.select(*COLUMNS), benchmark)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: The tokenizer, the language model and XXH64 are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        with scope(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if last is not None:
            remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
