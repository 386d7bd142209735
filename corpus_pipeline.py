"""A corpus pipeline: quality, language, near duplicates, mix, token ids.

Every stage reads what the one before it wrote. All stages but the last return the
columns of the documents they were given; the last returns the ids of every text.

Defined cases, in all stages: an empty table gives an empty result; columns besides id,
text, lang and source are carried along whatever their names, but may not be maps; NULL
ids, languages and sources are values like others; texts are read whole. A NULL or empty
text fails the base rules and goes in the first stage; given to a later one it goes for
want of a language, is a group of its own among near duplicates, is never taken by a mix,
and has no pieces. Rows alike in all columns are one document of a group, and as many in
the other stages; rows that differ in any column are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import jaccard, language, mixing, quality, sentencepieces
from tallybrook.llm.queries import ready
from tallybrook.session import work_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or tokeniser fertility reject go."""
    ready(spark)
    return quality.keep_good(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go."""
    ready(spark)
    return language.keep_identified(docs, language.learn(docs, ~language.held_out()))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the smallest id stays, NULL last.

    Rows are told apart by a hash of all their columns. Two different rows that share one
    would both stay where one of them does; neither is lost.
    """
    ready(spark)
    keyed = docs.withColumn("_row", F.xxhash64(*docs.columns))
    found = jaccard.jaccard_components(keyed.select("_row", "text"), id_column="_row", width=5, percent=80)
    groups = found.select("_row", "component_id").distinct()
    owners = keyed.select(F.col("_row").alias("_of"), "doc_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))
    stays = (
        groups.join(owners, F.col("_row") == F.col("_of"))
        .groupBy(F.col("component_id").alias("_group"))
        .agg(first["_row"].alias("_stays"))
    )
    left = stays.select(F.col("_stays").alias("_of"))
    gone = groups.join(stays, F.col("component_id") == F.col("_group")).where("_row <> _stays").select("_row").distinct()
    gone = gone.join(left, F.col("_row") == F.col("_of"), "left_anti").select(F.col("_row").alias("_of"))
    kept = keyed.join(gone, F.col("_row") == F.col("_of"), "left_anti")
    # Only rows that may be there several times are put together by all their columns.
    again = keyed.groupBy(F.col("_row").alias("_of")).count().where("count > 1").select("_of")
    once = kept.join(again, F.col("_row") == F.col("_of"), "left_anti").select(*docs.columns)
    return once.unionByName(kept.join(again, F.col("_row") == F.col("_of"), "left_semi").select(*docs.columns).distinct())


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Rows are told apart by a digest of all
    their columns; those that are alike are taken together."""
    ready(spark)
    digest = F.unhex(F.sha2(F.to_json(F.struct(*docs.columns)), 256))
    keyed = docs.withColumn("_row", digest)
    mix = mixing.mix_sources(keyed, id_column="_row")
    copies = mix.groupBy(F.col("_row").alias("_of")).agg(F.sum("copies").cast("int").alias("_copies")).where("_copies > 0")
    taken = keyed.dropDuplicates(["_row"]).join(copies, F.col("_row") == F.col("_of"))
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*docs.columns)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text under merge-dropout, and whether they decode to it. The
    copies of a document are numbered, so that each is segmented its own way.

    The ids are written before they are decoded: a task that did both would hold two Python
    workers, with a vocabulary each, and an executor keeps those for the stages after it.
    """
    ready(spark)
    texts = docs.groupBy("doc_id", "lang", "source", "text").agg(F.count("*").cast("int").alias("_copies"))
    texts = texts.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).drop("_copies")
    folder = work_folder(spark, "pieces")
    sentencepieces.encode_texts(texts, rate=0.1, seed=17, copy_column="_copy").write.parquet(folder)
    decoded = sentencepieces.decode_ids(spark.read.parquet(folder))
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_pieces"),
        F.col("text").eqNullSafe(F.col("decoded")).alias("lossless"),
        "ids",
    )


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near duplicates", near_duplicate_stage),
    ("mix", mixing_stage),
    ("pieces", pieces_stage),
]

# No stage but the base rules can be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    folder = work_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
