"""The registered queries of the operators, each over its whole table."""

import os
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headingflow.llm.alignment import align
from headingflow.llm.co_training import THRESHOLD as QUALITY_THRESHOLD
from headingflow.llm.co_training import fit_quality, score_quality
from headingflow.llm.decontamination import find_passages
from headingflow.llm.mixing import SEED, mix, word_tokens
from headingflow.llm.near_duplicates import near_duplicates
from headingflow.llm.oracle import REPEATS_SQL, SEARCH_SQL, mixing_sql
from headingflow.llm.pieces import KNOWN_PIECES
from headingflow.llm.ranked_search import build_index, search
from headingflow.llm.repeats import remove_repeats
from headingflow.llm.sharding import assign_shards
from headingflow.llm.storage import new_path
from headingflow.llm.token_counts import count_tokens
from headingflow.llm.token_files import file_starts, read_ids, write_ids
from headingflow.llm.toxicity import THRESHOLD, learn_lexicon, score_toxicity
from headingflow.llm.warc import read_warc, write_warc
from headingflow.llm.weak_rules import judge_quality


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Where the driver found this package, workers on its machine look too. On
    # a cluster the package is shipped with --py-files.
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in (paths := [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]):
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Target weights of the tree's nodes among their siblings; all others weigh 1.
MIX_WEIGHTS = [
    ("domain", "forum", 5), ("domain", "news", 3), ("domain", "wiki", 2),
    ("lang", "en", 6), ("lang", "de", 2), ("lang", "es", 2),
]
#: The tables have no domain: one of three by the number in the source's name.
DOMAIN = "{} % 3 = 0 THEN 'forum' WHEN {} % 3 = 1 THEN 'news' ELSE 'wiki' END"


def domain_sql(cast: str) -> str:
    number = f"coalesce({cast}(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT), 0)"
    return f"CASE WHEN {DOMAIN.format(number, number)}"


def mixed(docs: DataFrame, out: str = "copies") -> DataFrame:
    """The documents with the number of copies in the mix."""
    weights = docs.sparkSession.createDataFrame(MIX_WEIGHTS, "level string, name string, weight int")
    levels = {"domain": F.expr(domain_sql("try_cast")), "lang": F.col("lang"), "source": F.col("source")}
    return mix(docs, weights, levels, word_tokens(F.col("text")), out=out)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    q = F.col("quality")
    return scored.select(
        "doc_id",
        q["by_text"].alias("by_text"),
        q["by_page"].alias("by_page"),
        q["probability"].alias("score"),
        (q["probability"] >= QUALITY_THRESHOLD).alias("kept"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    labels = table(spark, sf_dir, "labels").filter(fold != 2)
    lexicon = learn_lexicon(docs, labels)
    return score_toxicity(docs, lexicon).select(
        "doc_id",
        F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixed(table(spark, sf_dir, "documents"))
    return chosen.select(
        "doc_id",
        F.expr(domain_sql("try_cast")).alias("domain"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")],
        word_tokens(F.col("text")).alias("n_tokens"),
        "copies",
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame, known: int = KNOWN_PIECES) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from files written for the documents."""
    spark = docs.sparkSession
    path = new_path(spark, "token-files")
    write_ids(docs, path, public_tokenizers.path("word_bpe_49k.json"), known=known)
    found = read_ids(spark, path).select(
        F.col("_id").alias("doc_id"), "_file", "before", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
    starts = file_starts(spark, path)
    return found.join(starts, "_file").select(
        "doc_id", (F.col("ids_before") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archives")
    write_warc(table(spark, sf_dir, "pages"), path)
    found = read_warc(spark, path)
    return found.select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op11_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    return cleaned.withColumnRenamed("kept", "kept_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align(docs, a, b, digest=True).docs.withColumnRenamed("groups", "groups_sha256")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents"))
    found = search(index, table(spark, sf_dir, "benchmark"))
    index.drop()
    return found


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_token_counts": op5_token_counts,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_decontamination": op7_decontamination,
    "op8_shards": op8_shards,
    "op9_token_files": op9_token_files,
    "op10_warc": op10_warc,
    "op11_repeated_passages": op11_repeated_passages,
    "op12_token_alignment": op12_token_alignment,
    "op13_ranked_search": op13_ranked_search,
}
ORACLE: dict[str, str] = {
    "op4_mixing": mixing_sql("SELECT * FROM documents", MIX_WEIGHTS, domain_sql("TRY_CAST"), SEED),
    "op11_repeated_passages": REPEATS_SQL,
    "op13_ranked_search": SEARCH_SQL,
}
