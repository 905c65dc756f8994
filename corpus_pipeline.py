"""Clean a corpus: quality rules, near duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import common, decontaminate, ngram_join, packing, quality, secrets
from chatloom.llm.queries import vocabulary
from chatloom.session import materialize

ENCODER_CACHE = 250_000  # chunks: workers that other stages use, too, keep fewer of them


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go."""
    rules = quality.train(docs, common.table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", "text")
    return quality.kept_rows(quality.judge(rows, rules))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of the smallest id."""
    return ngram_join.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    found = decontaminate.contamination(docs, common.table(spark, sf_dir, "benchmark"))
    bad = materialize(found.where("contaminated").select(F.col("doc_id").alias("_id"), "_digest").distinct())
    rows = docs.select(
        F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), decontaminate.text_digest().alias("_text")
    )
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_digest"))
    return rows.join(decontaminate.small(bad), same, "left_anti").select("_row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; ``n_chars`` follows."""
    found = secrets.scan(docs.select(F.struct("*").alias("_row"), "text"))
    clean = F.when(F.size("all") > 0, secrets.redact(F.col("text"), F.col("all"))).otherwise(F.col("text"))
    rows = found.select("_row", clean.alias("_clean"))
    changed = {"text": F.col("_clean"), "n_chars": F.char_length("_clean").cast("long")}
    return rows.select(*[changed.get(c, F.col(f"_row.{c}")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences."""
    return packing.best_fit_packing(docs, vocabulary("byte_bpe_50k.json"), cache=ENCODER_CACHE)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", drop_copies),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
