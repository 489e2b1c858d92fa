"""A corpus pipeline: each stage filters or changes the documents by one text operator, and
reads the rows that the one before it wrote as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from abono.llm import decontaminate, jaccard, pieces, quality, secrets
from abono.llm.queries import MODEL
from abono.llm.store import stored


def set_apart(docs: DataFrame) -> DataFrame:
    """docs with columns but doc_id and text under names that no operator's results bear."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"__c{i}" for i, c in enumerate(docs.columns)])


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is a half or more, by a classifier of all labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = set_apart(docs)
    scored = quality.quality(rows, labels, allowed=F.lit(True), keep=rows.columns)
    return scored.where("score >= 0.5").select(*rows.columns).toDF(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies (five words, similarity 0.8) one row: of the least id, null
    ids last, then of the least node, then of the least text hash. Documents without words are no
    copies of each other, but of rows alike in id and text one stays."""
    params = jaccard.Params(words=5, least=jaccard.Fraction(8, 10))
    classes = jaccard.jaccard_classes(docs, params=params).where("n_shingles > 0").select("root", "doc_id", "node").distinct()
    classes = stored(classes, "classes")
    first = classes.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("first"))
    first = first.select("root", F.col("first.node").alias("kept_node"), F.col("first.doc_id").alias("kept_id"))
    one_of = classes.join(first, "root")
    own = (F.col("node") == F.col("kept_node")) & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    later = one_of.where(~own).select(F.struct("doc_id", F.lit(False).alias("bare"), F.col("node").alias("name")).alias("__key"))

    rows = set_apart(docs)
    same = F.xxhash64("text")
    bare = F.col("n_shingles") == 0
    name = F.when(bare, same).otherwise(F.col("node"))
    noded = jaccard.nodes_of(rows, rows.columns, params=params)
    keyed = noded.select(*rows.columns, F.struct("doc_id", bare.alias("bare"), name.alias("name")).alias("__key"))
    # rows of one key are ranked, which each task does for its own first
    ranked = keyed.withColumn("__rank", F.row_number().over(Window.partitionBy("__key").orderBy(same)))
    kept = ranked.where("__rank = 1").join(later, "__key", "left_anti")
    return kept.select(*rows.columns).toDF(*docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = set_apart(docs)
    found = decontaminate.find_leaks(rows, benchmark, keep=rows.columns)
    return found.where("size(hit_words) = 0").select(*rows.columns).toDF(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark; n_chars follows the text."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of every text, beside the documents' other columns; those with the
    name of a result give way to it."""
    results = ("text", "n_tokens", "ids", "round_trip")
    return pieces.encode(docs, model=MODEL, keep=[c for c in docs.columns if c not in results])


STAGES = [
    ("quality", good_documents),
    ("near copies", one_of_near_copies),
    ("benchmark leaks", without_leaks),
    ("secrets", without_secrets),
    ("pieces", encoded),
]

#: SQL can't train the classifier and the random field; tests compare the other stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
