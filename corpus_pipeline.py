"""From documents to packed sequences: quality, lines, near-duplicates, benchmark, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept and returns a DataFrame, which ``run``
writes as Parquet and reads again. All but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm import op1_decontamination, op2_lines, op3_packing, op4_quality, op10_jaccard
from palaver.llm.tables import read
from palaver.workspace import new_path, remove, run_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject."""
    return op4_quality.accepted(docs, op4_quality.fit(docs, read(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that came before; one of which no line is left goes."""
    found = op2_lines.without_repeated_lines(docs)
    emptied = (F.col("n_kept") < F.col("n_lines")) & (F.trim(F.translate("text", "\n", " ")) == "")
    kept = found.where(~emptied)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id."""
    return op10_jaccard.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return op1_decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents that are left, with its place in a sequence."""
    return op3_packing.pack(op3_packing.pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", packing),
]

#: A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of a folder.

    A stage's working tables go when its result is written, and its result when the next stage's is.
    """
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, name.replace(" ", "-"))
        with run_folder(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.schema(made.schema).parquet(path), path
    return docs
