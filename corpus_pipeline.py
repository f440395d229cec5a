"""From raw documents to packed sequences: five stages, each a table for the next.

Documents below the quality threshold go, one document of each group of near duplicates
stays, secrets are cut out of the texts, sources are mixed to their target weights, and
the mix is packed. A stage reads what the stage before it wrote and nothing else of it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.grouping import stored
from headway.llm.minhash_dedup import near_duplicates
from headway.llm.mixture import mix_sources, repeated
from headway.llm.quality import fit_quality, score_quality
from headway.llm.queries import held_out, packed
from headway.llm.secret_scan import find_secrets
from headway.session import new_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
THRESHOLD = 0.3
# The workers that pack run other stages before and after, so the encoder gets less memory
# and gives it back.
FRAGMENTS = 120_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that score at least the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(F.col("doc_id")))
    table, network = fit_quality(docs.select("doc_id", "text"), labels)
    scored = score_quality(docs, table, network, keep=COLUMNS)
    return scored.filter(F.col("score") >= THRESHOLD).drop("score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates.

    The ids that go, or that rows repeat, are the short list; all other documents stay where
    they are unless that list is too long to broadcast. Of rows that repeat a kept id one
    stays; only such rows are brought together for that. Rows without an id all stay.
    """
    docs = docs.select(*COLUMNS)
    labels = near_duplicates(docs).filter("doc_id is not null").groupBy("doc_id")
    marks = labels.agg(F.count("*").alias("rows"), F.min("kept").alias("kept"))
    marks = stored(marks.filter("not kept or rows > 1"), "marks")
    single = docs.join(marks.select("doc_id"), "doc_id", "left_anti")
    several = docs.join(marks.filter("kept").select("doc_id"), "doc_id", "left_semi")
    order = Window.partitionBy("doc_id").orderBy("text", "lang", "source", "n_chars")
    one = several.withColumn("place", F.row_number().over(order)).filter("place = 1")
    return single.select(*COLUMNS).union(one.select(*COLUMNS))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; the documents stay."""
    found = find_secrets(docs, keep=("doc_id", "lang", "source"))
    return found.select(
        "doc_id",
        F.col("redacted").alias("text"),
        "lang",
        "source",
        F.char_length("redacted").cast("long").alias("n_chars"),
    )


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emit documents as often as their source's target asks for."""
    return repeated(mix_sources(docs.select(*COLUMNS)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut documents into sequences whose lengths are powers of two."""
    return packed(docs, most_fragments=FRAGMENTS, forget=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Rows go to the workers a few megabytes at a time, so that long texts, which a batch could
# hold ten thousand of, do not fill an executor.
BATCH_BYTES = 4 << 20


def _bounded(stage: Stage) -> Stage:
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [
    ("quality", _bounded(quality)),
    ("near_dedup", _bounded(near_dedup)),
    ("secrets", _bounded(secrets)),
    ("mixture", _bounded(mixture)),
    ("packing", _bounded(packing)),
]

# The quality score, signatures and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
