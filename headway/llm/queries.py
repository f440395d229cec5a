"""The registered queries of this package: one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.backoff import score_texts
from headway.llm.grouping import stored
from headway.llm.html_text import extract_text
from headway.llm.importance import resample
from headway.llm.merkle import dataset_proofs, row_digest, with_folded
from headway.llm.minhash_dedup import near_duplicates
from headway.llm.mixture import mix_sources
from headway.llm.order_minhash import fingerprint_documents, fingerprint_text, likeness
from headway.llm.packing import number_sequences, pack_documents
from headway.llm.quality import fit_quality, score_quality
from headway.llm.secret_scan import find_secrets
from headway.llm.token_shards import read_documents, write_token_shards
from headway.llm.topk import top_k
from headway.llm.url_templates import judge_urls
from headway.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Rules of the URL filter: verdict, host and path.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def registered(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        return query

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered("op1_near_duplicates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def held_out(doc_id) -> F.Column:
    """Whether a document's label is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


@registered("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    table, network = fit_quality(documents, labels)
    return score_quality(documents, table, network).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@registered("op3_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_text(_table(spark, sf_dir, "pages"))
    return texts.select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


@registered("op4_token_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    folder = new_folder(spark, "tokens")
    write_token_shards(
        documents, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, width=2
    )
    rows = documents.groupBy(F.col("doc_id").alias("key")).count()
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1))
    found = read_documents(spark, folder, rows.select("key", copies.alias("copy")))
    return found.select(
        F.col("key").alias("doc_id"),
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@registered("op5_order_minhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint_documents(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text(F.col("fingerprint")).alias("fingerprint"),
        fingerprint_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


@registered("op6_url_templates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, RULES).select(
        "page_id",
        F.col("url_host").alias("host"),
        F.col("url_path").alias("path"),
        F.col("url_rule").alias("rule"),
        F.col("url_verdict").alias("verdict"),
        F.col("url_template").alias("template"),
    )


@registered("op7_mixture")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


def packed(
    documents: DataFrame, most_fragments: int = 250_000, forget: bool = False
) -> DataFrame:
    """Pieces of the documents with their sequences, ids as a check sum."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = pack_documents(
        documents,
        tokenizer,
        end_id=1,
        most_fragments=most_fragments,
        sums_only=True,
        forget=forget,
    )
    return number_sequences(stored(pieces, "pieces")).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.lit(0).cast("long").alias("offset"),
    )


@registered("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


@registered("op9_top_k")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


@registered("op10_secrets")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents"))
    spans = F.col("secrets")

    def joined(some) -> F.Column:
        written = F.transform(
            some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        )
        return F.array_join(written, ",")

    def number(kind: str) -> F.Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    base = F.filter(spans, lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


@registered("op11_backoff")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    apart = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    return score_texts(documents, ~apart).select(
        "doc_id",
        (~F.col("trained")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@registered("op12_importance")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@registered("op13_manifest")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    documents = _table(spark, sf_dir, "documents").select(*fields)
    changed = row_digest(*(F.col(f) + 1 if f == "n_chars" else F.col(f) for f in fields))
    # Rows that a tampering of n_chars would meet; a null stays null.
    met = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    documents = documents.withColumn("tampered", F.when(met, changed))
    proofs, root = dataset_proofs(documents, "doc_id", "lang", fields, ["doc_id", "tampered"])
    proofs = proofs.withColumn("seen", F.coalesce("tampered", "digest"))
    found = with_folded(proofs, "seen", "folded", ["doc_id", "digest", "top", "siblings"])

    def text(name: str) -> F.Column:
        return F.lower(F.hex(name))

    whole = F.lit(root)
    return found.select(
        "doc_id",
        text("digest").alias("leaf"),
        text("top").alias("subroot"),
        F.lower(F.hex(whole)).alias("root"),
        F.sha2(text("siblings"), 256).alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == whole).alias("verified"),
    )
