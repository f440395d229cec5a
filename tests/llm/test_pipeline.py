"""The pipeline from end to end: each stage against what the stage before it left."""

import os

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from headway.llm.packing import piece_lengths
from headway.session import new_folder
from tests.conftest import SMALL
from tests.llm import brute


LARGER = os.path.join(os.path.dirname(SMALL), "sf0.01")


def test_run_equals_its_stages_in_plain(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, LARGER).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        left[name] = [r.asDict() for r in docs.collect()]
    everything = {r["doc_id"] for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    kept = {r["doc_id"]: r["text"] for r in left["quality"]}
    assert set(kept) < everything
    # Near duplicates: the smallest id of each group of what quality left.
    groups = brute.near_duplicates(list(kept.items()))
    assert sorted(r["doc_id"] for r in left["near_dedup"]) == sorted({g for _, g in groups.values()})
    assert all(kept[r["doc_id"]] == r["text"] for r in left["near_dedup"])
    # Secrets: every document stays and has no base span any more.
    assert sorted(r["doc_id"] for r in left["secrets"]) == sorted(r["doc_id"] for r in left["near_dedup"])
    found = sum(len(brute.base_spans(r["text"])) for r in left["near_dedup"])
    assert found > 0
    assert all(r["n_chars"] == len(r["text"]) for r in left["secrets"])
    # The mix: whole documents, three times at most.
    clean = {r["doc_id"]: r["text"] for r in left["secrets"]}
    counts = {}
    for r in left["mixture"]:
        assert clean[r["doc_id"]] == r["text"]
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert max(counts.values()) <= 3 and len(counts) > len(clean) // 4
    # Packing: the tokens of every document of the mix, cut into powers of two.
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in left["mixture"]:
        ids, at = brute.tokens(tokenizer, r["text"], 1), 0
        for length in piece_lengths(len(ids), 2048):
            want.append((r["doc_id"], at, length, len(ids), brute.crc(ids[at : at + length])))
            at += length
    rows = corpus_pipeline.run(spark, LARGER).collect()
    got = [(r["doc_id"], r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]) for r in rows]
    assert sorted(got) == sorted(want)
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))


def test_dissimilar_texts_of_one_id_and_rows_without(spark):
    texts = [" ".join(f"{tag}{i}" for i in range(40)) for tag in "abcd"]
    rows = [(1, texts[0]), (1, texts[0]), (2, texts[0] + " more"), (3, texts[1]), (None, texts[2]),
            (None, texts[2]), (4, ""), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' as lang", "'s' as source", "length(text) as n_chars"
    )
    kept = corpus_pipeline.near_dedup(spark, frame, SMALL)
    found = sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    assert found == sorted([(1, texts[0]), (3, texts[1]), (0, texts[2]), (0, texts[2]), (4, ""), (5, "")])
    assert kept.filter(F.col("doc_id") == 1).count() == 1
