"""Every operator against a plain version, on whole small tables and on odd rows."""

import hashlib
import os
import re

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from headway.llm.encoding import FragmentEncoder
from headway.llm.grouping import group_links
from headway.llm.html_text import common_lines, difference, extract_text, page_lines
from headway.llm.minhash_dedup import near_duplicates, parity_map, superminhash
from headway.llm.order_minhash import fingerprint_documents, likeness
from headway.llm.packing import piece_lengths
from headway.llm.queries import QUERIES
from headway.llm.quality import fit_network
from headway.llm.secret_scan import base_spans, redact, scan_text
from headway.llm.token_shards import build_hash, key_hashes, slots_of, write_token_shards
from headway.llm.topk import top_k
from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.conftest import odd_documents

def _rows(spark, name, folder):
    return [r.asDict() for r in QUERIES[name](spark, folder).collect()]


def _documents(folder):
    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    return [(r["doc_id"], r["text"]) for r in table.to_pylist()]


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, empty, name):
    assert _rows(spark, name, empty) == []


def test_empty_pipeline(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


@pytest.mark.parametrize("which", ["small", "odd"])
def test_near_duplicates(spark, odd, which):
    folder = SMALL if which == "small" else odd
    documents = _documents(folder)
    want = brute.near_duplicates(documents)
    got = _rows(spark, "op1_near_duplicates", folder)
    assert len(got) == len(documents)
    for row in got:
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["kept"]
        else:
            assert (row["n_shingles"], row["component_id"]) == want[row["doc_id"]]
            assert row["kept"] == (row["component_id"] == row["doc_id"])


def test_near_duplicates_of_an_id_with_two_texts(spark):
    # In every bucket that 100 and 101 share, a smaller id comes first that is like neither;
    # what they share beyond it only 101 has, whose rows have two texts.
    def words(tag, n):
        return [f"{tag}85x{i}" for i in range(n)]

    core = words("core", 84)
    rows = [(i, " ".join(core + words(f"c{i}y", 26))) for i in range(40)]
    rows += [(i, " ".join(core + words("rest", 7) + words(t, 10))) for i, t in ((100, "a"), (101, "b"))]
    rows.append((101, " ".join(words("other", 60))))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {i: i for i in range(40)} | {100: 100, 101: 100}
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_quality(spark, odd):
    rows = _rows(spark, "op2_quality", odd)
    assert len(rows) == len(odd_documents())
    assert all(0.0 <= r["score"] <= 1.0 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_quality_on_labels_held_out(spark):
    folder = os.path.join(os.path.dirname(SMALL), "sf0.01")
    labels = {
        r["doc_id"]: r["quality"] for r in pq.read_table(f"{folder}/labels.parquet").to_pylist()
    }
    rows = [r for r in _rows(spark, "op2_quality", folder) if r["held_out"] and r["doc_id"] in labels]
    right = [r["predicted"] == labels[r["doc_id"]] for r in rows]
    assert len(right) > 40 and np.mean(right) >= 0.9


def test_main_text(spark, odd):
    pages = {r["page_id"]: r for r in pq.read_table(f"{SMALL}/pages.parquet").to_pylist()}
    for row in _rows(spark, "op3_main_text", SMALL):
        assert row["text"] == brute.article_text(pages[row["page_id"]]["html"])
        assert row["n_chars"] == len(row["text"])
    texts = sorted(r["text"] for r in _rows(spark, "op3_main_text", odd))
    assert texts == ["", "", "Hi & you", "Hi & you", "cut of"]


@pytest.mark.parametrize("which", ["small", "odd"])
def test_token_shards(spark, odd, which):
    folder = SMALL if which == "small" else odd
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counted = [(i, brute.tokens(tokenizer, t, 2)) for i, t in _documents(folder)]
    counted.sort(key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes()))
    want, start = [], 0
    for i, ids in counted:
        want.append((i, start, len(ids), brute.crc(ids)))
        start += len(ids)
    got = [
        (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"])
        for r in _rows(spark, "op4_token_shards", folder)
    ]
    assert sorted(got, key=lambda r: r[1]) == want


def test_ids_that_do_not_fit_are_refused(spark, folder):
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    for end_id, width in ((70_000, 2), (2, 3), (2, 1)):
        with pytest.raises(ValueError, match="do not fit"):
            write_token_shards(frame, folder, path, end_id=end_id, width=width)
    write_token_shards(frame, folder, path, end_id=65_535, width=2)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 70000])
def test_minimal_perfect_hash(n):
    hashes = key_hashes(np.arange(n) * 7 - 5, np.zeros(n, bool), np.zeros(n, np.int64))
    levels, rest = build_hash(hashes)
    assert sorted(slots_of(hashes, levels, rest)) == list(range(n))


def test_order_minhash(spark, odd):
    documents = _documents(SMALL)
    want, texts = brute.edited(documents), dict(documents)
    order = sorted(texts, reverse=True)
    off = []
    for row in _rows(spark, "op5_order_minhash", SMALL):
        i = row["doc_id"]
        assert row["n_chars"] == len(texts[i])
        assert row["edited_sha256"] == hashlib.sha256(want[i].encode()).hexdigest()
        own = brute.order_minhash(texts[i])
        following = texts[order[(order.index(i) + 1) % len(order)]]
        off.append((row["near_edited"] - brute.likeness(own, brute.order_minhash(want[i])),
                    row["near_next"] - brute.likeness(own, brute.order_minhash(following))))
    assert np.abs(np.mean(off, axis=0)).max() < 0.03
    rows = _rows(spark, "op5_order_minhash", odd)
    assert len(rows) == len(odd_documents())
    assert rows[0]["fingerprint"] or rows[0]["n_chars"] == 0
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (0, 1, 15)}) == 1


def test_order_minhash_of_texts_without_spaces(spark):
    rng = np.random.default_rng(7)
    han = ["".join(chr(0x4E00 + c) for c in rng.integers(0, 3000, 2000)) for _ in range(3)]
    lines = ["\n".join(f"w{c}" for c in rng.integers(0, 5000, 2000)) for _ in range(3)]
    code = ["".join(chr(c) for c in rng.integers(97, 123, 30_000)) for _ in range(3)]
    texts = [*han, *lines, *code, "", None, "\n \t"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = fingerprint_documents(frame, 3).select(
        "doc_id", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("next"), "fingerprint",
    ).collect()
    for r in rows:
        if r["doc_id"] < 9:
            assert 0 < r["edited"] < 0.3 and r["next"] < 0.05
    assert len({tuple(r["fingerprint"]) for r in rows if r["doc_id"] >= 9}) == 1
    # A third of all k-mers is shared at most, so a ninth of the pairs.
    assert 0.05 < np.mean([r["edited"] for r in rows if r["doc_id"] < 9]) < 0.16


def test_url_templates(spark, odd):
    by_id = {r["page_id"]: r for r in _rows(spark, "op6_url_templates", odd)}
    assert (by_id[1]["host"], by_id[1]["path"]) == ("a.example.org", "/en/1")
    assert (by_id[1]["rule"], by_id[1]["verdict"]) == ("example.org/en/1", "block")
    assert (by_id[2]["host"], by_id[2]["path"], by_id[2]["rule"]) == ("", "", None)
    assert (by_id[None]["host"], by_id[None]["path"], by_id[None]["rule"]) == ("example.com", "", None)
    assert {r["verdict"] for r in by_id.values()} <= {"allow", "block"}


def test_mixture(spark, odd):
    rows = _rows(spark, "op7_mixture", odd)
    assert len(rows) == len(odd_documents())
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in _documents(odd)}
    for r in rows:
        assert r["doc_id"] is None or r["size"] == sizes[r["doc_id"]]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"]
    assert rows == _rows(spark, "op7_mixture", odd)


@pytest.mark.parametrize("which", ["small", "odd"])
def test_packing(spark, odd, which):
    folder = SMALL if which == "small" else odd
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, text in _documents(folder):
        ids, at = brute.tokens(tokenizer, text, 1), 0
        for length in piece_lengths(len(ids), 2048):
            want.append((str(i), at, length, len(ids), brute.crc(ids[at : at + length])))
            at += length
        assert at == len(ids)
    rows = _rows(spark, "op8_packing", folder)
    names = ("start", "length", "doc_tokens", "ids_crc32")
    assert sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in rows) == sorted(want)
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))


def test_top_k(spark, odd):
    vectors = {i: [int(np.floor(64 * x)) for x in (float(i % 7), -1.5)] for i in range(60)}
    vectors[160] = [64 * int(float(np.float32(1e30))), 32]
    rows = _rows(spark, "op9_top_k", odd)
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    queries = {i: vectors[i] for i in (0, 40, 160)}
    # The repeated row 20 is a candidate twice, and the vector of three numbers none.
    everything = [*vectors.items()] + [(20, vectors[20])]
    for q, v in queries.items():
        scores = [(i, sum(a * b for a, b in zip(v, w, strict=True))) for i, w in everything if i != q]
        best = sorted(scores, key=lambda s: (-s[1], s[0]))[:20]
        most = (1 << 63) - 1
        assert got[q] == [(i, max(-most - 1, min(most, s))) for i, s in best]
    assert 100 not in got and 200 not in got


def test_top_k_counts_large_components_exactly(spark):
    numbers = [1.0, -3.0, 2.0**22, 2.0**23, 2.0**40 + 1, 2.0**55, 2.0**55 + 8, 1e300, -1e300, 5e-3]
    vectors = [(i, [x, y]) for i, x in enumerate(numbers) for y in (x, 0.25)]
    vectors = [(n, v) for n, (_, v) in enumerate(vectors)] + [(99, [1e308, 1e308])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    rows = top_k(frame, frame, k=7).collect()
    exact = {i: [int(np.floor(64 * x)) if abs(x) < 2**53 else 64 * int(x) for x in v] for i, v in vectors}
    want = brute.top_k(exact, exact, 7)
    most = (1 << 63) - 1
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == {q: [(i, max(-most - 1, min(most, s))) for i, s in best] for q, best in want.items()}


def test_secrets(spark, odd):
    for folder in (SMALL, odd):
        texts = _documents(folder)
        by_id = dict(texts)
        rows = _rows(spark, "op10_secrets", folder)
        assert len(rows) == len(texts)
        for r in rows:
            if r["doc_id"] is None:
                continue
            spans = brute.base_spans(by_id[r["doc_id"]])
            joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
            assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def test_novelty_finds_keys_and_leaves_words():
    prose = "the server of this service is described in the manual of the server. " * 5
    found = scan_text(prose + "authorization bearer Xy9kQ2mLp0Zr7TnAA11 is used. " + prose)
    assert [k for _, k, _ in found] == [3]
    assert scan_text(prose + "credential user-authentication-service-v2 is used. " + prose) == []
    assert base_spans("nothing here") == []


def test_novelty_looks_at_every_candidate():
    text = 'password="abcDEF1$k9Lm2Qw8!zX"'
    assert scan_text(text) == [(0, 0, 17), (17, 3, 29)]
    assert redact(text, scan_text(text)) == '[SECRET][SECRET]"'
    prose = "the server of this service is described in the manual of the server. " * 5

    def found(text):
        whole = prose + text + prose
        return [whole[a:b] for a, k, b in scan_text(whole) if k == 3]

    # Letters only, digits only, and before the word.
    assert found("credential QzkWvXpLmTrB is used. ") == ["QzkWvXpLmTrB"]
    assert found("credential 830174659218 is used. ") == ["830174659218"]
    assert found("use Xy9kQ2mLp0Zr7TnAA11 as credential. ") == ["Xy9kQ2mLp0Zr7TnAA11"]
    # A sensitive word in the string does not hide what follows; names of values stay.
    assert found("set secret_key=Xy9kQ2mLp0Zr7TnAA11 now. ")[0].endswith("Xy9kQ2mLp0Zr7TnAA11")
    assert found("set db_password=hunter22 now. ") == []


def test_encoder_equals_tokenizer():
    odd = ["a  b", "a \n b", " x ", "it's we'll a.b, c).", "a <|endoftext|>, b", "é, è. ß? İ.",
           "A\0b c", "日本語、 ab日,", "%%% ***a### b&&&&", "ÀÉ, ÿ× ÷a ýÞð.", "1,000 a1, b2."]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        own = FragmentEncoder(public_tokenizers.path(name))
        plain = Tokenizer.from_file(public_tokenizers.path(name))
        texts = odd + [f"{a} {b}" for a in odd for b in odd]
        for text, ids in zip(texts, own.encode(texts), strict=True):
            want = plain.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, text


def test_encoder_builds_lines_from_their_words():
    """Words met before, with punctuation and line ends, need not be encoded again."""
    texts = ["the word, of.\nÉtat\nthe. end", "the word.\nof, the\n\nend \n of.\n\tthe\n", "\nthe.\n.\nof"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        plain = Tokenizer.from_file(public_tokenizers.path(name))
        for most in (3, 1000):
            own = FragmentEncoder(public_tokenizers.path(name), most)
            for text in [*texts, *texts]:
                want = plain.encode(text, add_special_tokens=False).ids
                assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == want, text
        asked = []

        class Counted:
            def encode_batch_fast(self, some, **options):
                asked.extend(some)
                return plain.encode_batch_fast(some, **options)

        own._tokenizer = Counted()
        own.encode(["of the word.\nof end.\nÉtat, the\nword"])
        assert asked == []


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(3)
    off = []
    for _ in range(100):
        pool = rng.integers(0, 1 << 63, 300).astype(np.uint64)
        a, b = pool[:250], pool[50:]
        one, other = superminhash([a, b])
        off.append((one == other).mean() - 200 / 300)
        common = (len(a) + len(b) - np.unpackbits((parity_map(a) ^ parity_map(b)).view(np.uint8)).sum()) / 2
        assert common >= 200
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.042


def test_group_links(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 3)]
    rows = group_links(spark, spark.createDataFrame(links, "a long, b long").repartition(5)).collect()
    want = {i: 0 for i in range(1, 41)} | {100: 90, 95: 90}
    assert {r["node"]: r["root"] for r in rows} == want


def test_differencing_deletes_what_neighbours_share():
    pages = [f"<div>Accept our terms</div><div class=x><p>{w * 30}</p></div>" for w in ("a ", "b ")]
    texts = difference([page_lines(p) for p in pages], 4)
    assert texts == [("a " * 30).strip(), ("b " * 30).strip()]
    assert common_lines(list("abcbdab"), list("bdcaba")) and len(
        common_lines(list("abcbdab"), list("bdcaba"))
    ) == 4


def test_differencing_keeps_lines_that_only_their_zone_shares():
    def page(own):
        items = "".join(f"<li>{x}</li>" for x in [*own, "See also"])
        return f"<div class=content><p>{own[0] * 40}</p><ul>{items}</ul></div>"

    owns = [(f"alpha{i} ", f"beta{i}") for i in range(3)]
    texts = difference([page_lines(page(o)) for o in owns], 4)
    assert texts == [f"{(a * 40).strip()} {a.strip()} {b}" for a, b in owns]
    # Copies of one page say nothing of another page.
    twins = [page_lines(page(owns[0]))] * 2 + [page_lines(page(("gamma ", "delta")))]
    assert difference(twins, 4)[2].endswith("gamma delta")


def test_main_text_does_not_depend_on_ranges(spark):
    def page(i):
        notes = "".join(f"<li>note {(i + k) // 5}</li>" for k in range(5))
        return f"<div>terms {i // 3}</div><ul>{notes}</ul><p>{f'own{i} ' * 40}</p>"

    pages = [(i, f"http://h.example.org/{i:04}", page(i)) for i in range(300)]
    pages += [(i, f"http://g.example.org/{i:04}", page(i)) for i in range(300, 303)]
    pages += [(None, None, "<p>alone</p>"), (7, None, None)] + pages[100:103] * 2
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    want = {}
    for some in (pages[:300], pages[300:303], [pages[304], pages[303]]):
        texts = difference([page_lines(h or "") for _, _, h in some], 4)
        # Each page is judged by its own neighbours: one run of all pages is the plain version.
        want |= {(i, u): t for (i, u, _), t in zip(some, texts, strict=True)}
    for partitions in (1, 7, 120):
        rows = extract_text(table, partitions).collect()
        assert len(rows) == len(pages)
        assert {(r["page_id"], r["url"]): r["text"] for r in rows} == want
        assert all(r["text"] == want[r["page_id"], r["url"]] for r in rows)


def test_network_without_both_labels():
    x = np.ones((5, 3))
    assert np.allclose(fit_network(x, np.ones(5)).scores(x), 0.999)
    assert np.allclose(fit_network(x[:0], np.ones(0)).scores(x), 0.5)


def test_pipeline_stages(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    kept = corpus_pipeline.near_dedup(spark, docs, odd)
    assert sorted(kept.columns) == sorted(corpus_pipeline.COLUMNS)
    ids = [r["doc_id"] for r in kept.collect() if r["doc_id"] is not None]
    groups = brute.near_duplicates(_documents(odd))
    assert sorted(ids) == sorted({root for _, root in groups.values()})
    clean = corpus_pipeline.secrets(spark, docs, odd)
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts[11] == "[SECRET] and [SECRET]" and texts[5] is None
    mixed = corpus_pipeline.mixture(spark, docs, odd)
    assert mixed.columns == list(corpus_pipeline.COLUMNS)
    assert mixed.groupBy("doc_id", "text").count().filter(F.col("count") > 9).count() == 0
