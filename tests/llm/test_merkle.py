"""The manifest against a plain tree, for runs of any size and levels left out."""

import hashlib
import zlib

import pyarrow.parquet as pq
import pytest

from headway.llm.merkle import dataset_proofs, with_folded
from headway.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm import brute

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf(row):
    out = ""
    for name in FIELDS:
        value = row[name]
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return hashlib.sha256(out.encode()).hexdigest()


@pytest.mark.parametrize("which", ["small", "odd"])
def test_query_equals_plain_tree(spark, odd, which):
    folder = SMALL if which == "small" else odd
    rows = pq.read_table(f"{folder}/documents.parquet", columns=list(FIELDS)).to_pylist()
    changed = {}
    for row in rows:
        i, n = row["doc_id"], row["n_chars"]
        if i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None:
            changed[_leaf(row)] = _leaf({**row, "n_chars": n + 1})
    root, want = brute.manifest([(r["doc_id"], r["lang"], _leaf(r)) for r in rows], 2)
    expected = []
    for key, leaf, subroot, path in want:
        siblings = "".join("".join(a) + "".join(b) for a, b in path)
        top = brute.folded(changed.get(leaf, leaf), path)
        proof = hashlib.sha256(siblings.encode()).hexdigest()
        expected.append((key, leaf, subroot, root, proof, top, top == root))
    got = [tuple(r) for r in QUERIES["op13_manifest"](spark, folder).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert {leaf for _, leaf, *_, verified in got if not verified} == set(changed)


@pytest.mark.parametrize("fan,step", [(2, 1), (2, 3), (3, 2), (5, 1), (16, 1)])
@pytest.mark.parametrize("sizes", [(1,), (2, 1), (7, 16, 1), (33, 100)])
def test_any_fan_and_step(spark, fan, step, sizes):
    rows = [(n * 1000 + i, f"t{n}", f"v{i}") for n, size in enumerate(sizes) for i in range(size)]
    frame = spark.createDataFrame(rows, "id long, tree string, value string")
    proofs, root = dataset_proofs(frame, "id", "tree", ["id", "value"], ["id"], fan, step)
    found = with_folded(proofs, "digest", "folded", ["id", "digest", "top", "siblings"]).collect()

    def leaf(i, value):
        return hashlib.sha256(f"{len(str(i))}:{i}{len(value)}:{value}".encode()).hexdigest()

    want_root, want = brute.manifest([(i, t, leaf(i, v)) for i, t, v in rows], fan)
    assert root.hex() == want_root and len(found) == len(rows)
    by_id = {r["id"]: r for r in found}
    for key, digest, subroot, path in want:
        row = by_id[key]
        assert (row["digest"].hex(), row["top"].hex()) == (digest, subroot)
        assert row["siblings"].hex() == "".join("".join(a) + "".join(b) for a, b in path)
        assert row["folded"].hex() == want_root
