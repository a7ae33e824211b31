"""Every registered training-data query: against DuckDB, or against brute force."""

import hashlib
import re
import zlib
from pathlib import Path

import numpy as np
import pytest

duckdb = pytest.importorskip("duckdb")

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from ratelab.llm import queries

DATA = Path("/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT * FROM documents ORDER BY doc_id").df()


def canonical(pdf):
    pdf = pdf[sorted(pdf.columns)].astype(object)
    pdf = pdf.where(pdf.notna(), None)
    return sorted(tuple(map(repr, row)) for row in pdf.itertuples(index=False, name=None))


def result(spark, name):
    got = queries.QUERIES[name](spark, str(DATA)).toPandas()
    return got.sort_values("doc_id").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, str(DATA)).toPandas()
    want = duck.execute(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 0
    assert canonical(got) == canonical(want)


def test_every_operator_has_a_query():
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES] == list(range(1, 14))


def test_languages(spark, documents):
    got = result(spark, "op3_language_id")
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in documents.doc_id]
    assert got.held_out.tolist() == held
    right = got.lang_pred == documents.lang
    assert right[got.held_out].mean() > 0.99
    assert got.score.between(0, 1).all()


def test_bpe_equals_library(spark, documents):
    got = result(spark, "op6_streaming_bpe")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for row, e in zip(got.itertuples(), library.encode_batch(list(documents.text), add_special_tokens=False)):
        assert row.n_tokens == len(e.ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(e.ids, dtype="<u4").tobytes()).hexdigest()
        text = library.decode(e.ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_token_files_equal_library(spark, documents):
    got = result(spark, "op9_dictionary_files")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for row, e in zip(got.itertuples(), library.encode_batch(list(documents.text), add_special_tokens=False)):
        ids = [*e.ids, 2]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def brute_fingerprint(text):
    lowered = text.translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def lowest_reachable(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_simhash_equals_brute_force(spark, documents):
    got = result(spark, "op10_anchor_simhash")
    prints = np.array([brute_fingerprint(t) for t in documents.text], dtype=np.uint64)
    assert got.fingerprint.tolist() == [f"{p:016x}" for p in prints]
    links = [
        (i, j)
        for i in range(len(prints))
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 2) + i + 1
    ]
    assert got.component_id.tolist() == [documents.doc_id[i] for i in lowest_reachable(len(prints), links)]


def test_pipeline(spark, documents):
    """The stages again, by hand: SQL for what it can state, brute force for the rest."""
    got = corpus_pipeline.run(spark, str(DATA)).toPandas()
    kept = documents[documents.text.str.contains(r"[^\W\d_]")]
    last = kept.groupby("text").doc_id.max()
    kept = kept[kept.doc_id.isin(set(last))].sort_values("doc_id").reset_index(drop=True)
    prints = np.array([brute_fingerprint(t) for t in kept.text], dtype=np.uint64)
    links = [
        (i, j)
        for i in range(len(prints))
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 2) + i + 1
    ]
    roots = lowest_reachable(len(prints), links)
    kept = kept[[i == r for i, r in enumerate(roots)]]
    connection = duckdb.connect()
    connection.register("documents", kept)
    taken = connection.execute(queries.ORACLE["op4_source_schedule"]).df()
    taken = taken[taken.taken > 0]
    want = dict(zip(taken.doc_id, np.ceil(taken.taken / taken["size"]).astype(int)))
    assert got.groupby("doc_id").size().to_dict() == want
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = dict(zip(documents.doc_id, documents.text))
    for row in got.drop_duplicates("doc_id").itertuples():
        assert list(row.ids) == library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(row.ids)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "mix", "tokenize"]
