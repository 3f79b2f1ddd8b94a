"""The operators' queries on the smallest tables, against SQL, libraries or brute force."""

import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from checks.compare import differences
from orderflow.llm.oracles import ORACLES
from orderflow.llm.queries import QUERIES, VOCABULARY

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    out = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "conversations", "labels"):
        out.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return out


@pytest.fixture(scope="module")
def documents(connection):
    return {d: (t, lang) for d, t, lang in
            connection.sql("SELECT doc_id, text, lang FROM documents").fetchall()}


@pytest.fixture(scope="module")
def ids(documents):
    library = Tokenizer.from_file(VOCABULARY)
    return {d: library.encode(t or "", add_special_tokens=False).ids
            for d, (t, _) in documents.items()}


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SMALL), connection, ORACLES[name]) == []


def test_token_counts(spark, documents, ids):
    got = {r.doc_id: r for r in QUERIES["op1_token_counts"](spark, SMALL).collect()}
    assert {d: r.n_tokens for d, r in got.items()} == {d: len(i) for d, i in ids.items()}
    assert all(r.n_bytes == len(documents[d][0].encode()) for d, r in got.items())
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got.values())


def test_held_out_languages(spark, documents):
    rows = QUERIES["op3_language_id"](spark, SMALL).collect()
    assert len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == documents[r.doc_id][1] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_packed_ids(spark, ids):
    rows = QUERIES["op7_packing"](spark, SMALL).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        all_ids = [*ids[r.doc_id], 2]
        part = np.array(all_ids[r.start:r.start + r.length], "<u4").tobytes()
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(part), len(all_ids))
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length))
    lengths = [gapless(s) for s in sequences.values()]
    assert max(lengths) <= 4096
    assert {d: gapless(p) for d, p in pieces.items()} == {d: len(i) + 1 for d, i in ids.items()}
    padded = sum(n if n & (n - 1) == 0 else 4096 for n in lengths)
    assert sum(lengths) > 0.9 * padded


def gapless(spans):
    end = 0
    for start, length in sorted(spans):
        assert start == end
        end += length
    return end
