"""The pipeline's rows against brute force over the smallest tables."""

import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from orderflow.llm import langid
from orderflow.llm.common import table
from orderflow.llm.queries import VOCABULARY

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def one_of_equal_texts(texts):
    groups = defaultdict(list)
    for i, text in texts.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", text)].append((-len(text), i))
    return {i: texts[i] for _, i in map(min, groups.values())}


def class_of_near_texts(texts, size, percent):
    sets = {}
    for i, text in texts.items():
        found = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets[i] = {tuple(found[k:k + size]) for k in range(max(1, len(found) - size + 1))}
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((top(a), top(b)))
                    root[y] = x
    return {i: top(i) for i in texts}


def phrases(text, length=10):
    found = WORD.findall(lower(text))
    size = min(length, len(found))
    return {tuple(found[k:k + size]) for k in range(len(found) - size + 1)} if size else set()


@pytest.fixture(scope="module")
def packed(spark):
    return corpus_pipeline.run(spark, SMALL).collect()


def test_pipeline_against_brute_force(spark, packed):
    connection = duckdb.connect()
    documents = dict(connection.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    items = [t for t, in connection.sql(f"SELECT text FROM '{SMALL}/benchmark.parquet'").fetchall()]
    # the models' code lengths are tested against their definition
    first = {r.doc_id for r in langid.accepted(table(spark, SMALL, "documents")).collect()}
    assert first == {i for i, t in documents.items() if t and any(c.isalpha() for c in t)}
    unlike = one_of_equal_texts({i: documents[i] for i in first})
    class_of = class_of_near_texts(unlike, 5, 80)
    wanted = set().union(*(phrases(t or "") for t in items))
    lengths = {len(w) for w in wanted}

    def clean(text):
        found = WORD.findall(lower(text))
        return not any(tuple(found[k:k + n]) in wanted for n in lengths for k in range(len(found) - n + 1))

    stays = set(class_of.values())  # the smallest id of each class
    want = {i for i in stays if clean(documents[i])}
    assert {r.doc_id for r in packed} == want
    assert len(want) < len(stays) < len(unlike) < len(first)


def test_packed_tokens_are_the_kept_texts(packed):
    connection = duckdb.connect()
    documents = dict(connection.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    library = Tokenizer.from_file(VOCABULARY)
    pieces = defaultdict(list)
    for r in packed:
        pieces[r.doc_id].append(r)
    for i, found in pieces.items():
        ids = [*library.encode(documents[i], add_special_tokens=False).ids, 2]
        found.sort(key=lambda r: r.start)
        assert [r.start for r in found] == [sum(x.length for x in found[:k]) for k in range(len(found))]
        assert sum(r.length for r in found) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
                   for r in found)
