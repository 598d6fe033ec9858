"""The registered corpus queries: against DuckDB where they have SQL, else by brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from compare import difference, duck

from almacen.llm import bpe, queries, sharding

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.fixture(scope="module")
def documents(connection):
    return connection.execute("select doc_id, text, lang from documents").fetchall()


@pytest.mark.parametrize("key", queries.SQL)
def test_query_matches_sql(spark, connection, key):
    assert difference(queries.QUERIES[key](spark, SF_DIR), connection, queries.SQL[key]) is None


def test_sharding_looks_up_the_slot_of_every_document(spark, documents):
    rows = queries.op1_sharding(spark, SF_DIR).collect()
    table = sharding.lookup_table()
    assert sorted(r["doc_id"] for r in rows) == sorted(d[0] for d in documents)
    assert all(sharding.SHARDS[table[r["slot"]]] == r["shard"] for r in rows)


def test_language_id_names_the_language_of_unseen_texts(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op4_language_id(spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    held_out = [d for d in documents if zlib.crc32(str(d[0]).encode()) % 4 == 2]
    assert {d[0] for d in held_out} == {i for i, r in rows.items() if r["held_out"]}
    right = sum(rows[i]["lang_pred"] == lang for i, _, lang in held_out)
    assert right >= 0.95 * len(held_out)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_byte_bpe_gives_the_tokens_of_tiktoken(spark, documents):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    reference = tiktoken.Encoding(
        "reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    rows = {r["doc_id"]: r for r in queries.op8_byte_bpe(spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    for key, text, _ in documents:
        ids = reference.encode_ordinary(text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert rows[key]["n_tokens"] == len(ids)
        assert rows[key]["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert rows[key]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_lm_scoring_counts_every_token_and_beats_the_unigrams(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op10_lm_scoring(spark, SF_DIR).collect()}

    def tokens(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]

    held_out = {d[0]: zlib.crc32(str(d[0]).encode()) % 7 == 2 for d in documents}
    counts = Counter(t for i, text, _ in documents if not held_out[i] for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    for key, text, _ in documents:
        row, mine = rows[key], tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in mine)
        assert row["held_out"] == held_out[key]
        assert row["train_tokens"] == n
        assert row["n_tokens"] == len(mine)
        assert row["n_known"] == sum(counts[t] > 0 for t in mine)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
    unseen = [r for i, r in rows.items() if held_out[i]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)
