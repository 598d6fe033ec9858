"""The corpus pipeline, stage by stage, against plain Python over the rows each stage was given."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
import tiktoken
from cases import awkward, nothing

from almacen.llm import bpe, mixing
from almacen.llm.stored import stored

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["language ID", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights"]
NAMES += ["byte-level BPE encoding and decoding"]


def steps(spark, docs):
    """The rows before and after each stage."""
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF_DIR), "step"))
    return out


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}


def one_of_each(rows):
    """The keys of the smallest document of each group of near copies, all pairs compared."""
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    top = {k: k for k in sets}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((find(a), find(b)))
                top[high] = low
    return {k for k in keys if find(k) == k}


def test_stages_against_brute_force(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    given, known, different, apart, mixed, tokens = steps(spark, docs)
    rows = [df.collect() for df in (given, known, different, apart, mixed)]
    assert all(df.columns == docs.columns for df in (known, different, apart, mixed))

    kept = {r["doc_id"] for r in rows[1]}
    clean = [r["doc_id"] for r in rows[0] if r["text"] and any(c.isalpha() for c in r["text"])]
    assert len(kept) >= 0.99 * len(clean)
    assert kept <= set(clean)

    last = {}
    for r in rows[1]:
        last[r["text"]] = max(last.get(r["text"], r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in rows[2]) == sorted(last.values())

    assert sorted(r["doc_id"] for r in rows[3]) == sorted(one_of_each(rows[2]))

    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(apart).collect()}
    assert Counter(r["doc_id"] for r in rows[4]) == {k: n for k, n in copies.items() if n}

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    reference = tiktoken.Encoding(
        "reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = {r["doc_id"]: r["text"] for r in rows[4]}
    found = tokens.collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in rows[4])
    for r in found:
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert bytes(r["ids"]) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_awkward_and_empty_tables_pass_through(spark):
    result = steps(spark, awkward(spark))
    assert {r["doc_id"] for r in result[-1].collect()} <= {r["doc_id"] for r in result[0].collect()}
    assert [df.count() for df in steps(spark, nothing(spark))] == [0] * 6
