from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tabularium.llm import packing
from tabularium.llm.queries import QUERIES

ODD = [
    None, "", " \n\t ", "It's a DON'T we'll 's've", "İstanbul ΣΑΣ", "x\x1cy a b", "<|endoftext|> a<|startoftext|>b", "123abc½ Ⅷ ²",
    "ﬁ é e\u0301 中文 ___ a_b", "a\u0085b\u00a0c", "ŸŒ ÿ ×÷ µ ª º ß", "??!! well... 'quoted'", "y" * 9000, "z " * 5000,
]


def check(rows, capacity=2048):
    """Sequences are gapless and within capacity; pieces of a document are gapless too."""
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        documents.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for parts in documents.values():
        for k, (piece, start, length) in enumerate(sorted(parts)):
            assert piece == k and start == k * capacity and (length == capacity or k == len(parts) - 1)
    return len(sequences)


def test_ids_are_those_of_the_tokenizer():
    coder = packing.encoder(packing.VOCABULARY)
    for text in ODD:
        assert coder.encode(text or "") == coder.whole(text or ""), text


def test_forgetting_words_changes_no_ids(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "CACHE", 3)
    coder = packing.WordEncoder(public_tokenizers.path(packing.VOCABULARY))
    text = "the cat, the dog. The Cat and 3 dogs! " * 5
    assert coder.encode(text) == coder.whole(text) and len(coder.known) <= 4


def test_patterns_use_each_piece_once_and_fill_well():
    rng = random.Random(1)
    for n in (0, 1, 50, 3000):
        counts = Counter(min(2048, int(rng.expovariate(1 / 600)) + 1) for _ in range(n))
        patterns = packing.plan_patterns(counts)
        used = Counter()
        for times, lengths in patterns:
            assert times > 0 and sum(lengths) <= 2048
            for length in lengths:
                used[length] += times
        assert used == counts
        bound = -(-sum(k * v for k, v in counts.items()) // 2048)
        assert sum(times for times, _ in patterns) <= max(bound + 1, 1.02 * bound)


def test_exact_pairs_and_triples_come_first():
    assert packing.plan_patterns({1000: 1, 1048: 1, 500: 1}) == [(1, (1048, 1000)), (1, (500,))]
    assert packing.plan_patterns({1024: 4}) == [(2, (1024, 1024))]
    assert packing.plan_patterns({1000: 2, 400: 2, 348: 2, 300: 4}, 2048)[0][1] == (1000, 400, 348, 300)


def test_defined_cases(docs):
    table = docs([*ODD, ODD[3], (3, ODD[3])])
    rows = packing.pack_documents(table, ids=True).collect()
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
    empty = [r for r in rows if r["doc_id"] in (0, 1, 2)]
    assert [(r["length"], r["ids"]) for r in empty] == [(1, [0])] * 3
    assert packing.pack_documents(table.limit(0)).count() == 0
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 2048) + 1


def test_many_copies_of_one_length(spark):
    cut = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
                                   F.when(F.col("id") % 3 == 0, 700).otherwise(F.col("id") % 2048 + 1).cast("long").alias("length"))
    rows = packing.pack(cut, rows_per_task=100).collect()
    assert len(rows) == 5000
    assert check(rows) == sum(times for times, _ in packing.plan_patterns(Counter(r["length"] for r in rows)))


def test_query(spark, small):
    rows = QUERIES["op10_complement_packing"](spark, small).collect()
    total = sum(r["length"] for r in rows)
    assert check(rows) <= -(-total // 2048) + 1
    coder = packing.encoder(packing.VOCABULARY)
    want = {}
    for doc in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect():
        data = coder.whole(doc["text"]) + b"\0\0\0\0"
        for k in range(0, len(data), 8192):
            want[doc["doc_id"], k // 8192] = (len(data[k : k + 8192]) // 4, zlib.crc32(data[k : k + 8192]))
    assert {(r["doc_id"], r["piece"]): (r["length"], r["ids_crc32"]) for r in rows} == want
