import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterfold.llm import exact, sharding


def lower(text):
    return (text or "").encode().lower()


def test_exact_dedup(docs, corpus):
    groups = {}
    for i, t in corpus:
        groups.setdefault(lower(t), []).append(i)
    for history in (None, F.lit(True), F.lit(False), F.col("doc_id") % 2 == 0):
        rows = exact.deduplicate(docs(corpus), history, part_digests=4).collect()
        assert len(rows) == len(corpus)
        by_sha = {hashlib.sha256(k).hexdigest(): v for k, v in groups.items()}
        for r in rows:
            ids = by_sha[r["text_sha256"]]
            known = [i for i in ids if i is not None]
            assert (r["group_size"], r["keep_id"]) == (len(ids), max(known) if known else None)
        kept = Counter(r["text_sha256"] for r in rows if r["kept"])
        assert kept == Counter(by_sha.keys())
        assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])


@pytest.mark.parametrize("history", ["false", "doc_id = 0", "true"])
def test_parts_hold_few_digests_whatever_the_history(docs, monkeypatch, history):
    """A first load, or a short history, does not put all arrivals into one part."""
    parts, look_up = [], exact.look_up
    monkeypatch.setattr(exact, "look_up", lambda index, new, n: parts.append(n) or look_up(index, new, n))
    rows = exact.deduplicate(docs([(i, f"text {i}") for i in range(1500)]), F.expr(history), part_digests=100).collect()
    assert len(rows) == 1500 and all(r["kept"] for r in rows)
    assert parts == [15]


def test_dropping_copies_keeps_all_columns(docs, corpus):
    df = docs(corpus)
    kept = exact.drop_copies(df)
    assert kept.columns == df.columns
    assert Counter(lower(r["text"]) for r in kept.collect()) == Counter({lower(t) for _, t in corpus})


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000, 20_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64)
    perfect = exact.MinimalPerfectHash.build(keys)
    assert sorted(perfect.slots(keys).tolist()) == list(range(n))


def test_perfect_hash_lists_what_no_level_seats():
    keys = np.array([5, 5, 9, 12], dtype=np.uint64)
    perfect = exact.MinimalPerfectHash.build(keys)
    assert perfect.listed.tolist() == [5, 5] and set(perfect.slots(keys)) <= {0, 1, 2, 3}


def test_digests_with_one_key_are_told_apart_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact, "_keys", lambda digests: np.full(len(digests), 7, dtype=np.uint64))
    import pyarrow as pa

    digests = [bytes([k]) * 32 for k in range(6)]
    rows = pa.table({"digest": digests[:4], "keep_id": [0, 1, 2, 3], "group_size": [1, 1, 1, 1]})
    index = exact._build_part((pa.scalar(0),), rows)
    found = exact._look_up_part(index, pa.table({"digest": digests[2:], "keep_id": [9, 1, 4, 5], "group_size": [2, 2, 2, 2]}))
    got = {d: (k, n) for d, k, n in zip(*[found[c].to_pylist() for c in ("digest", "keep_id", "group_size")])}
    assert got == dict(zip(digests, [(0, 1), (1, 1), (9, 3), (3, 3), (4, 2), (5, 2)]))


def test_sharding(docs, corpus):
    rows = sharding.assign_shards(docs(corpus)).collect()
    assert len(rows) == len(corpus)
    got = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
    assert got == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in corpus)
    slots, shards = {}, {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert shards.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], sharding.SHARDS)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shares_follow_weights_and_a_new_shard_only_takes(spark):
    ids = spark.range(40_000).select(F.col("id").cast("string").alias("k"))
    weights = {0: 1.0, 1: 2.0, 2: 5.0}
    now = sharding.rendezvous_shard(F.col("k"), weights)
    later = sharding.rendezvous_shard(F.col("k"), {**weights, 3: 2.0})
    counts = {(r["a"], r["b"]): r["count"] for r in ids.groupBy(now.alias("a"), later.alias("b")).count().collect()}
    assert {b for a, b in counts if a != b} == {3}
    for shard, weight in weights.items():
        share = sum(n for (a, _), n in counts.items() if a == shard) / 40_000
        assert abs(share - weight / 8) < 0.01
    assert abs(sum(n for (_, b), n in counts.items() if b == 3) / 40_000 - 0.2) < 0.01
    with pytest.raises(ValueError):
        sharding.rendezvous_shard(F.col("k"), {0: 0.0})


def test_sharding_runs_no_python(docs, corpus):
    plan = sharding.assign_shards(docs(corpus))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_tables(docs):
    assert exact.deduplicate(docs([])).count() == 0
    assert exact.drop_copies(docs([])).count() == 0
    assert sharding.assign_shards(docs([])).count() == 0
