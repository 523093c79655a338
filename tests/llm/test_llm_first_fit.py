"""First-fit packing against plain encoding and a plain first fit."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from meterfold.llm import bpe, first_fit, tokens


@pytest.mark.parametrize("vocabulary", [tokens.VOCABULARY, first_fit.VOCABULARY])
def test_words_encode_like_whole_texts(vocabulary):
    parts = ["a", "b", " ", " ", "\n", "\t", "  ", "é", "'s", "1", "!", " x", "\x1c", "日本", "<|endoftext|>", "\x85", "　", "don't"]
    parts += ["'S", "\xa0", "½", "²3", "İ", "ß", "é", "_", "Σ", "“", "—", "%%%", "\x00", "​", "<|", "ſ", "K"]
    encoder, rng = bpe.BpeEncoder(vocabulary, 1 << 14), random.Random(1)
    assert encoder.style in ("spaced", "bare")
    plain = Tokenizer.from_file(vocabulary)
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randrange(14)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_memo_is_bounded():
    memo = bpe.Memo(lambda key: key.encode(), 4 * (bpe._ENTRY_BYTES + 10))
    for n in range(100):
        assert memo["common"] == b"common" and memo[str(n)] == str(n).encode()
        assert len(memo) + len(memo.older) <= 4


def plain_first_fit(lengths, capacity):
    bins = []
    for place, length in enumerate(lengths):
        for b in bins:
            if sum(lengths[p] for p in b) + length <= capacity:
                b.append(place)
                break
        else:
            bins.append([place])
    return bins


@pytest.mark.parametrize("seed", range(8))
def test_tree_finds_the_first_bin(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 64, 256])
    lengths = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 90))), reverse=True)
    assert first_fit.first_fit_decreasing(lengths, capacity) == plain_first_fit(lengths, capacity)
    sequences = first_fit.pack_group(lengths, capacity)
    sizes = [sum(n for _, _, n in s) for s in sequences]
    full, rest = divmod(sum(lengths), capacity)
    assert sizes == [capacity] * full + first_fit.powers_of_two(rest)
    parts = sorted(p for s in sequences for p in s)
    ends = {}
    for place, first, length in parts:
        assert first == ends.get(place, 0) and length > 0
        ends[place] = first + length
    assert [ends[p] for p in range(len(lengths))] == lengths


def check(rows, texts, capacity):
    """Every id lies in one piece, checksums are right, and no sequence takes padding."""
    plain = Tokenizer.from_file(first_fit.VOCABULARY)
    ids = [(i, np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], "<u4")) for i, t in texts]
    by_length = {}
    for i, x in ids:
        by_length.setdefault((i, len(x)), []).append(x)
    found = Counter()
    for r in rows:
        candidates = by_length[r["doc_id"], r["doc_tokens"]]
        sums = {zlib.crc32(x[r["start"] : r["start"] + r["length"]].tobytes()) for x in candidates}
        assert r["ids_crc32"] in sums
        found[r["doc_id"]] += r["length"]
    want = Counter()
    for i, x in ids:
        want[i] += len(x)
    assert found == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity and end & (end - 1) == 0
    return sequences


@pytest.mark.parametrize("options", [{}, {"capacity": 64}, {"capacity": 64, "group_docs": 4}, {"group_docs": 3, "group_bytes": 500}])
def test_packing(docs, corpus, options):
    rows = first_fit.pack(docs(corpus), **options).collect()
    capacity = options.get("capacity", first_fit.SEQUENCE)
    assert all(r["length"] <= capacity for r in rows)
    check(rows, corpus, capacity)
    starts = {}
    for r in rows:
        starts.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"]))
    for (doc_id, total), places in starts.items():
        if sum(n for _, n in places) == total:
            end = 0
            for start, length in sorted(places):
                assert start == end
                end += length


def test_repeated_rows_and_no_rows(docs):
    same = [(None, None)] * 50 + [(7, "one text " * 40)] * 50
    check(first_fit.pack(docs(same), 64, group_docs=8).collect(), same, 64)
    assert first_fit.pack(docs([])).count() == 0
    with pytest.raises(ValueError):
        first_fit.pack(docs([]), 100)


def test_same_result_in_other_partitions(docs, corpus):
    one = first_fit.pack(docs(corpus).repartition(1), 64, group_docs=16).collect()
    many = first_fit.pack(docs(corpus).repartition(7), 64, group_docs=16).collect()
    assert Counter(one) == Counter(many)
