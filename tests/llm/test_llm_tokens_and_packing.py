"""Token files and packing against plain encoding with the tokenizer."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from meterfold.llm import bpe, packing, tokens
from meterfold.session import fresh_path


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokens.VOCABULARY)
    return lambda text: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def test_chunks_encode_like_whole_texts(plain):
    parts = ["a", "b", " ", "\n", "\t", "  ", "é", "'s", "1", "!", " x", "\x1c", "日本", "<|endoftext|>", "\x85", "　", "don't"]
    rng = random.Random(1)
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(3000)]
    for text, ids in zip(texts, tokens.encoded(texts)):
        assert ids == plain(text).tobytes(), repr(text)


def test_marks_behind_a_word_are_learned_once(plain):
    """Words with and without marks behind them, beyond ASCII too, share one entry."""
    encoder = bpe.BpeEncoder(tokens.VOCABULARY)
    text = "thtion thtion### thtion&&& thtion.*** st\u00fc st\u00fc, st\u00fc|\nst\u00fc$$$ <|endoftext|> x<|"
    assert encoder.encode(text) == plain(text)[:-1].tobytes()
    learned = {*encoder.memo, *encoder.memo.older}
    assert {k for k in learned if "thtion" in k} == {"thtion", "\nthtion"}
    assert {k for k in learned if "st\u00fc" in k} == {"st\u00fc", "\nst\u00fc"}


def test_a_small_memo_gives_the_same(plain):
    encoder = bpe.BpeEncoder(tokens.VOCABULARY, 1_000)
    for text in ("one two three four five six", "seven eight nine ten", "one two"):
        assert encoder.encode(text) == plain(text)[:-1].tobytes()


def test_rare_words_of_token_files_are_kept():
    """Words that come back after half a million others, more than the shared memo holds, are learned once."""
    learned = []
    memo = bpe.Memo(lambda word: learned.append(word) or b"0123" * 4, tokens.MEMO_BYTES)
    for _ in range(2):
        for i in range(500_000):
            assert memo[f"word{i}"]
    assert len(learned) == 500_000


def test_token_files_with_a_small_memo(spark, docs, corpus, plain):
    path = fresh_path(spark, "small-memo")
    tokens.write_tokens(docs(corpus), path, memo_bytes=1_000)
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in tokens.read_tokens(spark, path).collect())
    assert got == Counter((i, tuple(plain(t).tolist())) for i, t in corpus)


def test_token_files(spark, docs, corpus, plain):
    rows = tokens.round_trip(docs(corpus)).collect()
    assert len(rows) == len(corpus)
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows)
    ids = [(i, plain(t)) for i, t in corpus]
    assert got == Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in ids)
    in_order = sorted(rows, key=lambda r: r["start"])
    assert [r["start"] for r in in_order] == list(np.cumsum([0, *[r["n_tokens"] for r in in_order]])[:-1])
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in in_order]
    assert keys == sorted(keys)


def test_layout_of_files(spark, docs, corpus):
    path = fresh_path(spark, "layout")
    tokens.write_tokens(docs(corpus), path, row_group_bytes=1 << 16, page_rows=4)
    import glob

    files = [pq.ParquetFile(f) for f in glob.glob(f"{path.removeprefix('file://')}/*.parquet")]
    metas = [f.metadata for f in files if f.metadata.num_rows]
    column = {metas[0].row_group(0).column(c).path_in_schema: c for c in range(metas[0].num_columns)}
    for meta in metas:
        group = meta.row_group(0)
        ids = next(c for p, c in column.items() if p.startswith("ids"))
        assert "RLE_DICTIONARY" in group.column(ids).encodings
        assert "DELTA_BINARY_PACKED" in group.column(column["doc_id"]).encodings
        assert group.column(column["doc_id"]).has_column_index and group.column(column["doc_id"]).has_offset_index


def test_packing(docs, corpus, plain):
    capacity = 64
    rows = packing.pack(docs(corpus), capacity).collect()
    by_doc = {}
    for r in rows:
        assert 0 < r["length"] <= capacity
        by_doc.setdefault(r["doc_id"], []).append(r)
    texts = {}
    for i, t in corpus:
        texts.setdefault(i, []).append(plain(t))
    pieces = Counter()
    for i, all_ids in texts.items():
        for ids in all_ids:
            for n, (start, length) in enumerate(packing.piece_bounds(len(ids), capacity)):
                assert length == capacity or n == 0
                pieces[i, n, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
    assert pieces == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= capacity
    assert len(sequences) == best_fit([r["length"] for r in rows], capacity)


def best_fit(lengths, capacity):
    """Best fit, longest first, one piece at a time."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= length]
        gap = min(fitting) if fitting else capacity
        if fitting:
            gaps.remove(gap)
        gaps.append(gap - length)
    return len(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 50, 200])
    counts = {n: rng.randrange(1, 60) for n in rng.sample(range(1, capacity + 1), rng.randrange(1, min(capacity, 30)))}
    plan = packing.plan_packing(counts, capacity)
    length = np.concatenate([np.full(c, n) for n, c in counts.items()])
    rank = np.concatenate([np.arange(c) for c in counts.values()])
    sequence, offset = plan.of(length, rank)
    used = {}
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), length.tolist())):
        assert used.get(s, 0) == o
        used[s] = o + n
    assert max(used.values()) <= capacity
    assert len(used) == best_fit(length.tolist(), capacity)


def test_empty_tables(docs):
    assert tokens.round_trip(docs([])).count() == 0
    assert packing.pack(docs([])).count() == 0
