"""Stupid-backoff scores of documents against n-gram counts of the whole corpus.

Documents are dealt into batches. A batch sends each of its distinct n-grams once, as a hash
with its number of occurrences, to the block of the count table that its hash belongs to. The
block sums them over all batches and answers each batch in the order asked, and the batch joins
the answers to the positions of its documents. However frequent an n-gram is, a block receives it
once per batch and no document's n-grams are ever rows of a shuffle.

A document is scored by the rest of the corpus: its own occurrences are taken off every count.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold.llm.common import ngram_hashes, text_bytes, word_hashes, words
from meterfold.session import materialise

ORDER = 2
BACKOFF = 0.4
BATCH_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20

_ASKED = "batch bigint, block bigint, hashes binary, counts binary"
_ANSWERED = "batch bigint, block bigint, counts binary"
_SCORED = "doc_id {kind}, n_words bigint, n_seen bigint, n_lower bigint, n_unseen bigint, part double"


def _planes(numbers: np.ndarray) -> bytes:
    """64-bit numbers with their bytes of equal rank together, which compress where they are alike."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _grams(texts: list[bytes], order: int) -> list[list[np.ndarray]]:
    """Per text its n-gram hashes of each order 1..order, by position."""
    found = []
    for text in texts:
        hashes = word_hashes(words(text))
        found.append([ngram_hashes(hashes, n) for n in range(1, order + 1)])
    return found


def _distinct(grams: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    flat = [g for doc in grams for g in doc]
    return np.unique(np.concatenate(flat), return_counts=True) if flat else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _asker(order: int, bits: int) -> Callable:
    """A function from one batch of documents to one row for each block that it asks."""

    def ask(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        names, counts = _distinct(_grams(text_bytes(docs["text"]), order))
        block = (names >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(names), np.int64)
        at = np.unique(block)
        cuts = np.searchsorted(block, np.append(at, 1 << bits))
        parts = list(zip(cuts[:-1], cuts[1:]))
        return pa.table(
            {
                "batch": pa.array([key[0].as_py()] * len(at), pa.int64()),
                "block": pa.array(at, pa.int64()),
                # sorted, so differences are small
                "hashes": pa.array([_planes(np.diff(names[a:b], prepend=np.uint64(0))) for a, b in parts], pa.binary()),
                "counts": pa.array([_planes(counts[a:b]) for a, b in parts], pa.binary()),
            }
        )

    return ask


def _answer(rows: pa.Table) -> pa.Table:
    """One block of the count table: sums over all batches, returned to each in its own order."""
    hashes = [np.cumsum(_from_planes(h), dtype=np.uint64) for h in rows["hashes"].to_pylist()]
    counts = np.concatenate([_from_planes(c) for c in rows["counts"].to_pylist()]).astype(np.int64)
    _, gram = np.unique(np.concatenate(hashes), return_inverse=True)
    # summed as integers: a float would be exact up to 2^53 only
    total = np.zeros(int(gram.max()) + 1, dtype=np.int64)
    np.add.at(total, gram, counts)
    summed, ends = total[gram], np.cumsum([len(h) for h in hashes])
    answers = [_planes(summed[e - len(h) : e]) for h, e in zip(hashes, ends)]
    return pa.table({"batch": rows["batch"], "block": rows["block"], "counts": pa.array(answers, pa.binary())})


def _scorer(order: int, backoff: float) -> Callable:
    """A function from a batch's documents and the answers of all blocks to a row per document.

    ``part`` lacks what depends on the corpus size: the logarithm of it for each word scored by
    its own frequency or not seen at all.
    """

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        grams = _grams(text_bytes(docs["text"]), order)
        names, _ = _distinct(grams)
        in_order = answers.sort_by("block")["counts"].to_pylist()
        totals = np.concatenate([_from_planes(a) for a in in_order]).astype(np.int64) if in_order else np.empty(0, np.int64)
        rows = [_document(doc, names, totals, backoff) for doc in grams]
        columns = list(zip(*rows)) or [()] * 5
        return pa.table(
            {
                "doc_id": docs["doc_id"],
                **{n: pa.array(c, pa.int64()) for n, c in zip(("n_words", "n_seen", "n_lower", "n_unseen"), columns)},
                "part": pa.array(columns[4], pa.float64()),
            }
        )

    return score


def _document(grams: list[np.ndarray], names: np.ndarray, totals: np.ndarray, backoff: float) -> tuple:
    n = len(grams[0])
    if not n:
        return 0, 0, 0, 0, 0.0
    others = []
    for hashes in grams:
        _, gram, own = np.unique(hashes, return_inverse=True, return_counts=True)
        others.append(totals[np.searchsorted(names, hashes)] - own[gram] if len(hashes) else np.empty(0, np.int64))
    log, open_ = np.zeros(n), np.ones(n, dtype=bool)
    seen = 0
    for k in range(len(grams), 1, -1):
        if n < k:
            continue
        at = np.arange(k - 1, n)
        gram, context = others[k - 1], others[k - 2][: n - k + 1]
        hit = open_[at] & (gram > 0)
        log[at[hit]] += np.log(gram[hit] / context[hit])
        if k == len(grams):
            seen = int(hit.sum())
        open_[at[hit]] = False
        # one step down for the words that had a context of this length
        log[at[~hit & open_[at]]] += np.log(backoff)
    known = open_ & (others[0] > 0)
    log[known] += np.log(others[0][known])
    return n, seen, int(known.sum()), int((open_ & ~known).sum()), float(log.sum())


def score_documents(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """Stupid-backoff log scores of every row of ``docs(doc_id, text)`` under all other rows.

    A word scores the logarithm of its n-gram's count over that of its context; where the n-gram
    does not occur in another row, ``backoff`` times the score with one word less of context; at
    last its own share of the words of the other rows. A word no other row has counts as one more
    word. Words are runs without ASCII white space with A-Z lower-cased.

    Returns ``doc_id, n_words, n_seen`` (words whose longest n-gram is known), ``n_unseen`` (words
    no other row has), ``log_score`` (the sum, to six decimals) and ``per_word``.

    Edge cases: a text without words, or an absent one, has the score 0 and no ``per_word``; a text
    that is all of the corpus knows nothing but itself and every word is unseen; rows without id
    and repeated rows are rows like others, so copies know each other; an empty table gives no
    rows; other columns are not read.
    """
    if order < 1 or not 0 < backoff <= 1:
        raise ValueError(f"order from 1 and backoff in (0, 1], got {order} and {backoff}")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-size // BATCH_BYTES))
    bits = max(0, int(np.ceil(np.log2(max(1, order * size / BLOCK_BYTES / 2)))))
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)))
    asked = dealt.groupBy("batch").applyInArrow(_asker(order, bits), _ASKED)
    answered = asked.groupBy("block").applyInArrow(_answer, _ANSWERED)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = (
        dealt.groupBy("batch").cogroup(answered.groupBy("batch")).applyInArrow(_scorer(order, backoff), _SCORED.format(kind=kind))
    )
    scored = materialise(scored, "lm-scores")
    corpus = scored.agg(F.sum("n_words")).first()[0] or 0
    rest = F.lit(float(corpus)) - F.col("n_words")
    log_score = F.col("part") - F.col("n_lower") * F.log(F.greatest(rest, F.lit(1.0))) - F.col("n_unseen") * F.log(rest + 1)
    return scored.withColumn("log_score", F.round(log_score, 6)).select(
        "doc_id",
        "n_words",
        "n_seen",
        "n_unseen",
        "log_score",
        F.when(F.col("n_words") > 0, F.round(log_score / F.col("n_words"), 6)).alias("per_word"),
    )
