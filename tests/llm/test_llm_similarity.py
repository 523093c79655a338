"""Jaccard join and embedding near-dedup against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from meterfold.llm import embeddings, jaccard
from meterfold.llm.common import components_of, connected_components


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def smallest_reached(links, nodes):
    reach = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(reach[a], reach[b])
            if reach[a] != low or reach[b] != low:
                reach[a] = reach[b] = low
                changed = True
    return reach


def all_pairs(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    links = [
        (a, b)
        for n, (a, x) in enumerate(sets)
        for b, y in sets[:n]
        if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y)
    ]
    reach = smallest_reached(links, {i for i, _ in sets if i is not None})
    return Counter((i, len(s), reach.get(i)) for i, s in sets)


def result(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_jaccard_classes(docs, corpus):
    assert result(jaccard.jaccard_classes(docs(corpus))) == all_pairs(corpus)


@pytest.mark.parametrize("seed", [0, 1])
def test_jaccard_near_the_threshold(docs, seed, monkeypatch):
    """Many variants around 80 %, a passage that many documents share, small blocks everywhere."""
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 20)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 2_000)
    monkeypatch.setattr(jaccard, "PRODUCT_COLUMNS", 16)
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(30)]
    rows = []
    for group in range(6):
        base = [f"g{group}w{rng.randrange(500)}" for _ in range(rng.choice([12, 40, 90]))]
        for _ in range(14):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            cut = rng.randrange(len(text) // 6 + 1)
            rows.append((len(rows), " ".join(text[cut:] + (passage if rng.random() < 0.5 else []))))
    rng.shuffle(rows)
    want = all_pairs(rows)
    assert 1 < len({c for _, _, c in want}) < len(rows)
    assert result(jaccard.jaccard_classes(docs(rows))) == want


def test_dropping_near_copies(docs, corpus):
    df = docs(corpus)
    kept = jaccard.drop_near_copies(df)
    assert kept.columns == df.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    roots = {i for i, _, c in all_pairs(corpus) if i is not None and i == c}
    want = Counter(dict.fromkeys([(i, t) for i, t in corpus if i in roots], 1))
    assert got == want + Counter((i, t) for i, t in corpus if i is None)


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 100)]
    loose = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    edges = [*chain, *star, *loose, (5000, 5000), (7, None)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "t").collect()}
    links = [(a, b) for a, b in edges if b is not None]
    assert got == smallest_reached(links, {n for e in links for n in e})
    labels = components_of(300, np.array([a for a, _ in chain]), np.array([b for _, b in chain]))
    assert (labels[:201] == 0).all() and (labels[201:] == np.arange(201, 300)).all()


def vectors_near_the_threshold(dims=24, n=400, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((40, dims))
    rows = []
    for i in range(n):
        b = base[rng.integers(40)]
        side = rng.standard_normal(dims)
        v = b / np.linalg.norm(b) + side / np.linalg.norm(side) * rng.uniform(0, 0.4)
        rows.append((i, (v * rng.uniform(0.1, 9)).tolist()))
    rows += [(n + i, rows[i][1]) for i in range(30)]
    return rows


def brute(rows):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if usable(i, v)]
    links = []
    for n, (a, x) in enumerate(good):
        for b, y in good[:n]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                links.append((a, b))
    reach = smallest_reached(links, {i for i, _ in rows if i is not None})
    degree = Counter(e for link in links for e in link)
    return links, Counter((i, degree[i] if usable(i, v) else 0, reach.get(i)) for i, v in rows)


def usable(i, v):
    return i is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("kind", ["double", "float"])
def test_embeddings(spark, kind, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 50)
    rows = vectors_near_the_threshold()
    if kind == "float":
        rows = [(i, np.float32(v).tolist()) for i, v in rows]
    rows += [(900, None), (901, [0.0] * 24), (902, [None] * 24), (903, [float("nan")] * 24), (904, []), (None, rows[0][1])]
    rows += [(905, [float("inf"), *[0.0] * 23]), (906, [1.0, 2.0]), (907, [2.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id bigint, embedding array<{kind}>, label int, key string")
    got = embeddings.near_duplicates(df).collect()
    links, want = brute(rows)
    assert len(got) == len(rows)
    found, total = sum(r["n_links"] for r in got), 2 * len(links)
    assert 0.99 * total <= found <= total and total > 500
    if found == total:
        assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_collisions_are_counted_exactly():
    rng = np.random.default_rng(0)
    a, b = rng.standard_normal((37, 12)), rng.standard_normal((131, 12))
    for least in (1, 5, 12):
        i, j = embeddings.colliding_pairs(a, b, 0.7, least)
        count = (np.abs(a[:, None, :] - b[None, :, :]) <= 0.7).sum(axis=2)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(count >= least))))


def test_recall_is_calibrated():
    cal = embeddings.calibrated(64)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    hits = (np.abs((x - y) @ cal.axes.T) <= cal.window).sum(axis=1) >= cal.collisions
    assert hits.mean() > 0.99


@pytest.mark.parametrize("least", [0.5, 0.8, 0.95])
def test_links_at_other_thresholds(spark, least):
    """3,000 vectors over many cells: nearly every pair at or above the threshold is found, none below."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 8))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= least).sum(axis=1) - 1
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(df, least).collect()}
    assert all(got[i] <= n for i, n in enumerate(want))
    assert sum(got.values()) >= 0.98 * want.sum()


def test_occurrences():
    rng = np.random.default_rng(2)
    for n in (0, 1, 50, 1000):
        values = rng.integers(0, 40, n).astype(np.uint64)
        counts = Counter(values.tolist())
        assert jaccard.occurrences(values).tolist() == [counts[v] for v in values.tolist()]


def test_empty_tables(spark, docs):
    assert jaccard.jaccard_classes(docs([])).count() == 0
    assert jaccard.drop_near_copies(docs([(None, None), (1, "")])).count() == 2
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
