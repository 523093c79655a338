"""LM scores, toxicity, URL verdicts and segmentations against plain versions."""

import math
import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from meterfold.llm import lm, pieces, toxicity, urls


def backoff_scores(rows, order, alpha=0.4):
    docs = [(t or "").encode().lower().split() for _, t in rows]
    grams = [Counter(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)) for w in docs]
    total, words = sum(grams, Counter()), sum(map(len, docs))
    found = []
    for w, own in zip(docs, grams):
        rest, score = words - len(w), 0.0
        for i in range(len(w)):
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(w[i - n + 1 : i + 1])
                count = total[gram] - own[gram]
                if n == 1:
                    score += math.log(count / rest) if count else -math.log(rest + 1)
                elif count:
                    score += math.log(count / (total[gram[:-1]] - own[gram[:-1]]))
                    break
                else:
                    score += math.log(alpha)
        found.append((len(w), round(score, 4)))
    return found


@pytest.mark.parametrize("order", [1, 2, 3])
def test_stupid_backoff(docs, corpus, order, monkeypatch):
    monkeypatch.setattr(lm, "BATCH_BYTES", 20_000)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 10_000)
    got = lm.score_documents(docs(corpus), order).collect()
    want = backoff_scores(corpus, order)
    assert Counter((r["doc_id"], r["n_words"], round(r["log_score"], 4)) for r in got) == Counter(
        (i, n, s) for (i, _), (n, s) in zip(corpus, want)
    )
    assert all((r["per_word"] is None) == (r["n_words"] == 0) for r in got)


def test_backoff_of_nothing(docs):
    assert lm.score_documents(docs([])).count() == 0
    [row] = lm.score_documents(docs([(1, "alone here")])).collect()
    assert (row["n_unseen"], row["log_score"]) == (2, round(math.log(0.4), 6))


def toxic_corpus(n=900, seed=5):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        text = [f"w{rng.choice('abcdefgh')}{rng.choice('klmnop')}{rng.choice('rstuv')}" for _ in range(rng.randrange(5, 80))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["vileness", "vilest", "rotten", "rot"]))
        rows.append((i, " ".join(text)))
        if rng.random() < 0.7:
            labels.append((i, 1, int(toxic), int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, docs):
    rows, labels = toxic_corpus()
    truth = {i: any(w.startswith(("vile", "rot")) for w in t.split()) for i, t in rows}
    rows += [(None, None), (5000, ""), (5001, None), (None, "vilest rotten vileness rot"), (3, dict(rows)[3])]
    table = spark.createDataFrame([*labels, (None, 1, 1, 1), (7, None, None, None)], "doc_id bigint, quality int, toxic int, score int")
    got = toxicity.score_documents(docs(rows), table).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    hits = [r["predicted"] == truth[r["doc_id"]] for r in held]
    assert len(held) > 200 and np.mean(hits) > 0.98
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (5000, 5001)}) == 1
    kept = toxicity.drop_toxic(docs(rows), table)
    assert kept.columns == docs(rows).columns
    assert kept.count() == sum(r["predicted"] == 0 for r in got)
    # labels of held-out rows change nothing
    import zlib

    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t, s) for i, q, t, s in labels]
    other = spark.createDataFrame(flipped, "doc_id bigint, quality int, toxic int, score int")
    assert toxicity.score_documents(docs(rows), other).collect() == toxicity.score_documents(docs(rows), table.limit(len(labels))).collect()


def test_steps_follow_the_gradient_of_the_corrected_risk():
    """The fit against the same steps with a numerical gradient, through the point where the risk goes negative."""
    rng = np.random.default_rng(3)
    width, prior, s = 5, 0.45, toxicity.Settings(steps=40, decay=0.01)
    toxic = [np.flatnonzero(rng.random(width) < p) for p in (0.9, 0.8, 0.7, 0.9)]
    clean = [np.flatnonzero(rng.random(width) < 0.2) for _ in range(7)]

    def dense(rows):
        return np.array([[float(c in r) for c in range(width)] for r in rows])

    x, u = dense(toxic), dense(clean)

    def risks(theta):
        p, q = (1 / (1 + np.exp(-(m @ theta[:-1] + theta[-1]))) for m in (x, u))
        called_clean = -np.log(1 - q).mean() + prior * np.log(1 - p).mean()
        return prior * -np.log(p).mean(), called_clean

    def gradient(f, theta):
        return np.array([(f(theta + h) - f(theta - h)) / 2e-6 for h in np.eye(width + 1) * 1e-6])

    theta, first, second, negative = np.append(np.zeros(width), np.log(prior / (1 - prior))), 0.0, 0.0, 0
    for step in range(1, s.steps + 1):
        if risks(theta)[1] < 0:
            negative += 1
            g = -gradient(lambda t: risks(t)[1], theta)
        else:
            g = gradient(lambda t: sum(risks(t)), theta)
        g = g + s.decay * np.append(theta[:-1], 0)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g**2
        theta = theta - s.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        theta[:-1] = np.maximum(theta[:-1], 0)
    weights, bias = toxicity.fit_nnpu(toxicity._Sparse(toxic, width), toxicity._Sparse(clean, width), prior, s)
    assert 0 < negative < s.steps
    assert np.allclose(np.append(weights, bias), theta, atol=1e-4)


def test_an_id_that_is_repeated_is_one_of_the_sample(spark, docs):
    """Thousands of rows of one id do not crowd out the others."""
    rows = [(5, "again")] * 3000 + [(i, f"clean words {i}") for i in range(6, 66)] + [(i, "vile slur") for i in range(100, 130)]
    labels = spark.createDataFrame([(i, 1, 1) for i in range(100, 130)] + [(i, 1, 0) for i in range(6, 66)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs(rows), labels, toxicity.Settings(max_toxic=40, max_unlabelled=100))
    odds = list(model.log_odds(["vile slur", "clean words 7"]))
    assert odds[0] > odds[1]


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r["predicted"] for r in toxicity.score_documents(docs([(1, "a"), (2, None)]), none).collect()] == [0, 0]
    assert toxicity.score_documents(docs([]), none).count() == 0


def test_risk_correction_recovers_hidden_positives():
    """Toxic texts among the unlabelled ones do not teach the classifier that they are clean."""
    rows, _ = toxic_corpus(1500, 8)
    features = [toxicity.text_features(t) for _, t in rows]
    truth = np.array([any(w.startswith(("vile", "rot")) for w in t.split()) for _, t in rows])
    known = [f for f, y in zip(features[:700], truth[:700]) if y]
    model = toxicity.train(known, features[700:], 0.15)
    odds = np.array(list(model.log_odds([t for _, t in rows[700:]])))
    assert (odds[truth[700:]] > 0).mean() > 0.95 and (odds[~truth[700:]] > 0).mean() < 0.02


URLS = [
    "http://ththre.example.com/fr/825?page=2", "https://www.example.com/en/1", "https://example.com/en/1", "HTTPS://EXAMPLE.COM/en/",
    "https://a.example.net/es/2#x", "https://example.net/esx", "https://net/fr/", "https://www.casino-win.example.org/en/1",
    "https://casinos.example.org/x", "https://cheap-x.example.org/free/1", "https://cheap-x.example.org/1", "https://x.org/cheap/cheap",
    "no scheme casino", "://", "http://h?x=1://y/z", "http://xcom/", "http://a.b.com", "", None, "http://h/a?b#c", "http://h/\npills\n",
]


def plain_verdict(url):
    text = (url or "").encode().lower().decode()
    rest = (url or "").partition("://")[2]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut].encode().lower().decode(), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [
        r for r in urls.RULES
        if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])
    ]
    rule = max(fits, key=len) if fits else None

    def hit(term):
        import re

        return bool(re.search(rf"(?<![a-z0-9]){term}(?![a-z0-9])", text))

    v = urls.Vocabulary()
    strict, soft = sum(map(hit, v.strict)), sum(w for t, w in v.soft if hit(t))
    verdict = urls.RULES[rule] if rule else ("block" if strict or soft >= v.soft_weight else "allow")
    return host, path, rule, verdict, strict, soft


def test_urls(spark):
    pages = [(n, u, "<html>", "x") for n, u in enumerate(URLS)] + [(None, URLS[0], None, None), (0, URLS[0], None, None)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, rule string")
    got = Counter(tuple(r) for r in urls.judge_urls(df).collect())
    assert got == Counter((i, *plain_verdict(u)) for i, u, *_ in pages)
    assert urls.judge_urls(df.limit(0)).count() == 0


def test_vocabulary_is_checked():
    with pytest.raises(ValueError):
        urls.Vocabulary(strict=("Casino",))
    heavy = urls.Vocabulary(strict=(), soft=(("a", 1), ("b", 3)), soft_weight=3)
    assert urls.term_hits("http://x/a", heavy) == (0, 1) and urls.term_hits("a b b ab", heavy) == (0, 4)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.vocabulary_of()


def all_segmentations(text, vocabulary):
    lattice = pieces.Lattices(vocabulary, [text])

    def paths(stretches, node):
        if node is None:
            if not len(stretches):
                yield (), 0.0
                return
            stretches, node = stretches[1:], int(stretches[0])
        for c in np.nonzero(lattice.share[node])[0]:
            ids = tuple(lattice.ids(np.array([node]), np.array([c])).tolist())
            ahead = node + int(c) + 1
            for rest, log in paths(stretches, ahead if ahead < lattice.end[node] else None):
                yield ids + rest, log + math.log(lattice.share[node, c])

    return dict(paths(lattice.starts, None))


def test_lattice_holds_every_segmentation(vocabulary):
    names = vocabulary.processor.id_to_piece
    for text in ("the cat", "a  b", "don't"):
        spelled = vocabulary.processor.normalize(text)
        found = all_segmentations(text, vocabulary)
        assert abs(sum(map(math.exp, found.values())) - 1) < 1e-9
        plain = {i for i in range(vocabulary.size) if not vocabulary.processor.is_byte(i) and not vocabulary.processor.is_control(i)}
        by_text = {names(i): i for i in plain}

        def cut(rest):
            if not rest:
                return [()]
            return [(by_text[rest[:k]], *t) for k in range(1, len(rest) + 1) if rest[:k] in by_text for t in cut(rest[k:])]

        assert set(found) == set(cut(spelled))
        # probabilities are in the ratio of the products of piece weights
        weight = {s: sum(math.log(vocabulary.weight[i]) for i in s) for s in found}
        offset = {round(found[s] - weight[s], 6) for s in found}
        assert len(offset) == 1


def test_samples_follow_the_model_without_replacement(vocabulary):
    text, n = "the cat", 3000
    p = {s: math.exp(log) for s, log in all_segmentations(text, vocabulary).items()}
    first, among, estimate = Counter(), Counter(), Counter()
    for key in range(n):
        [samples] = pieces.segmentations([text], [key], 2, vocabulary)
        ids = [tuple(s[0].tolist()) for s in samples]
        assert len(set(ids)) == 2 and samples[0][2] > samples[1][2]
        first[ids[0]] += 1
        for i, s in zip(ids, samples):
            assert abs(s[1] - math.log(p[i])) < 1e-9
            among[i] += 1
            estimate[i] += 1 / s[3]
    for s, _ in first.most_common(4):
        included = p[s] + sum(q * p[s] / (1 - q) for z, q in p.items() if z != s)
        assert abs(first[s] / n - p[s]) < 4 * math.sqrt(p[s] / n)
        assert abs(among[s] / n - included) < 4 * math.sqrt(included / n)
        assert abs(estimate[s] / n - 1) < 0.15


def test_three_samples_follow_the_model_without_replacement():
    """Orders of three samples, against their exact chances; a flat model gives all of them a share."""
    flat, text, n = pieces.vocabulary_of(sharpness=0.1), "at on", 6000
    p = {s: math.exp(log) for s, log in all_segmentations(text, flat).items()}
    got = Counter()
    for first in range(0, n, 500):
        for samples in pieces.segmentations([text] * 500, list(range(first, first + 500)), 3, flat):
            got[tuple(tuple(s[0].tolist()) for s in samples)] += 1
    want = {(a, b, c): n * p[a] * p[b] / (1 - p[a]) * p[c] / (1 - p[a] - p[b]) for a, b, c in permutations(p, 3)}
    assert set(got) <= set(want) and len(want) > 30
    often = [x for x in want if want[x] >= 5]
    chi = sum((got[x] - want[x]) ** 2 / want[x] for x in often)
    assert abs(chi - len(often)) < 5 * math.sqrt(2 * len(often))


def test_the_search_draws_little_noise_for_a_long_text(vocabulary, monkeypatch):
    """What leaves a path stays one set until it is the best, however many steps the path has."""
    drawn, truncated = [], pieces._truncated
    monkeypatch.setattr(pieces, "_truncated", lambda mass, *rest: drawn.append(np.size(mass)) or truncated(mass, *rest))
    [samples] = pieces.segmentations(["the cat and the onheretion " * 300], [1], 3, vocabulary)
    assert len({tuple(s[0].tolist()) for s in samples}) == 3 and len(samples[0][0]) > 1000
    assert sum(drawn) < 20


def test_absent_pieces_are_searched_for_once(vocabulary, monkeypatch):
    """Beginnings of no piece, which are most, end at an empty slot of the first table; all pieces are found."""
    searched, slot = [0] * 8, pieces.Vocabulary._slot
    counted = lambda h, turn: searched.__setitem__(turn, searched[turn] + len(h)) or slot(h, turn)
    monkeypatch.setattr(pieces.Vocabulary, "_slot", staticmethod(counted))
    pieces.Lattices(vocabulary, ["the cat and the onheretion qxzv " * 20, "Anderswo 1234 wxyz, gehtdas"])
    assert 0 < searched[0] and sum(searched[1:]) < 0.2 * searched[0]
    for keys, values in vocabulary.tables:
        piece, there = vocabulary.find(keys[keys != 0])
        assert there.all() and (piece == values[keys != 0]).all()


def test_edges_of_samples_know_their_stretch(vocabulary):
    lattices = pieces.Lattices(vocabulary, ["in front", "the cat and the onheretion " * 5 + "\n\u6f22 end"])
    walks = lattices.walks([3, 4], 6)
    paths, _ = pieces.sample_paths(lattices, walks, 1, 6, np.random.Generator(np.random.Philox(key=4)))
    assert len(paths) == 6
    for path in paths:
        at, want = 0, []
        for length in lattices.length[path.edges].tolist():
            want.append(int(np.searchsorted(lattices.place[lattices.bounds[1] :], at, side="right")) - 1 + int(lattices.bounds[1]))
            at += length
        assert [path.owner(step) for step in range(len(path.edges))] == want
        assert abs(path.log_prob - float(lattices.log_chance[path.edges].sum())) < 1e-9


def test_samples_do_not_depend_on_neighbours(vocabulary):
    texts = ["the cat", "", "on the mat " * 40, "\u6f22\u5b57 \U0001f600", "the cat"]
    together = list(pieces.segmentations(texts, [5, 6, 7, 8, 5], 3, vocabulary))
    for text, key, samples in zip(texts, [5, 6, 7, 8, 5], together):
        [alone] = pieces.segmentations([text], [key], 3, vocabulary)
        assert [(s[0].tolist(), *s[1:]) for s in alone] == [(s[0].tolist(), *s[1:]) for s in samples]


def test_few_segmentations_are_all_given(vocabulary):
    [samples] = pieces.segmentations(["ab"], [1], 50, vocabulary)
    assert {tuple(s[0].tolist()) for s in samples} == set(all_segmentations("ab", vocabulary))
    assert all(s[3] == 1.0 for s in samples)


def test_segmentations_decode(docs, corpus, vocabulary):
    rows = pieces.sample_segmentations(docs(corpus), 3).collect()
    texts = {}
    for i, t in corpus:
        texts.setdefault(i, set()).add(t or "")
    for r in rows:
        back = pieces.decode(np.array(r["ids"], dtype=np.int64), vocabulary)
        assert back in texts[r["doc_id"]] and vocabulary.processor.decode(r["ids"]) == back
        assert 0 < r["inclusion"] <= 1
    assert {r["doc_id"] for r in rows} == {i for i, _ in corpus}
    digests = pieces.segmentation_digests(docs(corpus), 3).collect()
    assert len(digests) == len(rows) and all(d["round_trip"] for d in digests)
    assert Counter((d["doc_id"], d["sample"], d["n_tokens"]) for d in digests) == Counter(
        (r["doc_id"], r["sample"], len(r["ids"])) for r in rows
    )
    assert pieces.sample_segmentations(docs([])).count() == 0


def test_every_row_of_a_large_batch_is_segmented(docs):
    """More rows in one partition than an Arrow batch holds, and than are sampled at a time."""
    n = 2_300
    rows = docs([(i, f"w{i} of many") for i in range(n)]).coalesce(1)
    for got in (pieces.sample_segmentations(rows, 2), pieces.segmentation_digests(rows, 2)):
        assert Counter(r["doc_id"] for r in got.select("doc_id").collect()) == Counter({i: 2 for i in range(n)})
