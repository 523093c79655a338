"""The filter audit against a brute-force version on hand-made rows."""

import re
from itertools import permutations

from meterfold.llm import audit

FILTERS = "ABCDE"


def brute(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    judged = []
    for i, t, s in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": re.search(r"[#$%&*|]", t) is not None,
            "E": i is not None and first[t] < i,
        }
        good = any(d == i and q == 1 for d, q, _ in labels if i is not None)
        toxic = any(d == i and x == 1 for d, _, x in labels if i is not None)
        judged.append((s or "", {f for f in FILTERS if fails[f]}, good, toxic))
    out, shapley = {}, {}
    for part in {p for p, *_ in judged}:
        own = [r for r in judged if r[0] == part]
        for order in map("".join, permutations(FILTERS)):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [r for r in own if f in r[1] and not r[1] & before]
                shapley[part, f] = shapley.get((part, f), 0) + len(removed)
                out[part, order, step] = [
                    sum(not r[1] & (before | {f}) for r in own),
                    len(removed),
                    sum(f in r[1] and bool(r[1] & before) for r in own),
                    sum(r[1] == {f} for r in own),
                    sum(r[2] for r in removed),
                    sum(r[3] for r in removed),
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def frames(spark, rows, labels):
    extra = [(*r, "x", 1, 2, "y") for r in rows]
    docs = spark.createDataFrame(extra, "doc_id bigint, text string, source string, part string, key int, step int, filter string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def compared(spark, rows, labels):
    docs, marks = frames(spark, rows, labels)
    got = audit.audit(docs, marks).collect()
    columns = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in columns) for r in got}
    assert len(found) == len(got)
    assert found == brute(rows, labels)
    return found


def test_audit(spark):
    long = " ".join(f"w{i}" for i in range(250))
    rows = [(1, long, "s"), (2, long, "s"), (3, long, None), (3, long, "s"), (None, long, "s"), (None, long, "s")]
    rows += [(10, "a b c", "s"), (11, None, "s"), (12, "", "t"), (13, "\n", "t"), (14, "same " * 300, "t"), (15, "X" * 9, "")]
    rows += [(20, long + " #", "t"), (21, long.upper(), "t"), (22, long.upper() + "|", "t"), (23, "é " * 199 + "ÀÉ", None)]
    rows += [(24, long + "\x0b" + long, "s"), (25, "word\x1cword " * 200, "s"), (26, long.upper() + "|", "s")]
    rows += [(30, "very " * 50_000 + "long", "s")]
    labels = [(2, 1, 0), (2, 0, 1), (3, 1, None), (10, None, 1), (21, 1, 1), (None, 1, 1), (99, 1, 1), (26, 1, 0)]
    found = compared(spark, rows, labels)
    assert {k[0] for k in found} == {"", "s", "t"}


def test_nothing_fails_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(300))
    found = compared(spark, [(1, text, "s")], [])
    assert all(v == (1, 0, 0, 0, 0, 0, 0) for v in found.values())
    docs, marks = frames(spark, [], [])
    assert audit.audit(docs, marks).collect() == []


def test_one_text_very_often(spark):
    compared(spark, [(i, "copy", "hot") for i in range(400)], [(5, 1, 1)])
