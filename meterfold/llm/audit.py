"""How filters interact: what each removes after every set of others, from tables of failing ids.

Each filter is judged once, on the whole table, and stores the ids that fail it. Which rows are left
after some filters does not depend on their order, so the 120 orders of five filters share 32
prefixes: survivors of a prefix are a left anti join with the last filter's ids, what the next
filter removes is a left semi join of its ids with the survivors, and what it would remove but finds
gone is a left anti join. All prefixes of one length go through one join, with the prefix as a
column, and only counts by part leave the joins.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterfold.llm.common import or_empty
from meterfold.session import fresh_path, materialise

_SPACE = "\\x20\\x09-\\x0D"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The bounds of the filters.
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
MARKS = "[#$%&*|]"
TEXT_FILTERS, COPIES = ("A", "B", "C", "D"), "E"


def words_of(text: Column) -> Column:
    """Maximal runs without ASCII white space, as they are written."""
    # split leaves an empty word before leading and after trailing white space
    return F.array_remove(F.split(text, f"[{_SPACE}]+"), "")


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """By filter, whether a text that is not absent fails it: too few words, repetitive, capitals, marks."""
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * capitals > MOST_CAPITALS * F.length(text),
        "D": text.rlike(MARKS),
    }


def _judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, doc_id, part, good, toxic, digest`` of each row and whether it fails A to D; texts are read once and stay behind."""
    texts = docs.select("doc_id", or_empty(F.col("source")).alias("part"), or_empty(F.col("text")).alias("text"))
    filters = text_filters(F.col("text"), F.col("words"))
    rows = texts.withColumn("words", words_of(F.col("text"))).select(
        F.monotonically_increasing_id().alias("key"),
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        *[failing.alias(name) for name, failing in filters.items()],
    )
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    # keys are numbered once: what follows reads the written table
    return materialise(rows.join(marks, "doc_id", "left"), "audit-rows").withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")}
    )


def _copies(rows: DataFrame) -> DataFrame:
    """Rows whose text some smaller ``doc_id`` has too.

    A digest of very many rows is one row on the small side. That side is stored first: AQE splits
    the hot digest only in a join whose sides are shuffled for it.
    """
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    first = materialise(first.select("digest", "first"), "audit-copies")
    return rows.join(first, "digest").filter(F.col("doc_id") > F.col("first")).drop("first")


def store_failing_ids(rows: DataFrame) -> DataFrame:
    """``filter, key, part, good, toxic``: one table of failing rows per filter, each in a folder of its own."""
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "failing-ids")
    columns = ["filter", "key", "part", "good", "toxic"]
    failed = F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in TEXT_FILTERS]))
    texts = rows.withColumn("filter", F.explode(failed)).select(*columns)
    texts.write.partitionBy("filter").parquet(path)
    _copies(rows).withColumn("filter", F.lit(COPIES)).select(*columns).write.mode("append").partitionBy("filter").parquet(path)
    schema = "key bigint, part string, good boolean, toxic boolean, filter string"
    return spark.read.schema(schema).parquet(path)


def _counts(rows: DataFrame, by: list[str], **further: Column) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(n) for n, c in further.items()])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per ``part``, ``filter_order`` and ``step`` of the five filters A to E on whole texts.

    ``kept`` rows remain after the step; its filter ``removed`` rows and would have removed
    ``redundant`` ones that an earlier filter took; ``unique_fails`` fail no other filter;
    ``good_lost`` and ``toxic_lost`` are the removed ones with that label; ``shapley`` is what the
    filter removes over all orders. All are counts within the part.

    Edge cases: an absent text is empty (no words: it fails A alone, and E where another empty text
    has a smaller id); an absent source is the part of the empty one; a row without id has no label,
    is never a copy and makes no other one; rows of one id are rows of their own and copies only of
    smaller ids; several labels of one id count if one does; an empty table gives no rows; other
    columns are not read.

    Joins carry ids and never texts, and are on the row's own key, which is unique, so no key is
    hot. Equal texts meet in one row of the first join, whose other side is split by AQE.
    """
    rows = _judged(docs, labels)
    failing = store_failing_ids(rows)
    letters = "ABCDE"

    # survivors of every prefix, those of one length from those of the last by one anti join
    alive = rows.select(F.lit("").alias("prefix"), "key", "part")
    survivors = [alive]
    ids = failing.select("filter", "key")
    for _ in letters:
        # each set once: filters are added in ascending order
        later = F.array(*[F.lit(c) for c in letters])
        longer = alive.withColumn("filter", F.explode(F.filter(later, lambda c: c > F.substring("prefix", -1, 1))))
        alive = longer.join(ids, ["filter", "key"], "left_anti").select(
            F.concat("prefix", "filter").alias("prefix"), "key", "part"
        )
        alive = materialise(alive, "audit-survivors")
        survivors.append(alive)
    kept = None
    for level in survivors:
        counted = _counts(level, ["prefix", "part"])
        kept = counted if kept is None else kept.unionByName(counted)
    kept = materialise(kept.withColumnRenamed("n", "kept"), "audit-kept")

    # each failing row meets every prefix without its filter
    sets = [p for n in range(len(letters)) for p in sorted({"".join(sorted(o)) for o in permutations(letters, n)})]
    prefixes = F.filter(F.array(*[F.lit(p) for p in sets]), lambda p: ~p.contains(F.col("filter")))
    facing = failing.withColumn("prefix", F.explode(prefixes))
    standing = survivors[0].select("prefix", "key")
    for level in survivors[1:-1]:
        standing = standing.unionByName(level.select("prefix", "key"))
    by = ["prefix", "filter", "part"]
    removed = facing.join(standing, ["prefix", "key"], "left_semi")
    gone = facing.join(standing, ["prefix", "key"], "left_anti")
    removed = _counts(removed, by, good_lost=F.col("good"), toxic_lost=F.col("toxic")).withColumnRenamed("n", "removed")
    gone = _counts(gone, by).withColumnRenamed("n", "redundant")
    steps = materialise(removed.join(gone, by, "full_outer"), "audit-steps")

    others = {f: "".join(c for c in letters if c != f) for f in letters}
    alone = F.col("prefix") == F.create_map(*[F.lit(x) for f in letters for x in (f, others[f])])[F.col("filter")]
    # a set of k filters comes before the filter in k! (4 - k)! orders
    orders = F.array(*[F.lit(factorial(k) * factorial(len(letters) - 1 - k)) for k in range(len(letters))])
    share = F.coalesce("removed", F.lit(0)) * F.element_at(orders, F.length("prefix") + 1)
    whole = steps.groupBy("filter", "part").agg(
        F.sum(share).alias("shapley"), F.sum(F.when(alone, F.coalesce("removed", F.lit(0))).otherwise(0)).alias("unique_fails")
    )

    plan = [
        {"filter_order": order, "step": n, "filter": order[n - 1], "prefix": "".join(sorted(order[: n - 1])), "after": "".join(sorted(order[:n]))}
        for order in map("".join, permutations(letters))
        for n in range(1, len(letters) + 1)
    ]
    row = F.from_json(F.lit(json.dumps(plan)), "array<struct<filter_order string, step int, filter string, prefix string, after string>>")
    report = kept.filter("prefix = ''").select("part", F.explode(row).alias("p")).select("part", "p.*")
    after = kept.withColumnRenamed("prefix", "after")
    long = {
        c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
        for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    }
    return (
        report.join(after, ["part", "after"], "left")
        .join(steps, ["part", "prefix", "filter"], "left")
        .join(whole, ["part", "filter"], "left")
        .select("part", "filter_order", "step", *long.values())
    )
