"""URL filters: host and path rules, and a weighted vocabulary searched with Aho-Corasick."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterfold.llm.common import map_batches

ALLOW, BLOCK = "allow", "block"

# Rules by host and path start; the longest that fits decides.
RULES = {
    "com/": ALLOW,
    "example.com/en/": BLOCK,
    "www.example.com/en/": ALLOW,
    "net/es/": BLOCK,
    "net/fr/": BLOCK,
}


@dataclass(frozen=True)
class Vocabulary:
    """Terms in lower case. One strict hit rejects; so do distinct soft hits of enough weight in sum."""

    strict: tuple[str, ...] = ("casino", "porn", "xxx", "viagra", "pills", "escort", "spam")
    soft: tuple[tuple[str, int], ...] = (
        ("ads", 1), ("bets", 1), ("bonus", 1), ("cheap", 1), ("click", 1), ("deal", 1), ("farm", 1),
        ("free", 1), ("loan", 1), ("poker", 1), ("promo", 1), ("track", 1), ("win", 1),
    )
    soft_weight: int = 2

    def __post_init__(self):
        terms = [*self.strict, *(t for t, _ in self.soft)]
        if any(not t or t != t.lower() for t in terms) or len({*terms}) < len(terms):
            raise ValueError("terms must be distinct, lower-case and not empty")


@lru_cache(maxsize=8)
def _automaton(vocabulary: Vocabulary) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for term in vocabulary.strict:
        automaton.add_word(term, (len(term), term, 0))
    for term, weight in vocabulary.soft:
        automaton.add_word(term, (len(term), term, weight))
    automaton.make_automaton()
    return automaton


def _ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else text.encode().lower().decode()


def _inside_word(char: str) -> bool:
    return char.isascii() and char.isalnum()


def term_hits(url: str | None, vocabulary: Vocabulary) -> tuple[int, int]:
    """Distinct strict terms in the URL, and the weight of the distinct soft ones.

    A term counts only between boundaries: no ASCII letter or digit may touch it.
    """
    text = _ascii_lower(url or "")
    strict, soft = set(), {}
    for last, (length, term, weight) in _automaton(vocabulary).iter(text) if text else ():
        first = last - length + 1
        if first and _inside_word(text[first - 1]) or last + 1 < len(text) and _inside_word(text[last + 1]):
            continue
        if weight:
            soft[term] = weight
        else:
            strict.add(term)
    return len(strict), sum(soft.values())


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``; A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule whose host is the URL's or a parent domain of it and whose path begins the URL's."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + start))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def judge_urls(pages: DataFrame, rules: dict[str, str] | None = None, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """The verdict on each row of ``pages(page_id, url)``.

    Returns ``page_id, host, path, rule, verdict, strict_hits, soft_weight``. The longest rule that
    fits decides; without one the vocabulary does: ``block`` on a strict term or on distinct soft
    terms that together reach ``vocabulary.soft_weight``, else ``allow``.

    Edge cases: an absent URL or one without ``://`` has an empty host and path, fits no rule and
    is judged by the terms it holds; repeated rows and absent ids are kept as they are; an empty
    table gives no rows; other columns are not read. The hits are counted in the whole URL.
    """
    rules = RULES if rules is None else rules

    def count(rows: pa.Table) -> pa.Table:
        hits = [term_hits(u, vocabulary) for u in rows["url"].to_pylist()]
        rows = rows.append_column("strict_hits", pa.array([h[0] for h in hits], pa.int32()))
        return rows.append_column("soft_weight", pa.array([h[1] for h in hits], pa.int32()))

    chosen = pages.select("page_id", F.col("url").cast("string").alias("url"))
    kind = chosen.schema["page_id"].dataType.simpleString()
    counted = map_batches(chosen, count, f"page_id {kind}, url string, strict_hits int, soft_weight int")
    split = counted.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "strict_hits", "soft_weight"
    )
    ruled = split.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    rejected = (F.col("strict_hits") > 0) | (F.col("soft_weight") >= vocabulary.soft_weight)
    by_terms = F.when(rejected, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return ruled.select(
        "page_id", "host", "path", "rule", F.coalesce(by_rule, by_terms).alias("verdict"), "strict_hits", "soft_weight"
    )
