"""The registered queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from meterfold.llm import audit, embeddings, exact, first_fit, jaccard, lm, packing, pieces, sharding, tokens, toxicity, urls, whitening
from meterfold.llm.common import table


def op1_stupid_backoff(spark, sf_dir):
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op2_token_files(spark, sf_dir):
    return tokens.round_trip(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_rendezvous_sharding(spark, sf_dir):
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_embedding_near_dedup(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_gumbel_segmentation(spark, sf_dir):
    return pieces.segmentation_digests(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark, sf_dir):
    return exact.deduplicate(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark, sf_dir):
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"))


def op10_url_filter(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op11_first_fit_packing(spark, sf_dir):
    return first_fit.pack(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark, sf_dir):
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_stupid_backoff,
        op2_token_files,
        op3_best_fit_packing,
        op4_rendezvous_sharding,
        op5_toxicity,
        op6_embedding_near_dedup,
        op7_gumbel_segmentation,
        op8_exact_dedup,
        op9_ngram_jaccard,
        op10_url_filter,
        op11_first_fit_packing,
        op12_embedding_whitening,
        op13_filter_audit,
    )
}
LLM_QUERIES["pipeline"] = corpus_pipeline.run

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _sharding_sql() -> str:
    def ticket(shard: int) -> str:
        digits = f"substr(md5(concat(coalesce(doc_id::varchar, 'null'), '#{shard}')), 1, 13)"
        return f"{{'cost': -ln((('0x' || {digits})::bigint + 0.5) / {2.0**52}), 'shard': {shard}}}"

    base = ", ".join(ticket(s) for s in range(sharding.SHARDS))
    return f"""
WITH polynomial AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda acc, k: CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END, i) AS c
    FROM range(256) r(i))
), bytes AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS h FROM documents
), summed AS (
  SELECT doc_id, octet_length(b) + 1 AS size,
    xor(list_reduce(list_transform(range(octet_length(b)), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint),
      lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM bytes, polynomial
), placed AS (
  SELECT *, least({base}) AS now, least({base}, {ticket(sharding.SHARDS)}) AS later FROM summed
)
SELECT doc_id, size::bigint AS size, text_crc32, 'key' AS law, now.shard AS shard,
  row_number() OVER (PARTITION BY now.shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
  later.shard AS grown_shard
FROM placed"""


def _url_sql() -> str:
    v = urls.Vocabulary()

    def hit(term: str) -> str:
        return f"regexp_matches(u, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::int"

    rules = " ".join(
        f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) "
        f"AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
        for r in sorted(urls.RULES, key=len, reverse=True)
    )
    verdicts = " ".join(f"WHEN rule = '{r}' THEN '{w}'" for r, w in urls.RULES.items())
    return f"""
WITH split AS (
  SELECT page_id, coalesce(translate(url, {_LOWER}), '') AS u,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), {_LOWER}) AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), judged AS (
  SELECT page_id, host, path, CASE {rules} END AS rule,
    {" + ".join(hit(t) for t in v.strict)} AS strict_hits,
    {" + ".join(f"{w} * {hit(t)}" for t, w in v.soft)} AS soft_weight
  FROM split
)
SELECT page_id, host, path, rule,
  CASE {verdicts} WHEN strict_hits > 0 OR soft_weight >= {v.soft_weight} THEN 'block' ELSE 'allow' END AS verdict,
  strict_hits, soft_weight
FROM judged"""


LLM_ORACLES = {
    "op1_stupid_backoff": f"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {_LOWER}), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), corpus AS (SELECT sum(len(w)) AS n FROM split
), positions AS (SELECT doc_id, len(w) AS n_words, unnest(w) AS word, unnest(list_prepend(NULL, w[:-2])) AS before FROM split
), unigrams AS (SELECT word, count(*) AS c FROM positions GROUP BY word
), own_unigrams AS (SELECT doc_id, word, count(*) AS c FROM positions GROUP BY doc_id, word
), bigrams AS (SELECT before, word, count(*) AS c FROM positions WHERE before IS NOT NULL GROUP BY before, word
), own_bigrams AS (SELECT doc_id, before, word, count(*) AS c FROM positions WHERE before IS NOT NULL GROUP BY doc_id, before, word
), counted AS (
  SELECT p.doc_id, p.before, corpus.n - p.n_words AS rest, u.c - ou.c AS word_c, b.c - ob.c AS pair_c, x.c - ox.c AS context_c
  FROM positions p CROSS JOIN corpus
  JOIN unigrams u ON u.word = p.word JOIN own_unigrams ou ON ou.doc_id = p.doc_id AND ou.word = p.word
  LEFT JOIN bigrams b ON b.before = p.before AND b.word = p.word
  LEFT JOIN own_bigrams ob ON ob.doc_id = p.doc_id AND ob.before = p.before AND ob.word = p.word
  LEFT JOIN unigrams x ON x.word = p.before LEFT JOIN own_unigrams ox ON ox.doc_id = p.doc_id AND ox.word = p.before
), scored AS (
  SELECT doc_id, sum(CASE WHEN pair_c > 0 THEN ln(pair_c / context_c)
      ELSE CASE WHEN before IS NULL THEN 0 ELSE ln({lm.BACKOFF}) END
        + CASE WHEN word_c > 0 THEN ln(word_c / rest) ELSE -ln(rest + 1) END END) AS s,
    count_if(pair_c > 0) AS n_seen, count_if(word_c = 0 AND coalesce(pair_c, 0) = 0) AS n_unseen
  FROM counted GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_seen, 0)::bigint AS n_seen, coalesce(n_unseen, 0)::bigint AS n_unseen,
  round(coalesce(s, 0), 6) AS log_score, CASE WHEN len(w) > 0 THEN round(s / len(w), 6) END AS per_word
FROM split LEFT JOIN scored USING (doc_id)""",
    "op4_rendezvous_sharding": _sharding_sql(),
    "op6_embedding_near_dedup": """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::double[] AS v, sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))) AS norm
  FROM embeddings
), pairs AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
  ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v) AND list_inner_product(x.v, y.v) >= 0.95 * x.norm * y.norm
  WHERE x.norm > 0 AND y.norm > 0
), reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM vectors
  UNION SELECT reach.node, pairs.b FROM reach JOIN pairs ON reach.seen = pairs.a
), components AS (SELECT node AS vec_id, min(seen) AS component_id FROM reach GROUP BY node
), links AS (SELECT a AS vec_id, count(*) AS n_links FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN components USING (vec_id) LEFT JOIN links USING (vec_id)""",
    "op8_exact_dedup": f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, h AS text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), {_LOWER})) AS h FROM documents)
WINDOW same AS (PARTITION BY h)""",
    "op9_ngram_jaccard": f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {_LOWER}), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM split
), incidence AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM incidence x JOIN incidence y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT reach.node, pairs.b FROM reach JOIN pairs ON reach.seen = pairs.a
)
SELECT doc_id, len(s) AS n_shingles, component_id
FROM sets JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node) USING (doc_id)""",
    "op10_url_filter": _url_sql(),
    "op13_filter_audit": """
WITH RECURSIVE split AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), failed AS (
  SELECT doc_id, part, list_filter([
    CASE WHEN len(w) < 200 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END], lambda f: f IS NOT NULL) AS f
  FROM split
), marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, f, count(*) AS n, count_if(good) AS n_good, count_if(toxic) AS n_toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, f
), orders AS (
  SELECT '' AS filter_order
  UNION ALL SELECT filter_order || l FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE NOT contains(filter_order, l)
), steps AS (
  SELECT filter_order, step::int AS step, filter_order[step] AS f, string_split(filter_order[:step - 1], '') AS before,
    string_split(filter_order[:step], '') AS after
  FROM orders, range(1, 6) r(step) WHERE length(filter_order) = 5
), counted AS (
  SELECT c.part, s.filter_order, s.step, s.f,
    sum(CASE WHEN NOT list_has_any(c.f, s.after) THEN c.n ELSE 0 END) AS kept,
    sum(CASE WHEN list_contains(c.f, s.f) AND NOT list_has_any(c.f, s.before) THEN c.n ELSE 0 END) AS removed,
    sum(CASE WHEN list_contains(c.f, s.f) AND list_has_any(c.f, s.before) THEN c.n ELSE 0 END) AS redundant,
    sum(CASE WHEN c.f = [s.f] THEN c.n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN list_contains(c.f, s.f) AND NOT list_has_any(c.f, s.before) THEN c.n_good ELSE 0 END) AS good_lost,
    sum(CASE WHEN list_contains(c.f, s.f) AND NOT list_has_any(c.f, s.before) THEN c.n_toxic ELSE 0 END) AS toxic_lost
  FROM cells c, steps s GROUP BY ALL
)
SELECT part, filter_order, step, kept::bigint AS kept, removed::bigint AS removed, redundant::bigint AS redundant,
  unique_fails::bigint AS unique_fails, good_lost::bigint AS good_lost, toxic_lost::bigint AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::bigint AS shapley
FROM counted""",
}
if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
