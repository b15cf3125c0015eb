"""The registered queries of this subpackage and their SQL twins, over whole tables."""

from __future__ import annotations

from itertools import permutations

from mentionkit.llm import (
    chat, decontamination, filter_audit, hard_negatives, minhash, mixing, quality, secrets, simhash, token_counts, toxicity, url_filters, warc,
)
from mentionkit.llm.common import read


def op1_secret_scan(spark, sf):
    return secrets.secret_report(read(spark, sf, "documents"))


def op2_simhash(spark, sf):
    return simhash.group_report(read(spark, sf, "documents"))


def op3_decontamination(spark, sf):
    return decontamination.contaminated(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op4_chat_format(spark, sf):
    return chat.chat_report(read(spark, sf, "conversations"))


def op5_quality_rules(spark, sf):
    return quality.quality_report(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op6_token_counts(spark, sf):
    return token_counts.length_report(read(spark, sf, "documents"))


def op7_toxicity(spark, sf):
    return toxicity.toxicity_report(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op8_warc(spark, sf):
    return warc.archive_report(read(spark, sf, "pages"))


def op9_url_filter(spark, sf):
    return url_filters.judge(read(spark, sf, "pages"), url_filters.rules_frame(spark))


def op10_source_mix(spark, sf):
    rows = mixing.mix(read(spark, sf, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_minhash(spark, sf):
    return minhash.near_groups(read(spark, sf, "documents"))


def op12_hard_negatives(spark, sf):
    return hard_negatives.mine(read(spark, sf, "embeddings"))


def op13_filter_audit(spark, sf):
    return filter_audit.audit(read(spark, sf, "documents"), read(spark, sf, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_simhash, op3_decontamination, op4_chat_format, op5_quality_rules, op6_token_counts,
        op7_toxicity, op8_warc, op9_url_filter, op10_source_mix, op11_minhash, op12_hard_negatives, op13_filter_audit,
    )
}


def _chat_sql() -> str:
    def escaped(column: str) -> str:
        out = f"replace({column}, '\\', '\\\\')"
        for c in chat.CONTROL:
            out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
        return out

    marks = len(chat.START + chat.SEP + chat.END)
    check = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in chat.CONTROL_CHECK)
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {check})
), pieces AS (
  SELECT *, length({escaped('role')}) + length({escaped('text')}) + {marks} AS n FROM turns
), sums AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM pieces
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars,
  count(*) FILTER (role = 'assistant') AS n_examples,
  coalesce(sum(upto) FILTER (role = 'assistant'), 0)::BIGINT AS example_chars
FROM sums GROUP BY conv_id"""


_WARC = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), q AS (
  SELECT *, CASE WHEN payload_bytes >= {warc.LEAST} THEN max(page_id) OVER (PARTITION BY payload_digest) END AS kept FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM q"""

_URLS = f"""
WITH p AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1) AS h,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages
), k AS (SELECT page_id, translate(h, '{url_filters.UPPER}', '{url_filters.LOWER}') AS host, path FROM p),
r(action, rhost, rpath) AS (VALUES {", ".join(map(str, url_filters.RULES))}),
hits AS (
  SELECT host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(action, length(rhost || rpath)) AS action
  FROM (SELECT DISTINCT host, path FROM k) JOIN r ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath) GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM k LEFT JOIN hits USING (host, path)"""

_WORD = r"[^\x20\x09-\x0D]+"

_MINHASH = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{url_filters.UPPER}', '{url_filters.LOWER}') AS text FROM documents
), w AS (SELECT r, doc_id, regexp_extract_all(text, '{_WORD}') AS w FROM d
), s AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w
), sets AS (SELECT s, list_sort(s) AS k, min(r) AS c FROM s WHERE len(s) > 0 GROUP BY ALL
), classes AS (SELECT k, min(c) AS c, any_value(len(s)) AS n FROM sets GROUP BY k
), docs AS (SELECT s.doc_id, len(s.s) AS n_shingles, c FROM s LEFT JOIN classes ON list_sort(s.s) = classes.k AND len(s.s) > 0
), e AS (SELECT c, n, unnest(k) AS v FROM classes
), pairs AS (
  SELECT a.c AS a, b.c AS b FROM e a JOIN e b ON a.v = b.v AND a.c < b.c AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {minhash.PERCENT}
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= {minhash.PERCENT} * (a.n + b.n - count(*))
), links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs
), reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT reach.a AS c, min(docs.doc_id) AS component_id FROM reach JOIN docs ON docs.c = reach.b GROUP BY reach.a
), out AS (
  SELECT doc_id, n_shingles::BIGINT AS n_shingles, CASE WHEN docs.c IS NULL THEN doc_id ELSE component_id END AS component_id
  FROM docs LEFT JOIN least USING (c)
)
SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM out"""

_MINING = f"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, list_dot_product(a.q, x.q)::BIGINT AS score
  FROM r a JOIN r x ON a.vec_id % {hard_negatives.EVERY} = 0 AND len(a.q) = len(x.q) AND a.vec_id <> x.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {hard_negatives.POSITIVES}
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {hard_negatives.LOW} * positive_score <= 100 * score AND 100 * score <= {hard_negatives.HIGH} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= {hard_negatives.NEGATIVES}"""


def _audit_sql() -> str:
    names = filter_audit.FILTERS
    steps = [
        f"('{''.join(order)}', {k + 1}, {1 << names.index(f)}, {sum(1 << names.index(g) for g in order[:k])})"
        for order in permutations(names) for k, f in enumerate(order)
    ]
    return f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS w FROM d
), l AS (SELECT doc_id, bool_or(quality IS NOT NULL AND quality = 1) AS good, bool_or(toxic IS NOT NULL AND toxic = 1) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT doc_id, part, (len(w) < {filter_audit.LEAST_WORDS})::INT
    + 2 * (100 * len(list_distinct(w)) < {filter_audit.DISTINCT_PERCENT} * len(w))::INT
    + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {filter_audit.CAPITAL_PERCENT} * length(text))::INT
    + 8 * regexp_matches(text, '[{filter_audit.SYMBOLS}]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask FROM w
), c AS (
  SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL
), s(filter_order, step, bit, before) AS (VALUES {", ".join(steps)}
), f AS (SELECT *, (mask & bit) <> 0 AS fails, (mask & before) <> 0 AS gone FROM c, s)
SELECT part, filter_order, step,
  coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(n) FILTER (fails AND NOT gone AND good), 0)::BIGINT AS good_lost,
  coalesce(sum(n) FILTER (fails AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) FILTER (fails), 0)::BIGINT AS shapley
FROM f GROUP BY part, filter_order, step"""


ORACLES = {
    "op11_minhash": _MINHASH, "op12_hard_negatives": _MINING, "op13_filter_audit": _audit_sql(), "op4_chat_format": _chat_sql(), "op8_warc": _WARC, "op9_url_filter": _URLS,
}
