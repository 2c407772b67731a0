"""DuckDB SQL for the queries that SQL can express; each says anew what the operator has to find."""

from __future__ import annotations

from shoplake.llm.secret_scan import BASE_RULES, MORE_RULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    return (
        f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {words("text")} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, w, least(13, len(w)) AS size
      FROM (SELECT item_id, {words("text")} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, size, list_slice(w, p, p + size - 1) AS win
       FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM i)),
dw AS (SELECT doc_id, size, p, list_slice(w, p, p + size - 1) AS win
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
             FROM d CROSS JOIN (SELECT DISTINCT size FROM i) WHERE len(w) >= size)),
hits AS (SELECT doc_id, item_id, size, p FROM dw JOIN iw USING (size, win)),
covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + size)) AS place FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {words("text")} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, list_slice(w, p, p + least(5, len(w)) - 1) AS gram
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p
            FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
sets AS (SELECT doc_id, md5(string_agg(CAST(gram AS VARCHAR), '|' ORDER BY gram)) AS kind FROM g GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
           FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE common >= 0.8 * (x.n + y.n - common)),
reach AS (SELECT doc_id, doc_id AS other FROM d
          UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
classes AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id),
counts AS (SELECT a AS doc_id, count(*) AS n_links,
                  count(DISTINCT y.kind) FILTER (y.kind <> x.kind) AS n_text_links
           FROM links JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n_text_links, 0) AS n_text_links,
       coalesce(n, 0) AS n_grams
FROM d JOIN classes USING (doc_id) LEFT JOIN counts USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def spans_of() -> str:
    """(doc_id, place, kind, start, end) of every match that is long enough."""
    parts = []
    for place, rule in enumerate(BASE_RULES + MORE_RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"""SELECT doc_id, {place} AS place, '{rule.kind}' AS kind,
       list_sum(list_transform(gaps[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS a,
       length(whole[i]) AS size
FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i
      FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps,
                   regexp_extract_all(t, '{pattern}') AS whole,
                   regexp_extract_all(t, '{pattern}', {rule.group}) AS measured
            FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)))
WHERE length(measured[i]) >= {rule.least}"""
        )
    return " UNION ALL ".join(parts)


SECRETS = f"""
WITH found AS ({spans_of()}),
told AS (SELECT *, kind || ':' || CAST(a AS BIGINT) || ':' || CAST(a + size AS BIGINT) AS span FROM found),
per_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY a, place) FILTER (place < {len(BASE_RULES)}) AS base,
         string_agg(span, ',' ORDER BY a, place) AS spans FROM told GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, sha256(coalesce(text, '')) AS blob
FROM documents LEFT JOIN per_doc USING (doc_id)
"""

CHAT = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(nullif(role, ''), 'unknown') AS speaker,
                  regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '<| \1|>', 'g') AS text
           FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS participant FROM t WHERE speaker <> 'system'),
lines AS (
  SELECT conv_id, participant, turn, speaker, text,
         '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = participant
           THEN 'assistant' ELSE 'user name=' || regexp_replace(speaker, '[^\p{L}\p{N}_-]', '_', 'g') END
           || chr(10) AS head, text || '<|im_end|>' AS body
  FROM t JOIN people USING (conv_id)),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, participant
            ORDER BY turn NULLS FIRST, speaker, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            + length(head) AS a FROM lines),
parts AS (
  SELECT conv_id, participant, turn // 256 AS part, count(*) AS n_turns,
         min(a - length(head)) AS start,
         string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, speaker, text) AS text,
         string_agg(CAST(a AS BIGINT) || ':' || CAST(a + length(body) AS BIGINT), ','
                    ORDER BY turn NULLS FIRST, speaker, text) FILTER (speaker = participant) AS masks
  FROM placed GROUP BY conv_id, participant, turn // 256)
SELECT conv_id, participant, part, n_turns, CAST(start AS BIGINT) AS start, text,
       coalesce(masks, '') AS masks FROM parts
"""

MIXING = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (
  SELECT source, sum(size)::DOUBLE AS n, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind
  FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][kind + 1] AS weight FROM s),
rounds AS (
  SELECT 0 AS k, (SELECT sum(n) / sum(weight) FROM w) AS level
  UNION
  SELECT k + 1, (SELECT (sum(n) - coalesce(sum(3 * n) FILTER (3 * n < weight * level), 0))
                        / sum(weight) FILTER (NOT 3 * n < weight * level) FROM w)
  FROM rounds WHERE EXISTS (SELECT 1 FROM w WHERE 3 * n < weight * level) AND k < (SELECT count(*) FROM w)),
t AS (SELECT *, least(3 * n, weight * (SELECT arg_max(level, k) FROM rounds)) AS target FROM w),
placed AS (
  SELECT d.doc_id, d.size, t.n AS source_size, t.target, t.kind, md5(coalesce(d.doc_id::VARCHAR, '')) AS h,
         coalesce(sum(size) OVER (PARTITION BY t.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
takes AS (
  SELECT *, k * source_size + before AS a,
         greatest(least(size, round(target) - (k * source_size + before)), 0) AS words
  FROM placed, range(3) AS r(k)),
shares AS (SELECT *, (a + words / 2.0::DOUBLE) / target AS y FROM takes WHERE words > 0),
positions AS (
  SELECT *, least(CASE kind
    WHEN 0 THEN 2.0::DOUBLE * (y * 5.0::DOUBLE) / (7.5::DOUBLE + sqrt(greatest(56.25::DOUBLE - 10.0::DOUBLE * (y * 5.0::DOUBLE), 0)))
    WHEN 1 THEN 2.0::DOUBLE * (y * 2.0::DOUBLE) / (2.0::DOUBLE + sqrt(4.0::DOUBLE))
    ELSE 2.0::DOUBLE * y / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2.0::DOUBLE * y)) END, 1.0::DOUBLE) AS position FROM shares),
ordered AS (
  SELECT *, coalesce(sum(words) OVER (ORDER BY position, h, doc_id, k
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM positions),
told AS (
  SELECT doc_id, sum(words)::BIGINT AS taken, count(*) AS n_takes, min(first)::BIGINT AS first_at
  FROM ordered GROUP BY doc_id)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, coalesce(taken, 0) AS taken,
       coalesce(n_takes, 0) AS n_takes, first_at
FROM placed LEFT JOIN told USING (doc_id)
"""

PHRASES = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                               '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, k, list_slice(w, i, i + k - 1) AS phrase
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 5) AS r(k) WHERE len(w) >= k))
  GROUP BY lang, k, phrase),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM g WHERE f >= 30),
inside AS (
  SELECT lang, part, max(f) AS most
  FROM (SELECT lang, f, list_slice(phrase, i, i + m - 1) AS part
        FROM (SELECT lang, f, phrase, m, unnest(range(1, k - m + 2)) AS i FROM c, range(2, 4) AS r(m) WHERE m < k))
  GROUP BY lang, part),
cuts AS (
  SELECT x.lang, x.phrase, x.f AS a, j, y.f AS l, z.f AS r, 2000000::HUGEINT * x.f // (y.f + z.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c WHERE k > 1) x
  JOIN c y ON y.lang = x.lang AND y.phrase = list_slice(x.phrase, 1, j)
  JOIN c z ON z.lang = x.lang AND z.phrase = list_slice(x.phrase, j + 1, x.k)),
worst AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM cuts)
  WHERE place = 1),
kept AS (
  SELECT worst.*, list_aggregate(worst.phrase, 'string_agg', ' ') AS told
  FROM worst LEFT JOIN inside ON inside.lang = worst.lang AND inside.part = worst.phrase
  WHERE most IS NULL OR 100 * most < 80 * a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(told)) AS rank FROM kept)
SELECT lang, rank, told AS phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN t USING (lang) WHERE rank <= 2000
"""

LLM_ORACLE: dict[str, str] = {
    "op2_decontaminate": DECONTAMINATE,
    "op3_jaccard": JACCARD,
    "op6_secrets": SECRETS,
    "op8_chat": CHAT,
    "op12_phrases": PHRASES,
    "op13_mixing": MIXING,
}
