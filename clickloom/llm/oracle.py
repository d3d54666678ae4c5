"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from clickloom.llm.lexical import MOST
from clickloom.llm.merkle import ARCHIVE_RECORDS
from clickloom.llm.mixing import LEVELS, MOST_EPOCHS, NONE, SEED
from clickloom.llm.onebit import HIGHEST, LOWEST, POSITIVES, SCALE
from clickloom.llm.onebit import NEGATIVES as NEGATIVES_EACH
from clickloom.llm.production import (
    ALTERED,
    ANCHORS,
    DAMAGE,
    DOMAINS,
    LABELS,
    LOST,
    PERCENT,
    RELABELLED,
    TWICE,
    WEIGHTS,
)
from clickloom.llm.pstable import THRESHOLD

_RECORD = """'WARC/1.0' || e || 'WARC-Type: response' || e || 'WARC-Record-ID: <urn:page:' || page_id
 || '>' || e || 'WARC-Target-URI: ' || url || e || 'Content-Length: ' || strlen({held}) || e || e
 || {held} || e || e"""

MERKLE = f"""
WITH page AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, chr(13) || chr(10) AS e FROM pages),
held AS (
  SELECT *, CASE WHEN page_id % {DAMAGE} = {ALTERED} THEN html || '#' ELSE html END AS kept FROM page),
record AS (
  SELECT page_id // {ARCHIVE_RECORDS} AS archive, page_id,
    strlen({_RECORD.format(held="html")}) AS record_length,
    sha256({_RECORD.format(held="html")}) AS digest,
    sha256({_RECORD.format(held="kept")}) AS found_digest
  FROM held),
placed AS (
  SELECT *,
    CAST(coalesce(sum(record_length) OVER (PARTITION BY archive ORDER BY page_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS record_offset,
    CAST(sum(record_length) OVER (PARTITION BY archive) AS BIGINT) AS size
  FROM record)
SELECT archive, record_offset, page_id,
  CASE WHEN page_id % {DAMAGE} = {LOST} THEN 'missing' ELSE 'altered' END AS status, digest,
  CASE WHEN page_id % {DAMAGE} = {LOST} THEN NULL ELSE found_digest END AS found_digest
FROM placed WHERE page_id % {DAMAGE} = {LOST} OR digest <> found_digest
UNION ALL
SELECT archive, record_offset + size, page_id, 'extra', NULL, found_digest
FROM placed WHERE page_id % {DAMAGE} = {TWICE}
"""


def _given(depth: int) -> str:
    """Budgets of the nodes of a level, from those of the level above."""
    level, path = LEVELS[depth], ", ".join(LEVELS[: depth + 1])
    parent = ", ".join(LEVELS[:depth]) or "1"
    cases = " ".join(f"WHEN '{n}' THEN {w}" for n, w in WEIGHTS.get(level, {}).items())
    weight = f"CASE {level} {cases} ELSE 1 END" if cases else "1"
    nodes = f"SELECT {path}, sum(capacity) AS capacity, {weight} AS weight FROM leaf GROUP BY {path}"
    if depth:
        above = f"(SELECT {parent}, given AS budget FROM by_{LEVELS[depth - 1]})"
        nodes = f"SELECT * FROM ({nodes}) JOIN {above} USING ({parent})"
    else:
        nodes = f"SELECT *, (SELECT sum(tokens) * {PERCENT} // 100 FROM leaf) AS budget FROM ({nodes})"
    along = f"PARTITION BY {parent} ORDER BY capacity / weight, {level} ROWS BETWEEN"
    return f"""by_{level} AS (
  SELECT {path}, CASE WHEN is_full THEN capacity ELSE
    (budget - coalesce(sum(capacity) FILTER (is_full) OVER (PARTITION BY {parent}), 0)) * weight
    // sum(weight) FILTER (NOT is_full) OVER (PARTITION BY {parent}) END AS given
  FROM (SELECT * REPLACE (min(is_full) OVER ({along} UNBOUNDED PRECEDING AND CURRENT ROW) AS is_full)
    FROM (SELECT *, capacity * sum(weight) OVER ({along} CURRENT ROW AND UNBOUNDED FOLLOWING)
        <= (budget - coalesce(sum(capacity) OVER ({along} UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          * weight AS is_full
      FROM ({nodes}))))"""


_PATH = ", ".join(LEVELS)
_NAMES = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DOMAINS))

MIXING = f"""
WITH rows AS (
  SELECT doc_id,
    CASE TRY_CAST(nullif(regexp_extract(source, '^src([0-9]{{1,6}})$', 1), '') AS INT) // 5
      {_NAMES} ELSE '{NONE}' END AS domain,
    coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens
  FROM documents),
leaf AS (
  SELECT {_PATH}, sum(n_tokens) AS tokens, sum(n_tokens) * {MOST_EPOCHS} AS capacity
  FROM rows GROUP BY ALL),
{_given(0)},
{_given(1)},
{_given(2)},
budget AS (
  SELECT {_PATH}, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS full_epochs,
    CASE WHEN tokens > 0 THEN given % tokens ELSE 0 END AS rest
  FROM by_source JOIN leaf USING ({_PATH})),
drawn AS (
  SELECT *, md5('{SEED}:' || full_epochs || ':' || doc_id) AS place
  FROM rows JOIN budget USING ({_PATH})),
taken AS (
  SELECT *, greatest(0, least(n_tokens, rest - coalesce(sum(n_tokens) OVER (PARTITION BY {_PATH}
    ORDER BY place, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS partial_tokens
  FROM drawn)
SELECT doc_id, {_PATH}, n_tokens, CAST(full_epochs AS BIGINT) AS full_epochs,
  CAST(partial_tokens AS BIGINT) AS partial_tokens,
  CAST(full_epochs * n_tokens + partial_tokens AS BIGINT) AS selected_tokens
FROM taken
"""

_USABLE = "vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"

NEGATIVES = f"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % {RELABELLED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND {_USABLE}),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % {ANCHORS} = 0),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND {LOWEST} * positive_score <= 100 * score AND 100 * score <= {HIGHEST} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= {NEGATIVES_EACH}
"""

COSINES = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE {_USABLE} AND len([x FOR x IN embedding IF x <> 0]) > 0),
link AS (
  SELECT a.vec_id, b.vec_id AS other FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT reach.vec_id, link.other FROM reach JOIN link ON link.vec_id = reach.other)
SELECT vec_id, (SELECT count(*) FROM link WHERE link.vec_id = reach.vec_id) AS n_links,
  min(other) AS component_id, vec_id = min(other) AS kept
FROM reach GROUP BY vec_id
"""

_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_TERMS = f"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) AS term"""

LEXICAL = f"""
WITH posting AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS} FROM documents) GROUP BY ALL),
doc AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM posting GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM doc),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM posting, whole GROUP BY term),
norm AS (SELECT doc_id, 100 - 75 + (75 * n * docs) // terms AS m FROM doc, whole),
wanted AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_TERMS} FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM wanted JOIN weight USING (term) JOIN posting USING (term) JOIN norm USING (doc_id)
  GROUP BY item_id, doc_id)
SELECT item_id, doc_id, score,
  CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= {MOST}
"""

ORACLE: dict[str, str] = {
    "op1_merkle_audit": MERKLE,
    "op6_hierarchical_mixing": MIXING,
    "op11_one_bit_codes": NEGATIVES,
    "op12_pstable_hashing": COSINES,
    "op13_presence_masks": LEXICAL,
}
