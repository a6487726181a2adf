"""DuckDB SQL with the results of the text queries that SQL can express."""

from __future__ import annotations

from tallycast.llm.chat_format import ESCAPE, INSTRUCTION, TRIAL_ID, TRIAL_TEXT, Template
from tallycast.llm.decontamination import COVERAGE, WINDOW
from tallycast.llm.hard_negatives import HIGHEST, LOWEST, NEGATIVES, POSITIVES, STEPS
from tallycast.llm.mixing import MIX_SHARE, MOST_PASSES, SCHEDULES, WEIGHTS
from tallycast.llm.vector_dedup import THRESHOLD


def _text(value: str) -> str:
    """An SQL string; line breaks as their character code."""
    parts = ["'" + part.replace("'", "''") + "'" for part in value.split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")"


def _picked(values) -> str:
    return f"([{', '.join(f'CAST({v} AS DOUBLE)' for v in values)}])[place % {len(values)} + 1]"


def _escaped(column: str, template: Template) -> str:
    out = f"replace({column}, {_text(ESCAPE)}, {_text(ESCAPE * 2)})"
    for mark in template.controls():
        out = f"replace({out}, {_text(mark)}, {_text(mark[0] + ESCAPE + mark[1:])})"
    return out


def _around(template: Template) -> str:
    """Characters before and after the text of a turn."""
    before, _, after = template.other.opening.partition("{role}")
    name = _escaped("replace(replace(role, '%', '%25'), '>', '%3E')", template)
    cases = " ".join(f"WHEN {_text(r)} THEN {len(t.opening) + len(t.closing)}" for r, t in template.roles.items())
    other = f"{len(before) + len(after) + len(template.other.closing)} + length({name})"
    return f"CASE role {cases} ELSE {other} END"


_CHAT = f"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {TRIAL_ID}, 0, 'user', {_text(TRIAL_TEXT)}
  UNION ALL SELECT {TRIAL_ID}, 1, 'assistant', {_text(TRIAL_TEXT)}),
placed AS (
  SELECT *, row_number() OVER w - 1 AS nr, first_value(role) OVER w = 'system' AS led FROM every
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
judged AS (
  SELECT *, CASE WHEN nr = 0 AND led THEN 'system' WHEN (nr - CAST(led AS INTEGER)) % 2 = 0 THEN 'user' ELSE 'assistant' END AS due
  FROM placed),
told AS (
  SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY nr) AS turns,
    coalesce(string_agg(text, '' ORDER BY nr) FILTER (WHERE role = 'assistant'), '') AS loss,
    CAST(sum({_around(INSTRUCTION)} + length({_escaped("text", INSTRUCTION)})) AS BIGINT) AS formatted_chars,
    CAST(min(nr) FILTER (WHERE role <> due) AS INTEGER) AS first_break
  FROM judged GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars, first_break
FROM told"""

_MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
capped AS (
  SELECT *, {_picked(WEIGHTS)} AS w, CAST(source_size AS DOUBLE) * {float(MOST_PASSES)} AS cap,
    CAST(sum(source_size) OVER () AS DOUBLE) * {MIX_SHARE} AS wanted FROM sources),
levels AS (
  SELECT *, cap / w AS ratio,
    (wanted - coalesce(sum(cap) OVER earlier, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER earlier, 0)) AS level
  FROM capped WINDOW earlier AS (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT arg_min(level, (ratio, place)) AS level FROM levels WHERE level <= ratio),
targets AS (
  SELECT source, source_size, place, CASE WHEN chosen.level IS NULL THEN cap ELSE least(cap, w * chosen.level) END AS target
  FROM levels, chosen),
placed AS (
  SELECT doc_id, size, source_size, target, place,
    coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
given AS (
  SELECT *, least(size, greatest(0, CAST(round(target) AS BIGINT) - earlier)) AS once,
    least(size, greatest(0, CAST(round(target) AS BIGINT) - earlier - source_size)) AS twice,
    least(1.0, (CAST(earlier AS DOUBLE) + CAST(size AS DOUBLE) / 2) / target) AS demand,
    {_picked([s.begin for s in SCHEDULES])} AS b, {_picked([s.end - s.begin for s in SCHEDULES])} AS slope,
    {_picked([(s.begin + s.end) / 2 for s in SCHEDULES])} AS mean
  FROM placed)
SELECT doc_id, size, source_size, target, CAST(once + twice AS BIGINT) AS taken,
  CASE WHEN once > 0 THEN round(CASE WHEN slope = 0 THEN demand
    ELSE (sqrt(greatest(0.0, b * b + 2 * slope * mean * demand)) - b) / slope END, 9) END AS position,
  CAST((once > 0)::INTEGER + (twice > 0)::INTEGER AS INTEGER) AS passes
FROM given"""

_VECTORS = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
reached AS (
  SELECT vec_id AS v, vec_id AS low FROM embeddings
  UNION
  SELECT links.b, reached.low FROM reached JOIN links ON links.a = reached.v)
SELECT e.vec_id, coalesce(n, 0) AS n_links, low AS component_id, low = e.vec_id AS kept
FROM embeddings e
LEFT JOIN (SELECT a, CAST(count(*) AS BIGINT) AS n FROM links GROUP BY a) ON a = e.vec_id
JOIN (SELECT v, min(low) AS low FROM reached GROUP BY v) ON v = e.vec_id"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_LEAKS = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
tests AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS p
        FROM tests WHERE len(w) > 0)),
grams AS (
  SELECT r, n, p, array_to_string(w[p : p + n - 1], ' ') AS gram
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, (SELECT DISTINCT n FROM windows))),
met AS (SELECT DISTINCT r, grams.n, p, item_id FROM grams JOIN windows USING (n, gram)),
hits AS (SELECT DISTINCT r, unnest(range(p, p + n)) AS place FROM met),
runs AS (SELECT r, place, place - row_number() OVER (PARTITION BY r ORDER BY place) AS run FROM hits),
counted AS (SELECT r, CAST(count(*) AS BIGINT) AS n_hit, CAST(count(DISTINCT run) AS BIGINT) AS n_spans FROM runs GROUP BY r),
named AS (
  SELECT r, CAST(count(*) AS BIGINT) AS n_items, sha256(string_agg(name, ',' ORDER BY name)) AS items_sha256
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(n_spans, 0) AS n_spans,
  coalesce(n_hit >= {COVERAGE} * len(w), false) AS dropped
FROM docs LEFT JOIN counted USING (r) LEFT JOIN named USING (r)"""

_NEGATIVES = f"""
WITH steps AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({STEPS} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM steps a JOIN steps b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND {LOWEST} * positive_score <= 100 * score AND 100 * score <= {HIGHEST} * positive_score
QUALIFY rank <= {NEGATIVES}"""

ORACLES: dict[str, str] = {
    "op5_vector_dedup": _VECTORS,
    "op6_chat_format": _CHAT,
    "op9_mixing": _MIX,
    "op11_decontamination": _LEAKS,
    "op12_hard_negatives": _NEGATIVES,
}
