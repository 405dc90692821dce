"""Queries pN_ of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.session import ship_package, table

Query = Callable[[SparkSession, str], DataFrame]


def _q(fn: Callable[..., DataFrame], *tables: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(*[table(spark, sf_dir, t) for t in tables])

    return run


def queries() -> dict[str, Query]:
    from threadloom.llm import language, leakage, mail, mixing, neardup, overlap, packing, pii, splits, threads

    return {
        "p1_found": _q(splits.related_threads, "turns"),
        "p1_split": _q(splits.assign_splits, "turns", "split_targets"),
        "p1_report": _q(splits.split_report, "turns", "split_targets"),
        "p2_mix": _q(mixing.mix, "turns", "mix_targets"),
        "p2_report": _q(mixing.mix_report, "turns", "mix_targets"),
        "p3_found": _q(overlap.overlap_pairs, "turns"),
        "p3_report": _q(overlap.overlap_report, "turns"),
        "p4_found": _q(pii.personal_items, "turns", "contacts", "subjects"),
        "p4_redacted": _q(pii.redacted, "turns", "contacts", "subjects"),
        "p5_found": _q(neardup.near_duplicate_groups, "turns"),
        "p6_found": _q(mail.foreign_lines, "turns"),
        "p6_new_text": _q(mail.new_text, "turns"),
        "p7_found": lambda spark, d: _q(threads.thread_verdicts, "turns", "envelopes")(spark, d).where("dropped").select("thread_id"),
        "p7_verdicts": _q(threads.thread_verdicts, "turns", "envelopes"),
        "p7_conversations": lambda spark, d: _q(threads.conversations, "turns", "envelopes")(spark, d).withColumn("ts", F.unix_micros("ts")),
        "p7_paths": _q(threads.paths, "turns", "envelopes"),
        "p8_pack": _q(packing.pack, "documents", "pack_budgets"),
        "p8_report": _q(packing.pack_report, "documents", "pack_budgets"),
        "p9_found": lambda spark, d: _q(leakage.leaks, "documents", "fact_probes")(spark, d).select("item_id", "doc_id"),
        "p9_leaks": _q(leakage.leaks, "documents", "fact_probes"),
        "p9_clean": _q(leakage.without_leaks, "documents", "fact_probes"),
        "p10_found": _q(language.wrong_labels, "documents"),
        "p10_stretches": _q(language.stretches, "documents"),
        "p10_documents": _q(language.document_languages, "documents"),
    }


# Messages of the three sources in SQL: by (source, source_id), with bad payloads, parents, texts that show something, and dangling parents.
_MESSAGES = r"""
WITH RECURSIVE t AS (SELECT lower(trim(source)) AS source, source_id, thread_id, ts, author_id, text, coalesce(is_subject, false) AS subj FROM turns WHERE lower(trim(source)) IN ('imessage', 'claude_ai', 'chatgpt') AND thread_id IS NOT NULL),
r AS (SELECT lower(trim(source)) AS source, source_id, ts, CASE WHEN json_valid(payload) AND payload LIKE '{%' THEN payload END AS o FROM envelopes WHERE lower(trim(source)) IN ('imessage', 'claude_ai', 'chatgpt')),
e AS (SELECT source, source_id, ts, CASE source WHEN 'imessage' THEN o ->> '$.handle' WHEN 'claude_ai' THEN o ->> '$.sender' ELSE o ->> '$.role' END AS author, o IS NULL AS bad, o ->> '$.text' AS text,
  CASE source WHEN 'imessage' THEN o ->> '$.chat_guid' WHEN 'claude_ai' THEN o ->> '$.conversation_uuid' ELSE o ->> '$.conversation_id' END AS named,
  CASE source WHEN 'imessage' THEN o ->> '$.thread_originator' WHEN 'claude_ai' THEN o ->> '$.parent_message_uuid' ELSE o ->> '$.parent' END AS parent,
  coalesce(CASE source WHEN 'imessage' THEN (o ->> '$.is_from_me') = 'true' WHEN 'claude_ai' THEN (o ->> '$.sender') = 'human' ELSE (o ->> '$.role') = 'user' END, false) AS subj FROM r),
k AS (SELECT DISTINCT source, source_id, thread_id FROM t),
m AS (SELECT coalesce(k.thread_id, e.named) AS thread_id, e.source, e.source_id, e.ts, e.author, e.bad, e.text, e.parent, e.subj FROM e LEFT JOIN k USING (source, source_id)
  UNION ALL SELECT thread_id, source, source_id, ts, author_id, false, text, NULL, subj FROM t),
h AS (SELECT *, length(regexp_replace(coalesce(text, ''), '[\s\p{Z}\p{Cc}\p{Cf}\x{034F}\x{115F}\x{1160}\x{2800}\x{3164}\x{FE00}-\x{FE0F}\x{FFA0}\x{FFFC}]', '', 'g')) > 0 AS says FROM m),
o AS (SELECT DISTINCT h.thread_id FROM h LEFT JOIN (SELECT DISTINCT thread_id, source, source_id AS parent, true AS there FROM h) p USING (thread_id, source, parent) WHERE coalesce(h.parent, '') <> '' AND p.there IS NULL),
v AS (SELECT h.thread_id, bool_or(bad) OR NOT bool_or(subj AND says) OR NOT bool_or(NOT subj AND says) OR h.thread_id IN (SELECT thread_id FROM o) AS dropped FROM h WHERE h.thread_id IN (SELECT thread_id FROM t) GROUP BY h.thread_id)
"""

_P7 = _MESSAGES + "SELECT thread_id FROM v WHERE dropped"

# One row per message of a kept thread, and below a root the time that no message may come before.
_TREE = (
    _MESSAGES
    + r""",
g AS (SELECT thread_id, source, source_id, min(ts) AS ts, max(author) FILTER (author <> 'unknown') AS author, max(text) AS text, max(nullif(parent, '')) AS parent, bool_or(subj) AS subj FROM h WHERE thread_id IN (SELECT thread_id FROM v WHERE NOT dropped) GROUP BY 1, 2, 3),
w AS (SELECT thread_id, source, source_id, 0 AS depth, ts AS latest FROM g WHERE parent IS NULL UNION ALL SELECT g.thread_id, g.source, g.source_id, w.depth + 1, greatest(g.ts, w.latest) FROM w JOIN g ON g.thread_id = w.thread_id AND g.source = w.source AND g.parent = w.source_id)
"""
)
_P7_CONVERSATIONS = (
    _TREE
    + """
SELECT thread_id, row_number() OVER (PARTITION BY thread_id ORDER BY latest NULLS FIRST, depth, g.ts NULLS FIRST, source, source_id) AS seq,
  CASE WHEN subj THEN 'subject' WHEN source = 'imessage' THEN 'other' ELSE 'assistant' END AS role, author, epoch_us(ts) AS ts, depth, text, source, source_id
FROM g JOIN w USING (thread_id, source, source_id)
"""
)
_P7_PATHS = (
    _TREE
    + """,
l AS (SELECT w.thread_id, w.source, w.source_id, w.depth FROM w LEFT JOIN (SELECT DISTINCT thread_id, source, parent AS source_id, true AS answered FROM g WHERE parent IS NOT NULL) a USING (thread_id, source, source_id) WHERE answered IS NULL),
u AS (SELECT thread_id, source_id AS leaf, depth + 1 AS seq, source, source_id FROM l UNION ALL SELECT u.thread_id, u.leaf, u.seq - 1, u.source, g.parent FROM u JOIN g ON g.thread_id = u.thread_id AND g.source = u.source AND g.source_id = u.source_id WHERE g.parent IS NOT NULL)
SELECT thread_id, leaf, seq, source, source_id FROM u
"""
)

_P7_VERDICTS = (
    _MESSAGES
    + """,
q AS (SELECT DISTINCT h.thread_id, h.source, h.source_id FROM h LEFT JOIN (SELECT DISTINCT thread_id, source, source_id AS parent, true AS there FROM h) p USING (thread_id, source, parent) WHERE coalesce(h.parent, '') <> '' AND p.there IS NULL)
SELECT h.thread_id, bool_or(bad) AS damaged, bool_or(subj AND says) AS subject_speaks, bool_or(NOT subj AND says) AS others_speak, count(DISTINCT source || ':' || source_id) AS n_messages,
  (SELECT count(*) FROM q WHERE q.thread_id = h.thread_id) AS n_orphans, 0::BIGINT AS n_cyclic, any_value(v.dropped) AS dropped
FROM h JOIN v USING (thread_id) GROUP BY h.thread_id
"""
)

# Word sets of turns, and pairs of them by brute force.
_SETS = r"""
WITH RECURSIVE w AS (SELECT turn_id, lower(trim(eval_split)) AS side, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM turns WHERE text IS NOT NULL),
s AS (SELECT * FROM w WHERE len(w) >= 24)
"""

def _near_pairs(on: str) -> str:
    sized = f"SELECT a.turn_id AS x, b.turn_id AS y, len(a.w) AS n, len(b.w) AS m, len(list_intersect(a.w, b.w)) AS c FROM s a JOIN s b ON {on} WHERE len(a.w) >= 0.7 * len(b.w) AND len(b.w) >= 0.7 * len(a.w)"
    return f"SELECT x, y FROM ({sized}) WHERE c >= 0.7 * (n + m - c)"


_P3 = _SETS + f"SELECT least(x, y) AS turn_a, greatest(x, y) AS turn_b FROM ({_near_pairs("a.side = 'train' AND b.side IN ('validation', 'heldout')")})"
_P5 = (
    _SETS
    + f""",
e AS ({_near_pairs('a.turn_id < b.turn_id')}),
n AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT DISTINCT x AS t, x AS g FROM n UNION SELECT n.y, r.g FROM r JOIN n ON n.x = r.t WHERE r.g < n.y)
SELECT least(min(g), t) AS group_id, t AS turn_id FROM r GROUP BY t
"""
)

# Related threads in SQL: what their ids denote, and three turns in common.
_P1 = r"""
WITH RECURSIVE t AS (SELECT lower(trim(source)) AS source, thread_id, ts, text FROM turns WHERE thread_id IS NOT NULL),
i AS (SELECT DISTINCT source, thread_id AS id, regexp_extract(thread_id, '(?i)^\s*[a-z]+;-;(.*)$', 1) AS chat FROM t),
p AS (SELECT *, CASE WHEN regexp_matches(id, '<[^<>]*>\s*$') THEN regexp_extract(id, '<([^<>]*)>\s*$', 1) ELSE id END AS box, regexp_replace(regexp_replace(chat, '(?i)^\s*tel:', ''), '[^0-9+]', '', 'g') AS num,
  regexp_replace(replace(trim(id), '\', '/'), '(?i)^file:(//(localhost)?)?/', '/') AS path FROM i),
u AS (SELECT *, lower(regexp_replace(regexp_replace(regexp_replace(box, '\s', '', 'g'), '(?i)^mailto:', ''), '[?].*$', '')) AS mail, lower(regexp_replace(regexp_replace(regexp_replace(chat, '\s', '', 'g'), '(?i)^mailto:', ''), '[?].*$', '')) AS chat_mail,
  CASE WHEN starts_with(path, '/') THEN '/' ELSE '' END || array_to_string(list_filter(string_split(path, '/'), lambda x: x NOT IN ('', '.')), '/') AS clean FROM p),
c AS (SELECT *, regexp_replace(regexp_replace(clean, '[^/]+/\.\./', ''), '[^/]+/\.\./', '') AS full_path FROM u),
k AS (SELECT id, CASE WHEN source = 'mail' AND contains(mail, '@') THEN 'addr:' || mail WHEN source = 'imessage' AND contains(chat, '@') THEN 'addr:' || chat_mail WHEN source = 'imessage' AND chat <> '' AND length(num) > 3 THEN 'tel:' || regexp_replace(num, '^00', '+')
  WHEN source = 'claude_code' AND regexp_matches(id, '[/\\]') THEN 'file:' || full_path WHEN source = 'git_repos' AND regexp_matches(id, '[/\\]') THEN 'repo:' || regexp_replace(regexp_replace(full_path, '/?\.git$', ''), '/$', '') END AS key FROM c),
h AS (SELECT DISTINCT thread_id AS id, ts, text FROM t WHERE ts IS NOT NULL AND trim(text) <> ''),
l AS (SELECT DISTINCT a.id AS x, b.id AS y FROM k a JOIN k b ON a.key = b.key AND a.id <> b.id
  UNION SELECT a.id, b.id FROM h a JOIN h b ON a.ts = b.ts AND a.text = b.text AND a.id <> b.id GROUP BY a.id, b.id HAVING count(*) >= 3),
r AS (SELECT DISTINCT x AS a, x AS b FROM l UNION SELECT r.a, l.y FROM r JOIN l ON l.x = r.b)
SELECT a AS thread_a, b AS thread_b FROM r WHERE a < b
"""

# Probes in documents, in SQL: shared windows of twelve words.
_P9 = r"""
WITH w AS (SELECT item_id, regexp_extract_all(lower(strip_accents(regexp_replace(question, '\p{Cf}', '', 'g'))), '[\p{L}\p{N}]+') AS l FROM fact_probes),
d AS (SELECT doc_id, regexp_extract_all(lower(strip_accents(regexp_replace(text, '\p{Cf}', '', 'g'))), '[\p{L}\p{N}]+') AS l FROM documents),
a AS (SELECT DISTINCT item_id, array_to_string(l[i:i + 11], ' ') AS s FROM (SELECT item_id, l, unnest(range(1, len(l) - 10)) AS i FROM w WHERE len(l) >= 12)),
b AS (SELECT doc_id, array_to_string(l[i:i + 11], ' ') AS s FROM (SELECT doc_id, l, unnest(range(1, len(l) - 10)) AS i FROM d WHERE len(l) >= 12))
SELECT DISTINCT item_id, doc_id FROM a JOIN b USING (s)
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": _P1, "p3_found": _P3, "p5_found": _P5, "p7_found": _P7, "p7_verdicts": _P7_VERDICTS, "p7_conversations": _P7_CONVERSATIONS, "p7_paths": _P7_PATHS, "p9_found": _P9}
