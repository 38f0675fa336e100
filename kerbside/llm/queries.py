"""The operators applied to whole tables, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import (bpe, chat, counts, langid, manifest, minhash, packing, phrases, ppm, repair, toxicity,
                          urls, vectors)
from kerbside.llm.common import table
from kerbside.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepare(spark), sf_dir)
    QUERIES[build.__name__] = run
    return run


@query
def op1_bpe(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


@query
def op2_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query
def op7_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.learn(docs.filter(~langid.held_out())))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query
def op8_near_duplicates(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4)


@query
def op3_chat(spark, sf_dir):
    """All conversations and one more, whose texts look like marks of a template."""
    said = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionAll(spark.createDataFrame(said, "conv_id long, turn long, role string, text string"))
    return chat.read_back(chat.format_conversations(rows))


@query
def op4_token_counts(spark, sf_dir):
    return counts.count_tokens(table(spark, sf_dir, "documents"))


@query
def op6_lm_scoring(spark, sf_dir):
    return ppm.score_documents(table(spark, sf_dir, "documents"))


@query
def op9_near_vectors(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_fingerprints(spark, sf_dir):
    return phrases.fingerprints_with_next(table(spark, sf_dir, "documents"))


@query
def op11_urls(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"))


@query
def op12_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair(rows, repair.damage(rows))


@query
def op13_manifest(spark, sf_dir):
    return manifest.check_altered(table(spark, sf_dir, "documents"))


# -- SQL ---------------------------------------------------------------------------------------------

# An escaped control string is longer by one character, like one with a mark behind it.
ORACLE["op3_chat"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
  SELECT *, length(regexp_replace(replace(role, '\', '\\'), '(<\|[A-Za-z0-9_]+\|>|</?s>|\[/?INST\]|<</?SYS>>)',
                                  '\1#', 'g')) AS role_chars,
    length(regexp_replace(replace(text, '\', '\\'), '(<\|[A-Za-z0-9_]+\|>|</?s>|\[/?INST\]|<</?SYS>>)',
                          '\1#', 'g')) AS text_chars
  FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(8 + role_chars + 8 + text_chars + 7) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

# Components by repeated minima over links; words are cut at the six ASCII white-space characters.
ORACLE["op8_near_duplicates"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+'),
    lambda w: w <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION SELECT r.node, l.b FROM reached r JOIN edges l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.other) AS component_id, d.doc_id = min(r.other) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reached r ON r.node = d.doc_id
GROUP BY d.doc_id, s.n
"""

ORACLE["op9_near_vectors"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL)) = 0
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a
  JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reached AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings
  UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, min(r.other) AS component_id, e.vec_id = min(r.other) AS kept
FROM embeddings e LEFT JOIN degrees d ON d.a = e.vec_id JOIN reached r ON r.node = e.vec_id
GROUP BY e.vec_id, d.n
"""


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of ASCII text, bit by bit; 3988292384 is its polynomial."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


def _leaf(text: str) -> str:
    fields = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


# Sources' trees, then the tree over them: nodes by level, each one's siblings, and every leaf folded to the top.
ORACLE["op13_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {_leaf(
        "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS altered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, i, leaf AS d, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, level + 1, i // 16, sha256(string_agg(d, '' ORDER BY i)), (max(n) + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY tree, level, i // 16),
upper AS (
  SELECT 0 AS level, tree AS i, d, count(*) OVER () AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, i // 16, sha256(string_agg(d, '' ORDER BY i)), (max(n) + 15) // 16
  FROM upper WHERE n > 1 GROUP BY level, i // 16),
every AS (
  SELECT tree, level, i, d, n FROM nodes UNION ALL SELECT -1, level, i, d, n FROM upper),
steps AS (
  SELECT a.tree, a.level, a.i, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l,
    coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
  FROM every a JOIN every b ON a.tree = b.tree AND a.level = b.level AND a.i // 16 = b.i // 16
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.i),
folded AS (
  SELECT tree, i AS leaf, 0 AS level, i AS at, coalesce(altered, leaf) AS d, '' AS proof FROM placed
  UNION ALL
  SELECT f.tree, f.leaf, f.level + 1, f.at // 16, sha256(s.l || f.d || s.r), f.proof || s.l || s.r
  FROM folded f JOIN steps s ON s.tree = f.tree AND s.level = f.level AND s.i = f.at),
lower AS (
  SELECT tree, leaf, arg_max(d, level) AS d, arg_max(proof, level) AS proof FROM folded GROUP BY tree, leaf),
climbed AS (
  SELECT tree, leaf, 0 AS level, tree AS at, d, proof FROM lower
  UNION ALL
  SELECT f.tree, f.leaf, f.level + 1, f.at // 16, sha256(s.l || f.d || s.r), f.proof || s.l || s.r
  FROM climbed f JOIN steps s ON s.tree = -1 AND s.level = f.level AND s.i = f.at),
whole AS (
  SELECT tree, leaf, arg_max(d, level) AS d, arg_max(proof, level) AS proof FROM climbed GROUP BY tree, leaf)
SELECT p.doc_id, p.leaf, t.d AS subroot, u.d AS root, sha256(w.proof) AS proof_sha256, w.d AS folded_root,
  w.d = u.d AS verified
FROM placed p JOIN whole w ON w.tree = p.tree AND w.leaf = p.i JOIN nodes t ON t.tree = p.tree AND t.n = 1
JOIN upper u ON u.n = 1
"""


def _edit(state: str, cost: str, letter: str, line: str, where: str = "TRUE") -> str:
    """SQL for what an edit makes of the best way into a state: cost, letters, lines, or NULL."""
    return (f"CASE WHEN {state} IS NOT NULL AND {where} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', "
            f"'r': {state}.r || {line}}} END")


def _edits(*edits: tuple[str, str, str]) -> str:
    """SQL for the best of deleting, keeping and giving another role; (state before, first letter, role) for each way."""
    kept = [_edit(f"v{state}", "t", "K", "chr(10) || role || ':' || text", f"fault < 2 AND initial = '{initial}'")
            for state, initial, _ in edits]
    other = [_edit(f"v{state}", "3 + t", "R", f"chr(10) || '{role}:' || text", "fault < 2")
             for state, _, role in edits if role]
    return ", ".join(kept + other)


def _least(first: str, *edits: tuple[str, str, str]) -> str:
    return f"least({_edit(first, '4', 'D', chr(39) * 2)}, {_edits(*edits)})"


# Rows one after the other, with the best (cost, letters, lines) for each of the four states; least() compares in that order.
ORACLE["op12_repair"] = f"""
WITH RECURSIVE said AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32(
      "(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM said WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN body = '' THEN 2 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 3 WHEN right(body, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS fault
  FROM placed),
costed AS (SELECT *, CASE fault WHEN 1 THEN 3 ELSE 0 END AS t FROM faulty),
best AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 'r': ''}} AS v0,
    CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)) AS v1, {{'c': 3, 'a': 'I', 'r': chr(10) || 'user:'}} AS v2,
    {{'c': 6, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS v3
  FROM conversations
  UNION ALL
  SELECT conv_id, i, v0, v1, v2, least(v3, {_edit("v2", "3", "I", "chr(10) || 'assistant:'")})
  FROM (
    SELECT conv_id, i, v0, v1, least(v2, {", ".join(
        _edit(f"v{s}", "3", "I", "chr(10) || 'user:'") for s in (0, 1, 3))}) AS v2, v3
    FROM (
      SELECT b.conv_id, f.i, {_edit("v0", "4", "D", "''")} AS v0, {_least("v1", (0, "s", ""))} AS v1,
        {_least("v2", (0, "u", "user"), (1, "u", "user"), (3, "u", "user"))} AS v2,
        {_least("v3", (2, "a", "assistant"))} AS v3
      FROM best b JOIN costed f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1) x) y),
chosen AS (SELECT conv_id, arg_max(least(v0, v3), i) AS v FROM best GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 2) AS blank, count(*) FILTER (WHERE fault = 3) AS duplicate,
    count(*) FILTER (WHERE fault = 1) AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id)
SELECT v.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(v.v.c AS BIGINT) AS cost, v.v.a AS audit,
  sha256(substr(v.v.r, 2)) AS repaired_sha256
FROM chosen v LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM v.conv_id
"""


def _rule(column: str) -> str:
    """SQL for the longest rule that fits a host and path: its text or verdict."""
    cases = []
    for rule, verdict in sorted(urls.RULES, key=lambda r: (len(r[0]), r[0]), reverse=True):
        host, _, path = rule.partition("/")
        cases.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}') "
                     f"THEN '{rule if column == 'rule' else verdict}'")
    return f"CASE {' '.join(cases)} END"


def _url_level(d: int) -> str:
    """SQL for one more level of the tree: branches of every node, merged ones, and the pages one segment further."""
    above, node = f"level{d - 1}", "host, template"
    return f"""
kids{d} AS (
  SELECT {node}, estimate, segs[{d}] AS segment, count(*) AS n, count(blocked) AS labelled,
    coalesce(sum(blocked), 0) AS blocked
  FROM {above} WHERE len(segs) >= {d} GROUP BY {node}, estimate, segs[{d}]),
literal{d} AS (
  SELECT *, CASE WHEN n * {urls.MANY} >= sum(n) OVER (PARTITION BY {node}) AND n >= {urls.LEAST} THEN segment END AS lit
  FROM kids{d}),
branch{d} AS (
  SELECT {node}, estimate, lit, sum(labelled) AS labelled, sum(blocked) AS blocked,
    sum(labelled) >= {urls.LEAST} AS compared, sum(blocked) / greatest(sum(labelled), 1) AS share
  FROM literal{d} GROUP BY {node}, estimate, lit),
lagged{d} AS (
  SELECT *, lag(share) OVER w AS last_share, lag(labelled) OVER w AS last_labelled FROM branch{d}
  WINDOW w AS (PARTITION BY {node}, compared ORDER BY share, lit NULLS FIRST)),
grouped{d} AS (
  SELECT *, sum(CASE WHEN compared AND share - last_share < {urls.BOUND!r}::DOUBLE
      * (1 / sqrt(labelled) + 1 / sqrt(last_labelled)) THEN 0 ELSE 1 END)
    OVER (PARTITION BY {node}, compared ORDER BY share, lit NULLS FIRST) AS grp
  FROM lagged{d}),
merged{d} AS (
  SELECT {node}, lit, (sum(blocked) OVER w + {urls.WEIGHT} * estimate) / (sum(labelled) OVER w + {urls.WEIGHT}) AS own,
    list_sort(list(coalesce(regexp_replace(lit, '([*{{|}}\\\\])', '\\\\\\1', 'g'), '*')) OVER w) AS names
  FROM grouped{d} WINDOW w AS (PARTITION BY {node}, compared, grp)),
level{d} AS (
  SELECT page_id, l.host, path, rule, label, l.blocked, segs, l.template || '/' || CASE WHEN len(names) = 1 THEN names[1]
    ELSE '{{' || array_to_string(names, '|') || '}}' END AS template, own AS estimate
  FROM {above} l JOIN literal{d} k ON k.host = l.host AND k.template = l.template AND k.segment = l.segs[{d}]
  JOIN merged{d} m ON m.host = l.host AND m.template = l.template AND m.lit IS NOT DISTINCT FROM k.lit
  WHERE len(l.segs) >= {d}
  UNION ALL SELECT * FROM {above} WHERE len(segs) < {d})"""


ORACLE["op11_urls"] = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM rest),
ruled AS (
  SELECT page_id, host, path, {_rule("rule")} AS rule, {_rule("verdict")} AS label,
    list_filter(string_split(path, '/'), lambda s: s <> '') AS parts
  FROM parts),
cut AS (
  SELECT page_id, host, path, rule, label, CASE label WHEN 'block' THEN 1 WHEN 'allow' THEN 0 END AS blocked,
    CASE WHEN len(parts) > {urls.DEPTH} THEN list_concat(parts[1:{urls.DEPTH - 1}],
      [array_to_string(parts[{urls.DEPTH}:], '/')]) ELSE parts END AS segs
  FROM ruled),
overall AS (SELECT (coalesce(sum(blocked), 0) + 1) / (count(blocked) + 2) AS p FROM cut),
level0 AS (
  SELECT c.*, '' AS template, (coalesce(sum(blocked) OVER w, 0) + {urls.WEIGHT} * p) / (count(blocked) OVER w + {urls.WEIGHT})
    AS estimate
  FROM cut c, overall WINDOW w AS (PARTITION BY host)),
{",".join(_url_level(d) for d in range(1, urls.DEPTH + 1))}
SELECT page_id, host, path, rule, coalesce(label, CASE WHEN estimate >= {urls.PURITY} THEN 'block' ELSE 'allow' END)
  AS verdict, template, estimate AS score
FROM level{urls.DEPTH}
"""
