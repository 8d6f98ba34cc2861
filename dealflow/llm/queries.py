"""The registered queries of the subpackage: each applies one operator with production
parameters to its whole table and derives the columns that its contract fixes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def sha(col):
    return F.sha2(F.encode(col, "UTF-8"), 256)


def digest(spans, kinds=None):
    """Lowercase hex of the spans as kind:start:end, comma-joined."""
    own = F.col(spans) if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query
def op1_secret_scan(spark, sf_dir):
    from dealflow.llm.secrets import KINDS, find_secrets, fit

    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, fit(docs), keep=["doc_id"])
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in KINDS[:3]], sha(digest("spans", KINDS[:3])).alias("base_sha256"), digest("spans").alias("spans"))


@query
def op2_toxicity(spark, sf_dir):
    from dealflow.llm.toxicity import fit, score_toxicity

    docs = table(spark, sf_dir, "documents")
    got = score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
                      F.size("passages").cast("bigint").alias("n_passages"))


@query
def op3_line_dedup(spark, sf_dir):
    from dealflow.llm.line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", sha("kept").alias("kept_sha256"))


#: A-Z in the lists: DuckDB's lower() would also change letters outside ASCII.
LINE_KEY = r"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op3_line_dedup"] = f"""
WITH split_lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (SELECT doc_id, pos, line, {LINE_KEY} AS k FROM split_lines),
held AS (SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (first_doc IS NOT NULL AND first_doc <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (first_doc IS NULL OR first_doc = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN held USING (k) GROUP BY doc_id
"""


@query
def op4_substring_dedup(spark, sf_dir):
    from dealflow.llm.substring_dedup import dedup_substrings

    return dedup_substrings(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", sha("kept").alias("kept_sha256"))


@query
def op5_url_filter(spark, sf_dir):
    from dealflow.llm.url_filter import filter_urls, page_links

    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, page_links(pages))


@query
def op6_benchmark_decontamination(spark, sf_dir):
    from dealflow.llm.decontaminate import find_leaks

    got = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return got.select("doc_id", F.inline("leaks"))


@query
def op7_quality_classifier(spark, sf_dir):
    from dealflow.llm.quality import fit, score_quality

    docs = table(spark, sf_dir, "documents")
    got = score_quality(docs, fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      F.size("lines").cast("bigint").alias("n_lines"))


def vocabulary(name="byte_bpe_50k.json"):
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op8_bpe(spark, sf_dir):
    from dealflow.llm.bpe import encode

    got = encode(table(spark, sf_dir, "documents"), vocabulary(), keep=["doc_id"], decoded="decoded")
    return got.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                      F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), ","), "UTF-8"), 256).alias("ids_sha256"),
                      sha("decoded").alias("decoded_sha256"))


@query
def op10_quality_rules(spark, sf_dir):
    from dealflow.llm.quality_rules import MEASURES, fit, judge

    docs = table(spark, sf_dir, "documents")
    got = judge(docs, fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return got.select("doc_id", *MEASURES, "base_failed", "kept", "content_share")


@query
def op9_ngram_jaccard_join(spark, sf_dir):
    from dealflow.llm.near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_packing(spark, sf_dir):
    from dealflow.llm.packing import cut_pieces, pack

    return pack(cut_pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")))


@query
def op13_conversation_repair(spark, sf_dir):
    from dealflow.llm.conversation import damage, repair

    return repair(damage(table(spark, sf_dir, "conversations")))


@query
def op11_embedding_whitening(spark, sf_dir):
    from dealflow.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


def _conversation_sql() -> str:
    """The repair by dynamic programming from a conversation's end. What the rest costs depends on the role
    that comes next: s (nothing yet), u (after a system turn), a (after a user's) or d (after a whole
    pair); a value is a struct (cost, audit), whose order is the one asked for, and NULL if there is none."""
    add = lambda cost, letter, to: f"CASE WHEN {to} IS NOT NULL THEN {{'cost': {to}.cost + {cost}, 'audit': '{letter}' || {to}.audit}} END"
    least = lambda *ways: f"list_min(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))"
    ways = {}
    for q in "suad":
        to, role = ("d", "a") if q == "a" else ("a", "u")
        kept = [f"CASE WHEN may AND first = '{role}' THEN {add('extra', 'K', f'p.{to}')} END", f"CASE WHEN may THEN {add('extra + 3', 'R', f'p.{to}')} END"]
        if q == "s":
            kept.append(f"CASE WHEN may AND first = 's' THEN {add('extra', 'K', 'p.u')} END")
        ways[q] = least(add(4, "D", f"p.{q}"), *kept)
    closed = ", ".join([f"{least('x.a', add(3, 'I', 'x.d'))} AS a", *[f"{least(f'x.{q}', add(3, 'I', 'a'))} AS {q}" for q in "sud"]])
    ends = "{'cost': 3::BIGINT, 'audit': 'I'} AS a, {'cost': 0::BIGINT, 'audit': ''} AS s, {'cost': 6::BIGINT, 'audit': 'II'} AS u, {'cost': 0::BIGINT, 'audit': ''} AS d"
    ws = r"\x20\x09-\x0D"
    step = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))"
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS key FROM conversations
), coded AS (SELECT *, xor(list_reduce(list_concat([4294967295], key), lambda c, b: {step}), 4294967295) % 20 AS code FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM coded, (VALUES (1), (2)) t(copy) WHERE code <> 0 AND (copy = 1 OR code = 3)
), placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS first, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
         CASE WHEN NOT regexp_matches(text, '[^{ws}]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
              WHEN regexp_extract(text, '([^{ws}])[{ws}]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM placed
), turns AS (SELECT *, fault IS NULL OR fault = 'truncated' AS may, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra FROM judged),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || first NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM turns GROUP BY conv_id
), dp AS (
  SELECT conv_id, n AS pos, {ends} FROM counted
  UNION ALL
  SELECT x.conv_id, x.pos, {closed} FROM (
    SELECT p.conv_id, p.pos - 1 AS pos, {ways['a']} AS a, {ways['s']} AS s, {ways['u']} AS u, {ways['d']} AS d
    FROM dp p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.pos = p.pos) x
), best AS (SELECT conv_id, s.cost AS cost, s.audit AS audit FROM dp WHERE pos = 0),
edits AS (SELECT conv_id, unnest(string_split(audit, '')) AS edit, unnest(range(1, len(audit) + 1)) AS k FROM best WHERE audit <> ''),
aligned AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS pos FROM edits),
staying AS (
  SELECT a.conv_id, a.k, a.edit, t.role, CASE WHEN a.edit = 'I' THEN '' ELSE t.text END AS text, a.edit = 'K' AND t.first = 's' AS opens, row_number() OVER (PARTITION BY a.conv_id ORDER BY a.k) AS j
  FROM aligned a LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM a.conv_id AND t.pos = a.pos AND a.edit <> 'I' WHERE a.edit <> 'D'
), roled AS (SELECT *, CASE WHEN edit = 'K' THEN role WHEN (j - max(opens::INT) OVER (PARTITION BY conv_id)) % 2 = 1 THEN 'user' ELSE 'assistant' END AS new_role FROM staying),
fixed AS (SELECT conv_id, string_agg(new_role || ':' || text, chr(10) ORDER BY k) AS repaired FROM roled GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN fixed f ON f.conv_id IS NOT DISTINCT FROM i.conv_id
"""


ORACLE["op13_conversation_repair"] = _conversation_sql()
