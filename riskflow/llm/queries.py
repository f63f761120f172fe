"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.catalog.registry import Query
from riskflow.llm.bpe import build_lexicon, round_trip
from riskflow.llm.chat_views import perspectives
from riskflow.llm.exact_dedup import exact_groups
from riskflow.llm.html_text import extract
from riskflow.llm.line_dedup import drop_repeats
from riskflow.llm.minmax_dups import near_duplicates as minmax_near_duplicates
from riskflow.llm.near_dups import near_duplicates
from riskflow.llm.packing import pack_documents
from riskflow.llm.prefix_trie import prefix_trie
from riskflow.llm.quality_model import score_quality, train
from riskflow.llm.quality_rules import quality_rules
from riskflow.llm.tables import table
from riskflow.llm.warc import archive_round_trip
from riskflow.llm.word_runs import periodic_runs

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def span_list(column: str) -> Column:
    """Spans as text, ``start-end`` with commas between them."""
    return F.concat_ws(",", F.transform(column, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))))


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


@query("op7_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
     g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("n_chunks")


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train(docs, table(spark, sf_dir, "labels")))


@query("op3_html_extraction")
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query("op8_bpe_transducer")
def op8_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, vocab = table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    done = round_trip(docs, vocab, build_lexicon(docs, vocab))
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op6_warc_bundles", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
     g AS (SELECT html, min(page_id) AS first_id FROM p GROUP BY html)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           ((('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN g USING (html)""")
def op6_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


@query("op1_line_dedup", r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
     t AS (SELECT *, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos) - length(line) - 1 AS line_at,
                  regexp_extract_all(line, '.*?(?:[.!?][\x20\x09-\x0D]+|[\x{3002}\x{FF01}\x{FF1F}][\x20\x09-\x0D]*)|.+') AS parts FROM l),
     s AS (SELECT doc_id, pos, line_at, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM t),
     n AS (SELECT *, trim(regexp_replace(lower(part), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm, regexp_extract_all(lower(part), '[^\x20\x09-\x0D]+') AS w,
                  line_at + sum(length(part)) OVER (PARTITION BY doc_id, pos ORDER BY i) - length(part) AS place FROM s),
     m AS (SELECT *, len(w) >= 12 OR len(list_filter(w, lambda x: length(x) >= 40)) > 0 AS whole,
                  lag(norm) OVER line AS before, lag(len(w)) OVER line AS n_before, lead(norm) OVER line AS behind, lead(len(w)) OVER line AS n_behind
           FROM n WINDOW line AS (PARTITION BY doc_id, pos ORDER BY i)),
     k AS (SELECT doc_id, pos, i, '=' || norm AS unit FROM m WHERE whole
           UNION ALL SELECT doc_id, pos, i, '<' || before || chr(10) || norm FROM m WHERE NOT whole AND len(w) > 0 AND n_before + len(w) >= 12
           UNION ALL SELECT doc_id, pos, i, '>' || norm || chr(10) || behind FROM m WHERE NOT whole AND len(w) > 0 AND n_behind + len(w) >= 12),
     r AS (SELECT doc_id, pos, i, row_number() OVER (PARTITION BY unit ORDER BY doc_id, pos, i) > 1 AS again FROM k),
     g AS (SELECT doc_id, pos, i, bool_or(again) AS gone FROM r GROUP BY ALL),
     a AS (SELECT doc_id, pos, i, part, place, coalesce(gone, false) AS gone FROM n LEFT JOIN g USING (doc_id, pos, i)),
     c AS (SELECT doc_id, pos, string_agg(part, '' ORDER BY i) FILTER (WHERE NOT gone) AS line, sum(gone::BIGINT) AS n,
                  string_agg(place::BIGINT::VARCHAR || '-' || (place + length(part))::BIGINT::VARCHAR, ',' ORDER BY i) FILTER (WHERE gone) AS removed
           FROM a GROUP BY doc_id, pos)
SELECT doc_id, coalesce(string_agg(CASE WHEN parts = [] THEN '' ELSE c.line END, chr(10) ORDER BY pos), '') AS text,
       coalesce(sum(n), 0)::BIGINT AS n_removed, coalesce(string_agg(removed, ',' ORDER BY pos), '') AS removed
FROM t LEFT JOIN c USING (doc_id, pos) GROUP BY doc_id""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = drop_repeats(table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "text", F.size("removed").cast("long").alias("n_removed"), span_list("removed").alias("removed"))


@query("op5_near_duplicates", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
     g AS (SELECT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')] ELSE
                  list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s FROM w),
     n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
     p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
     l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 10 * shared >= 8 * (x.n + y.n - shared)),
     e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
     r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id),
     c AS (SELECT doc_id, min(root) AS class_id FROM r GROUP BY doc_id),
     k AS (SELECT a AS doc_id, count(*) AS n_links FROM e GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM documents JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)""")
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_perspective_rotation", """
WITH m AS (SELECT DISTINCT conv_id, turn::BIGINT AS turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS content
           FROM conversations),
     p AS (SELECT DISTINCT conv_id, role AS perspective FROM m WHERE role <> 'system'),
     o AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, content) - 1) // 256 AS part FROM m),
     s AS (SELECT p.conv_id, perspective, part, turn, role, content, role = perspective AS own,
                  '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN role
                                         ELSE 'user name=' || role END || chr(10) AS head,
                  content || '<|im_end|>' AS body FROM p JOIN o ON p.conv_id = o.conv_id),
     w AS (SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part ORDER BY turn, role, content)::BIGINT
                     - length(body) - 1 AS place FROM s)
SELECT conv_id, perspective, part, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY turn, role, content) AS text,
       coalesce(string_agg(place || '-' || (place + length(body)), ',' ORDER BY turn, role, content) FILTER (WHERE own), '') AS mask
FROM w GROUP BY conv_id, perspective, part""")
def op4_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives(table(spark, sf_dir, "conversations")).withColumn("mask", span_list("mask"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), planted=True)


@query("op11_minmax_near_dups", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
     g AS (SELECT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 3 THEN [array_to_string(w, ' ')] ELSE
                  list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS s FROM w),
     n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
     p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
     l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
     e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
     r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id),
     c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM documents JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)""")
def op11_minmax_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_near_duplicates(table(spark, sf_dir, "documents"))


@query("op12_prefix_trie", """
WITH m AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
     k AS (SELECT c, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(c::VARCHAR, ''),
                         lambda b: [ascii(b)::BIGINT + 2, 0, 0, 0, 0, 0, 0, 0, 0]))),
                  lambda s, x: CASE WHEN x >= 2 THEN xor(s, x - 2) WHEN s % 2 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)) % 9 AS h
           FROM (SELECT DISTINCT c FROM m)),
     b AS (SELECT k.c, 0 AS own, pos, r, t FROM k JOIN m ON m.c = k.c - (k.c % 5 + 5) % 5 AND pos <= h
           UNION ALL SELECT k.c, 1, pos, r, t FROM k JOIN m ON m.c = k.c AND pos > h),
     s AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d, count(*) OVER (PARTITION BY c) AS size, r, t FROM b),
     p AS (SELECT c, d, list(struct_pack(r := r, t := t)) OVER (PARTITION BY c ORDER BY d) AS path, octet_length(encode(t)) AS bytes, d = size AS ends FROM s
           UNION ALL SELECT c, 0, [], 0, c NOT IN (SELECT c FROM s) FROM k),
     n AS (SELECT path, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
                  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM p GROUP BY path),
     f AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
     w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN f USING (path)),
     a AS (SELECT path[1:i] AS path, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens
           FROM (SELECT path, n_children, saved, unnest(range(depth + 1)) AS i FROM w) GROUP BY ALL)
SELECT w.conv_id, w.depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM w JOIN a USING (path) LEFT JOIN w u ON w.depth > 0 AND u.path = w.path[1:w.depth - 1]""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
