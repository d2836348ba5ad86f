"""The registered queries over documents, vectors and pages, and the SQL some must equal."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .alignment import aligned
from .bpe import decoded, encoded
from .chat import formatted, read_back
from .quality import quality_scores
from .html import extracted
from .lines import line_groups
from .packing import byte_length, packed
from .repair import audits, damaged, repair_report
from .simhash import simhash_groups
from .substrings import without_repeats
from .topk import top_inner_products
from .toxicity import toxicity_scores
from .vectors import vector_groups

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_groups(table(spark, sf_dir, "embeddings"))


@query
def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"))


SQL["op8_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = decoded(encoded(texts, path, public_tokenizers.PATTERN), path)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


@query
def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_groups(table(spark, sf_dir, "documents"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), byte_length())


@query
def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["begin"])
    return found.select(
        "doc_id",
        (F.octet_length("kept").cast("long") + removed).alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


SQL["op5_substrings"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
    SELECT doc_id, unnest(generate_series(0, CAST(length(h) // 2 AS BIGINT) - 50)) AS pos, h FROM d WHERE length(h) >= 100
),
s AS (SELECT doc_id, pos, md5_number(substr(h, 2 * pos + 1, 100)) AS name FROM w),
f AS (SELECT name, min(doc_id) AS first FROM s GROUP BY name HAVING min(doc_id) < max(doc_id)),
g AS (SELECT s.doc_id, s.pos FROM s JOIN f USING (name) WHERE s.doc_id > f.first),
b AS (SELECT *, pos > 50 + lag(pos, 1, -1000) OVER (PARTITION BY doc_id ORDER BY pos) AS new FROM g),
r AS (SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM b),
spans AS (SELECT doc_id, run, min(pos) AS b, max(pos) + 50 AS e FROM r GROUP BY doc_id, run),
x AS (SELECT *, lead(b) OVER (PARTITION BY doc_id ORDER BY b) AS next_b, row_number() OVER (PARTITION BY doc_id ORDER BY b) AS k FROM spans),
o AS (
    SELECT x.doc_id, count(*) AS n_spans, sum(e - b) AS n_removed,
        string_agg(CASE WHEN k = 1 THEN substr(d.h, 1, 2 * b) ELSE '' END
            || substr(d.h, 2 * e + 1, 2 * coalesce(next_b - e, length(d.h))), '' ORDER BY b) AS kept
    FROM x JOIN d USING (doc_id) GROUP BY x.doc_id
)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN o USING (doc_id)
"""


@query
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = aligned(texts, *paths, public_tokenizers.PATTERN, digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


@query
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return repair_report(rows, settle(audits(rows)))


# CRC-32 of the key's bytes, bit by bit; then the cheapest edits, row by row from the left: the least (cost, letters)
# of each state, as equal costs never have one text as the beginning of the other.
SQL["op12_repair"] = r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
),
summed AS (
    SELECT *, xor(list_reduce(
        flatten(list_transform(range(length(k)), lambda i: [CAST(ascii(substr(k, CAST(i + 1 AS INTEGER), 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
        lambda c, b: xor(xor(c, b) >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END), 4294967295), 4294967295) % 20 AS f
    FROM keyed
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
        CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM summed, range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
),
bare AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t, substr(role, 1, 1) AS c FROM damaged),
copied AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS copy FROM bare),
rows AS (
    SELECT conv_id, turn, role, text, c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
        CASE WHEN t = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate' WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
    FROM copied
),
paired AS (SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM rows),
ids AS (SELECT DISTINCT conv_id FROM conversations),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM paired GROUP BY conv_id
),
inserted(q, p, cost, text) AS (
    VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 2, 2, 'I'), (1, 3, 4, 'II'),
        (2, 3, 2, 'I'), (3, 2, 2, 'I')
),
edits(p, c, q, cost, text) AS (
    VALUES (0, 's', 1, 0, 'K'), (0, 'u', 2, 0, 'K'), (1, 'u', 2, 0, 'K'), (2, 'a', 3, 0, 'K'), (3, 'u', 2, 0, 'K'),
        (0, NULL, 2, 2, 'R'), (1, NULL, 2, 2, 'R'), (2, NULL, 3, 2, 'R'), (3, NULL, 2, 2, 'R'),
        (0, NULL, 0, 3, 'D'), (1, NULL, 1, 3, 'D'), (2, NULL, 2, 3, 'D'), (3, NULL, 3, 3, 'D')
),
walk(conv_id, i, q, best) AS (
    SELECT conv_id, CAST(0 AS BIGINT), 0, {'cost': 0, 'text': ''} FROM ids
    UNION ALL
    SELECT w.conv_id, w.i + 1, e.q, min({'cost': w.best.cost + n.cost + e.cost
        + CASE WHEN r.fault = 'truncated' AND e.text <> 'D' THEN 1 ELSE 0 END, 'text': w.best.text || n.text || e.text})
    FROM walk w JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
        JOIN inserted n ON n.q = w.q
        JOIN edits e ON e.p = n.p AND (e.c IS NULL OR e.c = r.c) AND (e.text = 'D' OR r.fault IS NULL OR r.fault = 'truncated')
    GROUP BY w.conv_id, w.i, e.q
),
ended AS (
    SELECT w.conv_id, min({'cost': w.best.cost + n.cost, 'text': w.best.text || n.text}) AS best
    FROM walk w LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id JOIN inserted n ON n.q = w.q AND n.p IN (0, 3)
    WHERE w.i = coalesce(c.n, 0) GROUP BY w.conv_id
),
letters AS (
    SELECT e.conv_id, k, substr(e.best.text, CAST(k AS INTEGER), 1) AS letter,
        length(replace(substr(e.best.text, 1, CAST(k AS INTEGER)), 'I', '')) AS i
    FROM ended e, range(1, 1 + length(e.best.text)) AS x(k)
),
left_over AS (
    SELECT l.*, r.role, r.text, row_number() OVER (PARTITION BY l.conv_id ORDER BY k) AS place,
        count(*) FILTER (l.letter = 'K' AND r.c = 's') OVER (PARTITION BY l.conv_id) AS systems
    FROM letters l LEFT JOIN rows r ON l.letter <> 'I' AND r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i WHERE l.letter <> 'D'
),
repaired AS (
    SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - systems) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY place)) AS digest
    FROM left_over GROUP BY conv_id
)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(e.best.cost AS BIGINT) AS cost, e.best.text AS audit,
    coalesce(digest, sha256('')) AS repaired_sha256
FROM ids i JOIN ended e ON e.conv_id IS NOT DISTINCT FROM i.conv_id
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM i.conv_id
"""


# A conversation of the contract whose texts hold marks of many templates.
MARKED = r"\### Assistant: </turn> ok"


@query
def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = [F.struct(F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role")) for k, role in enumerate(("user", "assistant"))]
    added = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.inline(F.array(*rows))).withColumn("text", F.lit(MARKED))
    return read_back(formatted(given.unionByName(added)))


# A mark or an ambiguous backslash costs one character more.
SQL["op13_chat"] = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
),
w AS (
    SELECT *, 14 + length(role) + length(text)
        + len(regexp_extract_all(role, '### |</turn>|: ')) + len(regexp_extract_all(text, '### |</turn>'))
        + length(role || text) - length(replace(role || text, '\', ''))
        - len(regexp_extract_all(role, '\\[^\\#<:]')) - len(regexp_extract_all(text, '\\[^\\#<:]')) AS chars
    FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM w GROUP BY conv_id
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


SQL["op6_vectors"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS w, label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
    FROM embeddings
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.w) = len(b.w)
    WHERE a.usable AND b.usable AND list_cosine_similarity(a.w, b.w) >= 0.98
),
reached(a, b) AS (
    SELECT vec_id, vec_id FROM v
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
),
named AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM named LEFT JOIN counted USING (vec_id)
"""
