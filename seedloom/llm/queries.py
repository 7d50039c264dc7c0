"""The queries of this package, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedloom.llm import alignment, bpe, chat_views, jaccard_join, packing, pii, quality_classifier, quality_rules, repeats, token_counts, topk, url_filter, whitening
from seedloom.llm.frames import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB text of the queries that SQL can express.
SQL: dict[str, str] = {}
TOKENIZER = "byte_bpe_50k.json"
LEAST_SCORE = 0.3


def query(make):
    QUERIES[make.__name__] = make
    return make


@query
def op1_quality_rules(spark, sf):
    judged = quality_rules.judge(read(spark, sf, "documents").select("doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id", *[f"quality.{count}" for count in counts], "quality.base_failed", "quality.kept", "quality.posterior"
    )


URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query
def op2_url_filter(spark, sf):
    judged = url_filter.judge(read(spark, sf, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "judged.*")


SQL["op2_url_filter"] = r"""
    WITH RECURSIVE parsed AS MATERIALIZED (
        SELECT row_number() OVER () AS row, page_id,
               translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
               coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '') AS query
        FROM pages
    ), ruled AS MATERIALIZED (
        SELECT *, CASE
            WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
        FROM parsed
    ), given AS MATERIALIZED (
        SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS given FROM ruled
    ), tok AS MATERIALIZED (
        SELECT DISTINCT row, given, token FROM (
            SELECT row, given, 'host:' || x AS token FROM (SELECT row, given, unnest(string_split(host, '.')) AS x FROM given) WHERE x <> ''
            UNION ALL
            SELECT row, given, 'path:' || regexp_replace(x, '[0-9]+', '0', 'g') FROM (SELECT row, given, unnest(string_split(path, '/')) AS x FROM given) WHERE x <> ''
            UNION ALL
            SELECT row, given, 'key:' || regexp_extract(x, '^[^=]*') FROM (SELECT row, given, unnest(string_split(query, '&')) AS x FROM given) WHERE regexp_extract(x, '^[^=]*') <> '')
    ), combos AS (
        SELECT row, given, 1 AS size, token AS last, token AS name FROM tok
        UNION ALL
        SELECT c.row, c.given, c.size + 1, t.token, c.name || ' ' || t.token
        FROM combos c JOIN tok t ON t.row = c.row AND t.token > c.last
    ), examples AS (SELECT count(*) AS n FROM given WHERE given IS NOT NULL
    ), rules AS (
        SELECT name, size, verdict, n_both, n_both::DOUBLE / n_all::DOUBLE AS confidence FROM (
            SELECT name, size, count(*) AS n_all, count(*) FILTER (given = 'block') AS n_block, count(*) FILTER (given = 'allow') AS n_allow
            FROM combos WHERE given IS NOT NULL GROUP BY ALL
        ), LATERAL (SELECT 'block' AS verdict, n_block AS n_both UNION ALL SELECT 'allow', n_allow)
        WHERE n_both >= ceil(0.01 * (SELECT n FROM examples)) AND n_both > 0 AND n_both::DOUBLE / n_all::DOUBLE >= 0.8
    ), mined AS (
        SELECT row, verdict FROM combos JOIN rules USING (name, size) WHERE given IS NULL
        QUALIFY row_number() OVER (PARTITION BY row ORDER BY confidence DESC, n_both DESC, size DESC, name, verdict) = 1
    )
    SELECT page_id, host, path, rule, coalesce(given, verdict, 'allow') AS verdict FROM given LEFT JOIN mined USING (row)"""


@query
def op4_chat_views(spark, sf):
    return chat_views.views(read(spark, sf, "conversations")).withColumnRenamed("conversation", "conv_id")


SQL["op4_chat_views"] = """
    WITH turns AS MATERIALIZED (
        SELECT row_number() OVER () AS row, conv_id, turn, role AS speaker, coalesce(text, '') AS text FROM conversations
    ), people AS (
        SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE coalesce(speaker <> 'system', true)
    ), rendered AS (
        SELECT t.*, p.perspective, t.speaker IS NOT DISTINCT FROM p.perspective AS own,
               '<|im_start|>' || CASE WHEN t.speaker IS NOT DISTINCT FROM p.perspective THEN 'assistant'
                                      WHEN t.speaker = 'system' THEN 'system'
                                      ELSE 'user' || coalesce(' name=' || t.speaker, '') END || chr(10) AS head
        FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
    ), placed AS (
        SELECT *, head || text || '<|im_end|>' || chr(10) AS segment,
               coalesce(sum(length(head) + length(text) + 11) OVER (
                   PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker NULLS FIRST, text, row
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
        FROM rendered
    )
    SELECT conv_id, perspective, turn, speaker, segment, start::BIGINT AS start, length(segment) AS length,
           CASE WHEN own THEN (start + length(head))::BIGINT END AS loss_start,
           CASE WHEN own THEN length(text) + 10 ELSE 0 END AS loss_length
    FROM placed"""


@query
def op3_token_counts(spark, sf):
    documents = read(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = token_counts.count_tokens(documents, public_tokenizers.path(TOKENIZER))
    return counted.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > 512).alias("over_limit"),
    )


@query
def op5_bpe(spark, sf):
    path = public_tokenizers.path(TOKENIZER)
    coded = bpe.encode_and_decode(read(spark, sf, "documents").select("doc_id", "text"), path)
    return coded.select(
        "doc_id", bpe.n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: For tests and queries only: a real run takes its key from a secret store.
EXAMPLE_KEY = b"an example key, not a secret"


@query
def op6_pii(spark, sf):
    done = pii.pseudonymize(read(spark, sf, "documents").select("doc_id", "text"), EXAMPLE_KEY)
    counts = [F.col(f"found.{kind.name}").alias(f"n_{kind.name}") for kind in pii.KINDS]
    return done.select("doc_id", "text", *counts)


@query
def op7_jaccard_join(spark, sf):
    joined = jaccard_join.JaccardJoin(read(spark, sf, "documents")).components()
    return joined.select(
        F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


SQL["op7_jaccard_join"] = r"""
    WITH RECURSIVE words AS MATERIALIZED (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), sets AS MATERIALIZED (
        SELECT DISTINCT doc_id, shingle FROM (
            SELECT doc_id, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')) END) AS shingle
            FROM words WHERE len(w) > 0)
    ), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
    ), links AS MATERIALIZED (
        SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
    ), reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents
        UNION
        SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
    )
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
    FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
    JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id"""


@query
def op8_quality_classifier(spark, sf):
    documents = read(spark, sf, "documents").select("doc_id", "text")
    labelled = quality_classifier.labelled_rows(documents, read(spark, sf, "labels"))
    scored = quality_classifier.score_texts(documents, quality_classifier.fit(labelled))
    return scored.select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"),
    )


@query
def op9_exact_topk(spark, sf):
    return topk.top_k(read(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


SQL["op9_exact_topk"] = """
    WITH rows AS MATERIALIZED (
        SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256.0)) AS v
        FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = len(embedding)
    ), scored AS (
        SELECT q.row AS query_row, q.vec_id AS query_id, c.row AS row, c.vec_id AS vec_id,
               list_inner_product(q.v, c.v)::BIGINT AS score
        FROM rows q JOIN rows c ON q.vec_id % 50 = 0 AND q.row <> c.row
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id NULLS LAST, row) AS rank FROM scored
    )
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query
def op10_packing(spark, sf):
    pieces = packing.pack_texts(read(spark, sf, "documents"), public_tokenizers.path(TOKENIZER), end_id=1)
    return pieces.select(
        F.col("key").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


PIECES = "piece_bpe_32k.model"


@query
def op11_alignment(spark, sf):
    documents = read(spark, sf, "documents")
    paths = public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES)
    return alignment.align(documents, *paths, keep_groups=False)[0].drop("groups").withColumnRenamed("key", "doc_id")


@query
def op12_repeats(spark, sf):
    done, _ = repeats.remove_repeats(read(spark, sf, "documents"), keep_text=False)
    return done.select(F.col("key").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


SQL["op12_repeats"] = r"""
    WITH texts AS MATERIALIZED (
        SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), words AS MATERIALIZED (SELECT row, generate_subscripts(w, 1) AS place, unnest(w) AS word FROM texts
    ), windows AS MATERIALIZED (
        SELECT row, doc_id, place, array_to_string(w[place:place+12], ' ') AS words
        FROM (SELECT *, unnest(range(1, len(w) - 11)) AS place FROM texts WHERE len(w) >= 13)
    ), firsts AS (SELECT words, min(doc_id) AS first FROM windows GROUP BY words
    ), covered AS (
        SELECT DISTINCT row, place + unnest(range(0, 13)) AS place, true AS gone FROM windows JOIN firsts USING (words)
        WHERE first < coalesce(doc_id, 9223372036854775807)
    ), left_over AS (
        SELECT row, count(gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY place) FILTER (gone IS NULL), '') AS kept
        FROM words LEFT JOIN covered USING (row, place) GROUP BY row
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM texts LEFT JOIN left_over USING (row)"""


@query
def op13_whitening(spark, sf):
    rows = whitening.whiten(read(spark, sf, "embeddings").select("vec_id", "embedding"))
    components = rows.select("vec_id", "white.n", "white.deviation", "white.identity_error", F.explode("white.components").alias("of"))
    return components.select(
        "vec_id", "of.component", "n", F.col("deviation").try_cast("long").alias("deviation"), "of.whitened", "of.explained",
        "identity_error",
    )


#: Training sequences for dialogues: what bears loss fills up before the tokens do.
CHAT_LIMITS = packing.Limits(tokens=2048, segments=24, loss_tokens=768)


@query
def chat_packing(spark, sf):
    """Turns of all chat views as instruction data: what their speakers say bears loss, the rest is prompt."""
    turns = chat_views.views(read(spark, sf, "conversations"))
    prompt = F.coalesce(F.col("loss_start") - F.col("start"), F.col("length"))
    pieces = packing.pack_texts(
        turns.withColumn("prompt", prompt), public_tokenizers.path(TOKENIZER), end_id=1, key="conversation", text="segment",
        loss_from="prompt", limits=CHAT_LIMITS,
    )
    return pieces.select(
        F.col("key").alias("conv_id"), "start", "length", "loss_tokens", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
