"""Tables the queries run on, derived from the given ones.

Each is one SELECT that Spark and DuckDB both run, so both sides of a comparison
start from the same rows; ``{name}`` stands for a given or a derived table. Every
rule reads whole tables: each order, document or line item takes part.

Spark stores a derived table once per session in the scratch folder, as a user
would store the input of these operators, so the queries measure the operators.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from seedloom.session import scratch
from seedloom.sources.files import store

GIVEN = frozenset(
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations".split()
)



def json_text(text: str) -> str:
    """SQL for a piece of JSON: quotes and braces by number, as both engines and the slots read them otherwise."""
    for sign in '"{}':
        text = text.replace(sign, f"\0{ord(sign)}\0")
    parts = [f"chr({part})" if at % 2 else f"'{part}'" for at, part in enumerate(text.split("\0")) if at % 2 or part]
    return " || ".join(parts)


def json_escaped(column: str) -> str:
    """SQL for a text inside the quotes of a JSON string."""
    for code, name in ((92, "chr(92)"), (34, "chr(34)"), (10, "'n'"), (9, "'t'"), (13, "'r'")):
        column = f"replace({column}, chr({code}), chr(92) || {name})"
    return column


DERIVED = {
    # one text-to-SQL case per order
    "cases": """
        SELECT o.o_orderkey AS ex_id, o.o_custkey AS cust, o.o_orderpriority AS priority,
               o.o_orderstatus AS status, o.o_totalprice AS price, lower(c.c_mktsegment) AS domain,
               'Which orders did customer ' || c.c_name || ' place with priority ' || o.o_orderpriority || '?' AS question,
               'CREATE TABLE orders (o_orderkey INT, o_custkey INT, o_orderpriority TEXT);' AS schema,
               CASE WHEN o.o_orderkey % 20 < 10 THEN 'basic SQL'
                    WHEN o.o_orderkey % 20 < 13 THEN 'single join'
                    WHEN o.o_orderkey % 20 < 15 THEN 'aggregation'
                    WHEN o.o_orderkey % 20 = 15 THEN 'multiple joins'
                    WHEN o.o_orderkey % 20 = 16 THEN 'subqueries'
                    WHEN o.o_orderkey % 20 = 17 THEN 'window functions'
                    WHEN o.o_orderkey % 20 = 18 THEN 'CTEs'
                    ELSE 'EXCEPT and INTERSECT' END AS complexity,
               CASE WHEN o.o_orderkey % 20 < 10
                    THEN 'SELECT o_orderkey FROM orders WHERE o_custkey = ' || o.o_custkey || ';'
                    WHEN o.o_orderkey % 20 < 13
                    THEN 'SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey;'
                    WHEN o.o_orderkey % 20 < 15
                    THEN 'SELECT o_custkey, COUNT(*) FROM orders GROUP BY o_custkey HAVING COUNT(*) > 3;'
                    WHEN o.o_orderkey % 20 = 15
                    THEN 'SELECT l.l_partkey FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey;'
                    WHEN o.o_orderkey % 20 = 16
                    THEN 'SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer);'
                    WHEN o.o_orderkey % 20 = 17
                    THEN 'SELECT o_orderkey, RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) FROM orders;'
                    WHEN o.o_orderkey % 20 = 18
                    THEN 'WITH big AS (SELECT o_orderkey FROM orders) SELECT COUNT(*) FROM big;'
                    ELSE 'SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer;' END AS gold
        FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey""",
    # raw seed rows with every defect the seed filter looks for
    "raw_examples": """
        SELECT ex_id,
               CASE WHEN ex_id % 97 = 3 THEN 'Short?'
                    ELSE 'Which orders did customer ' || cust || ' place?' || chr(9) END AS sql_prompt,
               CASE WHEN ex_id % 97 = 2 THEN 'orders (o_orderkey INT, o_custkey INT);'
                    WHEN ex_id % 97 = 5
                    THEN 'Create Table orders (o_orderkey INT, o_custkey INT);' || repeat(' ', 1500)
                    ELSE 'Create Table orders (o_orderkey INT, o_custkey INT);' || chr(10) END AS sql_context,
               CASE WHEN ex_id % 97 = 0 THEN 'SELECT 1'
                    WHEN ex_id % 97 = 1 THEN gold || ' -- TODO check'
                    WHEN ex_id % 97 = 4 THEN gold || repeat(' -- a longer remark', 40)
                    WHEN ex_id % 11 = 0 THEN '  ' || gold
                    ELSE gold END AS sql,
               CASE WHEN ex_id % 4 <> 0 THEN 'Looks up the orders of customer ' || cust || '. ' END AS sql_explanation,
               domain, complexity AS sql_complexity,
               CASE WHEN ex_id % 9 <> 0 THEN lower(priority) END AS sql_task_type
        FROM {cases}""",
    # rows after the model calls, with good and bad fields
    "enriched": """
        SELECT ex_id, 'Which orders did customer ' || cust || ' place?' AS question,
               'CREATE TABLE orders (o_orderkey INT, o_custkey INT);' AS schema,
               gold AS sql, complexity, domain,
               CASE WHEN ex_id % 13 = 1 THEN '' WHEN ex_id % 13 = 2 THEN 'Too short'
                    ELSE 'How many orders has customer ' || cust || ' placed by priority?' END AS upgraded_question,
               CASE ex_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'SELECT'
                    WHEN 2 THEN gold
                    WHEN 3 THEN 'SELECT COUNT(* FROM orders WHERE o_custkey = ' || cust
                    WHEN 4 THEN 'DELETE FROM orders WHERE o_custkey = ' || cust
                    ELSE 'WITH own AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) '
                         || 'SELECT c.c_name, own.n FROM own JOIN customer c ON c.c_custkey = own.o_custkey'
               END AS upgraded_sql,
               CASE WHEN ex_id % 3 <> 0 THEN 'CTEs' END AS upgraded_complexity,
               'CREATE TABLE trips (id INT, driver TEXT, fare REAL);' AS variant_schema,
               CASE WHEN ex_id % 5 = 0 THEN '' ELSE 'Which driver earned the most fares?' END AS variant_question,
               CASE WHEN ex_id % 19 = 0 THEN '[MOCK] SELECT driver FROM trips'
                    ELSE 'SELECT driver FROM trips GROUP BY driver ORDER BY SUM(fare) DESC LIMIT 1' END AS variant_sql,
               CASE ex_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'Short trace.'
                    WHEN 2 THEN repeat('Then we filter. ', 80)
                    WHEN 3 THEN ' Step 1: SELECT the orders. Next, filter WHERE the customer is ' || cust || '. 2. Done. '
                    ELSE 'Step 1: Identify tables. Step 2: JOIN users with orders. Step 3: GROUP BY user_id.'
               END AS reasoning_trace,
               CASE ex_id % 10 WHEN 0 THEN CAST(-1 AS DOUBLE) WHEN 1 THEN CAST(NULL AS DOUBLE)
                    ELSE CAST(0.85 AS DOUBLE) END AS quality_score
        FROM {cases}""",
    # documents as seed rows of the enrichment
    "doc_rows": """
        SELECT doc_id AS ex_id,
               'Which passages of ' || source || ' are written in ' || lang || ' like this one? ' || text AS question,
               'CREATE TABLE documents (doc_id INT, source TEXT, lang TEXT);' AS schema,
               'SELECT doc_id FROM documents WHERE lang = {{ lang }} AND n_chars = ' || n_chars || ';' AS sql,
               CASE lang WHEN 'en' THEN 'basic SQL' WHEN 'fr' THEN 'aggregation'
                         WHEN 'de' THEN 'window functions' ELSE 'CTEs' END AS complexity,
               source AS domain, lang AS task_type
        FROM {documents}""",
    # model answers per document and stage, whole texts inside; a second answer of two stages for long
    # documents, and a request sent again for others
    "answers": """
        SELECT d.doc_id AS ex_id, 'upgrade' AS stage,
               'Sure.' || chr(10) || '[QUESTION]' || chr(10)
               || CASE WHEN l.quality = 0 THEN ' ' ELSE 'How many passages of ' || d.source || ' are there?' END
               || chr(10) || '[/QUESTION]' || chr(10) || '[SQL]' || chr(10) || 'SELECT COUNT(*) FROM documents'
               || CASE WHEN l.toxic = 1 THEN '' ELSE chr(10) || '[/SQL]' END
               || '[COMPLEXITY]aggregation[/COMPLEXITY][SQL]SELECT 2[/SQL]' AS first_answer,
               CASE WHEN d.n_chars > 3000
                    THEN '[SQL]SELECT lang, COUNT(*) FROM documents GROUP BY lang[/SQL][QUESTION]Per language?[/QUESTION]'
               END AS second_answer
        FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id
        WHERE l.doc_id IS NOT NULL OR d.lang <> 'es'
        UNION ALL
        SELECT d.doc_id, 'variant',
               '[SCHEMA]CREATE TABLE words (word TEXT);[/SCHEMA][QUESTION]' || chr(9) || d.text || '[/QUESTION]'
               || '[SQL]SELECT word FROM words WHERE n = ' || d.n_chars || '[/SQL]',
               CAST(NULL AS STRING)
        FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id
        WHERE l.doc_id IS NOT NULL OR d.lang <> 'es'
        UNION ALL
        SELECT d.doc_id, 'upgrade',
               '[QUESTION]Asked once more?[/QUESTION][SQL]SELECT text FROM documents WHERE doc_id = ' || d.doc_id || '[/SQL]',
               CAST(NULL AS STRING)
        FROM {documents} d JOIN {labels} l ON l.doc_id = d.doc_id WHERE d.lang = 'fr' OR l.toxic = 1
        UNION ALL
        SELECT d.doc_id, 'trace', '[REASONING]' || chr(10) || d.text || chr(10) || '[/REASONING]',
               CASE WHEN d.n_chars > 3000 THEN '[REASONING]' || d.text END
        FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id
        WHERE l.doc_id IS NOT NULL OR d.lang <> 'es'""",
    # the answers as the bodies a service sends, some in the line of a batch result: texts as strings and as lists of
    # parts, choices without content, errors, and bodies that were cut off
    "bodies": f"""
        SELECT a.ex_id, a.stage,
               CASE WHEN d.source = 'src1' THEN {json_text('{"response":{"body":')} ELSE '' END
               || CASE WHEN l.quality = 0 AND a.stage = 'trace' THEN {json_text('{"error":{"message":"busy ')} || d.lang || {json_text('"}}')}
                       WHEN l.quality = 0 AND a.stage = 'variant' THEN {json_text('{"choices":[]}')}
                       ELSE {json_text('{"choices":[{"message":{"content":')}
                            || CASE WHEN d.lang = 'de' THEN {json_text('[{"text":"')} || a.first_text || {json_text('"},{"text":"."}]')}
                                    ELSE {json_text('"')} || a.first_text || {json_text('"')} END
                            || {json_text('},"index":3,"finish_reason":"')} || CASE WHEN d.n_chars > 5000 THEN 'length' ELSE 'stop' END
                            || {json_text('"}')}
                            || CASE WHEN a.second_text IS NOT NULL THEN {json_text(',{"text":"')} || a.second_text || {json_text('"}')} ELSE '' END
                            || CASE WHEN d.lang = 'fr' THEN {json_text(',{"message":{"content":null}}')} ELSE '' END
                            || {json_text(']}')} END
               || CASE WHEN d.source = 'src1' THEN {json_text('}}')} ELSE '' END
               || CASE WHEN l.toxic = 1 THEN ',' WHEN d.source = 'src2' AND l.quality = 1 THEN {json_text('"cut ')} ELSE '' END AS body
        FROM (SELECT ex_id, stage, {json_escaped('first_answer')} AS first_text, {json_escaped('second_answer')} AS second_text
              FROM {{answers}}) a
        JOIN {{documents}} d ON d.doc_id = a.ex_id LEFT JOIN {{labels}} l ON l.doc_id = a.ex_id""",
    # when requests went out, and when answers came: some too late, some delivered twice
    "asked": """
        SELECT ex_id, stage, CAST('2024-01-01 00:00:00' AS TIMESTAMP) + ex_id * INTERVAL '7' SECOND AS sent_at
        FROM (SELECT ex_id, 'upgrade' AS stage FROM {doc_rows} UNION ALL SELECT ex_id, 'variant' FROM {doc_rows}
              UNION ALL SELECT ex_id, 'trace' FROM {doc_rows})""",
    "came": """
        SELECT ex_id, stage, choice_idx, content,
               CAST('2024-01-01 00:00:00' AS TIMESTAMP) + (ex_id * 7 + length(content) % 5000) * INTERVAL '1' SECOND AS came_at
        FROM (SELECT ex_id, stage, CASE WHEN first_answer LIKE '[QUESTION]Asked once more%' THEN 7 ELSE 0 END AS choice_idx,
                     first_answer AS content FROM {answers}
              UNION ALL
              SELECT ex_id, stage, 1, second_answer FROM {answers} WHERE second_answer IS NOT NULL
              UNION ALL
              SELECT a.ex_id, a.stage, 0, a.first_answer FROM {answers} a JOIN {documents} d ON d.doc_id = a.ex_id
              WHERE d.lang = 'de' AND a.stage = 'trace')""",
    # predictions that differ from the gold query in spelling or in meaning; some orders have none
    "predictions": """
        SELECT ex_id,
               CASE priority WHEN '1-URGENT' THEN '  ' || replace(upper(gold), ' ', '  ') || ';;'
                    WHEN '2-HIGH' THEN '<think>Look at customer ' || cust || chr(10) || 'then filter.</think>'
                                       || chr(10) || chr(10) || gold
                    WHEN '3-MEDIUM' THEN replace(gold, ';', '')
                    WHEN '4-NOT SPECIFIED' THEN replace(gold, ';', ' ;')
                    ELSE 'SELECT ' || cust || ' FROM orders' END AS pred_sql
        FROM {cases} WHERE status <> 'P' OR price <= 400000""",
    # gold and predicted queries over a database of the order's own values
    "runs": """
        SELECT ex_id, 'Orders of customer ' || cust AS question, complexity,
               'CREATE TABLE orders (o_orderkey INT, o_custkey INT, o_orderpriority TEXT); INSERT INTO orders VALUES ('
               || ex_id || ', ' || cust || ', ' || chr(39) || priority || chr(39) || '); CREATE TABLE broken (;' AS schema,
               CASE priority WHEN '1-URGENT' THEN 'SELECT o_orderkey, o_orderpriority FROM orders'
                    WHEN '2-HIGH' THEN 'SELECT COUNT(*) FROM orders'
                    WHEN '3-MEDIUM' THEN 'SELECT o_orderkey FROM orders WHERE o_custkey < 0'
                    WHEN '4-NOT SPECIFIED' THEN 'SELECT o_custkey FROM orders UNION ALL SELECT o_custkey FROM orders'
                    ELSE 'SELECT missing FROM orders' END AS gold_sql,
               CASE status WHEN 'F' THEN 'SELECT o_orderkey, o_orderpriority FROM orders'
                    WHEN 'O' THEN 'SELECT o_custkey FROM orders' ELSE '' END AS pred_sql
        FROM {cases}""",
    # result rows of both sides, as if queried from the order's line items
    "result_rows": """
        SELECT l_orderkey AS ex_id, 'gold' AS side, '(' || l_partkey || ', ' || l_linenumber || ')' AS row_repr
        FROM {lineitem} WHERE l_returnflag = 'R'
        UNION ALL
        SELECT l_orderkey, 'pred', '(' || l_partkey || ', ' || l_linenumber || ')'
        FROM {lineitem} WHERE l_returnflag = 'R' OR (l_returnflag = 'A' AND l_quantity > 40)""",
    "run_status": """
        SELECT o_orderkey AS ex_id, 'gold' AS side, TRUE AS ok, CAST(NULL AS STRING) AS error FROM {orders}
        WHERE o_orderstatus <> 'P' OR o_orderpriority <> '1-URGENT'
        UNION ALL
        SELECT o_orderkey, 'pred', NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW'),
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'no such column' END
        FROM {orders} WHERE o_orderstatus <> 'P' OR o_orderpriority <> '1-URGENT'""",
}

#: A projection of one given table, with its texts inside: read from there, as a copy would only take its size again.
VIEWS = frozenset({"doc_rows"})
#: Tables with whole texts inside that, where another is derived from them, need not be stored for that.
ON_THE_WAY = VIEWS | {"answers"}

_SLOT = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


@cache
def needs(name: str) -> tuple[str, ...]:
    return tuple(sorted(set(_SLOT.findall(DERIVED[name]))))


_stored: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores where the input has fewer parts than that; the rows are the same either way.

    Only the small test tables are dealt anew: a large input has more parts than cores
    and comes back as it is, unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def made(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a derived table, not stored."""
    needed = {}
    for need in needs(name):
        needed[need] = (passing if need in ON_THE_WAY else table)(spark, sf_dir, need)
    return spark.sql(DERIVED[name], **needed)


def is_stored(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether the session has stored a frame under the name."""
    return (spark.conf.get("spark.app.id", ""), sf_dir, name) in _stored


def passing(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a derived table for one who stores them again: read where the table is stored, else made on the way."""
    return table(spark, sf_dir, name) if is_stored(spark, sf_dir, name) else made(spark, sf_dir, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given or derived table as a DataFrame."""
    if name in GIVEN:
        return given(spark, sf_dir, name)
    if name in VIEWS:
        return made(spark, sf_dir, name)
    return stored_frame(spark, sf_dir, name, lambda: made(spark, sf_dir, name))


def stored_frame(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A frame stored once per session under a name, for queries that share it."""
    place = (spark.conf.get("spark.app.id", ""), sf_dir, name)
    if place not in _stored:
        frame, path = make(), scratch(spark, name)
        store(frame, path)
        _stored[place] = path, frame.schema
    path, schema = _stored[place]
    return spark.read.schema(schema).parquet(path)


def stored_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of a stored derived table, for queries that read files themselves."""
    stored_frame(spark, sf_dir, name, lambda: made(spark, sf_dir, name))
    return _stored[(spark.conf.get("spark.app.id", ""), sf_dir, name)][0]


def with_tables(body: str, *names: str) -> str:
    """DuckDB text: the derived tables the body reads as CTEs, then the body.

    A body that starts with further CTEs begins with ``, name AS (``.
    """
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in GIVEN or name in ordered:
            return
        for need in needs(name):
            visit(need)
        ordered.append(name)

    for name in names:
        visit(name)
    parts = [
        f"{name} AS ({_SLOT.sub(r'\1', DERIVED[name]).replace('{{', '{').replace('}}', '}')})" for name in ordered
    ]
    body = body.strip()
    if not parts:
        return f"WITH {body[1:].strip()}" if body.startswith(",") else body
    return "WITH " + ",\n".join(parts) + ("\n" if not body.startswith(",") else "") + body
