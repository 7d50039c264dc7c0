"""The same queries as SQL text for DuckDB, written independently of the Spark plans."""

from __future__ import annotations

import re

from seedloom import fixed
from seedloom.functions.text import WHITESPACE
from workload import with_tables

SEED = 42


def q(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim(coalesce({x}, ''), {q(WHITESPACE)})"


def dbl(value: float) -> str:
    return f"CAST({value} AS DOUBLE)"


def key(expr: str, purpose: str) -> str:
    return f"md5({q(f'{SEED}|{purpose}|')} || {expr})"


def contains_any(x: str, marks) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(m)})" for m in marks) + ")"


def features(x: str) -> str:
    return "(" + " + ".join(
        f"CAST({contains_any(f'upper({x})', marks)} AS INT)" for marks in fixed.SQL_MARKS.values() if marks
    ) + ")"


def plausible(x: str) -> str:
    openers = " OR ".join(f"starts_with(upper({strip(x)}), {q(w)})" for w in fixed.SQL_OPENERS)
    return (
        f"(length({strip(x)}) >= 10 AND ({openers}) "
        f"AND length({x}) - length(replace({x}, '(', '')) = length({x}) - length(replace({x}, ')', '')) "
        f"AND NOT {contains_any(x, fixed.SQL_PLACEHOLDERS)})"
    )


def ascii_text(x: str) -> str:
    """Letters and digits outside ASCII as x, all else outside ASCII as a space: RE2's \\b is ASCII only."""
    return (
        rf"regexp_replace(regexp_replace({x}, '[^\x00-\x7F\p{{L}}\p{{N}}]', ' ', 'g'), '[^\x00-\x7F]', 'x', 'g')"
    )


def keywords(x: str) -> str:
    return rf"len(regexp_extract_all({ascii_text(x)}, '\b(?:{'|'.join(fixed.TRACE_KEYWORDS)})\b', 0, 'i'))"


def steps(x: str) -> str:
    return rf"len(regexp_extract_all({ascii_text(x)}, '\b(?:{'|'.join(fixed.TRACE_STEPS)})\b|\d+\.', 0, 'i'))"


def trace_score(x: str) -> str:
    return (
        f"CASE WHEN length({strip(x)}) < 50 THEN {dbl(0)} ELSE least({dbl(1)}, "
        f"least({dbl(0.3)}, length({x}) / {dbl(1000)}) + least({dbl(0.4)}, {keywords(x)} * {dbl(0.08)}) "
        f"+ least({dbl(0.3)}, {steps(x)} * {dbl(0.06)})) END"
    )


def rounded(x: str, digits: int) -> str:
    return f"CAST(printf('%.{digits}f', {x}) AS DOUBLE)"


PARTS = f"""
    SELECT ex_id,
           CASE WHEN NOT {plausible('upgraded_sql')} THEN {dbl(0)}
                WHEN {features('upgraded_sql')} > {features('sql')} THEN {dbl(1)}
                WHEN {features('upgraded_sql')} = {features('sql')} THEN {dbl(0.6)} ELSE {dbl(0.2)} END AS u,
           CASE WHEN {plausible('variant_sql')} THEN {dbl(0.9)} ELSE {dbl(0.1)} END AS v,
           CASE WHEN length(upgraded_question) > 15 THEN {dbl(0.5)} ELSE {dbl(0)} END
           + CASE WHEN length(variant_question) > 15 THEN {dbl(0.5)} ELSE {dbl(0)} END AS qs,
           {trace_score('reasoning_trace')} AS t,
           length({strip('reasoning_trace')}) >= 50 AS scored, length(reasoning_trace) AS n,
           {keywords('reasoning_trace')} AS kw, {steps('reasoning_trace')} AS st
    FROM enriched"""
SCORE = rounded(f"u * {dbl(0.35)} + v * {dbl(0.25)} + qs * {dbl(0.15)} + t * {dbl(0.25)}", 3)
EXACT = (
    "((35 * CAST(round(u * 1000) AS BIGINT) + 25 * CAST(round(v * 1000) AS BIGINT) "
    "+ 15 * CAST(round(qs * 1000) AS BIGINT) + 25 * (CASE WHEN scored THEN least(300, n) + least(400, 80 * kw) "
    f"+ least(300, 60 * st) ELSE 0 END) + 50) // 100) / {dbl(1000)}"
)

GOOD_SEED = (
    "length(sql) BETWEEN 20 AND 600 AND length(sql_context) <= 1500 AND length(sql_prompt) >= 10 "
    "AND contains(upper(sql_context), 'CREATE TABLE') AND NOT contains(sql, 'TODO') AND NOT contains(sql, 'FIXME')"
)
NORMAL_SEED = f"""
    SELECT ex_id, {strip('sql_prompt')} AS question, {strip('sql_context')} AS schema, {strip('sql')} AS sql,
           {strip('sql_explanation')} AS explanation, coalesce(domain, 'unknown') AS domain,
           coalesce(sql_complexity, 'unknown') AS complexity,
           coalesce(sql_task_type, 'analytics and reporting') AS task_type,
           {q(fixed.SEED_SOURCE)} AS source, 'seed' AS split
    FROM raw_examples"""
LEVELS = "(VALUES " + ", ".join(f"({q(name)}, {at})" for at, name in enumerate(fixed.LEVELS)) + ") lv(level, ord)"

EXAMPLES = """
    SELECT 'seed_with_reasoning/' || ex_id AS example_id, question, schema, sql, reasoning_trace AS thinking,
           complexity, domain, 'seed_with_reasoning' AS source, coalesce(quality_score, 1) AS quality_score
    FROM enriched WHERE coalesce(quality_score, 1) >= 0
    UNION ALL
    SELECT 'synthetic_upgraded/' || ex_id, upgraded_question, schema, upgraded_sql, '',
           coalesce(upgraded_complexity, 'unknown'), domain, 'synthetic_upgraded', coalesce(quality_score, 1)
    FROM enriched WHERE coalesce(quality_score, 1) >= 0 AND upgraded_question <> '' AND upgraded_sql <> ''
    UNION ALL
    SELECT 'synthetic_variant/' || ex_id, variant_question, variant_schema, variant_sql, '',
           complexity, domain, 'synthetic_variant', coalesce(quality_score, 1)
    FROM enriched WHERE coalesce(quality_score, 1) >= 0 AND variant_question <> ''
         AND NOT starts_with(variant_sql, '[MOCK]')"""
SEED_EXAMPLES = f"""
    SELECT 'seed/' || ex_id AS example_id, question, schema, sql, '' AS thinking, complexity, domain, source,
           {dbl(1)} AS quality_score
    FROM good"""
GOOD = f"SELECT * FROM ({NORMAL_SEED} WHERE {GOOD_SEED})"
MIXED = f""", good AS ({GOOD}), seeds AS ({SEED_EXAMPLES}), made AS ({EXAMPLES}),
    totals AS (SELECT (SELECT count(*) FROM seeds) + (SELECT count(*) FROM made) AS total),
    mixed AS (
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY {key('example_id', 'mix')}) AS rn FROM seeds)
        WHERE rn <= (SELECT CAST(trunc(total * {dbl(0.4)}) AS BIGINT) FROM totals)
        UNION ALL
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY {key('example_id', 'mix')}) AS rn FROM made)
        WHERE rn <= (SELECT CAST(trunc(total * {dbl(0.6)}) AS BIGINT) FROM totals))"""


def split_of(table: str, expr: str) -> str:
    train, evals = f"CAST(trunc(n * {dbl(0.9)}) AS BIGINT)", f"CAST(trunc(n * {dbl(0.05)}) AS BIGINT)"
    return f"""
        SELECT * EXCLUDE (rn, n), CASE WHEN rn <= {train} THEN 'train'
               WHEN rn <= {train} + {evals} THEN 'eval' ELSE 'test' END AS split
        FROM (SELECT *, row_number() OVER (ORDER BY {key(expr, 'split')}) AS rn, count(*) OVER () AS n FROM {table})"""


SPLIT = MIXED + f", labelled AS ({split_of('mixed', 'example_id')}), train AS (SELECT * FROM labelled WHERE split = 'train')"


def fill(template: str, slot: str, **columns: str) -> str:
    parts = re.split(slot, template)
    return " || ".join(
        (f"coalesce({columns.get(p, p)}, '')" if at % 2 else q(p)) for at, p in enumerate(parts) if at % 2 or p
    )


def prompt(stage: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT ex_id, {at} AS pos, {q(role)} AS role, {fill(body, r'{{ (\w+) }}')} AS content FROM doc_rows"
        for at, (role, body) in enumerate(fixed.PROMPTS[stage])
    )


CHOICES = """
    SELECT ex_id, stage, 0 AS choice_idx, first_answer AS content FROM answers
    UNION ALL SELECT ex_id, stage, 1, second_answer FROM answers WHERE second_answer IS NOT NULL"""


def tag(name: str, x: str = "content") -> str:
    return strip(rf"regexp_extract({x}, '(?s)\[{name}\](.*?)\[/{name}\]', 1)")


READ_BODIES = """, lines AS (
        SELECT ex_id, stage, CASE WHEN json_valid(body) THEN body::JSON END AS line FROM bodies),
    bodies_read AS (
        SELECT ex_id, stage, coalesce(json_extract(line, '$.response.body'), line) AS body FROM lines),
    choices_read AS (
        SELECT *, generate_subscripts(list, 1) - 1 AS place, unnest(list) AS choice
        FROM (SELECT *, CAST(json_extract(body, '$.choices') AS JSON[]) AS list FROM bodies_read WHERE json_extract(body, '$.error') IS NULL)),
    contents AS (
        SELECT ex_id, stage, coalesce(CAST(json_extract_string(choice, '$.index') AS INT), place) AS choice_idx, json_extract_string(choice, '$.finish_reason') AS finish,
               CASE json_type(choice, '$.message.content')
                    WHEN 'VARCHAR' THEN json_extract_string(choice, '$.message.content')
                    WHEN 'ARRAY' THEN array_to_string(list_transform(
                        CAST(json_extract(choice, '$.message.content') AS JSON[]), lambda p: coalesce(json_extract_string(p, '$.text'), '')), '')
                    ELSE json_extract_string(choice, '$.text') END AS content
        FROM choices_read)"""

FIELD_NAMES = [c for _, _, _, parsers in fixed.STAGES.values() for c in parsers]


def parsed_sql() -> str:
    """One row per key and choice: own answers first, else the key's first of the stage; repeats numbered on top."""
    tags = ", ".join(
        f"CASE WHEN stage = {q(stage)} THEN {tag(name)} END AS {column}"
        for stage, (_, _, _, parsers) in fixed.STAGES.items()
        for column, name in parsers.items()
    )
    has = ", ".join(f"bool_or(stage = {q(stage)}) AS has_{stage}" for stage in fixed.STAGES)
    own = ", ".join(f"max({c}) AS {c}" for c in FIELD_NAMES)
    chosen = ", ".join(
        f"coalesce(CASE WHEN s.has_{stage} THEN s.{c} ELSE f_{stage}.{c} END, '') AS {c}"
        for stage, (_, _, _, parsers) in fixed.STAGES.items()
        for c in parsers
    )
    joins = " ".join(
        f"LEFT JOIN firsts f_{stage} ON f_{stage}.ex_id = s.ex_id AND f_{stage}.stage = {q(stage)}" for stage in fixed.STAGES
    )
    return f""", choices AS ({CHOICES}), tagged AS (
        SELECT ex_id, stage, choice_idx,
               row_number() OVER (PARTITION BY ex_id, stage, choice_idx ORDER BY content) - 1 AS again, {tags}
        FROM choices),
    slots AS (SELECT ex_id, choice_idx, again, {has}, {own} FROM tagged GROUP BY ex_id, choice_idx, again),
    firsts AS (SELECT * FROM tagged QUALIFY row_number() OVER (PARTITION BY ex_id, stage ORDER BY choice_idx, again) = 1),
    lasts AS (SELECT ex_id, max(choice_idx) AS last FROM tagged GROUP BY ex_id),
    parsed AS (SELECT s.ex_id, s.choice_idx + s.again * (l.last + 1) AS choice_idx, {chosen}
               FROM slots s JOIN lasts l ON l.ex_id = s.ex_id {joins})"""


PARSED = parsed_sql()
ATTACHED = PARSED + f""", attached AS (
    SELECT d.*, coalesce(p.choice_idx, 0) AS choice_idx,
           {', '.join(f"coalesce(p.{c}, '') AS {c}" for c in FIELD_NAMES)}
    FROM doc_rows d LEFT JOIN parsed p USING (ex_id))"""
USEFUL = ATTACHED + f""", useful AS (SELECT * FROM attached WHERE {' AND '.join(
    f"{strip(c)} <> ''" for c in fixed.REQUIRED_FIELDS)})"""

USER = fill(fixed.USER_TURN, r"\{(\w+)\}")
SHOWN = f"length({strip('thinking')}) > 20"
CHAT_OK = f"{strip('question')} <> '' AND {strip('schema')} <> '' AND length({strip('sql')}) >= 10"
ASSISTANT = (
    f"CASE WHEN {SHOWN} THEN '<think>' || chr(10) || {strip('thinking')} || chr(10) || '</think>' "
    f"|| chr(10) || chr(10) || {strip('sql')} ELSE {strip('sql')} END"
)
SYSTEM = f"CASE WHEN {SHOWN} THEN {q(fixed.CHAT_SYSTEM_THINKING)} ELSE {q(fixed.CHAT_SYSTEM)} END"
CHAT_USER = fill(fixed.USER_TURN, r"\{(\w+)\}", schema=strip("schema"), question=strip("question"))


def turn(role: str, content: str) -> str:
    return f"'<|im_start|>' || {role} || chr(10) || {content} || '<|im_end|>' || chr(10)"


THINK_FREE = strip(r"regexp_replace(pred_sql, '(?s)<think>.*?</think>', '', 'g')")
SPACES = "[" + "".join(rf"\x{{{ord(c):X}}}" for c in WHITESPACE) + "]+"


def canonical(x: str) -> str:
    return f"rtrim(regexp_replace(lower({strip(x)}), {q(SPACES)}, ' ', 'g'), ';')"


ALIGNED = f""", aligned AS (
    SELECT c.ex_id, c.question, c.schema, c.gold AS gold_sql, coalesce({THINK_FREE}, '') AS pred_sql, c.complexity
    FROM cases c LEFT JOIN predictions p USING (ex_id))"""
MATCHED = """, sides AS (
        SELECT ex_id, row_repr, sum(CASE side WHEN 'pred' THEN 1 ELSE -1 END) AS surplus FROM result_rows GROUP BY ALL),
    wrong AS (SELECT DISTINCT ex_id FROM sides WHERE surplus <> 0),
    matched AS (SELECT ex_id, count(*) FILTER (ok) = 2 AND ex_id NOT IN (SELECT ex_id FROM wrong) AS execution_match
                FROM (SELECT ex_id, ok FROM run_status UNION ALL SELECT DISTINCT ex_id, FALSE FROM result_rows)
                GROUP BY ex_id)"""


def accuracy(flag: str) -> str:
    return rounded(f"count(*) FILTER ({flag}) / CAST(count(*) AS DOUBLE)", 4)


RESULTS = ALIGNED + MATCHED + f""", results AS (
    SELECT a.*, {canonical('pred_sql')} = {canonical('gold_sql')} AS exact_match,
           coalesce(m.execution_match, false) AS execution_match
    FROM aligned a LEFT JOIN matched m USING (ex_id))"""
REPORT = f""", report AS (
    SELECT CASE WHEN grouping(complexity) = 1 THEN 'overall' ELSE complexity END AS level,
           grouping(complexity) = 1 AS is_overall, count(*) AS n,
           {accuracy('exact_match')} AS exact_match, {accuracy('execution_match')} AS execution_accuracy
    FROM results GROUP BY ROLLUP (complexity))"""
ORDERED = f"""
    SELECT ord, level, n, exact_match, execution_accuracy,
           repeat('█', CAST(floor(execution_accuracy * 20) AS BIGINT)) AS bar
    FROM report LEFT JOIN {LEVELS} USING (level) WHERE NOT is_overall"""

def stratified(table: str, level: str, n: int, columns: str | None) -> str:
    """Equal quotas, then a top-up by value (``columns``) or by key, then a cut back."""
    same = "r.ex_id = t.ex_id" if columns is None else " AND ".join(
        f"r.{c} IS NOT DISTINCT FROM t.{c}" for c in columns.split()
    )
    return f"""ranked AS (
        SELECT *, row_number() OVER (PARTITION BY {level} ORDER BY {key('ex_id', 'level')}) AS rn,
               (SELECT count(DISTINCT {level}) FROM {table}) AS levels FROM {table}),
    taken AS (SELECT * FROM ranked WHERE rn <= greatest(1, {n} // levels)),
    rest AS (SELECT r.*, row_number() OVER (ORDER BY {key('r.ex_id', 'top up')}) AS pos FROM ranked r
             WHERE rn > greatest(1, {n} // levels) AND NOT EXISTS (SELECT 1 FROM taken t WHERE {same})),
    sampled AS (
        SELECT * EXCLUDE (rn, levels) FROM taken
        UNION ALL
        SELECT * EXCLUDE (rn, levels, pos) FROM rest WHERE pos <= {n} - (SELECT count(*) FROM taken))"""


SEED_VALUE = "question schema sql explanation domain complexity task_type source split"
DOCS = "documents_keyed AS (SELECT doc_id AS ex_id, lang, source, n_chars, text FROM documents)"


def bar() -> str:
    return "repeat('█', CAST(floor(n * 40 / CAST(max(n) OVER () AS DOUBLE)) AS BIGINT))"


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    # seed rows
    o["seed_quality_filter"] = with_tables(f"SELECT * FROM raw_examples WHERE {GOOD_SEED}", "raw_examples")
    o["seed_normalize"] = with_tables(NORMAL_SEED, "raw_examples")
    o["seed_kept_ratio"] = with_tables(
        f"""SELECT count(*) AS rows_before, count(*) FILTER ({GOOD_SEED}) AS rows_after,
            count(*) FILTER ({GOOD_SEED}) / CAST(count(*) AS DOUBLE) AS kept FROM raw_examples""", "raw_examples")
    o["seed_level_report"] = with_tables(
        f""", good AS ({GOOD}) SELECT ord, level, n, {bar()} AS bar FROM (
            SELECT ord, level, count(good.ex_id) AS n FROM {LEVELS} LEFT JOIN good ON complexity = level GROUP BY ord, level)""", "raw_examples")
    o["doc_length_filter"] = """
        SELECT doc_id, lang, n_chars FROM documents
        WHERE length(text) BETWEEN 200 AND 5000 AND length(source) >= 4 AND contains(upper(text), 'THE ')
          AND NOT contains(text, 'tion ') AND NOT contains(text, '###')"""
    o["stream_answers"] = with_tables("""
        SELECT r.ex_id, r.stage, a.choice_idx, a.content,
               CAST(epoch(a.came_at) - epoch(r.sent_at) AS BIGINT) AS waited
        FROM asked r LEFT JOIN (SELECT DISTINCT * FROM came) a ON a.ex_id = r.ex_id AND a.stage = r.stage
             AND a.came_at BETWEEN r.sent_at AND r.sent_at + INTERVAL '1' HOUR""", "asked", "came")
    # response bodies
    o["raw_responses"] = with_tables(
        READ_BODIES + " SELECT ex_id, stage, choice_idx, content FROM contents WHERE content IS NOT NULL", "bodies")
    o["raw_response_errors"] = with_tables(
        READ_BODIES + """
        SELECT ex_id, stage, choice_idx, CASE WHEN content IS NULL THEN 'no content' ELSE 'cut off' END AS error
        FROM contents WHERE content IS NULL OR finish = 'length'
        UNION ALL
        SELECT ex_id, stage, NULL, CASE WHEN body IS NULL THEN 'not JSON' ELSE 'service error: ' || json_extract_string(body, '$.error.message') END
        FROM bodies_read WHERE body IS NULL OR json_extract(body, '$.error') IS NOT NULL
        UNION ALL
        SELECT ex_id, stage, NULL, 'no choices' FROM bodies_read WHERE json_array_length(body, '$.choices') = 0""", "bodies")
    o["attach_raw_responses"] = with_tables(
        READ_BODIES + ", raw AS (SELECT ex_id, stage, choice_idx, content FROM contents WHERE content IS NOT NULL)"
        + ATTACHED.replace(CHOICES, "SELECT * FROM raw") + " SELECT * FROM attached", "bodies", "doc_rows")
    # scores
    o["sql_feature_count"] = with_tables(
        f"SELECT ex_id, {features('sql')} AS gold_features, {features('upgraded_sql')} AS upgraded_features FROM enriched",
        "enriched")
    o["sql_plausible"] = with_tables(
        f"SELECT ex_id, {plausible('upgraded_sql')} AS upgraded_ok, {plausible('variant_sql')} AS variant_ok FROM enriched",
        "enriched")
    o["trace_score"] = with_tables(
        f"SELECT ex_id, {trace_score('reasoning_trace')} AS trace_score FROM enriched", "enriched")
    o["trace_score_documents"] = f"""
        SELECT doc_id, {keywords('text')} AS keywords, {steps('text')} AS steps, {trace_score('text')} AS trace_score
        FROM documents"""
    o["quality_score"] = with_tables(f"SELECT ex_id, {SCORE} AS quality_score FROM ({PARTS})", "enriched")
    o["quality_score_exact"] = with_tables(f"SELECT ex_id, {EXACT} AS quality_score FROM ({PARTS})", "enriched")
    o["quality_mark"] = with_tables(
        f"""SELECT ex_id, CASE WHEN s < {dbl(0.7)} THEN {dbl(-1)} ELSE s END AS quality_score
        FROM (SELECT ex_id, {SCORE} AS s FROM ({PARTS}))""", "enriched")
    o["quality_mark_drop"] = with_tables(
        f""", scored AS (SELECT ex_id, {SCORE} AS s FROM ({PARTS})),
        remarked AS (SELECT e.* EXCLUDE (quality_score), CASE WHEN s < {dbl(0.7)} THEN -1 ELSE s END AS quality_score
                     FROM enriched e JOIN scored USING (ex_id)),
        made AS ({EXAMPLES.replace('FROM enriched', 'FROM remarked')})
        SELECT example_id, source, quality_score FROM made""", "enriched")
    o["stream_score"] = o["quality_mark"]
    # samples and splits
    o["sample_exact"] = f"""
        SELECT doc_id, lang FROM (SELECT *, row_number() OVER (ORDER BY {key('doc_id', 'sample')}) AS rn FROM documents)
        WHERE rn <= 400"""
    o["unsampled_rows"] = f"""
        WITH ranked AS (SELECT *, row_number() OVER (ORDER BY {key('doc_id', 'sample')}) AS rn FROM documents)
        SELECT doc_id, lang FROM ranked r WHERE NOT EXISTS (
            SELECT 1 FROM ranked t WHERE t.rn <= 400 AND t.text = r.text AND t.lang = r.lang)"""
    o["stratified_docs"] = f"WITH {DOCS}, {stratified('documents_keyed', 'lang', 400, 'lang source n_chars text')} SELECT ex_id, lang FROM sampled"
    o["stratified_topup"] = with_tables(
        f", good AS ({GOOD}), {stratified('good', 'complexity', 9000, SEED_VALUE)} SELECT * FROM sampled", "raw_examples")
    o["stratified_topup_by_key"] = with_tables(
        f", good AS ({GOOD}), {stratified('good', 'complexity', 9000, None)} SELECT ex_id, complexity FROM sampled",
        "raw_examples")
    o["stratified_many_levels"] = with_tables(
        f", {stratified('cases', 'cust', 5000, None)} SELECT ex_id, cust FROM sampled", "cases")
    o["keyless_sample"] = f"""
        WITH keyed AS (SELECT row_number() OVER (
            ORDER BY sha256('{{"quality":' || quality || ',"toxic":' || toxic || '}}')) AS ex_id, quality, toxic FROM labels)
        SELECT ex_id, quality, toxic FROM (SELECT *, row_number() OVER (ORDER BY {key('ex_id', 'sample')}) AS rn FROM keyed)
        WHERE rn <= 100"""
    o["stratum_report"] = """
        SELECT lang AS level, least(greatest(1, 400 // (SELECT count(DISTINCT lang) FROM documents)), count(*)) AS sampled,
               count(*) AS available FROM documents GROUP BY lang"""
    o["global_split"] = f"SELECT doc_id, split FROM ({split_of('documents', 'doc_id')})"
    o["split_by_group"] = f"""
        WITH g AS (SELECT DISTINCT conv_id FROM conversations), s AS ({split_of('g', 'conv_id')})
        SELECT conv_id, turn, split FROM conversations JOIN s USING (conv_id)"""
    o["shuffle_rank"] = f"""
        SELECT doc_id, row_number() OVER (ORDER BY {key('doc_id', 'shuffle')}) AS rank FROM documents"""
    o["batch_assign"] = f"""
        SELECT doc_id, (row_number() OVER (ORDER BY {key('doc_id', 'batch')}) - 1) // 20 AS batch_idx FROM documents"""
    # examples and mixing
    o["expand_examples"] = with_tables(EXAMPLES, "enriched")
    o["seed_examples"] = with_tables(f", good AS ({GOOD}) {SEED_EXAMPLES}", "raw_examples")
    o["mix_ratio"] = with_tables(MIXED + " SELECT * FROM mixed", "raw_examples", "enriched")
    o["mix_split"] = with_tables(SPLIT + " SELECT example_id, source, split FROM labelled", "raw_examples", "enriched")
    o["mix_split_sizes"] = with_tables(
        SPLIT + """ SELECT k.split, count(l.split) AS n FROM (VALUES ('train'), ('eval'), ('test')) k(split)
        LEFT JOIN labelled l ON l.split = k.split GROUP BY k.split""", "raw_examples", "enriched")
    o["mix_source_shares"] = with_tables(
        SPLIT + f""" SELECT source, count(*) AS n,
        count(*) / CAST((SELECT count(*) FROM train) AS DOUBLE) * {dbl(100)} AS pct FROM train GROUP BY source""",
        "raw_examples", "enriched")
    o["mix_complexity_bars"] = with_tables(
        SPLIT + f" SELECT *, {bar()} AS bar FROM (SELECT complexity, count(*) AS n FROM train GROUP BY complexity)",
        "raw_examples", "enriched")
    o["thinking_share"] = with_tables(
        SPLIT + """ SELECT count(*) FILTER (thinking <> '') AS with_thinking, count(*) AS n,
        count(*) FILTER (thinking <> '') / CAST(count(*) AS DOUBLE) AS thinking_ratio FROM train""",
        "raw_examples", "enriched")
    # enrichment
    for stage in fixed.STAGES:
        o[f"render_prompts_{stage}"] = with_tables(prompt(stage), "doc_rows")
    o["stage_requests"] = with_tables(
        "\nUNION ALL\n".join(
            f"""SELECT ex_id, {q(stage)} AS stage, {tokens} AS max_tokens, {dbl(heat)} AS temperature,
            {fill(fixed.PROMPTS[stage][1][1], r'{{ (\w+) }}')} AS user_text FROM doc_rows"""
            for stage, (tokens, heat, _, _) in fixed.STAGES.items()), "doc_rows")
    o["stream_requests"] = o["stage_requests"]
    o["stream_batches"] = f"""
        SELECT item_id, batch_idx, count(*) OVER (PARTITION BY batch_idx) AS n FROM (
            SELECT item_id, (row_number() OVER (ORDER BY {key('item_id', 'batch')}) - 1) // 20 AS batch_idx FROM benchmark)"""
    o["contract_check"] = with_tables("SELECT complexity, count(*) AS n FROM doc_rows GROUP BY complexity", "doc_rows")
    o["explode_choices"] = with_tables(CHOICES, "answers")
    o["parse_tags"] = with_tables(PARSED + " SELECT * FROM parsed", "answers")
    o["parse_tags_all"] = with_tables(
        rf""", choices AS ({CHOICES}), pieces AS (
            SELECT ex_id, stage, choice_idx, regexp_extract_all(content, '(?s)\[SQL\](.*?)\[/SQL\]', 1) AS found FROM choices),
        numbered AS (SELECT ex_id, stage, choice_idx, found, unnest(generate_series(0, len(found) - 1)) AS pos FROM pieces)
        SELECT ex_id, stage, choice_idx, pos, {strip('found[pos + 1]')} AS sql FROM numbered""", "answers")
    o["attach_completions"] = with_tables(ATTACHED + " SELECT * FROM attached", "doc_rows", "answers")
    o["required_fields"] = with_tables(USEFUL + " SELECT * FROM useful", "doc_rows", "answers")
    o["enrichment_chain"] = with_tables(
        USEFUL + f""", enriched AS (SELECT * REPLACE (ex_id || '/' || choice_idx AS ex_id) FROM useful)
        SELECT ex_id, CASE WHEN s < {dbl(0.7)} THEN {dbl(-1)} ELSE s END AS quality_score
        FROM (SELECT ex_id, {SCORE} AS s FROM ({PARTS}))""", "doc_rows", "answers")
    o["generation_summary"] = with_tables(
        USEFUL + """ SELECT 'total' AS section, 'all' AS label, count(*) AS n FROM useful
        UNION ALL SELECT 'domain', domain, n FROM (
            SELECT domain, count(*) AS n FROM useful GROUP BY domain ORDER BY n DESC, domain LIMIT 5)
        UNION ALL SELECT 'complexity', complexity, count(*) FROM useful GROUP BY complexity""", "doc_rows", "answers")
    o["dry_run_mock"] = with_tables(
        "SELECT *, '[MOCK] Harder version of: ' || question AS upgraded_question, "
        "'SELECT t1.*, COUNT(t2.id) FROM (' || sql || ') t1 LEFT JOIN orders t2 ON t1.id = t2.user_id GROUP BY t1.id' "
        "AS upgraded_sql, "
        + ", ".join(f"{dbl(v) if isinstance(v, float) else q(v)} AS {name}" for name, v in fixed.MOCK_CONSTANTS.items())
        + " FROM doc_rows ORDER BY ex_id LIMIT 5", "doc_rows")
    # chat rows
    o["chat_rows"] = with_tables(
        f""", made AS ({EXAMPLES}), ok AS (SELECT * FROM made WHERE {CHAT_OK})
        SELECT example_id, 0 AS pos, 'system' AS role, {SYSTEM} AS content FROM ok
        UNION ALL SELECT example_id, 1, 'user', {CHAT_USER} FROM ok
        UNION ALL SELECT example_id, 2, 'assistant', {ASSISTANT} FROM ok""", "enriched")
    o["chat_meta"] = with_tables(
        f""", made AS ({EXAMPLES}) SELECT example_id, complexity, domain, source, {SHOWN} AS has_thinking
        FROM made WHERE {CHAT_OK}""", "enriched")
    o["format_stats"] = with_tables(
        f""", made AS ({EXAMPLES}) SELECT count(*) AS total, count(*) FILTER ({CHAT_OK}) AS converted,
        count(*) FILTER (NOT ({CHAT_OK})) AS skipped, count(*) FILTER ({CHAT_OK} AND {SHOWN}) AS with_thinking
        FROM made""", "enriched")
    o["training_text"] = with_tables(
        f""", made AS ({EXAMPLES}) SELECT example_id, CASE WHEN {CHAT_OK} THEN
        {turn("'system'", SYSTEM)} || {turn("'user'", CHAT_USER)} || {turn("'assistant'", ASSISTANT)}
        ELSE {fill(fixed.RAW_TRAINING_TEXT, r'{(\w+)}')} END AS text FROM made""", "enriched")
    o["inference_messages"] = with_tables(
        f"""SELECT ex_id, 0 AS pos, 'system' AS role, {q(fixed.EVAL_SYSTEM)} AS content FROM doc_rows
        UNION ALL SELECT ex_id, 1, 'user', {USER} FROM doc_rows""", "doc_rows")
    o["inference_text"] = with_tables(
        f"""SELECT ex_id, {turn("'system'", q(fixed.EVAL_SYSTEM))} || {turn("'user'", USER)}
        || '<|im_start|>assistant' || chr(10) AS text FROM doc_rows""", "doc_rows")
    o["serve_requests"] = with_tables(
        f"""SELECT ex_id, CAST(to_json({{'model': 'text2sql', 'messages': [
            {{'role': 'system', 'content': {q(fixed.SERVE_SYSTEM)}}}, {{'role': 'user', 'content': {USER}}}],
            'max_tokens': 256, 'temperature': {dbl(0.1)}}}) AS VARCHAR) AS request FROM doc_rows""", "doc_rows")
    o["conversation_turn_text"] = f"SELECT conv_id, turn, {turn('role', 'text')} AS text FROM conversations"
    # evaluation
    o["drop_reasoning"] = with_tables(f"SELECT ex_id, {THINK_FREE} AS pred_sql FROM predictions", "predictions")
    o["canonical_sql"] = with_tables(f"SELECT ex_id, {canonical('pred_sql')} AS pred_sql FROM predictions", "predictions")
    o["canonical_documents"] = f"SELECT doc_id, {canonical('text')} AS text FROM documents"
    o["exact_match"] = with_tables(
        ALIGNED + f" SELECT ex_id, {canonical('pred_sql')} = {canonical('gold_sql')} AS exact_match FROM aligned",
        "cases", "predictions")
    o["align_predictions"] = with_tables(ALIGNED + " SELECT * FROM aligned", "cases", "predictions")
    o["ddl_statements"] = with_tables(
        f"""SELECT ex_id, row_number() OVER (PARTITION BY ex_id ORDER BY i) - 1 AS pos, piece AS statement FROM (
            SELECT ex_id, i, {strip("pieces[i]")} AS piece FROM (
                SELECT ex_id, pieces, unnest(generate_series(1, len(pieces))) AS i FROM (
                    SELECT ex_id, string_split(schema, ';') AS pieces FROM runs)))
        WHERE piece <> ''""", "runs")
    o["result_match"] = with_tables(MATCHED + " SELECT * FROM matched", "result_rows", "run_status")
    o["result_match_nonempty"] = with_tables(
        MATCHED + """ SELECT ex_id, execution_match AND ex_id IN (SELECT ex_id FROM result_rows) AS execution_match
        FROM matched""", "result_rows", "run_status")
    o["bag_difference"] = with_tables(
        """SELECT * FROM (SELECT ex_id, row_repr, sum(CASE side WHEN 'pred' THEN 1 ELSE -1 END) AS surplus
        FROM result_rows GROUP BY ALL) WHERE surplus <> 0""", "result_rows")
    o["eval_report"] = with_tables(
        RESULTS + REPORT + " SELECT * FROM report", "cases", "predictions", "result_rows", "run_status")
    o["eval_ordered"] = with_tables(
        RESULTS + REPORT + ORDERED, "cases", "predictions", "result_rows", "run_status")
    # files
    o["jsonl_roundtrip"] = "SELECT page_id, url, html FROM pages"
    o["jsonl_lenient_stats"] = f"""
        SELECT count(*) AS total, count(*) FILTER (good) AS converted, count(*) FILTER (NOT good) AS skipped,
               count(*) FILTER (good AND long) AS with_thinking
        FROM (SELECT d.lang <> 'es' AND {strip('d.text')} <> '' AND length({strip('d.text')}) >= 10 AS good,
                     length({strip('d.text')}) > 20 AS long FROM documents d)"""
    o["split_files"] = with_tables(SPLIT + " SELECT * EXCLUDE (split) FROM labelled WHERE split = 'test'",
                                   "raw_examples", "enriched")
    o["raw_tests_only"] = "SELECT 'doc/' || doc_id AS example_id, text AS question FROM documents WHERE lang <> 'en'"
    o["training_file_text"] = with_tables(
        f""", made AS ({EXAMPLES}) SELECT {turn("'system'", SYSTEM)} || {turn("'user'", CHAT_USER)}
        || {turn("'assistant'", ASSISTANT)} AS text FROM made WHERE {CHAT_OK}""", "enriched")
    o["report_file"] = o["eval_report"]
    o["named_split"] = "SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'"
    # SQL names
    o["sql_functions"] = with_tables(
        f"""SELECT ex_id, {canonical('upgraded_sql')} AS upgraded, {features('upgraded_sql')} AS features,
        {plausible('upgraded_sql')} AS plausible, {keywords('reasoning_trace')} AS keywords,
        {steps('reasoning_trace')} AS steps, {strip('reasoning_trace')} AS trace,
        {trace_score('reasoning_trace')} AS trace_score, quality_score
        FROM (SELECT * EXCLUDE (quality_score) FROM enriched) JOIN (SELECT ex_id, {SCORE} AS quality_score FROM ({PARTS})) USING (ex_id)""", "enriched")
    o["sql_answer_fields"] = with_tables(
        f", choices AS ({CHOICES}) " + " UNION ALL ".join(
            f"SELECT ex_id, stage, choice_idx, md5(content) AS answer, {q(column)} AS field, {tag(name)} AS value FROM choices WHERE stage = {q(stage)}"
            for stage, (_, _, _, parsers) in fixed.STAGES.items()
            for column, name in parsers.items()
        ), "answers")
    # the same rows by other ways
    o["align_by_position"] = with_tables(
        ALIGNED + """ SELECT row_number() OVER (ORDER BY ex_id) - 1 AS position, * EXCLUDE (ex_id) FROM aligned
        WHERE ex_id IN (SELECT ex_id FROM predictions)""", "cases", "predictions")
    for name, same in (
        ("align_stored_by_key", "align_predictions"), ("result_match_fingerprints", "result_match"),
        ("result_match_verified", "result_match_nonempty"), ("format_stats_written", "format_stats"),
        ("seed_kept_ratio_written", "seed_kept_ratio"), ("sql_training_examples", "expand_examples"),
        ("sql_tagged_texts", "parse_tags_all"), ("declared_chain", "enrichment_chain"),
    ):
        o[name] = o[same]
    return o
