"""Fixed values.

Everything in this file is a value that results depend on: word lists, bounds,
message texts and formats. They are stated as they are and used by reference
from the operators.
"""

# --- fixed values: difficulty levels, easiest first -------------------------

LEVELS = (
    "basic SQL",
    "single join",
    "aggregation",
    "multiple joins",
    "subqueries",
    "window functions",
    "CTEs",
    "EXCEPT and INTERSECT",
)

# --- fixed values: seed quality bounds --------------------------------------

MAX_CONTEXT_LEN = 1500
MIN_SQL_LEN = 20
MAX_SQL_LEN = 600
MIN_PROMPT_LEN = 10
CONTEXT_MARK = "CREATE TABLE"
SEED_BAD_WORDS = ("TODO", "FIXME")

# --- fixed values: defaults of absent fields --------------------------------

UNKNOWN = "unknown"
DEFAULT_TASK_TYPE = "analytics and reporting"
SEED_SOURCE = "gretelai/synthetic_text_to_sql"
SEED_SPLIT = "seed"
DEFAULT_QUALITY = 1.0

# --- fixed values: SQL feature groups and their marks ------------------------

SQL_MARKS = {
    "basic": (),
    "join": ("JOIN",),
    "aggregation": ("GROUP BY", "HAVING", "COUNT(", "SUM(", "AVG(", "MAX(", "MIN("),
    "subquery": ("SELECT", "(SELECT"),
    "window": ("OVER (", "OVER(", "ROW_NUMBER(", "RANK(", "LAG(", "LEAD(", "NTILE("),
    "cte": ("WITH ", "AS ("),
    "set_ops": ("EXCEPT", "INTERSECT", "UNION"),
}

# --- fixed values: SQL plausibility ------------------------------------------

SQL_OPENERS = ("SELECT", "WITH", "INSERT", "UPDATE", "DELETE")
SQL_PLACEHOLDERS = ("<your", "TODO", "FIXME", "...", "YOUR_SQL")
MIN_PLAUSIBLE_LEN = 10

# --- fixed values: reasoning trace score --------------------------------------

TRACE_MIN_LEN = 50
TRACE_KEYWORDS = (
    "SELECT", "WHERE", "JOIN", "GROUP BY", "HAVING", "ORDER BY", "WITH", "SUBQUERY",
)
TRACE_STEPS = ("step", "first", "next", "then", "finally")
LENGTH_CAP, LENGTH_DIVISOR = 0.3, 1000
KEYWORD_CAP, KEYWORD_GAIN = 0.4, 0.08
STEP_CAP, STEP_GAIN = 0.3, 0.06

# --- fixed values: overall score ----------------------------------------------

HARDER, EQUAL, SIMPLER, IMPLAUSIBLE = 1.0, 0.6, 0.2, 0.0
VARIANT_OK, VARIANT_BAD = 0.9, 0.1
QUESTION_GAIN, QUESTION_MIN_LEN = 0.5, 15
WEIGHTS = (0.35, 0.25, 0.15, 0.25)
MIN_SCORE = 0.7
REJECTED = -1.0

# --- fixed values: mixing and splitting ---------------------------------------

SEED_RATIO, SYNTHETIC_RATIO = 0.4, 0.6
TRAIN_RATIO, EVAL_RATIO = 0.9, 0.05
MOCK_PREFIX = "[MOCK]"
WITH_REASONING = "seed_with_reasoning"
UPGRADED = "synthetic_upgraded"
VARIANT = "synthetic_variant"

# --- fixed values: batches ------------------------------------------------------

BATCH_SIZE = 20
BATCH_PAUSE_SECONDS = 15

# --- fixed values: mock columns of a dry run ------------------------------------

MOCK_ROWS = 5
MOCK_QUESTION = "[MOCK] Harder version of: {question}"
MOCK_SQL = "SELECT t1.*, COUNT(t2.id) FROM ({sql}) t1 LEFT JOIN orders t2 ON t1.id = t2.user_id GROUP BY t1.id"
MOCK_CONSTANTS = {
    "upgraded_complexity": "multiple joins",
    "variant_schema": "CREATE TABLE mock_table (id INT, value TEXT);",
    "variant_question": "[MOCK] How many records are in mock_table?",
    "variant_sql": "SELECT COUNT(*) FROM mock_table;",
    "reasoning_trace": "[MOCK] Step 1: Identify table. Step 2: Use COUNT. Step 3: Done.",
    "quality_score": 0.85,
}

# --- fixed values: chat rows ----------------------------------------------------

THINKING_MIN_LEN = 20
CHAT_MIN_SQL_LEN = 10
USER_TURN = "Database schema:\n{schema}\n\nQuestion: {question}"
THINK_TURN = "<think>\n{thinking}\n</think>\n\n{sql}"

CHAT_SYSTEM = """\
You are an expert SQL query writer. Given a natural language question and a database schema, write the correct SQL query that answers the question.

Rules:
- Output ONLY the SQL query, nothing else
- The SQL must be syntactically valid
- Use only tables and columns that exist in the provided schema
- Use standard SQL compatible with SQLite and PostgreSQL
- Do not add explanations or markdown formatting around the SQL"""

CHAT_SYSTEM_THINKING = """\
You are an expert SQL query writer. Given a natural language question and a database schema, write the correct SQL query that answers the question.

Think through the problem step by step before writing the SQL:
1. Identify which tables are needed
2. Determine what joins are required
3. Figure out what filters, aggregations, or ordering to apply
4. Write the final SQL

Output your reasoning in <think>...</think> tags, then the SQL query."""

EVAL_SYSTEM = "You are an expert SQL query writer. Given a natural language question and a database schema, write the correct SQL query. Output ONLY the SQL query."

SERVE_SYSTEM = "You are an expert SQL query writer. Given a database schema and a natural language question, write the correct SQL query. Output ONLY the SQL query, nothing else."
SERVE_MODEL, SERVE_MAX_TOKENS, SERVE_TEMPERATURE = "text2sql", 256, 0.1

RAW_TRAINING_TEXT = "### Schema:\n{schema}\n\n### Frage:\n{question}\n\n### SQL:\n{sql}"
TURN_TEXT = "<|im_start|>{role}\n{content}<|im_end|>\n"
TURN_OPENING = "<|im_start|>assistant\n"

# --- fixed values: enrichment stages --------------------------------------------
# name -> (max tokens, temperature, columns read, {column made: tag read})

STAGES = {
    "upgrade": (
        1024, 0.8,
        ("question", "schema", "sql", "complexity", "domain"),
        {
            "upgraded_question": "QUESTION",
            "upgraded_sql": "SQL",
            "upgraded_complexity": "COMPLEXITY",
        },
    ),
    "variant": (
        1500, 0.9,
        ("domain", "complexity", "task_type"),
        {
            "variant_schema": "SCHEMA",
            "variant_question": "QUESTION",
            "variant_sql": "SQL",
        },
    ),
    "trace": (
        1024, 0.3,
        ("question", "schema", "sql"),
        {"reasoning_trace": "REASONING"},
    ),
}

REQUIRED_COLUMNS = ("question", "schema", "sql", "complexity", "domain")
MIN_SAMPLES = 1
REQUIRED_FIELDS = ("upgraded_sql", "upgraded_question", "reasoning_trace")

# --- fixed values: prompt texts, one (role, text) pair per message ----------------

PROMPTS = {
    "upgrade": (
        ("system", """\
You are an expert SQL database engineer and data analyst.
Your task is to take an existing Text-to-SQL example and rewrite it
as a HARDER version that requires more advanced SQL skills.

Rules:
- Keep the same database schema (same tables, same columns)
- The new question must be more complex than the original
- The new SQL must be syntactically valid and correctly answer the new question
- The SQL must be harder: use joins, subqueries, window functions, CTEs, or aggregations
  that were NOT present in the original
- The question must sound natural, like something a real analyst would ask
- Do NOT add columns or tables that do not exist in the provided schema

Always respond ONLY with this exact format:
[QUESTION]
<your upgraded natural language question here>
[/QUESTION]
[SQL]
<your upgraded SQL query here>
[/SQL]
[COMPLEXITY]
<one of: basic SQL | single join | aggregation | multiple joins | subqueries | window functions | CTEs | EXCEPT and INTERSECT>
[/COMPLEXITY]"""),
        ("user", """\
Domain: {{ domain }}
Current complexity: {{ complexity }}

Database schema:
{{ schema }}

Original question: {{ question }}
Original SQL:
{{ sql }}

Now rewrite this as a HARDER version. The new SQL should require at least
one level of additional complexity beyond "{{ complexity }}".
Think step by step about what a harder question on this schema would look like,
then produce the upgraded example."""),
    ),
    "variant": (
        ("system", """\
You are an expert SQL database architect and data analyst.
Your task is to create a realistic, novel Text-to-SQL training example
from scratch for the given domain and SQL complexity level.

Rules:
- Create a realistic database schema with 1-4 tables appropriate for the domain
- Write natural-sounding CREATE TABLE statements with realistic column names and types
- Write a natural language question that a business user would genuinely ask
- Write the correct SQL query that answers the question given your schema
- The SQL must match the requested complexity level exactly
- Make the schema and question feel realistic and diverse
- Use proper SQL compatible with SQLite and PostgreSQL

Always respond ONLY with this exact format:
[SCHEMA]
<your CREATE TABLE statements here>
[/SCHEMA]
[QUESTION]
<your natural language question here>
[/QUESTION]
[SQL]
<your SQL query here>
[/SQL]"""),
        ("user", """\
Generate a new Text-to-SQL example with these characteristics:

Domain: {{ domain }}
SQL complexity: {{ complexity }}
Task type: {{ task_type }}

Create a realistic database schema for the "{{ domain }}" domain,
write a natural language question at "{{ complexity }}" difficulty,
and provide the correct SQL answer."""),
    ),
    "trace": (
        ("system", """\
You are an expert SQL teacher explaining how to write SQL queries step by step.
Your task is to explain the reasoning process for translating a natural language
question into a SQL query, given a database schema.

Rules:
- Walk through the reasoning step by step (identify relevant tables, columns,
  joins needed, aggregations, filters, ordering, etc.)
- Be concise but complete
- Reference actual table and column names from the schema
- Explain WHY each SQL clause is needed, not just WHAT it does
- Do NOT just describe what the SQL does, explain how to DERIVE it

Always respond ONLY with this exact format:
[REASONING]
<your step-by-step reasoning here>
[/REASONING]"""),
        ("user", """\
Database schema:
{{ schema }}

Question: {{ question }}

SQL answer:
{{ sql }}

Explain step by step how to arrive at this SQL query from the question."""),
    ),
}
