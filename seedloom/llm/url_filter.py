"""URL filters: given rules first, then association rules mined from what those decide.

A URL becomes a set of tokens: host labels, path segments (runs of digits as one 0) and
query keys. The URLs that a given rule decides are labelled examples; Spark's FP-growth
mines token combinations from them, together with the verdict as one more item. A mined
rule "these tokens, so this verdict" stays if enough examples support it and its
confidence is high enough. The other URLs are judged by the mined rules all of whose
tokens they have, found through an inverted index from token to rules: matches are
counted per rule, and a rule fits when all its tokens matched. The surest rule decides,
without any the verdict is allow.

Everything is DataFrame code. URLs with equal token sets are matched once, so a host that
holds a third of all pages costs one set or few. Mined rules name tokens that a fixed share
of all examples has, so their number does not grow with the corpus.

A null URL, or one without ``://``, has an empty host and path and no tokens. Very long URLs
have as many tokens as they have; repeated rows and null ids stay. Without labelled examples
nothing is mined and all is allowed; an empty table gives an empty one. Other columns pass
unchanged, but for one named ``judged``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.llm.frames import free_name, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
VERDICT = "verdict:"


@dataclass(frozen=True)
class Mining:
    """Least share of the examples behind a rule, and least confidence; a rule may have any number of tokens."""

    support: float = 0.01
    confidence: float = 0.8


def part_of(url: Column, part: int) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, part), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(part_of(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return part_of(url, 2)


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest given rule that fits; null if none does. A rule is a host, a slash and the start of a path."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def tokens_of(host: Column, path: Column, query: Column) -> Column:
    """Sorted distinct tokens, marked by where they stand."""

    def marked(mark: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))

    segments = F.transform(F.split(path, "/"), lambda x: F.regexp_replace(x, "[0-9]+", "0"))
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))
    return F.array_sort(
        F.array_distinct(F.concat(marked("host:", F.split(host, r"\.")), marked("path:", segments), marked("key:", keys)))
    )


def mine(examples: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Rules ``tokens, verdict, confidence, support`` from rows ``tokens, verdict``, stored once."""
    items = examples.select(F.array_append("tokens", F.concat(F.lit(VERDICT), "verdict")).alias("items"))
    model = FPGrowth(minSupport=mining.support, minConfidence=mining.confidence, itemsCol="items").fit(items)
    rules = model.associationRules.where(F.element_at("consequent", 1).startswith(VERDICT))
    verdict = F.substring(F.element_at("consequent", 1), len(VERDICT) + 1, 100)
    return stored(
        rules.select(F.array_sort("antecedent").alias("tokens"), verdict.alias("verdict"), "confidence", "support"),
        "url-rules",
    )


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``tokens, verdict`` of each token set that a rule fits, by the surest rule.

    Surest is the highest confidence, then support, then most tokens, then first by name.
    """
    rule = F.struct(
        -F.col("confidence"), -F.col("support"), -F.size("tokens"), F.array_join("tokens", " ").alias("name"), "verdict"
    ).alias("rule")
    index = rules.select(rule, F.size("tokens").alias("needed"), F.explode("tokens").alias("token"))
    asked = sets.select("tokens", F.explode("tokens").alias("token"))
    hits = asked.join(index, "token").groupBy("tokens", "rule").agg(
        F.count(F.lit(1)).alias("had"), F.first("needed").alias("needed")
    )
    fits = hits.where(F.col("had") == F.col("needed"))
    return fits.groupBy("tokens").agg(F.min("rule").alias("rule")).select("tokens", F.col("rule.verdict").alias("verdict"))


def judge(df: DataFrame, rules: dict[str, str], url: str = "url", mining: Mining = Mining()) -> DataFrame:
    """The rows with a struct column ``judged``: host, path, rule and verdict. One of that name is replaced."""
    name = free_name(df, "parsed")
    host, path, query = host_of(F.col(url)), path_of(F.col(url)), part_of(F.col(url), 3)
    parsed = df.withColumn(name, F.struct(host.alias("host"), path.alias("path"), query.alias("query")))
    rule = fitting_rule(F.col(f"{name}.host"), F.col(f"{name}.path"), rules)
    tokens = tokens_of(F.col(f"{name}.host"), F.col(f"{name}.path"), F.col(f"{name}.query"))
    given = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    parsed = parsed.withColumn(name, F.struct(f"{name}.host", f"{name}.path", rule.alias("rule"), tokens.alias("tokens")))

    narrow = parsed.select(F.col(f"{name}.rule").alias("rule"), F.col(f"{name}.tokens").alias("tokens"))
    examples = narrow.where(F.col("rule").isNotNull()).select("tokens", given[F.col("rule")].alias("verdict"))
    mined = match(narrow.where(F.col("rule").isNull()).select("tokens").distinct(), mine(examples, mining))

    key, found = free_name(parsed, "tokens"), free_name(parsed, "verdict")
    # Stored, so that the join below reads it through an exchange of its own and hot token sets can be split.
    mined = stored(mined, "url-verdicts").select(F.col("tokens").alias(key), F.col("verdict").alias(found))
    asked = parsed.where(F.col(f"{name}.rule").isNull()).withColumn(key, F.col(f"{name}.tokens"))
    asked = asked.join(mined, key, "left").withColumn(found, F.coalesce(found, F.lit("allow"))).drop(key)
    ruled = parsed.where(F.col(f"{name}.rule").isNotNull()).withColumn(found, given[F.col(f"{name}.rule")])
    both = ruled.unionByName(asked)
    judged = F.struct(f"{name}.host", f"{name}.path", f"{name}.rule", F.col(found).alias("verdict"))
    return both.withColumn(name, judged).drop(found, "judged").withColumnRenamed(name, "judged")
