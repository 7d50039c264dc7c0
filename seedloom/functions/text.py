"""Text columns: stripping, SQL in one spelling, tags, reasoning blocks, DDL statements."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip and \s treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_SPACES = "".join(f"\\u{ord(c):04x}" for c in WHITESPACE)
# What is not one plain space already: a run of two or more, or another character. The look ahead turns
# letters away by two ranges, and is for speed only.
WHITESPACE_RUN = rf"(?=[\x00- \x85\xa0\u1680-\u3000])(?:[{_SPACES}]{{2,}}|[{_SPACES}&&[^ ]])"

THINK_BLOCK = "(?s)<think>.*?</think>"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def text(value: Column | str) -> Column:
    """Null reads as the empty string."""
    return F.coalesce(as_column(value), F.lit(""))


def default(value: Column | str, fallback: object) -> Column:
    return F.coalesce(as_column(value), F.lit(fallback))


def strip(value: Column | str) -> Column:
    """Both ends without white space; Spark's ``trim`` would drop spaces only."""
    return F.btrim(text(value), F.lit(WHITESPACE))


def filled(value: Column | str) -> Column:
    """True where something other than white space is left."""
    return strip(value) != ""


def fill_template(template: str, **slots: Column | str) -> Column:
    """``concat`` of a ``{slot}`` template's literal parts and columns.

    The template is cut once, so a value that holds ``{slot}`` itself stays as it is.
    """
    return _join_parts(re.split(r"\{(\w+)\}", template), slots)


def fill_prompt(template: str, **slots: Column | str) -> Column:
    """The same for ``{{ slot }}`` templates."""
    return _join_parts(re.split(r"\{\{\s*(\w+)\s*\}\}", template), slots)


def _join_parts(parts: list[str], slots: dict[str, Column | str]) -> Column:
    pieces = [
        text(slots[part]) if at % 2 else F.lit(part)
        for at, part in enumerate(parts)
        if at % 2 or part
    ]
    return F.concat(*pieces)


def canonical_sql(sql: Column | str) -> Column:
    """One spelling of a query: lower case, single spaces, no ending semicolons.

    Single spaces are left as they are, so a query in that spelling is not written anew.

    The result is not stripped again, so ``select 1 ;`` keeps its last space.
    """
    spaced = F.regexp_replace(F.lower(strip(sql)), WHITESPACE_RUN, " ")
    return F.rtrim(spaced, F.lit(";"))


def exact_match(predicted: Column | str, gold: Column | str) -> Column:
    return canonical_sql(predicted) == canonical_sql(gold)


def drop_reasoning(answer: Column | str) -> Column:
    """The answer without its ``<think>`` blocks; an unclosed block stays."""
    return strip(F.regexp_replace(text(answer), THINK_BLOCK, ""))


def tag_pattern(tag: str) -> str:
    return rf"(?s)\[{re.escape(tag)}\](.*?)\[/{re.escape(tag)}\]"


def tagged(content: Column | str, tag: str) -> Column:
    """Stripped text of the first ``[TAG]…[/TAG]``, or the empty string."""
    return strip(F.regexp_extract(text(content), tag_pattern(tag), 1))


def tagged_all(content: Column | str, tag: str) -> Column:
    """Stripped texts of every ``[TAG]…[/TAG]`` as an array."""
    found = F.regexp_extract_all(text(content), F.lit(tag_pattern(tag)), F.lit(1))
    return F.transform(found, strip)


def ddl_statements(ddl: Column | str) -> Column:
    """Array of the non-empty statements between semicolons (literals are not looked at)."""
    pieces = F.transform(F.split(text(ddl), ";"), strip)
    return F.filter(pieces, lambda piece: piece != "")
