"""Text expressions. All of them stay inside the JVM; none is a UDF."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WORD_CLASS = r"[\p{L}\p{N}_]"

# The boilerplate patterns, in the order in which they apply.
# Each match becomes one space.
BOILERPLATE = [
    r"^\s*\d+\.\s*",
    r"^\s*deputy\s+[a-záéíóú\-'.\s]+\s+asked\s+",
    r"\basked\s+the\s+minister\s+for\s+[^,]+,?\s*",
    r"\basked\s+the\s+minister\s+of\s+state\s+at\s+[^,]+,?\s*",
    r"\bthe\s+taoiseach\b",
    r"\bthe\s+tánaiste\b",
    r"\btaoiseach\b",
    r"\btánaiste\b",
    r"\b(if|whether)\s+he\s+will\s+make\s+a\s+statement\s+on\s+the\s+matter\b",
    r"\b(if|whether)\s+she\s+will\s+make\s+a\s+statement\s+on\s+the\s+matter\b",
    r"\band\s+if\s+he\s+will\s+make\s+a\s+statement\b",
    r"\band\s+if\s+she\s+will\s+make\s+a\s+statement\b",
    r"\band\s+if\s+so\b",
    r"\band\s+if\s+not\b",
    r"\bto\s+outline\b",
    r"\bto\s+provide\s+details\b",
    r"\bin\s+relation\s+to\b",
]

# A piece of text that every match of the pattern holds. A byte search for it
# is far cheaper than the pattern, so most texts skip most patterns. No piece
# has an s, i or k: those also match the odd letters U+017F and U+0131 when
# case is ignored, which a byte search would miss.
HINTS = [
    None, "deputy", None, "tate", "tao", "tána", "tao", "tána",
    "tement", "tement", "tement", "tement", "and", "and", "outl", "deta", "relat",
]
MINISTER_HINTS = ("minister", "\u017f", "\u0131")

DEPARTMENT_INPUT = "[DEPT] {department} [SEP] {question}"


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(text, F.lit(SPACES))


def literal(text: str) -> str:
    """The text as a SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> str:
    """The column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def _java(pattern: str) -> str:
    r"""The pattern for Java, with the Unicode meaning of ``\s``, ``\d`` and ``\b`` spelled out.

    A word holds letters, numbers and underscores; combining marks end it. Each
    ``\b`` here stands before a first letter or after a last one. The look-ahead
    rejects a position by its first letter before the boundary is tested.
    """
    java = pattern.replace(r"\s", SPACE_CLASS).replace(r"\d", r"\p{Nd}")
    first = re.match(r"\\b(?:\((\w)\w*\|(\w)\w*\)|(\w))", java)
    if first:
        letters = "".join(x for x in first.groups() if x)
        java = f"(?=[{letters}])(?<!{WORD_CLASS})" + java.removeprefix(r"\b")
    if java.endswith(r"\b"):
        java = java.removesuffix(r"\b") + f"(?!{WORD_CLASS})"
    return "(?iu)" + java


def _rewrite(held: str, pattern: str, hint: str | None) -> str:
    """One rule over the held text, skipped where the text lacks every hint."""
    replaced = f"regexp_replace(t, {literal(_java(pattern))}, ' ')"
    hints = MINISTER_HINTS if r"minister\s+for" in pattern else (hint,) if hint else ()
    if hints:
        hinted = " or ".join(f"contains(t, {literal(h)})" for h in hints)
        replaced = f"if({hinted}, {replaced}, t)"
    return f"transform({held}, t -> {replaced})"


def clean_question(column: str) -> Column:
    """Lower-case text without procedural boilerplate and punctuation; NULL gives ``""``.

    The one-element array binds each intermediate text to a lambda variable, so
    the hint and the pattern share it instead of evaluating it twice.
    """
    held = f"array(lower(btrim(coalesce({quoted(column)}, ''), {literal(SPACES)})))"
    for pattern, hint in zip(BOILERPLATE, HINTS, strict=True):
        held = _rewrite(held, pattern, hint)
    # Punctuation to blanks, then runs of blanks to one: the same as one pass
    # over the runs of anything but letters, digits, underscore and hyphen.
    unwanted = literal(r"[^\p{L}\p{N}_\-]+")
    return F.expr(f"btrim(regexp_replace(element_at({held}, 1), {unwanted}, ' '))")


def normalise_spaces(text: Column) -> Column:
    """Collapse white space only: the light cleaner."""
    return F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", " "))


def word_count(text: Column) -> Column:
    """Number of words between white space."""
    pieces = F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+")
    return F.size(F.filter(pieces, lambda w: w != ""))


def model_input(
    department: Column, question: Column, template: str = DEPARTMENT_INPUT, trim: bool = False
) -> Column:
    """Fill ``{department}`` and ``{question}`` of the template."""
    fields = {"department": strip(department) if trim else department, "question": question}
    parts = re.split(r"\{(department|question)\}", template)
    return F.concat(
        *[
            F.coalesce(fields[part], F.lit("")) if i % 2 else F.lit(part)
            for i, part in enumerate(parts)
        ]
    )
