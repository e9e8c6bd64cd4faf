"""Question rows from nested JSON documents."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headingflow.functions.text import quoted
from headingflow.functions.values import first_non_empty_sql, parse_day_sql

# Where a wrapped document may hold its items, in order.
ENVELOPE_KEYS = ("items", "results", "data", "pqs", "questions")

# For each output the paths to try, in order.
FIELD_PATHS = {
    "question": ("$.question.showAs", "$.question", "$.showAs"),
    "heading": ("$.question.debateSection.showAs", "$.heading", "$.debateSection.showAs"),
    "department": ("$.question.to.showAs", "$.department", "$.to.showAs"),
    "date": ("$.question.date", "$.date", "$.contextDate", "$.question.replyDate", "$.replyDate"),
}


def scalar_text_sql(item: str, path: str) -> str:
    """Text or number at the path as text; NULL for a missing step, an object or a list."""
    kind = f"schema_of_variant(try_variant_get({item}, '{path}', 'variant'))"
    return (
        f"case when not {kind} rlike '^(OBJECT|ARRAY)'"
        f" then try_variant_get({item}, '{path}', 'string') end"
    )


def document_items_sql(document: str, keys: Sequence[str], strict: bool) -> str:
    """The list of items: the first of ``keys`` whose value is a list, or the root.

    A document without a list is an error, or gives NULL when not strict.
    """
    paths = [f"$.{key}" for key in keys] + ["$"]
    lists = [f"try_variant_get({document}, '{path}', 'array<variant>')" for path in paths]
    if strict:
        lists.append("cast(raise_error('the JSON document is not a list and holds none') as array<variant>)")
    return f"coalesce({', '.join(lists)})"


def _with_items(documents: DataFrame, column: str, keys: Sequence[str], strict: bool) -> DataFrame:
    parse = "parse_json" if strict else "try_parse_json"
    others = [c for c in documents.columns if c != column]
    parsed = documents.select(*others, F.expr(f"{parse}({quoted(column)})").alias("_document"))
    return parsed.select(*others, F.expr(document_items_sql("_document", keys, strict)).alias("_items"))


def explode_items(
    documents: DataFrame, column: str, keys: Sequence[str] = ENVELOPE_KEYS, strict: bool = True
) -> DataFrame:
    """One row per item: ``position`` and ``item``, beside the other columns."""
    listed = _with_items(documents, column, keys, strict)
    others = [c for c in listed.columns if c != "_items"]
    return listed.select(*others, F.posexplode("_items").alias("position", "item"))


def extract_questions(documents: DataFrame, column: str = "value", strict: bool = True) -> DataFrame:
    """``position, question, heading, department, date`` of every complete item.

    Items without a readable date or with a blank text drop out, and so do
    items that are no objects, since they have no fields. Reading and dropping
    happen inside the array, so each path is read once per item and only
    complete items become rows.
    """
    listed = _with_items(documents, column, ENVELOPE_KEYS, strict)
    others = [c for c in listed.columns if c != "_items"]
    fields = {
        name: first_non_empty_sql([scalar_text_sql("item", path) for path in paths])
        for name, paths in FIELD_PATHS.items()
    }
    fields["date"] = parse_day_sql(fields["date"])
    struct = ", ".join(f"'{name}', {text}" for name, text in fields.items())
    rows = f"transform(_items, (item, i) -> named_struct('position', i, {struct}))"
    complete = "r.date is not null and r.question <> '' and r.heading <> '' and r.department <> ''"
    return listed.selectExpr(*[quoted(c) for c in others], f"inline(filter({rows}, r -> {complete}))")


def zip_arrays(df: DataFrame, departments_json: str, questions_json: str, id_column: str) -> DataFrame:
    """Rows ``id, position, department_code, question`` from two parallel JSON arrays.

    They are zipped inside the row and stop at the shorter one.
    """
    codes = F.from_json(F.col(departments_json), "array<int>")
    texts = F.from_json(F.col(questions_json), "array<string>")
    pairs = df.select(id_column, codes.alias("code"), texts.alias("text")).select(
        id_column,
        F.posexplode(
            F.slice(F.arrays_zip("code", "text"), F.lit(1), F.least(F.size("code"), F.size("text")))
        ).alias("position", "pair"),
    )
    return pairs.select(
        id_column,
        "position",
        F.col("pair.code").alias("department_code"),
        F.col("pair.text").alias("question"),
    )
