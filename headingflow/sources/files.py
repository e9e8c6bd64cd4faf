"""CSV and JSON in, CSV and JSON out."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from headingflow.functions.values import MISSING_STRINGS
from headingflow.operators.canon import explode_items
from headingflow.operators.guards import require_columns

UPLOAD_COLUMNS = ("question", "department", "heading")


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, missing: Sequence[str] = ("",)
) -> DataFrame:
    """CSV with a header and quoted texts over several lines; columns are matched by position.

    Strings in ``missing`` become NULL. Each file is read by one task;
    ``read_csv_ranges`` divides large ones.
    """
    raw = spark.read.csv(
        path,
        schema=schema,
        header=True,
        multiLine=True,
        quote='"',
        escape='"',
        enforceSchema=False,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return raw.select(
        *[
            F.when(~F.col(f.name).isin(list(missing)), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, StringType) and missing
            else F.col(f.name)
            for f in raw.schema
        ]
    )


def read_csv_with_missing_words(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Like ``read_csv``, with ``NA``, ``None``, ``null`` and their kind as NULL too."""
    return read_csv(spark, path, schema, MISSING_STRINGS)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def read_documents(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """JSON documents as text in ``value``: one per file, or one per line.

    A file that is one document is read by one task, and held whole.
    ``read_items`` divides large ones.
    """
    return spark.read.text(path, wholetext=not per_line)


def read_upload(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """An uploaded table with all its columns as text, its format chosen by the suffix of the path.

    ``.csv`` has a header. ``.json`` is a list of objects or an object whose
    ``data`` is one; other envelopes are refused. The columns of a JSON upload
    are the keys of all its objects, those of ``UPLOAD_COLUMNS`` first. A table
    without a question or a department column is an error; one without any
    object has no rows.
    """
    name = path.rstrip("/").lower()
    if name.endswith(".csv"):
        header = spark.read.option("header", True).option("multiLine", True).csv(path).columns
        table = read_csv_with_missing_words(spark, path, text_schema(header))
        return require_columns(table, ("question", "department"))
    if name.endswith(".json"):
        items = explode_items(read_documents(spark, path, per_line), "value", keys=("data",))
        fields = items.select(F.expr("try_variant_get(item, '$', 'map<string,variant>')").alias("_fields"))
        # One name for each column of the upload.
        names = fields.select(F.explode(F.map_keys("_fields")).alias("name")).distinct().orderBy("name").collect()
        keys = [r["name"] for r in names] or list(UPLOAD_COLUMNS)
        first = [c for c in UPLOAD_COLUMNS if c in keys]
        keys = first + [c for c in keys if c not in first]
        table = fields.select(*[_scalar_text(F.col("_fields")[F.lit(c)]).alias(c) for c in keys])
        return require_columns(table, ("question", "department"))
    raise ValueError("Unsupported file type: give a .csv or a .json path.")


def _scalar_text(value: Column) -> Column:
    """Text or number of a variant as text; NULL for an object or a list."""
    plain = ~F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
    return F.when(plain, F.try_variant_get(value, "$", "string"))


def write_dated(df: DataFrame, path: str, run_date: str, fmt: str = "json") -> None:
    """Write under ``<path>/run_date=<run_date>/``; a second run of a day replaces that day."""
    (
        df.withColumn("run_date", F.lit(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy("run_date")
        .format(fmt)
        .save(path)
    )


def append_history(rows: DataFrame, path: str, run_id: str) -> None:
    """Add what a run measured: ``step, name, value``, one row for each; other columns may come with any run."""
    rows = require_columns(rows, ("step", "name", "value"))
    rows.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All runs; a column that a run has not is NULL there."""
    return spark.read.option("mergeSchema", True).parquet(path)


def append_run(metadata: DataFrame, path: str) -> None:
    """Add the one-row record of a run to the table of runs."""
    metadata.write.mode("append").parquet(path)
