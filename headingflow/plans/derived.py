"""Tables that the queries derive from ``documents``, over all rows and whole texts."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headingflow.functions.candidates import best
from headingflow.operators.labels import decode_candidates, dictionary
from headingflow.sources.shared import spread

FIRST_DAY = "2026-01-13"
DAYS = 37
CANDIDATES = 10


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pq_id, question, department, heading, day_no, date``: each document as a question."""
    return documents(spark, sf_dir).selectExpr(
        "doc_id as pq_id",
        """case doc_id % 4
          when 0 then concat(cast(doc_id as string), '. Deputy Mary Byrne asked the Minister for ', source,
            ', to outline ', text, ' and if he will make a statement on the matter.')
          when 1 then concat('asked the Minister for ', source, ', in relation to ', text)
          when 2 then concat('Deputy Seán Ó Sé asked the Taoiseach ',
            'whether she will make a statement on the matter ', text)
          else coalesce(text, '') end as question""",
        "source as department",
        "concat(lang, '-', source) as heading",
        f"cast(doc_id % {DAYS} as int) as day_no",
        f"date_add(date'{FIRST_DAY}', cast(doc_id % {DAYS} as int)) as date",
    )


def spread_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The questions for heavy work on their texts."""
    return spread(questions(spark, sf_dir))


def labels(asked: DataFrame) -> DataFrame:
    """``heading, label_id`` over all headings."""
    return dictionary(asked, "heading", "label_id")


def ranked_questions(asked: DataFrame, known: DataFrame, turn: int = 0) -> DataFrame:
    """The questions with ``ranked``: ten made-up classes each, their order set by the id.

    The truth comes first, second to fourth, fifth to tenth, or not at all.
    ``turn`` shifts the ids that set it, for a second model. The classes are
    ranked inside the row, as those of a model's score vector are.
    """
    lookup = known.withColumnRenamed("heading", "_key")
    key = f"(pq_id + {turn})"
    offset = f"""case when {key} % 20 < 9 then 0 when {key} % 20 < 14 then 1 + {key} % 3
      when {key} % 20 < 17 then 4 + {key} % 6 else 11 end"""
    joined = asked.join(lookup, F.col("heading") == F.col("_key")).withColumn(
        "_classes", known.agg(F.count(F.lit(1))).scalar()
    )
    ready = joined.selectExpr(
        *asked.columns,
        "_classes",
        f"label_id - {offset} as _first",
        f"cast(15 + ({key} * 37) % 80 as double) / 100D as _top",
    )
    place = "cast(pmod(_first + k - 1, _classes) as int)"
    conf = "_top * power(1D - _top, cast(k - 1 as double))"
    ranked = f"named_struct('rank', k, 'class_id', {place}, 'conf', {conf})"
    return ready.selectExpr(
        *asked.columns, f"transform(sequence(1, {CANDIDATES}), k -> {ranked}) as ranked"
    )


def score_vectors(ranked: DataFrame, known: DataFrame) -> DataFrame:
    """``pq_id, heading, scores``: a score for every class, 0 for all but the made-up ones."""
    whole = ranked.withColumn("_classes", known.agg(F.count(F.lit(1))).scalar())
    by_class = "map_from_entries(transform(ranked, r -> struct(r.class_id, r.conf)))"
    score = "transform(sequence(0, cast(_classes as int) - 1), i -> coalesce(element_at(m, i), 0D))"
    # The one-element array binds the map, which every class reads.
    return whole.selectExpr("pq_id", "heading", f"transform(array({by_class}), m -> {score})[0] as scores")


def predicted(ranked: DataFrame, known: DataFrame) -> DataFrame:
    """``pred_heading, pred_confidence, candidates`` in place of ``ranked``."""
    return (
        decode_candidates(ranked, "ranked", known)
        .withColumn("_best", best(F.col("candidates")))
        .select(
            *[c for c in ranked.columns if c != "ranked"],
            F.col("_best.heading").alias("pred_heading"),
            F.col("_best.conf").alias("pred_confidence"),
            "candidates",
        )
    )


def predictions(spark: SparkSession, sf_dir: str, turn: int = 0) -> DataFrame:
    asked = questions(spark, sf_dir)
    known = labels(asked)
    return predicted(ranked_questions(asked, known, turn), known)


def with_gaps(df: DataFrame) -> DataFrame:
    """Some NULL departments and headings; the confidence as text, some of it unreadable."""
    others = [c for c in df.columns if c not in ("department", "heading", "pred_confidence")]
    return df.selectExpr(
        *others,
        "case when pq_id % 97 <> 1 then department end as department",
        "case when pq_id % 97 <> 2 then heading end as heading",
        """case pq_id % 50 when 0 then 'bad' when 1 then null when 2 then 'NaN'
          else concat('0.', cast(15 + (pq_id * 37) % 80 as string)) end as pred_confidence""",
    )


def canon_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: one JSON document per question, in several shapes and envelopes.

    Each holds the complete item of its question, and beside it items that must
    drop out: a blank heading, an unreadable date, a number, a text and a null.
    All envelopes but the first hold a decoy: an earlier key that is no list.
    """
    show = lambda text: f"named_struct('showAs', {text})"
    sections = f"'debateSection', {show('heading')}, 'to', {show('department')}"
    flat = "to_json(named_struct('question', {}, 'heading', {}, 'department', department, 'date', {}))"
    nested = f"named_struct('question', named_struct('showAs', question, 'date', string(date), {sections}))"
    rooted = f"named_struct('showAs', question, {sections}, 'contextDate', string(date) || 'T09:30:00.000Z')"
    item = f"""case pq_id % 3 when 0 then to_json({nested})
      when 1 then {flat.format("question", "heading", "date_format(date, 'dd/MM/yyyy')")} else to_json({rooted}) end"""
    blank_heading = flat.format("'dropped'", "'  '", "string(date)")
    bad_date = flat.format("'dropped'", "heading", "'not-a-date'")
    items = f"""concat('[', concat_ws(',', {blank_heading}, {item}, '17,"text",null', {bad_date}), ']')"""
    envelopes = ['{"items":', *[f'{{"items":"none","{k}":' for k in ("results", "data", "pqs", "questions")]]
    opened = " ".join(f"when {i} then '{text}'" for i, text in enumerate(envelopes))
    turn = "(pq_id div 3) % 6"
    return spread_questions(spark, sf_dir).selectExpr(
        f"concat(case {turn} {opened} else '' end, {items}, if({turn} = 5, '', '}}')) as value"
    )


def questions_as_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item``: every question as one JSON object, in one line."""
    fields = "named_struct('question', question, 'heading', heading, 'department', department, 'date', string(date))"
    return questions(spark, sf_dir).selectExpr("pq_id", f"to_json({fields}) as item")


def faulty_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items, some of them with a repeated key, with numbers that JSON has not, or broken."""
    return questions_as_items(spark, sf_dir).selectExpr(
        "pq_id",
        """case pq_id % 11
          when 0 then concat(substr(item, 1, length(item) - 1), ', }')
          when 1 then concat('{"question": "an older text", ', substr(item, 2))
          when 2 then concat('{"score": NaN, "range": [-Infinity, Infinity], ', substr(item, 2))
          else item end as item""",
    )


def write_huge_documents(items: DataFrame, path: str, documents: int = 4) -> None:
    """Each document a file of one line that holds a share of the items.

    One task writes a document, so there are as many as the scan of the items
    has parts, and ``documents`` at least: a share grows no larger with the table.
    """
    documents = max(documents, items.rdd.getNumPartitions())

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts(values: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])

        yield texts(['{"meta": {"pages": [1, 2]}, "items": "none", "data": ['])
        comma = ""
        for batch in batches:
            for item in batch.column("item").to_pylist():
                yield texts([comma + item])
                comma = ","
        yield texts(["]}"])

    shares = items.repartition(documents, "pq_id").select("item")
    shares.mapInArrow(framed, "value string").write.option("lineSep", " ").text(path)


def raw_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pq_id, raw``: the day in one of the accepted spellings, or blank, or no day."""
    return questions(spark, sf_dir).selectExpr(
        "pq_id",
        """case pq_id % 9
          when 0 then string(date)
          when 1 then date_format(date, 'yyyy/M/d')
          when 2 then date_format(date, 'dd-MM-yyyy')
          when 3 then concat(' ', date_format(date, 'd/M/yyyy'), ' ')
          when 4 then concat(string(date), 'T08:15:00')
          when 5 then concat(string(date), 'T23:59:59.250Z')
          when 6 then concat(string(date), 'T23:30:00+05:30')
          when 7 then ' '
          else '32/13/2026' end as raw""",
    )


def parallel_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pq_id, departments_json, questions_json``: each document's lines and as many codes."""
    lines = "split(coalesce(text, ''), '\\n')"
    return documents(spark, sf_dir).selectExpr(
        "doc_id as pq_id",
        f"to_json(transform({lines}, (line, i) -> cast((doc_id + i) % 20 as int))) as departments_json",
        f"to_json({lines}) as questions_json",
    )
