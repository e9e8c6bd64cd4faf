"""Token ids in binary files: canonical Huffman codes in blocks that decode on their own.

A folder holds ``code/``, a Parquet table ``id, bits`` that fixes the canonical
code, and ``blocks/``, files of blocks in order of the document id. Each block
is followed by one zero byte, which readers skip. A block, little-endian:

    4 bytes   ``TIDB``
    1 byte    1 if the document id is NULL, else 0
    8 bytes   document id, signed
    1 byte    1 if the block ends its document, else 0
    4 bytes   number of ids
    4 bytes   number of bytes of the codes
    2 bytes   for each 128 ids: the bits of their codes, the checkpoints
    ...       the codes, the first bit of a byte its highest

A checkpoint gives the bit at which every 128th id begins, so a reader decodes
any part of a block, and many parts at once.
"""

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headingflow.llm.huffman import LIMIT, STEP, bit_sizes, canonical_codes, code_lengths, decoding_table, pack, unpack
from headingflow.llm.pieces import KNOWN_PIECES, id_writer, read_spec
from headingflow.llm.storage import drop, small_batches, written

MAGIC = b"TIDB"
HEADER = "<4sBqBII"
#: Ids in a block at most.
BLOCK = 1 << 16
#: Bytes of a file, about.
FILE_BYTES = 16 << 20
END_ID = 1
_BATCH_BYTES = 2 << 20


def id_kind(spec: str, end_id: int) -> str:
    """The narrowest unsigned type that holds every id."""
    from tokenizers import Tokenizer

    most = max(end_id, Tokenizer.from_str(spec).get_vocab_size(with_added_tokens=True) - 1)
    return "<u2" if most < 1 << 16 else "<u4"


def encode_documents(
    df: DataFrame, spec: str, kind: str, id_column: str, text_column: str, end_id: int, known: int = KNOWN_PIECES
) -> DataFrame:
    """``_id, _row, _part, _last, _ids``: each row's ids in parts of at most a block, the end id last.

    A NULL text is empty and gives the end id alone. ``_row`` tells the rows of
    one document id apart.
    """
    sent = df.sparkSession.sparkContext.broadcast(spec)
    rows = df.select(
        F.col(id_column).cast("long").alias("_id"),
        F.monotonically_increasing_id().alias("_row"),
        F.coalesce(F.col(text_column), F.lit("")).alias("_text"),
    )
    width = np.dtype(kind).itemsize

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = id_writer(sent.value, kind, known)
        end = np.array([end_id], dtype=kind).tobytes()
        for batch in batches:
            out: list[tuple] = []
            size = 0
            keys, rows = batch.column("_id").to_pylist(), batch.column("_row").to_pylist()
            found = encoder.values(x.as_py() for x in batch.column("_text"))
            for key, row, codes in zip(keys, rows, found, strict=True):
                whole = codes + end
                n = -(-len(whole) // (width * BLOCK))
                for k in range(n):
                    out.append((key, row, k, k == n - 1, whole[width * BLOCK * k : width * BLOCK * (k + 1)]))
                size += len(whole)
                if size > _BATCH_BYTES:
                    yield _coded(out)
                    out, size = [], 0
            if out:
                yield _coded(out)

    return rows.mapInArrow(encode, "_id long, _row long, _part int, _last boolean, _ids binary")


def _coded(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["_id", "_row", "_part", "_last", "_ids"])


def _joined(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch, and where each row's begin."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    width = np.dtype(kind).itemsize
    return data.view(kind), (offsets - offsets[0]) // width


def id_counts(coded: DataFrame, kind: str) -> DataFrame:
    """``id, n`` over all rows: each task sends one count for each id it met."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            if not len(batch):
                continue
            ids, _ = _joined(batch.column("_ids"), kind)
            found = np.bincount(ids, minlength=len(total))
            found[: len(total)] += total
            total = found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    return coded.select("_ids").mapInArrow(tally, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(
    df: DataFrame,
    path: str,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
    file_bytes: int = FILE_BYTES,
    known: int = KNOWN_PIECES,
) -> None:
    """Encode every row and write the ids in ascending order of the document id, which is an integer.

    Other kinds of ids are an error before any job. Other columns are not read.
    A worker remembers up to twice ``known`` words, some 200 bytes each, and keeps
    them for later tasks; fewer cost time only.

    Rows with one id keep their order of reading, NULL ids come first, and an
    empty table gives an empty folder. The texts are encoded once; their ids are
    written to the shared folder, so that counting and coding read the same ids
    after a lost executor too, and are deleted when the files are there. What is
    shuffled is these ids, once. One entry per id of the vocabulary, and no
    more, reaches the driver.
    """
    spark = df.sparkSession
    if df.schema[id_column].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"the ids in {id_column} are no integers, which the blocks hold")
    spec = read_spec(tokenizer)
    kind = id_kind(spec, end_id)
    coded, scratch = written(encode_documents(df, spec, kind, id_column, text_column, end_id, known), "ids")

    counted = id_counts(coded, kind).collect()  # at most as many rows as the vocabulary has ids
    counts = np.zeros(max([1, *(r["id"] + 1 for r in counted)]), dtype=np.int64)
    for row in counted:
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts)
    table = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(table, "id long, bits int").coalesce(1).write.parquet(f"{path}/code")

    total = int((counts * lengths).sum()) // 8
    files = max(1, -(-total // file_bytes))
    code = spark.sparkContext.broadcast((canonical_codes(lengths), lengths))

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, sizes = code.value
        for batch in batches:
            if not len(batch):
                continue
            keys, lasts = batch.column("_id").to_pylist(), batch.column("_last").to_pylist()
            ids, starts = _joined(batch.column("_ids"), kind)
            blocks = []
            for i, (key, last) in enumerate(zip(keys, lasts, strict=True)):
                own = ids[starts[i] : starts[i + 1]]
                packed, _ = pack(own, codes, sizes)
                steps = bit_sizes(own, np.arange(0, len(own), STEP), sizes).astype("<u2").tobytes()
                head = struct.pack(HEADER, MAGIC, key is None, key or 0, last, len(own), len(packed))
                blocks.append(head + steps + packed)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], names=["_block"])

    # The row number makes the order unique, so a hot id can be split; the
    # blocks of a document stay in one file. The ids are dealt out, not the
    # blocks, as finding the ranges reads the table once more.
    ordered = coded.repartitionByRange(files, "_id", "_row").sortWithinPartitions("_id", "_row", "_part")
    blocks = ordered.mapInArrow(to_blocks, "_block binary").select(F.col("_block").cast("string").alias("value"))
    with small_batches(spark):
        blocks.write.option("lineSep", "\0").text(f"{path}/blocks")
    drop(spark, scratch)


@lru_cache(maxsize=2)
def _table(lengths: bytes) -> tuple[np.ndarray, np.ndarray]:
    return decoding_table(np.frombuffer(lengths, dtype=np.uint8))


def _blocks(data: bytes) -> Iterator[tuple[int | None, bool, int, int, np.ndarray]]:
    """Id, whether the last of its document, number of ids, start of the codes, bits of each step."""
    at = 0
    while at < len(data):
        magic, null, key, last, n, size = struct.unpack_from(HEADER, data, at)
        if magic != MAGIC:
            raise ValueError("no block begins here")
        steps = np.frombuffer(data, dtype="<u2", count=-(-n // STEP), offset=at + struct.calcsize(HEADER))
        codes = at + struct.calcsize(HEADER) + steps.nbytes
        yield (None if null else key), bool(last), n, codes, steps
        at = codes + size + 1


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{path}/blocks").select("path", "content")


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """``_file, ids_before``: the ids in all files before each, from the headers of the blocks alone."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [sum(b[2] for b in _blocks(c.as_py())) for c in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sums, pa.int64())], names=["_file", "n"])

    per_file = _files(spark, path).mapInArrow(totals, "_file string, n long")
    # One row per file. Part files are numbered in the order of their ids; beyond
    # 99,999 the numbers have more digits, so their names do not sort as texts.
    before = Window.orderBy(part_number(F.col("_file"))).rowsBetween(Window.unboundedPreceding, -1)
    return per_file.select("_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ids_before"))


def part_number(path: Column) -> Column:
    """The number in the name of a part file."""
    return F.regexp_extract(path, r"part-(\d+)[^/]*$", 1).cast("long")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``_id, _file, before, n_tokens, ids`` of every document in the files.

    ``ids`` are little-endian unsigned 32-bit integers, ``before`` counts the
    ids of the documents before it in its file. Each file is decoded by one
    task, some blocks at a time.
    """
    pairs = spark.read.parquet(f"{path}/code").collect()  # one row for each id of the vocabulary
    lengths = np.zeros(max([1, *(r["id"] + 1 for r in pairs)]), dtype=np.uint8)
    for row in pairs:
        lengths[row["id"]] = row["bits"]
    code = spark.sparkContext.broadcast(lengths.tobytes())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(code.value)
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                yield from _decoded(name.as_py(), content.as_py(), table)

    return _files(spark, path).mapInArrow(
        decode, "_id long, _file string, before long, n_tokens long, ids binary"
    )


def _decoded(name: str, data: bytes, table: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The documents of one file, some of them at a time."""
    raw = np.frombuffer(data, dtype=np.uint8)
    group: list[tuple] = []
    size = before = 0

    def made() -> pa.RecordBatch:
        begins = [8 * g[3] + np.cumsum(g[4].astype(np.int64)) - g[4] for g in group]
        runs = [np.minimum(STEP, g[2] - STEP * np.arange(len(g[4]))) for g in group]
        ids = unpack(raw, np.concatenate(begins), np.concatenate(runs), table).astype("<u4")
        ends = np.cumsum([g[2] for g in group])[[i for i, g in enumerate(group) if g[1]]]
        starts = np.concatenate([[0], ends[:-1]])
        columns = [
            pa.array([g[0] for g in group if g[1]], pa.int64()),
            pa.array([name] * len(ends)),
            pa.array(before + starts, pa.int64()),
            pa.array(ends - starts, pa.int64()),
            pa.array([ids[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["_id", "_file", "before", "n_tokens", "ids"])

    for block in _blocks(data):
        group.append(block)
        size += block[2]
        if block[1] and 4 * size > _BATCH_BYTES:
            yield made()
            before += size
            group, size = [], 0
    if group:
        yield made()
