"""WARC archives with one gzip member for each record: a writer, and a reader that splits files anywhere.

Files are made by Spark's text writer, whose rows end with a zero byte here. The
last byte of a gzip member is the highest byte of the payload's length, which is
zero below 16 MiB; the writer leaves that byte to the row's end. A longer record
is followed by an empty member, whose last byte is zero too. So the files are
plain sequences of members, as every WARC tool reads them.
"""

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headingflow.llm.storage import written

#: Payloads below this size are always written in full.
REVISIT_BYTES = 1000
#: The first bytes of a gzip member that holds a deflated stream.
GZIP = b"\x1f\x8b\x08"
LEVEL = 3
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BATCH_BYTES = 8 << 20
#: Flags of a gzip header that RFC 1952 reserves.
_RESERVED = 0xE0


def with_revisits(
    pages: DataFrame, id_column: str = "page_id", text_column: str = "html", least: int = REVISIT_BYTES
) -> DataFrame:
    """The columns of ``pages`` with ``payload_bytes, payload_digest, refers_to``.

    Of equal payloads of at least ``least`` bytes that with the largest id is
    the response, and ``refers_to`` of the others is its id; else it is NULL.
    Only digests are grouped, and only groups of two or more are joined back.
    """
    payload = F.encode(F.coalesce(F.col(text_column), F.lit("")), "UTF-8")
    known = pages.withColumns(
        {
            "payload_bytes": F.octet_length(F.coalesce(F.col(text_column), F.lit(""))).cast("long"),
            "payload_digest": F.sha1(payload),
            "_payload": F.sha2(payload, 256),
        }
    )
    groups = (
        known.filter(F.col("payload_bytes") >= least)
        .groupBy("_payload")
        .agg(F.max(id_column).alias("_last"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    other = F.col("_last").isNotNull() & ~F.col("_last").eqNullSafe(F.col(id_column))
    return (
        known.join(groups, "_payload", "left")
        .withColumn("refers_to", F.when(other, F.col("_last")))
        .drop("_payload", "_last")
    )


def record_id(key: object) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def _header(fields: list[tuple[str, str]]) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields), "", ""]
    return "\r\n".join(lines).encode("utf-8", "replace")


def _member(data: bytes) -> bytes:
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def record(
    key: object, uri: str | None, payload: bytes, digest: str, size: int, refers_to: object, date: str
) -> bytes:
    """One record as a gzip member; that of a revisit holds no payload."""
    revisit = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(key)),
        ("WARC-Target-URI", re.sub(r"[\r\n]+", " ", uri or "")),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("X-Payload-Length", str(size)),
    ]
    if revisit:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    block = b"" if revisit else payload
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block)))]
    return _member(_header(fields) + block + b"\r\n\r\n")


def write_warc(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    uri_column: str = "url",
    text_column: str = "html",
    least: int = REVISIT_BYTES,
    date: str = "2026-01-01T00:00:00Z",
) -> None:
    """Write a record for every row, its payload the text in UTF-8.

    A NULL text is an empty payload, a NULL uri an empty one, a NULL id an empty
    name that reads back as NULL. Rows that repeat an id each give a record. Row
    order and files follow the parts of the table; nothing is sorted.
    """
    rows = with_revisits(
        pages.select(
            F.col(id_column).alias("_id"), F.col(uri_column).alias("_uri"), F.col(text_column).alias("_text")
        ),
        "_id",
        "_text",
        least,
    )
    # A revisit needs no text.
    rows = rows.withColumn("_text", F.when(F.col("refers_to").isNull(), F.coalesce("_text", F.lit(""))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("_id", "_uri", "_text", "payload_digest", "payload_bytes", "refers_to")
        for batch in batches:
            out, size = [], 0
            for key, uri, text, digest, length, refers in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                made = record(key, uri, (text or "").encode("utf-8", "surrogatepass"), digest, length, refers, date)
                if made[-1]:  # 16 MiB or more: an empty member ends it
                    made += _member(b"")
                out.append(made[:-1])
                size += len(made)
                if size > _BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    made = rows.mapInArrow(build, "value binary").select(F.col("value").cast("string").alias("value"))
    made.write.option("lineSep", "\0").text(path)


def member_head(data: bytes) -> int | None:
    """Where the deflated stream of a gzip member begins, or None if no header stands here."""
    if len(data) < 10 or data[:3] != GZIP or data[3] & _RESERVED:
        return None
    flags, at = data[3], 10
    if flags & 4:
        if len(data) < at + 2:
            return None
        at += 2 + int.from_bytes(data[at : at + 2], "little")
    for flag in (8, 16):
        if flags & flag:
            end = data.find(b"\0", at)
            if end < 0:
                return None
            at = end + 1
    if flags & 2:
        at += 2
    return at if at < len(data) else None


def starts_record(data: bytes) -> bool:
    """Whether a record, or an empty member, begins here: its header is decoded and the stream looked into."""
    at = member_head(data)
    if at is None:
        return False
    try:
        opened = zlib.decompressobj(-15)
        begun = opened.decompress(data[at : at + 512], 5)
    except zlib.error:
        return False
    return begun[:5] == b"WARC/"[: len(begun)] and (len(begun) == 5 or opened.eof)


def inflated(data: bytes) -> bytes | None:
    """The content of a whole member, checked against its checksum; None if it is not whole."""
    opened = zlib.decompressobj(31)
    try:
        content = opened.decompress(data)
    except zlib.error:
        return None
    return content if opened.eof and not opened.unused_data.strip(b"\0") else None


class Members:
    """Puts the pieces between magic bytes together to members, in the order of one byte range.

    ``orphans`` are the pieces before the first record that begins in the range:
    they belong to a member of an earlier range that holds the magic bytes by
    chance. ``rest`` is the last member if its pieces do not make it whole.
    """

    def __init__(self):
        self.rest: bytes | None = None
        self.orphans: list[bytes] = []
        self.begun = False

    def add(self, piece: bytes) -> bytes | None:
        """The content of a member as soon as it is whole."""
        data = GZIP + piece
        if self.rest is not None:
            data = self.rest + data
        elif starts_record(data):
            self.begun = True
        elif self.begun:
            raise ValueError("no record begins after the end of the last one")
        else:
            self.orphans.append(data)
            return None
        whole = inflated(data)
        self.rest = data if whole is None else None
        return whole

    def loose(self) -> list[tuple[bool, bytes]]:
        """What other ranges are needed for: whether it opens a member, and the bytes."""
        return [(False, x) for x in self.orphans] + ([(True, self.rest)] if self.rest is not None else [])


def parse(content: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields in lower case and the block of a record; None for an empty member."""
    if not content:
        return None
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    size = int(fields["content-length"])
    if len(rest) < size:
        raise ValueError("a record is cut short")
    return fields, rest[:size]


def _named(text: str | None) -> str | None:
    """The page's id in a record's name."""
    found = re.fullmatch(r"<urn:page:(.*)>", text or "", re.DOTALL)
    return found[1] if found and found[1] else None


def _record_row(content: bytes, payloads: bool) -> tuple | None:
    parsed = parse(content)
    if parsed is None:
        return None
    fields, block = parsed
    kind = fields["warc-type"]
    if kind == "revisit":
        name = fields["warc-payload-digest"].partition(":")[2]
        digest, size = base64.b32decode(name).hex(), int(fields["x-payload-length"])
    else:  # from what was read, not from what the header says
        digest, size = hashlib.sha1(block, usedforsecurity=False).hexdigest(), len(block)
    named = _named(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind, digest, size
    return *named, _named(fields.get("warc-refers-to")), block if payloads else None


_RECORD = {
    "record_id": "string", "uri": "string", "record_type": "string", "payload_digest": "string",
    "payload_bytes": "long", "refers_to": "string", "payload": "binary",
}
_LOOSE = {"_file": "string", "_block": "long", "_order": "int", "_opens": "boolean", "_piece": "binary"}
_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


def _batch(rows: list[tuple], columns: dict[str, str]) -> pa.RecordBatch:
    cells = list(zip(*rows, strict=True)) if rows else [()] * len(columns)
    made = [pa.array(c, _ARROW[kind]) for c, kind in zip(cells, columns.values(), strict=True)]
    return pa.RecordBatch.from_arrays(made, names=list(columns))


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every record: ``record_id, uri, record_type, payload_digest, payload_bytes, refers_to, payload``.

    Spark cuts the files into byte ranges, and its reader looks in each range
    for the magic bytes of a gzip member; a range owns what begins inside, up to
    the next magic bytes, also beyond its end. A piece counts as the beginning
    of a record only if a gzip header can be decoded there and its stream begins
    with a record. Magic bytes that occur inside a member by chance cut it into
    pieces, which are put together again: inside a range at once, and over the
    bounds of ranges by a second, small step that joins the loose pieces of a
    file in their order. No task needs a whole file.

    ``payload`` is NULL unless asked for. Digest and length of a response come
    from its block, those of a revisit from its header. What is returned is read
    from a copy in the shared folder. A record that is damaged or cut short is
    an error. Names must not end in ``.gz``: Spark would unpack such files
    before they can be split. A payload that holds a whole archive uncompressed
    inside its member must not lie on the bound of a range.
    """
    columns = _RECORD | _LOOSE

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, members = None, Members()
        rows: list[tuple] = []
        size = 0

        def finished() -> list[tuple]:
            pieces = members.loose()
            return [(*[None] * len(_RECORD), *here, k, opens, data) for k, (opens, data) in enumerate(pieces)]

        for batch in batches:
            ranges = zip(batch.column("_file").to_pylist(), batch.column("_block").to_pylist(), strict=True)
            for place, piece in zip(ranges, batch.column("_piece"), strict=True):
                if place != here:
                    rows += finished() if here else []
                    here, members = place, Members()
                    if place[1] == 0:  # what stands before the first magic bytes of a file
                        if piece.as_py():
                            raise ValueError(f"{place[0]} does not begin with a gzip member")
                        continue
                content = members.add(piece.as_py())
                made = None if content is None else _record_row(content, payloads)
                if made:
                    rows.append((*made, *[None] * len(_LOOSE)))
                    size += len(made[-1] or b"") + 500
                if size > _BATCH_BYTES:
                    yield _batch(rows, columns)
                    rows, size = [], 0
        rows += finished() if here else []
        yield _batch(rows, columns)

    # This encoding makes single bytes of the separator; the values are raw bytes.
    ranges = spark.read.option("encoding", "ISO-8859-1").option("lineSep", GZIP.decode("latin-1")).text(path)
    pieces = ranges.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("value").cast("binary").alias("_piece"),
    )
    read, _ = written(pieces.mapInArrow(scan, _ddl(columns)), "records")

    # Each loose piece belongs to the last member that was opened before it.
    order = Window.partitionBy("_file").orderBy("_block", "_order")
    chains = (
        read.filter("_file is not null")
        .withColumn("_chain", F.count_if("_opens").over(order))
        .groupBy("_file", "_chain")
        .agg(F.array_sort(F.collect_list(F.struct("_block", "_order", "_piece"))).alias("_parts"))
        .select("_file", F.transform("_parts", lambda x: x["_piece"]).alias("_parts"))
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, parts in zip(*(batch.column(c).to_pylist() for c in ("_file", "_parts")), strict=True):
                content = inflated(b"".join(parts))
                if content is None:
                    raise ValueError(f"{name} holds a damaged record")
                rows.append(_record_row(content, payloads))
            yield _batch([r for r in rows if r], _RECORD)

    mended = chains.mapInArrow(join, _ddl(_RECORD))
    return read.filter("_file is null").select(*_RECORD).unionByName(mended)
