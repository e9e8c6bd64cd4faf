"""Token counts of texts of any length by overlapping chunks and resynchronisation."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headingflow.llm.pieces import CUT, counter, read_spec

#: Characters between the starts of two chunks of a huge document.
CHUNK = 1 << 16
#: Characters that two neighbouring chunks share at first.
OVERLAP = 256


def stable_cuts(text: str, start: int, end: int) -> list[int]:
    """Offsets from ``start`` to ``end`` at which tokens end in every text that contains this one.

    Both neighbours of the space are seen, so neither the missing text before
    nor that after the chunk can change the tokens at the cut.
    """
    return [m.start() for m in CUT.finditer(text, max(0, start - 1), min(len(text), end + 1)) if m.start() >= start]


class Splicer:
    """Joins the chunks of one document, fed in order.

    The text since the last splice is pending. The next chunk repeats its last
    ``overlap`` characters; the first offset at which both are stable is the
    splice, and everything before it is counted and let go. If there is none,
    the overlap is widened by the chunk's own text until there is one.
    """

    def __init__(self, count, overlap: int):
        self.count, self.overlap, self.total = count, overlap, 0
        self.pending = ""

    def add(self, chunk: str) -> None:
        if not self.pending:
            self.pending = chunk
            return
        shared = self.overlap
        body = len(self.pending) - shared  # where the new chunk starts in the pending text
        left = {c - body for c in stable_cuts(self.pending, body, len(self.pending))}
        common = [c for c in stable_cuts(chunk, 0, shared) if c in left]
        if common:
            self.total += self.count(self.pending[: body + common[0]])
            self.pending = chunk[common[0] :]
            return
        # No common boundary: the overlap grows to the right, step by step.
        joined = self.pending + chunk[shared:]
        while shared < len(chunk):
            shared = min(2 * shared, len(chunk))
            found = stable_cuts(joined, body, body + shared)
            if found:
                self.total += self.count(joined[: found[0]])
                self.pending = joined[found[0] :]
                return
        self.pending = joined

    def finish(self) -> int:
        total, self.pending, self.total = self.total + self.count(self.pending), "", 0
        return total


def count_tokens(
    df: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``id_column, n_bytes, n_tokens`` for every row, as the tokenizers library counts whole texts.

    ``tokenizer`` is the path of a library file whose rules prove cuts at spaces
    (see ``pieces``); others are refused. The file is read on the driver.

    Texts longer than a chunk are cut in one walk and go to Python as overlapping
    chunks, so no batch grows with the longest text; nothing is shuffled. A run without a cut is
    held whole, as the library itself needs it whole.

    A NULL text counts as empty: 0 bytes, 0 tokens. A NULL id stays NULL, and
    repeated rows give one row each. Other columns are neither read nor returned.
    """
    if not 0 < overlap < chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer))
    text = F.coalesce(F.col(text_column), F.lit(""))
    # The kind of the id is kept; its name cannot clash with the others.
    rows = df.select(F.col(id_column).alias("_id"), text.alias("_text")).select(
        "_id",
        F.octet_length("_text").cast("long").alias("n_bytes"),
        F.expr(f"""case when char_length(_text) <= {chunk + overlap} then array(_text)
          else transform(array(regexp_extract_all(_text, '(?s).{{1,{chunk}}}', 0)), parts ->
            transform(filter(parts, (p, i) -> i = 0 or char_length(p) > {overlap}),
              (p, i) -> concat(p, substring(coalesce(get(parts, i + 1), ''), 1, {overlap}))))[0] end""").alias("_chunks"),
    )
    rows = rows.select("_id", "n_bytes", F.size("_chunks").alias("_n"), F.posexplode("_chunks").alias("_k", "_chunk"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = counter(spec.value)
        splicer = Splicer(lambda piece: next(encoder.values([piece])), overlap)
        for batch in batches:
            chunks, n, k = batch.column("_chunk"), batch.column("_n").to_pylist(), batch.column("_k").to_pylist()
            whole = encoder.values(c.as_py() for c, parts in zip(chunks, n, strict=True) if parts == 1)
            totals = []
            for piece, parts, at in zip(chunks, n, k, strict=True):
                if parts == 1:
                    totals.append(next(whole))
                    continue
                splicer.add(piece.as_py())
                totals.append(splicer.finish() if at == parts - 1 else None)
            made = pa.array(totals, pa.int64())
            kept = made.is_valid()
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").filter(kept), batch.column("n_bytes").filter(kept), made.filter(kept)],
                names=["_id", "n_bytes", "n_tokens"],
            )

    kind = df.schema[id_column].dataType.simpleString()
    counted = rows.mapInArrow(count, f"_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumnRenamed("_id", id_column)
