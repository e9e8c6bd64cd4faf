"""Alignment of two tokenizers over a corpus, with an inverted index of linked id pairs.

Both tokenizers encode each text. Byte offsets at which tokens of both end cut
the tokens into groups, and two tokens are linked if their bytes overlap. The
index holds, for each pair of ids and each block of documents, a compressed
bitmap of the documents in which the pair is linked, and planes of bitmaps for
how often. Bitmaps of a pair lie in disjoint blocks, so their union is had block
by block: popcounts give the documents and the links of a pair over the corpus.
The postings then carry the scores of the pairs back to the documents.
"""

import hashlib
import json
import os
import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headingflow.llm.pieces import LONGEST_KNOWN, Recent, read_spec, split_pattern
from headingflow.llm.storage import drop, written

#: A block has at most so many documents, so their numbers in it have 14 bits, and about so many characters.
SLOT_BITS, BLOCK_CHARS = 14, 1 << 24
#: Characters of texts that are aligned at once, but for a longer text.
RUN = 1 << 20
#: Pieces of text that a worker remembers; twice as many with those it is about to forget.
KNOWN_PIECES = 200_000
#: A bitmap with more documents than this is a bit for each document of the block, another a list of 16-bit numbers.
DENSE = (1 << SLOT_BITS) // 16
#: New pieces that are encoded as one text.
JOINED = 64
#: The alignment of a piece whose bytes a tokenizer does not keep.
LOST = (0, 0, 0, "", b"")
_META = "▁"


def _ascii(kind: Callable[[str], bool]) -> np.ndarray:
    return np.array([b < 128 and kind(chr(b)) for b in range(256)])


# Kinds of bytes: white space, ASCII letters, those that end a letter behind 0xC3, ASCII signs.
_WHITE, _LETTER, _SIGN = _ascii(str.isspace), _ascii(str.isalpha), _ascii(string.punctuation.__contains__)
_LETTER_C3 = np.array([0x80 <= b < 0xC0 and chr(b + 0x40).isalpha() for b in range(256)])
_WIDE_WHITE = [chr(c).encode() for c in range(128, 0x10000) if chr(c).isspace()]
#: A place inside a token at which texts are cut.
_INSIDE = re.compile(
    rf".\n|[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff][{re.escape(string.punctuation)}]", re.DOTALL
)


def byte_values(spec: str) -> dict[int, bytes]:
    """The bytes of each id of a byte-level tokenizer. Printable bytes stand for themselves, others for the next free characters."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    return {
        i: bytes(byte[c] for c in token)
        for token, i in json.loads(spec)["model"]["vocab"].items()
        if all(c in byte for c in token)
    }


class Aligner:
    """Aligned tokens of texts, from the alignments of their pieces.

    A text with a space before it is cut before single spaces and line ends
    that stand between characters that are no white space, and between a letter
    and an ASCII sign. Where the rules of both tokenizers prove that a token
    begins at each such place whatever stands around it, the pieces are aligned
    on their own, and a piece that was met before is looked up. Where they
    prove it for spaces alone, texts are cut at those; else a text is one piece.
    A piece is UTF-8 and keeps the space, line end or sign that it begins with.
    """

    def __init__(self, spec: str, model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_a = byte_values(spec)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_META, " ").encode() for i, p in enumerate(pieces)
        ]
        self.known = Recent(KNOWN_PIECES)
        most = max(len(self.bytes_b), max(self.bytes_a) + 1)
        self.bytes_a = [self.bytes_a.get(i, b"") for i in range(max(self.bytes_a) + 1)]
        self.size_a, self.size_b = (np.array([len(x) for x in own]) for own in (self.bytes_a, self.bytes_b))
        self.written = [f"{i}{sign}" for i in range(most) for sign in ",|;\n"]
        # Pieces may begin with spaces, but none has a space behind another character. (A text
        # that has the sign for a space itself does not keep its bytes, however it is cut.)
        rules = json.loads(spec)
        self.cuts = split_pattern(rules) is not None and not any(_META in p.lstrip(_META) for p in pieces)
        # No token has a line end or an ASCII sign where a text may be cut. Byte, control and
        # unknown pieces are written with signs, but stand for no such text.
        b = self.b
        plain = [p for i, p in enumerate(pieces) if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i))]
        plain += [t["content"] for t in rules.get("added_tokens", []) if not t["special"]]
        self.fine = self.cuts and not any(_INSIDE.search(p) for p in plain)
        samples = [f"x{c}y {c}{c} 1{c} z\n{c}x.{c}y, {c}\n1{c}'s {c}x#{c}\n\nz" for c in map(chr, range(1, 256))]
        self.fine = self.fine and self._proven(samples)
        self.cuts = self.cuts and (self.fine or self._proven(samples))

    def _proven(self, texts: list[str]) -> bool:
        """Whether the pieces of each text have the tokens that the libraries give for the whole."""
        try:
            split, found = self.pieces(texts)
        except ValueError:  # a token goes on behind a cut
            return False
        finally:
            self.known = Recent(KNOWN_PIECES)
        pieces = [f" {t}".encode() for t in texts]
        whole = self._joined([[p] for p in pieces])
        for piece, own in zip(pieces, split, strict=True):
            made = [found[p] for p in own]
            if (piece in whole) == (LOST in made):
                return False
            if piece in whole and whole[piece][3:] != (";".join([v[3] for v in made]), b"".join([v[4] for v in made])):
                return False
        return True

    def _new(self, pieces: list[bytes]) -> list[tuple]:
        """Of each piece: numbers of tokens of both and of groups, the groups, the linked pairs.

        ``LOST`` for a piece whose bytes a tokenizer does not keep.
        """
        # Pieces stand one after the other in texts that are cut between them. One that
        # begins or ends with more white space is a text of its own.
        joined, alone = [], []
        for piece in pieces:
            text = piece.decode()
            odd = not self.cuts or (text[0].isspace() and text[1:2].isspace()) or text[-1].isspace()
            (alone if odd else joined).append(piece)
        texts = [joined[i : i + JOINED] for i in range(0, len(joined), JOINED)]
        made = self._joined(texts + [[p] for p in alone])
        # Where a tokenizer does not keep the bytes of such a text, its pieces tell which it is.
        made |= self._joined([[p] for text in texts if len(text) > 1 for p in text if p not in made])
        return [made.get(p, LOST) for p in pieces]

    def _joined(self, texts: list[list[bytes]]) -> dict[bytes, tuple]:
        """The alignments of the pieces of those texts whose bytes both tokenizers keep."""
        # What begins with no space stands behind a letter.
        stood = [[y for p in pieces for y in ((p,) if p[:1] == b" " else (b" x", p))] for pieces in texts]
        raw = [b"".join(pieces) for pieces in stood]
        whole = [x.decode() for x in raw]
        a = [x.ids for x in self.a.encode_batch_fast(whole, add_special_tokens=False)]
        b = self.b.encode([x[1:] for x in whole], num_threads=1)
        kept = [i for i, x in enumerate(raw) if self._keeps(x, a[i], b[i])]
        pieces = [p for i in kept for p in stood[i]]
        if not pieces:
            return {}
        ids = ([np.array(own[i], dtype=np.int64) for i in kept] for own in (a, b))
        return dict(zip(pieces, self._aligned(*map(np.concatenate, ids), list(map(len, pieces))), strict=True))

    def _keeps(self, text: bytes, a: list[int], b: list[int]) -> bool:
        of_a, of_b = self.bytes_a, self.bytes_b
        return b"".join([of_a[i] for i in a]) == text == b"".join([of_b[i] for i in b])

    def _aligned(self, ids_a: np.ndarray, ids_b: np.ndarray, sizes: list[int]) -> Iterator[tuple]:
        """Alignments of pieces of these sizes, which stand one after the other."""
        ends_a, ends_b, piece_ends = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b]), np.cumsum(sizes)
        total = int(piece_ends[-1])
        is_a, is_b = np.zeros(total + 1, dtype=bool), np.zeros(total + 1, dtype=bool)
        is_a[ends_a], is_b[ends_b] = True, True
        either, both = is_a | is_b, is_a & is_b
        if not both[piece_ends].all():
            raise ValueError("a token goes on where the rules of both tokenizers end one")
        # Tokens, links and groups that end up to each byte.
        kind = np.int32 if total < 1 << 31 else np.int64
        upto_a, upto_b, upto_link, upto_group = (np.cumsum(x, dtype=kind) for x in (is_a, is_b, either, both))
        # Each stretch between two ends, of whichever tokenizer, is what one pair of tokens shares.
        ends, cuts = np.flatnonzero(either), np.flatnonzero(both)
        pairs = ids_a[upto_a[ends - 1]] << 16 | ids_b[upto_b[ends - 1]]
        # Tokens in writing order: those of a before those of b in each group, with the sign that follows each.
        before_b, with_a = upto_b[np.append(0, cuts[:-1])], upto_a[cuts]
        signs = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        signs[np.arange(len(ids_a)) + before_b[upto_group[ends_a - 1]]] = ids_a << 2 | both[ends_a]
        last_b = np.where(both[ends_b], 2, 0)
        last_b[upto_b[piece_ends] - 1] = 3
        signs[np.arange(len(ids_b)) + with_a[upto_group[ends_b - 1]]] = ids_b << 2 | last_b
        groups = "".join(map(self.written.__getitem__, signs.tolist())).split("\n")
        raw = pairs.astype("<i8").tobytes()
        links = (8 * upto_link[piece_ends].astype(np.int64)).tolist()
        n_a, n_b, n_groups = (np.diff(x[piece_ends], prepend=0).tolist() for x in (upto_a, upto_b, upto_group))
        linked = [raw[low:high] for low, high in zip([0, *links], links, strict=False)]
        return zip(n_a, n_b, n_groups, groups, linked, strict=False)

    def distinct(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Each piece of the texts once; the piece at each place; how many pieces each text has."""
        raw = [f" {t}".encode() if t else b"" for t in texts]
        sizes = np.array([len(x) for x in raw], dtype=np.int64)
        reach = np.cumsum(sizes)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        begins = self._begins(data)
        begins[(reach - sizes)[sizes > 0]] = True
        offsets = np.append(np.flatnonzero(begins), len(data))
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        pieces = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).dictionary_encode()
        counts = np.diff(np.searchsorted(offsets[:-1], reach), prepend=0)
        return pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy(), counts

    def _begins(self, data: np.ndarray) -> np.ndarray:
        """Where pieces begin in UTF-8, but for the begin of a text."""
        begins = np.zeros(len(data), dtype=bool)
        if not self.cuts or not len(data):
            return begins
        solid = ~_WHITE[data]
        for sign in _WIDE_WHITE:
            at = np.flatnonzero(data[: len(data) - len(sign) + 1] == sign[0])
            for k in range(1, len(sign)):
                at = at[data[at + k] == sign[k]]
            for k in range(len(sign)):
                solid[at + k] = False
        at = data == ord(" ")
        if self.fine:
            at |= data == ord("\n")
        begins[1:-1] = at[1:-1] & solid[:-2] & solid[2:]
        if self.fine:
            letter = _LETTER[data]
            letter[1:] |= (data[:-1] == 0xC3) & _LETTER_C3[data[1:]]
            begins[1:] |= letter[:-1] & _SIGN[data[1:]]
        return begins

    def values(self, pieces: list[bytes]) -> list[tuple]:
        """The alignments of these different pieces."""
        values, places = self.known.found(pieces)
        for i, value in zip(places, self._new([pieces[i] for i in places]), strict=True):
            values[i] = value
            if len(pieces[i]) <= LONGEST_KNOWN:
                self.known.now[pieces[i]] = value
        return values

    def pieces(self, texts: list[str]) -> tuple[list[list[bytes]], dict[bytes, tuple]]:
        """The pieces of each text, and the alignments of them all."""
        pieces, which, counts = self.distinct(texts)
        split = [[pieces[i] for i in own] for own in np.split(which, np.cumsum(counts)[:-1])]
        return split, dict(zip(pieces, self.values(pieces), strict=True))


@lru_cache(maxsize=1)
def _aligner(spec: str, model: bytes) -> Aligner:
    return Aligner(spec, model)


def _runs(rows: Iterator[tuple], limit: int, most: int) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= limit or len(held) >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places from each start on, as many as its size."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class BlockIndex:
    """The links of one block's documents, until they are written as bitmaps."""

    def __init__(self, number: int, id_kind: pa.DataType | None = None):
        self.number, self.id_kind = number, id_kind
        self.docs = self.chars = 0
        self.keys = [np.zeros(0, dtype=np.int64)]
        self.times = [np.zeros(0, dtype=np.int64)]

    def add(self, slots: np.ndarray, pairs: np.ndarray) -> None:
        """Occurrences of linked pairs of documents that come with no other call."""
        keys = np.sort(pairs << SLOT_BITS | slots)
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys.append(keys[new])
        self.times.append(np.diff(np.append(new, len(keys))))

    def postings(self) -> Iterator[pa.RecordBatch]:
        """``pair, block, plane, dense, bits``: plane 0 has all documents, plane j the bit j - 1 of the links but one."""
        keys, more = np.concatenate(self.keys), np.concatenate(self.times) - 1
        order = np.argsort(keys, kind="stable")
        keys, more = keys[order], more[order]
        plane, own = 0, keys
        while len(keys):
            yield from self._bitmaps(own, plane)
            keys, more = keys[more > 0], more[more > 0]
            own = keys[(more & 1).astype(bool)]
            more = more >> 1
            plane += 1

    def _bitmaps(self, keys: np.ndarray, plane: int) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        pair, slot = keys >> SLOT_BITS, (keys & ((1 << SLOT_BITS) - 1)).astype("<u2")
        begins = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        sizes = np.diff(np.append(begins, len(pair)))
        dense = sizes > DENSE
        few = slot[np.repeat(~dense, sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(2 * sizes[~dense])]).astype(np.int32)
        lists = pa.Array.from_buffers(
            pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(few)]
        )
        maps = []
        for at, n in zip(begins[dense], sizes[dense], strict=True):
            bits = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
            bits[slot[at : at + n]] = 1
            maps.append(np.packbits(bits, bitorder="little").tobytes())
        for which, kind, bits in ((~dense, False, lists), (dense, True, pa.array(maps, pa.binary()))):
            if len(bits):
                yield _rows(
                    self.id_kind,
                    block=np.full(len(bits), self.number),
                    pair=pair[begins[which]],
                    plane=np.full(len(bits), plane),
                    dense=np.full(len(bits), kind),
                    bits=bits,
                )


#: Rows of the first pass: of documents, where ``pair`` is NULL, and of postings.
_KINDS = {
    "block": pa.int64(), "slot": pa.int32(), "doc_id": None, "n_a": pa.int64(), "n_b": pa.int64(),
    "n_groups": pa.int64(), "n_links": pa.int64(), "groups": pa.string(), "pair": pa.int64(),
    "plane": pa.int32(), "dense": pa.bool_(), "bits": pa.binary(),
}
_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _rows(id_kind: pa.DataType | None, **columns) -> pa.RecordBatch:
    n = len(columns["block"])
    made = []
    for name, kind in _KINDS.items():
        value, kind = columns.get(name), kind or id_kind or pa.null()
        made.append(pa.nulls(n, kind) if value is None else pa.array(value, kind) if not isinstance(value, pa.Array) else value)
    return pa.RecordBatch.from_arrays(made, names=list(_KINDS))


@dataclass
class Alignment:
    """Results in the shared folder.

    ``docs``: a row for each document with its numbers and ``groups``. ``pairs``:
    ``a, b, n_docs, n_links, is_best``, the scores of each pair of ids.
    """

    docs: DataFrame
    pairs: DataFrame


def _align_run(aligner: Aligner, rows: list[tuple], block: BlockIndex, digest: bool) -> dict:
    """The columns of some documents' rows; their links go to the block."""
    texts = [r[1] for r in rows]
    pieces, piece, counts = aligner.distinct(texts)
    n_a, n_b, n_groups, written_as, linked = zip(*aligner.values(pieces), strict=True) if pieces else [()] * 5
    sizes = np.array([len(x) // 8 for x in linked], dtype=np.int64)
    numbers = [np.array(x, dtype=np.int64) for x in (n_a, n_b, n_groups, sizes)]
    owner = np.repeat(np.arange(len(rows)), counts)
    # A document with a piece that loses bytes has no tokens.
    lost = np.unique(owner[(numbers[0] == 0)[piece]])
    if len(lost):
        counts[lost] = 0
        kept = ~np.isin(owner, lost)
        owner, piece = owner[kept], piece[kept]
    sums = np.zeros((len(rows), 4), dtype=np.int64)
    full, ends = np.flatnonzero(counts), np.cumsum(counts)
    if len(full):
        for k, own in enumerate(numbers):
            sums[full, k] = np.add.reduceat(own[piece], (ends - counts)[full])
        pairs = np.frombuffer(b"".join(linked), dtype="<i8")
        of_piece = sizes[piece]
        take = _ragged((np.cumsum(sizes) - sizes)[piece], of_piece)
        block.add(np.repeat(owner, of_piece) + block.docs, pairs[take])
    each = np.fromiter(written_as, dtype=object, count=len(written_as))[piece].tolist()
    groups = [";".join(each[low:high]) for low, high in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
    if digest:
        groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
    out = {
        "block": np.full(len(rows), block.number),
        "slot": block.docs + np.arange(len(rows)),
        "doc_id": [r[0] for r in rows],
        "groups": groups,
        **{name: sums[:, k] for k, name in enumerate(_NUMBERS)},
    }
    block.docs += len(rows)
    block.chars += sum(map(len, texts))
    return out


def index_links(
    docs: DataFrame, spec: str, model: bytes, id_column: str, text_column: str, digest: bool
) -> tuple[DataFrame, str]:
    """Rows of documents and of postings, written; and their path."""
    sent = docs.sparkSession.sparkContext.broadcast((spec, model))
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*sent.value)
        task = TaskContext.get()
        first = (task.partitionId() if task else 0) << 32
        block = BlockIndex(first)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            block.id_kind = ids.type
            rows = ((i, t.as_py()) for i, t in enumerate(texts))
            for run in _runs(rows, RUN, 1 << SLOT_BITS - 2):
                if block.docs and (block.docs + len(run) > 1 << SLOT_BITS or block.chars >= BLOCK_CHARS):
                    yield from block.postings()
                    block = BlockIndex(block.number + 1, ids.type)
                made = _align_run(aligner, run, block, digest)
                made["doc_id"] = ids.take(pa.array(made["doc_id"], pa.int64()))
                yield _rows(ids.type, **made)
        if block.docs:
            yield from block.postings()

    kind = narrow.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block long, slot int, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, "
        "pair long, plane int, dense boolean, bits binary"
    )
    return written(narrow.mapInArrow(index, schema), "alignment")


def popcount() -> Column:
    """Documents in a bitmap."""
    return F.when(F.col("dense"), F.bitmap_count("bits")).otherwise(F.length("bits") / 2).cast("long")


def score_pairs(postings: DataFrame) -> DataFrame:
    """``pair, n_docs, n_links, is_best`` from the bitmaps of all blocks.

    A pair is best if no other pair of its first id is in more documents.
    """
    links = popcount() * F.expr("shiftleft(1L, greatest(plane - 1, 0))")
    counted = postings.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, popcount()).otherwise(0)).alias("n_docs"), F.sum(links).alias("n_links")
    )
    # At most as many rows as the second vocabulary has ids.
    of_a = Window.partitionBy(F.shiftright("pair", 16))
    return counted.withColumn("is_best", F.col("n_docs") == F.max("n_docs").over(of_a))


def _returned(docs: pa.Table, postings: pa.Table) -> pa.Table:
    """The documents of one block, with the scores that its postings give back."""
    best, total = np.zeros(1 << SLOT_BITS, dtype=np.int64), np.zeros(1 << SLOT_BITS, dtype=np.int64)
    for batch in postings.to_batches():
        links = np.int64(1) << np.maximum(batch.column("plane").to_numpy() - 1, 0).astype(np.int64)
        n_docs = batch.column("n_docs").to_numpy()
        is_best = batch.column("is_best").to_numpy(zero_copy_only=False)
        dense = batch.column("dense").to_numpy(zero_copy_only=False)
        for kind in (False, True):
            which = np.flatnonzero(dense == kind)
            bits = [b.as_py() for b in batch.column("bits").take(pa.array(which))]
            if kind:
                slots = [np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8), bitorder="little")) for b in bits]
            else:
                slots = [np.frombuffer(b"".join(bits), dtype="<u2")]
            sizes = [len(s) for s in slots] if kind else [len(b) // 2 for b in bits]
            where, row = np.concatenate([*slots, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(which, sizes)
            np.add.at(total, where, (n_docs * links)[row])
            np.add.at(best, where, (is_best * links)[row])
    slot = docs.column("slot").to_numpy()
    return docs.append_column("n_best", pa.array(best[slot])).append_column("count_sum", pa.array(total[slot]))


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: bool = False,
) -> Alignment:
    """Align every row under a byte-level tokenizer (a) and a sentencepiece model (b).

    ``groups`` is written ``a1,a2|b1;a3|b2,b3``, or its lowercase hex SHA-256
    with ``digest``; '' for a document without tokens. A text that is NULL or
    empty, or whose bytes a tokenizer does not keep, has no tokens: zeros. Rows
    with one id are documents of their own, a NULL id stays NULL, and other
    columns are not read. A block holds one text at least, so a very long one is
    a block of its own. An empty table gives empty results.

    Texts are encoded once. Postings are shuffled twice: by pair to meet the
    scores, where a pair has one row for each block and plane, and by block to
    reach the documents, where a block has a bounded number of links.
    """
    spark = docs.sparkSession
    with open(b_path, "rb") as file:
        model = file.read()
    rows, path = index_links(docs, read_spec(a_path), model, id_column, text_column, digest)
    postings = rows.filter("pair IS NOT NULL").select("pair", "block", "plane", "dense", "bits")
    pairs, _ = written(score_pairs(postings), "pairs")
    scored = postings.join(pairs.drop("n_links"), "pair")
    numbers = ["block", "slot", "doc_id", *_NUMBERS, "groups"]
    of_docs = spark.read.schema(rows.schema).parquet(path).filter("pair IS NULL").select(*numbers)
    schema = StructType(list(of_docs.schema.fields)).add("n_best", "long").add("count_sum", "long")
    returned = of_docs.groupBy("block").cogroup(scored.groupBy("block")).applyInArrow(_returned, schema)
    made, _ = written(returned.drop("block", "slot"), "aligned")
    drop(spark, path)
    first = F.shiftright("pair", 16).cast("int").alias("a")
    second = (F.col("pair").bitwiseAND(0xFFFF)).cast("int").alias("b")
    return Alignment(made, pairs.select(first, second, "n_docs", "n_links", "is_best"))
