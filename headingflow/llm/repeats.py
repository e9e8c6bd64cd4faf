"""Removal of repeated passages by suffix automata of reference shards.

A passage is repeated if it holds a window of ``WINDOW`` words that starts in
another place, too. Every window has an anchor, its smallest hashed run of
``GRAM`` words, so equal windows have equal anchors, and only windows whose
anchor occurs again can be repeated.

For each such anchor one section of one document is its reference. Reference
sections are dealt into shards of bounded size. The suffix automaton of a shard
goes to all tasks that stream the documents' passages which have their reference
in it. Matching statistics find the maximal spans of at least a window that the
reference holds; these go, and so do their originals in the reference. A window
that is in a passage but not in its reference is compared by a digest with the
others left over, which settles it exactly.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headingflow.llm.shingles import mixed, word_hashes
from headingflow.llm.storage import drop, written

WINDOW, GRAM = 35, 12
#: Words of a document that are the reference of an anchor together, as a power of two.
SECTION_BITS = 16
#: Words in a shard of the reference, and words streamed by one task through its automaton, about.
SHARD_WORDS, STREAM_WORDS = 1 << 16, 1 << 20
#: Words that an anchor stands for, about.
WORDS_PER_ANCHOR = 16
#: An anchor that is more than this part of all is joined by broadcast; there are fewer of these than this.
HOT = 10_000
#: Words hashed at once, and of a slice of a longer document. Places in a slice have 24 bits.
RUN, SLICE = 1 << 18, 1 << 22
_BASE = 0x9E3779B97F4A7C15


def _identity(id_column: str, text_column: str):
    """Two hashes of a row: rows with both in common are equal, and so is what is removed from them."""
    key = F.xxhash64(F.col(text_column), F.col(id_column)).alias("key")
    return key, F.xxhash64(F.lit("other"), F.col(id_column), F.col(text_column)).alias("other")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - width + size], values[width - size :]) if size < width else values


class Windows:
    """All windows of some texts' words: where each starts, the place of its anchor, and hashes of the grams."""

    def __init__(self, texts: list[list[bytes]], window: int, gram: int):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.begins = np.cumsum(sizes) - sizes
        hashes = word_hashes(b" ".join(w for t in texts for w in t))
        self.starts = np.zeros(0, dtype=np.int64)
        self.anchors = np.zeros(0, dtype=np.int64)
        if len(hashes) < window:
            return
        grams = np.zeros(len(hashes) - gram + 1, dtype=np.uint64)
        factor = 1
        for j in range(gram):
            factor = factor * _BASE % (1 << 64)
            grams += hashes[j : j + len(grams)] * np.uint64(factor)
        self.grams = mixed(grams)
        # Forty bits of the hash, then the place: the first of the smallest.
        ranked = self.grams >> np.uint64(24) << np.uint64(24) | np.arange(len(grams), dtype=np.uint64)
        low = _smallest(ranked, window - gram + 1) & np.uint64((1 << 24) - 1)
        owner = np.repeat(np.arange(len(texts)), sizes)
        whole = owner[: len(low)] == owner[window - 1 : window - 1 + len(low)]
        self.starts = np.flatnonzero(whole)
        self.anchors = low[whole].astype(np.int64)
        self.owner = owner


def _slices(texts: list[list[bytes]], window: int) -> Iterator[tuple[list[int], list[int], list[list[bytes]]]]:
    """Runs of texts: their numbers, the word each begins at, and the words. A window is in one slice only."""
    held: tuple[list, list, list] = ([], [], [])
    size = 0
    for i, words in enumerate(texts):
        for at in range(0, max(1, len(words) - window + 1), SLICE):
            part = words[at : at + SLICE + window - 1] if len(words) > SLICE else words
            for values, value in zip(held, (i, at, part), strict=True):
                values.append(value)
            size += len(part)
            if size >= RUN:
                yield held
                held, size = ([], [], []), 0
    if size:
        yield held


def find_anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``key, pos, anchor``: each place in a document that is the anchor of a window."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            texts = [words_of(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            for numbers, offsets, words in _slices(texts, window):
                found = Windows(words, window, gram)
                places = np.unique(found.anchors)
                if len(places):
                    own = found.owner[places]
                    pos = places - found.begins[own] + np.array(offsets)[own]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[np.array(numbers)[own]], pa.int64()),
                            pa.array(pos, pa.int64()),
                            pa.array(found.grams[places].view(np.int64), pa.int64()),
                        ],
                        names=["key", "pos", "anchor"],
                    )

    return docs.select("key", "text").mapInArrow(find, "key long, pos long, anchor long")


def _matched(left: DataFrame, right: DataFrame, column: str, n: str, total: int) -> DataFrame:
    """An equi-join with rows that are unique by ``column`` and occur ``n`` times on the left, of ``total`` in all.

    The few that are more than one part in ``HOT`` of all rows are broadcast, so
    that no task meets all rows of one of them.
    """
    often = right.filter(F.col(n) * HOT > total)
    hot = F.broadcast(often)
    others = left.join(F.broadcast(often.select(column)), column, "left_anti")
    return left.join(hot, column).unionByName(others.join(right.filter(F.col(n) * HOT <= total), column))


def find_routes(anchors: DataFrame, shard_words: int, stream_words: int) -> tuple[DataFrame, str]:
    """``anchor, n, reference, shard, streams`` of the anchors that occur again, written; and the path.

    The reference is the section with the smallest hash that has the anchor, so
    copies of a document have theirs in one place. ``streams`` says among how
    many tasks the passages of the shard are dealt.
    """
    section = F.xxhash64("key", F.shiftright("pos", SECTION_BITS))
    counted = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min(section).alias("reference"))
    repeated, path = written(counted.filter("n > 1"), "anchors-repeated")
    shards = max(1, -(-repeated.count() * WORDS_PER_ANCHOR // shard_words))
    placed = repeated.withColumn("shard", F.pmod("reference", F.lit(shards)))
    streams = F.ceil(F.sum("n") * WORDS_PER_ANCHOR / F.lit(stream_words)).cast("int").alias("streams")
    # The anchors of a shard are about as many as the words of a shard admit.
    routes = written(placed.join(placed.groupBy("shard").agg(streams), "shard"), "routes")
    drop(anchors.sparkSession, path)
    return routes


def _pieces(batch: pa.RecordBatch, window: int, gram: int, digest: bool) -> Iterator[pa.RecordBatch]:
    """The rows with their words counted, and the passages that may be repeated."""
    texts = [words_of(t.as_py()) for t in batch.column("text").cast(pa.binary())]
    routes = batch.column("routes")
    flat, ends = routes.flatten(), np.concatenate([[0], np.cumsum([len(r) if r.is_valid else 0 for r in routes])])
    pos, shard, streams, own = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
    keys = batch.column("key").to_numpy()
    found: list[list[tuple]] = [[] for _ in texts]
    routed = [w if ends[i + 1] > ends[i] else [] for i, w in enumerate(texts)]
    for numbers, offsets, words in _slices(routed, window):
        made = Windows(words, window, gram)
        if not len(made.starts):
            continue
        # The routes of these documents, by their place in the run.
        rows = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in numbers])
        which = np.repeat(np.arange(len(numbers)), [ends[i + 1] - ends[i] for i in numbers])
        places = pos[rows] - np.array(offsets)[which] + made.begins[which]
        inside = (places >= made.begins[which]) & (places < made.begins[which] + np.array([len(w) for w in words])[which])
        rows, places = rows[inside], places[inside]
        order = np.argsort(places, kind="stable")
        rows, places = rows[order], places[order]
        if not len(places):
            continue
        at = np.minimum(np.searchsorted(places, made.anchors), len(places) - 1)
        hit = np.flatnonzero(places[at] == made.anchors)
        if not len(hit):
            continue
        start, row = made.starts[hit], rows[at[hit]]
        owner = made.owner[start]
        new = np.ones(len(hit), dtype=bool)
        new[1:] = (
            (start[1:] != start[:-1] + 1)
            | (owner[1:] != owner[:-1])
            | (shard[row[1:]] != shard[row[:-1]])
            | (own[row[1:]] != own[row[:-1]])
        )
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hit)) - 1
        for f, e in zip(first, last, strict=True):
            d, r = owner[f], row[f]
            low, high = int(start[f] - made.begins[d]), int(start[e] - made.begins[d]) + window
            number = numbers[d]
            # Passages of a long document go to several streams.
            stream = -1 if own[r] else (int(keys[number]) + (low + offsets[d] >> SECTION_BITS)) % int(streams[r])
            found[number].append(
                (int(shard[r]), stream, int(streams[r]), low + offsets[d], b" ".join(words[d][low:high]))
            )
    kept = [b" ".join(w) if f or not digest else None for w, f in zip(texts, found, strict=True)]
    sha = [hashlib.sha256(b" ".join(w)).hexdigest() if digest and not f else None for w, f in zip(texts, found, strict=True)]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string())
    names = ("shard", "stream", "streams", "start", "words")
    rows = [p for f in found for p in f]
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    struct = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]), pa.int32())
    yield pa.RecordBatch.from_arrays(
        [
            batch.column("id"),
            batch.column("key"),
            batch.column("other"),
            pa.array([len(w) for w in texts], pa.int64()),
            pa.array(kept, pa.string()),
            pa.array(sha, pa.string()),
            pa.ListArray.from_arrays(offsets, struct),
        ],
        names=["id", "key", "other", "n_words", "words", "sha256", "pieces"],
    )


class Automaton:
    """The suffix automaton of some word sequences, none of whose matches crosses from one into the next.

    A state stands for words that end in the same places; it has at most one
    sequence of each length, so the state reached by a whole window tells which
    window it is.
    """

    def __init__(self, sequences: list[list[bytes]], window: int):
        self.window = window
        self.code: dict[bytes, int] = {}
        code = self.code
        following: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for number, words in enumerate(sequences):
            # Each sequence ends in a sign of its own.
            for c in [*(code.setdefault(w, len(code)) for w in words), -1 - number]:
                new = len(following)
                following.append({})
                length.append(length[last] + 1)
                link.append(0)
                p = last
                while p >= 0 and c not in following[p]:
                    following[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = following[p][c]
                    if length[q] == length[p] + 1:
                        link[new] = q
                    else:
                        twin = len(following)
                        following.append(following[q].copy())
                        length.append(length[p] + 1)
                        link.append(link[q])
                        while p >= 0 and following[p].get(c) == q:
                            following[p][c] = twin
                            p = link[p]
                        link[q] = link[new] = twin
                last = new
        self.following, self.link, self.length = following, link, length

    def states(self, words: list[bytes]) -> list[int]:
        """For each window of the words the state of its match, -1 if it is not there."""
        following, link, length, code, window = self.following, self.link, self.length, self.code, self.window
        found = []
        state = matched = 0
        for i, word in enumerate(words, 1):
            c = code.get(word)
            if c is None:
                state = matched = 0
            else:
                while (after := following[state].get(c)) is None and state:
                    state = link[state]
                    matched = length[state]
                if after is not None:
                    state = after
                    matched += 1
                    if matched >= window:
                        # Longer matches are as good as one of a window.
                        matched = window
                        while length[link[state]] >= window:
                            state = link[state]
            if i >= window:
                found.append(state if matched >= window else -1)
        return found


def _spans(flags: np.ndarray, start: int, window: int) -> list[tuple[int, int]]:
    """Words that the flagged windows cover, as half-open spans."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(start + int(a), start + int(b) - 1 + window) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _stream(table: pa.Table, window: int) -> pa.Table:
    """Spans to remove, and digests of windows left over, of the passages of one shard in one stream."""
    rows = table.select(["own", "key", "other", "start", "words"]).to_pylist()
    held = [r | {"words": r["words"].encode().split()} for r in rows if r["own"]]
    out: list[tuple] = []
    automaton = Automaton([r["words"] for r in held], window)
    states = [np.array(automaton.states(r["words"]), dtype=np.int64) for r in held]
    met = np.zeros(len(automaton.link), dtype=np.int64)
    for s in states:
        np.add.at(met, s, 1)
    met[met == 1] = 0
    for r in rows:
        if r["own"]:
            continue
        words = r["words"].encode().split()
        found = np.array(automaton.states(words), dtype=np.int64)
        hit = found >= 0
        met[found[hit]] = 1
        out += [(r["key"], r["other"], a, b, None) for a, b in _spans(hit, r["start"], window)]
        for i in np.flatnonzero(~hit):
            digest = hashlib.blake2b(b" ".join(words[i : i + window]), digest_size=16).digest()
            at = r["start"] + int(i)
            out.append((r["key"], r["other"], at, at + window, digest))
    for r, s in zip(held, states, strict=True):
        out += [(r["key"], r["other"], a, b, None) for a, b in _spans(met[s] > 0, r["start"], window)]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = zip(*out, strict=True) if out else [()] * len(kinds)
    names = ["key", "other", "start", "stop", "digest"]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _kept(batch: pa.RecordBatch, digest: bool) -> pa.RecordBatch:
    removed, kept = [], []
    for text, spans in zip(batch.column("words"), batch.column("spans"), strict=True):
        words = text.as_py().split(" ") if text.as_py() else []
        gone = np.zeros(len(words) + 1, dtype=np.int32)
        for span in spans.as_py() or []:
            gone[span["start"]] += 1
            gone[span["stop"]] -= 1
        stays = np.cumsum(gone)[:-1] == 0
        left = " ".join([words[i] for i in np.flatnonzero(stays)])
        removed.append(len(words) - int(stays.sum()))
        kept.append(hashlib.sha256(left.encode()).hexdigest() if digest else left)
    return pa.RecordBatch.from_arrays(
        [batch.column("id"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
        names=["id", "n_words", "n_removed", "kept"],
    )


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    digest: bool = False,
    shard_words: int = SHARD_WORDS,
    stream_words: int = STREAM_WORDS,
) -> DataFrame:
    """Every row without the words that a repeated window covers: ``id, n_words, n_removed, kept``.

    ``kept`` has the words left with one space between them, or with ``digest``
    their lowercase hex SHA-256. All windows are judged on the texts as given,
    and all copies of a window go, the first too. NULL, empty and short texts
    keep what they have. Rows with one id are rows of their own, and equal rows
    repeat each other. A very long text is worked on in slices. Other columns
    are not read. An empty table gives no rows.

    Anchors are counted, and only those that occur again go on. An anchor, a
    passage or a copied document that a large part of all rows share is dealt
    among many tasks, each of which gets the shard's reference of bounded size.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    ).select("id", "text", *_identity("id", "text"))
    kind = narrow.schema["id"].dataType.simpleString()

    anchors, anchors_path = written(find_anchors(narrow, window, gram), "anchors")
    routes, routes_path = find_routes(anchors, shard_words, stream_words)
    routed = _matched(anchors, routes, "anchor", "n", anchors.count())
    own = F.col("reference") == F.xxhash64("key", F.shiftright("pos", SECTION_BITS))
    by_doc = routed.groupBy("key").agg(F.collect_set(F.struct("pos", "shard", "streams", own.alias("own"))).alias("routes"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                yield from _pieces(batch.slice(at, 256), window, gram, digest)

    piece = "struct<shard: long, stream: int, streams: int, start: long, words: string>"
    schema = f"id {kind}, key long, other long, n_words long, words string, sha256 string, pieces array<{piece}>"
    columns = ["id", "text", "key", "other", "routes"]
    work, _ = written(narrow.join(by_doc, "key", "left").select(*columns).mapInArrow(cut, schema), "passages")
    drop(spark, anchors_path, routes_path)

    passages = work.select("key", "other", F.explode("pieces").alias("p")).select("key", "other", "p.*")
    # A reference goes to all streams of its shard.
    every = F.when(F.col("stream") < 0, F.sequence(F.lit(0), F.col("streams") - 1)).otherwise(F.array("stream"))
    dealt = passages.withColumn("own", F.col("stream") < 0).withColumn("stream", F.explode(every))
    marks, marks_path = written(
        dealt.groupBy("shard", "stream").applyInArrow(
            lambda table: _stream(table, window), "key long, other long, start long, stop long, digest binary"
        ),
        "spans",
    )
    left = marks.filter("digest IS NOT NULL")
    again = left.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again, again_path = written(again, "windows-repeated")
    repeated = _matched(left, again, "digest", "n", left.count())
    spans = marks.filter("digest IS NULL").unionByName(repeated.drop("n")).select("key", "other", "start", "stop")
    gathered = spans.groupBy("key", "other").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                yield _kept(batch.slice(at, 256), digest)

    touched = work.filter(F.size("pieces") > 0).select("id", "key", "other", "n_words", "words")
    cleaned = (
        touched.join(gathered, ["key", "other"], "left")
        .select("id", "n_words", "words", "spans")
        .mapInArrow(keep, f"id {kind}, n_words long, n_removed long, kept string")
    )
    whole = work.filter(F.size("pieces") == 0).select(
        "id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha256" if digest else "words").alias("kept")
    )
    made, _ = written(cleaned.unionByName(whole).withColumnRenamed("id", id_column), "kept")
    drop(spark, marks_path, again_path)
    return made
