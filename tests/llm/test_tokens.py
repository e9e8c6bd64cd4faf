import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from headingflow.llm import huffman
from headingflow.llm.pieces import PieceEncoder, read_spec, split_pattern
from headingflow.llm.queries import op5_token_counts, op9_token_files
from headingflow.llm.token_counts import Splicer, count_tokens
from headingflow.llm.token_files import file_starts, part_number, read_ids, write_ids

BYTES, WORDS = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "a", "b", "The", " ", "  ", "\n", "\t", "é", "é", "Σ", "ς", "İ", "ß", "1", "²", "½", "'s", "'t", "'",
    "<|endoftext|>", "<|endof", "!", "...", " ", "　", "\x1c", "\x85", "中", "😀", "​", "ﬁ", "_",
    "\r\n", "\x00", "word", "x" * 250, "ŉ", "µ",
]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_equal_the_library(path):
    chance = random.Random(4)
    texts = ["".join(chance.choice(ODD) for _ in range(chance.randint(0, 25))) for _ in range(1500)]
    encoder = PieceEncoder(read_spec(path), lambda ids: ids, lambda parts: [i for p in parts for i in p], limit=300)
    assert encoder.latin.trusted
    library = Tokenizer.from_file(path)
    for text, ids in zip(texts, encoder.values(texts), strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids, text


LATIN = [
    "a", "Of", "é", "ÀÖ×Þ", "µ", "ª", "ß", "ÿ", "÷", "1", "23", "²", "¼", "'", "''", "'s", "'T", "'re", "'r", "'ve", "'v", "'ll",
    "'m", "'d", "!", "\\", "-", "_", " ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\xad", "\x00",
    "x" * 250,
]


def test_latin_texts_equal_the_library():
    """Texts split together: short forms at every place, all kinds of white space, empty texts, words too long to remember."""
    chance = random.Random(9)
    texts = ["".join(chance.choice(LATIN) for _ in range(chance.randint(0, 14))) for _ in range(4000)]
    texts += ["", "'", "'s", "'l", "'re", "\n", "", " "]
    encoder = PieceEncoder(read_spec(WORDS), lambda ids: ids, lambda parts: [i for p in parts for i in p], limit=300)
    assert encoder.latin.dense and encoder.latin.trusted and all(map(encoder.latin.takes, texts))
    library = Tokenizer.from_file(WORDS)
    for _ in range(2):  # words forgotten and kept
        for text, ids in zip(texts, encoder.values(texts), strict=True):
            assert ids == library.encode(text, add_special_tokens=False).ids, text
    assert list(encoder.values([])) == [] and list(encoder.values(["", ""])) == [[], []]


def test_a_word_is_looked_up_once_for_all_its_places():
    looked = []

    class Seen(dict):
        def __getitem__(self, key):
            looked.append(key)
            return dict.__getitem__(self, key)

        def get(self, key, default=None):
            looked.append(key)
            return dict.get(self, key, default)

    encoder = PieceEncoder(read_spec(WORDS), len, sum)
    encoder.words.now = Seen()
    assert list(encoder.values(["the of " * 5000, "of the", "and"])) == [10_000, 2, 1]
    assert len(looked) <= 6


def test_rules_without_a_proof_are_refused():
    assert split_pattern({"pre_tokenizer": {"type": "Whitespace"}, "normalizer": None}) is None


@pytest.mark.parametrize("seed", range(20))
def test_splicing_equals_the_whole_text(seed):
    chance = random.Random(seed)
    encoder = PieceEncoder(read_spec(BYTES), len, sum)
    library = Tokenizer.from_file(BYTES)
    text = "".join(chance.choice([*ODD, " word", " the"]) for _ in range(chance.randint(50, 400)))
    chunk, overlap = chance.randint(20, 90), chance.randint(1, 15)
    splicer = Splicer(lambda t: next(encoder.values([t])), overlap)
    for at in range(0, max(1, len(text) - overlap), chunk):
        splicer.add(text[at : at + chunk + overlap])
    assert splicer.finish() == len(library.encode(text, add_special_tokens=False).ids)


def counts_by_library(rows, path):
    library = Tokenizer.from_file(path)
    return Counter(
        (r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows
    )


@pytest.mark.parametrize("chunk, overlap", [(1 << 16, 256), (700, 30)])
def test_counts_of_edge_cases(edge_docs, edge_rows, chunk, overlap):
    counted = count_tokens(edge_docs, BYTES, chunk=chunk, overlap=overlap)
    assert counted.columns == ["doc_id", "n_bytes", "n_tokens"]
    assert Counter(map(tuple, counted.collect())) == counts_by_library(edge_rows, BYTES)


def test_counts_of_an_empty_table(no_docs):
    assert count_tokens(no_docs, BYTES).collect() == []


def test_counts_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = op5_token_counts(spark, sf_dir).collect()
    assert Counter(r[:3] for r in map(tuple, found)) == counts_by_library(docs, BYTES)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in found)


@pytest.mark.parametrize("limit", [4, 6, 18])
def test_code_lengths_are_optimal_and_limited(limit):
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 0, 55, 89, 144])
    lengths = huffman.code_lengths(counts, limit)
    used = lengths[counts > 0].astype(float)
    assert used.max() <= limit and lengths[9] == 0 and (0.5**used).sum() <= 1
    if limit == 18:  # as without a limit
        heap = sorted(c for c in counts.tolist() if c)
        cost = 0
        while len(heap) > 1:
            cost += heap[0] + heap[1]
            heap = sorted([heap[0] + heap[1], *heap[2:]])
        assert (counts * lengths).sum() == cost


@pytest.mark.parametrize("n", [1, 2, 127, 128, 129, 5000])
def test_packing_round_trip(n):
    chance = np.random.default_rng(n)
    ids = np.minimum(chance.geometric(0.01, n), 900).astype(np.int64)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=1000))
    packed, begins = huffman.pack(ids, huffman.canonical_codes(lengths), lengths)
    starts = np.arange(0, n, huffman.STEP)
    runs = np.minimum(huffman.STEP, n - starts)
    back = huffman.unpack(np.frombuffer(packed, np.uint8), begins[starts], runs, huffman.decoding_table(lengths))
    assert back.tolist() == ids.tolist()


def test_files_of_edge_cases(spark, edge_docs, edge_rows, tmp_path):
    path = str(tmp_path / "ids")
    write_ids(edge_docs, path, WORDS, file_bytes=2000)
    found = read_ids(spark, path).join(file_starts(spark, path), "_file").collect()
    library = Tokenizer.from_file(WORDS)
    expected = Counter((r[0], tuple([*library.encode(r[1] or "", add_special_tokens=False).ids, 1])) for r in edge_rows)
    whole = sorted(found, key=lambda r: r.ids_before + r.before)
    assert Counter((r["_id"], struct.unpack(f"<{r.n_tokens}I", r.ids)) for r in whole) == expected
    keys = [(r["_id"] is not None, r["_id"]) for r in whole]
    assert keys == sorted(keys)
    ends = 0
    for r in whole:
        assert r.ids_before + r.before == ends
        ends += r.n_tokens
    assert len({r["_file"] for r in whole}) > 1


def test_files_of_an_empty_table(spark, no_docs, tmp_path):
    path = str(tmp_path / "ids")
    write_ids(no_docs, path, WORDS)
    assert read_ids(spark, path).collect() == []


def test_files_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    found = {r.doc_id: r for r in op9_token_files(spark, sf_dir).collect()}
    library, start = Tokenizer.from_file(WORDS), 0
    for doc in docs:
        ids = [*library.encode(doc.text, add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert found[doc.doc_id] == (doc.doc_id, start, len(ids), crc)
        start += len(ids)
    assert len(found) == len(docs)


def test_files_are_in_order_of_their_numbers(spark):
    """From 100,000 files on the numbers have six digits."""
    names = [f"/x/part-1/blocks/part-{n:05d}-{n:08x}-c000.txt" for n in (99998, 99999, 100000, 100001, 7)]
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    numbers = [r[0] for r in rows.select(part_number(rows.name)).collect()]
    assert numbers == [99998, 99999, 100000, 100001, 7]


def test_ids_are_integers(spark, tmp_path):
    table = spark.createDataFrame([("a", "text")], "doc_id string, text string")
    with pytest.raises(TypeError, match="no integers"):
        write_ids(table, str(tmp_path / "x"), public_tokenizers.path("word_bpe_49k.json"))
