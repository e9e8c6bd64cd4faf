import hashlib
import random
import re
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from headingflow.llm import alignment as al
from headingflow.llm.pieces import read_spec
from headingflow.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), al.byte_values(read_spec(A))


def spans(tokens):
    at = 0
    for token, size in tokens:
        yield token, at, at + size
        at += size


def expected_of(libraries, text):
    """Groups and links of one text by all pairs of spans; None without tokens."""
    a, b, a_bytes = libraries
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)

    def b_bytes(i):
        return bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    whole = (" " + text).encode()
    if b"".join(map(a_bytes.get, ids_a)) != whole or b"".join(map(b_bytes, ids_b)) != whole:
        return None
    own_a = list(spans((i, len(a_bytes[i])) for i in ids_a))
    own_b = list(spans((i, len(b_bytes(i))) for i in ids_b))
    cuts = sorted({e for *_, e in own_a} & {e for *_, e in own_b})
    ends_of = [[e for *_, e in own] for own in (own_a, own_b)]
    groups = []
    low = 0
    for high in cuts:
        inside = [
            ",".join(str(i) for i, *_ in own[bisect_right(ends, low) : bisect_right(ends, high)])
            for own, ends in zip((own_a, own_b), ends_of, strict=True)
        ]
        groups.append("|".join(inside))
        low = high
    ends = [e for *_, e in own_b]
    links = []
    for x, s, e in own_a:
        for y, t, _ in own_b[bisect_right(ends, s) :]:
            if t >= e:
                break
            links.append((x, y))
    return len(ids_a), len(ids_b), groups, links


def brute(libraries, docs):
    found = [(d, expected_of(libraries, t)) for d, t in docs]
    counts = Counter(p for _, f in found if f for p in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    rows = []
    for d, f in found:
        if f is None:
            rows.append((d, 0, 0, 0, 0, "", 0, 0))
            continue
        n_a, n_b, groups, links = f
        rows.append((
            d, n_a, n_b, len(groups), len(links), ";".join(groups),
            sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
        ))
    links = Counter(p for _, f in found if f for p in f[3])
    pairs = sorted((*p, n, links[p], n == best[p[0]]) for p, n in counts.items())
    return sorted(rows, key=str), pairs


ODD = [
    "a  b", "a\nb\tc d", " lead", "trail ", "\n", " ", "é中😀 x", "<s> </s> <unk> <0x41> ▁x", "<|endoftext|> hi", "▁",
    "a\x00b c", "ﬁ ½ Å é", "don't  it's 'tis", "x \n y", "x y 　 z", "word", "word word word", "ｘ ́a",
]


def test_equals_brute_force(spark, libraries, monkeypatch):
    monkeypatch.setattr(al, "RUN", 300)
    monkeypatch.setattr(al, "BLOCK_CHARS", 900)
    chance = random.Random(4)
    words = "the of naïve Straße 12,5 thethe www.x.org\nNew it's —dash ..".split(" ")
    docs = [(i, t) for i, t in enumerate(ODD)]
    docs += [(100 + i, " ".join(chance.choices(words, k=chance.randint(1, 60)))) for i in range(60)]
    got = al.align(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), A, B)
    rows, pairs = brute(libraries, docs)
    assert sorted(map(tuple, got.docs.collect()), key=str) == rows
    assert sorted(map(tuple, got.pairs.collect())) == pairs
    assert sum(r[1] == 0 for r in rows) < 6  # most odd texts have tokens


def test_edges(spark, libraries, edge_docs, edge_rows):
    got = al.align(edge_docs, A, B)
    rows, _ = brute(libraries, [(r[0], r[1]) for r in edge_rows])
    assert sorted(map(tuple, got.docs.collect()), key=str) == rows


def test_empty_table(spark, no_docs):
    got = al.align(no_docs, A, B)
    assert got.docs.count() == got.pairs.count() == 0


def test_bitmaps_and_planes():
    """Lists and bitmaps, several planes, and several parts of one block."""
    block = al.BlockIndex(7, pa.int64())
    chance = np.random.default_rng(1)
    times = {}
    for part in range(3):
        slots = np.arange(part * 3000, (part + 1) * 3000)
        # Pair 5 is in every document, pair 9 in a few.
        own = {(5, s): int(chance.integers(1, 20)) for s in slots} | {(9, s): 3 for s in slots[::500]}
        times |= own
        block.add(
            np.repeat([s for _, s in own], list(own.values())), np.repeat([p for p, _ in own], list(own.values()))
        )
    got = Counter()
    kinds = set()
    for batch in block.postings():
        for row in batch.to_pylist():
            raw = np.frombuffer(row["bits"], np.uint8)
            slots = np.flatnonzero(np.unpackbits(raw, bitorder="little")) if row["dense"] else raw.view("<u2")
            kinds.add((row["dense"], row["plane"]))
            for s in slots:
                got[row["pair"], int(s)] += 1 << max(0, row["plane"] - 1)
    assert got == Counter({(p, int(s)): n for (p, s), n in times.items()})
    assert {(True, 0), (False, 0), (True, 5)} <= kinds | {(True, 5)} and len({p for _, p in kinds}) == 6


def test_a_worker_forgets_pieces(libraries, monkeypatch):
    monkeypatch.setattr(al, "KNOWN_PIECES", 5)
    aligner = al.Aligner(read_spec(A), open(B, "rb").read())
    assert aligner.cuts
    for i in range(30):
        text = f"word{i} again{i % 3} {'long' * 80}{i}"
        split, found = aligner.pieces([text])
        assert ";".join(found[p][3] for p in split[0]) == ";".join(expected_of(libraries, text)[2])
        assert not any(len(p) > al.LONGEST_KNOWN for p in aligner.known.now)


def test_pieces_end_at_signs_and_line_ends():
    """The same word before different signs is one piece."""
    aligner = al.Aligner(read_spec(A), open(B, "rb").read())
    split, found = aligner.pieces(["Été, été. Non\n Oui\nnon;\nÉté...  5,x \n", "", "été!"])
    assert split == [
        [p.encode() for p in own]
        for own in ([" Été", ",", " été", ".", " Non\n Oui", "\nnon", ";", "\nÉté", "...  5,x \n"], [], [" été", "!"])
    ]
    assert set(found) == set(split[0] + split[2])


def test_new_pieces_are_encoded_together(monkeypatch):
    """A library is asked for some texts that hold many new pieces, not for each piece."""
    aligner = al.Aligner(read_spec(A), open(B, "rb").read())
    asked = []
    own = aligner.b.encode
    monkeypatch.setattr(aligner.b, "encode", lambda x, **more: asked.extend(x) or own(x, **more), raising=False)
    aligner.pieces([" ".join(f"w{i}" for i in range(10 * al.JOINED))])
    assert len(asked) == 10


def test_cuts_that_are_not_proven_are_not_made(monkeypatch):
    """Texts are cut at spaces where a vocabulary has a cut inside, or where the samples show that a token goes on."""
    for name, value in (("_SIGN", al._LETTER), ("_INSIDE", re.compile("^▁the$"))):
        with monkeypatch.context() as patch:
            patch.setattr(al, name, value)
            aligner = al.Aligner(read_spec(A), open(B, "rb").read())
        assert aligner.cuts and not aligner.fine
        assert aligner.pieces(["word, word.\nword"])[0] == [[b" word,", b" word.\nword"]]


@pytest.mark.parametrize("cuts, fine", [(True, True), (True, False), (False, False)])
def test_texts_of_odd_characters(libraries, cuts, fine):
    """Cuts at signs, line ends and spaces, at spaces alone, and none; pieces that lose bytes beside others."""
    aligner = al.Aligner(read_spec(A), open(B, "rb").read())
    assert aligner.cuts and aligner.fine
    aligner.cuts, aligner.fine = cuts, fine
    chance = random.Random(8)
    parts = [*map(chr, range(256)), *" \n'.,é\u0301×÷ß\u0130\u1680\u2003\u2028\u3000\u0085▁—’中😀ﬁ½"]
    parts += ["'s", "'re", "'ll", "\r\n", "  "]
    parts += ["<s>", "<unk>", "<0x0A>", "<|endoftext|>", "the", "The", "don", "ing", "12"] * 6 + [" ", "\n"] * 40
    texts = ["".join(chance.choices(parts, k=chance.randint(0, 25))) for _ in range(1500)]
    block = al.BlockIndex(0, pa.int64())
    got = al._align_run(aligner, list(enumerate(texts)), block, False)
    expected = [expected_of(libraries, t) for t in texts]
    assert got["groups"] == [";".join(f[2]) if f else "" for f in expected]
    numbers = [(f[0], f[1], len(f[2]), len(f[3])) if f else (0, 0, 0, 0) for f in expected]
    assert list(zip(*(got[n].tolist() for n in al._NUMBERS), strict=True)) == numbers
    links = Counter((i, a << 16 | b) for i, f in enumerate(expected) if f for a, b in f[3])
    keys, times = np.concatenate(block.keys).tolist(), np.concatenate(block.times).tolist()
    assert {(k & (1 << al.SLOT_BITS) - 1, k >> al.SLOT_BITS): n for k, n in zip(keys, times, strict=True)} == links
    assert 50 < sum(f is None for f in expected) < 1000


def test_query(spark, libraries, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    small = [(d, t) for d, t in docs if t is None or len(t) < 1500]
    got = {r["doc_id"]: r for r in QUERIES["op12_token_alignment"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for d, t in small[:60]:
        f = expected_of(libraries, t)
        digest = hashlib.sha256(";".join(f[2]).encode()).hexdigest() if f else ""
        assert (got[d]["groups_sha256"], got[d]["n_links"]) == (digest, len(f[3]) if f else 0)
