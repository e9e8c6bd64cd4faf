"""Encoding of whole texts piece by piece, with a library tokenizer.

A text may be cut before a single space that stands between two characters that
are no white space. The pre-tokenizers accepted here end a token before such a
space and look at no character before it, so the tokens of the text are those
of its pieces, one after the other. Most pieces recur, and each worker encodes
a piece it knows by one look-up. Texts of Latin letters, whose rules are tested
against the library when a worker starts, are split into their words, which
recur more often still.
"""

import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

# Patterns that keep a space only in front of what follows it, or drop it.
DROPS_SPACE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
KEEPS_SPACE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Pieces, and words, that a worker remembers; twice as many with those it is about to forget.
KNOWN_PIECES = 350_000
#: Longer pieces are encoded each time, so that their number bounds the memory.
LONGEST_KNOWN = 200
#: Characters of texts that are split at once.
RUN = 1 << 20


def _flat(part: dict | None, inner: str) -> list[dict]:
    if not part:
        return []
    return [y for x in part[inner] for y in _flat(x, inner)] if part["type"] == "Sequence" else [part]


def split_pattern(spec: dict) -> str | None:
    """The pattern by which the tokenizer splits, if its rules prove that tokens end at every cut."""

    def normal(part: dict) -> bool:
        if part["type"] == "Replace":
            return part["pattern"] == {"Regex": r"\s+"} and part["content"] == " "
        return part["type"] in ("NFC", "NFD", "Lowercase")

    splits = _flat(spec.get("pre_tokenizer"), "pretokenizers")
    first = splits[0] if splits else {"type": None}
    pattern = None
    if first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"]:
        pattern = first["pattern"].get("Regex")
    elif first["type"] == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"]:
        pattern = KEEPS_SPACE
    rest = all(p["type"] == "ByteLevel" and not (p["add_prefix_space"] or p["use_regex"]) for p in splits[1:])
    plain = all(
        not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]))
        for t in spec.get("added_tokens", [])
    )
    proven = rest and plain and all(normal(p) for p in _flat(spec.get("normalizer"), "normalizers"))
    return pattern if proven and pattern in (DROPS_SPACE, KEEPS_SPACE) else None


class LatinWords:
    """Words of a text as the library splits it, for texts of Latin-1 characters without special tokens.

    ``trusted`` is False if a test of each of these characters, in several
    places, differs from the library; then nothing is split here.
    """

    def __init__(self, tokenizer, spec: dict, pattern: str):
        latin = list(map(chr, range(256)))
        # Kinds of characters: 0 white, 1 letter, 2 digit, 3 other.
        kinds = [
            0 if c.isspace() and not "\x1c" <= c <= "\x1f" else {"L": 1, "N": 2}.get(unicodedata.category(c)[0], 3)
            for c in latin
        ]
        self.kinds = np.array(kinds, dtype=np.uint8)
        white, letters, digits = ("".join(re.escape(c) for c, k in zip(latin, kinds, strict=True) if k == n) for n in range(3))
        own = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{white}{letters}{digits}]").replace(r"[\p{L}]", f"[{letters}]")
        own = own.replace(r"[\p{N}]", f"[{digits}]").replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{digits}]")
        own = own.replace(r"\S", f"[^{white}]").replace(r"\s", f"[{white}]")
        # Words of letters first: no other kind begins with one.
        kinds = own.split("|")
        plain = [k for k in kinds if k == f"[{letters}]+"]
        self.find = re.compile("|".join([*plain, *(k for k in kinds if k not in plain)])).findall
        self.lower = any(p["type"] == "Lowercase" for p in _flat(spec.get("normalizer"), "normalizers"))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        # Bytes that print stand for themselves, the others for the next free characters.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        self.shown = {b: 256 + i for i, b in enumerate(hidden)}
        # Line ends part words that are mapped together.
        self.shown_all = np.array([10 if b == 10 else self.shown.get(b, b) for b in range(256)], "<u2")
        #: Whether no word holds white space, so that ``distinct`` may split.
        self.dense = pattern == DROPS_SPACE
        tests = [
            x
            for c in latin
            for x in (f" a{c}", f" {c}b{c}{c}1", f" 1{c}!{c}", f"{c}", f" x'{c}", f"a{c} ")
            + (f"{c}'re{c}", f"{c}'ll's{c}", f"'v{c}'ve'{c}", f"{c}'d")
        ]
        self.trusted = self._split(tests) == [self._library(tokenizer, x) for x in tests]

    def _split(self, texts: list[str]) -> list[list[str]]:
        """The words of each text as they go to the library's model."""
        if not self.dense:
            return [list(map(self.mapped, self.words(x))) for x in texts]
        words, which, ends = self.distinct(texts)
        mapped = self.mapped_all(words)
        return [[mapped[i] for i in part] for part in np.split(which, ends[:-1])]

    @staticmethod
    def _library(tokenizer, text: str) -> list[str]:
        text = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
        return [word for word, _ in tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def words(self, text: str) -> list[str]:
        return self.find(text.lower() if self.lower else text)

    def mapped(self, word: str) -> str:
        """Bytes as the characters that stand for them in the vocabulary."""
        return word.encode().decode("latin-1").translate(self.shown)

    def distinct(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Each word of the texts once, in Latin-1; the word at each place; where the words of each text end.

        Does what the pattern does, for all texts at once: a word is a digit, or
        a run of letters or of other characters, or one of the short forms where
        no run of other characters reaches its apostrophe.
        """
        whole = "\n".join(texts)
        data = np.frombuffer((whole.lower() if self.lower else whole).encode("latin-1"), dtype=np.uint8)
        kind = self.kinds[data]
        begins = np.ones(len(data), dtype=bool)
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins |= kind == 2
        at = np.flatnonzero(data == ord("'"))
        at = at[(at == 0) | (kind[at - 1] != 3)]
        one, two = (np.where(at + k < len(data), data[np.minimum(at + k, len(data) - 1)], 0) for k in (1, 2))
        size = np.where(np.isin(one, list(b"stmd")), 2, 0)
        for a, b in (b"re", b"ve", b"ll"):
            size[(one == a) & (two == b)] = 3
        at, size = at[size > 0], size[size > 0]
        begins[at + 1] = False
        after = at + size
        begins[after[after < len(data)]] = True

        solid = kind != 0
        offsets = np.append(np.flatnonzero(begins[solid]), np.count_nonzero(solid))
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])]
        words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).dictionary_encode()
        reach = np.cumsum([len(x) + 1 for x in texts])
        ends = np.searchsorted(np.flatnonzero(begins & solid), reach)
        return words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy(), ends

    def mapped_all(self, words: list[bytes]) -> list[str]:
        """What ``mapped`` gives, for many words in Latin-1 without line ends."""
        if not words:
            return []
        data = np.frombuffer(b"\n".join(words).decode("latin-1").encode(), dtype=np.uint8)
        return self.shown_all[data].tobytes().decode("utf-16-le").split("\n")

    def takes(self, text: str) -> bool:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return False
        return self.trusted and not any(x in text for x in self.special)


class Recent:
    """Values by key; forgets those not asked for since it was last full."""

    def __init__(self, limit: int):
        self.limit = limit
        self.now: dict = {}
        self.before: dict = {}

    def missing(self, keys: set) -> set:
        """The keys that are not known; those known from before are kept on. Call it before each look-up."""
        self._forget()
        new = keys.difference(self.now)
        if self.before and new:
            before = self.before
            again = {k: before[k] for k in new if k in before}
            self.now.update(again)
            new.difference_update(again)
        return new

    def found(self, keys: list) -> tuple[list, list[int]]:
        """The value of each of these different keys, None if it is not known, and the places of those."""
        self._forget()
        values = list(map(self.now.get, keys))
        places = [i for i, v in enumerate(values) if v is None]
        if self.before:
            for i in places:
                values[i] = self.before.get(keys[i])
                if values[i] is not None:
                    self.now[keys[i]] = values[i]
            places = [i for i in places if values[i] is None]
        return values, places

    def _forget(self) -> None:
        if len(self.now) > self.limit:
            self.now, self.before = {}, self.now


class PieceEncoder:
    """``value(ids)`` of whole texts; ``add`` joins the values of their parts.

    A Latin text is split into words by the tokenizer's own pattern, and only
    words not met before go to the library's model. Any other text is cut into
    pieces, and new pieces go to the library. ``known`` holds pieces without
    their leading space. A piece enters it only if it neither begins nor ends
    with white space, so each of its occurrences between two single spaces is a
    piece in the sense above. Texts with other runs of white space are cut by
    the pattern, and keep their pieces in ``odd``.
    """

    def __init__(self, spec: str, value: Callable, add: Callable, limit: int = KNOWN_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        rules = json.loads(spec)
        pattern = split_pattern(rules)
        if pattern is None:
            raise ValueError("the rules of this tokenizer do not prove that texts can be cut at spaces")
        self.tokenizer = Tokenizer.from_str(spec)
        self.latin = LatinWords(self.tokenizer, rules, pattern)
        self.model = Tokenizer.from_str(
            json.dumps(rules | {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "added_tokens": []})
        )
        self.value, self.add = value, add
        self.words, self.known, self.odd = Recent(limit), Recent(limit // 4), Recent(limit // 20)

    def _encode(self, tokenizer, pieces: list[str]) -> list:
        return [self.value(x.ids) for x in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def exact(self, piece: str):
        """The value of one piece, its leading space included."""
        if self.odd.missing({piece}):
            found = self._encode(self.tokenizer, [piece])[0]
            if len(piece) > LONGEST_KNOWN:
                return found
            self.odd.now[piece] = found
        return self.odd.now[piece]

    def values(self, texts: Iterable[str]) -> Iterator:
        """The value of each text, some texts at a time."""
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= RUN:
                yield from self._values(held)
                held, size = [], 0
        yield from self._values(held)

    def _values(self, texts: list[str]) -> list:
        latin = [self.latin.takes(t) for t in texts]
        split = self._by_distinct if self.latin.dense else self._by_words
        by_words = iter(split([t for t, yes in zip(texts, latin, strict=True) if yes]))
        by_pieces = iter(self._by_pieces([t for t, yes in zip(texts, latin, strict=True) if not yes]))
        return [next(by_words if yes else by_pieces) for yes in latin]

    def _by_words(self, texts: list[str]) -> list:
        split = [self.latin.words(t) for t in texts]
        new = list(self.words.missing(set().union(*split)))
        known = self.words.now
        known.update(zip(new, self._encode(self.model, list(map(self.latin.mapped, new))), strict=True))
        found = [self.add([known[w] for w in words]) for words in split]
        for w in new:
            if len(w) > LONGEST_KNOWN:
                del known[w]
        return found

    def _by_distinct(self, texts: list[str]) -> list:
        """What ``_by_words`` gives, with one look-up for all places of a word in these texts."""
        if not texts:
            return []
        words, which, ends = self.latin.distinct(texts)
        values, places = self.words.found(words)
        new = [words[i] for i in places]
        for i, word, value in zip(places, new, self._encode(self.model, self.latin.mapped_all(new)), strict=True):
            values[i] = value
            if len(word) <= LONGEST_KNOWN:
                self.words.now[word] = value
        each = np.fromiter(values, dtype=object, count=len(values))[which].tolist()
        return [self.add(each[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _by_pieces(self, texts: list[str]) -> list:
        split = [t.split(" ") for t in texts]
        new = [
            p
            for p in self.known.missing(set().union(*split))
            if 0 < len(p) <= LONGEST_KNOWN and not (p[0].isspace() or p[-1].isspace())
        ]
        known = self.known.now
        known.update(zip(new, self._encode(self.tokenizer, [f" {p}" for p in new]), strict=True))
        found = []
        for text, parts in zip(texts, split, strict=True):
            head = parts[0]
            if (len(parts) == 1 or (head and not head[-1].isspace())) and all(p in known for p in parts[1:]):
                values = [self.exact(head), *(known[p] for p in parts[1:])]
            else:
                cut = CUT.split(text)
                values = [self.exact(p) for p in [cut[0], *(f" {p}" for p in cut[1:])]]
            found.append(self.add(values))
        return found


@lru_cache(maxsize=2)
def counter(spec: str) -> PieceEncoder:
    """This worker's encoder that counts tokens."""
    return PieceEncoder(spec, len, sum)


@lru_cache(maxsize=2)
def id_writer(spec: str, kind: str, known: int = KNOWN_PIECES) -> PieceEncoder:
    """This worker's encoder that gives ids as little-endian bytes, ``<u2`` or ``<u4``."""
    code = {"<u2": "H", "<u4": "I"}[kind]

    def packed(ids: list[int]) -> bytes:
        made = array(code, ids)
        if sys.byteorder == "big":
            made.byteswap()
        return made.tobytes()

    return PieceEncoder(spec, packed, b"".join, known)


def read_spec(path: str) -> str:
    """The tokenizer's file, read on the driver and sent with the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()
