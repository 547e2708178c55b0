"""Byte-level BPE: linear-time encoding by backtracking, decoding by an offset table.

An Aho-Corasick automaton over the vocabulary gives the longest token at every
place of a word.  Tokens are taken greedily, longest first; a pair table says
whether two neighbouring tokens would both survive the merges, and if no token
fits after the last one, that one is replaced by its next shorter prefix.  The
result is exactly that of applying the merges in rank order.
"""
from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import text as tx
from .common import lean

# Fixed value: the public pre-tokenisation pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# Letters, digits and spaces up to U+00FF. Texts without later characters take the
# standard library's engine, which is faster but knows no Unicode classes.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\\t-\\r \x85\xa0"
LATIN_PATTERN = rf"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"


def byte_names() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class WordCache(dict):
    """Encoded words; when a generation is full the one before is dropped."""

    def __init__(self, encode, room: int):
        super().__init__()
        self.encode, self.room, self.older = encode, room, {}

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            out = self.encode(word)
        if len(word) <= 64:
            if len(self) >= self.room:
                self.older = dict(self)
                self.clear()
            self[word] = out
        return out


class Bpe:
    """A vocabulary file of byte-level BPE (vocab, merges in rank order, special tokens)."""

    def __init__(self, spec: bytes, cache_words: int = 100_000):
        spec = json.loads(spec)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        names = byte_names()
        byte_of = {c: b for b, c in enumerate(names)}
        self.number = {chr(b): b for b in range(256)}        # token text, a character a byte -> place in merge order
        self.parts: list[tuple[int, int]] = [(b, b) for b in range(256)]
        self.merged: dict[tuple[int, int], int] = {}
        ids = [vocab[c] for c in names]
        for m in merges:
            a, b = m if isinstance(m, list) else m.split(" ")
            left, right = ("".join(chr(byte_of[c]) for c in x) for x in (a, b))
            pair = (self.number[left], self.number[right])
            if left + right not in self.number:
                self.number[left + right] = len(self.parts)
                self.parts.append(pair)
                ids.append(vocab[a + b])
            self.merged.setdefault(pair, self.number[left + right])
        self.packed = [int(i).to_bytes(4, "little") for i in ids]
        self.sizes = [0] * len(self.parts)
        self.shorter = [-1] * len(self.parts)
        self.automaton = ahocorasick.Automaton()
        for token, k in self.number.items():
            self.sizes[k] = len(token)
            self.automaton.add_word(token, k)
            for n in range(len(token) - 1, 0, -1):
                if (p := self.number.get(token[:n])) is not None:
                    self.shorter[k] = p
                    break
        self.automaton.make_automaton()
        self.special = {t["content"]: int(t["id"]) for t in spec.get("added_tokens", [])}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.all_words, self.latin_words = regex.compile(PATTERN), re.compile(LATIN_PATTERN)
        self.fits: dict[int, bool] = {}
        self.cache = WordCache(self.encode_word, cache_words)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave the border between two neighbouring tokens alone.

        Undo both tokens from the last merge backwards: at no time may the two pieces at
        the border have a merge that comes before the one by which either piece grew."""
        key, bound = left << 32 | right, len(self.parts)
        while True:
            pair = self.merged.get((left, right))
            if pair is not None and pair < bound:
                known = False
                break
            if left < 256 and right < 256:
                known = True
                break
            if left > right:            # the left piece was made last: it was still in two parts before
                bound, left = left, self.parts[left][1]
            else:                       # equal merges are made from left to right
                bound, right = right + 1, self.parts[right][0]
        if len(self.fits) > 400_000:
            self.fits.clear()
        self.fits[key] = known
        return known

    def tokens(self, word: str) -> list[int]:
        """Merge-order numbers of the tokens of a word given a character a byte."""
        n = len(word)
        longest = [0] * n
        size, sizes = [0] * n, self.sizes
        for end, k in self.automaton.iter(word):
            start = end - sizes[k] + 1
            if sizes[k] > size[start]:
                size[start], longest[start] = sizes[k], k
        shorter, known = self.shorter, self.fits.get
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token, last = 0, longest[0] if n else 0, -1
        while at < n:
            end = at + sizes[token]
            if dead[end]:
                fits = False
            elif last < 0:
                fits = True
            else:
                fits = known(last << 32 | token)
                if fits is None:
                    fits = self.compatible(last, token)
            if fits:
                out.append(token)
                at, last = end, token
                if at < n:
                    token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead[at] = 1
                token = out.pop()
                last = out[-1] if out else -1
                at -= sizes[token]
        return out

    def encode_word(self, word: str) -> bytes:
        packed = self.packed
        return b"".join([packed[k] for k in self.tokens(word.encode().decode("latin-1"))])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special tokens in the text are themselves."""
        if self.split is None or not any(s in text for s in self.special):
            return b"".join(map(self.cache.__getitem__, self.words(text)))
        parts = self.split.split(text)
        return b"".join(self.special[p].to_bytes(4, "little") if k % 2 else b"".join(map(self.cache.__getitem__, self.words(p))) for k, p in enumerate(parts))

    def words(self, text: str) -> list[str]:
        """The text cut into the words that are encoded on their own."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.all_words.findall(text)
        return self.latin_words.findall(text)


class OffsetTable:
    """The bytes of all tokens in one buffer, and where each begins."""

    def __init__(self, spec: bytes):
        spec = json.loads(spec)
        vocab = spec["model"]["vocab"]
        special = {t["content"]: int(t["id"]) for t in spec.get("added_tokens", [])}
        byte_of = {c: b for b, c in enumerate(byte_names())}
        pieces = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in vocab.items():
            if token not in special:
                pieces[i] = bytes(byte_of[c] for c in token)
        for token, i in special.items():
            pieces[i] = token.encode()
        self.blob = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, gathered by offset."""
        start, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        at = np.cumsum(size)
        return self.blob[np.arange(at[-1] if len(at) else 0) + np.repeat(start - at + size, size)].tobytes()

    def text(self, ids: bytes) -> str:
        """Text of ids given as little-endian unsigned 32-bit integers; invalid UTF-8 is replaced."""
        return self.decode(np.frombuffer(ids, dtype="<u4").astype(np.int64)).decode("utf-8", "replace")


def _loaded(kind, spec: bytes):
    """One per Python worker and kind, for the file used last; what it caches is bounded."""
    cache, digest = tx.process_cache(), hashlib.sha256(spec).hexdigest()
    if cache.get(kind.__name__, ("",))[0] != digest:
        cache[kind.__name__] = (digest, kind(spec))
    return cache[kind.__name__][1]


def _encode(batches: Iterable[pa.RecordBatch], spec: bytes, text_col: str, carry: list[str], shard_bytes: int, decoded: bool) -> Iterator[pa.RecordBatch]:
    bpe, table = _loaded(Bpe, spec), _loaded(OffsetTable, spec) if decoded else None
    for batch in batches:
        column = batch.column(text_col)
        _, offsets = tx.utf8(column)
        for i, j in tx.groups(offsets, shard_bytes):
            ids = [bpe.encode(t or "") for t in column.slice(i, j - i).to_pylist()]
            columns = [*[batch.column(c).slice(i, j - i) for c in carry], pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array([table.text(x) for x in ids], pa.string())] if table else []), [*carry, "ids", "n_tokens"] + (["decoded"] if table else []))


def _decode(batches: Iterable[pa.RecordBatch], spec: bytes) -> Iterator[pa.RecordBatch]:
    tokens = _loaded(OffsetTable, spec)
    for batch in batches:
        texts = [tokens.text(x or b"") for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])


def encode(docs: DataFrame, vocabulary: str, *, text_col: str = "text", carry: list[str] | None = None, decoded: bool = False, shard_bytes: int = 4 << 20) -> DataFrame:
    """The ``carry`` columns of ``docs`` (all but the text unless given) with ids and n_tokens.

    vocabulary: path of a byte-level BPE file; the driver reads it (a few MB, fixed with
    the tokenizer) and broadcasts it.  ids: little-endian unsigned 32-bit integers.
    ``decoded`` adds the text that they decode to, in the same pass.  A null or empty text
    has no ids; repeated rows stay.  Carried columns must not be named like an added one
    (by default such columns are left out).  No shuffle; a task holds a batch of texts
    and caches of bounded size.
    """
    carry = [c for c in docs.columns if c not in (text_col, "ids", "n_tokens", "decoded")] if carry is None else carry
    with open(vocabulary, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    added = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())] + [T.StructField("decoded", T.StringType())] * decoded
    return docs.select(*dict.fromkeys([*carry, text_col])).mapInArrow(
        lambda it: lean(_encode(it, spec.value, text_col, carry, shard_bytes, decoded)), T.StructType([docs.schema[c] for c in carry] + added))


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` with decoded, the text of its ids (special tokens included; invalid UTF-8 is replaced)."""
    with open(vocabulary, "rb") as f:
        spec = encoded.sparkSession.sparkContext.broadcast(f.read())
    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(lambda it: lean(_decode(it, spec.value)), T.StructType(encoded.schema.fields + [T.StructField("decoded", T.StringType())]))
