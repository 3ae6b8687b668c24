"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string exactly one token can be the last of the
prefix's BPE encoding.  The encoder stores that token for each prefix; walking
back from the end reads the encoding off.  Appending a byte needs only the
stored prefixes, and after an edit the walk stops as soon as the new last
tokens agree with the old ones for as many bytes as the longest token has.

Whether a token may follow another is decided from the merge that made each
token: the pair is impossible if a merge across its border would have come
before the merges that made its sides.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.runtime import table, tidy

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: About half the bytes of parts and pieces that a task remembers, and how many pairs of tokens; results do not depend on it.
MEMO_BYTES, MEMO = 40_000_000, 300_000
#: What an entry takes besides its bytes.
_ENTRY = 190
#: Characters whose parts are looked up together.
CHUNK = 2_000_000
#: Stands before a part that no space leads; texts that hold it take the plain way.
_MARK = "\x01"
#: Letters below are the same for Python and for the pattern's engine, and signs of one kind.
_STABLE, _SIGNS = "\u0250", ".,;:!?"
#: Beside the bytes, the key of a node's token.
_TOKEN = -1
#: Bytes before a border by which the tokens that may end there are looked up.
_TAIL = 4
#: White space as the pattern's engine in the tiktoken library has it (Python's own \s differs).
_SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"
#: Packs that many ids.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]
_BORDER = re.compile(f"(?= [^{_SPACE}])")


class PrefixBPE:
    """ranks: token bytes to ids below 2**17, which is what a key of two ids allows for."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.size_of = {r: len(b) for b, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self.split: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self._fits: dict[int, bool] = {}
        # A trie of the reversed tokens: byte -> node, and _TOKEN -> the token that ends there.
        self._suffixes: dict = {}
        self._ends: dict[bytes, tuple] = {}
        for rank in sorted(self.bytes_of):
            word = self.bytes_of[rank]
            if len(word) == 1:
                self.split[rank] = (rank, rank)
            else:
                for cut in range(1, len(word)):
                    a, b = ranks.get(word[:cut]), ranks.get(word[cut:])
                    if a is not None and b is not None and a in self.split and b in self.split and a < rank and b < rank and self._compatible(a, b):
                        self.split[rank] = (a, b)
                        self.merged[a, b] = rank
                        break
                else:
                    continue  # no merges lead to it: it only stands for a whole piece
            node = self._suffixes
            for byte in reversed(word):
                node = node.setdefault(byte, {})
            node[_TOKEN] = rank

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the encoding of both together is just these two tokens."""
        bound = 1 << 40
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and joined < bound:
                return False
            # Undo the later of the two merges next to the border, as it came after the other.
            if left > right:
                bound, inner = left, self.split[left][1]
                if inner != left:
                    left = inner
                    continue
                bound, inner = right + 1, self.split[right][0]
                if inner == right:
                    return True
                right = inner
            else:
                bound, inner = right + 1, self.split[right][0]
                if inner != right:
                    right = inner
                    continue
                bound, inner = left, self.split[left][1]
                if inner == left:
                    return True
                left = inner

    def fits(self, left: int, right: int) -> bool:
        key = left << 17 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= MEMO:
                self._fits.clear()
            known = self._fits[key] = self._compatible(left, right)
        return known

    def extend(self, data: bytes, last: list[int], end: int) -> None:
        """Appends the last tokens of the prefixes of data up to end; last has those of the shorter ones (last[k] for data[:k+1])."""
        fits, ends, tail, add = self._fits.get, self._ends.get, _TAIL, last.append
        for size in range(len(last) + 1, end + 1):
            if size > tail:
                key = data[size - tail : size]
                found, node = ends(key) or self._tokens_at(key)
                if node is not None:
                    found = self._longer(data, size - tail, node, found)
            else:
                key = data[:size]
                found, _ = ends(key) or self._tokens_at(key)
            for length, token in found:  # the longest first
                if length == size:
                    break
                before = last[-length]
                good = fits(before << 17 | token)
                if good or good is None and self.fits(before, token):
                    break
            else:
                raise ValueError("a byte is missing from the vocabulary")
            add(token)

    def _tokens_at(self, key: bytes) -> tuple[tuple[tuple[int, int], ...], dict | None]:
        """(length, token) of the tokens that key ends with, the longest first, and the node of the trie where key leads; remembered."""
        node, found = self._suffixes, []
        for size, byte in enumerate(reversed(key), 1):
            node = node.get(byte)
            if node is None:
                break
            if _TOKEN in node:
                found.append((size, node[_TOKEN]))
        if len(self._ends) >= MEMO:
            self._ends.clear()
        known = self._ends[key] = tuple(reversed(found)), node
        return known

    def _longer(self, data: bytes, i: int, node: dict, found: tuple) -> tuple:
        """found with the tokens before it that begin before data[i], where node is reached."""
        more, size = [], _TAIL
        while i:
            i -= 1
            size += 1
            node = node.get(data[i])
            if node is None:
                break
            if _TOKEN in node:
                more.append((size, node[_TOKEN]))
        return (*more[::-1], *found) if more else found

    def prefixes(self, data: bytes) -> list[int]:
        last: list[int] = []
        self.extend(data, last, len(data))
        return last

    def read(self, last: list[int]) -> list[int]:
        out, i, size = [], len(last), self.size_of
        while i:
            token = last[i - 1]
            out.append(token)
            i -= size[token]
        out.reverse()
        return out

    def encode_piece(self, data: bytes) -> list[int]:
        """Tokens of one match of the pattern; a piece that is a token stays whole."""
        if (rank := self.ranks.get(data)) is not None:
            return [rank]
        return self.read(self.prefixes(data))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixEncoding:
    """A byte string with the last token of each of its prefixes; appends and edits reuse what stays valid."""

    def __init__(self, bpe: PrefixBPE, data: bytes = b""):
        self.bpe, self.data, self.last, self.steps = bpe, data, bpe.prefixes(data), len(data)

    def append(self, more: bytes) -> PrefixEncoding:
        return self.replace(len(self.data), len(self.data), more)

    def replace(self, start: int, end: int, new: bytes) -> PrefixEncoding:
        """data[start:end] = new; steps counts the prefixes that were computed anew."""
        data, old = self.data[:start] + new + self.data[end:], self.last
        last, shift, agree = old[:start], len(new) - (end - start), 0
        at = start
        while at < len(data):
            self.bpe.extend(data, last, at + 1)
            self.steps += 1
            at += 1
            if at > start + len(new):
                agree = agree + 1 if last[-1] == old[at - 1 - shift] else 0
                if agree >= self.bpe.longest:  # what follows depends on no earlier prefix
                    last += old[at - shift :]
                    break
        self.data, self.last = data, last
        return self

    def tokens(self) -> list[int]:
        return self.bpe.read(self.last)


class TextEncoder:
    """Encodes texts as the library does: pieces by the pattern, each piece alone.

    A space before something that isn't white space always begins a piece, and
    a single line feed between such things is one; texts are cut there.  Parts
    and pieces are remembered up to MEMO_BYTES; the distinct pieces that are
    new are encoded in sorted order, where neighbours share the last tokens of
    their common prefix.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.bpe = PrefixBPE({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
        self.find = regex.compile(pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")).findall
        words = [self.bpe.bytes_of.get(r, b"") for r in range(max(self.bpe.bytes_of) + 1)]
        self.flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        self.size = np.array(list(map(len, words)), dtype=np.int32)
        self.begin = np.cumsum(self.size, dtype=np.int32) - self.size
        self.forget()

    def forget(self) -> None:
        """Drops what was remembered; results stay the same."""
        self.parts: dict[str, bytes | None] = {}
        self.known: dict[str, bytes] = {}
        self.older = self.parts, self.known
        self.held = 0

    def _pieces(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of at least these pieces."""
        out, old, fresh = self.known, self.older[1], []
        for piece in pieces - out.keys():
            if (ids := old.get(piece)) is not None:
                out[piece] = ids
                self.held += _ENTRY
            else:
                fresh.append(piece)
        fresh.sort()  # code points are in the order of their bytes
        ranks, extend, size, last, before, total = self.bpe.ranks.get, self.bpe.extend, self.bpe.size_of, [], b"", 0
        for piece in fresh:
            data = piece.encode()
            n = len(data)
            total += n
            if (rank := ranks(data)) is not None:
                out[piece] = rank.to_bytes(4, "little")
                continue
            k = 0
            for a, b in zip(data, before):  # noqa: B905
                if a != b:
                    break
                k += 1
            del last[k:]
            extend(data, last, n)
            before, ids = data, []
            while n:  # as PrefixBPE.read() does
                token = last[n - 1]
                ids.append(token)
                n -= size[token]
            ids.reverse()
            out[piece] = _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)
        self.held += _ENTRY * len(fresh) + 2 * total
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self.held > MEMO_BYTES:  # what the texts since the last time did not need goes
            self.older, self.parts, self.known, self.held = (self.parts, self.known), {}, {}, 0
        # A part after a line feed, and the first, has no space before it: that is what the mark says.
        cut = [(_MARK + text.replace("\n", f"\n {_MARK}")).split(" ") if _MARK not in text else [""] for text in texts]
        seen, old, found = set().union(*cut), self.older[0], {}
        for part in seen - self.parts.keys():
            if (ids := old.get(part)) is not None:
                self.parts[part] = ids
                self.held += _ENTRY
                continue
            led = part[:1] != _MARK
            body = part if led else part[1:]
            inner = body[:-1] if body[-1:] == "\n" else body
            if not inner or inner[0] in _SPACE or inner[-1] in _SPACE and inner is not body:
                self.parts[part] = None  # a piece may reach over the cut
            else:
                body = " " + body if led else body
                word = body[led:-1]  # letters with a plain sign after them are two pieces
                if body[-1] in _SIGNS and word.isalpha() and max(word) < _STABLE:
                    found[part] = [body[:-1], body[-1]]
                else:
                    found[part] = [body] if word.isalpha() and body[-1].isalpha() and max(body) < _STABLE else self.find(body)
        known = self._pieces(set().union(*found.values()))
        for part, pieces in found.items():
            ids = self.parts[part] = known[pieces[0]] if len(pieces) == 1 else b"".join(map(known.__getitem__, pieces))
            self.held += _ENTRY + len(part) + len(ids)
        out = []
        for text, parts in zip(texts, cut, strict=True):
            ids = list(map(self.parts.__getitem__, parts))
            out.append(self._whole(text) if None in ids else b"".join(ids))
        return out

    def _whole(self, text: str) -> bytes:
        """A text with other white space than single spaces and line feeds."""
        chunks = _BORDER.split(text)
        found = [self.find(c) for c in chunks]
        known = self._pieces(set().union(*found))
        return b"".join(known[p] for pieces in found for p in pieces)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, how many of them there are after each id)."""
        size = self.size[ids]
        end = np.cumsum(size, dtype=np.int64)
        at = np.arange(end[-1] if len(end) else 0, dtype=np.int32)
        at += np.repeat(self.begin[ids] - (end - size).astype(np.int32), size)
        return self.flat[at], end


@cache
def encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(path, pattern)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def encode_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: tuple[str, str] | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with keep_ids, ids (array<int>), a row for each row of df.

    vocabulary: the path of a rank file that every executor has, and a
    pattern.  A null text is an empty one: no ids, digests of nothing.  Rows
    are independent, so repeated rows and null ids give rows of their own and
    an empty table an empty one; a text may be of any length that fits a task;
    extra columns are not read.
    """
    path, pattern = vocabulary or default_vocabulary()
    fields = "doc_id {}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")

    def encoded(enc: TextEncoder, doc_ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        raw = enc.encode(texts)
        n = np.array(list(map(len, raw)), dtype=np.int64) // 4
        ids = np.frombuffer(b"".join(raw), dtype="<u4")
        data, end = enc.decode(ids)
        bounds = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(n)])].tolist()
        data = memoryview(data)
        decoded = [hashlib.sha256(data[a:b]).hexdigest() for a, b in pairwise(bounds)]
        out = [doc_ids, pa.array(n), pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()), pa.array(decoded, pa.string())]
        if keep_ids:
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            out.append(pa.ListArray.from_arrays(offsets, pa.array(ids.view("<i4"))))
        return pa.RecordBatch.from_arrays(out, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(out)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        gc.disable()  # nothing here has cycles, and each collection would walk all that is remembered
        try:
            for batch in batches:
                values, begin = batch.column(1), 0
                while begin < len(values):
                    texts, size, first = [], 0, begin
                    while begin < len(values) and size < CHUNK:
                        texts.append(values[begin].as_py() or "")
                        size, begin = size + len(texts[-1]), begin + 1
                    yield encoded(enc, batch.column(0).slice(first, begin - first), texts)
        finally:
            encoder.cache_clear()  # a worker outlives its task
            gc.enable()

    slim = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(tidy(work), fields.format(slim.schema["doc_id"].dataType.simpleString()))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
