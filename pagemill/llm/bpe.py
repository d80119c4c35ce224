"""Byte-level BPE encoding and decoding.

A piece (one match of the split pattern) is encoded without replaying merges. An Aho-Corasick
automaton over the vocabulary, with bytes mapped to Latin-1 characters, gives the longest token that
starts at each byte. A token may follow another if the merges applied to just these two give these two
back; this is memoised per pair. A sequence of tokens whose neighbours all fit is the one that the
merges give, so the encoder takes the longest token that fits, shortens it where it does not, and steps
back where nothing fits, marking that byte as a dead end. Each byte is marked once at most.
"""

import base64
import re
import struct
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A cut at a single space between two characters that are no white space never divides a match: every
#: alternative that takes the space takes it as its first character.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Bytes of encoded chunks, and of encoded pieces, that a task keeps, and the length beyond which they aren't kept. An entry
#: takes ENTRY_BYTES beside its text and ids.
CACHE_BYTES, MEMO_LENGTH, ENTRY_BYTES = 96 << 20, 64, 200
#: Pairs of tokens whose compatibility is kept.
CACHE_PAIRS = 1_000_000
#: Stands before the first token of a piece.
_START = 2**31
#: Rows put into one output batch.
BATCH_ROWS = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Codec:
    """Encodes and decodes by a table of ranks. Any text encodes: the table must hold all 256 bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cut_spaces: bool = True):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for t, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.cut_spaces = cut_spaces
        self.shorter: dict[int, int | None] = {}
        self.fits: dict[int, bool] = {}
        self.chunks = {}
        self.forget()
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()

    def forget(self, kept: bool = False) -> None:
        """Empties the memos, but for the newer chunks if they are to be kept: half of CACHE_BYTES at most.

        Two generations each: what is used stays, and neither grows without bound.
        """
        self.old_chunks, self.chunks, self.old_pieces, self.pieces = self.chunks if kept else {}, {}, {}, {}
        self.chunk_bytes = self.piece_bytes = 0
        if not kept or len(self.fits) > CACHE_PAIRS // 4:
            self.fits.clear()

    def merged(self, piece: bytes) -> list[int]:
        """By definition: merge the neighbours of lowest rank until none are left. Only for short pieces."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, len(self.ranks) + 1), i)
                           for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank > len(self.ranks):
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """True if the merges keep left and right (or right alone, at the start) as they are."""
        if left == _START:
            fit = self.merged(self.token[right]) == [right]
        else:
            fit = self.merged(self.token[left] + self.token[right]) == [left, right]
        if len(self.fits) >= CACHE_PAIRS:
            self.fits.clear()
        self.fits[left << 32 | right] = fit
        return fit

    def prefix(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if token not in self.shorter:
            text = self.token[token]
            ends = (self.ranks.get(text[:k]) for k in range(len(text) - 1, 0, -1))
            self.shorter[token] = next((t for t in ends if t is not None), None)
        return self.shorter[token]

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest, size = [0] * len(piece), self.size
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - size[token]] = token  # ends ascend, so the longest stays
        fits, last, out, at, dead = self.fits, _START, [], 0, bytearray(len(piece) + 1)
        token = longest[0]
        while True:
            end = at + size[token]
            fit = False
            if not dead[end]:
                fit = fits.get(last << 32 | token)
                if fit is None:
                    fit = self.compatible(last, token)
            if fit:
                out.append(token)
                if end == len(piece):
                    return out
                last, at, token = token, end, longest[end]
            else:
                shorter = self.shorter[token] if token in self.shorter else self.prefix(token)
                if shorter is None:
                    dead[at] = 1
                    token = out.pop()
                    at -= size[token]
                    last = out[-1] if out else _START
                else:
                    token = shorter

    def _piece(self, text: str) -> bytes:
        packed = self.old_pieces.get(text)
        if packed is None:
            ids = self.piece(text.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(text) <= MEMO_LENGTH:
            self.piece_bytes += ENTRY_BYTES + len(text) + len(packed)
            if 2 * self.piece_bytes >= CACHE_BYTES:
                self.old_pieces, self.pieces, self.piece_bytes = self.pieces, {}, 0
            self.pieces[text] = packed
        return packed

    def _chunk(self, chunk: str) -> bytes:
        known, new = self.pieces.get, self._piece
        return b"".join([known(p) or new(p) for p in self.pattern.findall(chunk)])

    def _after_space(self, chunk: str) -> bytes:
        packed = self.old_chunks.get(chunk)
        if packed is None:
            found = self.pattern.findall(" " + chunk)
            if len(found) == 1:  # kept as a chunk, so not as a piece too
                ids = self.piece(found[0].encode())
                packed = struct.pack(f"<{len(ids)}I", *ids)
            else:
                packed = b"".join([self.pieces.get(p) or self._piece(p) for p in found])
        if len(chunk) <= MEMO_LENGTH:
            self.chunk_bytes += ENTRY_BYTES + len(chunk) + len(packed)
            if 2 * self.chunk_bytes >= CACHE_BYTES:
                self.old_chunks, self.chunks, self.chunk_bytes = self.chunks, {}, 0
            self.chunks[chunk] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.cut_spaces:  # the pattern may divide text otherwise
            return self._chunk(text)
        first, *rest = _CUT.split(text)
        known, new = self.chunks.get, self._after_space
        return self._chunk(first) + b"".join([known(c) or new(c) for c in rest])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))


_CODECS: dict[tuple, Codec] = {}


def codec(path: str, pattern: str, cut_spaces: bool = True) -> Codec:
    """One codec per worker process; its tables outlive a task, and of its memos what forget keeps."""
    key = (path, pattern, cut_spaces)
    if key not in _CODECS:
        _CODECS[key] = Codec(read_ranks(path), pattern, cut_spaces)
    return _CODECS[key]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text",
                  cut_spaces: bool = True) -> DataFrame:
    """docs with `ids` (binary: little-endian unsigned 32-bit), `n_tokens` and `decoded` (binary).

    Whole texts; a null or empty text has no ids and empty bytes. Columns of docs that bear one of the
    three names are replaced, all others pass through; rows are neither merged nor reordered, so
    repeated rows stay repeated. An empty table gives an empty table. `ranks_path` must be readable on
    each executor (the vocabulary is installed there, as any Python dependency is). `cut_spaces` states
    that the pattern never matches across a single space between two non-blank characters except by
    starting with it; set it to False for other patterns.
    """
    docs = docs.drop("ids", "n_tokens", "decoded")
    place = docs.columns.index(text)
    schema = T.StructType(docs.schema.fields + [
        T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern, cut_spaces)
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, BATCH_ROWS):
                    part = batch.slice(start, BATCH_ROWS)
                    ids = [own.encode(t) if t else b"" for t in part.column(place).to_pylist()]
                    new = [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64()),
                           pa.array([own.decode(i) for i in ids], pa.binary())]
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, *new], names=[*part.schema.names, "ids", "n_tokens", "decoded"])
        finally:
            own.forget(kept=True)  # the worker goes on to other tasks, of other operators too

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    coded = encode_decode(docs.select("doc_id", "text"), ranks_path, pattern)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
