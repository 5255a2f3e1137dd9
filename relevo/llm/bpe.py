"""Byte-level BPE encoding and decoding of whole texts (operator 5).

Method: the pieces of the split pattern are merged on a segment tree over
byte positions.  Leaf ``i`` holds the rank of the pair that starts at ``i``
(with the position below it, so equal ranks order from the left) and the root
holds the leftmost minimum.  A merge changes three leaves (the pair itself,
its live left neighbour, the one that vanished), each in O(log n).  Pieces of
like length share one array of trees and merge side by side in numpy; a very
long piece is a tree of its own, so its cost is O(n log n) too.

Defined results: a null or empty text has no tokens and decodes to no bytes;
rows are independent, so repeated rows, empty tables and other columns make no
difference.  A row without an id is encoded like any other.  Encoded pieces
are remembered in a dictionary of bounded size (``memo``), which is only a
speed-up.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Batches

NONE = np.int64(1) << 62  # no such pair
_POS = 32                 # a leaf is rank << 32 | position


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """The ranks of a vocabulary file: one base64 token and its rank a line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


class Encoder:
    """Ranks as arrays: a pair of token ids is looked up as one sorted key."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = 150_000):
        self.split = regex.compile(pattern).findall
        self.ranks, self.memo = ranks, memo
        self.known: dict[str, str] = {}
        self.text_of = {str(r): t for t, r in ranks.items()}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for t, r in ranks.items():
            for k in range(1, len(t)):
                a, b = ranks.get(t[:k]), ranks.get(t[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], -1)

    def _merge(self, pieces: list[bytes], size: int) -> list[list[int]]:
        """Merge pieces of 2 to ``size`` bytes (a power of two), one tree each."""
        n = len(pieces)
        length = np.array([len(p) for p in pieces])
        raw = np.zeros((n, size), np.uint8)
        raw[np.arange(size) < length[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        token = self.byte[raw]
        pos = np.arange(size)
        after = np.broadcast_to(pos + 1, (n, size)).copy()   # next live position
        before = np.broadcast_to(pos - 1, (n, size)).copy()  # last live position
        tree = np.full((n, 2 * size), NONE, np.int64)
        has = pos[:-1] < (length - 1)[:, None]
        r, c = np.nonzero(has)
        rank = self._rank(token[r, c], token[r, c + 1])
        good = rank >= 0
        tree[r[good], size + c[good]] = rank[good] << _POS | c[good]
        level = size
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2],
                                                   tree[:, level + 1:2 * level:2])
            level //= 2

        def put(rows, at, value):
            at = at + size
            tree[rows, at] = value
            while at[0] > 1:  # all rows stand on the same level
                at >>= 1
                tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

        def pair(rows, left):
            """Set the leaf of the pair that starts at ``left``."""
            right = after[rows, left]
            ok = right < length[rows]
            rank = self._rank(token[rows, left], token[rows, np.where(ok, right, 0)])
            put(rows, left, np.where(ok & (rank >= 0), rank << _POS | left, NONE))

        live = np.flatnonzero(tree[:, 1] < NONE)
        while len(live):
            top = tree[live, 1]
            i = top & ((1 << _POS) - 1)
            j = after[live, i]
            token[live, i] = top >> _POS
            k = after[live, j]
            after[live, i] = k
            token[live, j] = -1
            inside = k < length[live]
            before[live[inside], k[inside]] = i[inside]
            put(live, j, np.full(len(live), NONE))
            pair(live, i)
            left = before[live, i]
            some = left >= 0
            if some.any():
                pair(live[some], left[some])
            live = live[tree[live, 1] < NONE]
        keep = (token >= 0) & (pos < length[:, None])
        flat = token[keep].tolist()
        ends = np.cumsum(keep.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def merge_all(self, pieces: Iterable[str]) -> dict[str, str]:
        """Ids, as decimals joined by one space, of distinct pieces."""
        out, groups = {}, {}
        for p in pieces:
            raw = p.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                out[p] = str(whole)
            else:
                size = 1 << (len(raw) - 1).bit_length()
                groups.setdefault(size, []).append((p, raw))
        for size, items in groups.items():
            step = max(1, (1 << 17) // size)
            for at in range(0, len(items), step):
                part = items[at:at + step]
                for (p, _), ids in zip(part, self._merge([raw for _, raw in part], size)):
                    out[p] = " ".join(map(str, ids))
        return out

    def encode(self, texts: list[str]) -> list[str]:
        """The ids of each text, as decimals joined by one space."""
        pieces = [self.split(t) for t in texts]
        here, known = set().union(*pieces), self.known
        new = here.difference(known)
        if len(known) + len(new) > self.memo:
            known.clear()
            new = here
        known.update(self.merge_all(new))
        return [" ".join(map(known.__getitem__, p)) for p in pieces]

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.text_of.__getitem__, ids.split()))


_encoders: dict[tuple, Encoder] = {}


def _encoder(shared, pattern: str) -> Encoder:
    """One encoder a worker process, kept over its tasks."""
    key = (hash(shared.value), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(read_ranks(shared.value), pattern)
    return _encoders[key]


def _text_blocks(col: pa.Array, size: int = 1 << 20):
    """Whole texts, about ``size`` bytes at a time (null: empty)."""
    part, held = [], 0
    for t in col:
        t = t.as_py() or ""
        part.append(t)
        held += len(t)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def encode_documents(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", ids: bool = False) -> DataFrame:
    """Encode every whole text and decode the ids again: ``id_col``,
    ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; with ``ids`` also the
    ids themselves as packed little-endian numbers (``ids binary``: 16 bits
    each where the vocabulary allows it, otherwise 32).  A batch is handed back
    for each block of texts, so a task holds little at a time.

    ``ranks_file`` is read on the driver and broadcast: its size is the
    vocabulary's, whatever the corpus holds.
    """
    with open(ranks_file, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Batches) -> Batches:
        enc = _encoder(shared, pattern)
        packed = np.dtype("<u2" if max(enc.ranks.values()) < 1 << 16 else "<u4")
        for b in batches:
            at = 0
            for part in _text_blocks(b.column(1)):
                n, sha, back, raw_ids = [], [], [], []
                for s in enc.encode(part):
                    n.append(s.count(" ") + 1 if s else 0)
                    sha.append(hashlib.sha256(s.encode()).hexdigest())
                    back.append(hashlib.sha256(enc.decode(s)).hexdigest())
                    if ids:
                        raw_ids.append(np.array(s.split(), np.int64).astype(packed).tobytes())
                cols = [b.column(0).slice(at, len(part)), pa.array(n, pa.int64()), pa.array(sha, pa.string()),
                        pa.array(back, pa.string()), *([pa.array(raw_ids, pa.binary())] if ids else [])]
                at += len(part)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_col, text_col).mapInArrow(
        run, schema + (", ids binary" if ids else ""))
