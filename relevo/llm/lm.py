"""Language-model scores from a log-frequency Bloom filter (operator 1).

Method: the counts of all n-grams (one and two words) of the training texts
are quantised by powers of two: a count ``c`` becomes the level
``1 + floor(log2 c)`` and the filter holds the n-gram with every level up to
it.  A count is read back by probing level after level until one is missing,
and stands for the middle of its last level.  The score is an interpolated bigram model: ``l * c(h, w) / c(h) + (1 - l) * p(w)``
with ``p(w)`` from the filter's word counts, and one weight ``l`` for each
level of ``c(h)``, chosen by leaving one out over all training tokens.

Counting and probing: a task takes its texts in chunks and sends, for each hash
range, the chunk's n-grams with their training counts as one packed array.  A
range's task adds them up, sets the bits of its own segment of the filter,
probes it for every chunk's n-grams and sends the levels back to the chunk,
words with their exact counts for the base score.  So the filter is never in
one place: a segment grows with its n-grams (``bits`` is the least size of all
segments together), all n-grams are kept, and the rate of false hits stays
under ``2**-PROBES`` whatever the corpus holds.

A token is three levels: of its history, of its word and of both.  A text is
reduced to its different triples and their numbers, from which both the weights
(training texts) and the score (any text) are read.

Tokens are words with ``A-Z`` lower-cased, then one end for each text; a word
is known by a 64-bit hash.  Defined results: a null text counts as empty (only
its end is a token); every row is scored by itself, whatever its id; a row
without an id is neither held out nor learned from; without training texts all
counts are 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from .common import Batches, collect_table, shuffle_partitions, stage, summed_tables
from .words import U, Words, blocks, mix, utf8

PROBES, LEVELS, HELD = 5, 40, 1 << 22
END, START = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)
_PAIR = U(0xD1342543DE82EF95)
_GRID = np.array([0, .02, .05, .1, .2, .3, .4, .5, .6, .7, .8, .9, .95, .98])


def tokens(w) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a block's texts, each text's ending with ``END``, and
    their offsets."""
    ptr = w.ptr + np.arange(w.n + 1)
    h = np.empty(ptr[-1], U)
    ends = ptr[1:] - 1
    word = np.ones(len(h), bool)
    word[ends] = False
    h[word], h[ends] = w.hashes(), END
    return h, ptr


def histories(h: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """The token before each token."""
    before = np.r_[START, h[:-1]]
    before[ptr[:-1]] = START
    return before


def unigram(h: np.ndarray) -> np.ndarray:
    return mix(h ^ _PAIR) & ~U(1)


def bigram(before: np.ndarray, h: np.ndarray) -> np.ndarray:
    """48 bits of hash, far rarer to clash than the filter's false hits."""
    return mix(before * _PAIR + h + U(1)) & ~U(0xFFFF)


def _segment(g: np.ndarray, segment_bits: int) -> np.ndarray:
    return (g >> U(64 - segment_bits)).astype(np.int64)


def level(count: np.ndarray) -> np.ndarray:
    """``1 + floor(log2 count)``; 0 for 0."""
    return np.frexp(np.asarray(count, np.float64))[1]


def middle(lev: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the middle of its range."""
    return np.where(lev > 0, (3.0 * 2.0 ** (lev - 1) - 1) / 2, 0.0)


def _positions(g: np.ndarray, lev: int, size: int) -> list[np.ndarray]:
    """The bits, within its segment, of an n-gram at a level."""
    x = mix(g + U(lev * 0x9E3779B97F4A7C15 % (1 << 64)))
    step = (x >> U(32)) | U(1)
    return [((x + U(i) * step) % U(size)).astype(np.int64) for i in range(PROBES)]


def room_for(levels: int) -> int:
    """Bits of a segment that ``levels`` fill to a half at most."""
    return -(-int(np.ceil(levels * PROBES / np.log(2)) + 64) // 8) * 8


def probe(bits: np.ndarray, size: int, g: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Levels of distinct n-grams, whose segments begin at ``base``: probe one
    after another until it is missing."""
    out = np.zeros(len(g), np.int64)
    alive = np.arange(len(g))
    for j in range(1, LEVELS):
        hit = np.ones(len(alive), bool)
        for p in _positions(g[alive], j, size):
            at = base[alive] + p
            hit &= ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
        alive = alive[hit]
        if not len(alive):
            break
        out[alive] = j
    return out


def build_segment(g: np.ndarray, c: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """One segment's bits (packed) from its n-grams, and the least count kept."""
    lev = level(c)
    room = int(size * np.log(2) / PROBES)
    cutoff = 1
    while True:
        kept = c >= cutoff
        if int(lev[kept].sum()) <= room:
            break
        cutoff += max(1, cutoff // 4)
    g, lev = g[kept], lev[kept]
    bits = np.zeros(size, bool)
    for j in range(1, int(lev.max(initial=0)) + 1):
        for p in _positions(g[lev >= j], j, size):
            bits[p] = True
    return np.packbits(bits, bitorder="little"), cutoff


@dataclass
class BloomModel:
    bits: np.ndarray | None  # packed, all segments; None: they stay with their ranges
    size: int                # bits of a segment
    segment_bits: int        # a segment is named by so many first bits of a hash
    tokens: int              # training tokens
    types: int               # different ones
    weights: np.ndarray      # by level of the history's count

    def levels(self, g: np.ndarray) -> np.ndarray:
        """Levels of distinct n-grams."""
        return probe(self.bits, self.size, g, _segment(g, self.segment_bits) * self.size)

    def parts(self, leave_out: bool = False):
        """Of each triple: its word probability, the share that its history
        gives it, and the level of the history's count.  ``leave_out`` takes
        the token itself out of the counts."""
        lev, known, pair = np.indices((LEVELS,) * 3).reshape(3, -1)
        seen, word, pair = middle(lev), middle(known), middle(pair)
        less = 1.0 if leave_out else 0.0
        p = (np.maximum(word - less, 0) + 0.5) / (self.tokens - less + 0.5 * (self.types + 1))
        share = np.maximum(pair - less, 0) / np.maximum(seen - less, 1)
        return p, np.where(seen > less, np.minimum(share, 1), 0), lev

    def learn(self, triples: np.ndarray) -> None:
        """The weights, from the number of training tokens of each triple."""
        at = np.flatnonzero(triples)
        p, share, lev = (x[at] for x in self.parts(leave_out=True))
        # log-likelihood over the word probability alone, by level and weight
        ratio = np.minimum(share / p, 1e12)
        gains = np.stack([np.bincount(lev, triples[at] * np.log(x * ratio + (1 - x)), LEVELS + 1) for x in _GRID], 1)
        self.weights = _GRID[gains.argmax(axis=1)]

    def log10(self) -> np.ndarray:
        """log10 probability of a token of each triple."""
        p, share, lev = self.parts()
        w = self.weights[lev]
        return np.log10(w * share + (1 - w) * p)


def _ngrams(held: list[tuple[np.ndarray, np.ndarray]], kind: int) -> list[np.ndarray]:
    """The words (1) or pairs (2) of a chunk's tokens."""
    return [unigram(h) if kind == 1 else bigram(histories(h, ptr), h) for h, ptr in held]


def _chunks(rows: DataFrame, segment_bits: int) -> DataFrame:
    """Of each chunk of texts: its n-grams with their training counts by hash
    range (``kind`` 1: words, 2: pairs), and its rows (3, under any range)."""

    def run(batches: Batches) -> Batches:
        task, made = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        learned: list[np.ndarray] = []
        texts: list[bytes] = []

        def flush():
            seg, kind, part = [], [], []
            for k in (1, 2):
                g = np.concatenate(_ngrams(held, k))
                g |= np.concatenate([np.repeat(x, np.diff(ptr)) for x, (_, ptr) in zip(learned, held)])
                g.sort()
                first = np.flatnonzero(np.r_[True, g[1:] >> U(1) != g[:-1] >> U(1)])
                c = np.add.reduceat(g & U(1), first).astype(np.int64)
                g = g[first] & ~U(1)
                cuts = np.searchsorted(_segment(g, segment_bits), np.arange((1 << segment_bits) + 1)).tolist()
                for j, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    if lo < hi:
                        seg.append(j), kind.append(k), part.append(_pack(g[lo:hi], c[lo:hi]))
            for j, x in enumerate(texts):
                seg.append((made * 7919 + task + j) % (1 << segment_bits)), kind.append(3), part.append(x)
            held.clear(), learned.clear(), texts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(seg, pa.int32()), pa.array([task + made] * len(seg), pa.int64()), pa.array(kind, pa.int32()),
                 pa.array(part, pa.binary())], names=["seg", "chunk", "kind", "part"])

        for b in batches:
            for w in blocks(b.column(3)):
                held.append(tokens(w))
                learned.append(b.column(2).slice(w.lo, w.n).to_numpy(zero_copy_only=False).astype(U))
                texts.append(_ipc(b.slice(w.lo, w.n)))
                if sum(len(h) for h, _ in held) >= HELD:
                    yield flush()
                    made += 1
        if held:
            yield flush()

    return rows.mapInArrow(run, "seg int, chunk long, kind int, part binary")


def _levels(chunks: DataFrame, bits: int, segment_bits: int) -> DataFrame:
    """Levels of each chunk's n-grams (of words after their exact counts) and its
    rows; and of each hash range (``kind`` 0) its different training words."""

    def segment(seg: int, held: list[tuple[int, int, bytes]]) -> Batches:
        sums = {}
        for k in (1, 2):
            own = []
            for _, kind, part in held:
                if kind == k:
                    g, c = _unpack(part)
                    own.append((g[c > 0], c[c > 0]))
                    if len(own) >= 64:  # keep one sum, not all parts
                        own = [_sum(own)]
            sums[k] = _sum(own)
        w, wc = sums[1]
        g, c = np.r_[w, sums[2][0]], np.r_[wc, sums[2][1]]
        size = max(bits >> segment_bits, room_for(int(level(c).sum())))
        packed, _ = build_segment(g, c, size)
        del g, c
        for chunk, kind, part in held:
            g, _ = _unpack(part)
            found = probe(packed, size, g, np.zeros(len(g), np.int64)).astype(np.uint8).tobytes()
            if kind == 1:
                at = np.minimum(np.searchsorted(w, g), max(len(w) - 1, 0))
                found = (np.where(w[at] == g, wc[at], 0) if len(w) else np.zeros(len(g), np.int64)).tobytes() + found
            yield out(chunk, kind, seg, found)
        yield out(-1 - seg, 0, seg, np.int64(len(w)).tobytes())

    def out(chunk: int, kind: int, seg: int, part: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), pa.array([kind], pa.int32()), pa.array([seg], pa.int32()),
             pa.array([part], pa.binary())], names=["chunk", "kind", "seg", "part"])

    def run(batches: Batches) -> Batches:
        held, now = [], None
        for b in batches:
            for s, chunk, kind, part in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 3:  # only passes through
                    yield out(chunk, 3, s, part)
                    continue
                if s != now and held:
                    yield from segment(now, held)
                    held.clear()
                now = s
                held.append((chunk, kind, part))
        if held:
            yield from segment(now, held)

    return chunks.repartition(1 << segment_bits, "seg").sortWithinPartitions("seg").mapInArrow(
        run, "chunk long, kind int, seg int, part binary")


def _triples(done: DataFrame, id_type: DataType) -> DataFrame:
    """One row a text: its tokens' different triples of levels (history, word,
    both) and their numbers, and what the base score needs; and one row a hash
    range with nothing but its ``types``."""

    def texts(parts: dict[int, list[bytes]]) -> Batches:
        rows = [b for x in parts[3] for b in pa.ipc.open_stream(_zstd().decompress(x[8:], int.from_bytes(x[:8])))]
        held = [tokens(Words(0, *utf8_rows(b.column(3)))) for b in rows]
        u, g = (np.unique(np.concatenate(_ngrams(held, k))) for k in (1, 2))
        count = np.concatenate([np.frombuffer(x, np.int64, len(x) // 9) for x in parts[1]])
        known = np.concatenate([np.frombuffer(x, np.uint8, offset=len(x) // 9 * 8) for x in parts[1]]).astype(np.int64)
        pairs = np.concatenate([np.frombuffer(x, np.uint8) for x in parts[2]]).astype(np.int64)
        # a history's count is its count as a word; a text's start, the number of ends
        ends = known[np.searchsorted(u, unigram(np.array([END], U)))[0]]
        logs = np.log10(count + 0.5)
        for b, (h, ptr) in zip(rows, held):
            at = np.searchsorted(u, unigram(h))
            word = known[at]
            lev = np.r_[0, word[:-1]]
            lev[ptr[:-1]] = ends
            code = (lev * LEVELS + word) * LEVELS + pairs[np.searchsorted(g, bigram(histories(h, ptr), h))]
            text = np.repeat(np.arange(b.num_rows), np.diff(ptr))
            x, n = np.unique(text << 16 | code, return_counts=True)
            cuts = pa.array(np.searchsorted(x, np.arange(b.num_rows + 1) << 16).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(np.diff(ptr)), pa.array(np.add.reduceat((count[at] > 0).astype(np.int64), ptr[:-1])),
                 pa.array(np.add.reduceat(logs[at], ptr[:-1])),
                 pa.ListArray.from_arrays(cuts, pa.array((x & 0xFFFF).astype(np.int32))),
                 pa.ListArray.from_arrays(cuts, pa.array(n.astype(np.int32))), pa.nulls(b.num_rows, pa.int64())],
                names=names)

    def run(batches: Batches) -> Batches:
        parts, now = {1: [], 2: [], 3: []}, None
        for b in batches:
            for chunk, kind, part in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 0:
                    types = pa.array(np.frombuffer(part, np.int64))
                    yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in own_types), types], names=names)
                    continue
                if chunk != now and now is not None:
                    yield from texts(parts)
                    parts = {1: [], 2: [], 3: []}
                now = chunk
                parts[kind].append(part)
        if now is not None:
            yield from texts(parts)

    names = ["doc_id", "held_out", "learn", "n_tokens", "n_known", "logs", "triples", "numbers", "types"]
    own_types = [to_arrow_type(id_type), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(),
                 pa.list_(pa.int32()), pa.list_(pa.int32())]
    rows = done.repartition("chunk").sortWithinPartitions("chunk", "kind", "seg")
    return rows.select("chunk", "kind", "part").mapInArrow(
        run, f"doc_id {id_type.simpleString()}, held_out boolean, learn boolean, n_tokens long, n_known long, logs double, "
             "triples array<int>, numbers array<int>, types long")


def utf8_rows(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a block's texts and their offsets, both from 0."""
    data, offs = utf8(col)
    return data[offs[0]:offs[-1]], offs - offs[0]


def _zstd() -> pa.Codec:
    return pa.Codec("zstd", 5)


def _ipc(b: pa.RecordBatch) -> bytes:
    """A block's rows compressed, after their size."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, b.schema) as w:
        w.write_batch(b)
    x = sink.getvalue()
    return x.size.to_bytes(8) + _zstd().compress(x, asbytes=True)


def _pack(h: np.ndarray, c: np.ndarray) -> bytes:
    """Sorted hashes (pairs as differences where they fit 32 bits), then counts as
    bytes where they fit (most are 1)."""
    step = np.diff(h >> U(16), prepend=h[:1] >> U(16))
    near = not (h & U(0xFFFF)).any() and int(step.max()) < 1 << 32
    small = bool((c < 256).all())
    return ((b"d" + h[:1].tobytes() + step.astype(np.uint32).tobytes() if near else b"h" + h.tobytes())
            + c.astype(np.uint8 if small else np.int64).tobytes() + (b"b" if small else b"q"))


def _unpack(part: bytes) -> tuple[np.ndarray, np.ndarray]:
    kind = np.dtype(np.uint8 if part[-1:] == b"b" else np.int64)
    if part[:1] == b"h":
        n = (len(part) - 2) // (8 + kind.itemsize)
        h, end = np.frombuffer(part, U, n, 1), 1 + 8 * n
    else:
        n = (len(part) - 10) // (4 + kind.itemsize)
        h = np.frombuffer(part, U, 1, 1) + (np.cumsum(np.frombuffer(part, np.uint32, n, 9), dtype=U) << U(16))
        end = 9 + 4 * n
    return h, np.frombuffer(part, kind, n, end)


def _sum(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, U), np.zeros(0, np.int64)
    h = np.concatenate([p[0] for p in parts])
    c = np.concatenate([p[1].astype(np.int64) for p in parts])
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(c, first) if len(h) else c


def fit(docs: DataFrame, learn: Column, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
        bits: int = 1 << 28) -> tuple[BloomModel, DataFrame]:
    """The model of the texts where ``learn`` holds, and all texts reduced to
    their triples, ready to be scored by it."""
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"),
                       F.coalesce(learn, F.lit(False)).alias("learn"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # as many hash ranges as the session's shuffles ask for, so a range's task does not grow with the corpus
    segment_bits = min(16, max(6, (4 * shuffle_partitions(docs.sparkSession) - 1).bit_length()))
    done = _levels(_chunks(rows, segment_bits), bits, segment_bits)
    done = stage(_triples(done, docs.schema[id_col].dataType), "triples")
    types = done.agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]
    texts = done.where("types is null").drop("types")

    def count(b: pa.RecordBatch, table: np.ndarray) -> None:
        table += np.bincount(b.column(0).flatten().to_numpy(), b.column(1).flatten().to_numpy(), len(table)).astype(np.int64)

    shape = (LEVELS ** 3,)
    triples = collect_table(summed_tables(texts.where("learn").select("triples", "numbers"), count, shape), shape)
    model = BloomModel(None, bits >> segment_bits, segment_bits, int(triples.sum()), int(types), np.zeros(LEVELS + 1))
    model.learn(triples)
    return model, texts


def score_documents(texts: DataFrame, model: BloomModel) -> DataFrame:
    """One row a text of ``fit``: ``doc_id``, ``held_out``, ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    shared = texts.sparkSession.sparkContext.broadcast(model.log10())
    scale = float(np.log10(model.tokens + 0.5 * (model.types + 1)))

    def run(batches: Batches) -> Batches:
        for b in batches:
            x, n = (b.column(k) for k in (5, 6))
            first = np.r_[0, np.cumsum(x.value_lengths().to_numpy())[:-1]].astype(np.int64)
            score = shared.value[x.flatten().to_numpy()] * n.flatten().to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(np.add.reduceat(score, first) if len(score) else np.zeros(0))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    out = texts.select("doc_id", "held_out", "n_tokens", "n_known",
                       (F.col("logs") - F.col("n_tokens") * F.lit(scale)).alias("base_score"), "triples", "numbers")
    return out.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, "
                               "score double").select("doc_id", "held_out", "n_tokens", "n_known",
                                                      F.lit(model.tokens).cast("long").alias("train_tokens"),
                                                      "base_score", "score")
