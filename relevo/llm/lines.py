"""Near-duplicate lines by an exact set-similarity join (operator 8).

Method: a line is the set of its words (``A-Z`` lower-cased).  Its words are
ordered by rarity; two lines with a Jaccard index of at least ``percent``
share one of the first ``n - ceil(t * n) + 1`` words of that order (prefix
filter).  Lines that share a prefix word are compared by length, by the place
of the word (positional filter: what is left behind it must still suffice) and
by 64-bit parity maps of their sets, whose Hamming distance can't exceed the
symmetric difference.  A second pass over the texts reads the lines in question
once more: pairs whose 256-bit parity maps differ too much go, what is left is
verified exactly on the full sets.  A line is
removed if an earlier line (smaller id, then line number) has the same set or
is similar enough, whether that line stays or not.

Any fixed order of words keeps the join exact, so rarity is read from a table
of hashed word counts of fixed size over all texts.  Prefix words travel as
packed arrays by hash range; equal sets collapse to their earliest line.  For
each later line the ``CANDIDATES`` nearest earlier partners of a word are sent
on at first; words where a line has more leave their whole list behind, and
lines that were not matched by the first ones meet the rest of these lists, so
nothing is lost.  Only texts with a line in question are parsed for them.

Defined results: lines are parted by ``\n``; lines of fewer than ``min_words``
different words are left alone, empty ones too; a null text has no lines; a
row without an id can't be ranked and takes no part; rows that share an id
count as one document, the same line of both as one line.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, collect_table, marked, marks, shuffle_partitions, stage, summed_tables
from .words import U, Words, blocks, mix

PERCENT, MIN_WORDS, CANDIDATES = 80, 1, 4
RARITY_BITS = 20
MAPS = 4  # words of the wide parity maps, a power of two
POSTING = np.dtype([("word", "<u4"), ("digest", "<u8"), ("parity", "<u8"), ("doc", "<i8"), ("line", "<i4"),
                    ("n", "<i4"), ("place", "<u2")])


def line_sets(w: Words):
    """The lines of a block as sets: word hashes sorted by line, where each
    line's begin, and the text and number of each line (lines without words
    are skipped)."""
    newline = np.flatnonzero(w.data == 10)
    h, row = w.hashes(), w.rows()
    number = np.searchsorted(newline, w.start)              # newlines of the block before the word
    number = number - np.searchsorted(newline, w.offs[:-1])[row]  # ... before the text
    change = np.ones(len(h), bool)
    change[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
    return h, np.cumsum(change) - 1, row[change], number[change]


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (n * percent + 99) // 100 + 1


def needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Common words that sets of ``n`` and ``m`` need for the Jaccard index."""
    return (percent * (n + m) + 99 + percent) // (100 + percent)


def _sets(w: Words, lines_, rank: np.ndarray | None = None):
    """The distinct words of each line, in order of ``rank`` (else of their
    hashes), and each line's first place, size, digest and parity map."""
    h, line, row, number = lines_
    rank = h if rank is None else rank
    if len(h) and line[-1] < 1 << 20:
        # one key of line and rank; where its last bits are missed, by both
        key = line.astype(U) << U(44) | rank >> U(20)
        order = np.argsort(key)
        key, by_key = key[order], h[order]
        if ((key[1:] == key[:-1]) & (by_key[1:] != by_key[:-1])).any():
            order = np.lexsort((rank, line))
    else:
        order = np.lexsort((rank, line))
    h, line = h[order], line[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    h, line = h[new], line[new]
    first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]]) if len(h) else np.zeros(0, np.int64)
    n = np.diff(np.r_[first, len(h)])
    digest = np.add.reduceat(mix(h + U(7)), first) if len(h) else h
    parity = np.bitwise_xor.reduceat(U(1) << (mix(h) >> U(58)), first) if len(h) else h
    return h, first, n, digest, parity, row, number


def _postings(w: Words, rarity: np.ndarray, ids: np.ndarray, percent: int, min_words: int):
    """Prefix postings of a block's lines (of equal sets the earliest), with
    their word hashes; and, as rows of numbers, the later lines of equal sets
    with the earliest one."""
    h, line, row, number = line_sets(w)
    rank = rarity[(h >> U(64 - RARITY_BITS)).astype(np.int64)].astype(U) << U(56) | h >> U(8)
    h, first, n, digest, parity, row, number = _sets(w, (h, line, row, number), rank)
    doc = ids[w.lo + row]
    use = np.flatnonzero(n >= min_words)
    use = use[np.lexsort((number[use], doc[use], digest[use]))]
    same = np.zeros(len(use), bool)
    same[1:] = digest[use][1:] == digest[use][:-1]
    lead = use[np.maximum.accumulate(np.where(same, 0, np.arange(len(use))))] if len(use) else use
    twin = same & ((doc[use] != doc[lead]) | (number[use] != number[lead]))
    copies = np.stack([doc[use], number[use], doc[lead], number[lead]])[:, twin]
    use = use[~same]
    p = prefix_length(n[use], percent)
    place = np.arange(p.sum()) - np.repeat(np.cumsum(p) - p, p)
    of = np.repeat(use, p)
    words = h[first[of] + place]
    out = np.empty(len(of), POSTING)
    out["word"] = (words & U(0xFFFFFFFF)).astype(np.uint32)
    out["digest"], out["parity"], out["doc"], out["line"] = digest[of], parity[of], doc[of], number[of]
    out["n"], out["place"] = n[of], np.minimum(place, 65535)
    return words, out, copies


def _shared(word: np.ndarray) -> np.ndarray:
    """Which entries may hold a word that occurs again (one that doesn't is
    mostly seen by a count in as many buckets)."""
    mask = (1 << max(10, len(word).bit_length() + 1)) - 1
    at = word & np.uint32(mask & 0xFFFFFFFF)
    return np.bincount(at)[at] > 1


def _equal_sets(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Postings of one range in order of word, document and line, one for each
    word and set (the earliest), of words that several sets have; and the later
    lines of equal sets, found at their rarest word only."""
    p = p[_shared(np.ascontiguousarray(p["word"]))]
    word, digest = np.ascontiguousarray(p["word"]).astype(U), np.ascontiguousarray(p["digest"])
    order = np.argsort(word << U(32) | digest >> U(32))
    word, digest = word[order], digest[order]
    if ((word[1:] == word[:-1]) & (digest[1:] >> U(32) == digest[:-1] >> U(32)) & (digest[1:] != digest[:-1])).any():
        order = np.lexsort((p["digest"], p["word"]))
        word, digest = p["word"][order].astype(U), p["digest"][order]
    new = np.ones(len(p), bool)
    new[1:] = (word[1:] != word[:-1]) | (digest[1:] != digest[:-1])
    group = np.cumsum(new) - 1
    # within equal sets by document and line
    many = np.flatnonzero(np.bincount(group)[group] > 1) if len(p) else order
    rows = p[order[many]]
    order[many] = order[many][np.lexsort((rows["line"], rows["doc"], group[many]))]
    lead = order[np.flatnonzero(new)][group] if len(p) else order
    x, y = p[order[many]], p[lead[many]]
    twin = (~new[many]) & (x["place"] == 0) & ((x["doc"] != y["doc"]) | (x["line"] != y["line"]))
    x, y = x[twin], y[twin]
    copies = np.stack([x["doc"], x["line"].astype(np.int64), y["doc"], y["line"].astype(np.int64)])
    p = p[order[new]]
    word = np.ascontiguousarray(p["word"])
    again = np.zeros(len(p), bool)
    again[1:] = word[1:] == word[:-1]
    again[:-1] |= again[1:]
    p = p[again]
    return p[np.lexsort((p["line"], p["doc"], p["word"]))], copies


def _pairs(p: np.ndarray, percent: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Compatible pairs within words, as rows later/earlier document and line
    and whether the later line has more than the ``bound`` pairs sent; and the
    numbers of all postings of words that have such a line."""
    found = []
    sent = np.zeros(len(p), np.int64)
    word, parity = p["word"].copy(), p["parity"].copy()
    n = p["n"].astype(np.int64)
    rest = n - p["place"]
    live = np.arange(len(p))
    d = 0
    while len(live):
        d += 1
        live = live[live + d < len(p)]
        live = live[word[live + d] == word[live]]
        # place, then length, then parity: each on what the one before leaves
        x, y = n[live], n[live + d]
        good = live[np.minimum(rest[live], rest[live + d]) >= needed(x, y, percent)]
        x, y = n[good], n[good + d]
        ok = 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
        ok &= np.bitwise_count(parity[good] ^ parity[good + d]) <= x + y - 2 * needed(x, y, percent)
        good = good[ok]
        later = good + d
        few = sent[later] < bound
        sent[later] += 1
        found.append(np.stack([good[few], later[few]]))
    a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    # a pair often shares several words of the range
    digests = np.stack([p["digest"][b], p["digest"][a]])
    kind = 1 + (sent[b] > bound)
    order = np.lexsort((-kind, *digests))
    first = np.ones(len(order), bool)
    first[1:] = (digests[:, order[1:]] != digests[:, order[:-1]]).any(axis=0)
    once = order[first]
    a, b = a[once], b[once]
    rows = np.stack([p["doc"][b], p["line"][b].astype(np.int64), p["doc"][a], p["line"][a].astype(np.int64),
                     kind[once], p["digest"][b].view(np.int64), p["digest"][a].view(np.int64)])
    return rows, np.flatnonzero(np.isin(word, word[sent > bound]))


# kind: 0 equal set, 1 candidate, 2 candidate of a line with more of them;
# 3 a posting of a word where a line has more of them: by_doc is the word,
# by_line its place and the set's size, by_digest the parity map
COLUMNS = ["doc", "line", "by_doc", "by_line", "kind", "digest", "by_digest"]
OUT = ", ".join(f"{c} long" for c in COLUMNS)


def _batch(rows: np.ndarray) -> pa.RecordBatch:
    """Rows of numbers as a batch; copies (4 rows) have no kind or digests yet."""
    full = np.zeros((len(COLUMNS), rows.shape[1]), np.int64)
    full[:len(rows)] = rows
    return pa.RecordBatch.from_arrays([pa.array(r) for r in full], names=COLUMNS)


def candidates(docs: DataFrame, percent: int, min_words: int, rarity) -> DataFrame:
    """Later lines with an earlier one: of an equal set, or to verify."""
    parts = 1 << max(6, (4 * shuffle_partitions(docs.sparkSession)).bit_length())
    shift = 65 - parts.bit_length()

    def local(batches: Batches) -> Batches:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            held, hashes, twins = [], [], []
            for w in blocks(b.column(1)):
                if len(w):
                    words, p, copies = _postings(w, rarity.value, ids, percent, min_words)
                    held.append(p), hashes.append(words), twins.append(copies)
                if sum(map(len, held)) > 400_000:
                    yield pack(held, hashes, twins)
            if held:
                yield pack(held, hashes, twins)

    def pack(held, hashes, twins):
        p, at = np.concatenate(held), (np.concatenate(hashes) >> U(shift)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        p, at = p[order], at[order]
        copies = np.concatenate(twins, axis=1)
        held.clear(), hashes.clear(), twins.clear()
        seg, start = np.unique(at, return_index=True)
        cuts = [*start.tolist(), len(p)]
        blobs = [p[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        if copies.shape[1]:  # found already: they only pass through
            seg, blobs = np.r_[seg, seg[:1]], [*blobs, copies.astype(np.int64).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array(seg.astype(np.int32)), pa.array([k < len(start) for k in range(len(seg))]),
                                           pa.array(blobs, pa.binary())], names=["seg", "open", "part"])

    def join(batches: Batches) -> Batches:
        held, now = [], None
        for b in batches:
            for s, is_open, part in zip(*(c.to_pylist() for c in b.columns)):
                if not is_open:
                    rows = np.frombuffer(part, np.int64).reshape(4, -1)
                    yield _batch(rows)
                    continue
                if s != now and held:
                    yield from matched(held, now)
                now = s
                held.append(np.frombuffer(part, POSTING))
        if held:
            yield from matched(held, now)

    def matched(held, segment):
        p, copies = _equal_sets(np.concatenate(held))
        held.clear()
        yield _batch(copies)
        pairs, more = _pairs(p, percent, CANDIDATES)
        yield _batch(pairs)
        p = p[more]
        word = p["word"].astype(np.int64) | np.int64(segment) << 32
        yield _batch(np.stack([p["doc"], p["line"].astype(np.int64), word, p["n"].astype(np.int64) << 16 | p["place"],
                               np.full(len(p), 3), p["digest"].view(np.int64), p["parity"].view(np.int64)]))

    packed = docs.mapInArrow(local, "seg int, open boolean, part binary")
    return packed.repartition("seg").sortWithinPartitions("seg").mapInArrow(join, OUT)


def _line_hash(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    return mix(mix(doc.astype(np.int64).view(U)) + line.astype(np.int64).view(U))


def _doc_hash(doc: np.ndarray) -> np.ndarray:
    return mix(doc.astype(np.int64).view(U) + U(3))


def _marks(wanted: DataFrame):
    """Marks of the lines ``doc``, ``line``, two for each, and of their documents."""

    def key(batches: Batches) -> Batches:
        for b in batches:
            doc, line = (c.to_numpy() for c in b.columns)
            h = _line_hash(doc, line)
            h = np.concatenate([h, mix(h), np.unique(_doc_hash(doc))])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return marks(wanted.mapInArrow(key, "h long"))


def _parity_maps(h: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Parity maps of ``64 * MAPS`` bits of the sets that begin at ``first``."""
    x = mix(h + U(11))
    bit, lane = U(1) << (x & U(63)), x >> U(64 - MAPS.bit_length() + 1)
    return [np.bitwise_xor.reduceat(np.where(lane == U(k), bit, U(0)), first) if len(h) else h for k in range(MAPS)]


def _close(percent: int) -> Column:
    """Do the wide parity maps of two sets (``n``, ``p0``, ... and ``by_n``,
    ``by_p0``, ...) differ in no more bits than similar sets can?"""
    alpha = F.floor((F.lit(percent) * (F.col("n") + F.col("by_n")) + 99 + percent) / (100 + percent))
    apart = sum((F.bit_count(F.col(f"p{k}").bitwiseXOR(F.col(f"by_p{k}"))) for k in range(MAPS)), F.lit(0))
    return apart <= F.col("n") + F.col("by_n") - 2 * alpha


def _verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (with digests) whose sets are similar enough.  The sets of the
    lines in question are read off the texts once more: a line is sent if its
    place is marked (which only spares work; the joins on digests decide).
    Pairs meet wide parity maps first, and only what these leave meets sets."""
    wanted = stage(pairs.select("doc", "line").unionByName(pairs.select(F.col("by_doc").alias("doc"), F.col("by_line").alias("line")))
                   .distinct(), "wanted")
    bits, shared = _marks(wanted)
    maps = [f"p{k}" for k in range(MAPS)]

    def sets(batches: Batches) -> Batches:
        table = shared.value
        for b in batches:
            b = b.filter(pa.array(marked(_doc_hash(b.column(0).to_numpy(zero_copy_only=False)), bits, table)))
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for w in blocks(b.column(1)):
                if not len(w):
                    continue
                h, line, row, number = line_sets(w)
                place = _line_hash(ids[w.lo + row], number)
                use = marked(place, bits, table) & marked(mix(place), bits, table)
                word = use[line]
                h, first, n, digest, _, _, _ = _sets(w, (h[word], (np.cumsum(use) - 1)[line[word]], row[use], number[use]))
                _, once = np.unique(digest, return_index=True)
                wide = [x[once].view(np.int64) for x in _parity_maps(h, first)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (digest[once].view(np.int64), n[once].astype(np.int64), *wide)]
                    + [pa.array([h[first[k]:first[k] + n[k]].tobytes() for k in once.tolist()], pa.binary())],
                    names=["digest", "n", *maps, "words"])

    found = stage(docs.mapInArrow(sets, ", ".join(f"{c} long" for c in ("digest", "n", *maps)) + ", words binary"), "line-sets")

    def once(*columns: str) -> DataFrame:
        """These columns of each set; rows that share an id send theirs again."""
        return found.groupBy("digest").agg(*[F.first(c).alias(c) for c in columns])

    def earlier(df: DataFrame) -> DataFrame:
        return df.select([F.col(c).alias(f"by_{c}") for c in df.columns])

    places = ["doc", "line", "by_doc", "by_line"]
    t = (pairs.join(once("n", *maps), "digest").join(earlier(once("n", *maps)), "by_digest").where(_close(percent))
         .select(*places, "digest", "by_digest")
         .join(earlier(once("words")), "by_digest").join(once("words"), "digest").select(*places, "words", "by_words"))

    def run(batches: Batches) -> Batches:
        for b in batches:
            good = []
            for k, (x, y) in enumerate(zip(b.column(4), b.column(5))):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    good.append(k)
            rows = np.stack([c.to_numpy() for c in b.columns[:4]])[:, np.array(good, np.int64)]
            yield _batch(rows)

    return t.mapInArrow(run, OUT)


def _rest(open_lines: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """All compatible earlier lines of ``open_lines`` (``digest``) on the lists
    of words where a line has more candidates than were sent."""
    p = lists.select("doc", "line", "digest", F.col("by_doc").alias("word"), F.shiftright("by_line", 16).alias("n"),
                     F.col("by_line").bitwiseAND(65535).alias("place"), F.col("by_digest").alias("parity"))
    own = p.join(open_lines.select("digest").distinct(), "digest", "left_semi")
    by = p.select("word", *[F.col(c).alias(f"by_{c}") for c in p.columns if c != "word"])
    alpha = F.floor((F.lit(percent) * (F.col("n") + F.col("by_n")) + 99 + percent) / (100 + percent))
    return (own.join(by, "word")
            .where("by_doc < doc or (by_doc = doc and by_line < line)").where("digest <> by_digest")
            .where(F.least(F.col("n") - F.col("place"), F.col("by_n") - F.col("by_place")) >= alpha)
            .where(100 * F.least("n", "by_n") >= percent * F.greatest("n", "by_n"))
            .where(F.bit_count(F.col("parity").bitwiseXOR(F.col("by_parity"))) <= F.col("n") + F.col("by_n") - 2 * alpha)
            .select("doc", "line", "by_doc", "by_line", "digest", "by_digest").distinct())


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """The lines to remove: ``doc_id``, ``line`` (from 0), and the earliest
    line found for it, ``by_doc_id``, ``by_line``."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(
        "doc_id is not null and text is not null")

    def count(b: pa.RecordBatch, table: np.ndarray) -> None:
        for w in blocks(b.column(0)):
            table += np.bincount((w.hashes() >> U(64 - RARITY_BITS)).astype(np.int64), minlength=len(table))

    shape = (1 << RARITY_BITS,)
    counts = collect_table(summed_tables(d.select("text"), count, shape), shape)
    rarity = docs.sparkSession.sparkContext.broadcast(
        np.minimum(np.log2(counts + 1) * 7, 255).astype(np.uint8))
    found = stage(candidates(d, percent, min_words, rarity), "line-pairs")
    columns = ["doc", "line", "by_doc", "by_line", "digest", "by_digest"]
    pairs = stage(found.where("kind in (1, 2)").groupBy("digest", "by_digest").agg(
        F.max("kind").alias("kind"), *[F.min(c).alias(c) for c in columns[:4]]), "line-pairs")
    near = stage(_verified(pairs, d, percent), "lines")
    open_lines = stage(pairs.where("kind = 2").select("doc", "line", "digest").distinct().join(
        near.select("doc", "line"), ["doc", "line"], "left_anti"), "open-lines")
    if not open_lines.isEmpty():
        rest = _rest(open_lines, found.where("kind = 3"), percent).join(
            pairs.select("digest", "by_digest"), ["digest", "by_digest"], "left_anti")
        rest = stage(rest, "line-pairs")
        near = near.unionByName(_verified(rest, d, percent))
    return found.where("kind = 0").unionByName(near).groupBy("doc", "line").agg(
        F.min(F.struct("by_doc", "by_line")).alias("by")).select(
        F.col("doc").alias("doc_id"), "line", F.col("by.by_doc").alias("by_doc_id"), F.col("by.by_line").alias("by_line"))


def without_lines(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with these lines taken out of their texts; other columns stay."""
    gone = removed.groupBy("doc_id").agg(F.collect_set("line").alias("_gone")).withColumnRenamed("doc_id", "_line_id")
    d = docs.join(gone, F.col(id_col).cast("long") == F.col("_line_id"), "left")
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1),
                                 lambda x, i: ~F.array_contains("_gone", i.cast("long"))), "\n")
    return d.withColumn(text_col, F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(kept)).select(*docs.columns)
