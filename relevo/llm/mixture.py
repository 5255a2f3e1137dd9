"""Mixing sources to target weights (operator 4), DataFrame functions only.

Method: a multivariate-hypergeometric splitting tree.  Each source's documents
form a stream in the order of a hash; the words of the mix are cut from that
stream in blocks of ``block_words``, up to ``max_repeats`` passes over it.  The
exact number of blocks of every source (its quota) is split recursively: a
node hands half of its blocks to the left half of its shards, drawn without
replacement from the node's blocks of all sources, and the rest to the right.
At the leaves each output shard owns a range of each source's blocks, disjoint
from every other shard's, and sorts what it gets by a hash.

The tree works on one row a node with one number a source, never on documents.
A document's place in its stream is a sum over hash ranges plus a running sum
within one range, so a source of any size is spread over many tasks; the place
does not depend on how many ranges there are.

Defined results: a null text has size 0, and documents of size 0 are never
taken; a null source is a source of its own, last in order; repeated rows are
documents of their own; an empty table gives an empty mix.  A seed fixes every
draw, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """Words to take of each source (``sizes``: one row a source, ``source``,
    ``source_size``).  Sources in code-point order, null last, weigh
    ``weights`` in turn and share 100 % of all sizes; a target stops at
    ``max_repeats`` times its source, and the excess goes to the others by
    weight.  Adds ``rank`` (from 0), ``weight`` and ``target``.

    What repeated resharing ends in is ``min(limit, level * weight)``: with
    the sources in order of ``limit / weight``, those that reach their limit
    come first, so two running sums find the level."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("rank") % len(weights) + 1).cast("int"))
    s = (sizes.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", w)
         .withColumn("limit", F.col("source_size") * float(max_repeats)))
    by = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before, whole = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = (s.withColumn("left", F.sum("source_size").over(whole)
                      - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
         .withColumn("weights", F.sum("weight").over(whole)
                     - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("open", F.col("left") * F.col("weight") <= F.col("limit") * F.col("weights")))
    # the first open source's level holds for all open ones
    first = F.first(F.when(F.col("open"), F.col("left") / F.col("weights")), ignorenulls=True).over(
        by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("open"), first * F.col("weight")).otherwise(F.col("limit"))
    return s.withColumn("target", target).select("source", "source_size", "rank", "weight", "target")


def _log_factorial(n: str) -> str:
    """ln n!: fixed below 10, by Stirling's series (error under 1e-10) above."""
    small = ", ".join(f"{math.lgamma(k + 1)!r}D" for k in range(10))
    return (f"CASE WHEN {n} < 10 THEN element_at(array({small}), cast({n} as int) + 1) "
            f"ELSE ({n} + 0.5D) * ln({n}) - {n} + {0.5 * math.log(2 * math.pi)!r}D + 1 / (12D * {n}) "
            f"- 1 / (360D * {n} * {n} * {n}) + 1 / (1260D * {n} * {n} * {n} * {n} * {n}) END")


def _log_choose(n: str, k: str) -> str:
    return f"({_log_factorial(n)}) - ({_log_factorial(k)}) - ({_log_factorial(f'({n} - {k})')})"


def _split(seed: int) -> Column:
    """Quotas of a node's left half: one hypergeometric draw a source, given
    the draws before it (walk along the distribution to a hashed quantile)."""
    own, others, need = "quota[i]", "(a.others - quota[i])", "a.need"
    u = f"(pmod(xxhash64({seed}, node, i), 9007199254740992L) / 9007199254740992D)"
    chance = (f"exp({_log_choose(own, 'k')} + {_log_choose(others, f'({need} - k)')} "
              f"- ({_log_choose('a.others', need)}))")
    drawn = (f"aggregate(sequence(greatest(0L, {need} - {others}), least({own}, {need})), "
             f"named_struct('x', -1L, 'sum', 0D), (w, k) -> CASE WHEN w.x >= 0 THEN w "
             f"WHEN w.sum + {chance} >= {u} OR k = least({own}, {need}) "
             f"THEN named_struct('x', k, 'sum', 0D) "
             f"ELSE named_struct('x', -1L, 'sum', w.sum + {chance}) END, w -> w.x)")
    step = (f"aggregate(array({drawn}), a, (b, x) -> named_struct('others', a.others - quota[i], "
            f"'need', a.need - x, 'out', concat(a.out, array(x))))")
    total = "aggregate(quota, 0L, (a, x) -> a + x)"
    return F.expr(f"aggregate(sequence(0, size(quota) - 1), named_struct('others', {total}, "
                  f"'need', {total} div 2, 'out', cast(array() as array<bigint>)), "
                  f"(a, i) -> {step}, a -> a.out)")


def shard_quotas(sources: DataFrame, shards: int, block_words: Column, seed: int) -> DataFrame:
    """The splitting tree: blocks of every source for each of ``shards`` (a
    power of two) output shards.  Rows: ``rank``, ``cuts`` (shard ``j`` owns the
    source's blocks from ``cuts[j]`` up to ``cuts[j + 1]``)."""
    blocks = F.ceil(F.round("target") / block_words).cast("long")
    root = (sources.select("rank", blocks.alias("blocks")).agg(F.sort_array(F.collect_list(F.struct("rank", "blocks"))).alias("q"))
            .select(F.lit(1).cast("long").alias("node"), F.col("q.blocks").alias("quota")).where("size(quota) > 0"))
    nodes, levels = root, shards.bit_length() - 1
    for _ in range(levels):
        nodes = (nodes.withColumn("lefts", _split(seed))
                 .withColumn("rights", F.zip_with("quota", "lefts", lambda a, b: a - b))
                 .select(F.explode(F.array(
                     F.struct((F.col("node") * 2).alias("node"), F.col("lefts").alias("quota")),
                     F.struct((F.col("node") * 2 + 1).alias("node"), F.col("rights").alias("quota")))).alias("c"))
                 .select("c.node", "c.quota"))
    leaf = nodes.select((F.col("node") - shards).alias("shard"), F.posexplode("quota").alias("rank", "n"))
    upto = Window.partitionBy("rank").orderBy("shard")
    ends = leaf.withColumn("end", F.sum("n").over(upto))
    return ends.groupBy("rank").agg(F.sort_array(F.collect_list("end")).alias("ends")).select(
        "rank", F.concat(F.array(F.lit(0).cast("long")), F.col("ends")).alias("cuts"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = 3, shards: int = 16,
                blocks_per_shard: int = 64, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", carry: Sequence[str] = ()) -> DataFrame:
    """One row a document: ``doc_id``, ``size``, ``source``, ``source_size``,
    ``target`` and ``pieces``: what the mix takes of it, as structs ``shard``,
    ``repeat``, ``from_word``, ``words`` and ``order_key`` (a shard is read in
    the order of this key).  Columns ``carry`` come along as the struct ``row``."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                    n_words(text_col).alias("size"),
                    *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []))
    sizes = d.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = targets(sizes, weights, max_repeats)
    src = src.withColumn("words", F.sum("source_size").over(Window.partitionBy()))
    block = F.greatest(F.lit(1), F.ceil(F.col("words") / (shards * blocks_per_shard))).cast("long")
    src = src.withColumn("block", block)
    src = src.join(shard_quotas(src, shards, F.col("block"), seed), "rank")
    key = ["_s", "_null"]  # a null source joins too

    def keyed(df):
        return df.withColumn("_s", F.coalesce("source", F.lit(""))).withColumn("_null", F.col("source").isNull())

    src = keyed(src).select(*key, "source_size", "target", "block", "cuts")

    # place in the source's stream: words of the hash ranges before, then within the range
    ranges = 8 * shuffle_partitions(docs.sparkSession)
    d = keyed(d).withColumn("_key", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))).withColumn(
        "_range", F.floor((F.col("_key") / F.lit(2.0 ** 64) + 0.5) * ranges).cast("int"))
    sums = d.groupBy(*key, "_range").agg(F.sum("size").alias("_sum"))
    w = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(w), F.lit(0))).drop("_sum").join(src, key)
    w = Window.partitionBy(*key, "_range").orderBy("_key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    d = (d.withColumn("_within", F.coalesce(F.sum("size").over(w), F.lit(0))).join(sums, [*key, "_range"])
         .withColumn("_at", F.col("_before") + F.col("_within"))
         .withColumn("_take", F.round("target").cast("long")))
    passes = F.expr(f"""filter(transform(sequence(0, {max_repeats - 1}), p -> named_struct('p', p,
        'lo', p * source_size + _at, 'hi', least(p * source_size + _at + size, _take))), x -> x.hi > x.lo)""")
    pieces = F.expr(f"""flatten(transform(_passes, x -> filter(transform(sequence(0, {shards - 1}), j -> named_struct(
        'shard', j, 'repeat', x.p,
        'from_word', greatest(x.lo, cuts[j] * block) - x.p * source_size - _at,
        'words', least(x.hi, cuts[j + 1] * block) - greatest(x.lo, cuts[j] * block),
        'order_key', xxhash64({seed}, doc_id, x.p, j))), y -> y.words > 0)))""")
    return d.withColumn("_passes", passes).withColumn("pieces", pieces).select(
        "doc_id", "source", "size", "source_size", "target", "pieces", *(["row"] if carry else []))


def mixed_documents(docs: DataFrame, text_col: str = "text", shards: int = 16, **options) -> DataFrame:
    """The mix itself: a row for each piece, with the columns of ``docs``; a
    document that a block ends in is cut there, one that is taken again is
    repeated.  A shard is dealt over several tasks by ranges of its order key,
    each range in order, so that a task stays small however large a shard is."""
    mix = mix_sources(docs, text_col=text_col, shards=shards, carry=docs.columns, **options)
    p = mix.select("size", "row", F.explode("pieces").alias("p"))
    space = r"\\x20\\x09-\\x0D"  # within a SQL string
    text = f"row.`{text_col}`"
    # words with the space behind them; what stands before the first word belongs to none
    cut = F.expr(f"""array_join(slice(split(regexp_replace({text}, '^[{space}]+', ''),
        '(?<=[{space}])(?=[^{space}])'), cast(p.from_word + 1 as int), cast(p.words as int)), '')""")
    text = F.when(F.col("p.words") == F.col("size"), F.expr(text)).otherwise(cut)
    tasks = shuffle_partitions(docs.sparkSession)
    ranges = -(-4 * tasks // shards)
    p = p.withColumn("part", F.floor((F.col("p.order_key") / F.lit(2.0 ** 64) + 0.5) * ranges))
    out = p.repartition(tasks, "p.shard", "part").sortWithinPartitions("p.shard", "part", "p.order_key")
    return out.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def taken() -> Column:
    """Words that the mix takes of a document, repeats counted."""
    return F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p.words)
