"""Mixing sources to target weights by a hypergeometric splitting tree.

Sizes are words.  Sources, ordered by code point with null last, get weights
that repeat; together they are to give ``share`` of all words.  A source's
target stops at ``limit`` times its size; what is above is shared again by
weight, until none is above (one common rate per unit of weight).

A source's documents lie in blocks by the leading bits of a hash.  A target of
q whole sizes and a rest takes every block q times, and in one more pass the
blocks in order while they fit into the rest; the block in which the rest runs
out is refined bit by bit until it is small, and its documents are taken
largest first as they fit.  This is done for long documents first, those over
``LONG`` times the source's mean: they get their share of the rest, and at least what
the others cannot fill.  The others then fill what the long ones have left.  So no
document is taken more than ``limit`` times, and a source misses its target by less
than one document that is not long, unless its others are too few to fill the rest.

The output shards split the exact numbers of blocks that each source gives: a
tree halves the range of shards, each node draws how many of its blocks of
every source go left from the multivariate hypergeometric distribution, and a
node's random numbers follow from its range alone, so any task can walk to its
shards again.  Sources are split in groups of ``SOURCE_GROUP``, each by a tree of its
own that deals its blocks evenly, and a large group's shards in ranges: a task has the
sources of one group and the shards of one range.  A leaf holds, for each source, a run of the source's permuted
blocks; runs of different shards are disjoint.  Rows are shuffled inside
their shard by a hash.

Sources, documents, blocks and shards stay in Spark; the driver gets sums.

Null texts have size 0, null is a source of its own.  Very long texts are taken whole.  Rows with equal doc_id,
source and text are one unit: all are taken equally often.  Empty documents and
sources have size 0 and nothing is taken of them.  An empty table gives an
empty result.  Other columns are carried along by ``mix``, whatever their names (but
for a few that begin with two underscores), and not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvial.llm.common import materialize, table

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
LIMIT = 2.0
SEED = 20
BLOCK_WORDS = 50_000
MAX_BLOCK_BITS = 20
SHARD_WORDS = 2_000_000
#: A block in which a rest runs out is refined while it has more documents.
REST_UNITS = 2000
_REFINE_BITS = 8
#: A document is long in its source if it is longer than this many times the mean.
LONG = 8
#: Sources that one splitting tree deals, and blocks of a group for each range of shards.
#: The draws take at most 10^9 blocks: a source has at most (limit + 1) 2^20.
SOURCE_GROUP, RANGE_BLOCKS = 256, 4096


def sizes(docs: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, key) per row: words and a 64-bit hash of the row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        *more, "doc_id", F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.xxhash64(F.lit(SEED), "doc_id", "source", text).alias("key"))


def source_targets(sized: DataFrame, weights=WEIGHTS, share=SHARE, limit=LIMIT,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """(sid, source, source_size, target, passes, rest, bits) of every source."""
    ranged, _ = materialize(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .repartitionByRange(F.col("source").asc_nulls_last())
        .withColumn("part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # a row per partition
    offset = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (ranged.withColumn("nth", F.row_number().over(inside))
              .join(offset, F.col("part") == F.col("p"))
              .select((F.col("offset") + F.col("nth") - 1).cast("int").alias("sid"), "source", "source_size")
              .withColumn("weight", F.element_at(weight, F.col("sid") % len(weights) + 1)))
    ranked, _ = materialize(ranked, "mix-ranked")
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    rate, stopped = 0.0, -1
    while True:   # the rate rises until no further source stops at its limit
        at_limit = F.col("weight") * rate >= F.col("source_size") * limit
        row = ranked.agg(F.sum(F.when(at_limit, F.col("source_size") * limit)),
                         F.sum(F.when(~at_limit, F.col("weight"))), F.count_if(at_limit)).first()
        if row[2] == stopped or not row[1]:
            break
        rate, stopped = (total - (row[0] or 0.0)) / row[1], row[2]
    target = F.least(F.col("weight") * rate, F.col("source_size") * limit)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    bits = F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("source_size") / block_words)))
    return (ranked.withColumn("target", F.when(F.col("source_size") > 0, target).otherwise(0.0))
            .withColumn("passes", passes.cast("long"))
            .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
            .withColumn("bits", F.least(bits, F.lit(MAX_BLOCK_BITS)).cast("int")).drop("weight"))


def _lead(bits: str) -> Column:
    """The leading ``bits`` bits of key."""
    return F.expr(f"CASE WHEN ({bits}) <= 0 THEN 0L ELSE shiftrightunsigned(key, 64 - ({bits})) END")


def _run_out(groups: DataFrame, rest: DataFrame) -> DataFrame:
    """(rid, edge, room): the group in which a source's rest runs out and what
    is left for it; sources whose rest takes nothing or everything are absent.

    groups: (sid, lead, words), at most 2^MAX_BLOCK_BITS rows per source.
    """
    upto = Window.partitionBy("sid").orderBy("lead")
    return (groups.join(rest, F.col("sid") == F.col("rid"))
            .withColumn("upto", F.sum("words").over(upto))
            .where((F.col("upto") > F.col("room")) & (F.col("upto") - F.col("words") <= F.col("room")))
            .select("rid", F.col("lead").alias("edge"), (F.col("room") - F.col("upto") + F.col("words")).alias("room")))


def _fit_rest(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """Documents of a small group that fit into the room, largest first; one
    more if that comes nearer."""
    pdf = pdf.sort_values(["words", "key"], ascending=[False, True])
    room, taken = float(pdf["room"].iloc[0]), np.zeros(len(pdf), bool)
    words = pdf["words"].to_numpy()
    for i, w in enumerate(words):
        if 0 < w <= room:
            taken[i], room = True, room - w
    over = np.where(taken | (words == 0), np.inf, np.abs(words - room))
    if len(over) and over.min() < room:
        taken[int(over.argmin())] = True
    return pdf.loc[taken, ["sid", "key", "size"]]


def _last_pass(units: DataFrame, rest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What one more pass over the units of some sources takes.

    units: (sid, key, size, words, bits, block); rest: (rid, room), room > 0.
    Returns (sid, key, size) of the units taken, and (rid, last): the last block
    that any of them lies in, the first being 0.
    """
    own = units.join(rest.select(F.col("rid").alias("own")), F.col("sid") == F.col("own"), "left_semi")
    edge, _ = materialize(_run_out(
        own.groupBy("sid", F.col("block").alias("lead")).agg(F.sum("words").alias("words")), rest), "mix-edge")
    near, extra = edge, 0
    while True:
        inside = own.join(near, (F.col("sid") == F.col("rid")) & (_lead(f"bits + {extra}") == F.col("edge")))
        most = inside.groupBy("sid").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= REST_UNITS or extra + _REFINE_BITS + MAX_BLOCK_BITS > 60:
            break
        # blocks before the edge, at this depth, are taken: their words leave the room
        finer = inside.select("sid", _lead(f"bits + {extra + _REFINE_BITS}").alias("lead"), "words") \
            .groupBy("sid", "lead").agg(F.sum("words").alias("words"))
        near, _ = materialize(_run_out(finer, near.select("rid", "room")), "mix-finer")
        extra += _REFINE_BITS
    fitted = inside.groupBy("sid").applyInPandas(_fit_rest, "sid int, key long, size long")
    cut = near.select(F.col("rid").alias("nid"), F.col("edge").alias("cut"))
    before = (own.join(cut, F.col("sid") == F.col("nid"), "left")
              # a rest that takes everything has no edge
              .where(F.col("cut").isNull() | (_lead(f"bits + {extra}") < F.col("cut"))).select("sid", "key", "size"))
    taken, _ = materialize(before.unionByName(fitted), "mix-rest")
    bits = units.select("sid", "key", "size", "block")
    last = (taken.join(bits, ["sid", "key", "size"]).groupBy(F.col("sid").alias("rid"))
            .agg(F.max("block").alias("last")))
    return taken, last


def draws(sized: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the mix takes: units (sid, key, size, block, copies) and blocks
    (sid, bits, number of blocks drawn)."""
    mean = sized.groupBy("source").agg(F.avg("size").alias("mean")).withColumnRenamed("source", "of_mean")
    known = sources.join(mean, F.col("source").eqNullSafe(F.col("of_mean"))).drop("of_mean")
    units, _ = materialize(
        sized.join(known.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .groupBy("sid", "key", "size", "bits", "passes", "mean")
        .agg(F.sum("size").alias("words")).withColumn("block", _lead("bits"))
        .withColumn("long", F.col("words") > LONG * F.col("mean")).drop("mean"), "mix-units")
    by_class = units.groupBy("sid").agg(
        F.sum(F.when(F.col("long"), F.col("words")).otherwise(0)).alias("long_words"), F.sum("words").alias("all_words"))
    rooms, _ = materialize(
        sources.where("rest > 0").join(by_class, "sid").select(
            F.col("sid").alias("rid"), "rest",
            # the long documents' share, or what the others cannot fill
            F.greatest(F.col("rest") * F.col("long_words") / F.col("all_words"),
                       F.col("rest") - (F.col("all_words") - F.col("long_words"))).alias("long_room")), "mix-rooms")
    long_taken, long_last = _last_pass(
        units.where("long"), rooms.where("long_room > 0").select("rid", F.col("long_room").alias("room")))
    filled = long_taken.join(units.select("sid", "key", "size", "words"), ["sid", "key", "size"]) \
        .groupBy("sid").agg(F.sum("words").alias("filled"))
    small_rooms = rooms.join(filled, F.col("rid") == F.col("sid"), "left").select(
        "rid", (F.col("rest") - F.coalesce("filled", F.lit(0))).alias("room")).where("room > 0")
    small_rooms, _ = materialize(small_rooms, "mix-small-rooms")
    small_taken, small_last = _last_pass(units.where(~F.col("long")), small_rooms)
    again = long_taken.unionByName(small_taken).withColumn("again", F.lit(1))
    taken = units.join(again, ["sid", "key", "size"], "left").select(
        "sid", "key", "size", "block", (F.col("passes") + F.coalesce("again", F.lit(0))).alias("copies"))
    last = long_last.unionByName(small_last).groupBy("rid").agg(F.max("last").alias("last"))
    blocks = sources.join(last, F.col("sid") == F.col("rid"), "left").select(
        "sid", "bits", F.expr("passes * shiftleft(1L, bits) + coalesce(last + 1, 0)").alias("blocks"))
    return taken, blocks


def split(counts: np.ndarray, lo: int, hi: int, seed: list[int]) -> np.ndarray:
    """Blocks of every source that the left half of shards [lo, hi) gets."""
    mid = (lo + hi) // 2
    rng = np.random.default_rng([*seed, lo, hi])
    left = int(counts.sum()) * (mid - lo) // (hi - lo)
    return rng.multivariate_hypergeometric(counts, left, method="marginals")


def leaves(counts: np.ndarray, shards: int, first: int, stop: int, seed: list[int]
           ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, first block, number of blocks) per source of shards first .. stop - 1
    that get any block."""
    todo = [(0, shards, np.zeros_like(counts), counts)]
    while todo:
        lo, hi, start, have = todo.pop()
        if hi <= first or lo >= stop or not have.any():
            continue
        if hi - lo == 1:
            yield lo, start, have
            continue
        mid, left = (lo + hi) // 2, split(have, lo, hi, seed)
        todo += [(mid, hi, start + left, have - left), (lo, mid, start, left)]


def block_shards(blocks: DataFrame, shards: int) -> DataFrame:
    """(bid, nth, shard): where the nth block drawn of each source goes.

    A group's rows go to a task for each of its ranges of shards: as many
    ranges as its number of blocks asks for.
    """
    drawn = blocks.where("blocks > 0").withColumn("group", F.expr(f"sid div {SOURCE_GROUP}"))
    ranges = F.least(F.lit(shards).cast("long"), F.ceil(F.col("group_blocks") / RANGE_BLOCKS))
    size = drawn.groupBy("group").agg(F.sum("blocks").alias("group_blocks")).withColumn("ranges", ranges)
    met = drawn.join(size, "group").withColumn("range", F.explode(F.expr("sequence(0L, ranges - 1)")))

    def runs(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("sid")
        ids, counts, n = pdf["sid"].to_numpy(np.int32), pdf["blocks"].to_numpy(np.int64), int(pdf["ranges"].iloc[0])
        lo, hi = int(key[1]) * shards // n, (int(key[1]) + 1) * shards // n
        out = [(ids[has], start[has], taken[has], np.full(int(has.sum()), shard))
               for shard, start, taken in leaves(counts, shards, lo, hi, [SEED, int(key[0])])
               for has in (taken > 0,)]
        columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], [], []]
        return pd.DataFrame(dict(zip(("bid", "start", "n", "shard"), columns)))

    of_rank = (met.groupBy("group", "range").applyInPandas(runs, "bid int, start long, n long, shard long")
               .select("bid", F.explode(F.expr("sequence(start, start + n - 1)")).alias("rank"), "shard"))
    # permute each source's blocks; at most a few million per source
    order = Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(SEED + 1), "sid", "nth"), "nth")
    ranked = (blocks.where("blocks > 0")
              .select("sid", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("nth"))
              .withColumn("rank", F.row_number().over(order) - 1))
    return ranked.join(of_rank.withColumnRenamed("rank", "at"),
                       (F.col("sid") == F.col("bid")) & (F.col("rank") == F.col("at"))) \
        .select("bid", "nth", "shard")


def placements(sized: DataFrame, sources: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(sid, key, size, copy, shard, position): each taken copy of each unit, the
    shard it goes to and the hash by which its shard is shuffled."""
    taken, blocks = draws(sized, sources)
    taken, _ = materialize(taken.where("copies > 0"), "mix-taken")
    blocks, _ = materialize(blocks, "mix-blocks")
    words = sources.agg(F.sum("target")).first()[0] or 0.0
    n_blocks = blocks.agg(F.sum("blocks")).first()[0] or 0
    shards = max(1, min(int(words // shard_words) + 1, int(n_blocks)))
    to, _ = materialize(block_shards(blocks, shards), "mix-shards")
    bits = blocks.select(F.col("sid").alias("b_sid"), "bits")
    return (taken.join(bits, F.col("sid") == F.col("b_sid"))
            .withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
            .withColumn("drawn", F.expr("copy * shiftleft(1L, bits) + block"))
            .join(to, (F.col("sid") == F.col("bid")) & (F.col("drawn") == F.col("nth")))
            .select("sid", "key", "size", "copy", "shard",
                    F.xxhash64(F.lit(SEED + 2), "shard", "key", "copy").alias("position")))


def mix_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row of ``docs``."""
    sized, _ = materialize(sizes(docs), "mix-sizes")
    sources, _ = materialize(source_targets(sized), "mix-targets")
    count, _ = materialize(
        placements(sized, sources).groupBy("sid", "key", "size").agg(F.count("*").alias("copies"))
        .select(F.col("sid").alias("psid"), F.col("key").alias("pkey"), F.col("size").alias("psize"), "copies"),
        "mix-copies")
    return (sized.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
            .join(count, (F.col("sid") == F.col("psid")) & (F.col("key") == F.col("pkey"))
                  & (F.col("size") == F.col("psize")), "left")
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.coalesce("copies", F.lit(0))).cast("long").alias("taken")))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed rows, with the columns of ``docs``: each as often as it is
    taken, together by shard, in the shard's shuffled order."""
    columns = docs.columns
    sized, _ = materialize(sizes(docs), "mix-sizes")
    sources, _ = materialize(source_targets(sized), "mix-targets")
    where, _ = materialize(
        placements(sized, sources).where("size > 0").select(
            F.col("key").alias("__key"), F.col("size").alias("__size"), "shard", "position")
        .withColumnRenamed("shard", "__shard").withColumnRenamed("position", "__position"), "mix-places")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumn("__of", F.xxhash64(F.lit(SEED), "doc_id", "source", text))
    return (keyed.join(where, F.col("__of") == F.col("__key"))
            .repartition("__shard").sortWithinPartitions("__shard", "__position").select(*columns))


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))
