"""Set-containment join: ``sets.S ⊆ targets.items``.

No nested loops and no cross product.  Each set gets one join key: its rarest
item among the targets (per ``on`` group, e.g. per label), which bounds the
fan-out of popular items, and a 128-bit signature with one bit per item.  Targets
are exploded by item into narrow rows (row id, key, signature); the equi-join on
(on..., key) is a broadcast or sort-merge hash join chosen by AQE, a set's bits
must all be among the target's, and only what passes fetches the target's items,
where ``array_except`` verifies the containment.  Every target row meets a given
set at most once (one key per set), so counts over the result are exact.  A key
with more than ``ROWS_A_KEY`` target rows is salted: its target rows are dealt
into parts by a hash of the row id, its sets are repeated once for each part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emergent.session import reliable

#: Target rows of one join key that go to one part.  The table of hot keys, which is broadcast, has at most one
#: row for so many exploded target rows.
ROWS_A_KEY = 1_000_000


def rarest_item_keys(sets: DataFrame, set_col: str, targets: DataFrame, items_col: str,
                     on: Sequence[str] = ()) -> DataFrame:
    """(on..., set_col, _key, _freq): the set's item with the fewest target rows, ties by item."""
    on = list(on)
    freq = (targets.select(*on, F.explode(items_col).alias("_item"))
            .groupBy(*on, "_item").agg(F.count(F.lit(1)).alias("_freq")))
    distinct_sets = sets.select(*on, set_col).distinct()
    exploded = distinct_sets.select(*on, set_col, F.explode(set_col).alias("_item"))
    keyed = (exploded.join(freq, on + ["_item"], "left")
             .groupBy(*on, set_col)
             .agg(F.min(F.struct(F.coalesce(F.col("_freq"), F.lit(0)).alias("f"), F.col("_item").alias("i")))
                  .alias("_best")))
    return keyed.select(*on, set_col, F.col("_best.i").alias("_key"), F.col("_best.f").alias("_freq"))


def signature(items_col: str, half: int) -> Column:
    """Half of a set's 128-bit signature: a bit for each item whose hash falls there."""
    def bit(x: Column) -> Column:
        h = F.xxhash64(x)
        place = F.shiftright(h, 1).bitwiseAND(F.lit(63)).cast("int")
        return F.when(h.bitwiseAND(F.lit(1)) == half, F.call_function("shiftleft", F.lit(1).cast("bigint"), place)) \
            .otherwise(F.lit(0).cast("bigint"))

    return F.aggregate(items_col, F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseOR(bit(x)))


def containment_join(sets: DataFrame, set_col: str, targets: DataFrame, items_col: str,
                     on: Sequence[str] = (), rows_a_key: int | None = None,
                     target_key: Sequence[str] = ()) -> DataFrame:
    """Rows of ``sets`` x ``targets`` with equal ``on`` columns and ``set_col ⊆ items_col``.

    Column names of the two sides must be disjoint apart from ``on``.
    ``target_key`` names columns that tell the target rows apart; without them
    the targets are written with row numbers.
    """
    on = list(on)
    numbered = list(target_key) or ["_tid"]
    if not target_key:
        targets = reliable(targets.withColumn("_tid", F.monotonically_increasing_id()), "targets")
    parts = F.floor(F.col("_freq") / F.lit(rows_a_key or ROWS_A_KEY)).cast("int")
    keys = rarest_item_keys(sets, set_col, targets, items_col, on)
    sets_k = (sets.join(keys, on + [set_col])
              .withColumn("_s0", signature(set_col, 0)).withColumn("_s1", signature(set_col, 1))
              .withColumn("_part", F.explode(F.sequence(F.lit(0), parts))).drop("_freq"))
    salted = (keys.withColumn("_parts", parts).filter("_parts > 0")
              .groupBy(*on, "_key").agg(F.max("_parts").alias("_parts")))
    rest = [c for c in on if c not in numbered]
    narrow = (targets.select(*numbered, *rest, F.xxhash64(*numbered).alias("_h"), signature(items_col, 0).alias("_t0"),
                             signature(items_col, 1).alias("_t1"), F.col(items_col).alias("_items"))
              .select(*numbered, *rest, "_h", "_t0", "_t1", F.explode("_items").alias("_key")))
    narrow = (narrow.join(F.broadcast(salted), on + ["_key"], "left")
              .withColumn("_part", F.when(F.col("_parts").isNull(), F.lit(0))
                          .otherwise(F.pmod("_h", F.col("_parts") + 1).cast("int"))).drop("_h", "_parts"))
    met = (narrow.join(sets_k, on + ["_key", "_part"])
           .filter("_s0 & _t0 = _s0 AND _s1 & _t1 = _s1").drop("_s0", "_s1", "_t0", "_t1", "_key", "_part"))
    # Item lists are packed small on disk: their file size must not make them a broadcast.
    whole = targets.drop(*rest).hint("merge")
    return (met.join(whole, numbered).drop("_tid")
            .filter(F.size(F.array_except(F.col(set_col), F.col(items_col))) == 0))
