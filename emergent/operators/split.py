"""Class assignment and hold-out splits.

``hash_split`` is the scalable default: a row's side depends only on the md5
of its key, so it needs no shuffle and gives the same answer in any engine and
under any partitioning.  ``exact_split`` reproduces an exact ``ceil(f * n)``
test size per class by distributed selection: histograms of the hash's digits
narrow to the class's threshold, then every row is flagged where it is scanned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emergent.session import reliable

# The source's status vocabulary.
POSITIVE_STATUS = ("Approved",)
NEGATIVE_STATUS = ("Terminated", "Withdrawn", "Suspended")
POSITIVE = "positive"
NEGATIVE = "negative"
TRAIN = "train"
TEST = "test"


def classify(assoc: DataFrame, status: str = "status",
             positive: Sequence[str] = POSITIVE_STATUS,
             negative: Sequence[str] = NEGATIVE_STATUS) -> DataFrame:
    """F1 / F2: keep positive and negative rows and tag them with ``class``."""
    pos, neg = list(positive), list(negative)
    return (assoc.filter(F.col(status).isin(pos + neg))
            .withColumn("class", F.when(F.col(status).isin(pos), F.lit(POSITIVE)).otherwise(F.lit(NEGATIVE))))


def hash_bucket(key: Column) -> Column:
    """First 32 bits of md5(key) as an integer, modulo 100."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % F.lit(100)


def hash_split(df: DataFrame, key: Column, test_percent: int = 20) -> DataFrame:
    """T1 (scalable): ``train`` iff the md5 bucket of the key is below 100 - test_percent."""
    return df.withColumn("split", F.when(hash_bucket(key) < F.lit(100 - test_percent), F.lit(TRAIN))
                         .otherwise(F.lit(TEST)))


#: Hexadecimal digits of the hash that one histogram resolves (65,536 counts a class), and digits in all.
DIGITS, WIDTH = 4, 32


def _thresholds(rows: DataFrame, class_col: str, test_fraction: float) -> list[tuple]:
    """Per class of ``rows(class, _h)`` the hash prefix that the last test row has: ``(class, prefix, need, size)``.

    ``need`` of the ``size`` rows with that prefix are test rows.  A round is one
    pass that shuffles counts only and narrows every open class by four digits;
    about log(rows) / log(65536) rounds are needed.
    """
    spark = rows.sparkSession
    class_type = rows.schema[class_col].dataType
    schema = T.StructType([T.StructField("_c", class_type), T.StructField("_pre", T.StringType()),
                           T.StructField("_need", T.LongType())])
    done: list[tuple] = []
    still = None
    for length in range(0, WIDTH, DIGITS):
        if still is None:
            met = rows.withColumn("_need", F.lit(None).cast("long"))
        else:
            known = F.broadcast(spark.createDataFrame([r[:3] for r in still], schema))    # a row per class
            met = rows.join(known, F.col(class_col).eqNullSafe(F.col("_c"))
                            & (F.substring("_h", 1, length) == F.col("_pre")))
        hist = met.groupBy(class_col, F.substring("_h", length + 1, DIGITS).alias("_p")).agg(
            F.count(F.lit(1)).alias("_n"), F.max("_need").alias("_need"))
        whole = Window.partitionBy(class_col)
        need = F.coalesce("_need", F.ceil(F.lit(test_fraction) * F.sum("_n").over(whole)))
        upto = F.sum("_n").over(whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        cross = (hist.withColumn("_k", need).withColumn("_upto", upto)
                 .filter("_upto >= _k AND _upto - _n < _k")
                 .select(F.col(class_col).alias("c"), "_p", (F.col("_k") - (F.col("_upto") - F.col("_n"))).alias("need"), "_n"))
        before = {r[0]: r[1] for r in still or []}
        found = [(r["c"], before.get(r["c"], "") + r["_p"], int(r["need"]), int(r["_n"])) for r in cross.collect()]
        done += [r for r in found if r[2] == r[3] or length + DIGITS == WIDTH]
        still = [r for r in found if r[2] < r[3]]
        if not still:
            break
    return done


def exact_split(df: DataFrame, order: Sequence[Column], class_col: str = "class",
                test_fraction: float = 0.2) -> DataFrame:
    """T1 (exact): per class, the first ``ceil(test_fraction * n)`` rows in ``order`` are ``test``.

    ``order`` begins with a hash of 32 hexadecimal digits; a row's side follows
    from comparing it with its class's threshold, so nothing is sorted or
    written.  Only where rows of one hash lie on both sides of it are those rows
    ranked by the rest of ``order``.  ``df`` is read once per round, so an
    expensive one should be a stored table.
    """
    spark = df.sparkSession
    bounds = _thresholds(df.select(class_col, order[0].alias("_h")), class_col, test_fraction)
    schema = T.StructType([T.StructField("_c", df.schema[class_col].dataType), T.StructField("_pre", T.StringType()),
                           T.StructField("_need", T.LongType()), T.StructField("_size", T.LongType())])
    known = F.broadcast(spark.createDataFrame(bounds, schema))     # a row per class
    placed = df.join(known, F.col(class_col).eqNullSafe(F.col("_c")), "left").withColumn(
        "_head", F.when(F.col("_pre").isNotNull(), F.substring(order[0], 1, F.length("_pre"))))
    tied = (F.col("_head") == F.col("_pre")) & (F.col("_need") < F.col("_size"))
    side = F.when(F.coalesce(F.col("_head") <= F.col("_pre"), F.lit(False)), F.lit(TEST)).otherwise(F.lit(TRAIN))
    if all(need == size for _, _, need, size in bounds):
        return placed.withColumn("split", side).drop(*schema.names, "_head")
    clear = placed.filter(~F.coalesce(tied, F.lit(False))).withColumn("split", side)
    return clear.unionByName(_ranked(placed.filter(tied), order[1:], class_col)).drop(*schema.names, "_head")


def _ranked(df: DataFrame, order: Sequence[Column], class_col: str) -> DataFrame:
    """The first ``_need`` rows of each class in ``order`` are ``test``: a range-partitioned sort and the
    partitions' offsets (a table of partitions x classes, which is what is broadcast)."""
    ranked = (df.orderBy(F.col(class_col), *order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranked = ranked.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_local", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    # The row ids are read twice (offsets and the join back); writing them once
    # to the shared folder keeps both reads identical even if a task reruns.
    ranked = reliable(ranked, "exact-split")
    per_part = ranked.groupBy("_pid", F.col(class_col).alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    w_before = Window.partitionBy("_k").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(F.col("_pid").alias("_p"), "_k", "_first",
                              F.coalesce(F.sum("_n").over(w_before), F.lit(0)).alias("_before"))
    rank = F.col("_before") + (F.col("_local") - F.col("_first")) + F.lit(1)
    out = ranked.join(F.broadcast(offsets), (F.col("_pid") == F.col("_p")) & F.col(class_col).eqNullSafe(F.col("_k")))
    return (out.withColumn("split", F.when(rank <= F.col("_need"), F.lit(TEST)).otherwise(F.lit(TRAIN)))
            .drop("_mid", "_pid", "_p", "_k", "_local", "_first", "_before"))


def class_counts(df: DataFrame, class_col: str = "class", split_col: str = "split") -> DataFrame:
    """Rows per class and split."""
    return df.groupBy(class_col, split_col).agg(F.count(F.lit(1)).alias("n_rows"))
