"""A filter of keys that rows meet right after their scan, before any shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64
MARKS = 4


def _place(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _mask(key: Column) -> Column:
    """``MARKS`` bits of one word, cut six bits each from a second hash; some may coincide."""
    drawn = F.xxhash64(key, F.lit(1))
    marks = [F.lit(1).cast("bigint")] * MARKS
    for n in range(MARKS):
        at = F.shiftrightunsigned(drawn, 6 * n).bitwiseAND(F.lit(WORD - 1)).cast("int")
        marks[n] = F.call_function("shiftleft", marks[n], at)
    mask = marks[0]
    for mark in marks[1:]:
        mask = mask.bitwiseOR(mark)
    return mask


def key_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """A blocked Bloom filter of column ``key`` as one row with one array of longs, ``bits`` / 64 of them.

    A key marks bits of one word only, so a probe reads one long. Words are summed up where the keys are read; one task then puts
    the words, whose number is fixed, in order. Null keys are left out. Without keys all words are 0.
    """
    words = bits // WORD
    if words < 1:
        raise ValueError("a filter has at least one word")
    marked = keys.where(F.col(key).isNotNull()).select(_place(F.col(key), words).alias("word"), _mask(F.col(key)).alias("marks"))
    blank = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("marks"))
    each = marked.unionAll(blank).groupBy("word").agg(F.bit_or("marks").alias("marks"))
    return each.agg(F.sort_array(F.collect_list(F.struct("word", "marks")))["marks"].alias("words"))


def may_hold(filter_row: DataFrame, key: Column, bits: int) -> Column:
    """False only where :func:`key_filter` of the same ``bits`` was built without ``key``.

    The filter is a scalar subquery: nothing runs until the rows are read.
    """
    mask = _mask(key)
    return F.get(filter_row.scalar(), _place(key, bits // WORD).cast("int")).bitwiseAND(mask) == mask
