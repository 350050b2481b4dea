"""Filtering rows by a bitmap of hashed keys, before a join would shuffle all of them.

The bitmap has about `BITS_PER_KEY` bits for each key and `MOST_BITS` at most, so what is broadcast
has a fixed bound however many keys there are. Rows whose bit is not set have no key among the
given ones and need not travel to the join; a few others pass and are dropped there. With far more
keys than bits everything passes, which costs the shuffle but no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
MOST_BITS = 1 << 28
#: Bits of one bitmap of Spark's bitmap functions.
BUCKET_BITS = 1 << 15


def likely(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows whose `column` is in the one column of `keys`, and a few others. Runs a job that
    counts the keys, which should be written. Null keys are dropped."""
    key = keys.columns[0]
    wanted = max(BUCKET_BITS, min(MOST_BITS, BITS_PER_KEY * keys.count()))
    bits = 1 << (wanted - 1).bit_length()

    def place(name: str):
        return F.pmod(F.xxhash64(name), F.lit(bits)) + 1

    bitmaps = (
        keys.filter(F.col(key).isNotNull())
        .select(place(key).alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("__bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("__bits"))
    )
    bit = F.bitmap_bit_position(place(column))
    byte = F.substring("__bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    mask = F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), F.pmod(bit, F.lit(8)).cast("int") + 1)
    return (
        rows.withColumn("__bucket", F.bitmap_bucket_number(place(column)))
        .join(F.broadcast(bitmaps), "__bucket")
        .filter(number.bitwiseAND(mask) != 0)
        .select(*(f"`{c}`" for c in rows.columns))
    )
