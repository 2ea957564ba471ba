"""What partition a producer gives a key, as expressions: CRC-32 and the murmur2 of the Java client."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MASK = 4294967295
# Multiplier and seed of murmur2.
_M, _SEED = 1540483477, 2538058380


def crc32_partition(key: Column, partitions: int) -> Column:
    return (F.crc32(F.encode(key, "UTF-8")) % partitions).cast("int")


def murmur2(key: Column) -> Column:
    """The 32-bit hash of the key's UTF-8 bytes, unsigned in a long. Products stay below 2**63."""
    mask, m = F.lit(_MASK).cast("long"), F.lit(_M).cast("long")
    hexed = F.hex(F.encode(key, "UTF-8"))
    n = F.octet_length(key)
    byte = lambda at: F.coalesce(F.conv(F.substring(hexed, at * 2 + 1, F.lit(2)), 16, 10).cast("long"), F.lit(0).cast("long"))
    word = lambda at: sum((F.when(at + j < n, F.shiftleft(byte(at + j), 8 * j)).otherwise(F.lit(0).cast("long")) for j in range(4)), F.lit(0).cast("long"))
    times = lambda x: (x * m).bitwiseAND(mask)

    def mixed(x: Column) -> Column:
        x = times(x)
        return times(x.bitwiseXOR(F.shiftright(x, 24)))

    start = F.lit(_SEED).cast("long").bitwiseXOR(n.cast("long")).bitwiseAND(mask)
    whole = F.floor(n / 4).cast("int")
    words = F.when(whole > 0, F.sequence(F.lit(0), whole - 1)).otherwise(F.array().cast("array<int>"))
    h = F.aggregate(words, start, lambda h, i: times(h).bitwiseXOR(mixed(word(i * 4))))
    tail = F.when(n % 4 == 0, h).otherwise(times(h.bitwiseXOR(word(whole * 4))))
    end = times(tail.bitwiseXOR(F.shiftright(tail, 13)))
    return end.bitwiseXOR(F.shiftright(end, 15))


def murmur2_partition(key: Column, partitions: int) -> Column:
    return (murmur2(key).bitwiseAND(F.lit(2147483647)) % partitions).cast("int")
