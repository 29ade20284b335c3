"""Key → simulated Kafka partition, and key → record time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topiclake.schemas import KEY_PARTITIONS


def key_partition(key: Column | str, partitions: int = KEY_PARTITIONS) -> Column:
    """``abs(hash(key)) % n`` on a BIGINT key, as an INT.

    The key is cast to BIGINT first (Murmur3 of an INT differs from that of
    the same BIGINT value) and the 32-bit hash is widened before ``abs``: the
    INT ``abs(-2147483648)`` overflows under ANSI mode.  A NULL key hashes to
    the seed (42), i.e. partition 0.  This is *not* ``pmod``: a negative hash
    maps to ``abs(h) % n``.
    """
    k = F.col(key) if isinstance(key, str) else key
    h = F.hash(k.cast("bigint")).cast("bigint")
    return (F.abs(h) % F.lit(partitions)).cast("int")


def message_partition(key: Column | str, partitions: int = KEY_PARTITIONS) -> Column:
    """Partition of a message by its key's bytes (first 32 bits of their MD5), as an INT; NULL key → 0."""
    k = F.col(key) if isinstance(key, str) else key
    bits = F.conv(F.substring(F.md5(k.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(bits % F.lit(partitions), F.lit(0)).cast("int")


def key_time(key: Column | str) -> Column:
    """Record time simulated from the key: epoch + key seconds."""
    k = F.col(key) if isinstance(key, str) else key
    return F.timestamp_seconds(k.cast("bigint"))
