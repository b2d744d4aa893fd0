"""SimHash fingerprints and their blocks as plain columns."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 64
_LANES = 32  # bit i and bit i + 32 of a hash are counted in the two halves of one long
_BOTH = (1 << 32) | 1


def lane_sums(hash_: Column, weight: Column | None = None) -> list[Column]:
    """Aggregates that count, for each bit, the hashes that have it set, two bits in each long.

    Each half counts up to 2**30 hashes.
    """
    lanes = [F.shiftrightunsigned(hash_, i).bitwiseAND(F.lit(_BOTH)) for i in range(_LANES)]
    return [F.sum(lane if weight is None else lane * weight).alias(f"_lane{i}") for i, lane in enumerate(lanes)]


def from_lanes(total: Column) -> Column:
    """The fingerprint: a bit is set where more than half of ``total`` hashes set it."""
    half = F.shiftrightunsigned(total.cast("long"), 1)
    # a guard bit above each half's threshold is gone after the subtraction where the count is larger
    bar = F.shiftleft(half, 32).bitwiseOR(half).bitwiseOR(F.lit((1 << 62) | (1 << 31)))
    bits = F.lit(0).cast("long")
    for i in range(_LANES):
        over = F.bitwise_not(bar - F.col(f"_lane{i}"))
        low = F.shiftrightunsigned(over, 31).bitwiseAND(F.lit(1).cast("long"))
        high = F.shiftrightunsigned(over, 62).bitwiseAND(F.lit(1).cast("long"))
        bits = bits.bitwiseOR(F.shiftleft(low.bitwiseOR(F.shiftleft(high, 32)), i))
    return bits


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def block_keys(fingerprint: Column, blocks: int, radius: int, *salt: Column) -> Column:
    """An array of keys, of which fingerprints within ``radius`` share at least one.

    The bits are cut into ``blocks``; at most ``radius`` of them can differ, so the others agree, and each choice of
    blocks - radius blocks is a key. More blocks make keys longer and more: the guarantee is the same.
    """
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = 0
        for c in chosen:
            mask |= (1 << edges[c + 1]) - (1 << edges[c])
        mask -= (1 << 64) if mask >= 1 << 63 else 0
        keys.append(F.xxhash64(F.lit(n), *salt, fingerprint.bitwiseAND(F.lit(mask).cast("long"))))
    return F.array(*keys)
