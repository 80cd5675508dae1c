"""Integer expressions: the even test and an exact 32-bit wrapping sum."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of 32-bit two's-complement arithmetic.
INT32_MIN = -(2**31)
TWO_POW_32 = 2**32
LOW16_MASK = 0xFFFF
TWO_POW_16 = 2**16


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_even(x: Column | str) -> Column:
    """``x % 2 == 0``; the remainder keeps the dividend's sign, so -4 and 0 are even."""
    return (_col(x) % 2) == 0


def sum_wrap32(x: Column | str) -> Column:
    """Aggregate: the sum of 32-bit ints, wrapped to 32 bits as Java ``int`` does.

    The value is split into its low 16 bits (0..65535) and its signed high 16
    bits (-32768..32767) and each half is summed as a 64-bit long. Both sums stay
    exact for fewer than 2**47 rows, and 32-bit wrap commutes with addition, so
    the result does not depend on partitioning. Two long sums keep the partial
    aggregation in codegen (a DECIMAL(20,0) sum would take the BigDecimal path).
    NULLs are skipped; no rows gives NULL.
    """
    v = _col(x).cast("int")
    lo = F.sum(v.bitwiseAND(F.lit(LOW16_MASK)).cast("bigint"))
    hi = F.sum(F.shiftright(v, 16).cast("bigint"))
    low32 = lo + F.pmod(hi, F.lit(TWO_POW_16)) * F.lit(TWO_POW_16)
    return (F.pmod(low32 - F.lit(INT32_MIN), F.lit(TWO_POW_32)) + F.lit(INT32_MIN)).cast("int")
