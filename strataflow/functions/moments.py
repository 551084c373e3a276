"""A time and an id as one decimal, so that first and last rows are minima and maxima of fixed width.

Spark aggregates a struct by sorting; a decimal is updated in place in a hash table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
#: Ids take the last 20 digits (their 64 bits, shifted to be positive; 0 stands for none), microseconds the others.
_IDS = Decimal(10**20)
_SHIFT = Decimal(2**63 + 1)
#: Microseconds before any time: no time comes first, as nulls do in Spark's order.
_NEVER = -(9 * 10**17)


def moment(time: Column | str, row_id: Column | str) -> Column:
    """Ordered like (time, id), nulls first; a decimal(38,0)."""
    time = F.col(time) if isinstance(time, str) else time
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    micros = F.coalesce(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), time), F.lit(_NEVER))
    place = F.coalesce(row_id.cast("decimal(20,0)") + F.lit(_SHIFT), F.lit(Decimal(0)))
    return (micros.cast("decimal(18,0)") * F.lit(_IDS) + place).cast("decimal(38,0)")


def time_of(packed: Column, kind: T.DataType) -> Column:
    """The time of a moment, in the type it came from."""
    micros = F.floor(packed / F.lit(_IDS).cast("decimal(21,0)")).cast("bigint")
    known = F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH)).cast(kind)
    return F.when(micros > _NEVER, known)
