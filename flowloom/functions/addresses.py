"""IPv4 text and its unsigned integer form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_QUAD = r"^[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}$"


def ipv4_to_long(ip: Column) -> Column:
    """Unsigned value of a dotted quad; anything else, null included, is 0."""
    parts = F.split(ip, r"\.")
    octets = [parts[i].try_cast("bigint") for i in range(4)]
    value = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    valid = ip.rlike(_QUAD) & (F.greatest(*octets) <= 255)
    return F.when(valid, value).otherwise(F.lit(0).cast("bigint"))
