"""Recipients as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.functions.addresses import parse_address_list

ROLES = ("to", "cc", "bcc")


def explode_recipients(df: DataFrame, key: str, **headers: str) -> DataFrame:
    """(key, role, pos, address) from raw header columns named per role."""
    lists = F.array(
        *[
            F.struct(F.lit(role).alias("role"), parse_address_list(F.col(headers[role])).alias("list"))
            for role in ROLES
            if role in headers
        ]
    )
    by_role = df.select(key, F.inline(lists))
    return by_role.select(key, "role", F.posexplode("list").alias("pos", "address"))
