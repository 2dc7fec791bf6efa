"""User identity of raw documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IDENTITY_SLOTS = 10  # fixed value: entries of all_identities that are looked at


def numeric_user_id(doc: Column) -> Column:
    """``profile.identity`` when it is all digits, else the first all-digit entry among the
    first ten of ``profile.all_identities``, else null. E-mail and phone never qualify."""
    own = F.try_variant_get(doc, "$.profile.identity", "string")
    others = F.slice(
        F.try_variant_get(doc, "$.profile.all_identities", "array<string>"), 1, IDENTITY_SLOTS
    )
    digits = r"^[0-9]+\z"
    return F.coalesce(
        F.when(own.rlike(digits), own),
        F.get(F.filter(others, lambda x: x.rlike(digits)), F.lit(0)),
    )
