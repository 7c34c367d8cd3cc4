"""Keys computed from the business key alone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Field separator, and the mark that keeps (null, 'a') apart from ('a', null).
FIELD_SEP = "\u0001"
NULL_MARK = "\u0002"


def hash_key(namespace: str, *business_key: Column | str) -> Column:
    """String surrogate key: the same member gets the same key in every run and on every executor,

    so a retried task cannot hand out a second key and staging can derive it without a join.
    """
    fields = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARK)) for c in business_key]
    return F.sha2(F.concat_ws(FIELD_SEP, F.lit(namespace), *fields), 256)
