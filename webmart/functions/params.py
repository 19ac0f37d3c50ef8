"""Reading the repeated key/value record of an event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: The parameters that the mart reads.
PARAMS = ("ga_session_id", "page_location", "session_engaged", "engagement_time_msec")


def param_count(key: str) -> Column:
    """How often an event has a parameter; taking it out and comparing sizes stays in generated code."""
    keys = F.col("event_params.key")
    return F.coalesce(F.size(keys) - F.size(F.array_remove(keys, key)), F.lit(0))


def event_param(key: str, field: str, strict: bool = False) -> Column:
    """Value of the first parameter named ``key``; NULL when the event has none.

    ``strict`` ends the query where an event has it more than once.

    Finds the place of the key and reads the value there. Unlike a lambda filter this stays in generated code, and the
    scan reads only keys and values of the asked type.
    """
    place = F.array_position(F.col("event_params.key"), key).cast("int") - 1
    value = F.get(F.col(f"event_params.value.{field}"), place)
    if not strict:
        return value
    repeated = F.raise_error(F.concat(F.lit(f"parameter {key} repeats in an event of "), F.coalesce("user_pseudo_id", F.lit("nobody"))))
    return F.when(param_count(key) > 1, repeated).otherwise(value)
