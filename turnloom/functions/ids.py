"""Content-derived identifiers (name-based UUIDs, version 5) without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The RFC 4122 name spaces.
NAMESPACE_DNS = "6ba7b8109dad11d180b400c04fd430c8"
NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace_hex: str = NAMESPACE_DNS) -> Column:
    """RFC 4122 version-5 UUID of ``name``; null in, null out."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))
    nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
    variant = F.substring(F.lit("89ab"), nibble % 4 + 1, F.lit(1))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
    )


def group_id(date_text: Column, channel: Column, time_text: Column, text: Column) -> Column:
    """Identifier of a clip group: the date is written with a midnight time."""
    return uuid5(F.concat_ws("|", F.concat(date_text, F.lit(" 00:00:00")), channel, time_text, text))


def program_id(date_text: Column, channel: Column, start: Column, end: Column) -> Column:
    """Identifier of a programme slot, or of the channel day where no slot is known."""
    return uuid5(
        F.when(start.isNotNull(), F.concat_ws("|", date_text, channel, start, end)).otherwise(
            F.concat_ws("|", date_text, channel)
        )
    )


def child_id(parent: Column, index: Column) -> Column:
    """Identifier of the ``index``-th segment or turn of a group."""
    return uuid5(F.concat_ws("|", parent, index.cast("string")))


def blocked_id(parent: Column, stage: str = "attribute") -> Column:
    return uuid5(F.concat(F.lit(f"blocked-{stage}::"), parent), NAMESPACE_URL)


def random_id() -> Column:
    """A random (version 4) UUID for rows that have no content to name them by; differs from run to run."""
    return F.uuid()
