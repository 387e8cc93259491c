"""Deterministic keys: hashes and name-based UUIDs, without UDFs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, functions as F

_SEPARATOR = "|"


def _joined(columns: tuple[Column, ...]) -> Column:
    """One text for several values. Each part carries its length, so that ("a|b", "c") and ("a", "b|c") differ;
    a single value stands as it is. A null is `-`, which no length prefix equals."""
    parts = [c.cast("string") for c in columns]
    if len(parts) == 1:
        return parts[0]
    sized = [F.coalesce(F.concat(F.char_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.concat_ws(_SEPARATOR, *sized)


def hash_key(*columns: Column, method: str = "md5") -> Column:
    """Key of one or more business values; null when any of them is null.

    `md5` (128 bit) is the default: a 64-bit hash is expected to collide at a
    few billion keys. `xxhash64` gives a bigint for smaller sets.
    """
    complete = F.lit(True)
    for c in columns:
        complete = complete & c.isNotNull()
    if method == "md5":
        value = F.md5(_joined(columns))
    elif method == "xxhash64":
        value = F.xxhash64(_joined(columns))
    else:
        raise ValueError(f"unknown hash method: {method}")
    return F.when(complete, value)


def uuid3(c: Column, namespace: uuid.UUID = uuid.NAMESPACE_DNS) -> Column:
    """RFC 4122 version 3 UUID of a string, as 36 characters of text."""
    digest = F.md5(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(c.cast("string"), "UTF-8")))

    def dashed(d: Column) -> Column:
        # the variant nibble keeps its low two bits below the fixed bits 10
        variant = F.translate(F.substring(d, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
        return F.concat(
            F.substring(d, 1, 8), F.lit("-"), F.substring(d, 9, 4), F.lit("-3"),
            F.substring(d, 14, 3), F.lit("-"), variant, F.substring(d, 18, 3),
            F.lit("-"), F.substring(d, 21, 12),
        )

    # the digest stands in the expression once: written out per part, a key of keys in a filter or a lambda is hashed dozens of times
    return F.get(F.transform(F.array(digest), dashed), F.lit(0))


def hashdiff(*columns: Column) -> Column:
    """Version 3 UUID over key and attributes; a null differs from empty text."""
    return uuid3(_joined(columns))
