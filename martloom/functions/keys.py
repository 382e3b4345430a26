"""Deterministic keys and change fingerprints."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_SEPARATOR = "_"
DIFF_SEPARATOR = "|"
# What a missing value reads as inside a fingerprint.
MISSING = "None"


def _any_null(cols: tuple[Column, ...]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def uuid5(*parts: Column, namespace: uuid.UUID = uuid.NAMESPACE_DNS) -> Column:
    """RFC 4122 version-5 UUID of the underscore-joined parts, equal to Python's ``uuid.uuid5``.

    Null when any part is null: a missing business key must not become a shared key. The digest is computed once and read six
    times in the plan, so keys of keys (links over hubs) are made in a projection of their own.
    """
    name = F.concat(*[x for p in parts for x in (F.lit(NAME_SEPARATOR), p.cast("string"))][1:])
    return _uuid5_text(F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), name.cast("binary"))))


def _uuid5_text(digest: Column) -> Column:
    # The variant digit keeps its two low bits under the fixed high bits 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


_UUID = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"


def packed(text: Column) -> Column:
    """A text key in as few bytes as it can be told apart by: 17 for a UUID in small letters, one more than its own for any other.

    For rows that are shuffled or compared by their keys; ``unpacked`` gives the text back.
    """
    other = F.concat(F.lit(bytes([0])), text.cast("binary"))
    return F.when(text.rlike(_UUID), F.concat(F.lit(bytes([1])), F.unhex(F.replace(text, F.lit("-"), F.lit(""))))).otherwise(other)


def unpacked(key: Column) -> Column:
    rest = F.substring(key, 2, 2**31 - 1)
    dashed = F.regexp_replace(F.lower(F.hex(rest)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(F.substring(key, 1, 1) == F.lit(bytes([1])), dashed).otherwise(rest.cast("string"))


def hash_key(*cols: Column, algo: str = "xxhash64") -> Column:
    """Key of one or more business-key columns; null when any of them is null.

    ``xxhash64`` is a compact bigint for dimensions up to some hundred million keys (beyond,
    64 bits collide); ``sha256`` and ``uuid5`` serve any number. These two join the parts by an underscore, so parts that may
    hold one need ``sha256_framed``, which puts each part's length before it.
    """
    if algo == "uuid5":
        return uuid5(*cols)
    # Over the text of the parts, so that an int and a bigint of one value give one key.
    parts = [c.cast("string") for c in cols]
    if algo == "xxhash64":
        key = F.xxhash64(*parts)
    elif algo == "sha256":
        # Null by itself when a part is null: a test of the parts would compute the hashes inside a key of keys again.
        return F.sha2(F.concat(*[x for p in parts for x in (F.lit(NAME_SEPARATOR), p)][1:]), 256)
    elif algo == "sha256_framed":
        framed = [x for p in parts for x in (F.char_length(p).cast("string"), F.lit(":"), p)]
        key = F.sha2(F.concat(*framed), 256)
    else:
        raise ValueError(f"unknown key algorithm: {algo}")
    return F.when(~_any_null(cols), key)


def hash_diff(*cols: Column) -> Column:
    """Fingerprint of descriptive columns: version-5 UUID of the sha-256 of the pipe-joined values.

    Pass numbers as the text they arrived in, for a double has more than one spelling.
    """
    joined = F.concat_ws(DIFF_SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(MISSING)) for c in cols])
    return uuid5(F.sha2(joined, 256))
