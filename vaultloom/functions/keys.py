"""Deterministic hash keys of one or more business columns.

Every column becomes ``<length>:<text>`` (``N`` for NULL) before hashing, so
NULL hashes to a normal value and ``('a|b','c')`` differs from ``('a','b|c')``.
``xxhash64`` would be cheaper but skips NULLs and has no portable counterpart.
"""

from __future__ import annotations

from collections.abc import Sequence

KEY_HEX_DIGITS = 15  # 60 bits: always a positive bigint

INT60, HEX128 = "int60", "hex128"
"""Kinds of key: a bigint of 60 bits, or 32 hex digits for warehouses beyond some 10^9 keys."""


def key_part(c: str) -> str:
    text = f"cast({c} as string)"
    return f"coalesce(concat(length({text}), ':', {text}), 'N')"


def float_input(c: str) -> str:
    """A double as a text that is defined here, since a cast's text depends on the JDK:
    sign, whole part, and the rest in units of 2**-62, which is exact from 2**-10 on.
    Both zeros are one, as joins and groupings have them. Values from 2**53 on, infinite
    ones and NaN have the cast's text."""
    whole = f"floor(abs({c}))"
    return (
        f"CASE WHEN abs({c}) < 9007199254740992D THEN concat(CASE WHEN {c} < 0D THEN '-' ELSE '' END, "
        f"cast({whole} as string), '+', cast(cast((abs({c}) - {whole}) * 4611686018427387904D as bigint) as string)) "
        f"ELSE cast({c} as string) END")


def hex_key(*columns: str) -> str:
    """128-bit key as 32 hex digits."""
    return f"md5(concat({', '.join(key_part(c) for c in columns)}))"


def hash_key(*columns: str, digits: int = KEY_HEX_DIGITS) -> str:
    """Bigint key over the columns.

    A digest is never NULL, but ``conv`` is declared nullable; the ``coalesce``
    says so to the planner, which would otherwise add a NULL test, and with it a
    second digest per row, below every join on the key.
    """
    key = f"cast(conv(substr({hex_key(*columns)}, 1, {digits}), 16, 10) as bigint)"
    return f"coalesce({key}, 0L)"


def key_of(kind: str, *columns: str) -> str:
    """The key of a kind over the columns."""
    if kind not in (INT60, HEX128):
        raise ValueError(f"unknown kind of key {kind!r}")
    return hash_key(*columns) if kind == INT60 else hex_key(*columns)


def digest_of(*columns: str) -> str:
    """128 bits of another hash than the keys', to tell apart what shares a key."""
    return f"substr(sha2(concat({', '.join(key_part(c) for c in columns)}), 256), 1, 32)"


def key_inputs(schema, columns: Sequence[str]) -> list[str]:
    """The columns as inputs of a key: floating ones by the text that is defined here."""
    return [float_input(c) if schema[c].dataType.typeName() in ("double", "float") else c for c in columns]
