"""Integers in and out of binary columns, with built-in expressions only.

A binary column is turned into hex text once; a field is then a slice of that
text.  Byte offsets count from 0.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def be_uint(hex_text: Column, offset: int | Column, nbytes: int) -> Column:
    """Unsigned big-endian integer of ``nbytes`` at ``offset``; null past the end."""
    start = F.lit(offset) if isinstance(offset, int) else offset
    piece = F.substr(hex_text, start * 2 + 1, F.lit(nbytes * 2))
    return F.when(F.length(piece) == nbytes * 2, F.conv(piece, 16, 10)).cast("bigint")


def word(hex_text: Column, offset: int | Column) -> Column:
    """Eight bytes at ``offset`` as one long, so that several fields share a conversion."""
    start = F.lit(offset) if isinstance(offset, int) else offset
    return F.conv(F.substr(hex_text, start * 2 + 1, F.lit(16)), 16, -10).cast("bigint")


def field_of(word_column: Column, at: int, nbytes: int) -> Column:
    """Unsigned big-endian field of ``nbytes`` at byte ``at`` of an eight-byte word."""
    moved = F.shiftrightunsigned(word_column, 64 - 8 * (at + nbytes))
    return moved.bitwiseAND(F.lit((1 << 8 * nbytes) - 1).cast("bigint"))


def swap32(value: Column) -> Column:
    """An unsigned 32-bit value with its bytes in the other order (little-endian fields)."""
    parts = [F.shiftleft(F.shiftright(value, 8 * i).bitwiseAND(255), 24 - 8 * i) for i in range(4)]
    return parts[0].bitwiseOR(parts[1]).bitwiseOR(parts[2]).bitwiseOR(parts[3])


def be_hex(value: Column, nbytes: int) -> Column:
    """Hex text of an unsigned integer, big-endian, ``nbytes`` wide."""
    return F.lpad(F.hex(value.cast("bigint")), nbytes * 2, "0")


def bytes_of(*hex_parts: Column) -> Column:
    """Binary value of the joined hex texts."""
    return F.unhex(F.concat(*hex_parts))
