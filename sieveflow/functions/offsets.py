"""Offset units: bytes, code points and UTF-16 code units of a string column."""

from pyspark.sql import Column, functions as F

UNITS = ("utf16", "codepoint", "byte")


def measure(text: Column, unit: str) -> Column:
    """Length of `text` in `unit`."""
    if unit == "codepoint":
        n = F.length(text)
    elif unit == "byte":
        n = F.octet_length(text)
    elif unit == "utf16":
        # every code point is one unit, and those beyond the BMP (4 bytes in UTF-8) are two
        n = F.when(F.octet_length(text) == F.length(text), F.length(text)).otherwise(
            (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int"))
    else:
        raise ValueError(f"unknown offset unit {unit!r}, expected one of {UNITS}")
    return n.cast("bigint")


def convert_offset(text: Column, codepoint: Column, unit: str) -> Column:
    """A 0-based code-point offset of `text`, in another unit."""
    return measure(F.substring(text, F.lit(1), codepoint.cast("int")), unit)


def latin1_view(text: Column) -> Column:
    """One character per UTF-8 byte of `text`, so that string functions count bytes."""
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(
        F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"))


def char_index(byte_view: Column, byte: Column, unit: str = "utf16") -> Column:
    """Index of the character that holds 0-based `byte` of a :func:`latin1_view`.

    A 4-byte character is two UTF-16 units: bytes 0-1 give the first, bytes 2-3 the second.
    """
    if unit == "byte":
        return byte.cast("bigint")
    upto = F.substring(byte_view, F.lit(1), (byte + 1).cast("int"))
    started = F.length(F.regexp_replace(upto, r"[\x80-\xBF]", ""))
    if unit == "utf16":
        started = started + F.regexp_count(upto, F.lit(r"[\xF0-\xF4][\x80-\xBF]{2}"))
    return F.greatest(started - 1, F.lit(0)).cast("bigint")


def byte_to_char(text: Column, byte: Column, unit: str = "utf16") -> Column:
    """Index of the character of `text` that holds 0-based UTF-8 byte `byte`."""
    return char_index(latin1_view(text), byte, unit)


def inclusive_end(end_exclusive: Column) -> Column:
    """Exclusive to inclusive end; an empty match at 0 keeps end 0."""
    return F.greatest(end_exclusive - 1, F.lit(0).cast("bigint"))


def matched_text(text: Column, start_cp: Column, end_cp_exclusive: Column) -> Column:
    """The text between two code-point offsets."""
    return F.substring(text, (start_cp + 1).cast("int"), (end_cp_exclusive - start_cp).cast("int"))


def is_clean_utf8(data: Column) -> Column:
    """Is a binary column well-formed UTF-8?"""
    return F.is_valid_utf8(data.cast("string"))


def clean_utf8(data: Column) -> Column:
    """A binary column as text, malformed bytes replaced by U+FFFD."""
    return F.make_valid_utf8(data.cast("string"))
