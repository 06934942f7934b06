"""Line hashes and the packed forms in which metadata travels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltworks.functions.binding import let
from siltworks.functions.text import normalize_for_dedup


def text_hash(col: Column) -> Column:
    """First 8 bytes of SHA-1 as 16 hex digits (an unsigned 64-bit value does not fit bigint)."""
    return F.substring(F.sha1(F.encode(col, "UTF-8")), 1, 16)


def text_hash_32(col: Column) -> Column:
    """First 4 bytes of SHA-1 as 8 hex digits, of the text as it is."""
    return F.substring(F.sha1(F.encode(col, "UTF-8")), 1, 8)


def line_hash(col: Column) -> Column:
    """``text_hash`` of the line normalized for deduplication."""
    return text_hash(normalize_for_dedup(col))


def plain_base64(data: Column) -> Column:
    """Base64 without the line breaks that Spark puts after 76 characters."""
    return F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))


def encode_hashes(hashes: Column) -> Column:
    """An array of hex hashes as base64 of their bytes."""
    return plain_base64(F.unhex(F.array_join(hashes, "")))


def decode_hashes(packed: Column, digits: int = 8) -> Column:
    """The hex hashes, ``digits`` each, of a base64 string."""

    def cut(text: Column) -> Column:
        steps = F.sequence(F.lit(0), F.floor(F.length(text) / digits).cast("int") - 1)
        parts = F.transform(steps, lambda i: F.substring(text, i * digits + 1, F.lit(digits)))
        return F.when(F.length(text) >= digits, parts).otherwise(F.array().cast("array<string>"))

    return let(F.lower(F.hex(F.unbase64(packed))), cut)


def encode_line_ids(ids: Column) -> Column:
    """Line numbers as base64 of little-endian unsigned 16-bit values; null for null, empty for none."""

    def pair(i):
        digits = F.lpad(F.lower(F.hex(i.cast("bigint"))), 4, "0")
        return F.concat(F.substring(digits, 3, 2), F.substring(digits, 1, 2))

    return plain_base64(F.unhex(F.array_join(F.transform(ids, pair), "")))


def decode_line_ids(packed: Column) -> Column:
    """The unsigned line numbers of ``encode_line_ids``; an odd last byte is dropped, bad base64 gives null."""

    def unpack(text: Column) -> Column:
        count = F.floor(F.length(text) / 4).cast("int")

        def number(i: Column) -> Column:
            pair = F.substring(text, i * 4 + 1, F.lit(4))
            return F.conv(F.concat(F.substring(pair, 3, 2), F.substring(pair, 1, 2)), 16, 10).cast("int")

        some = F.transform(F.sequence(F.lit(0), count - 1), number)
        return F.when(text.isNull(), None).when(count > 0, some).otherwise(F.array().cast("array<int>"))

    return let(F.hex(F.try_to_binary(packed, F.lit("base64"))), unpack)


def document_key(digest: Column) -> Column:
    """First 4 bytes of a ``sha1:`` base32 digest as 8 hex digits, worked out from its first seven characters."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    body = F.upper(F.regexp_replace(digest, "^sha1:", ""))
    total = F.lit(0).cast("bigint")
    for i in range(7):
        value = (F.instr(F.lit(alphabet), F.substring(body, i + 1, 1)) - 1).cast("bigint")
        total = total * 32 + value
    key = F.lower(F.lpad(F.hex(F.shiftright(total, 3)), 8, "0"))
    return F.when(body.rlike("^[A-Z2-7]{7}"), key)
