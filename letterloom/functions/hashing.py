"""Keyed hashes of addresses and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHA512_BLOCK = 128


def _xor_pad(key: Column, mask: int) -> Column:
    """A 128-byte key, every byte XOR-ed with ``mask``.

    The key is read as Latin-1 so that one character is one byte. ``translate``
    takes NUL for "delete", so the byte that becomes NUL goes by way of a
    character outside Latin-1.
    """
    stand_in = "\u0100"
    before = "".join(map(chr, range(256)))
    after = "".join(chr(b ^ mask) if b != mask else stand_in for b in range(256))
    mixed = F.translate(F.decode(key, "ISO-8859-1"), before, after)
    return F.encode(F.replace(mixed, F.lit(stand_in), F.lit("\0")), "ISO-8859-1")


def pbkdf2_hash(text: Column, salt: str) -> Column:
    """PBKDF2-HMAC-SHA512 with one iteration and eight bytes, as hex.

    One iteration is one HMAC over the salt and the block number, so two
    ``sha2`` calls are enough and the work stays in the JVM.
    """
    raw = text.cast("binary")
    key = F.when(F.octet_length(raw) > SHA512_BLOCK, F.unhex(F.sha2(raw, 512))).otherwise(raw)
    key = F.rpad(key, F.lit(SHA512_BLOCK), F.lit(b"\0"))
    block = F.lit(salt.encode() + b"\x00\x00\x00\x01")
    inner = F.unhex(F.sha2(F.concat(_xor_pad(key, 0x36), block), 512))
    return F.substring(F.sha2(F.concat(_xor_pad(key, 0x5C), inner), 512), 1, 16)


def sha256_hash(text: Column, salt: str) -> Column:
    return F.substring(F.sha2(F.concat(F.lit(salt), text), 256), 1, 16)


def keyed_hash(text: Column, salt: str, mode: str = "sha256") -> Column:
    """16 hex characters that depend on the text and the salt."""
    return (pbkdf2_hash if mode == "pbkdf2" else sha256_hash)(text, salt)


def hash_address(address: Column, salt: str, mode: str = "sha256") -> Column:
    """Hash both sides of the last "@" apart, so equal domains stay joinable.

    Without "@" the local side is empty and the whole text is the other side.
    """
    domain = F.substring_index(address, "@", -1)
    local = F.regexp_extract(address, r"(?s)^(.*)@", 1)
    at = F.when(F.contains(address, F.lit("@")), "@").otherwise("")
    return F.concat(keyed_hash(local, salt, mode), at, keyed_hash(domain, salt, mode))
