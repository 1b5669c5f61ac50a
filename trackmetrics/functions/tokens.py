"""Pseudonymous tokens from identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MIN_SALT = 32
HMAC_KEY = 64


def salted_token(user: Column, salt: str, bits: int = 128) -> Column:
    """SHA-256 of salt and id, cut to ``bits`` (64 to 256, a multiple of 4)."""
    if len(salt) < MIN_SALT:
        raise ValueError(f"the salt needs at least {MIN_SALT} characters")
    if not 64 <= bits <= 256 or bits % 4:
        raise ValueError("token bits: 64 to 256, a multiple of 4")
    return F.substring(F.sha2(F.concat(F.lit(salt), user.cast("string")), 256), 1, bits // 4)


def hmac_token(user: Column, key: bytes, bits: int = 128) -> Column:
    """HMAC-SHA-256 with a 64-byte key, built from two SHA-256 calls so that it stays in the JVM."""
    if len(key) != HMAC_KEY:
        raise ValueError(f"the key needs exactly {HMAC_KEY} bytes")
    inner = F.lit(bytes(b ^ 0x36 for b in key))
    outer = F.lit(bytes(b ^ 0x5C for b in key))
    message = F.concat(inner, F.encode(user.cast("string"), "UTF-8"))
    digest = F.sha2(F.concat(outer, F.unhex(F.sha2(message, 256))), 256)
    return F.substring(digest, 1, bits // 4)
