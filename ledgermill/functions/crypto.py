"""Hashes, message signatures and column encryption, all JVM-side."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "|"
_BLOCK = 64


def content_hash(content: Column) -> Column:
    """SHA-256 of file bytes or text, as lower-case hex."""
    return F.sha2(content, 256)


def dedup_hash(*parts: Column) -> Column:
    """SHA-256 over key columns joined with ``|``; NULL counts as empty text."""
    text = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *text), 256)


def hmac_pads(secret: str) -> tuple[str, str]:
    """Inner and outer padded key of HMAC-SHA256 as hex."""
    if not secret:
        raise ValueError("a signing secret is required")
    key = secret.encode("utf-8")
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    padded = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in padded).hex(), bytes(b ^ 0x5C for b in padded).hex()


@dataclass(frozen=True)
class Pads:
    """Inner and outer pad as binary columns, read from where the secret is kept."""

    inner: Column
    outer: Column


# A secret in clear text ends up in plans; see ``operators.secrets`` for the other form.
Secret = str | Pads


def pads_of(secret: Secret) -> Pads:
    if isinstance(secret, Pads):
        return secret
    inner, outer = hmac_pads(secret)
    return Pads(F.unhex(F.lit(inner)), F.unhex(F.lit(outer)))


def hmac_sha256(message: Column, secret: Secret) -> Column:
    """HMAC-SHA256 as hex, composed from two SHA-256 calls."""
    pads = pads_of(secret)
    digest = F.sha2(F.concat(pads.inner, F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(pads.outer, F.unhex(digest)), 256)


def review_token(doc_id: Column, action: Column, secret: Secret) -> Column:
    return hmac_sha256(F.concat_ws("|", doc_id.cast("string"), action), secret)


def checklist_token(group: Column, fy_year: Column, answer: Column, secret: Secret) -> Column:
    return hmac_sha256(F.concat_ws("|", group, fy_year.cast("string"), answer), secret)


def _key(key: str | Column) -> Column:
    return key if isinstance(key, Column) else F.encode(F.lit(key), "UTF-8")


def encrypt(value: Column, key: str | Column) -> Column:
    return F.aes_encrypt(F.encode(value, "UTF-8"), _key(key))


def decrypt(value: Column, key: str | Column) -> Column:
    return F.decode(F.aes_decrypt(value, _key(key)), "UTF-8")
