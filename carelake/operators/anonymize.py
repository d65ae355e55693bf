"""Keyed tokens for patient numbers and names, entirely in Catalyst expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space, the two labels with their patterns,
# token prefixes and the token length. The look-behind is a Unicode word boundary; it
# stands behind the letters so that it is only tried where they match.
SPACE = r"[\s\x1c-\x1f]"
IP_PATTERN = rf"(?iU)IP(?<![\p{{L}}\p{{N}}_]IP){SPACE}*NO{SPACE}*:{SPACE}*([^\n\r]+)"
NAME_PATTERN = rf"(?iU)NAME(?<![\p{{L}}\p{{N}}_]NAME){SPACE}*:{SPACE}*([^\n\r]+)"
TOKEN_LENGTH = 10


def strip_space(col: Column) -> Column:
    return F.regexp_replace(col, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def hmac_sha256(col: Column, salt: str) -> Column:
    """HMAC-SHA256 in hex: two nested SHA-256 with pads made from the salt."""
    key = salt.encode("utf-8")
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    inner_pad = F.lit(bytes(b ^ 0x36 for b in key))
    outer_pad = F.lit(bytes(b ^ 0x5C for b in key))
    inner = F.unhex(F.sha2(F.concat(inner_pad, F.encode(col, "UTF-8")), 256))
    return F.sha2(F.concat(outer_pad, inner), 256)


def token(col: Column, prefix: str, salt: str, length: int = TOKEN_LENGTH) -> Column:
    digest = F.upper(F.substring(hmac_sha256(strip_space(col), salt), 1, length))
    return F.concat(F.lit(f"{prefix}-"), digest)


def _let(value: Column, use) -> Column:
    """Bind an expression once for several uses (Catalyst would repeat its work)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _replace(text: Column, pattern: str, label: str, prefix: str, salt: str, length: int) -> Column:
    """Put label and token in place of each match: the pieces between matches and
    the captured values come from the same pattern, so they interleave."""
    pieces = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    filled = F.zip_with(
        pieces,
        values,
        lambda piece, value: F.when(
            value.isNotNull(), F.concat(piece, F.lit(f"{label}: "), token(value, prefix, salt, length))
        ).otherwise(piece),
    )
    # Texts without the label skip the work.
    return F.when(text.rlike(pattern), F.array_join(filled, "")).otherwise(text)


def anonymize(text, salt: str, length: int = TOKEN_LENGTH) -> Column:
    """'IP NO: v' and 'NAME: v' become tokens; equal values give equal tokens everywhere.

    A token has ``length`` hex digits of the digest. Ten tell about a million names apart;
    take more (up to 64) for larger sets, where two names could share a token.
    """
    col = F.col(text) if isinstance(text, str) else text
    return _let(
        _replace(col, IP_PATTERN, "IP NO", "IP", salt, length),
        lambda done: _replace(done, NAME_PATTERN, "NAME", "NM", salt, length),
    )
