"""Stable identifiers: a prefix and the first hex digits of a SHA-256 over separated parts."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\x1f"


def stable_id(prefix: str, digits: int, *parts: Column | str, separator: str = SEPARATOR) -> Column:
    """prefix + SHA-256 of the parts; null parts count as empty strings (concat_ws would skip them)."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws(separator, *texts), 256), 1, digits))


def canonical_digest(value) -> str:
    """SHA-256 of JSON with sorted keys, compact separators and non-ASCII text kept."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
