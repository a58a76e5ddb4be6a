"""Masking of sensitive fields in texts and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import SENSITIVE_FIELDS

MASK = "***MASKED***"
_NAMES = "|".join(sorted((f.replace("_", "[_-]") if "_" in f else f for f in SENSITIVE_FIELDS), key=len, reverse=True))


def mask_text(text: Column) -> Column:
    """Values after key=value and "key": "value" of sensitive names, whatever their case."""
    quoted = F.regexp_replace(text, rf"""(?i)(["'](?:{_NAMES})["']\s*:\s*["'])[^"']*(["'])""", f"$1{MASK}$2")
    return F.regexp_replace(quoted, rf"(?i)\b((?:{_NAMES})\s*=\s*)[^\s,;&]+", f"$1{MASK}")


def mask_map(m: Column) -> Column:
    """A map's values under sensitive names; case, _ and - don't count."""
    plain = sorted({f.replace("_", "").replace("-", "") for f in SENSITIVE_FIELDS})
    return F.transform_values(m, lambda k, v: F.when(F.regexp_replace(F.lower(k), "[_-]", "").isin(plain), F.lit(MASK)).otherwise(v))
