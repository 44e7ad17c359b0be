"""Pseudonyms and tamper-evident record hashes as Column expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values — must equal the reference for identical pseudonyms / hashes.
# ---------------------------------------------------------------------------
PSEUDONYM_SALT = "pharma-ai-pseudonym-salt-"
GENESIS_TEXT = "genesis"
# Field order of the hashed consent payload (keys sorted, as a sorted-key
# JSON dump produces them).
CONSENT_HASH_FIELDS = (
    "action",
    "patient_pseudonym",
    "previous_record_hash",
    "record_id",
    "timestamp",
    "use_case_id",
    "version",
)
# ---------------------------------------------------------------------------

GENESIS_HASH = hashlib.sha256(GENESIS_TEXT.encode()).hexdigest()
ISO_MICROS_SPARK = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_MICROS_DUCKDB = "%Y-%m-%dT%H:%M:%S.%fZ"


def pseudonymize(col, salt: str = PSEUDONYM_SALT) -> Column:
    """B1: first 16 hex digits of SHA-256(salt ‖ id)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(F.sha2(F.concat(F.lit(salt), c.cast("string")), 256), 1, 16)


def pseudonymize_sql(expr: str, salt: str = PSEUDONYM_SALT) -> str:
    return f"substr(sha256('{salt}' || CAST({expr} AS VARCHAR)), 1, 16)"


def pseudonymize_py(value, salt: str = PSEUDONYM_SALT) -> str:
    return hashlib.sha256(f"{salt}{value}".encode()).hexdigest()[:16]


def iso_utc(col) -> Column:
    """A timestamp as ISO text with microseconds in UTC, whatever the session
    time zone (computed from the epoch, so local clock changes do not matter)."""
    us = F.unix_micros(F.col(col) if isinstance(col, str) else col)
    day = F.floor(us / F.lit(86_400_000_000)).cast("long")
    day = F.when(day * 86_400_000_000 > us, day - 1).otherwise(day)
    left = us - day * 86_400_000_000
    two = lambda x: F.lpad(x.cast("long").cast("string"), 2, "0")
    second = F.floor(left / 1_000_000)
    return F.concat(F.date_add(F.lit("1970-01-01").cast("date"), day.cast("int")).cast("string"), F.lit("T"),
                    two(F.floor(second / 3600)), F.lit(":"), two(F.floor(second / 60) % 60), F.lit(":"),
                    two(second % 60), F.lit("."), F.lpad((left % 1_000_000).cast("string"), 6, "0"), F.lit("Z"))


# JSON's short escapes.
_SHORT = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


def _escaped_char(c: Column) -> Column:
    """One character as ASCII JSON text: short escapes, else ``\\uXXXX``, a
    surrogate pair beyond the basic plane."""
    def unit(x: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(x.cast("long"))), 4, "0"))

    point = F.ascii(c)
    out = F.when(c == "", F.lit(""))
    for raw, short in _SHORT.items():
        out = out.when(c == raw, F.lit(short))
    high = point - 0x10000
    return (out.when(point > 0xFFFF, F.concat(unit(F.floor(high / 1024) + 0xD800), unit(high % 1024 + 0xDC00)))
            .when((point > 126) | (point < 32), unit(point)).otherwise(c))


def json_string(col) -> Column:
    """Quote a string Column as an ASCII JSON string literal.

    Plain printable ASCII takes the short way; a text with control or
    non-ASCII characters is escaped character by character."""
    c = F.col(col) if isinstance(col, str) else col
    escaped = F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), '"', '\\\\"')
    full = F.array_join(F.transform(F.split(escaped, ""), _escaped_char), "")
    return F.concat(F.lit('"'), F.when(c.rlike(r"[^\x20-\x7e]"), full).otherwise(escaped), F.lit('"'))


def json_payload(fields: dict) -> Column:
    """Sorted-key JSON object with ``", "`` / ``": "`` spacing.

    Spark's ``to_json`` writes compact JSON, which hashes differently from a
    default-spaced JSON dump; this builds the spaced text with ``concat``.
    Control and non-ASCII characters are escaped, as a default JSON dump does.
    """
    parts = []
    for i, name in enumerate(sorted(fields)):
        parts.append(F.lit(("{" if i == 0 else ", ") + f'"{name}": '))
        parts.append(json_string(fields[name]))
    parts.append(F.lit("}"))
    return F.concat(*parts)


def json_payload_sql(fields: dict) -> str:
    pieces = []
    for i, name in enumerate(sorted(fields)):
        lead = ("{" if i == 0 else ", ") + f'"{name}": '
        pieces.append(f"'{lead}'")
        v = fields[name]
        pieces.append(
            f"'\"' || replace(replace({v}, '\\', '\\\\'), '\"', '\\\"') || '\"'")
    pieces.append("'}'")
    return "(" + " || ".join(pieces) + ")"


def record_hash(fields: dict) -> Column:
    """B2: SHA-256 hex of the sorted-key JSON payload of ``fields``."""
    return F.sha2(json_payload(fields), 256)


def record_hash_py(fields: dict) -> str:
    import json
    return hashlib.sha256(json.dumps(fields, sort_keys=True).encode()).hexdigest()
