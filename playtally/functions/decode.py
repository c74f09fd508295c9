"""Message decoding: prefix strip, control trim, JSON parse, typed fields.

All steps are built-in column expressions (JVM side, whole-stage codegen);
no Python runs per row. The accept/reject contract:

* ``strip=True`` (Kafka job): drop one leading ``message: `` (tested before
  trimming), then trim every char <= U+0020 from both ends (the Java
  ``String.trim`` rule; Spark's ``trim`` drops only spaces).
* ``strip=False`` (the variant without a prefix): the raw line is parsed.
* The JSON object is read with both fields as text, so numbers given as
  strings are accepted; ``try_cast`` then yields BIGINT / INT or NULL.
* An unquoted number in another form is converted as the reference does: a
  fraction or exponent is truncated toward zero, and a number beyond the type
  keeps its low 64 or 32 bits (up to 38 digits; nine decimals). Quoted ones of
  these forms are rejected: where the plain cast fails, the field's own JSON type
  (a second parse, to VARIANT) tells a number from text. Of a repeated field the
  last one decides.
* A row is accepted when both ``target_id`` and ``count`` are non-null.
  Rejected rows are returned by :func:`rejected`, or raise an error with
  ``fail_fast=True``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the message contract.
PREFIX = "message: "
CONTROL_AND_SPACE = "".join(chr(c) for c in range(0x00, 0x21))  # U+0000 .. U+0020
PAYLOAD_SCHEMA = "targetId STRING, count STRING"
NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
JSON_OPTIONS = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_prefix(line: Column | str) -> Column:
    """Drop one leading ``message: ``; any other line passes unchanged."""
    line = _col(line)
    return F.when(line.startswith(PREFIX), F.substr(line, F.lit(len(PREFIX) + 1))).otherwise(line)


def trim_control(text: Column | str) -> Column:
    """Trim every character <= U+0020 from both ends."""
    return F.btrim(_col(text), F.lit(CONTROL_AND_SPACE))


def payload_text(line: Column | str, strip: bool = True) -> Column:
    line = _col(line)
    return trim_control(strip_prefix(line)) if strip else line


def parse_payload(text: Column | str) -> Column:
    """JSON object -> ``struct<targetId: string, count: string>`` (NULL fields if absent)."""
    return F.from_json(_col(text), PAYLOAD_SCHEMA, JSON_OPTIONS)


def _is_number(json: Column, name: str) -> Column:
    """Whether the field stands in the object as a number (not as text that looks like one). Reads
    the same object again with the field's own JSON type; nested and quoted text cannot mislead it."""
    typed = F.from_json(json, f"{name} VARIANT", JSON_OPTIONS)
    return F.schema_of_variant(typed[name]).rlike("^(BIGINT|DECIMAL|DOUBLE)")


def _field(name: str, text: str, json: Column, bits: int) -> Column:
    """The field as BIGINT (64 bits) or INT (32 bits); the second way runs only where the plain
    cast fails on something that looks like a number."""
    kind = "bigint" if bits == 64 else "int"
    column = F.col(text)
    exact = F.when(column.rlike(r"^-?[0-9]+$"), column.try_cast("decimal(38,0)"))
    parts = column.try_cast("decimal(38,9)")
    whole = F.coalesce(exact, F.when(parts < 0, F.ceil(parts)).otherwise(F.floor(parts)))
    span = F.lit(Decimal(1 << bits))
    low = F.pmod(whole, span)
    signed = F.when(low >= F.lit(Decimal(1 << (bits - 1))), low - span).otherwise(low)
    other = column.rlike(NUMBER) & _is_number(json, name)
    return F.coalesce(column.try_cast(kind), F.when(other, signed.try_cast(kind)))


def decode_messages(messages: DataFrame, strip: bool = True, fail_fast: bool = False,
                    line_col: str = "line") -> DataFrame:
    """Add ``target_id BIGINT`` and ``count INT`` (NULL when undecodable) to every row
    (replacing columns of those names, so decoding twice is harmless).

    The parsed struct leaves through a one-element ``inline``, and so do the
    two numbers. Catalyst pushes filters through projections by copying the
    projected expression into the filter, which would parse and convert once
    per reference; filters are not pushed below a generator, so the JSON is
    parsed exactly once per message however the rows are filtered later, and
    a second, typed time only for a number in an unusual form.
    """
    # A positional struct cast gives the parsed fields private names, so they
    # cannot collide with the input's columns (e.g. an existing ``count``).
    payload = parse_payload(payload_text(line_col, strip)).cast(
        "struct<_target_text: string, _count_text: string>")
    numbers = F.struct(_field("targetId", "_target_text", payload_text(line_col, strip), 64).alias("target_id"),
                       _field("count", "_count_text", payload_text(line_col, strip), 32).alias("count"))
    decoded = (messages.drop("target_id", "count")
               .select("*", F.inline(F.array(payload)))
               .select("*", F.inline(F.array(numbers)))
               .drop("_target_text", "_count_text"))
    if fail_fast:
        bad = F.col("target_id").isNull() | F.col("count").isNull()
        message = F.concat(F.lit("undecodable message: "),
                           F.coalesce(F.col(line_col), F.lit("NULL")))
        decoded = decoded.filter(F.when(bad, F.raise_error(message)).otherwise(F.lit(True)))
    return decoded


def is_accepted() -> Column:
    return F.col("target_id").isNotNull() & F.col("count").isNotNull()


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(is_accepted())


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.filter(~is_accepted())
