"""Text and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fundlens import constants as K


def lower(c) -> Column:
    return F.lower(c)


def json_text(c, *path: str) -> Column:
    """Text at a path of object keys; NULL for a missing key or a JSON null."""
    return F.get_json_object(c, "$." + ".".join(path))


def json_fields(c, fields: str) -> Column:
    """Several fields as one struct: one JSON parse per row, however many fields."""
    return F.from_json(c, fields)


def json_elements(c, key: str, element: str) -> Column:
    """Array of structs under ``key``; one JSON parse for all the fields."""
    return F.from_json(F.get_json_object(c, f"$.{key}"), f"array<struct<{element}>>")


def repair_hex_prefix(c) -> Column:
    """Put '0' for the first character and lower-case the rest; NULL gives '0'."""
    return F.concat_ws("", F.lit("0"), F.lower(F.substring(c, 2, 2147483647)))


def concat_text(*cols) -> Column:
    """Join text; NULL if any part is NULL."""
    return F.concat(*[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])


def concat_skip_null(*cols) -> Column:
    """Join text, leaving NULL parts out."""
    return F.concat_ws("", *cols)


def row_hash(*cols) -> Column:
    """SHA-256 of the joined text of the columns; NULL if any part is NULL.

    Pass money as DECIMAL(18,2): the text of a double is not stable across engines.
    """
    return F.sha2(concat_text(*cols), 256)


def valid_address(c) -> Column:
    return F.rlike(c, F.lit(K.ADDRESS_PATTERN))


def normalize_title(c) -> Column:
    """Lower-case; drop all but letters, numbers, '_' and white space; collapse white space."""
    kept = F.regexp_replace(F.lower(c), K.PUNCTUATION_PATTERN, "")
    return F.trim(F.regexp_replace(kept, K.WHITE_SPACE_PATTERN, " "))


def repo_owner(c) -> Column:
    """Owner part of a repository URL or of 'owner/name'."""
    owner = F.lower(c)
    for prefix in K.REPO_HOST_PREFIXES:
        owner = F.replace(owner, F.lit(prefix), F.lit(""))
    return F.substring_index(owner, "/", 1)


def none_if_blank(c) -> Column:
    return F.when(F.trim(c) != "", c)
