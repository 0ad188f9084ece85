"""Input checks with a reason instead of an exception."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.functions.text import strip_blanks
from docsift.sources.files import ALLOWED_EXTENSIONS, extension

# Shortest accepted text and token count, default file name.
MIN_CHARS = 5
MIN_TOKENS = 3
DEFAULT_FILENAME = "Saisie directe"


def filename_or_default(filename: Column) -> Column:
    return F.coalesce(F.nullif(filename, F.lit("")), F.lit(DEFAULT_FILENAME))


def reason(text: Column, tokens: Column, filename: Column | None = None) -> Column:
    """Why an input is rejected, else null. ``filename`` is null for typed text."""
    checks = F.lit(None).cast("string")
    length = F.length(strip_blanks(F.coalesce(text, F.lit(""))))
    checks = F.when(F.size(tokens) < MIN_TOKENS, F.lit("too_little_text")).otherwise(checks)
    checks = F.when(length < MIN_CHARS, F.lit("empty_text")).otherwise(checks)
    if filename is not None:
        given = filename.isNotNull()
        no_content = given & (F.coalesce(F.length(text), F.lit(0)) == 0)
        checks = F.when(no_content, F.lit("empty_file")).otherwise(checks)
        bad = given & ~extension(filename).isin(ALLOWED_EXTENSIONS)
        checks = F.when(bad, F.lit("unsupported_extension")).otherwise(checks)
        checks = F.when(given & (filename == ""), F.lit("no_file_selected")).otherwise(checks)
    return checks


def validate(df: DataFrame, text: str = "text", tokens: str = "tokens", filename: str | None = None) -> DataFrame:
    """Add ``status`` ('accepted' or 'rejected') and ``reason``."""
    why = reason(F.col(text), F.col(tokens), F.col(filename) if filename else None)
    checked = df.withColumn("reason", why)
    return checked.withColumn("status", F.when(F.col("reason").isNull(), "accepted").otherwise("rejected"))
