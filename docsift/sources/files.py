"""Text from uploaded files of mixed formats."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.text import strip_blanks

# Accepted file extensions.
ALLOWED_EXTENSIONS = [".pdf", ".docx", ".doc", ".txt", ".rtf", ".md"]
TEXT_EXTENSIONS = [".txt", ".rtf", ".md"]

Handler = Callable[[bytes], str]


def extension(filename: Column) -> Column:
    """Lower-cased extension of the last path part with its dot, else ''."""
    return F.regexp_extract(F.lower(filename), r"[^/.][^/]*?(\.[^./]*)$", 1)


def decode_text(content: Column) -> Column:
    """UTF-8 when the bytes are valid UTF-8, else Latin-1; edge blanks stripped."""
    as_string = content.cast("string")
    utf8 = F.is_valid_utf8(as_string)
    text = F.when(utf8, as_string).otherwise(F.decode(content, "ISO-8859-1"))
    return strip_blanks(text)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("filename"), "path", "length", "content")
    )


def _run_handlers(handlers: Mapping[str, Handler]):
    """Per-batch helper: one handler per extension, all of them for unknown ones.
    Content that no handler could read is handed on."""

    def text_of(kind: str, content: bytes) -> tuple[str | None, str | None, bytes | None]:
        known = kind in handlers
        for handler in [handlers[kind]] if known else handlers.values():
            try:
                text = handler(bytes(content))
            except Exception as failure:  # a bad file must not fail the job
                if known:
                    return None, str(failure), None
                continue
            if text or known:
                return text, None, None
        return None, None, content

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [text_of(k, c) for k, c in zip(batch["kind"], batch["content"], strict=True)]
            yield pd.DataFrame(
                {
                    "filename": batch["filename"],
                    "path": batch["path"],
                    "text": [t for t, _, _ in found],
                    "error": [e for _, e, _ in found],
                    "content": [c for _, _, c in found],
                }
            )

    return run


def extract_text(files: DataFrame, handlers: Mapping[str, Handler] | None = None) -> DataFrame:
    """``(filename, path, text, error)`` for a ``read_files`` table.

    Plain-text kinds are decoded by built-in functions. ``handlers`` maps further
    extensions ('.pdf', '.docx', '.doc') to functions from bytes to text; they run
    in Python batches, each file once. A known kind without a handler gives an
    error row. An unknown kind tries the handlers in order and then plain text.
    """
    handlers = dict(handlers or {})
    kind = extension(F.col("filename"))
    files = files.select("filename", "path", "content", kind.alias("kind"))
    plain = F.col("kind").isin(TEXT_EXTENSIONS)
    binary = F.col("kind").isin([e for e in ALLOWED_EXTENSIONS if e not in TEXT_EXTENSIONS])
    refused = binary & ~F.col("kind").isin(list(handlers)) if handlers else binary
    direct = files.select(
        "filename",
        "path",
        F.when(~refused, decode_text(F.col("content"))).alias("text"),
        F.when(refused, F.concat(F.lit("no handler for "), F.col("kind"))).alias("error"),
        "kind",
    )
    if not handlers:
        return direct.drop("kind")
    by_built_in = plain | refused
    handled = files.filter(~by_built_in).mapInPandas(
        _run_handlers(handlers),
        "filename string, path string, text string, error string, content binary",
    )
    left_over = F.when(F.col("content").isNotNull(), decode_text(F.col("content")))
    handled = handled.select("filename", "path", F.coalesce("text", left_over).alias("text"), "error")
    return direct.filter(by_built_in).drop("kind").unionByName(handled)
