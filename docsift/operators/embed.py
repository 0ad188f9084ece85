"""Text to vectors: hashed words as table work, or a user-supplied encoder in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Texts per encoder call and encoder window in tokens.
BATCH = 32
MAX_TOKENS = 256

Encoder = Callable[[Sequence[str], int], np.ndarray]
WORD = r"[^\x20\x09-\x0D]+"


def hashed_vectors(df: DataFrame, row_id: str, text: str, dims: int = 64) -> DataFrame:
    """``(row_id, embedding array<double>)``: signed counts of the hashed lower-case words of whole texts.

    Words are counted per row and slot before anything meets, and one shuffle brings
    the few slots of a row together. A row without words has a zero vector.
    """
    words = df.select(row_id, F.explode_outer(F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), 1)).alias("word"))
    code = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("long")
    slots = words.select(
        row_id, (code % dims).cast("int").alias("slot"), F.when(F.floor(code / dims) % 2 == 1, 1.0).otherwise(-1.0).alias("sign")
    )
    counted = slots.groupBy(row_id, "slot").agg(F.sum("sign").alias("value"))
    entry = F.when(F.col("slot").isNotNull(), F.struct("slot", "value"))
    found = counted.groupBy(row_id).agg(F.map_from_entries(F.collect_list(entry)).alias("held"))
    places = F.sequence(F.lit(0), F.lit(dims - 1))
    vector = F.transform(places, lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0.0)))
    return found.select(row_id, vector.alias("embedding"))


def embed(
    df: DataFrame,
    row_id: str,
    text: str,
    load_encoder: Callable[[], Encoder],
    batch: int = BATCH,
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """``(row_id, embedding array<float>)`` with unit-length rows.

    ``load_encoder`` runs once per task and returns ``encode(texts, max_tokens)``. A text
    of more than ``max_tokens`` words goes to it in windows of so many words, whose
    unit vectors are averaged by their words, so no text is cut off. Without an encoder
    there is no embedding: a missing model is an error.
    """

    def unit(vectors: np.ndarray) -> np.ndarray:
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        return vectors / np.clip(norms, 1e-12, None)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load_encoder()
        for frame in frames:
            windows, sizes, owner = [], [], []
            for i, whole in enumerate(frame[text].fillna("").tolist()):
                words = whole.split()
                for start in range(0, max(len(words), 1), max_tokens):
                    part = words[start : start + max_tokens]
                    windows.append(whole if len(words) <= max_tokens else " ".join(part))
                    sizes.append(max(len(part), 1))
                    owner.append(i)
            total = None
            for start in range(0, len(windows), batch):
                vectors = unit(np.asarray(encode(windows[start : start + batch], max_tokens), dtype="float64"))
                total = np.zeros((len(frame), vectors.shape[1])) if total is None else total
                part = slice(start, start + batch)
                np.add.at(total, owner[part], vectors * np.array(sizes[part])[:, None])
            if total is not None:
                yield pd.DataFrame({row_id: frame[row_id].to_numpy(), "embedding": list(unit(total).astype("float32"))})

    kind = df.schema[row_id].dataType.simpleString()
    return df.select(row_id, text).mapInPandas(run, f"{row_id} {kind}, embedding array<float>")
