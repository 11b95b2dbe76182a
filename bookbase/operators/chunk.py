"""Texts cut into overlapping chunks."""

from collections import deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.functions.bind import let

# Where the recursive form cuts, coarse to fine.
SEPARATORS = ["\n\n", "\n", " ", ""]


def fixed_chunks(c, size, overlap):
    """ARRAY<STRING> of chunks of `size` characters, each sharing `overlap` with the next.

    The text is cut once into steps and each step is completed from the next one, so the work
    grows with the text and not with text times chunks.
    """
    step = size - overlap

    def complete(steps):
        last = F.size(steps) - 1
        full = F.transform(
            steps,
            lambda s, i: F.concat(s, F.coalesce(F.substring(F.get(steps, i + 1), 1, overlap), F.lit(""))),
        )
        # A short last step lies wholly inside the chunk before it.
        inside = (last > 0) & (F.length(F.get(steps, last)) <= overlap)
        return F.slice(full, F.lit(1), F.when(inside, last).otherwise(last + 1))

    return let(F.regexp_extract_all(c, F.lit(rf"(?s).{{1,{step}}}"), F.lit(0)), complete)


def _cut(text, separator):
    """Pieces of `text`, each but the first opening with the separator it was cut at."""
    if separator == "":
        return list(text)
    head, *rest = text.split(separator)
    return [p for p in [head, *[separator + r for r in rest]] if p]


def _pack(pieces, size, overlap):
    """Join pieces into chunks up to `size`; a chunk opens with at most `overlap` of the one before."""
    chunks, held, length = [], deque(), 0
    for piece in pieces:
        if held and length + len(piece) > size:
            chunks.append("".join(held))
            while held and (length > overlap or length + len(piece) > size):
                length -= len(held.popleft())
        held.append(piece)
        length += len(piece)
    if held:
        chunks.append("".join(held))
    return [c for c in (chunk.strip() for chunk in chunks) if c]


def recursive_chunks(text, size, overlap, separators=SEPARATORS):
    """Cut at the coarsest separator present; pieces that are still too long are cut finer."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    chunks, fitting = [], []
    for piece in _cut(text, separators[at]):
        if len(piece) <= size:
            fitting.append(piece)
            continue
        chunks += _pack(fitting, size, overlap) + recursive_chunks(piece, size, overlap, separators[at + 1 :])
        fitting = []
    return chunks + _pack(fitting, size, overlap)


def chunk(df: DataFrame, column, size=1500, overlap=150, mode="fixed") -> DataFrame:
    """One row per chunk of `column`: `chunk_no` from 0 and `chunk`; `column` itself is left out.

    `fixed` cuts by length alone. `recursive` looks for paragraph, line and word boundaries
    first; it runs in Python, an Arrow batch at a time.
    """
    if not 0 <= overlap <= size // 2:
        raise ValueError("overlap must lie between 0 and half the size")
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    if mode == "fixed":
        chunks = fixed_chunks(F.col(column), size, overlap)
    elif mode == "recursive":

        @F.pandas_udf("array<string>")
        def cut(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: recursive_chunks(t, size, overlap) if t else [])

        chunks = cut(F.col(column))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.select(*rest, F.posexplode(chunks).alias("chunk_no", "chunk")).withColumn(
        "chunk_no", F.col("chunk_no").cast("bigint")
    )
