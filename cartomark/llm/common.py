"""Shared by the operators: tables, ASCII folding, tokenizer files."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the contracts define words: ``[^\x20\x09-\x0D]+``.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
#: Lower-cases A-Z in UTF-8 bytes and leaves every other byte.
FOLD = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and other letters kept.

    ``lower`` does just that for pure ASCII, much faster than ``translate``.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def byte_bpe() -> dict[str, str]:
    """Files and split pattern of the public byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    return {
        "tokenizer_json": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks_file": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def slices(batches: Iterator[pa.RecordBatch], text_column: int, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut at about ``limit`` bytes of text, so that derived arrays stay small."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
