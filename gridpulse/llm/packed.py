"""Texts compressed before a shuffle that has to move them."""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame


def packed_texts(docs: DataFrame) -> DataFrame:
    """The text column as a compressed binary column ``packed``; the other columns, and null as empty, stay."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts = b.column("text").cast(pa.large_binary())
            packed = pa.array([pack.compress(t.as_buffer() if t.is_valid else b"") for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in others), packed], [*others, "packed"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(run, f"{kinds}, packed binary")


def unpacked(column: pa.Array) -> list[bytes]:
    """The bytes of each packed text of a batch."""
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(p.as_buffer()) for p in column]
