"""A Bloom filter of a hash column, of a size set beforehand."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.common import arrow_types
from cohortloom.llm.tokens import scramble

BLOOM_BITS = 1 << 24


def bloom_places(values: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    second = scramble(values ^ np.uint64(0x5851F42D4C957F2D))
    return (values % np.uint64(n_bits)).astype(np.int64), (second % np.uint64(n_bits)).astype(np.int64)


def hit(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    n_bits = len(bits) * 8
    found = np.ones(len(values), bool)
    for at in bloom_places(values, n_bits):
        found &= (bits[at >> 3] >> (at & 7)) & 1 == 1
    return found


class Bloom:
    """A Bloom filter of a hash column; at most ``n_bits`` bits reach the driver and the tasks."""

    def __init__(self, hashes: DataFrame, column: str, n_bits: int = BLOOM_BITS) -> None:
        spark = hashes.sparkSession
        words = "word long, bits long"
        kinds = arrow_types(spark, words)

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                at = np.concatenate(bloom_places(values, n_bits))
                bits = np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at >> 6, kinds["word"]), pa.array(bits, kinds["bits"])], names=list(kinds))

        found = hashes.select(column).mapInArrow(places, words).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        table = found.toArrow()  # n_bits / 64 rows at most
        filled = np.zeros(n_bits // 64, np.int64)
        filled[table.column("word").to_numpy()] = table.column("bits").to_numpy()
        self.sent = spark.sparkContext.broadcast(filled.tobytes())

    def bits(self) -> np.ndarray:
        return np.frombuffer(self.sent.value, np.uint8)
