"""A filter of rows by a set of keys, of a fixed size, so that rows nobody asks for stay where they are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the filter; full of them it lets everything through, and what it lets through is joined exactly afterwards.
FILTER_BITS = 25


def _bit_batches(batches):
    """(hash) -> bits of the hashes of one partition, packed."""
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    for batch in batches:
        bits[batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - FILTER_BITS)] = True
    yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])


def _kept_batches(keep):
    """(hash, ...) -> (...) of the rows whose bit is set."""

    def run(batches):
        bits = np.unpackbits(np.frombuffer(keep.value, dtype=np.uint8)).view(bool)
        for batch in batches:
            mask = bits[batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - FILTER_BITS)]
            yield batch.select(range(1, batch.num_columns)).filter(pa.array(mask))

    return run


def asked_for(rows: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """The rows whose `col` is among the values of `keys` (one column, without nulls), and a few others."""
    bits = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for part in keys.select(F.xxhash64(keys.columns[0])).coalesce(8).mapInArrow(_bit_batches, "bits binary").collect():  # at most eight filters
        bits |= np.frombuffer(part[0], dtype=np.uint8)
    keep = rows.sparkSession.sparkContext.broadcast(bits.tobytes())
    return rows.where(F.col(col).isNotNull()).select(F.xxhash64(col).alias("__hash"), *rows.columns).mapInArrow(_kept_batches(keep), rows.schema)
