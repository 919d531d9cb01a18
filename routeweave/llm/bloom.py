"""A Bloom filter of fixed size over a column of 64-bit hashes.

Spark builds the slices; the driver and the workers hold ``n_bytes``, however
many rows there are.  It only ever saves work: what it lets through is
decided exactly afterwards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeweave.llm.textbytes import mix64

SLICES = 64
_U = np.uint64


def _places(h: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    g = mix64(h + _U(0x2545F4914F6CDD1D))
    return (g & _U(n_bits - 1)).astype(np.int64), (g >> _U(32) & _U(n_bits - 1)).astype(np.int64)


def bloom_filter(rows: DataFrame, column: str, n_bytes: int = 8 << 20) -> np.ndarray:
    """Bits of all values of a long column; ``n_bytes`` is a power of two."""
    part = n_bytes // SLICES

    def build(key, table):
        out = np.zeros(part * 8, dtype=bool)
        for at in _places(table["h"].to_numpy().view(np.uint64), part * 8):
            out[at] = True
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "bits": [np.packbits(out, bitorder="little").tobytes()]})

    # partial distinct values keep a hot value from one task
    made = (rows.select(F.col(column).alias("h")).distinct()
            .withColumn("slice", F.shiftrightunsigned("h", 58).cast("int"))
            .groupBy("slice").applyInArrow(build, "slice int, bits binary").collect())
    bits = np.zeros(n_bytes, dtype=np.uint8)
    for r in made:
        bits[r[0] * part:(r[0] + 1) * part] = np.frombuffer(bytes(r[1]), np.uint8)
    return bits


def may_contain(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    part = len(bits) // SLICES * 8
    base = (h >> _U(58)).astype(np.int64) * part
    out = np.ones(len(h), dtype=bool)
    for at in _places(h, part):
        at = at + base
        out &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return out
