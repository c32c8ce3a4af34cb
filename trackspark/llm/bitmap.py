"""A set of keys as a bitmap of fixed size, to leave out rows before a join.

It may hold keys that are not in the set, never lacks one that is, and weighs 16 MB for any number of keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

BITMAP_BITS = 1 << 27


def _slots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k = keys.view(np.uint64)
    return ((k >> np.uint64(32)) % np.uint64(BITMAP_BITS)).astype(np.int64), (k % np.uint64(BITMAP_BITS)).astype(np.int64)


def key_bitmap(keys: DataFrame) -> np.ndarray:
    """Two bits for each of the 64-bit keys in the first column, made in 128 pages."""
    page = BITMAP_BITS // 128

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(_slots(batch.column(0).to_numpy())))
            yield pa.RecordBatch.from_arrays([pa.array((at // page).astype(np.int32)), pa.array((at % page).astype(np.int32))], ["page", "bit"])

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(page, bool)
        bits[rows["bit"].to_numpy()] = True
        return pd.DataFrame({"page": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})
    # a page holds at most as many distinct bits as it has
    pages = (keys.mapInArrow(split, "page int, bit int").distinct().groupBy("page").applyInPandas(fill, "page int, bits binary"))
    out = np.zeros((128, page // 8), np.uint8)
    for row in pages.toLocalIterator():
        out[row["page"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def may_hold(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    hit = np.ones(len(keys), bool)
    for at in _slots(keys):
        hit &= (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return hit
