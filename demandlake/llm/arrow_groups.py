"""Groups of rows inside a task, from Arrow batches that are sorted by a key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def grouped_tables(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """One table for each run of equal keys; a run may lie in several batches."""
    rest: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([rest, t]) if rest is not None and rest.num_rows else t
        keys = t[key].to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for a, z in zip([0, *cuts[:-1]], cuts):
            yield t.slice(a, z - a)
        rest = t.slice(cuts[-1] if len(cuts) else 0)
    if rest is not None and rest.num_rows:
        yield rest
