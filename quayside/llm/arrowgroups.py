"""Groups of rows from sorted Arrow batches, one at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from quayside.llm.textarrays import released


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal `keys` (numbers without nulls); a run may go on in the next batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in released(batches):
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            own = tuple(c[lo] for c in columns)
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = own
    if held:
        yield pa.Table.from_batches(held)
