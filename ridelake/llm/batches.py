"""Arrow batches in pieces, so that a task holds the Python objects of a few hundred rows only."""

from collections.abc import Callable, Iterator

import pyarrow as pa

ROWS = 500


def by_pieces(work: Callable[[list], pa.Array]) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """A column function that gives ``work`` the values of ``ROWS`` rows at a time."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            starts = range(0, max(1, len(batch)), ROWS)
            yield pa.concat_arrays([work(batch.slice(start, ROWS).to_pylist()) for start in starts])

    return run
