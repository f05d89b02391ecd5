"""The nearest of many centres, by a grid over them.

The plane is cut into cells. For each cell the centres are found that may be the nearest of any point in it, and rides are joined
with those of their own cell only. Which centres these are is proven, not guessed: of two centres the difference of
squared distances is linear in the point, so a centre that another one beats at all four corners of a cell, by more than rounding can
change, is the nearest nowhere in it. Distances are then worked out and compared exactly as for few centres (ties go to the first centre),
so the result does not depend on the way.
"""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions.geo import is_point
from ridelake.operators.joins import left_join_salted, left_join_small

# Points further out than this many degrees are no places; they are compared with all centres.
FAR = 10_000.0
PER_CELL = 2
# Rounding of a squared distance, in parts of the largest one: some units in the last place, amply.
ROUNDING = 1e-14
CELLS = "_cell INT, _candidates ARRAY<STRUCT<number: INT, lat: DOUBLE, lon: DOUBLE>>"


def _squares(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, a row a point."""
    return ((points[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)


def _possible(box: tuple[float, float, float, float], centers: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The numbers of those centres that may be the nearest of a point in the box (south, north, west, east)."""
    south, north, west, east = box
    corners = np.array([(a, b) for a in (south, north) for b in (west, east)])
    tests = np.array([(a, b) for a in (south, (south + north) / 2, north) for b in (west, (west + east) / 2, east)])
    squares = _squares(corners, centers)
    beaten = np.zeros(len(centers), dtype=bool)
    for strong in np.unique(_squares(tests, centers).argmin(axis=1)):
        margin = ROUNDING * (squares + squares[:, [strong]])
        beaten |= (squares[:, [strong]] + margin < squares).all(axis=0)
    return numbers[~beaten]


@dataclass(frozen=True)
class CenterGrid:
    """Cells over the centres, ``size`` each way, and a border beyond; ``candidates`` by cell number."""

    south: float
    north: float
    west: float
    east: float
    size: int
    candidates: dict[int, list[int]]

    @property
    def far(self) -> int:
        """The cell of all points that are no places."""
        return (self.size + 2) ** 2


def build_grid(centers: Sequence[tuple[float, float]]) -> CenterGrid:
    """The grid over centres of (latitude, longitude); numpy on the driver, which holds the centres anyway."""
    points = np.array(centers, dtype=np.float64).reshape(-1, 2)
    if not (np.abs(points) < FAR).all():
        raise ValueError("centres must be places")
    size = max(1, int((len(points) / PER_CELL) ** 0.5))
    (south, west), (north, east) = points.min(axis=0), points.max(axis=0)
    edges = [_edges(low, high, size) for low, high in ((south, north), (west, east))]
    numbers = np.arange(len(points))
    # Which centres lie in which cell, for the rings around a cell.
    place = [np.clip(np.searchsorted(e[1:-1], points[:, i], side="right") - 1, 0, size - 1) for i, e in enumerate(edges)]
    order = np.lexsort((place[1], place[0]))
    starts = np.searchsorted(place[0][order] * size + place[1][order], np.arange(size * size + 1))
    steps = [(e[-2] - e[1]) / size for e in edges]
    candidates = {}
    for i in range(size + 2):
        for j in range(size + 2):
            box = (edges[0][i], edges[0][i + 1], edges[1][j], edges[1][j + 1])
            inner = 0 < i <= size and 0 < j <= size
            near = _ring(box, (i - 1, j - 1), points, order, starts, size, steps) if inner else numbers
            candidates[i * (size + 2) + j] = _possible(box, points[near], near).tolist()
    candidates[(size + 2) ** 2] = numbers.tolist()
    return CenterGrid(south, north, west, east, size, candidates)


def _edges(low: float, high: float, size: int) -> np.ndarray:
    """The borders of cells along one axis, the outermost ones far away."""
    return np.concatenate([[-FAR], np.linspace(low, high, size + 1), [FAR]])


def _ring(box, cell, points, order, starts, size, steps) -> np.ndarray:
    """The centres in the rings around a cell, up to the first ring that is further from it than some centre can be."""
    south, north, west, east = box
    corners = np.array([(a, b) for a in (south, north) for b in (west, east)])
    found, bound = [], np.inf
    for r in range(size + 1):
        # All cells of ring r lie at least r - 1 steps away.
        if (max(r - 1, 0) * min(steps)) ** 2 > bound:
            break
        for row in range(max(0, cell[0] - r), min(size, cell[0] + r + 1)):
            whole = abs(row - cell[0]) == r
            columns = [(max(0, cell[1] - r), min(size, cell[1] + r + 1))] if whole else [(c, c + 1) for c in (cell[1] - r, cell[1] + r) if 0 <= c < size]
            for first, last in columns:
                some = order[starts[row * size + first] : starts[row * size + last]]
                if len(some):
                    found.append(some)
                    bound = min(bound, _squares(corners, points[some]).max(axis=0).min() * (1 + 1e-9))
    return np.sort(np.concatenate(found))


def _axis(value: Column, low: float, high: float, size: int) -> Column:
    """A coordinate's place along one axis, 0 and ``size + 1`` beyond the centres."""
    step = (high - low) / size
    inner = F.least(F.floor((value - low) / F.lit(step or 1.0)).cast("int"), F.lit(size - 1)) + 1
    return F.when(value < low, 0).when(value > high, size + 1).otherwise(inner)


def cell_of(latitude: Column, longitude: Column, grid: CenterGrid) -> Column:
    """The number of a point's cell; null for no point."""
    row = _axis(latitude, grid.south, grid.north, grid.size)
    column = _axis(longitude, grid.west, grid.east, grid.size)
    near = (F.abs(latitude) <= FAR) & (F.abs(longitude) <= FAR)
    return F.when(near, row * (grid.size + 2) + column).otherwise(F.lit(grid.far)).cast("int")


def with_nearest_of_many(
    df: DataFrame, latitude: str, longitude: str, centers: Sequence[tuple[float, float]], name: str, broadcast_bytes: int
) -> DataFrame:
    """Adds the index of the closest centre, the first one of equals; rows without a valid point get NULL.

    The cells and their candidates are broadcast if their size allows it; otherwise they are joined by a shuffle, in which a
    cell with very many rides is dealt to several tasks.
    """
    grid = build_grid(centers)
    spark: SparkSession = df.sparkSession
    rows = [(cell, [(n, *map(float, centers[n])) for n in numbers]) for cell, numbers in grid.candidates.items()]
    held = sum(16 + 24 * len(numbers) for _, numbers in rows)
    cells = spark.createDataFrame(rows, CELLS)
    lat, lon = F.col(latitude).cast("double"), F.col(longitude).cast("double")
    placed = df.withColumn("_cell", F.when(is_point(latitude, longitude), cell_of(lat, lon, grid)))
    join = left_join_small if held <= broadcast_bytes else left_join_salted
    met = join(placed, cells, "_cell")
    squares = F.transform(
        "_candidates",
        lambda c: F.struct(
            ((lat - c["lat"]) * (lat - c["lat"]) + (lon - c["lon"]) * (lon - c["lon"])).alias("square"), c["number"].alias("number")
        ),
    )
    return met.withColumn(name, F.array_min(squares)["number"]).select(*df.columns, name)
