"""Pickup regions: KMeans on neighbourhood points, nearest centre per ride."""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions.geo import is_point, with_nearest_center
from ridelake.operators.joins import left_join_salted, left_join_small
from ridelake.operators.nearest import with_nearest_of_many

CLUSTERS = 12
SEED = 1
BROADCAST_BYTES = 32 * 1024 * 1024
# Beyond this many centres the search by literals makes too long an expression; the grid finds the same cluster, ties included.
LITERAL_CENTERS = 64
# Tasks that the fit runs in, whatever the session says: the model depends on them.
FIT_TASKS = 16

PICKUP_POINT = ("pickup_latitude", "pickup_longitude")
FACTS = "k INT, seed BIGINT, small BOOLEAN, separate BOOLEAN"


@dataclass(frozen=True)
class Regions:
    """A fitted model and the neighbourhoods of each cluster.

    ``dim`` holds distinct ``(pickup_cluster, pickup_region)`` rows. ``small``
    says its measured size may be broadcast. ``separate`` says that no two
    clusters give the same region, so fanning distinct rides out by cluster
    keeps them distinct.
    """

    model: KMeansModel
    dim: DataFrame
    k: int
    seed: int
    small: bool
    separate: bool


def assemble(df: DataFrame, cols: list[str], handle_invalid: str = "error", output: str = "features") -> DataFrame:
    """Adds the vector of ``cols``. Null or NaN fails the job, or drops the row with ``"skip"``."""
    return VectorAssembler(inputCols=list(cols), outputCol=output, handleInvalid=handle_invalid).transform(df)


def is_small(neighborhoods: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the neighbourhoods, measured over all rows, fit ``limit`` bytes."""
    name = F.coalesce(F.octet_length("neighborhood"), F.lit(0)).cast("bigint")
    size = neighborhoods.agg(F.sum(name + 64).alias("size")).first()["size"]
    return (size or 0) <= limit


def fit_regions(neighborhoods: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> KMeansModel:
    """KMeans on (latitude, longitude), in plain degrees; equal points are one weighted point.

    The result depends on row order and partitions as well as on the seed. Points
    are therefore always dealt by their place to the same number of tasks and sorted
    there, at every size of the table and under every setting of the session.
    """
    weighted = neighborhoods.groupBy("latitude", "longitude").agg(F.count("*").cast("double").alias("weight"))
    points = weighted.repartition(FIT_TASKS, "latitude", "longitude").sortWithinPartitions("latitude", "longitude")
    kmeans = KMeans(k=k, seed=seed, predictionCol="cluster", weightCol="weight")
    return kmeans.fit(assemble(points, ["latitude", "longitude"]))


def centers_of(model: KMeansModel) -> list[tuple[float, float]]:
    """The model's centres as (latitude, longitude)."""
    return [(float(c[0]), float(c[1])) for c in model.clusterCenters()]


def _clustered(df: DataFrame, model: KMeansModel, point: tuple[str, str], cluster: str) -> DataFrame:
    """Adds the nearest cluster; rows without a valid point get NULL."""
    centers = centers_of(model)
    if len(centers) <= LITERAL_CENTERS:
        return with_nearest_center(df, *point, centers, cluster)
    return with_nearest_of_many(df, *point, centers, cluster, BROADCAST_BYTES)


def label_neighborhoods(model: KMeansModel, neighborhoods: DataFrame) -> DataFrame:
    """``(neighborhood, cluster)`` for every neighbourhood."""
    return _clustered(neighborhoods, model, ("latitude", "longitude"), "cluster").select("neighborhood", "cluster")


def assign_cluster(
    rides: DataFrame, model: KMeansModel, handle_invalid: str = "skip", cluster: str = "pickup_cluster"
) -> DataFrame:
    """Adds the cluster whose centre is closest to the pickup point.

    Rides without a valid point are dropped by ``"skip"``; ``"keep"`` leaves them
    with a NULL cluster.
    """
    if handle_invalid == "skip":
        return _clustered(rides.filter(is_point(*PICKUP_POINT)), model, PICKUP_POINT, cluster)
    if handle_invalid != "keep":
        raise ValueError(f"handle_invalid must be 'skip' or 'keep', not {handle_invalid!r}")
    return _clustered(rides, model, PICKUP_POINT, cluster)


def _region_dim(model: KMeansModel, neighborhoods: DataFrame, small: bool) -> DataFrame:
    # In one partition the distinct below needs no shuffle; the rows are the same either way.
    places = neighborhoods.coalesce(1) if small else neighborhoods
    return (
        label_neighborhoods(model, places)
        .withColumnRenamed("cluster", "pickup_cluster")
        .withColumnRenamed("neighborhood", "pickup_region")
        .distinct()
        .select("pickup_cluster", "pickup_region")
    )


def _are_separate(dim: DataFrame, clusters: int) -> bool:
    """Every cluster has regions, all of them named, and no name lies in two clusters."""
    facts = dim.agg(
        F.count("*").alias("rows"),
        F.count_distinct("pickup_region").alias("names"),
        F.count_distinct("pickup_cluster").alias("clusters"),
    ).first()
    return facts["rows"] == facts["names"] and facts["clusters"] == clusters


def build_regions(
    neighborhoods: DataFrame, k: int = CLUSTERS, seed: int = SEED, broadcast_bytes: int = BROADCAST_BYTES
) -> Regions:
    """Fits the clusters and labels the neighbourhoods. Runs jobs on the neighbourhoods only.

    The measured size decides which join and how many tasks are used, never what comes out.
    """
    small = is_small(neighborhoods, broadcast_bytes)
    model = fit_regions(neighborhoods, k, seed)
    dim = _region_dim(model, neighborhoods, small)
    return Regions(model, dim, k, seed, small, _are_separate(dim, len(model.clusterCenters())))


def save_regions(regions: Regions, path: str) -> None:
    """Writes model, dimension and facts under ``path``; the facts go last and mark it complete."""
    spark = regions.dim.sparkSession
    regions.model.write().overwrite().save(f"{path}/model")
    regions.dim.write.mode("overwrite").parquet(f"{path}/dim")
    facts = [(regions.k, regions.seed, regions.small, regions.separate)]
    spark.createDataFrame(facts, FACTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")


def load_regions(spark: SparkSession, path: str) -> Regions | None:
    """The regions saved under ``path``, or None if there are none or the save did not finish."""
    try:
        facts = spark.read.schema(FACTS).parquet(f"{path}/facts").first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if facts is None:
        return None
    dim = spark.read.schema("pickup_cluster INT, pickup_region STRING").parquet(f"{path}/dim")
    return Regions(KMeansModel.load(f"{path}/model"), dim, *facts)


def load_or_build_regions(
    neighborhoods: DataFrame, path: str, k: int = CLUSTERS, seed: int = SEED
) -> Regions:
    """The saved regions if there are any, else new ones, saved.

    A stream calls this at every start, so a restart keeps the regions it began with.
    """
    spark = neighborhoods.sparkSession
    regions = load_regions(spark, path)
    if regions is None:
        save_regions(build_regions(neighborhoods, k, seed), path)
        regions = load_regions(spark, path)
    if (regions.k, regions.seed) != (k, seed):
        raise ValueError(f"regions under {path} were fitted with k={regions.k}, seed={regions.seed}")
    return regions


def attach_regions(rides: DataFrame, regions: Regions) -> DataFrame:
    """Rides, already clustered, with one row per region of their cluster (NULL if it has none)."""
    join = left_join_small if regions.small else left_join_salted
    return join(rides, regions.dim, "pickup_cluster").drop("pickup_cluster")


def assign_regions(rides: DataFrame, regions: Regions, handle_invalid: str = "skip") -> DataFrame:
    """Clusters the rides and attaches their regions."""
    return attach_regions(assign_cluster(rides, regions.model, handle_invalid), regions)
