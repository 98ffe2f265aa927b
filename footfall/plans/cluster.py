"""Location clustering (M1): k-means on (longitude, latitude) with batched restarts.

All restarts move together: one pass over the points gives, for every restart that is still
moving, each cluster's sum and count; a restart whose centres stay is frozen.  The first
centres are chosen as in k-means||: each pass keeps points far from the centres so far, for
all restarts at once, and the kept points, weighted by the points nearest to them, are reduced to
k by weighted k-means++ on the driver.  What reaches the driver is restarts x k rows per pass.

One point per store (the dimension repeats each store 7 times, which scales the objective
but does not move its optimum).  Stores without coordinates get a null
cluster instead of failing the fit (trap T17).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COORDS = ["longitude", "latitude"]
SEEDING_PASSES = 3
TOLERANCE = 1e-4            # a centre that moves less stays
POINTS = 1 << 15            # points of a partition: every pass runs a task for each
_SUMS = "restart int, cluster int, sx double, sy double, n long, cost double"


@dataclass
class LocationClusters:
    centres: np.ndarray     # k x 2
    cost: float             # sum of squared distances to the nearest centre
    passes: int

    def assign(self, stores: DataFrame, out: str = "cluster") -> DataFrame:
        """``stores`` with the number of the nearest centre (the first on ties), null without
        coordinates."""
        x, y = (F.col(c).cast("double") for c in COORDS)
        away = [F.struct((F.pow(x - F.lit(float(cx)), F.lit(2.0))
                          + F.pow(y - F.lit(float(cy)), F.lit(2.0))).alias("d"),
                         F.lit(i).alias("i")) for i, (cx, cy) in enumerate(self.centres)]
        nearest = F.least(*away)["i"] if len(away) > 1 else away[0]["i"]
        return stores.withColumn(out, F.when(x.isNotNull() & y.isNotNull(), nearest).cast("int"))


def _points(stores: DataFrame, store: str) -> DataFrame:
    x, y = (F.col(c).cast("double") for c in COORDS)
    return (stores.select(store, x.alias("x"), y.alias("y"))
            .where("x is not null and y is not null").dropDuplicates([store])
            .select("x", "y", F.xxhash64(store).alias("id")))


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((points[:, :1] - centres[:, 0]) ** 2 + (points[:, 1:] - centres[:, 1]) ** 2)


def cluster_sums(points: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Per restart and cluster: sums, count and cost of the points nearest to its centre."""
    def run(batches):
        total = {r: np.zeros((4, len(c))) for r, c in centres.items()}
        for batch in batches:
            xy = batch[["x", "y"]].to_numpy(float)
            for r, c in centres.items():
                away = _distances(xy, c)
                near = away.argmin(axis=1)
                cost = away[np.arange(len(xy)), near]
                total[r] += [np.bincount(near, w, len(c)) for w in (*xy.T, None, cost)]
        found = [(r, k, v[0], v[1], int(v[2]), v[3])
                 for r, t in total.items() for k, v in enumerate(t.T) if v[2]]
        if found:
            yield pd.DataFrame(found, columns=["restart", "cluster", "sx", "sy", "n", "cost"])

    return points.mapInPandas(run, _SUMS).groupBy("restart", "cluster").agg(
        *[F.sum(c).alias(c) for c in ("sx", "sy", "n", "cost")])


def kmeans_step(points: DataFrame, centres: dict[int, np.ndarray]
                ) -> tuple[dict[int, np.ndarray], dict[int, float]]:
    """One move of every restart's centres, and the cost before it; an empty cluster stays."""
    moved = {r: c.copy() for r, c in centres.items()}
    cost = dict.fromkeys(centres, 0.0)
    for row in cluster_sums(points, centres).collect():     # restarts x k rows
        moved[row["restart"]][row["cluster"]] = row["sx"] / row["n"], row["sy"] / row["n"]
        cost[row["restart"]] += row["cost"]
    return moved, cost


def _first_centres(points: DataFrame, k: int, restarts: int, seed: int) -> dict[int, np.ndarray]:
    def chance(r: int, i: int) -> F.Column:
        """A number in [0, 1) that depends on the point, restart and pass alone."""
        h = F.xxhash64(F.col("id"), F.lit(seed), F.lit(r), F.lit(i))
        return F.pmod(h, F.lit(1 << 30)) / F.lit(float(1 << 30))

    one = points.agg(*[F.min_by(F.struct("x", "y"), F.struct(chance(r, 0), "id")).alias(f"r{r}")
                       for r in range(restarts)]).first()
    if one is None or one["r0"] is None:
        return {}
    kept = {r: np.array([[one[f"r{r}"]["x"], one[f"r{r}"]["y"]]]) for r in range(restarts)}
    for i in range(1, SEEDING_PASSES + 1):
        cost = dict.fromkeys(kept, 0.0)
        for row in cluster_sums(points, kept).collect():
            cost[row["restart"]] += row["cost"]

        def far(batches, kept=dict(kept), cost=cost, i=i):
            for batch in batches:
                xy, ids = batch[["x", "y"]].to_numpy(float), batch["id"].to_numpy(np.int64)
                for r, c in kept.items():
                    if cost[r] <= 0:
                        continue
                    # about 2 k points a pass and restart
                    share = 2.0 * k * _distances(xy, c).min(axis=1) / cost[r]
                    at = batch[f"c{r}"].to_numpy(float) < share
                    if at.any():
                        yield pd.DataFrame({"restart": np.int32(r), "x": xy[at, 0], "y": xy[at, 1],
                                            "id": ids[at]})

        drawn = points.select("*", *[chance(r, i).alias(f"c{r}") for r in kept]).mapInPandas(
            far, "restart int, x double, y double, id long").orderBy("restart", "id").toPandas()
        kept = {r: np.vstack([c, drawn.loc[drawn["restart"] == r, ["x", "y"]].to_numpy(float)])
                for r, c in kept.items()}
    kept = {r: np.unique(c, axis=0) for r, c in kept.items()}
    weight = {r: np.zeros(len(c)) for r, c in kept.items()}
    for row in cluster_sums(points, kept).collect():
        weight[row["restart"]][row["cluster"]] = row["n"]
    return {r: _reduced(c, weight[r], k, np.random.RandomState(seed + r))
            for r, c in kept.items()}


def _reduced(points: np.ndarray, weight: np.ndarray, k: int, random: np.random.RandomState
             ) -> np.ndarray:
    """``k`` of the weighted points (fewer if there are fewer) by k-means++, then moved."""
    weight = np.maximum(weight, 1e-12)
    centres = points[[random.choice(len(points), p=weight / weight.sum())]]
    while len(centres) < min(k, len(points)):
        far = weight * _distances(points, centres).min(axis=1)
        if far.sum() <= 0:
            break
        centres = np.vstack([centres, points[random.choice(len(points), p=far / far.sum())]])
    for _ in range(30):
        near = _distances(points, centres).argmin(axis=1)
        moved = np.array([np.average(points[near == j], axis=0, weights=weight[near == j])
                          if (near == j).any() else c for j, c in enumerate(centres)])
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def fit_location_clusters(stores: DataFrame, k: int = 8, restarts: int = 25,
                          max_iter: int = 1000, seed: int = 0, store: str = "air_store_id"
                          ) -> LocationClusters | None:
    """The restart of least cost; None without any coordinates."""
    dealt = _points(stores, store).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # the number of tasks of a pass follows the points, not the shuffle that found them
        points = dealt.coalesce(max(1, -(-dealt.count() // POINTS))).persist(
            StorageLevel.MEMORY_AND_DISK)
        points.count()
    finally:
        dealt.unpersist()
    try:
        centres = _first_centres(points, k, restarts, seed)
        costs, moving, passes = {}, dict(centres), 0
        while moving:
            moved, cost = kmeans_step(points, moving)
            passes += 1
            for r, c in list(moving.items()):
                costs[r], stays = cost[r], bool(
                    (np.linalg.norm(moved[r] - c, axis=1) <= TOLERANCE).all())
                if stays or passes > max_iter:
                    del moving[r]       # frozen: ``costs`` belongs to its centres
                else:
                    centres[r] = moving[r] = moved[r]
    finally:
        points.unpersist()
    if not costs:
        return None
    best = min(costs, key=lambda r: (costs[r], r))
    return LocationClusters(centres[best], costs[best], passes)


def add_location_cluster(stores: DataFrame, k: int = 8, restarts: int = 25,
                         max_iter: int = 1000, seed: int = 0,
                         model: LocationClusters | None = None) -> DataFrame:
    model = model or fit_location_clusters(stores, k, restarts, max_iter, seed)
    if model is None:
        return stores.withColumn("cluster", F.lit(None).cast("int"))
    return model.assign(stores)
