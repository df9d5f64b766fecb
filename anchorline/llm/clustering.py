"""Centroid clustering with Ptolemaic pivots: exact k-means rounds that skip most distances.

Components become integers, so that distances, sums and centroids are exact. Every vector's
distances to a few pivots are computed once and stored. For pivots p and s, Ptolemy's
inequality bounds the distance of a vector v and a centroid c from below:

    d(v, c) >= |d(v, p) d(c, s) - d(v, s) d(c, p)| / d(p, s)

The bound, rounded down, rules centroids out; what it leaves is compared by exact distances.
Rounds move sums per cluster only, never vectors.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import arrow_map
from anchorline.sources.staging import Staging

DIM = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = "2"
PIVOTS = 6
#: Components end here, so that a squared distance fits 64 bits.
LARGEST = 1 << 27
#: What rounding of square roots, products and quotients can add to a bound, amply.
SLACK = 1e-12
#: Vectors compared at a time.
BLOCK = 2048

STAGED = "vec_id long, comps array<int>, near array<double>"
ASSIGNED = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
    "centroid_sha256 string"
)


def whole(embedding: Column, dim: int = DIM) -> Column:
    """A vector of `dim` components, none null or non-finite; false for a null vector."""
    odd = F.exists(
        embedding,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    return F.coalesce((F.size(embedding) == dim) & ~odd, F.lit(False))


def integers(embedding: Column) -> Column:
    """floor(256 * x) of each component, between -LARGEST and LARGEST."""
    return F.transform(
        embedding,
        lambda x: F.least(
            F.greatest(F.floor(x.cast("double") * SCALE), F.lit(-LARGEST)), F.lit(LARGEST)
        ).cast("int"),
    )


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two arrays of 64-bit integers."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


class Pivots:
    """Fixed pivots, their pairs, and the distances that bounds are made of."""

    def __init__(self, points: np.ndarray):
        self.points = points
        pairs = [
            (i, j, float(np.sqrt(d)))
            for i, j in combinations(range(len(points)), 2)
            if (d := int(squared(points[i : i + 1], points[j : j + 1])[0]))
        ]
        self.first = np.array([p[0] for p in pairs], int)
        self.second = np.array([p[1] for p in pairs], int)
        self.apart = np.array([p[2] for p in pairs])

    @classmethod
    def spread(cls, points: np.ndarray, n: int = PIVOTS) -> Pivots:
        """Up to n of the points, each the farthest from those before it."""
        if not len(points):
            return cls(points)
        chosen = [0]
        far = squared(points, points[:1])
        while len(chosen) < min(n, len(points)) and far.max():
            chosen.append(int(far.argmax()))
            far = np.minimum(far, squared(points, points[chosen[-1 :]]))
        return cls(points[chosen])

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Each point's distance to each pivot."""
        out = [np.sqrt(squared(points, p[None])) for p in self.points]
        return np.stack(out, axis=1) if out else np.zeros((len(points), 0))

    def bounds(self, near: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Squares below the squared distance of each point (row) to each centroid, given
        both sides' distances to the pivots."""
        out = np.zeros((len(near), len(centroids)))
        for p, s, apart in zip(self.first, self.second, self.apart, strict=True):
            x = np.outer(near[:, p], centroids[:, s])
            y = np.outer(near[:, s], centroids[:, p])
            np.maximum(out, (np.abs(x - y) - SLACK * (x + y)) / apart, out=out)
        return out * out * (1 - SLACK)


def nearest(
    comps: np.ndarray, near: np.ndarray, pivots: Pivots, centroids: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Each vector's nearest centroid, the smaller number on ties, its squared distance, and
    how many distances were computed."""
    cluster = np.zeros(len(comps), np.int64)
    distance = np.zeros(len(comps), np.int64)
    centroid_near, computed = pivots.distances(centroids), 0
    for at in range(0, len(comps), BLOCK):
        block = comps[at : at + BLOCK]
        bounds = pivots.bounds(near[at : at + BLOCK], centroid_near)
        first = bounds.argmin(axis=1)
        known = squared(block, centroids[first])
        row, col = np.nonzero(bounds <= known[:, None])
        exact = squared(block[row], centroids[col])
        starts = np.searchsorted(row, np.arange(len(block)))
        least = np.minimum.reduceat(exact, starts)
        ties = np.flatnonzero(exact == least[row])[::-1]
        cluster[at + row[ties]] = col[ties]
        distance[at : at + BLOCK] = least
        computed += len(block) + len(row)
    return cluster, distance, computed


def matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """A column of lists of the same length as an array with one row per list."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(kind)


def initial(kept: DataFrame, clusters: int, dim: int) -> np.ndarray:
    """The vectors whose ids' digests are smallest. Ids that are null come last."""
    order = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(order.asc_nulls_last(), "comps").limit(clusters).select("comps").collect()
    return np.array([r[0] for r in rows], np.int64).reshape(-1, dim)


def cluster_sums(staged: DataFrame, pivots: Pivots, centroids: np.ndarray) -> DataFrame:
    """cluster, place, total, n: sums of each component over each cluster's vectors.

    A task gives one row per cluster and component.
    """
    k, dim = centroids.shape

    def rows(batches):
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            comps = matrix(batch.column(0), dim, np.int64)
            near = matrix(batch.column(1), len(pivots.points), float)
            cluster, _, _ = nearest(comps, near, pivots, centroids)
            order = np.argsort(cluster, kind="stable")
            found, starts, n = np.unique(cluster[order], return_index=True, return_counts=True)
            if len(found):
                sums[found] += np.add.reduceat(comps[order], starts)
                counts[found] += n
        full = np.flatnonzero(counts)
        yield {
            "cluster": np.repeat(full, dim).astype(np.int32),
            "place": np.tile(np.arange(dim, dtype=np.int32), len(full)),
            "total": sums[full].ravel(),
            "n": np.repeat(counts[full], dim),
        }

    found = arrow_map(
        staged.select("comps", "near"), "cluster int, place int, total long, n long", rows
    )
    return found.groupBy("cluster", "place").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )


def moved(staged: DataFrame, pivots: Pivots, centroids: np.ndarray) -> np.ndarray:
    """Every non-empty cluster's componentwise floor(sum / count); empty ones stay. The
    driver sees one row per cluster and component."""
    out = centroids.copy()
    for r in cluster_sums(staged, pivots, centroids).collect():
        out[r["cluster"], r["place"]] = r["total"] // r["n"]
    return out


def assigned(staged: DataFrame, pivots: Pivots, centroids: np.ndarray) -> DataFrame:
    def rows(batches):
        for batch in batches:
            comps = matrix(batch.column(1), centroids.shape[1], np.int64)
            near = matrix(batch.column(2), len(pivots.points), float)
            cluster, distance, _ = nearest(comps, near, pivots, centroids)
            yield {
                "vec_id": batch.column(0),
                "cluster": cluster.astype(np.int32),
                "distance": distance,
            }

    return arrow_map(staged, "vec_id long, cluster int, distance long", rows)


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    vectors: DataFrame,
    staging: Staging,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dim: int = DIM,
    pivots: int = PIVOTS,
) -> DataFrame:
    """Per kept vector vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, of another length, or with a null or non-finite component are left
    out. Components beyond 2^27 in size count as that; an inertia beyond 64 bits is null.
    Null ids stay null and come last in the choice of first centroids, repeated rows count
    and repeat, fewer vectors than clusters give as many clusters, no vector gives no row.
    Other columns are not read.
    """
    kept = vectors.where(whole(F.col("embedding"), dim)).select(
        F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding")).alias("comps")
    )
    centroids = initial(kept, clusters, dim)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], ASSIGNED)
    fixed = Pivots.spread(centroids, pivots)

    def with_distances(batches):
        for batch in batches:
            near = fixed.distances(matrix(batch.column(1), dim, np.int64))
            bounds = pa.array(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1])
            yield {
                "vec_id": batch.column(0),
                "comps": batch.column(1),
                "near": pa.ListArray.from_arrays(bounds, pa.array(near.ravel())),
            }

    staged = staging.table(arrow_map(kept, STAGED, with_distances), "vectors")
    for _ in range(rounds):
        centroids = moved(staged, fixed, centroids)
    final = staging.table(assigned(staged, fixed, centroids), "assigned")
    sums = final.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    )
    totals = {r["cluster"]: int(r["total"]) for r in sums.collect()}

    def in_range(total: int) -> int | None:
        return total if total < 1 << 63 else None

    about = vectors.sparkSession.createDataFrame(
        [
            (c, in_range(n), in_range(sum(totals.values())), digest(centroids[c]))
            for c, n in sorted(totals.items())
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )  # a row per cluster at most
    return final.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def oracle_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM) -> str:
    """The same by comparing every vector with every centroid, in DuckDB's SQL."""
    parts = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
            WHERE len(embedding) = {dim}
              AND (SELECT count(*) FROM unnest(embedding) AS u(x) WHERE isfinite(x)) = {dim})""",
        f"""comps AS MATERIALIZED (
            SELECT r, i, CAST(greatest(least(floor({SCALE} * CAST(embedding[i] AS DOUBLE)),
                {LARGEST}), -{LARGEST}) AS BIGINT) AS x
            FROM kept, range(1, {dim + 1}) AS t(i))""",
        f"""first AS (
            SELECT r, row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR))
                NULLS LAST, v) - 1 AS c
            FROM kept JOIN (SELECT r, list(x ORDER BY i) AS v FROM comps GROUP BY r) USING (r))""",
        f"""centroids0 AS MATERIALIZED (
            SELECT c, i, x FROM first JOIN comps USING (r) WHERE c < {clusters})""",
    ]
    for n in range(rounds + 1):
        parts.append(
            f"""assigned{n} AS MATERIALIZED (
                SELECT r, c, CAST(d AS BIGINT) AS d FROM (
                    SELECT v.r, k.c, sum((v.x - k.x) * (v.x - k.x)) AS d
                    FROM comps v JOIN centroids{n} k USING (i) GROUP BY v.r, k.c)
                QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
        )
        if n < rounds:
            parts.append(
                f"""centroids{n + 1} AS MATERIALIZED (
                    SELECT c, i, CAST(CASE WHEN n IS NULL THEN k.x
                        ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x
                    FROM centroids{n} k LEFT JOIN (
                        SELECT c, i, sum(x) AS s, count(*) AS n
                        FROM comps JOIN assigned{n} USING (r) GROUP BY c, i) USING (c, i))"""
            )
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance,
            CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
            CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
        FROM assigned{rounds} JOIN kept USING (r) JOIN (
            SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h
            FROM centroids{rounds} GROUP BY c) USING (c)"""


SQL = oracle_sql()
