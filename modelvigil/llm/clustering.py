"""Centroid clustering in integers; Ptolemy's inequality over pivot pairs spares distances."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelvigil.llm.common import table
from modelvigil.llm.topk import usable
from modelvigil.session import scratch_path

SCALE, WIDTH, CLUSTERS, ROUNDS, SALT = 256, 64, 40, 5, 2
#: Pivots: so many of the first centroids, which stay where they are. Each vector keeps its distances to them.
PIVOTS = 16
#: Scaled components beyond this are cut to it, so that a squared distance of ``WIDTH`` of them fits in a long.
LARGEST = 1 << 27
#: Vectors compared at a time.
ROWS = 8_192
#: Above this share of survivors one matrix product is cheaper than single distances.
DENSE = 0.3
#: Products and quotients of rounded square roots are off by less than this, relative to their parts.
_ROUNDING = 4e-15
#: Squared distances up to this are whole in double precision.
_EXACT = 2.0**53


def squared_distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows (int64) to all points, as longs."""
    largest = max(int(np.abs(rows).max(initial=0)), int(np.abs(points).max(initial=0)))
    if 4 * rows.shape[1] * largest**2 < _EXACT:  # every term and sum is a whole number in double precision
        a, b = rows.astype(np.float64), points.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((rows - point) ** 2).sum(1) for point in points], axis=1)


def paired_distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to the point beside it."""
    apart = rows - points
    return np.einsum("ij,ij->i", apart, apart)


class Pivots:
    """Fixed points; what is known of a vector or a centroid are its distances to them."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.apart = np.sqrt(squared_distances(points, points).astype(np.float64))

    def distances(self, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(squared_distances(rows, self.points).astype(np.float64))

    def bounds(self, own: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances of vectors to centroids, given the pivot distances of both.

        Ptolemy: d(v,c) d(p,q) >= |d(v,p) d(c,q) - d(v,q) d(c,p)|. Of all pairs the pivot nearest to the vector and
        the one nearest to the centroid say most, as the bound is then close to d(p,q). Rounding is taken off.
        """
        near, far = own.argmin(1), other.argmin(1)
        one = own[np.arange(len(own)), near][:, None] * other[np.arange(len(other)), far]
        two = own[:, far] * other[:, near].T
        apart = self.apart[np.ix_(near, far)]
        found = np.abs(one - two) - _ROUNDING * (one + two)
        return np.divide(found, apart, out=np.zeros_like(found), where=apart > 0) * (1 - _ROUNDING)


def nearest(
    rows: np.ndarray, known: np.ndarray, centroids: np.ndarray, centroids_known: np.ndarray, pivots: Pivots
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row (ties: the smaller number), its squared distance, and the distances computed.

    The centroid of the least bound is tried first; only those whose bound does not exceed its distance are left.
    """
    bounds = pivots.bounds(known, centroids_known)
    first = bounds.argmin(1)
    best = paired_distances(rows, centroids[first])
    left = bounds <= (np.sqrt(best.astype(np.float64)) * (1 + _ROUNDING))[:, None]
    left[np.arange(len(rows)), first] = True
    if left.mean() > DENSE:
        found = np.where(left, squared_distances(rows, centroids), np.iinfo(np.int64).max)
    else:
        found = np.full(left.shape, np.iinfo(np.int64).max)
        row, point = np.nonzero(left)
        for a in range(0, len(row), ROWS):
            some, to = row[a : a + ROWS], point[a : a + ROWS]
            found[some, to] = paired_distances(rows[some], centroids[to])
    chosen = found.argmin(1)
    return chosen, found[np.arange(len(rows)), chosen], int(left.sum())


def _rows(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, width)


class Clustering:
    """Vectors kept with their pivot distances in a table of the shared folder, and the centroids of each round."""

    def __init__(self, vectors: DataFrame, clusters: int, rounds: int, salt: int, pivots: int, width: int):
        """``vectors``: ``vec_id`` long and ``terms``, arrays of ``width`` longs."""
        self.spark, self.width = vectors.sparkSession, width
        name = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
        seeds = vectors.select("terms", name.alias("name")).orderBy(F.asc_nulls_last("name"), "terms").limit(clusters)
        self.centroids = np.array([r.terms for r in seeds.collect()], dtype=np.int64).reshape(-1, width)
        self.computed = 0
        if len(self.centroids):
            self.pivots = Pivots(self.centroids[:pivots])
            self.kept = self._keep(vectors)
            for _ in range(rounds):
                self.centroids = self._moved()

    def _keep(self, vectors: DataFrame) -> DataFrame:
        pivots, width, out = self.pivots, self.width, pa.schema([
            ("vec_id", pa.int64()), ("code", pa.binary()), ("known", pa.binary()),
        ])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    rows = batch.column("terms").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                    code, known = rows.astype("<i4"), pivots.distances(rows)
                    yield pa.RecordBatch.from_arrays([
                        batch.column("vec_id"), pa.array([r.tobytes() for r in code], pa.binary()),
                        pa.array([r.tobytes() for r in known], pa.binary()),
                    ], schema=out)

        target = scratch_path(self.spark, "clustering-vectors")
        vectors.select("vec_id", "terms").mapInArrow(work, "vec_id long, code binary, known binary").write.parquet(target)
        return self.spark.read.parquet(target)

    def _pass(self):
        """The work of one pass: batches to (vec_id column, rows, clusters, squared distances, distances computed)."""
        pivots, width, centroids = self.pivots, self.width, self.centroids
        count = len(pivots.points)
        centroids_known = pivots.distances(centroids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for batch in batches:
                for a in range(0, batch.num_rows, ROWS):
                    some = batch.slice(a, ROWS)
                    rows = _rows(some.column("code"), "<i4", width).astype(np.int64)
                    known = _rows(some.column("known"), "<f8", count)
                    yield (some.column("vec_id"), rows, *nearest(rows, known, centroids, centroids_known, pivots))

        return run

    def _moved(self) -> np.ndarray:
        """Centroids after a round: floor(sum / count) of each component; a centroid without vectors stays.

        A task adds up its own vectors, so a row a cluster, component and task is shuffled, whatever the clusters' sizes.
        """
        run, k, width = self._pass(), len(self.centroids), self.width
        out = pa.schema([("cluster", pa.int32()), ("place", pa.int32()), ("total", pa.int64()), ("n", pa.int64())])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals, counts = np.zeros((k, width), dtype=np.int64), np.zeros(k, dtype=np.int64)
            computed = 0
            for _, rows, chosen, _, spent in run(batches):
                order = np.argsort(chosen, kind="stable")
                owners, starts, sizes = np.unique(chosen[order], return_index=True, return_counts=True)
                totals[owners] += np.add.reduceat(rows[order], starts, axis=0)
                counts[owners] += sizes
                computed += spent
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(np.repeat(used, width), -1), pa.int32()),
                pa.array(np.append(np.tile(np.arange(width), len(used)), 0), pa.int32()),
                pa.array(np.append(totals[used].ravel(), computed), pa.int64()),
                pa.array(np.append(np.repeat(counts[used], width), counts.sum()), pa.int64()),
            ], schema=out)

        partial = self.kept.select("vec_id", "code", "known").mapInArrow(work, "cluster int, place int, total long, n long")
        sums = partial.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        moved = self.centroids.copy()
        for r in sums.collect():  # clusters times components
            if r.cluster < 0:
                self.computed += r.total
            else:
                moved[r.cluster, r.place] = r.total // r.n
        return moved

    def assigned(self) -> DataFrame:
        """``vec_id``, ``cluster``, ``distance`` of every vector, written to the shared folder and read again."""
        schema = "vec_id long, cluster int, distance long"
        if not len(self.centroids):
            return self.spark.createDataFrame([], schema)
        run = self._pass()
        out = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, _, chosen, distance, _ in run(batches):
                yield pa.RecordBatch.from_arrays([ids, pa.array(chosen, pa.int32()), pa.array(distance)], schema=out)

        target = scratch_path(self.spark, "clustering-result")
        self.kept.mapInArrow(work, schema).write.parquet(target)
        return self.spark.read.parquet(target)


def scaled(vectors: DataFrame, scale: int = SCALE, width: int = WIDTH) -> DataFrame:
    """``vec_id`` and ``terms``: floor(scale * component), in double; vectors of another width or with a component
    that is null or not finite are left out."""
    held = lambda x: F.greatest(F.least(x, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    terms = F.transform("embedding", lambda x: F.floor(held(x.cast("double") * F.lit(float(scale)))).cast("long"))
    kept = vectors.where(usable("embedding") & (F.size("embedding") == width))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), terms.alias("terms"))


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, salt: int = SALT, pivots: int = PIVOTS,
    width: int = WIDTH,
) -> Clustering:
    """Cluster ``vec_id``, ``terms`` (arrays of ``width`` longs, none null) around ``clusters`` centroids.

    The centroids start as the vectors with the smallest sha256 of ``salt:vec_id`` (ties by terms, null ids last)
    and move ``rounds`` times to the floor of their vectors' mean. With fewer vectors than ``clusters`` there are as
    many centroids; with none the result is empty. Equal vectors, repeated ids and null ids are vectors of their
    own; a tie goes to the smaller number. Other columns are not read. ``pivots`` changes no result.

    Each round is one pass over the stored vectors; sums are made before the shuffle. The driver holds the
    centroids alone, ``clusters`` times ``width`` numbers.
    """
    return Clustering(vectors, clusters, rounds, salt, pivots, width)


def with_inertia(found: Clustering) -> DataFrame:
    """Assignments with the inertia of their cluster and of all, and the digest of the final centroid."""
    rows = found.assigned()
    inertia = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("cluster_inertia"))
    by_cluster = {r.cluster: r.cluster_inertia for r in inertia.collect()}  # a row a cluster
    prints = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centroids]
    digest = found.spark.createDataFrame(
        [(c, n, prints[c]) for c, n in by_cluster.items()], "cluster int, cluster_inertia long, centroid_sha256 string"
    )
    total = F.lit(sum(by_cluster.values())).cast("long")
    return rows.join(F.broadcast(digest), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", total.alias("inertia"), "centroid_sha256",
    )


def op11_clustering(spark, folder: str) -> DataFrame:
    return with_inertia(cluster(scaled(table(spark, folder, "embeddings"))))


def _oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    def assigned(turn: int) -> str:
        return f"""
assigned{turn} AS MATERIALIZED (
    SELECT row, vec_id, terms, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
    FROM (SELECT v.row, v.vec_id, v.terms, c.cluster,
                 v.norm - 2 * list_inner_product(v.terms, c.terms) + list_inner_product(c.terms, c.terms) AS distance
          FROM vectors v, centroids{turn} c)
    GROUP BY row, vec_id, terms)"""

    def moved(turn: int) -> str:
        return f"""
centroids{turn} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.terms, c.terms) AS terms
    FROM centroids{turn - 1} c LEFT JOIN (
        SELECT cluster, list(CAST(mean AS DOUBLE) ORDER BY place) AS terms
        FROM (SELECT cluster, place,
                     (sum(term) - ((sum(term) % count(*)) + count(*)) % count(*)) // count(*) AS mean
              FROM (SELECT cluster, unnest(range({WIDTH})) AS place, CAST(unnest(terms) AS HUGEINT) AS term
                    FROM assigned{turn - 1})
              GROUP BY cluster, place)
        GROUP BY cluster) m ON m.cluster = c.cluster)"""

    turns = ",".join(part for turn in range(1, rounds + 1) for part in (moved(turn), assigned(turn)))
    return f"""
WITH scaled AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS terms
    FROM embeddings
    WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, terms, list_inner_product(terms, terms) AS norm FROM scaled),
centroids0 AS MATERIALIZED (
    SELECT cluster, terms FROM (
        SELECT terms, CAST(row_number() OVER (
                   ORDER BY sha256('{SALT}:' || CAST(vec_id AS VARCHAR)) NULLS LAST, terms) - 1 AS INT) AS cluster
        FROM vectors)
    WHERE cluster < {clusters}),{assigned(0)},{turns}
SELECT a.vec_id, a.cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c.terms, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM assigned{rounds} a JOIN centroids{rounds} c ON c.cluster = a.cluster
"""


ORACLE = _oracle()
