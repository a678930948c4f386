"""Clustering of vectors by exact integer k-means: Shallot search inside tasks, sums by Spark between the rounds."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm import shallot as S
from citylake.llm.common import dropped, staged

_STATE = "id {id}, x array<int>, near int, second int, upper double, lower double"


def kept_vectors(vectors: DataFrame, dims: int = 64, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x): rows whose vector has exactly ``dims`` components, none null or non-finite, as integers floor(scale * component).
    Components of more than 2 ** 27 in absolute value end the job with an error: their squared distances don't fit a long."""
    v = F.col(f"`{vector_col}`")
    fine = (F.size(v) == dims) & F.forall(v, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < float("inf")))
    whole = F.transform(v, lambda e: F.floor(e.cast("double") * F.lit(float(scale))))
    fits = F.forall(v, lambda e: F.abs(e.cast("double") * F.lit(float(scale))) < float(S.LARGEST))
    return (vectors.where(F.coalesce(fine, F.lit(False)))
            .select(F.col(f"`{id_col}`").alias("id"),
                    F.when(fits, whole.cast("array<int>")).otherwise(F.raise_error(F.lit("a component is too large for exact distances in 64 bits")).cast("array<int>")).alias("x")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _round(points: np.ndarray, shift: np.ndarray | None, dims: int):
    """One assignment of every vector; the first (without ``shift``) begins the state."""
    def run(batches):
        c = S.Centroids(points)
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            if shift is None:
                state = S.begin(len(x))
            else:
                state = S.drift(tuple(batch.column(n).to_numpy() for n in ("near", "second", "upper", "lower")), shift)
            state, _ = S.search(x, state, c)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), *map(pa.array, state)], ["id", "x", "near", "second", "upper", "lower"])
    return run


def _sums(dims: int):
    """Per task: the number of vectors and the componentwise sums of each centroid."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x, near = _matrix(batch.column("x"), dims), batch.column("near").to_numpy()
            for k in np.unique(near):
                mine = x[near == k]
                total[int(k)] = total.get(int(k), 0) + np.concatenate([[len(mine)], mine.sum(0)])
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([list(map(int, t)) for t in total.values()], pa.list_(pa.int64()))], ["near", "sums"])
    return run


def _nearest_distance(points: np.ndarray, dims: int):
    def run(batches):
        c = S.Centroids(points)
        for batch in batches:
            x, near = _matrix(batch.column("x"), dims), batch.column("near").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("near"), pa.array(S.distances(x, near, c))], ["id", "cluster", "distance"])
    return run


def start_points(kept: DataFrame, k: int, dims: int, salt: str = "2") -> np.ndarray:
    """The kept vectors with the smallest lowercase-hex sha256 of ``<salt>:<id>``, in ascending order; ties by components. A null id
    hashes as no digits."""
    rank = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = kept.select(rank.alias("h"), "x").orderBy("h", "x").limit(k).collect()  # k rows
    return np.array([r["x"] for r in rows], np.int64).reshape(len(rows), dims)


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, id_col: str = "vec_id",
            vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) of every kept vector, final centroids).

    Each round assigns every vector to the nearest centroid (ties: smaller number) and moves every non-empty centroid to the
    floor of its vectors' mean; a last assignment follows. Between rounds the vectors lie in a written table with their
    bounds, and superseded tables are deleted. Only (count, sums) of each task and centroid are shuffled, and k rows of
    them reach the driver, so a centroid that holds most vectors is summed in all tasks.
    """
    kept = kept_vectors(vectors, dims, scale, id_col, vector_col)
    points = start_points(kept, k, dims)
    id_type = vectors.schema[id_col].dataType.simpleString()
    if not len(points):
        return kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where(F.lit(False)), points
    now, shift = kept, None
    for turn in range(rounds + 1):
        last = now
        now = staged(last.mapInArrow(_round(points, shift, dims), _STATE.format(id=id_type)), "centroid-round")
        if turn:
            dropped(last)
        if turn == rounds:
            break
        sums = now.select("x", "near").mapInArrow(_sums(dims), "near int, sums array<long>").select("near", F.posexplode("sums").alias("i", "s"))
        new = points.copy()
        total = {(r["near"], r["i"]): r["s"] for r in sums.groupBy("near", "i").agg(F.sum("s").alias("s")).collect()}  # at most k * (dims + 1) rows
        for j in range(len(points)):
            if (j, 0) in total:
                new[j] = [total[j, i + 1] // total[j, 0] for i in range(dims)]
        points, shift = new, S.moved(points, new)
    return now.mapInArrow(_nearest_distance(points, dims), f"id {id_type}, cluster int, distance long"), points


def cluster_report(vectors: DataFrame, id_col: str = "vec_id", **options) -> DataFrame:
    """One row per kept vector: id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` (distance summed over the cluster
    and over all vectors), ``centroid_sha256`` (lowercase hex, of the final centroid's components joined by commas).

    Rows with a null vector, another number of components, or a null, infinite or NaN component are left out; an empty table gives no
    rows. With fewer kept vectors than centroids each is a centroid. Repeated rows and rows with a null id each count.
    Other columns are ignored.
    """
    found, points = cluster(vectors, id_col=id_col, **options)
    found = staged(found, "centroid-distances")
    spark = vectors.sparkSession
    inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(j, inertia.get(j, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, p.tolist())).encode()).hexdigest()) for j, p in enumerate(points)]
    each = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # one row per centroid
    return (found.join(F.broadcast(each), "cluster")
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _oracle(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """The same in DuckDB SQL, one pair of statements per round."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dims}),
p0 AS MATERIALIZED (
  SELECT c, v FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v FROM kept) WHERE c < {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT row, m.d AS d, m.c AS c FROM (
    SELECT row, min(struct_pack(d := d, c := c)) AS m FROM (
      SELECT row, c, CAST(list_sum([(k.v[i] - p.v[i]) * (k.v[i] - p.v[i]) FOR i IN range(1, {dims + 1})]) AS BIGINT) AS d FROM kept k, p{r} p) GROUP BY row))""")
        if r < rounds:
            steps.append(f"""
p{r + 1} AS MATERIALIZED (
  SELECT p.c, coalesce(n.v, p.v) AS v FROM p{r} p LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
      SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{r} JOIN kept USING (row), range(1, {dims + 1}) AS t(i) GROUP BY c, i) GROUP BY c) n ON p.c = n.c)""")
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(p.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (row) JOIN p{rounds} p USING (c)
"""


ORACLE = _oracle()
