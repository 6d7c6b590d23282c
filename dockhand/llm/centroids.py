"""Centroid clustering of integer vectors in JVM expressions alone.

Vectors are arrays of integers and the centroids of a round are one literal
array of arrays. For each row ``transform`` goes over the centroids,
``zip_with`` and ``aggregate`` give the squared distance, and ``array_min`` of
(distance, number) structs the cluster, ties to the smaller number. A round is
one aggregation by cluster: a count and one sum for each component, summed in
every task before the shuffle, so a cluster that holds most rows costs one row
a task. Only these sums, clusters times components, come to the driver, where
the next literal is made: ``MOST_NUMBERS`` bounds them. There is no Python
code, pandas or Arrow on the rows' way.

Defined results: vectors that are null, hold null or non-finite components or
have another number of components take no part; a null ``vec_id`` hashes as
the empty number; rows that repeat an id are vectors of their own; equal
hashes are ordered by vector; with fewer vectors than clusters there are as
many centroids as vectors; an empty table gives no rows; a squared distance or
a sum beyond 2^63 fails the job (ANSI mode) and is never wrong silently; other
columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import written

CLUSTERS = 40
COMPONENTS = 64
ROUNDS = 5
SCALE = 256
SEED = 2
MOST_NUMBERS = 1 << 18  # clusters times components, which the driver and each plan hold

Centroids = list[list[int]]


def integer_vectors(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, e): floor(scale * x) of every component x, taken as a double."""
    e = F.col("embedding")
    double = F.transform(e, lambda x: x.cast("double"))
    whole = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.filter((F.size(e) == components) & F.coalesce(whole, F.lit(False)))
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(double, lambda x: F.floor(x * scale).cast("long")).alias("e")
    )


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> Centroids:
    """The vectors of the smallest hashes of ``seed:vec_id``, in that order."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    hashed = vectors.select(F.sha2(text.cast("binary"), 256).alias("hash"), "e")
    return [list(row["e"]) for row in hashed.orderBy("hash", "e").limit(clusters).collect()]


def literal(centroids: Centroids) -> Column:
    """The centroids as one constant of type array<array<bigint>>."""
    return F.expr("array(" + ",".join("array(" + ",".join(f"{x}L" for x in c) + ")" for c in centroids) + ")")


def nearest(vector: Column, centroids: Centroids) -> Column:
    """struct(distance, cluster) of the nearest centroid, ties to the smaller number."""

    def distance(c: Column) -> Column:
        squares = F.zip_with(vector, c, lambda x, y: (x - y) * (x - y))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda total, square: total + square)

    each = F.transform(literal(centroids), lambda c, k: F.struct(distance(c).alias("distance"), k.alias("cluster")))
    return F.array_min(each)


def assigned(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """The vectors with ``cluster`` and ``distance``."""
    return vectors.withColumn("near", nearest(F.col("e"), centroids)).select(
        *vectors.columns, F.col("near.cluster").cast("int").alias("cluster"), F.col("near.distance").alias("distance")
    )


def moved(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """Each centroid at the floor of the mean of its vectors; one without vectors stays."""
    n = len(centroids[0])
    sums = [F.sum(F.col("e")[i]).alias(f"s{i}") for i in range(n)]
    out = list(centroids)
    for row in assigned(vectors, centroids).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(n)]
    return out


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def clusters_of(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    components: int = COMPONENTS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector. Runs a job a round."""
    if clusters * components > MOST_NUMBERS:
        raise ValueError(f"more than {MOST_NUMBERS} numbers of centroids")
    kept = written(integer_vectors(vectors, components, scale))
    centroids = first_centroids(kept, clusters, seed)
    spark = vectors.sparkSession
    if not centroids:
        return kept.limit(0).select(
            "vec_id", F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")),
            F.lit("").alias("centroid_sha256"),
        )
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    final = written(assigned(kept, centroids).select("vec_id", "cluster", "distance"))
    spread = {r["cluster"]: r["d"] for r in final.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    facts = spark.createDataFrame(
        [(k, spread[k], sum(spread.values()), digest(centroids[k])) for k in sorted(spread)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # one row a cluster, at most ``clusters``
    return final.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def twin_sql(clusters: int = CLUSTERS, components: int = COMPONENTS, rounds: int = ROUNDS) -> str:
    """The same as DuckDB SQL, a block of common table expressions a round."""
    near = """
        a{k} AS MATERIALIZED (
            SELECT n, vec_id, e, c, d FROM (
                SELECT v.n, v.vec_id, v.e, m.c,
                       CAST(list_sum(list_transform(list_zip(v.e, m.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d,
                       row_number() OVER (PARTITION BY v.n ORDER BY d, m.c) AS place
                FROM v CROSS JOIN c{k} m
            ) WHERE place = 1
        )"""
    move = """
        t{k} AS (
            SELECT c, i, sum(x) AS s, count(*) AS n
            FROM (SELECT c, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{k}) GROUP BY c, i
        ),
        c{next} AS MATERIALIZED (
            SELECT m.c, coalesce(f.e, m.e) AS e FROM c{k} m LEFT JOIN (
                SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM t{k} GROUP BY c
            ) f ON f.c = m.c
        )"""
    steps = [near.format(k=k) + "," + move.format(k=k, next=k + 1) for k in range(rounds)] + [near.format(k=rounds)]
    return f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS n, vec_id,
                   list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE len(embedding) = {components} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, e) - 1 AS c, e FROM (
                SELECT sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, e FROM v ORDER BY h, e LIMIT {clusters}
            )
        ),{",".join(steps)}
        SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
               CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.e, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} m ON m.c = a.c
    """
