"""Centroid clustering on bit planes: exact dot products by AND and bit counts.

A component becomes the whole number floor(scale * x), less the smallest one of all, so that it is
not negative; distances do not change by that. Bit i of the 64 components of a vector is one
unsigned 64-bit word, its plane i. The dot product of two vectors is then the sum over planes i
and j of 2**(i + j) times the number of bits set in both words, and
|x - c|**2 = |x|**2 + |c|**2 - 2 x*c is exact.

A round assigns the staged planes and adds up each cluster in every task, so a task sends one row
per centroid, whatever the number of vectors in a cluster. The driver holds the centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlog.llm.common import ddl, release_memory
from foldlog.staging import stage

COMPONENTS = 64
#: Planes of a word per component: 64 squares of numbers below 2**28 stay below 2**62.
_MOST_PLANES = 28
#: Vectors that are compared with all centroids at once; their counts stay in the processor's cache.
_AT_ONCE = 2048


def planes_of(values: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` planes of each row of 64 whole numbers from 0 to 2**count - 1."""
    out = np.empty((len(values), count), np.uint64)
    for i in range(count):
        bits = ((values >> i) & 1).astype(np.uint8)
        out[:, i] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def values_of(planes: np.ndarray) -> np.ndarray:
    """The rows of 64 whole numbers that ``planes_of`` packed."""
    out = np.zeros((len(planes), COMPONENTS), np.int64)
    for i in range(planes.shape[1]):
        own = np.ascontiguousarray(planes[:, i]).astype("<u8").view(np.uint8).reshape(-1, 8)
        out += np.unpackbits(own, axis=1, bitorder="little").astype(np.int64) << i
    return out


def plane_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dot products of all rows of ``left`` with all of ``right``, both given as planes."""
    planes = left.shape[1]
    out = np.zeros((len(left), len(right)), np.int64)
    for weight in range(2 * planes - 1):
        # Up to 28 counts of up to 64 bits have this weight.
        counted = np.zeros(out.shape, np.uint16)
        for i in range(max(0, weight - planes + 1), min(weight, planes - 1) + 1):
            counted += np.bitwise_count(left[:, i, None] & right[None, :, weight - i])
        out += counted.astype(np.int64) << weight
    return out


def squared_lengths(planes: np.ndarray) -> np.ndarray:
    """The dot product of each row with itself."""
    out = np.zeros(len(planes), np.int64)
    for i in range(planes.shape[1]):
        for j in range(planes.shape[1]):
            out += np.bitwise_count(planes[:, i] & planes[:, j]).astype(np.int64) << (i + j)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each row; the smaller number at a tie."""
    chosen, distance = np.zeros(len(planes), np.int64), np.zeros(len(planes), np.int64)
    lengths = squared_lengths(centroids)
    for begin in range(0, len(planes), _AT_ONCE):
        some = planes[begin : begin + _AT_ONCE]
        far = squared_lengths(some)[:, None] + lengths - 2 * plane_products(some, centroids)
        best = far.argmin(axis=1)
        chosen[begin : begin + len(some)] = best
        distance[begin : begin + len(some)] = far[np.arange(len(some)), best]
    return chosen, distance


def _packed(words: np.ndarray) -> pa.Array:
    """Rows of unsigned words as binary."""
    return pa.array([row.tobytes() for row in words.astype("<u8")], pa.binary())


def _unpacked(column: pa.Array, count: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, count)


def kept_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, numbers): vectors of exactly 64 components, none null or not finite, as whole numbers."""
    vector = F.col(vector_col).cast("array<double>")
    sound = (F.size(vector) == COMPONENTS) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return df.where(F.coalesce(sound, F.lit(False))).select(
        F.col(id_col).alias("vec_id"),
        F.transform(vector, lambda x: F.floor(x * F.lit(float(scale)))).alias("numbers"),
    )


def _staged_planes(vectors: DataFrame, low: int, count: int) -> DataFrame:
    schema = pa.schema([("planes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            words = planes_of(flat.reshape(-1, COMPONENTS) - low, count)
            yield pa.RecordBatch.from_arrays([batch.column(0), _packed(words)], ["vec_id", "planes"])
        release_memory()

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    packed = vectors.select("vec_id", "numbers").mapInArrow(run, f"vec_id {id_type}, {ddl(schema)}")
    return stage(packed, "planes")


def _starts(staged: DataFrame, hashed: Column, rows: int, clusters: int, count: int) -> np.ndarray:
    """Planes of the rows with the smallest hashes; rows of one hash by their planes.

    Hashes are spread evenly, so a bound on them lets few rows through; it is raised until enough
    are there. Equal rows are counted before they are sent, and the driver gets ``clusters`` rows
    of each partition of the counted table at most.
    """
    share = (8 * clusters + 64) / max(rows, 1)
    while True:
        few = staged.withColumn("hash", hashed)
        if share < 1:
            few = few.where(F.col("hash") < f"{int(share * 2**64):016x}")
        found = few.groupBy("hash", "planes").count().orderBy("hash", "planes").limit(clusters).collect()
        words = [r["planes"] for r in found for _ in range(min(r["count"], clusters))][:clusters]
        if len(words) == min(clusters, rows) or share >= 1:
            return np.frombuffer(b"".join(words), "<u8").reshape(-1, count)
        share *= 8


def _moved(staged: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of the mean of each cluster; empty ones stay."""
    schema = pa.schema([("cluster", pa.int64()), ("members", pa.int64()), ("sums", pa.list_(pa.int64()))])
    count = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), COMPONENTS), np.int64)
        for batch in batches:
            if batch.num_rows:
                words = _unpacked(batch.column(0), count)
                chosen, _ = nearest(words, centroids)
                order = np.argsort(chosen, kind="stable")
                numbers, first = np.unique(chosen[order], return_index=True)
                members += np.bincount(chosen, minlength=len(members))
                sums[numbers] += np.add.reduceat(values_of(words[order]), first, axis=0)
        own = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own), pa.array(members[own]), pa.array(sums[own].tolist(), schema.field("sums").type)],
            schema=schema,
        )
        release_memory()

    parts = staged.select("planes").mapInArrow(run, ddl(schema))
    # A row per centroid and component at most.
    total = (
        parts.select("cluster", "members", F.posexplode("sums").alias("place", "part"))
        .groupBy("cluster", "place")
        .agg(*(F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("members", "part")))
        .collect()
    )
    values = values_of(centroids)
    for r in total:
        values[r["cluster"], r["place"]] = int(r["part"]) // int(r["members"])
    return planes_of(values, count)


def _assigned(staged: DataFrame, centroids: np.ndarray) -> DataFrame:
    count = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, distance = nearest(_unpacked(batch.column(1), count), centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(chosen.astype(np.int32)), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )
        release_memory()

    id_type = staged.schema["vec_id"].dataType.simpleString()
    return staged.mapInArrow(run, f"vec_id {id_type}, cluster int, distance bigint")


def _described(spark: SparkSession, centroids: np.ndarray, low: int, inertia: dict[int, int]) -> DataFrame:
    """A row per centroid: its inertia, that of all, and the digest of its components."""
    rows = []
    for number, values in enumerate((values_of(centroids) + low).tolist()):
        digest = hashlib.sha256(",".join(map(str, values)).encode()).hexdigest()
        rows.append((number, inertia.get(number, 0), sum(inertia.values()), digest))
    return spark.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )


def cluster_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = 40,
    rounds: int = 5,
    scale: int = 256,
    salt: str = "2:",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each kept vector.

    Kept are vectors of exactly 64 components, none null, NaN or infinite. Centroids start as the
    vectors with the smallest sha256 of ``salt`` and the id, are moved ``rounds`` times, and every
    vector is assigned once more. Rows with one id are vectors of their own; a null id is hashed
    as an empty text and returned as null. With fewer vectors than ``clusters`` there are as many
    centroids as vectors; an empty table gives no rows. Other columns are not read. Whole numbers
    that lie 2**28 or more apart are refused: their distances would leave 64 bits.
    """
    spark = df.sparkSession
    vectors = kept_vectors(df, id_col, vector_col, scale)
    seen = vectors.agg(
        F.count("*").alias("rows"),
        F.min(F.array_min("numbers")).alias("low"),
        F.max(F.array_max("numbers")).alias("high"),
    ).first()
    rows, low, high = seen["rows"], seen["low"] or 0, seen["high"] or 0
    count = max(1, (high - low).bit_length())
    if count > _MOST_PLANES:
        raise ValueError(f"components lie {high - low} apart; at most {2**_MOST_PLANES - 1} is allowed")
    staged = _staged_planes(vectors, low, count)
    hashed = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    centroids = _starts(staged, hashed, rows, clusters, count)
    for _ in range(rounds):
        centroids = _moved(staged, centroids)
    assigned = stage(_assigned(staged, centroids), "assigned")
    inertia = {
        r["cluster"]: int(r["total"])
        for r in assigned.groupBy("cluster")
        .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"))
        .collect()
    }
    return assigned.join(F.broadcast(_described(spark, centroids, low, inertia)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _cluster_sql(clusters: int = 40, rounds: int = 5) -> str:
    """The same clusters in SQL: a vector is a row per component."""

    def distances(centroids: str) -> str:
        return f"""SELECT vec_id, cluster, distance FROM (
            SELECT v.vec_id, c.cluster, CAST(sum((v.value - c.value) * (v.value - c.value)) AS BIGINT) AS distance
            FROM parts v JOIN {centroids} c USING (place) GROUP BY v.vec_id, c.cluster)
          QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1"""

    steps = [
        """kept AS MATERIALIZED (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        """parts AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS place,
          CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS value FROM kept)""",
        f"""starts AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster
          FROM kept ORDER BY cluster LIMIT {clusters})""",
        """c0 AS MATERIALIZED (SELECT cluster, place, value FROM parts JOIN starts USING (vec_id))""",
    ]
    for k in range(rounds):
        steps += [
            f"a{k} AS MATERIALIZED ({distances(f'c{k}')})",
            f"""m{k} AS MATERIALIZED (SELECT cluster, place,
              CAST(floor(CAST(sum(value) AS DECIMAL(38, 0)) / count(*)) AS BIGINT) AS value
              FROM parts JOIN a{k} USING (vec_id) GROUP BY cluster, place)""",
            f"""c{k + 1} AS MATERIALIZED (SELECT cluster, place, coalesce(m.value, c.value) AS value
              FROM c{k} c LEFT JOIN m{k} m USING (cluster, place))""",
        ]
    steps += [
        f"final AS MATERIALIZED ({distances(f'c{rounds}')})",
        f"""digests AS (SELECT cluster, sha256(string_agg(CAST(value AS VARCHAR), ',' ORDER BY place))
          AS centroid_sha256 FROM c{rounds} GROUP BY cluster)""",
    ]
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM final JOIN digests USING (cluster)"""


CLUSTERS_SQL = _cluster_sql()
