"""Exact top-k search by inner product: a Voronoi kNN join.

Vectors get one more component so that the largest inner product is the
smallest Euclidean distance: data x becomes (x, sqrt(M^2 - |x|^2)) with M the
largest norm, a query q becomes (q, 0), and |q' - x'|^2 = |q|^2 + M^2 - 2 q.x.
Queries and data are grouped by their nearest pivot. From each cell's radius
and smallest distances to its pivot an upper bound of every query cell's k-th
distance follows, and from that which distances to a pivot a data vector may
have to matter. Only such vectors are sent to a group of query cells, where
the scores themselves decide, in whole numbers. The few vectors too long for
this arithmetic (norm of 2^31 or more, scaled) are compared with all others.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarry.llm.common import written

#: Queries in a group of cells, and data vectors in a chunk, about.
GROUP_QUERIES, CHUNK_ROWS = 1024, 16384
#: From this squared norm on a vector is a cell of its own kind, without bounds.
FAR = 2.0 ** 62
LARGEST = float(np.finfo(np.float64).max)
LONGS = (-2 ** 63, 2 ** 63 - 1)


def scaled_vectors(table: DataFrame, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(row, vec_id, v): floor(scale * x) of each component x, as doubles (whole
    numbers; the largest double where ``scale * x`` is beyond it). Vectors that
    are null or empty or hold a null or non-finite component are left out, so
    are null ids. ``row`` numbers the rows, for rows may repeat an id."""
    def whole(x):
        y = F.greatest(F.least(x * scale, F.lit(LARGEST)), F.lit(-LARGEST))
        # doubles of 2^53 or more are whole numbers already
        return F.when(F.abs(y) < 2.0 ** 53, F.floor(F.when(F.abs(y) < 2.0 ** 53, y).otherwise(0.0)).cast("double")).otherwise(y)

    good = F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & F.col(id_col).isNotNull() & F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= LARGEST))
    v = F.transform(F.col(vector_col).cast("array<double>"), whole)
    return table.where(good).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def _matrix(col) -> np.ndarray:
    """An Arrow list column of equal lengths as a matrix."""
    import pyarrow as pa

    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _scores(q: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Exact inner products. Doubles are exact below 2**53; beyond that Python's
    integers, and one beyond a long is the nearest long."""
    if not len(q) or not len(s):
        return np.zeros((len(q), len(s)))
    with np.errstate(over="ignore"):
        if np.abs(q).max() * np.abs(s).max() * q.shape[1] < 2.0 ** 53:
            return q @ s.T
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(q) @ whole(s).T, *LONGS).astype(np.int64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(d, 0))


def _groups(count: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """A group for each query cell: near cells together until a group has its queries."""
    group, left = np.zeros(len(count), np.int64), set(np.flatnonzero(count).tolist())
    g, held, at = 0, 0, min(left, default=0)
    while left:
        left.discard(at)
        group[at] = g
        held += count[at]
        if held >= GROUP_QUERIES:
            g, held = g + 1, 0
        at = min(left, key=lambda c: (distance[at, c], c), default=0)
    return group


def _search(vectors: DataFrame, k: int, query, pivots: int) -> DataFrame:
    """(row, query_id, vec_id, score) with at least each query's k best; vectors of one length."""
    spark = vectors.sparkSession
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    vectors = vectors.withColumn("far", norm2 >= FAR)
    near_by = vectors.where("not far")
    n, top2 = near_by.agg(F.count(F.lit(1)), F.max(norm2)).first()
    top2 = top2 or 0.0
    drawn = near_by.orderBy(F.xxhash64("vec_id"), "row").limit(max(1, min(pivots, round(n ** 0.5)))).collect()
    width = vectors.select(F.size("v").alias("w")).first()["w"]

    def lifted(m: np.ndarray) -> np.ndarray:
        return np.column_stack([m, np.sqrt(np.maximum(top2 - (m * m).sum(1), 0))])

    p = np.unique(lifted(np.array([r["v"] for r in drawn] or np.zeros((1, width)), float)), axis=0)
    far_cell = len(p)  # the cell of the vectors without bounds

    def assigned(df: DataFrame, as_query: bool) -> DataFrame:
        def run(batches):
            import pyarrow as pa

            for b in batches:
                if b.num_rows:
                    far = b.column(3).to_numpy(zero_copy_only=False)
                    m = np.where(far[:, None], 0.0, _matrix(b.column(2)))
                    d = _distances(np.column_stack([m, np.zeros(len(m))]) if as_query else lifted(m), p)
                    cell = d.argmin(1)
                    d = np.where(far, 0.0, d[np.arange(len(m)), cell])
                    yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(np.where(far, far_cell, cell).astype(np.int32)), pa.array(d)],
                                                     ["row", "vec_id", "v", "cell", "d"])
        return df.select("row", "vec_id", "v", "far").mapInArrow(run, "row bigint, vec_id bigint, v array<double>, cell int, d double")

    data, asked = written(assigned(vectors, False), "data-cells"), written(assigned(vectors.where(query), True), "query-cells")

    def smallest(batches):
        """The k + 1 smallest distances of each cell in each batch."""
        import pyarrow as pa

        for b in batches:
            cell, d = b.column(0).to_numpy(), b.column(1).to_numpy()
            order = np.lexsort((d, cell))
            cell, d = cell[order], d[order]
            first = np.searchsorted(cell, cell)
            near = np.arange(len(cell)) - first <= k
            yield pa.RecordBatch.from_arrays([pa.array(cell[near]), pa.array(d[near])], ["cell", "d"])

    # summaries: a few numbers a cell
    near = data.where(F.col("cell") < far_cell).select("cell", "d").mapInArrow(smallest, "cell int, d double").withColumn(
        "r", F.row_number().over(W.partitionBy("cell").orderBy("d"))).where(F.col("r") <= k + 1).select("cell", "d").collect()
    radius, count = np.zeros(far_cell + 1), np.zeros(far_cell + 1, np.int64)
    for r in asked.groupBy("cell").agg(F.max("d").alias("u"), F.count(F.lit(1)).alias("n")).collect():
        radius[r["cell"]], count[r["cell"]] = r["u"], r["n"]
    between = _distances(p, p)
    cells, ds = np.array([r["cell"] for r in near], int), np.array([r["d"] for r in near])
    group = np.append(_groups(count[:-1], between), 0)
    groups = int(group.max()) + 1
    group[far_cell] = groups  # its queries meet all data
    slack = 1e-6 * (1 + between.max() + np.sqrt(top2))
    low, high = np.full((groups + 1, far_cell + 1), np.inf), np.full((groups + 1, far_cell + 1), -np.inf)
    for i in np.flatnonzero(count[:-1]).tolist():
        # k + 1, for one of them may be the query's own row
        upper = np.sort(radius[i] + between[i][cells] + ds)
        theta = (upper[k] if len(upper) > k else np.inf) + slack
        g = group[i]
        low[g, :-1] = np.minimum(low[g, :-1], between[i] - radius[i] - theta)
        high[g, :-1] = np.maximum(high[g, :-1], between[i] + radius[i] + theta)
    asking = np.bincount(group, weights=count, minlength=groups + 1).astype(np.int64)
    low[asking > 0, far_cell], high[asking > 0, far_cell] = -np.inf, np.inf
    if asking[groups]:
        low[groups], high[groups] = -np.inf, np.inf
    # rows: groups times cells, the square of the pivots at most
    rules = spark.createDataFrame([(int(g), int(j), float(low[g, j]), float(high[g, j])) for g, j in zip(*np.nonzero(low <= high))],
                                  "g int, cell int, lo double, hi double")
    sent = data.join(F.broadcast(rules), "cell").where("d between lo and hi")
    # a group's queries and the data sent to it are cut into blocks and chunks by its own counts
    receives = {r["g"]: r["n"] for r in sent.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = spark.createDataFrame([(g, max(1, -(-int(asking[g]) // (2 * GROUP_QUERIES))), max(1, -(-receives.get(g, 0) // CHUNK_ROWS)))
                                   for g in range(groups + 1)], "g int, blocks int, chunks int")
    of_cell = spark.createDataFrame([(i, int(group[i])) for i in range(far_cell + 1)], "cell int, g int").join(F.broadcast(sizes), "g")
    dealt = lambda seed, m: F.pmod(F.xxhash64("row", F.lit(seed)), F.col(m)).cast("int")
    numbered = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    sent = sent.join(F.broadcast(sizes), "g").select("g", dealt(1, "chunks").alias("c"), numbered("blocks").alias("b"), "row", "vec_id", "v")
    asked = asked.join(F.broadcast(of_cell), "cell").select("g", dealt(2, "blocks").alias("b"), numbered("chunks").alias("c"), "row", "vec_id", "v")

    def solve(q, s):
        import pyarrow as pa

        out = [np.zeros(0, np.int64)] * 4
        if q.num_rows and s.num_rows:
            s = s.sort_by([("vec_id", "ascending"), ("row", "ascending")])
            ids, rows, vectors_ = s["vec_id"].to_numpy(), s["row"].to_numpy(), _matrix(s["v"])
            asking, asked_ids, questions = q["row"].to_numpy(), q["vec_id"].to_numpy(), _matrix(q["v"])
            parts: list[tuple] = []
            for lo in range(0, len(asking), 256):
                scores = _scores(questions[lo: lo + 256], vectors_)
                for a, i, x in zip(asking[lo: lo + 256].tolist(), asked_ids[lo: lo + 256].tolist(), scores):
                    other = np.flatnonzero(rows != a)
                    x = x[other]
                    if len(x) > k:
                        least = np.partition(x, len(x) - k)[len(x) - k]
                        over = np.flatnonzero(x > least)
                        # ids ascend, so the first of the equals are the smaller ids
                        pick = np.concatenate([over, np.flatnonzero(x == least)[: k - len(over)]])
                    else:
                        pick = np.arange(len(x))
                    parts.append((np.full(len(pick), a), np.full(len(pick), i), ids[other[pick]], x[pick].astype(np.int64)))
            out = [np.concatenate(c).astype(np.int64) for c in zip(*parts)]
        return pa.table({n_: pa.array(c) for n_, c in zip(("row", "query_id", "vec_id", "score"), out)})

    keys = ["g", "b", "c"]
    return asked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(solve, "row bigint, query_id bigint, vec_id bigint, score bigint")


def exact_top_k(table: DataFrame, query, k: int = 20, scale: int = 64, pivots: int = 1024,
                id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the largest inner
    product for each row for which the condition ``query`` on the id holds
    (all others, if fewer), ties to the smaller id. The query's own row is no
    candidate; rows that repeat an id are queries and candidates each.

    Components are scaled and floored (``scaled_vectors``, which says which
    rows take no part); scores are exact whole numbers, and one beyond a long
    is the nearest long. Vectors are compared with those of their own length
    only. Extra columns are not read.

    Pivots are as many as the root of the rows, ``pivots`` at most; the driver
    sees them and a few numbers for each pair of them. A unit of work is a
    block of a group's queries with a chunk of the data sent to that group,
    so a vector with very many copies is in many units. Exact search in
    blocks is at worst every query against every vector; the bounds take off
    what geometry allows, but nothing of vectors whose squared norm is ``FAR`` or more.
    """
    vectors = written(scaled_vectors(table, scale, id_col, vector_col).withColumn("dim", F.size("v")), "vectors")
    found = None
    for r in vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():
        if r["n"] > 1:
            part = _search(vectors.where(F.col("dim") == r["dim"]).drop("dim"), k, query(F.col("vec_id")), pivots)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    rank = F.row_number().over(W.partitionBy("row").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
