"""Exact top-k search by a Voronoi kNN join.

Vectors become integers ``floor(256 * x)``; the score is their inner product.
Data rows go to the cell of their nearest pivot; each cell is summarised by its
size and radius.  Queries are grouped by their nearest pivot too, groups of
like cells being packed together up to a bounded number of queries.  From the
summaries alone every query gets a lower bound of its k-th score (cells in
falling order of their guaranteed score, until k rows are counted), and a cell
is sent to a query group only if its best possible score reaches the lowest
such bound of the group; the rest of the data is never moved.  Each (group,
cell) is solved locally with one matrix product and the k best rows of a
query's cells are merged.

Bounded: pivots (``n_pivots``), queries per group (``group_queries``) and data
rows per local block (``block_rows``; larger cells, such as a vector that
repeats endlessly, are split by a hash of vec_id).

Defined cases: vectors that are null or hold null or non-finite components take
no part, nor do empty vectors and vectors of another length than the first
pivot's; ties go to the smaller vec_id; null vec_ids take no part; repeated vec_ids are
separate rows (a query leaves out all rows of its own id); an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.common import staged

K = 5
QUERY_EVERY = 50


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256.0).cast("long"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < float("inf")))
    return embeddings.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
                             & (F.size("embedding") > 0) & finite).select("vec_id", whole.alias("v"))


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, 0), np.int64)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in doubles where they cannot round."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def nearest(v: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot and the distance to it, of every row."""
    x = v.astype(np.float64)
    squares = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None, :]
    cell = squares.argmin(1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1))


def top_k(embeddings: DataFrame, k: int = K, query_every: int = QUERY_EVERY, n_pivots: int = 64,
          group_queries: int = 2048, block_rows: int = 20_000) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best rows."""
    spark = embeddings.sparkSession
    vectors = staged(integer_vectors(embeddings), "knn-vectors")
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).collect()
    out = "query_id long, rank int, vec_id long, score long"
    if not chosen:
        return spark.createDataFrame([], out)
    width = len(chosen[0]["v"])
    pivots = np.array([r["v"] for r in chosen if len(r["v"]) == width], np.float64)
    vectors = vectors.filter(F.size("v") == width)

    def assign(frames):
        for f in frames:
            if len(f):
                v = _matrix(f["v"])
                f["cell"], f["distance"] = nearest(v, pivots)
                f["length"] = np.sqrt((v.astype(np.float64) ** 2).sum(1))
                yield f

    cells = staged(vectors.mapInPandas(
        assign, "vec_id long, v array<long>, cell long, distance double, length double"), "knn-cells")
    is_query = F.col("vec_id") % query_every == 0
    # one row per pivot: bounded by n_pivots
    summary = {r["cell"]: r for r in cells.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("distance").alias("radius"),
        F.count(F.when(is_query, 1)).alias("queries")).collect()}
    ids = np.array(sorted(summary))
    size = np.array([summary[c]["n"] for c in ids])
    radius = np.array([summary[c]["radius"] for c in ids]) * (1 + 1e-9) + 1e-6
    centre = pivots[ids]
    blocks = {int(c): int(-(-summary[c]["n"] // block_rows)) for c in ids}
    # neighbouring cells share a query group; a crowded cell is split by hash
    near = [ids[0]]
    left = set(ids[1:].tolist())
    while left:
        at = min(left, key=lambda c: ((pivots[c] - pivots[near[-1]]) ** 2).sum())
        near.append(at)
        left.remove(at)
    group_of, filled, group = {}, 0, 0
    for c in near:
        q = summary[c]["queries"]
        if filled and filled + q > group_queries:
            group, filled = group + 1, 0
        parts = max(1, -(-q // group_queries))
        group_of[int(c)] = (group, parts)
        filled += q
        if parts > 1:
            group, filled = group + parts, 0

    def grouped(frames):
        for f in frames:
            base = f["cell"].map(lambda c: group_of[c][0]).to_numpy()
            parts = f["cell"].map(lambda c: group_of[c][1]).to_numpy()
            spread = pd.util.hash_array(f["vec_id"].to_numpy()) % parts.astype(np.uint64)
            f["grp"] = base + spread.astype(np.int64)
            v = _matrix(f["v"]).astype(np.float64)
            middle = v @ centre.T
            slack = f["length"].to_numpy()[:, None] * radius[None, :]
            low, high = middle - slack, middle + slack
            # k + 1 rows, as the query's own row does not count; a repeated id
            # is allowed for by the cell test below
            order = np.argsort(-low, 1)
            counted = np.cumsum(size[order], 1)
            enough = (counted >= k + 1).argmax(1)
            bound = np.where(counted[:, -1] >= k + 1,
                             np.take_along_axis(low, order, 1)[np.arange(len(f)), enough], -np.inf)
            # rows are grouped below, so give each query's needed cells as a list
            f["needs"] = [ids[h >= b - 1e-3 * (1 + abs(b))].tolist() if np.isfinite(b) else ids.tolist()
                          for h, b in zip(high, bound)]
            yield f[["vec_id", "v", "grp", "needs"]]

    queries = staged(cells.filter(is_query).mapInPandas(
        grouped, "vec_id long, v array<long>, grp long, needs array<long>"), "knn-queries")
    repeated = cells.filter(is_query).groupBy("vec_id").count().filter("count > 1")
    if repeated.limit(1).count():      # own rows may then outnumber the one allowed for
        queries = queries.withColumn("needs", F.array(*[F.lit(int(c)) for c in ids]))
    # cells that a group needs: at most groups x pivots rows, summed up before any data moves
    needed = staged(queries.select("grp", F.explode("needs").alias("cell")).distinct(), "knn-needed")
    block_count = F.element_at(F.create_map(*[x for c, n in blocks.items()
                                              for x in (F.lit(c), F.lit(n))]), F.col("cell"))
    data = (cells.select("vec_id", "v", "cell").join(needed, "cell")
            .withColumn("block", F.pmod(F.xxhash64("vec_id"), block_count)))
    sent = (queries.drop("needs").join(needed, "grp")
            .withColumn("block", F.explode(F.sequence(F.lit(0), block_count - 1)))
            .withColumn("block", F.col("block").cast("long")))

    def solve(key, q, d):
        if not len(q) or not len(d):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        d = d.sort_values("vec_id", ignore_index=True)
        data_ids, query_ids = d["vec_id"].to_numpy(), q["vec_id"].to_numpy()
        right = _matrix(d["v"])
        parts = []
        left_all = _matrix(q["v"])
        step = max(1, 4_000_000 // len(d))
        for a in range(0, len(q), step):
            s = inner(left_all[a:a + step], right)
            own = query_ids[a:a + step, None] == data_ids[None, :]
            s[own] = -np.iinfo(np.int64).max       # last in both orders (the negative of int64 min is itself)
            take = min(k, len(d))
            best = np.argsort(-s, 1, kind="stable")[:, :take] if len(d) <= 64 else _first_best(s, take)
            row = np.arange(len(s))[:, None]
            keep = ~own[row, best]
            parts.append(pd.DataFrame({
                "query_id": np.broadcast_to(query_ids[a:a + step, None], best.shape)[keep],
                "vec_id": data_ids[best][keep], "score": s[row, best][keep]}))
        return pd.concat(parts)

    local = (sent.withColumnRenamed("vec_id", "query").groupBy("grp", "cell", "block")
             .cogroup(data.groupBy("grp", "cell", "block")))
    found = local.applyInPandas(lambda key, q, d: solve(key, q.rename(columns={"query": "vec_id"}), d),
                                "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _first_best(s: np.ndarray, take: int) -> np.ndarray:
    """Columns of the ``take`` largest values of each row, ties to the left."""
    cut = np.partition(s, s.shape[1] - take, 1)[:, s.shape[1] - take]
    out = np.empty((len(s), take), np.int64)
    for i, c in enumerate(cut):
        above = np.flatnonzero(s[i] > c)
        level = np.flatnonzero(s[i] == c)[:take - len(above)]
        both = np.concatenate([above, level])
        out[i] = both[np.lexsort((both, -s[i, both]))]
    return out


def op3(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


OP3_SQL = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(cast(x as double) * 256) as bigint)) as v
  from embeddings
  where vec_id is not null and len(embedding) > 0 and len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
scored as (
  select q.vec_id as query_id, d.vec_id,
    cast(list_dot_product(q.v::double[], d.v::double[]) as bigint) as score
  from v q join v d on q.vec_id <> d.vec_id and q.vec_id % {QUERY_EVERY} = 0),
ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
    vec_id, score from scored)
select * from ranked where rank <= {K}"""
