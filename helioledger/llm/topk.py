"""Exact top-k search by selection in score histograms that are refined over all data.

Vectors are dealt into blocks of bounded size, and every block of queries meets every block of candidates once a
turn.  A turn scores everything and counts scores in equal bins between each query's bounds.  The counts of all blocks
are added, which locates the bin of the kth score; the next turn bins that bin, until a bin is one value.  Then
everything at or above the kth score passes, and ties go to the smaller id.

A block sends bins from the top until they hold k scores: the kth of all is not below the kth of a block, so lower
bins of that block can't hold it.  Likewise each block passes its own k best at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helioledger.llm.tables import land, read, ship

BLOCK, QUERY_BLOCK, SLICE, BINS = 4096, 1024, 128, 2048
#: Scores are exact within this; one beyond it is an error.  A double holds it exactly, and twice as much fits a long.
LIMIT = (1 << 62) - 512
NO_SCORE = -(1 << 62)


def quantise(vector: list) -> np.ndarray | None:
    """Each component x as floor(256 x); None if one is null or not finite.  One too large for that is an error."""
    found = np.array(vector, np.float64)  # null becomes nan
    if not np.isfinite(found).all():
        return None
    with np.errstate(over="ignore"):
        scaled = np.floor(found * 256)
    if not np.isfinite(scaled).all():
        raise OverflowError("256 times a component is beyond a double")
    return scaled


def pack(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of ``size`` vectors: ``block`` (0, 1, ...), ``dim``, ids, whether there is an id, data, sums of absolute components."""
    ship(vectors.sparkSession)
    parts = max(1, -(-vectors.count() // size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for id_, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = None if vector is None else quantise(vector)
                if found is not None:
                    held.setdefault(len(found), []).append((id_, found))
        block = TaskContext.get().partitionId()
        for dim, rows in held.items():
            data = np.array([r[1] for r in rows]).reshape(len(rows), dim)
            sums = np.minimum(np.abs(data).sum(axis=1), LIMIT).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block], pa.int32()),
                    "dim": pa.array([dim], pa.int32()),
                    "ids": pa.array([[r[0] or 0 for r in rows]], pa.list_(pa.int64())),
                    "named": pa.array([[r[0] is not None for r in rows]], pa.list_(pa.bool_())),
                    "data": pa.array([data.tobytes()], pa.binary()),
                    "sums": pa.array([sums.tolist()], pa.list_(pa.int64())),
                    "most": pa.array([float(np.abs(data).max(initial=0))], pa.float64()),
                }
            )

    dealt = vectors.select(F.col("id").cast("long"), F.col("vector").cast("array<double>")).repartition(parts)
    ddl = "block int, dim int, ids array<long>, named array<boolean>, data binary, sums array<long>, most double"
    return land(dealt.mapInArrow(run, ddl), "blocks").withColumn("blocks", F.lit(parts))


def _score(queries: np.ndarray, candidates: np.ndarray, barred: np.ndarray) -> np.ndarray:
    """Integer inner products, by doubles where those are exact, else by Python's integers; ``NO_SCORE`` for barred pairs."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * queries.shape[1]
    if bound < 1 << 53:
        scores = (queries @ candidates.T).astype(np.int64)
    else:
        exact = np.vectorize(int, otypes=[object])
        wide = exact(queries) @ exact(candidates).T
        wide[barred] = 0
        if (np.abs(wide) > LIMIT).any():
            raise OverflowError("a score is beyond 62 bits")
        scores = wide.astype(np.int64)
    scores[barred] = NO_SCORE
    return scores


def _slices(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Of each pair of blocks, some queries at a time: where they begin, scores of all candidates, bounds, candidates."""
    for row in batch.to_pylist():
        dim = row["dim"]
        queries = np.frombuffer(row["q_data"]).reshape(len(row["q_ids"]), dim)
        candidates = np.frombuffer(row["data"]).reshape(len(row["ids"]), dim)
        ids, named, own = np.array(row["ids"], np.int64), np.array(row["named"], bool), np.array(row["q_ids"], np.int64)
        low, width = (np.array([s[k] for s in row["state"]], np.int64) for k in ("low", "width"))
        for at in range(0, len(queries), SLICE):
            part = slice(at, at + SLICE)
            scores = _score(queries[part], candidates, (own[part, None] == ids[None]) & named[None])
            yield row, at, scores, low[part], width[part], ids, named


def _histograms(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, at, scores, low, width, _, _ in _slices(batch):
                n, inside = len(scores), scores >= low[:, None]
                bins = np.minimum((scores - low[:, None]) // width[:, None], BINS) + np.arange(n)[:, None] * (BINS + 1)
                counts = np.bincount(bins[inside], minlength=n * (BINS + 1)).reshape(n, BINS + 1)
                above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
                query, bin_ = np.nonzero((counts > 0) & (above < k))
                size = len(query)
                yield pa.RecordBatch.from_pydict(
                    {
                        "q_block": pa.array(np.full(size, row["q_block"], np.int32)),
                        "dim": pa.array(np.full(size, row["dim"], np.int32)),
                        "pos": pa.array((query + at).astype(np.int32)),
                        "bin": pa.array(bin_.astype(np.int32)),
                        "n": pa.array(counts[query, bin_].astype(np.int64)),
                    }
                )

    return run


def _best(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, at, scores, low, _, ids, named in _slices(batch):
                out: list[tuple] = []
                for i, line in enumerate(scores):
                    passed = np.flatnonzero((line >= low[i]) & (line > NO_SCORE))
                    order = np.lexsort((ids[passed], ~named[passed], -line[passed]))[:k]
                    out += [(at + i, row["q_ids"][at + i], int(ids[c]) if named[c] else None, int(line[c])) for c in passed[order]]
                columns = list(zip(*out, strict=True)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["q_block"]] * len(out), pa.int32()),
                        pa.array([row["dim"]] * len(out), pa.int32()),
                        pa.array(columns[0], pa.int32()),
                        *[pa.array(c, pa.int64()) for c in columns[1:]],
                    ],
                    ["q_block", "dim", "pos", "query_id", "vec_id", "score"],
                )

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the k best candidates of every query.

    Both tables have ``id`` and ``vector``.  Vectors that are null or hold null or non-finite components take no part;
    those of other lengths than the query's aren't its candidates, nor are rows with its id.  Candidates without an id
    take part and come last among ties; queries need one.  Repeated candidates count each, and each row of a repeated
    query is asked.  Fewer than k candidates are all returned.  A score beyond 62 bits is an error, never clipped.
    """
    if k < 1:
        raise ValueError("k must be 1 or more")
    candidates, asked = pack(vectors, BLOCK), pack(queries.filter("id IS NOT NULL"), QUERY_BLOCK)
    (c_blocks, most), q_blocks = candidates.agg(F.max("blocks"), F.max("most")).first(), asked.agg(F.max("blocks")).first()[0]
    if not c_blocks or not q_blocks:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    key, place = ["q_block", "dim"], ["q_block", "dim", "pos"]
    spread = candidates.select("block", "dim", "ids", "named", "data", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_block"))
    asked = asked.select(F.col("block").alias("q_block"), "dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), "sums")
    reach = F.least(F.col("sum") * F.lit(float(most) * (1 + 1e-9)), F.lit(float(LIMIT))).cast("long")
    state = asked.select(*key, F.posexplode("sums").alias("pos", "sum")).select(*place, (-reach).alias("low"), (reach * 2 + 1).alias("range"))
    state = land(state.select(*place, "low", F.ceil(F.col("range") / BINS).cast("long").alias("width")), "bounds")

    def pairs(state: DataFrame) -> DataFrame:
        bounds = state.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", "low", "width"))).alias("state"))
        ready = asked.drop("sums").join(bounds, key)
        ready = ready.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
        return spread.join(ready.hint("shuffle_merge"), ["q_block", "block", "dim"]).select(
            "q_block", "dim", "ids", "named", "data", "q_ids", "q_data", "state"
        )

    while True:
        counted = pairs(state).mapInArrow(_histograms(k), "q_block int, dim int, pos int, bin int, n long")
        summed = counted.groupBy(*place, "bin").agg(F.sum("n").alias("n"))
        upward = F.sum("n").over(Window.partitionBy(*place).orderBy(F.desc("bin")))
        holds = summed.withColumn("upward", upward).filter((F.col("upward") >= k) & (F.col("upward") - F.col("n") < k))
        moved = state.join(holds.select(*place, "bin"), place, "left")
        low = F.col("low") + F.coalesce(F.col("bin"), F.lit(0)) * F.col("width")
        width, single = F.ceil(F.col("width") / BINS).cast("long"), state.agg(F.max("width")).first()[0] == 1
        state = land(moved.select(*place, low.alias("low"), width.alias("width")), "bounds")
        if single:
            break
    best = pairs(state).mapInArrow(_best(k), "q_block int, dim int, pos int, query_id long, vec_id long, score long")
    order = Window.partitionBy(*place).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_histogram_top_k(spark, sf_dir: str) -> DataFrame:
    """The 5 best of all vectors for every id divisible by 50."""
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding").toDF("id", "vector")
    return top_k(vectors, vectors.filter("id % 50 = 0"), 5)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id AND len(a.q) = len(b.q)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
