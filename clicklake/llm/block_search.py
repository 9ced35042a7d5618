"""Exact top-k search by block-at-a-time pruning.

Vectors of integers are taken as documents, their dimensions as terms. Candidates are ordered so that similar ones
stand together, and cut into document ranges of ``BLOCK`` rows. Each block keeps the largest and the least value
of every term, and a forward index: the rows themselves. For a query, a term's maximum in a block is the larger
of its weight times either bound, and their sum bounds every score in the block. Blocks are visited in order of
falling bounds and scored through their forward index, until the next bound is below the k-th best score so far.
A bound that equals it is still visited, as ties go to smaller ids.

Rows are told apart by a number: rows that share an id are numbered in order of their vector, and a query leaves out the candidate of its own
id and number. Queries travel with the tasks in blocks of at most ``QUERY_BLOCK``, a pass over the candidates for each. A task keeps the k best of
its own rows; a query's lists are merged by rank afterwards. As a start, every query's k-th best score among the bounded pilot
sample of candidates already bounds the final one from below, in all tasks.

Defined cases: vectors that are null, or hold a null or non-finite component, take no part; vectors of another length
than a query's are no candidates for it; an empty vector scores 0; null ids take no part; rows that share an id are separate
candidates and separate queries, each with a list of its own, and the other rows of its id are candidates for it; of equal rows any one counts
as the query's own; fewer than k candidates are all returned; empty tables give no rows; other columns are not read. Components are scaled by ``scale`` and rounded down; scores must stay under 2**62.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import stored, table

K = 5
SCALE = 256
BLOCK = 128
QUERY_BLOCK = 16_384
PILOT = 2_048
#: Pivots that similar vectors gather around, taken from the pilot sample.
PIVOTS = 64
#: Below this bound on scores, double precision is exact.
EXACT = float(1 << 52)
#: Stands for no score, and for no row.
LOW, NONE = -(1 << 62), (1 << 63) - 1


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """id, vector of longs and turn (0, 1, ... within an id), for vectors without null or non-finite components."""
    values = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(values, lambda x: F.floor(x * scale).cast("long"))
    rows = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.col(key).cast("long").alias("id"), whole.alias("vector")
    )
    # equal rows are one until they are numbered, so that an id that many equal rows share is no more than one row of a window
    counted = rows.groupBy("id", "vector").agg(F.count("*").alias("n"))
    before = Window.partitionBy("id").orderBy("vector").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    each = F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("turn")
    return counted.select("id", "vector", "n", first).select("id", "vector", each)


def matrices(ids: np.ndarray, vectors: list) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids (with turns: two columns) and matrix of the vectors of each length."""
    lengths = np.array([len(v) for v in vectors])
    out = {}
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        out[int(length)] = ids[at], np.array([vectors[i] for i in at], np.int64).reshape(len(at), int(length))
    return out


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer matrix product: in double precision where that is exact."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if most < EXACT:
        return (left.astype(float) @ right.T.astype(float)).astype(np.int64)
    return left @ right.T


def bounds(queries: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """For each query and block, the sum of term maxima."""
    return product(np.maximum(queries, 0), most) + product(np.minimum(queries, 0), least)


class TopK:
    """The k best scores and ids of each query: score falling, then id rising."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.scores = np.full((queries, k), LOW)
        self.ids = np.full((queries, k), NONE)
        self.floor = floor if floor is not None else np.full(queries, LOW)

    def level(self, at=slice(None)) -> np.ndarray:
        return np.maximum(self.scores[at, -1], self.floor[at])

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offers rows ``ids`` to the queries ``at``; where an id is the query's own its score is the least integer."""
        some = (scores >= self.level(at)[:, None]).any(axis=1)
        at, scores = at[some], scores[some]
        all_scores = np.concatenate([self.scores[at], scores], axis=1)
        all_ids = np.concatenate([self.ids[at], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.scores.shape[1]]
        self.scores[at] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[at] = np.take_along_axis(all_ids, order, axis=1)


def search(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, top: TopK, block: int = BLOCK
) -> int:
    """Offers ``rows`` to ``top`` block by block; returns how many scores were computed. Ids have two columns, id and turn."""
    starts = np.arange(0, len(ids), block)
    least, most = np.minimum.reduceat(rows, starts), np.maximum.reduceat(rows, starts)
    bound = bounds(queries, least, most)
    order = np.argsort(-bound, axis=1, kind="stable")
    active, computed = np.arange(len(queries)), 0
    for place in range(len(starts)):
        chosen = order[active, place]
        going = bound[active, chosen] >= top.level(active)
        active, chosen = active[going], chosen[going]
        if not len(active):
            break
        by_block = np.argsort(chosen, kind="stable")
        edges = np.flatnonzero(np.diff(chosen[by_block])) + 1
        for group in np.split(by_block, edges):
            start = starts[chosen[group[0]]]
            held = ids[start : start + block]
            scores = product(queries[active[group]], rows[start : start + block])
            scores[(held[None] == query_ids[active[group], None]).all(axis=2)] = LOW
            computed += scores.size
            top.add(active[group], scores, held[:, 0])
    return computed


def _gather(batches) -> tuple[np.ndarray, list]:
    ids, vectors = [], []
    for batch in batches:
        ids.append(np.column_stack([batch.column(0).to_numpy(), batch.column(2).to_numpy()]))
        vectors += batch.column(1).to_numpy(zero_copy_only=False).tolist()
    return np.concatenate(ids) if ids else np.zeros((0, 2), np.int64), vectors


def _pieces(batches, size: int = 65_536) -> Iterator[tuple[np.ndarray, list]]:
    """Ids and vectors of bounded runs of rows."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= size:
            yield _gather(held)
            held, count = [], 0
    if held:
        yield _gather(held)


def _collected(frame: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    rows = frame.toArrow()
    ids = np.column_stack([rows["id"].to_numpy(), rows["turn"].to_numpy()])
    return matrices(ids, rows["vector"].to_numpy().tolist())


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score; both frames have id (long), vector (array of longs) and turn (long), which tells rows of an id apart."""
    spark = candidates.sparkSession
    pilot = _collected(candidates.orderBy(F.xxhash64("id"), "id", "turn").limit(PILOT))
    pivots = {n: rows[:PIVOTS] for n, (_, rows) in pilot.items()}

    def near(batches):
        for batch in batches:
            ids, vectors = _gather([batch])
            pivot = np.zeros(len(ids), np.int32)
            lengths = np.array([len(v) for v in vectors])
            for n, (_, rows) in matrices(ids, vectors).items():
                if n in pivots and n:
                    fit = product(rows, pivots[n]) - (pivots[n].astype(float) ** 2).sum(axis=1) / 2
                    pivot[lengths == n] = fit.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pivot)], names=["id", "vector", "turn", "pivot"]
            )

    candidates = candidates.select("id", "vector", "turn")
    grouped = candidates.mapInArrow(near, "id long, vector array<bigint>, turn long, pivot int")
    by = ["pivot", "id", "turn"]
    ordered = grouped.repartitionByRange(*by).sortWithinPartitions(*by).select("id", "vector", "turn")
    ordered = stored(ordered, "search-candidates")
    queries = stored(queries, "search-queries")
    total = queries.count()
    blocks = -(-total // QUERY_BLOCK)
    kinds = "query_id long, turn long, vec_id long, score long"
    out = spark.createDataFrame([], kinds)
    for number in range(blocks):
        held = queries.where(F.pmod(F.xxhash64("id", "turn"), F.lit(blocks)) == number)
        asked = _collected(held)
        floors = {}
        for n, (ids, rows) in asked.items():
            top = TopK(len(ids), k)
            if n in pilot:
                search(ids, rows, *pilot[n], top, block)
            floors[n] = top.scores[:, -1].copy()

        def run(batches, asked=asked, floors=floors):
            tops = {n: TopK(len(ids), k, floors[n]) for n, (ids, _) in asked.items()}
            for ids, vectors in _pieces(batches):
                for n, (found, rows) in matrices(ids, vectors).items():
                    if n in asked:
                        search(*asked[n], found, rows, tops[n], block)
            for n, top in tops.items():
                row, column = np.nonzero(top.ids != NONE)
                scores = top.scores[row, column]
                real = (scores > LOW) & (scores >= floors[n][row])
                if real.any():
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, (*asked[n][0][row[real]].T, top.ids[row, column][real], scores[real]))],
                        names=["query_id", "turn", "vec_id", "score"],
                    )

        found = ordered.mapInArrow(run, kinds)
        # stored, a block leaves the driver before the next one is read
        out = out.unionByName(found if number == blocks - 1 else stored(found, "search-found"))
    rank = F.row_number().over(Window.partitionBy("query_id", "turn").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), numbered AS (
  SELECT *, row_number() OVER () AS row FROM sound
), scored AS (
  SELECT q.vec_id AS query_id, q.row, c.vec_id,
    list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM numbered q JOIN numbered c ON q.vec_id % 50 = 0 AND q.row <> c.row AND len(q.v) = len(c.v)
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
) WHERE rank <= 5
"""


def op9_block_search(spark, sf_dir: str) -> DataFrame:
    rows = integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(rows, rows.where(F.col("id") % 50 == 0))
