"""Exact search for the k greatest inner products, block by block.

Vectors of whole numbers are put in an order in which neighbours are alike (the
nearest of some pivots, then the id) and cut into ranges, the blocks. A block
keeps the greatest and least value of each component and its vectors as a small
matrix. For a query, the sum over components of what a block's extremes allow is
a bound on all scores in it. Blocks are scored in order of falling bounds, until
a query's next bound falls below its kth score.

Ranges of blocks are met in the same way. What the extremes of whole ranges allow,
for few enough of them to be sent to all tasks, ranks the ranges for each query. A
round sends each query to its next ranges in that order, three times as many as in
all rounds before, but to none whose bound is below the kth score found so far, and
a range returns only scores that reach it. As later ranges rank lower, a round adds
about k rows for a query times the growth of its share, whatever the number of ranges.
The unit of work is (a range, a chunk of the queries sent there), so neither side is
held as a whole, and a range is copied only as often as it has chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.frames import written

K = 20
BLOCK_ROWS = 256
#: Rows of a range of blocks, and queries of a chunk: what a task holds.
RANGE_ROWS = 1 << 14
CHUNK_ROWS = 1 << 12
#: Rows that the pivots are chosen from, and their number. They only decide the
#: order of rows, never the result.
PIVOT_SAMPLE, PIVOTS = 4096, 64

#: Bytes of extremes that are sent to all tasks. Beyond as many ranges, neighbours
#: share a summary.
SUMMARY_BYTES = 1 << 24
#: Ranges of a query in the first round, and by how much its rounds grow.
FIRST_RANGES, GROWTH = 1, 4
#: Numbers in a matrix of bounds of queries and summaries.
BOUND_CELLS = 1 << 20

EXTREMES = "summary int, first long, high binary, low binary"
ROUTES = "vec_id long, which long, vector array<long>, kth long, kth_id long, summary int"
BLOCKS = "part int, first long, ids binary, vectors binary, high binary, low binary"
FOUND = "query_id long, which long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Vectors that are not null and hold finite numbers only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, x as a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


LEAST, MOST = -(1 << 63), (1 << 63) - 1


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of 64-bit whole numbers, exactly; an error if one does not fit."""
    found = products(a, b)
    if found.dtype == object and found.size and (found.max() > MOST or found.min() < LEAST):
        raise OverflowError("scores exceed 64 bits")
    return found.astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of 64-bit whole numbers, exactly; Python's where they might not fit."""
    top_a, top_b = (max(int(m.max(initial=0)), -int(m.min(initial=0))) for m in (a, b))
    most = top_a * top_b * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    return a.astype(object) @ b.astype(object).T


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each query and block, a number no score in the block exceeds, or the
    nearest one of 64 bits."""
    pairs = ((np.maximum(queries, 0), high), (np.minimum(queries, 0), low))
    try:
        up, down = (product(a, b) for a, b in pairs)
        if max(np.abs(up).max(initial=0), np.abs(down).max(initial=0)) < 1 << 62 and min(up.min(initial=0), down.min(initial=0)) > LEAST:
            return up + down
    except OverflowError:
        pass
    up, down = (products(a, b).astype(object) for a, b in pairs)
    return np.clip(up + down, LEAST, MOST).astype(np.int64)


def search(
    queries: np.ndarray, query_ids: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], bound: np.ndarray, k: int, least: np.ndarray | None = None
) -> list[list[tuple[int, int]]]:
    """For each query the k best (score, id) over all blocks (ids, vectors), ties
    to the smaller id; rows of the query's own id take no part, nor do scores below
    its `least`. A score among the k best that does not fit 64 bits is an error."""
    order = np.argsort(~bound, axis=1, kind="stable")  # ~x falls as x rises, without overflow
    best: list[list[tuple[int, int]]] = [[] for _ in range(len(queries))]  # (-score, id), best first
    kth = np.full(len(queries), LEAST, np.int64) if least is None else least.astype(np.int64)
    open_ = np.arange(len(queries))
    for turn in range(len(blocks)):
        open_ = open_[bound[open_, order[open_, turn]] >= kth[open_]]
        if not len(open_):
            break
        chosen = order[open_, turn]
        for b in np.unique(chosen):
            who = open_[chosen == b]
            ids, vectors = blocks[b]
            try:
                scores = product(queries[who], vectors)
            except OverflowError:  # it matters only if such a score is among the k best
                scores = products(queries[who], vectors)
            good = scores >= kth[who][:, None]
            if scores.dtype == object:  # what is below 64 bits still counts where there are fewer than k
                good = good.astype(bool) | np.array([len(best[q]) < k for q in who])[:, None]
            good &= ids[None, :] != query_ids[who][:, None]
            for row in np.flatnonzero(good.any(axis=1)):
                at = np.flatnonzero(good[row])
                found = scores[row, at]
                if len(at) > k:  # ids rise within a block, so a stable sort keeps the smaller on ties
                    top = np.argsort(-found, kind="stable")[:k]
                    at, found = at[top], found[top]
                q = who[row]
                best[q] = sorted(best[q] + list(zip((-found).tolist(), ids[at].tolist(), strict=True)))[:k]
                if len(best[q]) == k:
                    kth[q] = max(-best[q][-1][0], kth[q])
    return [[(-score, i) for score, i in own] for own in best]


def _pivots(rows: DataFrame, dim: int) -> np.ndarray:
    """Centres of a bounded sample, by a few rounds of k-means."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("vector").toArrow()
    data = _matrix(sample.column("vector").to_pylist(), dim).astype(float)
    data = data[np.lexsort(data.T[::-1])] if len(data) else data
    centres = data[:: max(1, len(data) // PIVOTS)][:PIVOTS].copy()
    for _ in range(5 if len(data) else 0):
        near = _nearest(data, centres)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = data[near == c].mean(axis=0)
    return centres


def _nearest(data: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(data @ centres.T - (centres**2).sum(axis=1) / 2, axis=1)


def _matrix(vectors: list, dim: int) -> np.ndarray:
    """Rows of `dim` whole numbers; shorter vectors end in zeros."""
    found = np.zeros((len(vectors), dim), np.int64)
    for row, v in zip(found, vectors, strict=True):
        row[: len(v)] = v
    return found


def _blocked(dim: int):
    """Rows in order of pivot and id to blocks; `part` is the task's range."""

    def block(rows: list[tuple]) -> tuple:
        rows.sort(key=lambda r: r[0])
        vectors = _matrix([r[1] for r in rows], dim)
        ids = np.array([r[0] for r in rows], np.int64)
        return TaskContext.get().partitionId(), int(ids[0]), *(x.tobytes() for x in (ids, vectors, vectors.max(axis=0), vectors.min(axis=0)))

    def run(batches):
        held, pivot = [], None
        names, types = ["part", "first", "ids", "vectors", "high", "low"], [pa.int32(), pa.int64(), *[pa.binary()] * 4]
        for batch in batches:
            done = []
            for i, vector, own in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "vector", "pivot")), strict=True):
                if held and (own != pivot or len(held) == BLOCK_ROWS):
                    done.append(block(held))
                    held = []
                held.append((i, vector))
                pivot = own
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(block(held), types, strict=True)], names=names)

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, scale: int = 64, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row for which `is_query`
    holds, the k rows of other ids with the greatest inner products of
    floor(scale * x), all if there are fewer; ties to the smaller id.

    Vectors that are null, or hold nulls or numbers that are not finite, and
    rows without an id take no part. Shorter vectors count as ending in zeros,
    so empty ones score 0. A repeated query row is searched once; of an id with
    several vectors each is searched and has its own k rows. Repeated candidates are candidates each. Other columns are ignored.
    """
    source = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("_v"), is_query.alias("query"))
    rows = source.where(F.col("vec_id").isNotNull() & usable(F.col("_v"))).select("vec_id", whole(F.col("_v"), scale).alias("vector"), "query")
    total, dim = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    spark = vectors.sparkSession
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = max(dim, 1)
    centres = spark.sparkContext.broadcast(_pivots(rows, dim))  # PIVOTS vectors

    def near(batches):
        for batch in batches:
            data = _matrix(batch.column("vector").to_pylist(), dim).astype(float)
            own = pa.array(_nearest(data, centres.value).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=[*batch.schema.names, "pivot"])

    placed = rows.select("vec_id", "vector").mapInArrow(near, "vec_id long, vector array<long>, pivot int")
    ranges = placed.repartitionByRange(-(-total // RANGE_ROWS), "pivot", "vec_id").sortWithinPartitions("pivot", "vec_id", "vector")
    blocks = written(ranges.mapInArrow(_blocked(dim), BLOCKS), "blocks")
    extremes = _extremes(blocks, dim)

    asked = rows.where("query").select("vec_id", "vector").distinct().withColumn("which", F.xxhash64("vector"))
    asked = written(asked.withColumns(dict.fromkeys(("kth", "kth_id"), F.lit(None).cast("long"))), "asked")
    best = spark.createDataFrame([], f"{FOUND}, rank int")
    done, upto, order = 0, FIRST_RANGES, Window.partitionBy("query_id", "which").orderBy(F.col("score").desc(), "vec_id")
    while done < extremes.count:
        routes = written(asked.mapInArrow(extremes.routes(done, upto), ROUTES), "routes")
        if routes.isEmpty():  # bounds fall from rank to rank, so no later one is reached either
            break
        found = _met(blocks, routes, extremes.span, dim, k)
        ranked = best.drop("rank").unionByName(found).withColumn("rank", F.row_number().over(order))
        best = written(ranked.where(F.col("rank") <= k), "best")
        last = best.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "which", F.col("score").alias("kth"), best.vec_id.alias("kth_id"))
        asked = asked.drop("kth", "kth_id").join(last, ["vec_id", "which"], "left").select("vec_id", "vector", "which", "kth", "kth_id")
        if upto < extremes.count:
            asked = written(asked, "asked")
        done, upto = upto, upto * GROWTH
    return best.select("query_id", "rank", "vec_id", "score")


class _Summaries:
    """Extremes of ranges, each of `span` neighbours, at most SUMMARY_BYTES of them."""

    def __init__(self, spark: SparkSession, first: np.ndarray, high: np.ndarray, low: np.ndarray, names: np.ndarray, span: int):
        self.count, self.span = len(names), span
        self._sent = spark.sparkContext.broadcast((first, high, low, names))

    def routes(self, done: int, upto: int):
        """Sends queries to their ranges of ranks done to upto, best bounds first, that
        can reach the kth row so far: a greater score, or an equal one with a smaller id."""
        sent = self._sent

        def run(batches):
            first, high, low, names = sent.value
            dim = high.shape[1]
            step = max(1, BOUND_CELLS // len(names))
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    part = batch.slice(start, step)
                    bound = bounds(_matrix(part.column("vector").to_pylist(), dim), high, low)
                    kth, kth_id = (part.column(c).fill_null(v).to_numpy()[:, None] for c, v in (("kth", LEAST), ("kth_id", MOST)))
                    reached = (bound > kth) | ((bound == kth) & (first[None, :] <= kth_id))
                    order = np.argsort(~bound, axis=1, kind="stable")[:, done:upto]
                    row, rank = np.nonzero(np.take_along_axis(reached, order, axis=1))
                    who = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [*(who.column(c) for c in ("vec_id", "which", "vector")), pa.array(kth[row, 0]), pa.array(kth_id[row, 0]), pa.array(names[order[row, rank]], pa.int32())],
                        names=["vec_id", "which", "vector", "kth", "kth_id", "summary"],
                    )

        return run


def _extremes(blocks: DataFrame, dim: int) -> _Summaries:
    last = blocks.agg(F.max("part")).first()[0]
    span = -(-(last + 1) // max(1, SUMMARY_BYTES // (16 * dim)))

    def fold(name: str):
        def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            high, low = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64).reshape(-1, dim) for c in ("high", "low"))
            folded = (key[0].as_py(), min(table.column("first").to_pylist()), high.max(axis=0).tobytes(), low.min(axis=0).tobytes())
            types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            return pa.table([pa.array([v], t) for v, t in zip(folded, types, strict=True)], names=[name, "first", "high", "low"])

        return run

    # by range first, so that the ranges of a summary meet as one row each
    by_part = blocks.groupBy("part").applyInArrow(fold("part"), EXTREMES.replace("summary", "part"))
    by_summary = by_part.withColumn("summary", F.expr(f"part div {span}").cast("int")).drop("part")
    if span > 1:
        by_summary = by_summary.groupBy("summary").applyInArrow(fold("summary"), EXTREMES)
    rows = by_summary.orderBy("summary").toArrow()  # SUMMARY_BYTES at most
    high, low = (np.frombuffer(b"".join(rows.column(c).to_pylist()), np.int64).reshape(-1, dim) for c in ("high", "low"))
    return _Summaries(blocks.sparkSession, rows.column("first").to_numpy(), high, low, rows.column("summary").to_numpy(), span)


def _met(blocks: DataFrame, routes: DataFrame, span: int, dim: int, k: int) -> DataFrame:
    """What ranges give to the queries sent there, in chunks of queries."""
    chunks = routes.groupBy("summary").agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("chunks"))
    summary = F.expr(f"part div {span}").cast("int")
    left = blocks.withColumn("summary", summary).join(chunks, "summary").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = routes.join(chunks, "summary").withColumn("chunk", F.pmod(F.xxhash64("vec_id", "which"), F.col("chunks")).cast("int"))
    first = F.col("summary") * span
    right = dealt.withColumn("part", F.explode(F.sequence(first, first + (span - 1))))

    def meet(ranges: pa.Table, wanted: pa.Table) -> pa.Table:
        columns = {c: ranges.column(c).to_pylist() for c in ("ids", "vectors", "high", "low")}
        ids = wanted.column("vec_id").to_numpy()
        queries = _matrix(wanted.column("vector").to_pylist(), dim)
        high, low = (np.frombuffer(b"".join(columns[c]), np.int64).reshape(-1, dim) for c in ("high", "low"))
        stored = [
            (np.frombuffer(i, np.int64), np.frombuffer(v, np.int64).reshape(-1, dim))
            for i, v in zip(columns["ids"], columns["vectors"], strict=True)
        ]
        found = search(queries, ids, stored, bounds(queries, high, low), k, wanted.column("kth").to_numpy()) if len(ids) and stored else []
        kth, kth_id = (wanted.column(c).to_pylist() for c in ("kth", "kth_id"))
        queried = zip(ids.tolist(), wanted.column("which").to_pylist(), kth, kth_id, found, strict=True) if found else ()
        rows = [(q, w, i, score) for q, w, low, last, own in queried for score, i in own if score > low or i <= last]
        columns = zip(*rows, strict=True) if rows else ((), (), (), ())
        names = ["query_id", "which", "vec_id", "score"]
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(names, columns, strict=True)})

    left = left.select("part", "chunk", "ids", "vectors", "high", "low")
    right = right.select("part", "chunk", "vec_id", "which", "vector", "kth", "kth_id")
    return left.groupBy("part", "chunk").cogroup(right.groupBy("part", "chunk")).applyInArrow(meet, FOUND)
