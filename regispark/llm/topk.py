"""Exact top-k inner products by a three-phase uniform threshold.

Vectors are cut into ``LISTS`` stripes of components. A stripe's products with a query are that
query's score list there, and a score is the sum of its entries over all lists. Lists lie in
tables of their own rows, cut into chunks of rows, so a list's chunk is one node.

1. Every node gathers its ``k`` best local entries of each query. Whole scores of these rows give a
   cutoff: the k-th best of them, which no answer is below.
2. The cutoff is broadcast. Every node collects all entries of at least cutoff / LISTS: a row that is
   below that everywhere cannot reach the cutoff.
3. Entries meet by chunk of rows. What a missing list can add at most is known, which drops some;
   the others get their missing entries, so all remaining scores are exact.

Queries go against all rows in groups of ``QUERIES``, which bounds what is broadcast and what a task
holds; no pair of rows becomes a row of a table unless it is among a chunk's ``k`` best of a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regispark.llm.frames import materialize, scratch_path, ship

#: Score lists a vector is cut into.
LISTS = 2
#: Rows of a node, and queries of a group.
CHUNK = 4096
QUERIES = 1024
#: Queries whose products with a node are held at once.
SLICE = 128
#: Whole numbers up to here are exact in floating point.
EXACT = 1 << 53
LEAST = -(1 << 63)

NODES = "chunk bigint, list int, ids array<bigint>, asked array<int>, width int, values binary"
BLOCKS = "chunk bigint, block int, list int, pos array<int>, ids array<bigint>, width int, values binary"
ENTRIES = "chunk bigint, list int, q binary, pos binary, score binary"
RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"


def whole_vectors(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component; null for a null vector or one with a null or non-finite component."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))
    return F.when(vector.isNotNull() & sound, whole)


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    if _bound(queries, rows) < EXACT:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def _bound(queries: np.ndarray, rows: np.ndarray) -> int:
    """What no product is beyond."""
    largest = [max(int(x.max()), -int(x.min())) for x in (queries, rows)]
    bound = largest[0] * largest[1] * rows.shape[1]
    if bound >= -LEAST:
        raise OverflowError("a score does not fit 64 bits")
    return bound


def _pairs(queries: np.ndarray, rows: np.ndarray, q: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Inner products of given pairs of a query and a row, some at a time."""
    out = np.zeros(len(q), np.int64)
    if queries.size and rows.size:
        _bound(queries, rows)
        for at in range(0, len(q), 1 << 16):
            part = slice(at, at + (1 << 16))
            out[part] = np.einsum("ij,ij->i", queries[q[part]], rows[pos[part]])
    return out


def nodes(rows: DataFrame, width: int, lists: int = LISTS, chunk: int = CHUNK) -> DataFrame:
    """Rows ``(id, values, asked)`` as one row per list and chunk, components as 64-bit numbers."""
    edges = [width * j // lists for j in range(lists + 1)]

    def told(number: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros((len(held), width), np.int64)
        for at, (_, values, _) in enumerate(held):
            whole[at, : len(values)] = values
        name = (TaskContext.get().partitionId() << 33) + number
        asked = [at for at, row in enumerate(held) if row[2]]
        for j in range(lists):
            cut = np.ascontiguousarray(whole[:, edges[j] : edges[j + 1]])
            row = (name, j, [r[0] for r in held], asked, cut.shape[1], cut.tobytes())
            yield _batch(NODES, [row])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number = 0
        for batch in batches:
            held.extend(zip(*(c.to_pylist() for c in batch.columns)))
            while len(held) >= chunk:
                yield from told(number, held[:chunk])
                held, number = held[chunk:], number + 1
        if held:
            yield from told(number, held)

    return rows.select("id", "values", "asked").mapInArrow(run, NODES)


_TYPES = {
    "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    named = [part.split() for part in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(named)
    arrays = [pa.array(list(c), _TYPES[kind]) for c, (_, kind) in zip(columns, named)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in named])


def _matrix(values: bytes, count: int, width: int) -> np.ndarray:
    return np.frombuffer(values, np.int64).reshape(count, width)


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that ask, in blocks."""
    for batch in batches:
        for row in batch.to_pylist():
            whole = _matrix(row["values"], len(row["ids"]), row["width"])
            for block, at in enumerate(range(0, len(row["asked"]), SLICE)):
                pos = row["asked"][at : at + SLICE]
                ids = [row["ids"][p] for p in pos]
                yield _batch(BLOCKS, [(row["chunk"], block, row["list"], pos, ids, row["width"], whole[pos].tobytes())])


class Group:
    """Queries that go against all rows together: where each stands, its id, its stripes, its cutoff."""

    def __init__(self, blocks: list):
        first = [b for b in blocks if b["list"] == 0]
        self.chunk = np.concatenate([np.full(len(b["pos"]), b["chunk"], np.int64) for b in first])
        self.pos = np.concatenate([np.array(b["pos"], np.int64) for b in first])
        self.ids = [key for b in first for key in b["ids"]]
        lists = sorted({b["list"] for b in blocks})
        self.values = [
            np.concatenate([_matrix(bytes(b["values"]), len(b["pos"]), b["width"]) for b in blocks if b["list"] == j])
            for j in lists
        ]
        self.cutoff = np.full(len(self.ids), LEAST, np.int64)

    def scores(self, row: dict) -> Iterator[tuple[int, np.ndarray]]:
        """Local scores of a node, some queries at a time; a query's own row has none."""
        rows = _matrix(row["values"], len(row["ids"]), row["width"])
        for at in range(0, len(self.ids), SLICE):
            found = products(self.values[row["list"]][at : at + SLICE], rows)
            own = np.flatnonzero(self.chunk[at : at + SLICE] == row["chunk"])
            found[own, self.pos[at + own]] = LEAST
            yield at, found


def _best_of_each(q: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each query, in an order where a query's rows stand together."""
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    return np.flatnonzero(place < k)


def _local_best(group, k: int):
    """Phase 1 at a node: its ``k`` best entries of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q, pos, score = [], [], []
                for at, found in group.value.scores(row):
                    best = np.argpartition(-found, k - 1, axis=1)[:, :k] if found.shape[1] > k else None
                    if best is None:
                        best = np.tile(np.arange(found.shape[1]), (len(found), 1))
                    local = np.take_along_axis(found, best, 1)
                    there, place = np.nonzero(local > LEAST)
                    q.append(at + there)
                    pos.append(best[there, place])
                    score.append(local[there, place])
                yield _entries(row, q, pos, score)

    return run


def _above_cutoff(group, lists: int):
    """Phase 2 at a node: all entries of at least cutoff / lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q, pos, score = [], [], []
                for at, found in group.value.scores(row):
                    cutoff = group.value.cutoff[at : at + SLICE]
                    # cutoff / lists, rounded up; without a cutoff all entries
                    least = np.where(cutoff == LEAST, LEAST + 1, (cutoff + (lists - 1)) // lists)[:, None]
                    there, place = np.nonzero(found >= least)
                    q.append(at + there)
                    pos.append(place)
                    score.append(found[there, place])
                yield _entries(row, q, pos, score)

    return run


def _entries(row: dict, q: list, pos: list, score: list) -> pa.RecordBatch:
    def flat(parts: list, kind) -> bytes:
        return np.concatenate(parts).astype(kind).tobytes()

    return _batch(ENTRIES, [(row["chunk"], row["list"], flat(q, np.int32), flat(pos, np.int32), flat(score, np.int64))])


def _resolved(group, lists: int, k: int):
    """Whole scores of the rows of a chunk that some list named, and of these each query's ``k`` best
    that reach the cutoff."""

    def run(named: pa.Table, stripes: pa.Table) -> pa.Table:
        own, stripes = group.value, sorted(stripes.to_pylist(), key=lambda r: r["list"])
        if not stripes or not named.num_rows:
            return pa.Table.from_batches([_batch(FOUND, [])])
        ids = stripes[0]["ids"]
        given = named.to_pylist()
        codes = [
            np.frombuffer(r["q"], np.int32).astype(np.int64) * len(ids) + np.frombuffer(r["pos"], np.int32) for r in given
        ]
        code = np.unique(np.concatenate(codes))
        q, pos = np.divmod(code, len(ids))
        # What a list adds that has not named a row: less than cutoff / lists, so this at most.
        cutoff = own.cutoff[q]
        most = np.where(cutoff == LEAST, -LEAST // 4 // lists, (cutoff - 1) // lists)
        known = np.zeros((lists, len(code)), bool)
        score = np.zeros((lists, len(code)), np.int64)
        for r, c in zip(given, codes):
            at = np.searchsorted(code, c)
            known[r["list"], at] = True
            score[r["list"], at] = np.frombuffer(r["score"], np.int64)
        alive = np.flatnonzero(np.where(known, score, most).sum(axis=0) >= cutoff)
        for r in stripes:
            j = r["list"]
            open_ = alive[~known[j, alive]]
            rows = _matrix(r["values"], len(ids), r["width"])
            score[j, open_] = _pairs(own.values[j], rows, q[open_], pos[open_])
        total = score[:, alive].sum(axis=0)
        alive, total = alive[total >= cutoff[alive]], total[total >= cutoff[alive]]
        q, pos = q[alive], pos[alive]
        key = np.array([x if x is not None else -(LEAST + 1) for x in ids], np.int64)[pos]
        order = np.lexsort((key, -total, q))
        order = order[_best_of_each(q[order], k)]
        rows = [(int(q[o]), own.ids[q[o]], ids[pos[o]], int(total[o])) for o in order]
        return pa.Table.from_batches([_batch(FOUND, rows)])

    return run


FOUND = "q int, query_id bigint, vec_id bigint, score bigint"


def exact_top_k(rows: DataFrame, k: int = 10, lists: int = LISTS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` rows with the highest inner
    product with each query, ties to the smaller ``vec_id``; all rows if there are fewer.

    ``rows`` holds ``id`` (whole number), ``values`` (array of whole numbers) and ``asked`` (whether the row
    is a query); other columns are not read. Rows without ``values`` take no part. Shorter vectors
    count as ending in zeros. A query does not meet its own row, but other rows of its id;
    every row that asks gets an answer of its own, also where ids repeat. Rows without id are
    candidates, last among ties. A score beyond 64 bits fails the job. No queries, no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    part = rows.where(F.col("values").isNotNull()).select(
        F.col("id").cast("bigint").alias("id"), "values", F.coalesce("asked", F.lit(False)).alias("asked")
    )
    width = part.agg(F.max(F.size("values"))).first()[0] or 0
    all_nodes = materialize(nodes(part, width, lists), "nodes")
    blocks = materialize(all_nodes.where(F.size("asked") > 0).mapInArrow(_query_blocks, BLOCKS), "queries")
    # One row per block of queries, without their vectors.
    sizes = blocks.where("list = 0").select("chunk", "block", F.size("pos").alias("n")).orderBy("chunk", "block").collect()
    target, number, group = scratch_path(spark, "topk"), 0, []
    for at, one in enumerate(sizes):
        group.append(one)
        if at + 1 == len(sizes) or sum(x["n"] for x in group) + sizes[at + 1]["n"] > QUERIES:
            _answer(all_nodes, blocks, group, k, lists).write.parquet(f"{target}/queries={number}")
            number, group = number + 1, []
    if not number:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(f"{RESULT}, queries int").parquet(target).drop("queries")


def _answer(all_nodes: DataFrame, blocks: DataFrame, group: list, k: int, lists: int) -> DataFrame:
    spark = all_nodes.sparkSession
    wanted = {(x["chunk"], x["block"]) for x in group}
    near = blocks.where(F.col("chunk").between(group[0]["chunk"], group[-1]["chunk"]))
    held = [b for b in near.collect() if (b["chunk"], b["block"]) in wanted]
    own = Group(sorted(held, key=lambda b: (b["list"], b["chunk"], b["block"])))

    def met(run, whole: DataFrame) -> DataFrame:
        return run.groupBy("chunk").cogroup(whole.groupBy("chunk")).applyInArrow(_resolved(sent, lists, k), FOUND)

    sent = spark.sparkContext.broadcast(own)
    first = met(all_nodes.mapInArrow(_local_best(sent, k), ENTRIES), all_nodes)
    best = Window.partitionBy("q").orderBy(F.desc("score"))
    cutoffs = first.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).groupBy("q").agg(
        F.min("score").alias("score"), F.count(F.lit(1)).alias("n")
    )
    for row in cutoffs.where(F.col("n") == k).collect():  # one number per query of the group
        own.cutoff[row["q"]] = row["score"]
    sent = spark.sparkContext.broadcast(own)
    found = met(all_nodes.mapInArrow(_above_cutoff(sent, lists), ENTRIES), all_nodes)
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
