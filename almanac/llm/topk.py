"""Exact top-k inner products of integer vectors, accumulated by terms.

The table is packed into blocks of rows (plain arrays in one row each), written
once; the query rows are packed again into groups, one row each, of bounded size.
A task meets one group with the candidate blocks of one part of the table, which it reads
where they lie: neither blocks nor pairs of blocks are shuffled.  A dimension's weights in a
candidate block are its posting list, and each query that has the dimension adds its weight times the list
to its row of a dense score array; dimensions that one side lacks are left out.  Each query keeps its k best so
far, so of a later score array only the scores that reach the least of these are looked at.  The selections of
all parts are merged by rank.

A component x becomes floor(``SCALE`` * x).  Vectors may differ in length; a missing
dimension weighs nothing.  Scores are exact: they are accumulated in floats while all sums stay below the
whole numbers that these hold, else in 64 bits, if need be in Python's whole numbers.  A score among the results that does not fit into
64 bits is an error.

Nulls and odd rows: a vector that is null, or holds a null or a non-finite component, takes no part; nor does a row with a null id.
A component whose weight is infinite as a double is an error.
Rows with equal ids are rows of their own, and only the very query row is left out of its candidates; further ties go by block and place.
Empty tables, and tables without a query, give an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.staging import stage

# Weights per unit, queries are rows whose id is divisible by QUERY_STEP, results per query.
SCALE, QUERY_STEP, K = 64.0, 20, 20

# Rows of a candidate block and of a query block, and bytes of a candidate block; queries and candidates scored at once.
ROWS, QUERIES, BLOCK_BYTES = 8192, 512, 8 << 20
TILE_QUERIES, TILE_ROWS = 256, 1024

# Queries of a group and bytes of their weights (4 each), which a worker holds; scores of a task.
GROUP_QUERIES, GROUP_BYTES, TASK_SCORES = 32768, 8 << 20, 10**11

# Weights are kept in as many bytes as they need; 0 stands for pickled whole numbers of any size.
BLOCK_SCHEMA = "block bigint, n int, width int, bytes int, ids binary, weights binary, uids binary"
NARROW = {1: "<i1", 2: "<i2", 4: "<i4"}

LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _block(number: int, ids: np.ndarray, weights: np.ndarray, uids: np.ndarray) -> pa.RecordBatch:
    wide = weights.dtype == object
    size = 0 if wide else next(size for size in NARROW if size == 4 or _largest(weights) < 1 << 8 * size - 1)
    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array([number], pa.int64()), "n": pa.array([len(ids)], pa.int32()),
            "width": pa.array([weights.shape[1]], pa.int32()), "bytes": pa.array([size], pa.int32()),
            "ids": [ids.astype("<i8").tobytes()],
            "weights": [pickle.dumps(weights) if wide else weights.astype(NARROW[size]).tobytes()], "uids": [uids.astype("<i8").tobytes()],
        }
    )


def _arrays(batch: pa.RecordBatch, row: int, side: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    value = {x: batch.column(f"{side}{x}")[row] for x in ("n", "width", "bytes", "ids", "weights", "uids")}
    n, width, size = (value[x].as_py() for x in ("n", "width", "bytes"))
    # Pickled weights were written by this module's own tasks.
    if size:
        weights = np.frombuffer(value["weights"].as_buffer(), NARROW[size]).reshape(n, width)
    else:
        weights = pickle.loads(value["weights"].as_py())
    return np.frombuffer(value["ids"].as_buffer(), "<i8"), weights, np.frombuffer(value["uids"].as_buffer(), "<i8")


def weighted(ids: pa.Array, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integer weights (padded with 0 to one length) of the rows that take part; 32 bits or Python's whole numbers."""
    kept, rows = [], []
    for key, vector in zip(ids.to_pylist(), vectors, strict=True):
        if key is None or not vector.is_valid or vector.values.null_count:
            continue
        x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all():
            with np.errstate(over="ignore"):
                weights = np.floor(SCALE * x)
            if not np.isfinite(weights).all():
                raise ValueError(f"a component of {key} has no finite weight")
            kept.append(key)
            rows.append(weights)
    wide = any(len(x) and np.abs(x).max() >= 1 << 31 for x in rows)
    out = np.zeros((len(rows), max(map(len, rows), default=0)), dtype=object if wide else np.int32)
    for i, x in enumerate(rows):
        out[i, : len(x)] = [int(v) for v in x] if wide else x.astype(np.int32)
    return np.array(kept, dtype=np.int64), out


def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate blocks of a partition; a row's uid is its block and place."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        widest = pc.max(pc.list_value_length(batch.column(1))).as_py() or 1
        rows = max(1, min(ROWS, BLOCK_BYTES // (4 * widest)))
        for at in range(0, batch.num_rows, rows):
            ids, weights = weighted(batch.column(0).slice(at, rows), batch.column(1).slice(at, rows))
            if len(ids):
                yield _block(number, ids, weights, number * ROWS + np.arange(len(ids)))
                number += 1


def _pack_queries(step: int):
    def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                ids, weights, uids = _arrays(batch, row)
                chosen = ids % step == 0
                for at in range(0, int(chosen.sum()), QUERIES):
                    held.append(tuple(a[chosen][at : at + QUERIES] for a in (ids, weights, uids)))
                    size += len(held[-1][0])
                    if size >= QUERIES:
                        yield _block(number, *_stacked(held))
                        number, held, size = number + 1, [], 0
        if held:
            yield _block(number, *_stacked(held))

    return of_blocks


def _group_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The query blocks of a partition as one, with the partition as its number."""
    held = [_arrays(batch, row) for batch in batches for row in range(batch.num_rows)]
    if held:
        yield _block(TaskContext.get().partitionId(), *_stacked(held))


def _stacked(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    wide = max(w.shape[1] for _, w, _ in parts)
    weights = [np.pad(w, ((0, 0), (0, wide - w.shape[1]))) for _, w, _ in parts]
    return np.concatenate([i for i, _, _ in parts]), np.vstack(weights), np.concatenate([u for _, _, u in parts])


def _largest(weights: np.ndarray) -> int:
    return max((abs(int(w)) for w in (weights.min(), weights.max())), default=0) if weights.size else 0


def tiles(queries: np.ndarray, candidates: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first query, first candidate, scores) of tile after tile, accumulated by terms that both sides have."""
    terms = min(queries.shape[1], candidates.shape[1])
    used = np.flatnonzero((queries[:, :terms] != 0).any(axis=0) & (candidates[:, :terms] != 0).any(axis=0))
    most = _largest(queries) * _largest(candidates) * len(used)
    kind = next((k for k, end in ((np.float32, 1 << 24), (np.float64, 1 << 53), (np.int64, 1 << 63)) if most < end), object)
    postings = np.ascontiguousarray(candidates[:, used].T.astype(kind))
    weights = np.ascontiguousarray(queries[:, used].astype(kind))
    for c in range(0, len(candidates), TILE_ROWS):
        lists = np.ascontiguousarray(postings[:, c : c + TILE_ROWS])
        for q in range(0, len(queries), TILE_QUERIES):
            of_queries = weights[q : q + TILE_QUERIES]
            if kind in (np.float32, np.float64):
                yield q, c, of_queries @ lists
                continue
            tile = np.zeros((len(of_queries), lists.shape[1]), dtype=kind)
            for term in range(len(used)):
                tile += of_queries[:, term, None] * lists[term]
            yield q, c, tile


def best(row: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    places = np.arange(len(row))
    if row.dtype == object:
        return np.array(sorted(places, key=lambda place: (-row[place], ids[place], place))[:k], dtype=np.int64)
    if len(places) > k:
        least = np.partition(row, len(row) - k)[len(row) - k]
        places = np.flatnonzero(row >= least)
    return places[np.lexsort((ids[places], -row[places].astype(np.int64)))][:k]


def _as_long(found: np.ndarray) -> np.ndarray:
    if found.dtype == object and any(abs(score) >= 1 << 63 for score in found):
        raise OverflowError("a score does not fit into 64 bits")
    return found.astype(np.int64)


class Selection:
    """The k best candidates so far of each query of a group, by score, id and uid."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, uids: np.ndarray, k: int):
        self.ids, self.weights, self.uids, self.k = ids, weights, uids, k
        self.least = np.full(len(ids), LEAST)
        nothing = np.zeros(0, dtype=np.int64)
        self.tiles = [(nothing,) * 4] * -(-len(ids) // TILE_QUERIES)
        self.waiting, self.sizes = [[] for _ in self.tiles], [0] * len(self.tiles)

    def meet(self, ids: np.ndarray, weights: np.ndarray, uids: np.ndarray) -> None:
        for q, c, scores in tiles(self.weights, weights):
            rows, places = self._hits(scores, self.least[q : q + TILE_QUERIES], ids[c : c + TILE_ROWS])
            found = scores[rows, places]
            found = found if found.dtype == object else found.astype(np.int64)
            rows, places = rows + q, places + c
            other = np.flatnonzero(uids[places] != self.uids[rows])
            if len(other):
                tile = q // TILE_QUERIES
                self.waiting[tile].append((rows[other], found[other], ids[places[other]], uids[places[other]]))
                self.sizes[tile] += len(other)
                if self.sizes[tile] * 2 > self.k * len(scores) or len(self.tiles[tile][0]) < self.k * len(scores):
                    self._merge(tile)

    def _hits(self, scores: np.ndarray, least: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores that may be among the best: not below the least of these, and of no more candidates a query than the k best and itself."""
        reach = np.arange(len(scores))
        if scores.dtype != object:
            hits = np.flatnonzero(scores >= least.astype(scores.dtype)[:, None])
            rows, places = np.divmod(hits, scores.shape[1])
            counts = np.bincount(rows, minlength=len(scores))
            if counts.max(initial=0) <= 4 * self.k:
                return rows, places
            reach = np.flatnonzero(counts)
        chosen = [best(scores[row], ids, self.k + 1) for row in reach]
        return np.repeat(reach, [len(x) for x in chosen]), np.concatenate(chosen)

    def _merge(self, tile: int) -> None:
        parts = [self.tiles[tile], *self.waiting[tile]]
        rows, scores, ids, uids = (np.concatenate([part[i] for part in parts]) for i in range(4))
        if scores.dtype == object:
            order = np.array(sorted(range(len(rows)), key=lambda i: (rows[i], -scores[i], ids[i], uids[i])))
        else:
            order = np.lexsort((uids, ids, -scores, rows))
        rows = rows[order]
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
        kept = order[rank < self.k]
        self.tiles[tile] = rows[rank < self.k], scores[kept], ids[kept], uids[kept]
        full = order[rank == self.k - 1]
        self.least[rows[rank == self.k - 1]] = [min(max(int(score), LEAST), MOST) for score in scores[full]]
        self.waiting[tile], self.sizes[tile] = [], 0

    def batches(self) -> Iterator[pa.RecordBatch]:
        for tile, waiting in enumerate(self.waiting):
            if waiting:
                self._merge(tile)
            rows, scores, ids, uids = self.tiles[tile]
            yield pa.RecordBatch.from_pydict(
                {"query_uid": self.uids[rows], "query_id": self.ids[rows], "vec_id": ids, "vec_uid": uids, "score": _as_long(scores)}
            )


def _score_pairs(k: int):
    def of_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        selections: dict[int, Selection] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                group = batch.column("q_block")[row].as_py()
                if group not in selections:
                    selections[group] = Selection(*(a.copy() for a in _arrays(batch, row, "q_")), k)
                selections[group].meet(*_arrays(batch, row, "c_"))
        for selection in selections.values():
            yield from selection.batches()

    return of_pairs


def _spread(candidates: DataFrame, queries: DataFrame) -> tuple[int, int]:
    """Into how many groups the queries go, and into how many parts the candidates.

    A group is no larger than its bounds.  Each part gives k results a query, so the queries are split further
    before the candidates are.
    """
    sums = queries.agg(F.sum("n"), F.sum(F.col("n").cast("bigint") * F.col("width") * 4), F.count("n")).first()
    n, size, blocks = (x or 0 for x in sums)
    rows = candidates.agg(F.sum("n")).first()[0] or 0
    tasks = 2 * candidates.sparkSession.sparkContext.defaultParallelism
    groups = max(1, -(-n // GROUP_QUERIES), -(-size // GROUP_BYTES), min(tasks, blocks))
    return groups, max(1, -(-tasks // groups), -(-rows * n // (groups * TASK_SCORES)))


def search(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query row of (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
    candidates = stage(rows.mapInArrow(pack_rows, BLOCK_SCHEMA), "candidate-blocks")
    queries = stage(candidates.mapInArrow(_pack_queries(query_step), BLOCK_SCHEMA), "query-blocks")
    groups, parts = _spread(candidates, queries)
    grouped = stage(queries.repartition(groups).mapInArrow(_group_queries, BLOCK_SCHEMA), "query-groups")
    # A task for each group and part; the groups were numbered from 0.
    left = candidates.coalesce(parts).select(*[F.col(c).alias(f"c_{c}") for c in candidates.columns])
    right = grouped.repartitionById(groups, F.col("block").cast("int")).select(*[F.col(c).alias(f"q_{c}") for c in grouped.columns])
    pairs = left.crossJoin(right.hint("shuffle_replicate_nl"))
    found = pairs.mapInArrow(
        _score_pairs(k), "query_uid bigint, query_id bigint, vec_id bigint, vec_uid bigint, score bigint"
    )
    order = Window.partitionBy("query_uid").orderBy(F.col("score").desc(), "vec_id", "vec_uid")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
