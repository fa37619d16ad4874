"""The search over many groups of queries and many parts of the table, and the selection of one task."""

import numpy as np
import pytest

from almanac.llm import topk

K = 3


def expected(rows, queries):
    """Brute force over (id, weights, uid)."""
    out = []
    for key, weights, uid in queries:
        found = [(-int(np.dot(weights.astype(object), w.astype(object))), i, u) for i, w, u in rows if u != uid]
        out += [(uid, key, i, u, -score) for score, i, u in sorted(found)[:K]]
    return sorted(out)


@pytest.mark.parametrize("largest", [1, 100, 3_000_000, 1 << 30, 1_600_000_000], ids=["ties", "float", "double", "long", "any"])
def test_a_selection_keeps_the_best_of_all_blocks(monkeypatch, largest):
    monkeypatch.setattr(topk, "TILE_QUERIES", 4)
    monkeypatch.setattr(topk, "TILE_ROWS", 8)
    random = np.random.default_rng(largest)
    weights = random.integers(-largest, largest + 1, (90, 5)).astype(object if largest > 1 << 30 else np.int32)
    weights[:, 2] = 0
    ids, uids = random.integers(0, 30, 90), np.arange(90)
    chosen = np.flatnonzero(ids % 5 == 0)
    selection = topk.Selection(ids[chosen], weights[chosen], uids[chosen], K)
    for at in range(0, 90, 40):
        selection.meet(ids[at : at + 40], weights[at : at + 40], uids[at : at + 40])
    rows = [row for batch in selection.batches() for row in zip(*batch.to_pydict().values(), strict=True)]
    assert sorted(rows) == expected(list(zip(ids, weights, uids)), [(ids[i], weights[i], i) for i in chosen])


def test_blocks_stay_where_they_are(spark, monkeypatch):
    """Before, each candidate block was shuffled once for each query block, and the other way round."""
    random = np.random.default_rng(0)
    vectors = random.integers(-50, 50, (600, 6)) / 64.0
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(topk, "GROUP_QUERIES", 4, raising=False)
    monkeypatch.setattr(topk, "TASK_SCORES", 500, raising=False)
    result = topk.search(table.repartition(6), k=K)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "hashpartitioning(c_" not in plan and "hashpartitioning(q_" not in plan
    weights = np.floor(64 * vectors).astype(np.int64)
    scores = weights @ weights.T
    order = {q: sorted((-scores[q, i], i) for i in range(600) if i != q)[:K] for q in range(0, 600, 20)}
    assert sorted(map(tuple, result.collect())) == [
        (q, rank, i, -score) for q, found in order.items() for rank, (score, i) in enumerate(found, 1)
    ]
