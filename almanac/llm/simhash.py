"""Near duplicates by SimHash: fingerprints within a few bits of each other are linked.

Equal fingerprints are one node from the start.  Candidates come from Golay keys
(:mod:`almanac.llm.golay`) and every candidate pair is verified bit by bit.  Within
the rows of a key only the links that join two parts not yet joined are emitted,
so a large group of near copies gives few links, not all its pairs, and no connection is lost.
A key with more than ``MOST_ROWS`` fingerprints is cut into blocks and its pairs of blocks become keys of their own.

Nulls and odd rows: a null text or one without words has fingerprint 0, and is linked like any other.
A null ``doc_id`` links like any other but is never a component's smallest; a component of
nulls only has a null id.  Repeated rows share their component.  An empty table gives an empty result.
Columns of the input named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm import golay
from almanac.llm.apart import own_columns_apart
from almanac.llm.components import components
from almanac.staging import stage

# Shingle length in words, seed of the shingle hash.
SHINGLE, SEED = 4, 42

# Fingerprints of one key that a task compares among themselves.
MOST_ROWS = 4096


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half the shingle hashes."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], dtype="<u8"
    )
    votes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text, shingle: int = SHINGLE):
    """The fingerprint as a BIGINT with the same 64 bits."""

    def of_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = (fingerprint(t, shingle) for t in texts.cast(pa.binary()).to_pylist())
            yield pa.array(np.fromiter(found, dtype=np.uint64, count=len(texts)).view(np.int64))

    of_batches.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(of_batches, "bigint")(text)


def _golay_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy()
        for at in range(0, len(prints), 8192):
            part = prints[at : at + 8192]
            keys, rows = golay.keys(part.view(np.uint64))
            yield pa.record_batch([pa.array(keys), pa.array(part[rows])], names=["key", "print"])


def links_within(bucket: np.ndarray, prints: np.ndarray, max_bits: int) -> np.ndarray:
    """Row pairs (a, b) that join fingerprints within ``max_bits``, a forest for each bucket.

    Rows are sorted by bucket; its lowest bit tells home (0) from probe (1) rows.  Pairs of two probes are not compared.
    """
    n = len(bucket)
    group = bucket >> 1
    new = np.empty(n, dtype=bool)
    new[:1] = True
    new[1:] = group[1:] != group[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    homes = np.add.reduceat(1 - (bucket & 1), np.flatnonzero(new))[np.cumsum(new) - 1] if n else bucket
    parent, found = np.arange(n), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    rows, home = np.arange(n), 0
    while True:
        rows = rows[(homes[rows] > home) & (rows > first[rows] + home)]
        if not len(rows):
            return np.array(found, dtype=np.int64).reshape(-1, 2)
        a = first[rows] + home
        near = (parent[a] != parent[rows]) & (np.bitwise_count((prints[a] ^ prints[rows]).view(np.uint64)) <= max_bits)
        if near.any():
            for x, y in zip(a[near].tolist(), rows[near].tolist(), strict=True):
                p, q = root(x), root(y)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    found.append((x, y))
            while not np.array_equal(up := parent[parent], parent):
                parent = up
        home += 1


def _links(max_bits: int):
    def of_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of each bucket of a sorted partition; the last bucket of a batch waits for the next batch."""
        held = np.empty(0, np.int64), np.empty(0, np.int64)

        def linked(bucket, prints):
            pairs = links_within(bucket, prints, max_bits)
            return pa.record_batch([pa.array(prints[pairs[:, 0]]), pa.array(prints[pairs[:, 1]])], names=["a", "b"])

        for batch in batches:
            bucket = np.concatenate([held[0], batch.column(0).to_numpy()])
            prints = np.concatenate([held[1], batch.column(1).to_numpy()])
            if not len(bucket):
                continue
            whole = int(np.searchsorted(bucket >> 1, bucket[-1] >> 1))
            yield linked(bucket[:whole], prints[:whole])
            held = bucket[whole:], prints[whole:]
        yield linked(*held)

    return of_sorted


def links(prints: DataFrame, max_bits: int, most_rows: int = MOST_ROWS) -> DataFrame:
    """(a, b): enough links between distinct fingerprints (print) to connect all that differ in ``max_bits`` or fewer."""
    if not 0 <= max_bits <= golay.MAX_BITS:
        raise ValueError(f"keys are proven for up to {golay.MAX_BITS} bits")
    keys = stage(prints.select("print").mapInArrow(_golay_keys, "key bigint, print bigint"), "golay-keys")
    group = F.shiftright("key", 1)
    large = stage(
        keys.groupBy(group.alias("large")).agg(F.count("*").alias("rows")).where(F.col("rows") > most_rows)
        .select("large", F.ceil(F.col("rows") / (most_rows // 2)).cast("int").alias("blocks")),
        "large-keys",
    )
    block = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    # A pair of blocks is a bucket of its own; should its hash meet another bucket, more pairs are compared.
    paired = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.shiftleft(
            F.shiftright(F.xxhash64("large", F.least(block, other), F.greatest(block, other)), 1), 1
        ).bitwiseOR(F.col("key").bitwiseAND(F.lit(1).cast("bigint"))),
    )
    dealt = keys.join(large, group == F.col("large"), "left").select(
        F.explode(F.when(F.col("blocks").isNull(), F.array("key")).otherwise(paired)).alias("bucket"), "print"
    )
    shuffled = dealt.repartition(F.shiftright("bucket", 1)).sortWithinPartitions("bucket")
    return shuffled.mapInArrow(_links(max_bits), "a bigint, b bigint")


def _placed(docs: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """``docs`` with __row and __print, and (__of, __root, component_id) for each distinct fingerprint."""
    marked = stage(
        docs.drop("fingerprint", "component_id")
        .withColumn("__print", fingerprint_column(F.col("text"), shingle))
        .withColumn("__row", F.monotonically_increasing_id()),
        "fingerprints",
    )
    prints = stage(
        marked.groupBy(F.col("__print").alias("print")).agg(F.min("doc_id").alias("first_id")), "prints"
    )
    rooted = stage(components(links(prints, max_bits)), "roots")
    smallest = stage(
        rooted.join(prints, F.col("node") == F.col("print"))
        .groupBy("root").agg(F.min("first_id").alias("component_id")),
        "smallest",
    )
    linked = stage(rooted.join(smallest, "root"), "linked")
    placed = stage(
        prints.join(linked, F.col("print") == F.col("node"), "left").select(
            F.col("print").alias("__of"),
            F.coalesce("root", "print").alias("__root"),
            F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"),
        ),
        "placed",
    )
    return marked, placed


@own_columns_apart
def cluster(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = golay.MAX_BITS) -> DataFrame:
    """``docs`` with fingerprint (16 hex digits) and component_id (smallest ``doc_id`` it is linked to)."""
    marked, placed = _placed(docs, shingle, max_bits)
    return (
        marked.join(placed, F.col("__print") == F.col("__of"))
        .withColumn("fingerprint", F.lower(F.lpad(F.hex("__print"), 16, "0")))
        .drop("__row", "__print", "__of", "__root")
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = golay.MAX_BITS) -> DataFrame:
    """``docs`` as given, with one document of each component: that with the smallest ``doc_id``.

    Only the numbers of rows are joined and grouped; the documents meet the few rows that go.
    """
    marked, placed = _placed(
        docs.select("doc_id", "text", F.struct(*docs.columns).alias("__doc")), shingle, max_bits
    )
    rows = marked.select("__row", "doc_id", "__print").join(placed, F.col("__print") == F.col("__of"))
    kept = stage(
        rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy(F.col("__root").alias("__kept_root")).agg(F.min("__row").alias("__kept")),
        "kept",
    )
    gone = stage(
        rows.join(kept, F.col("__root") == F.col("__kept_root")).where("__row <> __kept").select("__row"), "gone"
    )
    return marked.join(gone, "__row", "left_anti").select("__doc.*")
