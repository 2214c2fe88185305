"""SimHash near-dedup by tiled exact comparison (operator 4).

Fingerprints: words of a lower-cased text (A-Z only) in 4-word shingles, repeats included;
a bit is set if it is set in over half of the shingles' XXH64 (seed 42). Distinct
fingerprints are dealt into tiles by population count (and, where a count has many, into
slices by hash). Two numbers that differ in at most ``radius`` bits have population counts at
most ``radius`` apart, so only such tiles meet. Inside a pair of tiles the same bound is used
on the four 16-bit parts: blocks of fingerprints are skipped if the counts of their parts
lie too far apart. What is left is compared exactly, by exclusive-or and bit count. A pair of
tiles reports a spanning forest of its links, never all pairs of a group.

Defined results: null or wordless text has fingerprint zero, which links like any other.
Copies share a fingerprint and are one node. component_id is the smallest non-null doc_id
that can be reached; it is null only where all ids are. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import Forest, components, partitions, pieces, raw_texts, stage, unstage

RADIUS = 4
SHINGLE = 4
TILE = 1 << 14  # fingerprints of a tile, on average at most
BLOCK = 128
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LANES = np.uint64(0x0101010101010101)


def _bits(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Majority bits of each run hashes[start:end]; zero for an empty run."""
    # eight byte-wide counters ride in one word; runs are cut so that none overflows
    out = np.zeros(len(starts), np.uint64)
    full = np.flatnonzero(ends > starts)
    if not len(full):
        return out
    heads = [np.arange(s, e, 255) for s, e in zip(starts[full].tolist(), ends[full].tolist())]
    owner = np.repeat(np.arange(len(full)), [len(h) for h in heads])
    at = np.concatenate(heads)
    first = np.r_[0, np.flatnonzero(np.diff(owner)) + 1]
    half = (ends - starts)[full]
    result = np.zeros(len(full), np.uint64)
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, at).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(sums.astype(np.int64), first, axis=0)
        for lane in range(8):
            bit = np.uint64(8 * lane + k)
            result |= (2 * counts[:, lane] > half).astype(np.uint64) << bit
    out[full] = result
    return out


def fingerprint_texts(texts: list[bytes]) -> np.ndarray:
    hashes, ends, digest = [], [], xxhash.xxh64_intdigest
    for text in texts:
        words = _WORD.findall(text.lower())
        if words:
            line = b" ".join(words)
            size = np.fromiter(map(len, words), np.int64, len(words)) + 1
            end = np.cumsum(size) - 1
            start = (end - size + 1).tolist()
            stop = end[SHINGLE - 1 :].tolist() or [len(line)]
            hashes += [digest(line[a:b], 42) for a, b in zip(start, stop)]
        ends.append(len(hashes))
    ends = np.array(ends, np.int64)
    return _bits(np.array(hashes, np.uint64), np.r_[0, ends[:-1]], ends)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            found = fingerprint_texts(raw_texts(part)).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, f"doc_id {kind}, fp bigint")


def _parts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Values sorted by the counts of their parts; their order; least and most counts by block."""
    counts = np.bitwise_count(values.view(np.uint16).reshape(-1, 4)).astype(np.int16)
    order = np.lexsort(counts.T[::-1])
    heads = np.arange(0, len(values), BLOCK)
    counts = counts[order]
    return values[order], order, np.minimum.reduceat(counts, heads), np.maximum.reduceat(counts, heads)


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between and, if a is b, within two tiles: pairs of values."""
    left, _, low_a, high_a = _parts(a)
    right, _, low_b, high_b = _parts(b)
    forest = Forest(len(left) + len(right))
    for k in range(len(low_a)):
        gap = np.maximum(0, np.maximum(low_b - high_a[k], low_a[k] - high_b)).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        if not len(near):
            continue
        cols = (near[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        cols = cols[cols < len(right)]
        block = left[k * BLOCK : (k + 1) * BLOCK]
        i, j = np.nonzero(np.bitwise_count(block[:, None] ^ right[cols][None, :]) <= radius)
        forest.link(i + k * BLOCK, cols[j] + len(left))
    i, j = forest.edges()
    both = np.concatenate([left, right])
    return both[i], both[j]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = (np.array(batch.column(c)[row].values, np.int64).view(np.uint64) for c in ("a", "b"))
                x, y = tile_links(a, b, radius)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

    return run


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between fingerprints of column fp that connect all within the radius."""
    spark = distinct.sparkSession
    counted = distinct.select("fp", F.bit_count("fp").alias("p"))
    slices = {r["p"]: -(-r["n"] // tile) for r in counted.groupBy("p").agg(F.count("*").alias("n")).collect()}  # 65 rows at most
    if not slices:
        return spark.createDataFrame([], "a bigint, b bigint")
    wide = F.create_map(*[F.lit(x) for item in slices.items() for x in item])
    tiles = (
        counted.withColumn("s", F.pmod(F.xxhash64("fp"), wide[F.col("p")]))
        .groupBy("p", "s")
        .agg(F.collect_list("fp").alias("a"))
    )
    tiles = stage(tiles, "tiles")
    left = tiles.select("a", "s", F.col("p"), F.explode(F.sequence("p", F.col("p") + radius)).alias("q"))
    right = tiles.select(F.col("a").alias("b"), F.col("s").alias("t"), F.col("p").alias("q"))
    pairs = left.join(right, "q").where((F.col("p") < F.col("q")) | (F.col("s") <= F.col("t")))
    pairs = pairs.repartition(partitions(spark), "p", "q", "s", "t").select("a", "b")
    return pairs.mapInArrow(_compare(radius), "a bigint, b bigint")


def near_components(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row per row of docs: doc_id, fp, component_id."""
    rows = stage(fingerprints(docs), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(fingerprint_links(distinct, radius, tile))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(rooted.join(groups, "root").select("fp", "component_id"), "named")
    unstage(distinct)
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Docs with one document of each component, that with the smallest id; columns as they came.

    Rows without an id stay: they can't be told to be the one document that is kept.
    """
    found = near_components(docs, radius)
    drop = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_drop")).distinct()
    return docs.join(drop, docs["doc_id"] == drop["_drop"], "left_anti")
