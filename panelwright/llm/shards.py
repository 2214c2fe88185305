"""Documents in shards, and questions about hashes that shards put to the whole corpus.

A shard is a few megabytes of documents, picked by hash, so that a hot source or a group of
copies is spread over all shards; their number follows the bytes of the input. A question
goes out as one row per (bucket, shard) that carries arrays of hashes with two numbers each;
every hash is there once per shard, so the most frequent one of the corpus has as many
entries in its bucket as there are shards. Answers come back as rows per shard.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import partitions, text_key

SHARD_BYTES = 4 << 20
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_ODD = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def sharded(docs: DataFrame, size: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """doc_id, text, shard; and the number of shards, that of buckets too."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(partitions(docs.sparkSession), -(-total // size))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_key().alias("_key"))
    return rows.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "_key"), F.lit(n)).cast("int").alias("shard")), n


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n."""
    held = _POWERS.get(base)
    if held is None or len(held[0]) < n:
        size = max(n, 1 << 16)
        up, down = (np.full(size, b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        up[0] = down[0] = 1
        held = _POWERS[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return held[0][:n], held[1][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _ODD) -> np.ndarray:
    """Hash of values[start:end] for every span: a polynomial, from prefix sums, mixed."""
    up, _ = _powers(len(values) + 1, base)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    _, down = _powers(len(values) + 1, base)
    return mix((total[ends] - total[starts]) * down[starts])


def run_hashes(values: np.ndarray, width: int, base: int = _ODD) -> np.ndarray:
    """``span_hashes`` of every run of ``width`` values."""
    n = max(0, len(values) - width + 1)
    up, down = _powers(len(values) + 1, base)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return mix((total[width : width + n] - total[:n]) * down[:n])


def sliding(values: np.ndarray, width: int, least: bool = True) -> np.ndarray:
    """Least (or most) of each run of ``width`` values."""
    pick = np.minimum if least else np.maximum
    n, done = len(values) - width + 1, 1
    if n <= 0:
        return values[:0]
    out = values
    while done * 2 <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return pick(out[: len(out) - rest], out[rest:])[:n] if rest else out[:n]


QUESTION = "bucket int, shard int, h array<bigint>, a array<bigint>, b array<bigint>"
ANSWER = "shard int, h array<bigint>, a array<bigint>"


def question(shard: int, buckets: int, h: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """One row per bucket from a shard's distinct hashes with two numbers each, b not below a.

    b travels as what it has beyond a, mostly nothing.
    """
    b = b - a
    where = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(where, kind="stable")
    cut = np.r_[0, np.cumsum(np.bincount(where, minlength=buckets))].astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x[order].astype(np.int64) if x.dtype != np.uint64 else x[order].view(np.int64))) for x in (h, a, b)]
    full = np.flatnonzero(np.diff(cut))
    table = pa.table({"bucket": pa.array(np.arange(buckets, dtype=np.int32)), "shard": pa.array(np.full(buckets, shard, np.int32)), "h": lists[0], "a": lists[1], "b": lists[2]})
    return table.take(pa.array(full))


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    joined = column.combine_chunks()
    joined = joined if isinstance(joined, pa.Array) else pa.concat_arrays(joined.chunks)
    return np.asarray(joined.flatten()), np.asarray(pc.list_value_length(joined))


def answered(asked: DataFrame, judge: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """To every shard those of its hashes that pass, with a number.

    judge(a, b, heads) sees all entries sorted by hash, the heads of equal hashes, and returns
    for each hash whether it passes and its number.
    """

    def run(table: pa.Table) -> pa.Table:
        h, size = flat(table["h"])
        a = flat(table["a"])[0]
        b = a + flat(table["b"])[0]
        shard = np.repeat(np.asarray(table["shard"]), size)
        order = np.argsort(h, kind="stable")
        sorted_h = h[order]
        heads = np.flatnonzero(np.r_[True, sorted_h[1:] != sorted_h[:-1]])
        passes, number = judge(a[order], b[order], heads)
        each = np.diff(np.r_[heads, len(h)])
        keep = np.repeat(passes, each)
        number = np.repeat(number, each)[keep]
        to, h = shard[order][keep], sorted_h[keep]
        order = np.argsort(to, kind="stable")
        shards, first = np.unique(to[order], return_index=True)
        cut = pa.array(np.r_[first, len(order)].astype(np.int32))
        return pa.table(
            {
                "shard": pa.array(shards.astype(np.int32)),
                "h": pa.ListArray.from_arrays(cut, pa.array(h[order])),
                "a": pa.ListArray.from_arrays(cut, pa.array(number[order].astype(np.int64))),
            }
        )

    return asked.groupBy("bucket").applyInArrow(run, ANSWER)


def answer(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A shard's passing hashes, sorted, with their numbers."""
    if not table.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, a = flat(table["h"])[0].view(np.uint64), flat(table["a"])[0]
    order = np.argsort(h)
    return h[order], a[order]


def look_up(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each hash among the sorted known ones, -1 if it is not there."""
    if not len(known):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, at, -1)
