"""Ranked lexical search over K2-treaps (operator 13).

The corpus is a grid of terms by documents whose cells hold the impact of a term on a document's score.
Documents are cut into shards of bounded text; a shard's grid is a K2-treap: a square is halved both ways
down to single cells, empty quarters are left out, and every square kept holds the largest impact inside it.
Stored are, level by level, the bits of the quarters that exist and the maxima, as the difference to the
square above. Terms are rows in the order of their frequency, so rare terms share sparse squares.

A search follows one path of squares for each term of an item. All paths of an item descend together over
ranges of documents: the sum of the weighted maxima bounds every document of a range, ranges with the best
bounds are halved first, and those that cannot reach the best ``k`` so far are left. At a single document
the maxima are the impacts, so the bound is the score. What is found is exact.

Numbers of the corpus (documents, terms, documents with a term) are counted over all rows. Shards are rows of
a staged table, read once for each block of items; a block is bounded in items and bytes, and only it
travels to the tasks. From each shard come at most ``k`` rows for each item.

Defined results: a null or empty text has no terms, is not counted and never found. Repeated rows are
documents of their own. Rows without an id are counted and can be found, last among equals. An item without terms, or
none that a document holds, gets no rows; a repeated item id is searched once for each different text, its
ranks then counting each text alone. Empty tables give no rows. Very long texts are taken whole, one of them
may be a shard by itself. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelwright.llm.common import pieces, raw_texts, stage, unstage

#: Digits, letters in lower case and the bytes of all other characters stay, the rest becomes a blank.
_CLASS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SHARD_BYTES = 12 << 20  # of text; one text may be longer
BLOCK_ITEMS, BLOCK_BYTES = 512, 4 << 20
TOP = 10
SPREAD = 4  # a term has 2 ** SPREAD rows, all but the first empty: squares of so few documents hold no other term
_WAVE = 32  # ranges halved at once


def _squeezed(data: bytes | np.ndarray) -> bytes:
    """With its length in front. Shards travel squeezed: most squares of a level miss nothing to the one above."""
    raw = data if isinstance(data, bytes) else data.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _loose(data: pa.Buffer | bytes) -> pa.Buffer:
    view = memoryview(data)
    return pa.decompress(view[8:], int.from_bytes(view[:8], "little"), codec="zstd")


def terms(text: bytes) -> list[bytes]:
    return text.translate(_CLASS).split()


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass
class Treap:
    """Squares by level: ``bits[l]`` tells which quarters of the squares of level l exist, ``maxima[l]``
    holds their largest impacts; the last level's squares are single cells."""

    bits: list[np.ndarray]
    maxima: list[np.ndarray]

    @staticmethod
    def build(row: np.ndarray, column: np.ndarray, value: np.ndarray) -> Treap:
        """Of different cells with values above 0."""
        height = max(1, int(max(row.max(initial=0), column.max(initial=0))).bit_length())
        place = np.zeros(len(row), np.int64)
        for b in range(height):
            for side, shift in ((row, 2 * b + 1), (column, 2 * b)):
                bit = (side >> b & 1).astype(np.int64)
                bit <<= shift
                place |= bit
        order = np.argsort(place, kind="stable").astype(np.int32)
        place, top = place[order], value[order].astype(np.int32)
        del order
        maxima, bits = [top], []
        for _ in range(height):
            above = place >> 2
            heads = np.flatnonzero(np.r_[True, above[1:] != above[:-1]]) if len(above) else np.zeros(0, np.int64)
            quarter = np.zeros((len(heads), 4), bool)
            quarter[np.cumsum(np.r_[False, above[1:] != above[:-1]]) if len(above) else heads, place & 3] = True
            bits.append(quarter)
            top = np.maximum.reduceat(top, heads) if len(heads) else top
            maxima.append(top)
            place = above[heads]
        return Treap(bits[::-1], maxima[::-1])

    def pack(self) -> tuple[list[bytes], list[bytes]]:
        """Bits as bytes, and each level's maxima as what is missing to the square above, in the least width."""
        stored = [self.maxima[0].astype("<i4")]
        for quarter, above, own in zip(self.bits, self.maxima, self.maxima[1:]):
            less = np.repeat(above, quarter.sum(axis=1)) - own
            stored.append(less.astype("<u1" if less.max(initial=0) < 256 else "<u2" if less.max(initial=0) < 65536 else "<u4"))
        return [_squeezed(np.packbits(q)) for q in self.bits], [_squeezed(x) for x in stored]

    @staticmethod
    def unpack(bits: list[bytes], stored: list[bytes]) -> Treap:
        top = np.frombuffer(_loose(stored[0]), "<i4")
        maxima, quarters = [top], []
        for packed, less in zip(map(_loose, bits), map(_loose, stored[1:])):
            quarter = np.unpackbits(np.frombuffer(packed, np.uint8), count=4 * len(top)).astype(bool).reshape(-1, 4)
            top = _lowered(top, quarter.sum(axis=1), less)
            quarters.append(quarter)
            maxima.append(top)
        return Treap(quarters, maxima)


def _lowered(above: np.ndarray, held: np.ndarray, less: pa.Buffer) -> np.ndarray:
    """Maxima of a level from those above it, the number of squares held there, and what is missing."""
    width = len(less) // max(1, int(held.sum(dtype=np.int64)))
    return np.repeat(above, held) - np.frombuffer(less, f"<u{max(1, width)}").astype(np.int32)


#: By the four bits of a square: the number of its quarters, and of those before each.
_HELD = np.array([b.bit_count() for b in range(16)], np.uint8)
_BEFORE = np.array([[(b >> (4 - q)).bit_count() for q in range(4)] for b in range(16)], np.int32)


class Search:
    """Best documents of one packed shard. A level takes 9 bytes a square: its four bits, the place of its first
    quarter in the next level and its maximum. One more square without quarters and maximum stands for none."""

    def __init__(self, bits: list[bytes], stored: list[bytes]):
        self.height = len(bits)
        top = np.frombuffer(_loose(stored[0]), "<i4")
        self.maxima = [np.r_[top, np.int32(0)]]
        self.four: list[np.ndarray] = []
        self.first: list[np.ndarray] = []
        for packed, less in zip(map(_loose, bits), map(_loose, stored[1:])):
            pairs = np.frombuffer(packed, np.uint8)
            four = np.stack([pairs >> 4, pairs & 15], axis=1).ravel()[: len(top)]
            held = _HELD[four]
            first = np.zeros(len(top) + 1, np.int32)
            np.cumsum(held, out=first[1:])
            top = _lowered(top, held, less)
            self.four.append(np.r_[four, np.uint8(0)])
            self.first.append(first)
            self.maxima.append(np.r_[top, np.int32(0)])

    def below(self, level: int, at: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """Squares of the next level: the given quarters of squares, or the one that stands for none."""
        four = self.four[level][at]
        there = (four >> (3 - quarter)) & 1 == 1
        return np.where(there, self.first[level][at] + _BEFORE[four, quarter], len(self.maxima[level + 1]) - 1)

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, column) of the best k columns with a score above 0; equal scores by column."""
        if not len(rows) or len(self.maxima[0]) < 2:
            return []
        # A range is (-bound, first column, level, square of each row's path).
        heap = [(-int(weights @ self.maxima[0][np.zeros(len(rows), int)]), 0, 0, np.zeros(len(rows), np.int64))]
        found: list[tuple[int, int]] = []  # (score, -column), the worst first
        while heap:
            wave, least = [], (found[0] if len(found) == k else (0, 1))
            while heap and len(wave) < _WAVE:
                bound, first, level, squares = heapq.heappop(heap)
                if (-bound, -first) <= least:
                    heap.clear()  # no better one is left
                    break
                wave.append((first, level, squares))
            for level in sorted({w[1] for w in wave}):
                some = [w for w in wave if w[1] == level]
                shift = self.height - 1 - level
                at = np.stack([w[2] for w in some])
                quarter = 2 * (rows >> shift & 1)
                squares = np.concatenate([self.below(level, at, quarter), self.below(level, at, quarter + 1)])
                bounds = (self.maxima[level + 1][squares] @ weights).tolist()
                firsts = [w[0] for w in some] + [w[0] + (1 << shift) for w in some]
                for j, one in enumerate(zip(bounds, (-f for f in firsts))):
                    if not one[0] or len(found) == k and one <= found[0]:
                        continue
                    if shift:
                        heapq.heappush(heap, (-one[0], firsts[j], level + 1, squares[j]))
                    elif len(found) < k:
                        heapq.heappush(found, one)
                    else:
                        heapq.heapreplace(found, one)
        return [(s, -c) for s, c in sorted(found, key=lambda x: (-x[0], -x[1]))]


class _Shard:
    """Documents taken in one after another, given out as one row."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.found: dict[bytes, int] = {}
        self.rows: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []
        self.bytes = 0

    def add(self, id: pa.Array, text: bytes) -> None:
        self.bytes += len(text)
        counts = Counter(terms(text))
        if counts:
            found = self.found
            self.ids.append(id)
            self.rows.append(np.array([found.setdefault(t, len(found)) for t in counts], np.int32))
            self.tf.append(np.array(list(counts.values()), np.int32))

    def row(self) -> pa.RecordBatch:
        """Ids ascending, null last; terms by falling frequency; of each posting its term's place and count."""
        ids = pa.concat_arrays(self.ids)
        order = pc.sort_indices(ids)
        by_id = order.to_pylist()
        names = np.array(list(self.found), object)
        df = np.bincount(np.concatenate(self.rows), minlength=len(names))
        by = np.lexsort((names, -df))
        place = np.empty(len(by), np.int32)
        place[by] = np.arange(len(by), dtype=np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(order)),
                pa.array([sum(int(t.sum()) for t in self.tf)], pa.int64()),
                pa.array([_squeezed(b" ".join(names[by]))], pa.binary()),  # a term holds no blank
                *(
                    pa.array([_squeezed(x.astype("<i4"))], pa.binary())
                    for x in (
                        df[by],
                        np.array([len(self.rows[i]) for i in by_id]),
                        place[np.concatenate([self.rows[i] for i in by_id])],
                        np.concatenate([self.tf[i] for i in by_id]),
                    )
                ),
            ],
            ["ids", "length", "terms", "df", "per", "rows", "tf"],
        )


def _numbers(squeezed: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(_loose(squeezed.as_buffer()), "<i4")


def _names(squeezed: pa.BinaryScalar) -> pa.Array:
    return pa.array(_loose(squeezed.as_buffer()).to_pybytes().split(b" "), pa.binary())


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = _Shard()
    for batch in batches:
        for part in pieces(batch):
            for i, text in enumerate(raw_texts(part)):
                if shard.bytes and shard.bytes + len(text) > SHARD_BYTES:
                    if shard.ids:
                        yield shard.row()
                    shard = _Shard()
                shard.add(part.column("doc_id").slice(i, 1), text)
    if shard.ids:
        yield shard.row()


def _treaps(documents: int, length: int):
    """Postings of shards to treaps; an impact needs the numbers of the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                per, rows, tf = (_numbers(batch.column(c)[i]) for c in ("per", "rows", "tf"))
                heads = np.r_[0, np.cumsum(per)[:-1]]
                m = 10 + 90 * np.add.reduceat(tf, heads, dtype=np.int64) * documents // length
                value = impact(tf.astype(np.int64), np.repeat(m, per)).astype(np.int32)
                bits, maxima = Treap.build(rows << SPREAD, np.repeat(np.arange(len(per), dtype=np.int32), per), value).pack()
                del value
                kept = [batch.column(c).slice(i, 1) for c in ("ids", "terms", "df")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([bits], pa.list_(pa.binary())), pa.array([maxima], pa.list_(pa.binary()))],
                    ["ids", "terms", "df", "bits", "maxima"],
                )

    return run


@dataclass
class Index:
    """Shards (ids, terms, df, bits, maxima) and the number of documents with a term."""

    shards: DataFrame
    documents: int
    kind: str  # of the ids


def build_index(docs: DataFrame) -> Index:
    """Of every row and whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    postings = stage(
        texts.mapInArrow(
            _shards,
            f"ids array<{kind}>, length long, terms binary, df binary, per binary, rows binary, tf binary",
        ),
        "postings",
    )
    documents, length = postings.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    made = postings.mapInArrow(
        _treaps(documents, length), f"ids array<{kind}>, terms binary, df binary, bits array<binary>, maxima array<binary>"
    )
    shards = stage(made, "treaps")
    unstage(postings)
    return Index(shards, documents, kind)


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items with their different terms, so many at a time as the bounds allow; one item may exceed the bytes."""
    block, held = [], 0
    for id, text in items.select("item_id", "text").distinct().toLocalIterator():
        own = sorted(set(terms((text or "").encode())))
        size = sum(map(len, own))
        if block and (len(block) == BLOCK_ITEMS or held + size > BLOCK_BYTES):
            yield block
            block, held = [], 0
        block.append((id, own))
        held += size
    if block:
        yield block


def _frequencies(names: pa.Array):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names), np.int64)
        for batch in batches:
            for own, df in zip(batch.column("terms"), batch.column("df")):
                at = pc.index_in(names, value_set=_names(own))
                some = np.flatnonzero(np.asarray(at.is_valid()))
                total[some] += _numbers(df)[np.asarray(at.drop_null())]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["term", "df"])

    return run


def _descend(names: pa.Array, weights: np.ndarray, items: list[np.ndarray], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = pc.index_in(names, value_set=_names(batch.column("terms")[i]))
                row = np.asarray(at.fill_null(-1), np.int64) << SPREAD
                search = Search(*([b.as_buffer() for b in batch.column(c)[i]] for c in ("bits", "maxima")))
                found = []
                for j, own in enumerate(items):
                    own = own[(row[own] >= 0) & (weights[own] > 0)]
                    found += [(j, s, c) for s, c in search.best(row[own], weights[own], k)]
                if found:
                    item, score, column = zip(*found)
                    ids = batch.column("ids")[i].values.take(pa.array(column, pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(score, pa.int64()), ids], ["item", "score", "doc_id"])

    return run


def search(index: Index, items: DataFrame, k: int = TOP) -> DataFrame:
    """The k best documents of each item: item_id, rank, doc_id, score."""
    spark, kind = items.sparkSession, items.schema["item_id"].dataType.simpleString()
    results = []
    for block in _blocks(items):
        names = sorted({t for _, own in block for t in own})
        place = {t: i for i, t in enumerate(names)}
        array = pa.array(names, pa.binary())
        counted = index.shards.select("terms", "df").mapInArrow(_frequencies(array), "term int, df long")
        weights = np.zeros(len(names), np.int64)
        for term, df in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
            weights[term] = weight(index.documents, df)
        rows = [np.array([place[t] for t in own], np.int64) for _, own in block]
        found = index.shards.select("ids", "terms", "bits", "maxima").mapInArrow(
            _descend(array, weights, rows, k), f"item int, score long, doc_id {index.kind}"
        )
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        named = spark.createDataFrame([Row(item=i, item_id=id) for i, (id, _) in enumerate(block)], f"item int, item_id {kind}")
        results.append(stage(ranked.join(named, "item").select("item_id", "rank", "doc_id", "score"), "found", False))
    if not results:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {index.kind}, score long")
    return reduce(DataFrame.unionByName, results)


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """Index docs, search all items, drop the index."""
    index = build_index(docs)
    found = search(index, items, k)
    unstage(index.shards)
    return found
