"""Exact dedup by chunk recipes (operator 3).

A text is lower-cased (A-Z only) and cut where its content says so: a rolling hash over the
last 32 bytes picks the cuts, so equal texts have equal chunks wherever they lie. Chunks are
deduplicated to identifiers (SHA-256), and each identifier is verified: all bytes seen under
it must be the same. A text is then its recipe, the ordered list of identifiers; documents
are compared by recipe alone, so a long text never travels to be compared.

Defined results: a null text counts as empty (the empty recipe). Of equal texts the row with
the largest doc_id stays; null ids come last, and a group of null ids alone keeps them. Rows
that repeat both id and text are one document, marked alike. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import pieces, raw_texts, stage

CUT_BITS = 12  # a cut every 4 KB on average
LONGEST = 1 << 16  # and after 64 KB at the latest
_REACH = 32
_TABLE = np.random.default_rng(32).integers(0, 1 << 32, 256, dtype=np.uint32)


def normalise(text: bytes) -> bytes:
    """Lower case for A-Z; other bytes, those of other letters too, as they are."""
    return text.lower()


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of one normalised text."""
    n = len(data)
    if n <= _REACH:
        return [n] if n else []
    h = _TABLE[np.frombuffer(data, np.uint8)]
    step = 1
    while step < _REACH:  # h[i] becomes the hash of twice as many bytes that end at i
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    found = np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + 1
    ends, last = [], 0
    for end in [*found[found >= _REACH].tolist(), n]:
        while end - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if end > last:
            ends.append(end)
            last = end
    return ends


def _chunks(text: bytes) -> list[bytes]:
    last, out = 0, []
    for end in cuts(text):
        out.append(text[last:end])
        last = end
    return out


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            found = {hashlib.sha256(c).digest(): c for t in raw_texts(part) for c in _chunks(normalise(t))}
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.binary())], ["id", "body"])


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            shas, recipes = [], []
            for t in raw_texts(part):
                t = normalise(t)
                shas.append(hashlib.sha256(t).hexdigest())
                recipes.append(b"".join(hashlib.sha256(c).digest() for c in _chunks(t)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(shas, pa.string()), pa.array(recipes, pa.binary())],
                ["doc_id", "text_sha256", "recipe"],
            )


def verify_chunks(docs: DataFrame) -> None:
    """Raise if two chunks with different bytes share an identifier. One copy of a chunk leaves each task."""
    seen = docs.select("text").mapInArrow(_bodies, "id binary, body binary")
    clash = seen.groupBy("id").agg((F.min("body") != F.max("body")).alias("clash")).where("clash")
    if not clash.isEmpty():
        raise ValueError("two different chunks share an identifier")


def recipes(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256 and the recipe: identifiers of the chunks, 32 bytes each, in order."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_recipes, f"doc_id {kind}, text_sha256 string, recipe binary")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    verify_chunks(docs)
    rows = stage(recipes(docs), "recipes")
    groups = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return rows.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact(docs: DataFrame) -> DataFrame:
    """Docs with one row of each group of equal texts, that with the largest id; columns as they came.

    Rows that repeat id and text differ at most in other columns; the first by those stays.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    sha = F.sha2(F.translate(F.coalesce("text", F.lit("")), upper, lower), 256)
    keep = exact_groups(docs).where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("digest")).distinct()
    rows = docs.select(F.struct("*").alias("row"), "doc_id", sha.alias("sha"))
    rows = rows.join(keep, rows["doc_id"].eqNullSafe(keep["id"]) & (rows["sha"] == keep["digest"]), "left_semi")
    return rows.dropDuplicates(["doc_id", "sha"]).select("row.*")
