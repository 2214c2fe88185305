"""Embedding near-dedup by an exact metric range join (operator 7).

Within a label, cosine >= t on unit vectors is Euclidean distance <= r = sqrt(2 - 2t). Pivots
(a bounded number of vectors, the first by hash) split the space: a vector's home is the
cell of its nearest pivot. By the triangle inequality a vector within r of a cell's members
lies at most r beyond the plane half way between the pivots, and at most r beyond the
cell's radius; it is replicated to every cell for which both hold. So a vector's partners are
all present in its home cell, and cells join independently. A cell with many vectors is
dealt into slices, and pairs of slices join independently too: no task holds a whole cell.

Identical vectors of a label are one node with a weight, so copies never form pairs. Each
task returns link counts of its home vectors and a spanning forest of its links.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and
rows with a null label, link with nothing (n_links 0, component_id = vec_id, kept). Vectors
of different length don't link. component_id is the smallest non-null vec_id reachable.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import Forest, components, stage

THRESHOLD = 0.98
CELL = 4096  # vectors of a cell that a further pivot is added for
MOST_PIVOTS = 256  # so the pivots sent to every task have a bounded size
SLICE = 2048  # vectors of a slice
_SLACK = 1e-5  # distances near 0 are roots of rounding errors; more slack only adds candidates


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vector as bytes of doubles; null where it can't link."""
    for batch in batches:
        out = []
        for v in batch.column("embedding"):
            x = None if not v.is_valid or v.values.null_count else np.asarray(v.values, np.float64)
            good = x is not None and len(x) and np.isfinite(x).all() and x.any()
            out.append((x + 0.0).tobytes() if good else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary())], ["vec_id", "label", "vec"])


def _unit(vec: bytes) -> np.ndarray:
    x = np.frombuffer(vec, np.float64)
    x = x / np.abs(x).max()
    return x / np.sqrt(x @ x)


def _places(pivots: list[tuple[object, bytes]], radius: float):
    """For each vector its home cell and the cells it borders on, by distance to the pivots."""
    by: dict[tuple[object, int], list[np.ndarray]] = {}
    for label, vec in pivots:
        by.setdefault((label, len(vec)), []).append(_unit(vec))
    known = {k: np.array(v) for k, v in by.items()}
    apart = {k: np.sqrt(np.maximum(0, 2 - 2 * p @ p.T)) for k, p in known.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for label, vec in zip(batch.column("label").to_pylist(), batch.column("vec").to_pylist()):
                p = known.get((label, len(vec)))
                if p is None:
                    rows.append([{"cell": 0, "far": 0.0, "home": True}])
                    continue
                d = np.sqrt(np.maximum(0, 2 - 2 * p @ _unit(vec)))
                home = int(d.argmin())
                # not divided: parallel pivots are a rounding error apart, or nothing
                cells = np.flatnonzero(d * d - d[home] ** 2 <= 2 * (apart[label, len(vec)][home] + _SLACK) * (radius + _SLACK))
                rows.append([{"cell": int(c), "far": float(d[c]), "home": c == home} for c in cells])
            kind = pa.list_(pa.struct([("cell", pa.int32()), ("far", pa.float64()), ("home", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], [*batch.schema.names, "places"])

    return run


def _join(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        ids = np.asarray(table["node"])
        weight = np.asarray(table["weight"])
        x = np.array([np.frombuffer(v, np.float64) for v in table["vec"].to_pylist()])
        scale = np.abs(x).max(axis=1, keepdims=True)
        x = x / scale
        norm = np.sqrt((x * x).sum(axis=1))
        home = np.asarray(table["is_home"])
        h, g = np.flatnonzero(home), np.flatnonzero(~home)
        forest, n = Forest(len(ids)), np.zeros(len(h), np.int64)
        for k in range(0, len(h), 512):
            rows = h[k : k + 512]
            near = (x[rows] @ x[g].T) / (norm[rows][:, None] * norm[g][None, :]) >= threshold
            near &= ids[rows][:, None] != ids[g][None, :]
            n[k : k + 512] = near @ weight[g]
            i, j = np.nonzero(near)
            forest.link(rows[i], g[j])
        i, j = forest.edges()
        return pa.table(
            {
                "a": np.concatenate([ids[h], ids[i]]),
                "b": np.concatenate([ids[h], ids[j]]),
                "links": np.concatenate([n, np.zeros(len(i), np.int64)]),
            }
        )

    return run


def linked_vectors(vectors: DataFrame, threshold: float = THRESHOLD, cell: int = CELL, most: int = MOST_PIVOTS, width: int = SLICE) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept."""
    radius = float(np.sqrt(2 - 2 * threshold))
    id_type, label_type = (vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    rows = stage(
        vectors.select("vec_id", "label", "embedding").mapInArrow(_clean, f"vec_id {id_type}, label {label_type}, vec binary"), "vectors"
    )
    good = rows.where("label IS NOT NULL AND vec IS NOT NULL")
    nodes = good.groupBy("label", "vec").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    wanted = min(most, nodes.count() // cell)
    first = nodes.orderBy(F.xxhash64("label", "vec"), "label", "vec").limit(wanted) if wanted else nodes.limit(0)
    pivots = [(r["label"], bytes(r["vec"])) for r in first.select("label", "vec").collect()]
    placed = nodes.select("node", "weight", "label", "vec").mapInArrow(
        _places(pivots, radius),
        f"node bigint, weight bigint, label {label_type}, vec binary, places array<struct<cell: int, far: double, home: boolean>>",
    )
    placed = stage(placed, "placed").select("node", "weight", "label", F.length("vec").alias("size"), "vec", F.inline("places"))
    key = ["label", "size", "cell"]
    reach = placed.where("home").groupBy(key).agg(F.max("far").alias("reach"))
    placed = placed.join(reach, key).where(F.col("far") <= F.col("reach") + radius + _SLACK)
    cells = placed.groupBy(key).agg(
        F.ceil(F.count_if("home") / width).cast("int").alias("homes"), F.ceil(F.count("*") / width).cast("int").alias("guests")
    )
    dealt = placed.join(cells, key)
    slot = F.xxhash64("node")
    common = [*key, "node", "weight", "vec"]
    home = dealt.where("home").select(
        *common, F.lit(True).alias("is_home"), F.pmod(slot, "homes").alias("i"), F.explode(F.expr("sequence(0L, guests - 1L)")).alias("j")
    )
    guest = dealt.select(
        *common, F.lit(False).alias("is_home"), F.explode(F.expr("sequence(0L, homes - 1L)")).alias("i"), F.pmod(slot, "guests").alias("j")
    )
    found = home.unionByName(guest).groupBy(*key, "i", "j").applyInArrow(_join(threshold), "a bigint, b bigint, links bigint")
    found = stage(found, "found")

    roots = components(found.where("a <> b").select("a", "b"))
    counts = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    rooted = nodes.join(counts, "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        "label", "vec", (F.col("weight") - 1 + F.col("links")).alias("n_links"), "component_id"
    )
    result = rows.join(stage(named, "named"), ["label", "vec"], "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
