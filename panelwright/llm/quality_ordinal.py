"""Quality classifier: ordinal cumulative-link regression (operator 2).

Ratings are grades in order: 0 toxic, 1 poor, 2 good. One weight per hashed
feature is shared by all grades, and ordered thresholds cut the score:
P(grade <= k) = sigmoid(threshold_k - score). From it come the expected grade and the tail
probability P(grade >= 2), by which documents are selected.

Features of a text: its words, hashed, those no more frequent on one side of
a grade than chance would have it left out, weighted by idf and log(1 + count); shapes of words (case, signs, digits), as shares; how much it repeats itself,
and its length in steps. Each group is scaled on its own so that a single telling word still
counts in a long text.

The model is fitted on a bounded sample of labelled rows (``SAMPLE`` rows at most, the first
by hash of the id); everything else runs over all rows. Each document is scored whole.

Defined results: rows without a label, or with a null quality, don't train; null toxic counts
as not toxic. Several labels of one document count as several. A null or empty text has no
features but its length step and is scored like any other. Without labelled rows all scores
are alike and every document is kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import pieces, raw_texts

GRADES = 3
WIDTH = 1 << 17
SAMPLE = 8_000  # labelled rows used to fit
SAMPLE_BYTES = 40_000  # a labelled text may have; longer ones are passed over in fitting only
COMMON = 0.004  # share of the labelled texts that a feature must be in
TELLING = 4.0  # standard errors between its shares above and below a grade
KEEP = 0.2  # tail probability from which a document is kept
_SHAPE_AT, _STEP_AT = 0, 4096  # shapes and steps have their own ranges; words come after
_CACHE = 300_000
_ROWS_AT_ONCE = 256


def _shape(word: bytes) -> int:
    """A class of words: letters' case, digits and signs, runs collapsed."""
    out, last = [], b""
    for c in word[:24]:
        k = b"a" if 97 <= c <= 122 or c >= 128 else b"A" if 65 <= c <= 90 else b"0" if 48 <= c <= 57 else bytes([c])
        if k != last:
            out.append(k)
            last = k
    return _SHAPE_AT + crc32(b"".join(out[:6])) % (_STEP_AT - 1)


def _places(word: bytes) -> tuple[int, int]:
    bare = word.strip(b".,;:!?\"'()").lower()
    return 8192 + crc32(bare) % (WIDTH - 8192), _shape(word)


class Features:
    """Sparse rows (index, value) of texts; remembers the places of words it has seen."""

    def __init__(self) -> None:
        self.seen: dict[bytes, tuple[int, int]] = {}

    def row(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        counts = Counter(text.split())
        if len(self.seen) > _CACHE:
            self.seen = {}
        seen = self.seen
        for w in counts:
            if w not in seen:
                seen[w] = _places(w)
        n = sum(counts.values())
        tf = np.fromiter(counts.values(), np.float64, len(counts))
        at = np.array([seen[w] for w in counts], np.int64).reshape(-1, 2)
        lines = text.split(b"\n")
        steps = [
            (0, min(15, n.bit_length())),
            (1, int(10 * len(counts) / n) if n else 0),
            (2, int(10 * (1 - len(set(lines)) / len(lines)))),
            (3, min(10, int(10 * tf.max() / n)) if n else 0),
        ]
        steps = np.array([_STEP_AT + 32 * a + b for a, b in steps], np.int64)
        index = np.concatenate([at[:, 0], at[:, 1], steps])
        value = np.concatenate([np.log1p(tf), 3 * tf / max(n, 1), np.full(len(steps), 0.5)])
        return index, value


@dataclass
class Model:
    weights: np.ndarray  # idf is folded in
    thresholds: np.ndarray

    def score(self, index: np.ndarray, value: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = np.r_[0.0, np.cumsum(self.weights[index] * value)]
        return total[ends] - total[np.r_[0, ends[:-1]]]

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, passes: int = 30, decay: float = 2e-4) -> Model:
    """Minibatch Adam on the cumulative-link likelihood; thresholds stay in order by their gaps."""
    if not len(grades):
        return Model(np.zeros(WIDTH), np.array([-1.0, 0.0]))
    df = np.bincount(np.concatenate([np.unique(i) for i, _ in rows]), minlength=WIDTH)
    idf = np.where(df >= max(3, COMMON * len(rows)), np.log((1 + len(rows)) / (1 + df)) + 0.3, 0.0)
    idf[:8192] = 1.0
    # leave out words that are no more telling than chance: the same share of texts on either side of a grade
    telling = np.zeros(WIDTH, bool)
    for k in range(1, GRADES):
        above = grades >= k
        n1, n0 = max(1, above.sum()), max(1, (~above).sum())
        hits = np.bincount(np.concatenate([np.unique(i) for (i, _), a in zip(rows, above) if a] or [np.zeros(0, int)]), minlength=WIDTH)
        share = df / len(rows)
        spread = np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0)) + 1e-12
        telling |= np.abs(hits / n1 - (df - hits) / n0) / spread >= TELLING
    idf[8192:] *= telling[8192:]
    w, m, v = np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(WIDTH)
    share = np.clip(np.cumsum(np.bincount(grades, minlength=GRADES)) / len(grades), 0.02, 0.98)
    first = np.log(share[0] / (1 - share[0]))
    t = np.array([first, np.log(max(0.1, np.log(share[1] / (1 - share[1])) - first))])
    tm, tv = np.zeros(2), np.zeros(2)
    rng, step = np.random.default_rng(2), 0
    balance = len(grades) / (GRADES * np.maximum(1, np.bincount(grades, minlength=GRADES)))
    balance = np.sqrt(balance)
    for p in range(passes):
        rate = 0.02 * (1 - p / passes) + 0.001
        order = rng.permutation(len(rows))
        for k in range(0, len(order), 128):
            some = order[k : k + 128]
            index = np.concatenate([rows[i][0] for i in some])
            value = np.concatenate([rows[i][1] for i in some]) * idf[index]
            size = np.array([len(rows[i][0]) for i in some])
            heads = np.r_[0, np.cumsum(size)[:-1]]
            f = np.add.reduceat(w[index] * value, heads)
            cut = np.array([t[0], t[0] + np.exp(t[1])])
            c = 1 / (1 + np.exp(np.clip(f[:, None] - cut[None, :], -40, 40)))  # P(y <= k)
            c = np.c_[np.zeros(len(f)), c, np.ones(len(f))]
            slope = c * (1 - c)
            y, each = grades[some], np.arange(len(some))
            prob = np.maximum(c[each, y + 1] - c[each, y], 1e-9)
            gf = balance[y] * (slope[each, y + 1] - slope[each, y]) / prob  # of the loss by the score
            gc = np.zeros((len(f), 4))
            gc[each, y + 1] -= balance[y] * slope[each, y + 1] / prob
            gc[each, y] += balance[y] * slope[each, y] / prob
            gc = gc[:, 1:3].mean(axis=0)
            gt = np.array([gc.sum(), gc[1] * np.exp(t[1])])
            g = np.bincount(index, weights=value * np.repeat(gf, size), minlength=WIDTH) / len(some) + decay * w
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            tm, tv = 0.9 * tm + 0.1 * gt, 0.999 * tv + 0.001 * gt * gt
            a, b = 1 - 0.9**step, 1 - 0.999**step
            w -= rate * (m / a) / (np.sqrt(v / b) + 1e-6)
            t -= rate * (tm / a) / (np.sqrt(tv / b) + 1e-8)
    return Model((w * idf).astype(np.float32), np.array([t[0], t[0] + np.exp(t[1])]))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    make = Features()
    for batch in batches:
        rows = [make.row(t) for t in raw_texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("grade"), pa.array([i for i, _ in rows], pa.list_(pa.int32())), pa.array([v for _, v in rows], pa.list_(pa.float32()))],
            ["grade", "index", "value"],
        )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the sample of labelled rows; features are made on the executors."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    rated = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", grade.alias("grade"))
    rated = rated.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)
    chosen = docs.select("doc_id", "text").join(rated, "doc_id").where(F.length("text") <= SAMPLE_BYTES)
    got = chosen.select("text", "grade").mapInArrow(_featurise, "grade int, index array<int>, value array<float>").toArrow()
    got = got.combine_chunks()
    grades = np.asarray(got["grade"], np.int64)
    rows = [(np.asarray(i.values), np.asarray(v.values)) for i, v in zip(got["index"], got["value"])]  # views, 8 bytes a feature
    order = np.lexsort((np.array([len(i) for i, _ in rows]), np.array([i.sum() for i, _ in rows], np.int64), grades)) if rows else []
    return fit([rows[k] for k in order], grades[order] if len(grades) else grades)


def _rate(model: Model, keep: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for batch in batches:
            for part in pieces(batch):
                rows = [make.row(t) for t in raw_texts(part)]
                ends = np.cumsum([len(i) for i, _ in rows])
                score = model.score(np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), ends)
                tails = model.tails(score)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(score), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= keep)],
                    [*part.schema.names[:-1], "score", "expected_grade", "tail", "kept"],
                )

    return run


def rate(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """One row per row of docs: doc_id, score, expected_grade, tail (P of the best grade), kept."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _rate(model, keep), f"doc_id {kind}, score double, expected_grade double, tail double, kept boolean"
    )


def select_quality(docs: DataFrame, labels: DataFrame, keep: float = KEEP, fit_on: DataFrame | None = None) -> DataFrame:
    """Docs that the classifier keeps, columns as they came; it is fitted on ``fit_on`` or docs."""
    model = train(docs if fit_on is None else fit_on, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _rate(model, keep)
        for batch in batches:
            for part in pieces(batch):
                alone = part.select(["doc_id", "text"])
                kept = pa.concat_arrays([b.column("kept") for b in judge(iter([alone]))])
                yield part.filter(kept)

    return docs.mapInArrow(run, docs.schema)
