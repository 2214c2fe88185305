"""Toxicity by a factorization machine over hashed terms (operator 11).

A text is the set of its terms: words in lower case and their first 3 to 6 letters, hashed.
The score is a sigmoid of

    bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,    x_i = 1 + log(times term i occurs)

The inner products of the terms' factors are what additive weights miss: an insult and the mention
of a group may each be harmless alone. The pair sum costs as much as the plain one, as it is
half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2 over the factors.

Fitting sees at most ``sample`` labelled rows of each class, the first by hash of the id, and the
``TERMS`` terms whose shares in toxic and other texts differ most, by ``TELLING`` standard errors at
least. Both counts come from the tasks; the driver gets only these terms of the sampled texts.
Everything else runs over all rows and whole texts: a task keeps what it knows of the words it has met.

Defined results: a null or empty text has no terms and gets the score of the bias, as has a text of
unknown terms. Labels are taken only where crc32 of the id as text leaves 0 or 2 when divided by 3; a
null label or id is not learned from, several labels of one document count as several, and every row
of a repeated id carries that id's labels. A null id is not held out. Without labelled rows of both
classes all scores are 0. An empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import pieces, raw_texts

WIDTH = 1 << 22  # hashed terms
SAMPLE = 10_000  # labelled rows of each class used to fit
TERMS = 4_096  # terms that get weights
TELLING = 4.0
FACTORS = 8
TOXIC = 0.7  # score from which a text is predicted toxic
_STEMS = (3, 4, 5, 6)
_CACHE = 300_000
#: ASCII but for letters becomes a blank; bytes of other letters stay.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def held_out(id: Column) -> Column:
    """True where labels are not learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id.cast("string")) % 3 == 1, F.lit(False))


def words(batch: pa.RecordBatch) -> Iterator[Counter]:
    """How often each word occurs, text by text."""
    lower = pa.RecordBatch.from_arrays([pc.utf8_lower(batch.column("text"))], ["text"])
    for text in raw_texts(lower):
        yield Counter(text.translate(_LETTERS).split())


def terms(word: bytes) -> list[int]:
    """Places of a word and of its stems; a stem is told from a word that reads the same."""
    letters = word.decode("utf-8", "replace")
    stems = [letters[:k].encode() for k in _STEMS if len(letters) > k]
    return [crc32(word) % WIDTH, *(crc32(b"*" + s) % WIDTH for s in stems)]


@dataclass
class Machine:
    """Weights and factors of the terms ``known`` (sorted places)."""

    bias: float
    known: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, at: np.ndarray, value: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of texts given one after another as positions in ``known`` and values."""
        total = np.zeros(len(sizes)) + self.bias
        some = np.flatnonzero(sizes)
        if len(some):
            heads = np.r_[0, np.cumsum(sizes[some])[:-1]]
            each = self.factors[at] * value[:, None]
            pairs = np.add.reduceat(each, heads) ** 2 - np.add.reduceat(each**2, heads)
            total[some] += np.add.reduceat(self.weights[at] * value, heads) + pairs.sum(axis=1) / 2
        return total


class Rows:
    """Texts as positions in ``known`` and values; remembers the words it has met."""

    def __init__(self, known: np.ndarray):
        self.place = {k: i for i, k in enumerate(known.tolist())}
        self.seen: dict[bytes, tuple[int, ...]] = {}

    def of(self, counts: Counter) -> tuple[list[int], list[float]]:
        if len(self.seen) > _CACHE:
            self.seen = {}
        found: dict[int, int] = {}
        for word, n in counts.items():
            at = self.seen.get(word)
            if at is None:
                at = self.seen[word] = tuple(self.place[t] for t in terms(word) if t in self.place)
            for i in at:
                found[i] = found.get(i, 0) + n
        order = sorted(found)
        return order, [found[i] for i in order]


def _gather(rows: list[tuple[list[int], list[float]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.array([i for r, _ in rows for i in r], np.int64)
    times = np.array([v for _, r in rows for v in r], np.float64)
    return at, 1 + np.log(np.maximum(times, 1)), np.array([len(r) for r, _ in rows], np.int64)


def fit(
    known: np.ndarray, rows: list[tuple[list[int], list[float]]], toxic: np.ndarray, passes: int = 40, decay: float = 1e-4, seed: int = 11
) -> Machine:
    """Minibatch Adam on the logistic loss; classes weigh alike. Rows are taken in the order given."""
    rng = np.random.default_rng(seed)
    machine = Machine(0.0, known, np.zeros(len(known)), rng.normal(0, 0.05, (len(known), FACTORS)))
    n1 = int(toxic.sum())
    if not len(known) or not n1 or n1 == len(toxic):
        machine.bias = -np.inf
        return machine
    balance = np.where(toxic, len(toxic) / (2 * n1), len(toxic) / (2 * (len(toxic) - n1)))
    at, value, sizes = _gather(rows)
    ends = np.cumsum(sizes)
    state = {k: [np.zeros_like(x), np.zeros_like(x)] for k, x in (("b", np.zeros(1)), ("w", machine.weights), ("v", machine.factors))}
    bias, step = np.zeros(1), 0
    for p in range(passes):
        rate = 0.03 * (1 - p / passes) + 0.002
        order = rng.permutation(len(rows))
        for k in range(0, len(order), 256):
            some = order[k : k + 256]
            size = sizes[some]
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(ends[some] - size, size)
            i, x = at[inside], value[inside]
            machine.bias = bias[0]
            gap = balance[some] * (1 / (1 + np.exp(-np.clip(machine.logits(i, x, size), -40, 40))) - toxic[some])
            owner = np.repeat(np.arange(len(some)), size)
            each = machine.factors[i] * x[:, None]
            sums = np.zeros((len(some), FACTORS))
            np.add.at(sums, owner, each)
            slope = gap[owner] / len(some)
            gw, gv = decay * machine.weights, decay * machine.factors
            np.add.at(gw, i, slope * x)
            np.add.at(gv, i, (slope * x)[:, None] * (sums[owner] - each))
            step += 1
            a, b = 1 - 0.9**step, 1 - 0.999**step
            for param, g, (m, v) in ((bias, np.array([gap.mean()]), state["b"]), (machine.weights, gw, state["w"]), (machine.factors, gv, state["v"])):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                param -= rate * (m / a) / (np.sqrt(v / b) + 1e-8)
    machine.bias = float(bias[0])
    return machine


def _chosen(batch: pa.RecordBatch, ids: pa.Array, labels: list[list[int]]) -> Iterator[tuple[list[int], Counter]]:
    """Labels and words of the rows whose id was sampled."""
    found = pc.index_in(batch.column("doc_id"), value_set=ids)
    batch, found = batch.filter(found.is_valid()), found.drop_null().to_pylist()
    done = 0
    for part in pieces(batch) if batch.num_rows else ():
        for i, counts in zip(found[done:], words(part)):
            yield labels[i], counts
        done += part.num_rows


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fit on the sample of labelled rows; terms are counted and texts made into rows on the executors."""
    rated = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    rated = rated.select("doc_id", (F.col("toxic") == 1).cast("int").alias("y"))
    drawn = [rated.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect() for y in (0, 1)]
    of: dict[object, list[int]] = {}
    for id, y in sorted((r for part in drawn for r in part), key=lambda r: (r.y, r.doc_id)):
        of.setdefault(id, []).append(y)
    empty = np.zeros(0, np.int64)
    if not drawn[0] or not drawn[1]:
        return fit(empty, [], empty)
    ids, kinds = pa.array(list(of)), list(of.values())
    texts = docs.select("doc_id", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}
        n1, n0, most1, most0 = Counter(), Counter(), 0, 0
        for batch in batches:
            for ys, counts in _chosen(batch, ids, kinds):
                present: set[int] = set()
                for word in counts:
                    if word not in seen:
                        seen[word] = terms(word)
                    present.update(seen[word])
                ones, noes = sum(ys), len(ys) - sum(ys)
                most1, most0 = most1 + ones, most0 + noes
                for n, k in ((n1, ones), (n0, noes)):
                    for t in present if k else ():
                        n[t] += k
        found = sorted(n1.keys() | n0.keys())
        rows = [(-1, most1, most0), *((t, n1[t], n0[t]) for t in found)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["term", "n1", "n0"])

    summed = texts.mapInArrow(count, "term long, n1 long, n0 long").groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    m1, m0 = len(drawn[1]), len(drawn[0])
    share = (F.col("n1") + F.col("n0")) / F.lit(m1 + m0)
    error = F.sqrt(share * (1 - share) * (1 / m1 + 1 / m0))
    gap = F.abs(F.col("n1") / m1 - F.col("n0") / m0)
    telling = summed.where("term >= 0").select("term", (gap / error).alias("z")).where(F.col("z") >= TELLING)
    known = np.array(sorted(r.term for r in telling.orderBy(F.desc("z"), "term").limit(TERMS).collect()), np.int64)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Rows(known)
        for batch in batches:
            out = [(y, *make.of(counts)) for ys, counts in _chosen(batch, ids, kinds) for y in ys]
            y, at, times = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(y, pa.int32()), pa.array(at, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))], ["y", "at", "times"]
            )

    # An id that rows repeat, and texts without any of the terms, count once for each different row of terms.
    got = texts.mapInArrow(featurise, "y int, at array<int>, times array<int>").groupBy("y", "at", "times").agg(F.count("*").alias("n"))
    rows = sorted((r.y, r["at"], r["times"], r.n) for r in got.toLocalIterator())
    repeated = [(at, times, y) for y, at, times, n in rows for _ in range(min(n, sample))]
    return fit(known, [(at, times) for at, times, _ in repeated], np.array([y for *_, y in repeated], np.int64))


def scores(docs: DataFrame, machine: Machine, toxic: float = TOXIC) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Rows(machine.known)
        for batch in batches:
            for part in pieces(batch):
                logits = machine.logits(*_gather([make.of(c) for c in words(part)]))
                score = 1 / (1 + np.exp(-np.clip(logits, -700, 700)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(score), pa.array((score >= toxic).astype(np.int32))], [*part.schema.names[:-1], "score", "predicted"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def rate_toxicity(docs: DataFrame, labels: DataFrame, toxic: float = TOXIC) -> DataFrame:
    return scores(docs, train(docs, labels), toxic)
