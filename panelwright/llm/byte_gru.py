"""Language ID by a bidirectional gated recurrent network over bytes (operator 5).

Two gated recurrent layers of a few units read the bytes of a text, one from the front, one
from the back; at every position both states give log probabilities of the languages. A
document's probabilities pool those of all its positions. The network is trained in numpy by
backpropagation through time on a bounded sample of different texts whose language is known,
shared out evenly among the languages; its size does not grow with the corpus.

A text is read in runs of ``RUN`` bytes, each with fresh states, so that runs of many
documents advance together as one matrix; every byte of every text is read and labelled.
States are kept as (units x runs), so each step is a small matrix product and a few
vectorised functions.

Defined results: a text that is null or has no letter gets ``und`` with score 0. Rows with a
null language don't train. Held-out rows (crc32 of the id as text, modulo 5, is 0) never
train; an id that is null counts as text "null" here. Without any rows to learn from every
text is ``und``. Language, source and id are never inputs. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import pieces, raw_texts, stage, unstage

UNITS = 6  # of each direction
RUN = 64
SAMPLE = 2000  # texts to learn from, at most (but one of each language)
SAMPLE_BYTES = 5 << 18  # and bytes of them, at most
LONGEST = SAMPLE_BYTES // 50  # bytes of one text, at most; longer ones enter with their front
PASSES = 4
UNKNOWN = "und"
_WIDE = 2048  # runs that advance together


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")) % 5 == 0


@dataclass
class Network:
    langs: list[str]
    inputs: np.ndarray  # direction, byte (256: none), gate and unit
    recur: np.ndarray  # direction, gate and unit, unit
    out: np.ndarray  # language, both states
    bias: np.ndarray

    @staticmethod
    def fresh(langs: list[str], units: int = UNITS, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        net = Network(langs, draw(2, 257, 3 * units, scale=0.3), draw(2, 3 * units, units, scale=0.4), draw(len(langs), 2 * units, scale=0.3), np.zeros(len(langs), np.float32))
        return net

    @property
    def params(self) -> list[np.ndarray]:
        return [self.inputs, self.recur, self.out, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _states(net: Network, codes: np.ndarray, way: int, keep: list | None = None) -> np.ndarray:
    """States after each byte: (length, units, runs). codes: (length, runs)."""
    length, wide = codes.shape
    units = net.recur.shape[2]
    table, u = net.inputs[way], net.recur[way]
    gates = u[: 2 * units]
    h = np.zeros((units, wide), np.float32)
    out = np.empty((length, units, wide), np.float32)
    for t in range(length) if way == 0 else range(length - 1, -1, -1):
        x = np.ascontiguousarray(table.take(codes[t], axis=0).T)
        zr = x[: 2 * units]
        zr += gates @ h
        _sigmoid(zr)
        z, r = zr[:units], zr[units:]
        uh = u[2 * units :] @ h
        n = x[2 * units :]
        if keep is None:
            uh *= r
            n += uh
            np.tanh(n, out=n)
            np.subtract(h, n, out=uh)
            uh *= z
            h = np.add(n, uh, out=out[t])
            continue
        n += r * uh
        np.tanh(n, out=n)
        keep.append((t, h, z, r, n, uh))
        h = n + z * (h - n)
        out[t] = h
    return out


def position_logits(net: Network, codes: np.ndarray) -> np.ndarray:
    """(length, languages, runs)"""
    units = net.recur.shape[2]
    both = [_states(net, codes, way) for way in (0, 1)]
    return np.matmul(net.out[:, :units], both[0]) + np.matmul(net.out[:, units:], both[1]) + net.bias[None, :, None]


def log_probs(logits: np.ndarray) -> np.ndarray:
    top = logits.max(axis=1, keepdims=True)
    logits -= top
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def gradients(net: Network, codes: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over real positions, and its gradients by backpropagation through time."""
    units = net.recur.shape[2]
    kept: list[list] = [[], []]
    both = [_states(net, codes, way, kept[way]) for way in (0, 1)]
    states = np.concatenate(both, axis=1)
    lp = log_probs(np.matmul(net.out, states) + net.bias[None, :, None])
    real = codes < 256
    n = max(1, real.sum())
    runs = np.arange(codes.shape[1])
    loss = -(lp[:, target, runs] * real).sum() / n
    d = np.exp(lp)
    d[:, target, runs] -= 1
    d *= (real / n)[:, None, :].astype(np.float32)
    g_in, g_rec = np.zeros_like(net.inputs), np.zeros_like(net.recur)
    g_out = np.einsum("tlr,tur->lu", d, states, optimize=True)
    d_states = np.matmul(net.out.T, d)
    for way in (0, 1):
        dh = np.zeros((units, codes.shape[1]), np.float32)
        u = net.recur[way]
        for t, h, z, r, c, uh in reversed(kept[way]):
            dh = dh + d_states[t, way * units : (way + 1) * units]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * uh * r * (1 - r)
            gates = np.concatenate([dz, dr, dc])
            for k in range(3 * units):
                g_in[way, :, k] += np.bincount(codes[t], weights=gates[k], minlength=257).astype(np.float32)
            back = np.concatenate([dz, dr, dc * r])
            g_rec[way] += back @ h.T
            dh = dh * z + u.T @ back
    return float(loss), [g_in, g_rec, g_out, d.sum(axis=(0, 2))]


def _runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts in runs (length, runs), filled up with code 256, and the text each belongs to."""
    count = np.array([-(-len(t) // RUN) for t in texts], np.int64)
    codes = np.full((int(count.sum()), RUN), 256, np.int64)
    at = 0
    for t, c in zip(texts, count.tolist()):
        if c:
            codes[at : at + c].ravel()[: len(t)] = np.frombuffer(t, np.uint8)
            at += c
    return codes, np.repeat(np.arange(len(texts)), count)


def learn(texts: list[bytes], langs: list[str], passes: int = PASSES) -> Network | None:
    names = sorted(set(langs))
    if not names:
        return None
    net = Network.fresh(names)
    codes, owner = _runs(texts)
    target = np.array([names.index(x) for x in langs], np.int64)[owner]
    rng = np.random.default_rng(5)
    share = np.bincount(target, minlength=len(names)) + 1.0
    m = [np.zeros_like(p) for p in net.params]
    v = [np.zeros_like(p) for p in net.params]
    step, size = 0, 256
    total = passes * -(-len(codes) // size)
    for _ in range(passes):
        order = rng.choice(len(codes), len(codes), p=(1 / share[target]) / (1 / share[target]).sum())  # languages alike often
        for k in range(0, len(order), size):
            some = order[k : k + size]
            _, grads = gradients(net, np.ascontiguousarray(codes[some].T), target[some])
            step += 1
            rate = 0.02 * (1 - step / (total + 1)) + 0.001
            for p, g, a, b in zip(net.params, grads, m, v):
                np.clip(g, -1, 1, out=g)
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def predict(net: Network, texts: list[bytes]) -> np.ndarray:
    """Pooled probabilities (texts x languages)."""
    codes, owner = _runs(texts)
    pooled = np.zeros((len(texts), len(net.langs)))
    for k in range(0, len(codes), _WIDE):
        some = np.ascontiguousarray(codes[k : k + _WIDE].T)
        lp = log_probs(position_logits(net, some))
        if codes[k : k + _WIDE, -1].max() == 256:
            lp *= (some < 256)[:, None, :]
        sums = lp.sum(axis=0)
        for j in range(len(net.langs)):
            pooled[:, j] += np.bincount(owner[k : k + _WIDE], weights=sums[j], minlength=len(texts))
    pooled /= np.maximum(1, np.array([len(t) for t in texts]))[:, None]  # mean over positions
    pooled = np.exp(pooled - pooled.max(axis=1, keepdims=True))
    return pooled / pooled.sum(axis=1, keepdims=True)


def _level(there: list[int], most: int) -> int:
    """The largest share for all of which the sum of min(there, share) stays within most; 1 at least."""
    left, share = most, max(there, default=0)
    for k, n in enumerate(sorted(there)):
        if n * (len(there) - k) > left:
            share = left // (len(there) - k)
            break
        left -= n
    return max(1, share)


def train(docs: DataFrame, rows: int = SAMPLE, size: int = SAMPLE_BYTES, longest: int = LONGEST) -> Network | None:
    """Fit on different texts among those that may train: in each language the first by hash.

    Languages get equal shares of both bounds, and what small ones leave over goes to the
    others, so none is missing. A text counts with its first ``longest`` bytes; the last one
    of a share is cut to what is left of it.
    """
    may = docs.where(~held_out() & F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    front = F.substring(F.col("text").cast("binary"), 1, longest)
    may = may.select("lang", front.alias("front"), F.xxhash64("text").alias("turn"))
    # hashes alone are ranked: a few bytes for each different text, copies are one
    different = stage(may.groupBy("lang", "turn").agg(F.max(F.octet_length("front")).alias("n")), "turns", False)
    there = different.groupBy("lang").agg(F.count("*").alias("rows")).collect()
    of_rows = _level([r["rows"] for r in there], rows)
    by_turn = Window.partitionBy("lang").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    first = different.withColumn("nth", F.row_number().over(by_turn)).where(F.col("nth") <= of_rows)
    picked = first.select("lang", "turn", "n").collect()
    unstage(different)
    whole = Counter()
    for r in picked:
        whole[r["lang"]] += r["n"]
    of_bytes, held, take = _level(list(whole.values()), size), Counter(), {}
    for lang, turn, n in sorted(map(tuple, picked)):
        if held[lang] < of_bytes:
            take[lang, turn] = min(n, of_bytes - held[lang])
            held[lang] += n
    texts, langs = [], []
    if take:
        chosen = may.where(F.col("turn").isin(sorted({turn for _, turn in take}))).groupBy("lang", "turn").agg(F.min("front").alias("front"))
        for lang, turn, data in sorted((r["lang"], r["turn"], bytes(r["front"])) for r in chosen.collect()):
            if (lang, turn) in take:
                texts.append(data[: take[lang, turn]]), langs.append(lang)
    return learn(texts, langs)


def _predict(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, limit=1 << 19):
                texts = raw_texts(part)
                letters = [any(map(str.isalpha, t or "")) for t in part.column("text").to_pylist()]
                lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if net is not None:
                    p = predict(net, texts)
                    best = p.argmax(axis=1)
                    for i, there in enumerate(letters):
                        if there:
                            lang[i], score[i] = net.langs[best[i]], min(1.0, float(p[i, best[i]]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(lang), pa.array(score, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return run


def identify(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score."""
    net = net or train(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(
        _predict(net), f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
