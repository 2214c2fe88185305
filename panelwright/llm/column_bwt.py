"""Suffix-array dedup by column-wise multi-document construction (operator 6).

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else is removed;
strings never cross documents and are judged on the input.

1. Anchors. A window (LENGTH bytes) is represented by the least hash of the ``GRAM``-byte
   strings in it. Equal windows have equal anchors, so only windows whose anchor value occurs
   twice or more in the corpus can recur. About one byte in 85 is an anchor.
2. Segments. A shard cuts its documents into runs of windows of one anchor; those of recurring
   anchors go to the anchor's bucket, equal ones of a shard once with their number. An anchor
   with more than ``HOT`` different segments (a common line in different surroundings) would
   fill one bucket; its windows go out one by one instead, each as two independent 64-bit
   hashes of its LENGTH bytes, to the bucket of the first. Equal windows have equal anchors
   and equal hashes, so they meet all the same, and the group spreads over all buckets.
3. Collections. A bucket builds the Burrows-Wheeler order of its segments column by column:
   in every round each string takes in one more symbol from its right end, and the suffix
   this makes is placed among those present by its symbol and the place of the suffix it
   extends. The common-prefix array is updated by range minima of the round before. Symbols
   are words of SYMBOL bytes, and a segment enters as SYMBOL strings, one for each phase, so a
   suffix begins at every byte and LENGTH bytes are LENGTH / SYMBOL symbols. Any order of
   symbols serves: up to 8 bytes they are ordered by their bytes, longer ones by a 64-bit hash
   (two windows would have to agree but for words that clash). The arrays of a round are
   written front to back into new ones, in sequence; a bucket's bounded size lets them stay in
   memory. Neighbours with a common prefix of LENGTH / SYMBOL symbols are equal windows; a
   class that stands for two places or more recurs. So does a pair of hashes counted twice.
   Before that, segments are cut down to the parts whose words all stand for two places or more,
   as no other part can hold a window that recurs: most segments only share their anchor. The words
   are numbered there, by order of their hashes, and a phase too short for a window is no string.
4. Shards get back which windows of their segments recur, and remove what they cover.

Nothing is capped. Equal segments count once with a weight, so large groups of copies do not
enlarge a bucket; different segments around one anchor share a bucket up to HOT of them.

Defined results: a null text counts as empty. Repeated rows are repeats of one another. Null
ids are ids like any other here. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import stage, unstage
from panelwright.llm.shards import _ODD, QUESTION, answer, answered, flat, look_up, mix, question, run_hashes, sharded, sliding, span_hashes

LENGTH = 200
GRAM = 32
SYMBOL = 40  # a divisor of LENGTH: fewer and wider columns for larger ones
MOST = 128  # windows of a segment; longer runs are cut
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
HOT = 4096  # different segments of an anchor (1.3 MB), counted by shard; windows of hotter ones are spread
_SECOND = 0xC2B2AE3D27D4EB4F  # base of the second hash of a window
_PART = 1 << 20


class Bytes:
    """Some documents laid end to end, with a byte between them that no window may hold."""

    def __init__(self, texts: list[bytes], length: int, gram: int):
        self.data = b"\0".join([*texts, b""])
        raw = np.frombuffer(self.data, np.uint8)
        self.ends = np.cumsum([len(t) + 1 for t in texts])
        self.begins = np.r_[0, self.ends[:-1]]
        self.grams = run_hashes(_TABLE[raw], gram)
        self.width = length - gram + 1
        self.least = sliding(self.grams, self.width)
        size = self.ends - self.begins
        held = np.maximum(size - length, 0)  # windows of a text; the filler byte is not the text's, so none touch the next one's
        self.whole = np.repeat(np.tile([True, False], len(texts)), np.stack([held, size - held], 1).ravel())[: len(self.least)]

    def anchors(self) -> np.ndarray:
        """Hashes at the places that are least in some whole window."""
        m = len(self.least)
        if not m:
            return self.grams[:0]
        seen = np.where(self.whole, self.least, np.uint64(0))
        pad = np.zeros(self.width - 1, np.uint64)
        most = sliding(np.concatenate([pad, seen, pad]), self.width, least=False)
        return self.grams[(most[: len(self.grams)] == self.grams) & (most[: len(self.grams)] > 0)]

    def segments(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last window of each run with one anchor value."""
        inside, new = self.whole, self.least[1:] != self.least[:-1]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= new | ~inside[:-1]
        ends[:-1] &= new | ~inside[1:]
        low, high = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        pieces = -(-(high - low) // most)
        first = np.repeat(low, pieces) + most * _windows(np.zeros_like(pieces), pieces)
        return first, np.minimum(first + most, np.repeat(high, pieces))

    def hashes(self, starts: np.ndarray, ends: np.ndarray, base: int = _ODD) -> np.ndarray:
        return span_hashes(_TABLE[np.frombuffer(self.data, np.uint8)], starts, ends, base)


def _windows(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Every window of the runs first:last."""
    size = last - first
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())


def _pairs(h: np.ndarray, g: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs (h, g), sorted, and the sum of their times."""
    order = np.lexsort((g, h))
    h, g, times = h[order], g[order], times[order]
    heads = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])]) if len(h) else order
    return h[heads], g[heads], np.add.reduceat(times, heads) if len(h) else times


def _parts(table: pa.Table, length: int, gram: int):
    texts = table["text"].cast(pa.binary()).to_pylist()
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= _PART):
            size += len(texts[end])
            end += 1
        yield at, texts[at:end], Bytes(texts[at:end], length, gram)
        at = end


def _ask_anchors(length: int, gram: int, most: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        found, values, bodies = [], [], []
        for _, _, part in _parts(table, length, gram):
            first, last = part.segments(most)
            found.append(part.anchors()), values.append(part.least[first]), bodies.append(part.hashes(first, last + length - 1))
        h, n = np.unique(np.concatenate(found), return_counts=True)
        value, body = np.concatenate(values), np.concatenate(bodies)
        value = _pairs(value, body, np.ones(len(value), np.int64))[0]
        # b - a: different segments in this shard beyond the first, mostly none
        return question(table["shard"][0].as_py(), buckets, h, n, n + np.bincount(np.searchsorted(h, value), minlength=len(h)) - 1)

    return run


def _twice(a: np.ndarray, b: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether anchors are there twice, and their different segments, those of each shard counted alone."""
    if not len(heads):
        return np.zeros(0, bool), a
    return np.add.reduceat(a, heads) >= 2, np.add.reduceat(b - a + 1, heads)


_SEGMENTS = "bucket int, shard int, bodies array<binary>, times array<bigint>, h array<bigint>, g array<bigint>, n array<bigint>"


def _ask_segments(length: int, gram: int, most: int, buckets: int, hot: int = HOT):
    def run(table: pa.Table, recurring: pa.Table) -> pa.Table:
        known, different = answer(recurring)
        bodies: list[dict[bytes, int]] = [{} for _ in range(buckets)]
        prints: list[tuple[np.ndarray, np.ndarray]] = [(known[:0], known[:0])]
        for _, _, part in _parts(table, length, gram) if table.num_rows else ():
            first, last = part.segments(most)
            value = part.least[first]
            place = look_up(value, known)
            some = place >= 0
            if some.any():
                spread = some & (different[place] > hot)
                some &= ~spread
                if spread.any():
                    at = _windows(first[spread], last[spread])
                    prints.append((part.hashes(at, at + length), part.hashes(at, at + length, _SECOND)))
            data = part.data
            for s, e, b in zip(first[some].tolist(), last[some].tolist(), (value[some] % np.uint64(buckets)).tolist()):
                body, held = data[s : e + length - 1], bodies[b]
                held[body] = held.get(body, 0) + 1
        h, g = (np.concatenate(x) for x in zip(*prints))
        h, g, n = _pairs(h, g, np.ones(len(h), np.int64))
        where = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        cut = np.r_[0, np.cumsum(np.bincount(where, minlength=buckets))]
        full = [b for b in range(buckets) if bodies[b] or cut[b] < cut[b + 1]]
        spread = {
            name: pa.array([x[order[cut[b] : cut[b + 1]]] for b in full], pa.list_(pa.int64()))
            for name, x in (("h", h.view(np.int64)), ("g", g.view(np.int64)), ("n", n))
        }
        return pa.table(
            {
                "bucket": pa.array(full, pa.int32()),
                "shard": pa.array([table["shard"][0].as_py()] * len(full) if full else [], pa.int32()),
                "bodies": pa.array([list(bodies[b]) for b in full], pa.list_(pa.binary())),
                "times": pa.array([list(bodies[b].values()) for b in full], pa.list_(pa.int64())),
                **spread,
            }
        )

    return run


class _Minima:
    """Range minima of a byte array, by doubling."""

    def __init__(self, values: np.ndarray, longest: int):
        self.levels = [values]
        step = 1
        while step * 2 <= longest:
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def ask(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least of values[low:high] for non-empty ranges."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.uint8)
        for k in np.unique(level).tolist():
            on = level == k
            row = self.levels[k]
            out[on] = np.minimum(row[low[on]], row[high[on] - (1 << k)])
        return out


def _words(raw: np.ndarray, symbol: int) -> np.ndarray:
    """The word of so many bytes at every place, as a number: its bytes if they fit, else their hash."""
    n = len(raw) - symbol
    if symbol > 8:
        return run_hashes(_TABLE[raw], symbol)[:n]
    windows = np.lib.stride_tricks.sliding_window_view(raw, symbol)[:n]
    wide = np.zeros((n, 8), np.uint8)
    wide[:, 8 - symbol :] = windows
    return wide.view(">u8").ravel().astype(np.uint64)


def _ordered(values: np.ndarray) -> np.ndarray:
    """Places of the values in ascending order.

    Their upper bits are sorted with the place in the lower ones, as a sort of numbers takes a sixth of one of places;
    values that agree in the upper bits only, mostly none, are put in order after that.
    """
    bits = np.uint64(len(values).bit_length())
    key = values >> bits << bits
    key |= np.arange(len(values), dtype=np.uint64)
    key.sort()
    order = (key & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    found = values[order]
    if (found[1:] < found[:-1]).any():
        upper = found >> bits
        odd = (upper[1:] == upper[:-1]) & (found[1:] != found[:-1])
        on = np.flatnonzero(np.isin(upper, upper[1:][odd]))
        order[on] = order[on[np.argsort(found[on], kind="stable")]]
    return order


def _ranks(values: np.ndarray) -> np.ndarray:
    """Number of each value among the different ones, in ascending order."""
    order = _ordered(values)
    found = values[order]
    out = np.empty(len(values), np.int32)
    out[order] = np.cumsum(np.r_[False, found[1:] != found[:-1]][: len(values)], dtype=np.int32)
    return out


def collection(bodies: list[bytes], length: int = LENGTH, symbol: int = SYMBOL, *, ranks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted order of the strings' suffixes of at least ``length`` bytes, built column by column.

    Returns for each such suffix, in order: the body it lies in, where in it it begins, and how
    many symbols it shares with the suffix before (no more than length / symbol are counted).
    ``ranks``: the number of the word at each byte of the bodies laid end to end, if it is known.
    """
    full = length // symbol
    size = np.array([len(b) for b in bodies], np.int64)
    starts = np.r_[0, np.cumsum(size)[:-1]]
    if ranks is None:
        ranks = _ranks(_words(np.frombuffer(b"".join(bodies) + bytes(symbol), np.uint8), symbol))
    # one string for each body and phase, but those too short to hold a window; symbols are ranks of the words that occur
    phases = np.clip(size - full * symbol + 1, 0, symbol)
    body = np.repeat(np.arange(len(bodies)), phases)
    phase = np.arange(len(body)) - np.repeat(np.cumsum(phases) - phases, phases)
    count = (size[body] - phase) // symbol
    n = len(body)
    base = starts[body] + phase

    # the list so far: first symbol, place of the tail, common prefix
    first = np.full(n, -1, np.int32)
    tail = np.arange(n, dtype=np.int32)
    shared = np.zeros(n, np.uint8)
    place = tail.copy()  # of each string's longest suffix
    for k in range(1, int(count.max(initial=0)) + 1):
        on = np.flatnonzero(count >= k)
        total = len(first)
        # all different, as each string has its own place, which tells the string
        key = (ranks[base[on] + (count[on] - k) * symbol].astype(np.int64) << 32) | place[on]
        string = np.empty(total, np.int32)
        string[place[on]] = on
        key.sort()
        c, pos = (key >> 32).astype(np.int32), key.astype(np.int32)
        on = string[pos]
        old_key = (first.astype(np.int64) << 32) | tail
        at = np.searchsorted(old_key, key)
        new_place = (at + np.arange(len(on))).astype(np.int32)
        moved = np.arange(total, dtype=np.int32)
        moved += np.cumsum(np.bincount(at, minlength=total + 1)[:total], dtype=np.int32)

        def merged(old: np.ndarray, new: np.ndarray | int) -> np.ndarray:
            out = np.empty(total + len(on), old.dtype)
            out[moved], out[new_place] = old, new
            return out

        first = merged(first, c)
        tail_before = merged(tail, pos)  # in the list as it was
        shared_before = shared
        shared = merged(shared, 0)
        # common prefixes change where a suffix came in, and just after it
        changed = np.zeros(len(first) + 1, bool)
        changed[new_place] = changed[new_place + 1] = True
        changed[0] = changed[-1] = False
        check = np.flatnonzero(changed)
        same = first[check] == first[check - 1]
        same &= first[check] >= 0
        low, high = tail_before[check[same] - 1] + 1, tail_before[check[same]] + 1
        shared[check] = 0
        if len(low):
            least = _Minima(shared_before, int((high - low).max())).ask(low, high)
            shared[check[same]] = np.minimum(least.astype(np.int64) + 1, full)
        shared[0] = 0
        tail = moved[tail_before]
        others = np.flatnonzero(count < k)
        place[on] = new_place
        if len(others):
            place[others] = moved[place[others]]
    # from each string's longest suffix along the tails, as far as they hold a window
    owner, symbols = np.empty(len(first), np.int32), np.zeros(len(first), np.int32)
    on, left = np.arange(n), count
    while len(on):
        owner[place], symbols[place] = on, left
        more = left > full
        on, left, place = on[more], left[more] - 1, tail[place[more]]
    long = np.flatnonzero(symbols)
    # what lies between two equal windows is equal to both, so dropping short suffixes loses nothing
    own = owner[long]
    return body[own], phase[own] + (count[own] - symbols[long]) * symbol, shared[long]


def shared_parts(
    bodies: list[bytes], times: np.ndarray, length: int = LENGTH, symbol: int = SYMBOL
) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The parts of the strings in which each word of ``symbol`` bytes may stand for two places or more.

    A window that recurs holds no other word, so it lies inside such a part, and nothing is lost with what
    lies between. Words are numbered once; what the first cut leaves is counted again, so that equal parts end
    alike. Returns the different parts, for each place of one its number, the string it lies in and where in it
    it begins, and the number of the word at each byte of the parts laid end to end.
    """
    size = np.array([len(b) for b in bodies], np.int64)
    starts = np.r_[0, np.cumsum(size)[:-1]]
    joined = b"".join(bodies)
    raw = np.frombuffer(joined + bytes(symbol), np.uint8)
    none = np.zeros(0, np.int64)
    if not len(joined):
        return [], none, none, none, none
    ranks = _ranks(_words(raw, symbol))
    often = np.repeat(times >= 2, size)
    left = _windows(starts, starts + np.maximum(size - symbol + 1, 0))  # words of a string
    for _ in range(2):
        # a word stands for two places or more if it is there twice, or in a string that does
        word = ranks[left]
        twice = np.bincount(word) >= 2
        twice[word[often[left]]] = True
        recurs = np.zeros(len(joined) + 2, np.int8)
        recurs[left + 1] = twice[word]
        edge = np.diff(recurs)
        low, high = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        on = high - low > length - symbol
        low, high = low[on], high[on]
        left = _windows(low, high)
    owner = np.searchsorted(starts, low, "right") - 1
    high = high + symbol - 1
    number: dict[bytes, int] = {}
    part = np.array([number.setdefault(joined[i:j], len(number)) for i, j in zip(low.tolist(), high.tolist())], np.int64)
    head = np.unique(part, return_index=True)[1]
    return list(number), part, owner, low - starts[owner], ranks[_windows(low[head], high[head])]


def recurring_windows(bodies: list[bytes], times: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Windows (body, start) whose string stands for two places or more.

    Columns are built over the shared parts alone, equal ones once with the places that they stand for.
    """
    parts, part, owner, offset, ranks = shared_parts(bodies, times, length, SYMBOL)
    own, start, shared = collection(parts, length, SYMBOL, ranks=ranks)
    if not len(own):
        return own, start
    stands = np.bincount(part, weights=times[owner], minlength=len(parts)).astype(np.int64)
    heads = np.flatnonzero(np.r_[True, shared[1:] < length // SYMBOL])
    weight = np.add.reduceat(stands[own], heads)
    keep = np.repeat(weight >= 2, np.diff(np.r_[heads, len(own)]))
    own, start = own[keep], start[keep]
    # from each part to its places
    by_part = np.argsort(part, kind="stable")
    places = np.bincount(part, minlength=len(parts))
    n = places[own]
    at = by_part[_windows((first := (np.cumsum(places) - places)[own]), first + n)]
    return owner[at], np.repeat(start, n) + offset[at]


_RANGES = "shard int, ids array<bigint>, lows array<int>, highs array<int>, h array<bigint>, g array<bigint>"


def _recurring_prints(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each shard its spread windows (two hashes) that stand for two places or more in all shards."""
    (h, size), (g, _), (n, _) = (flat(table[c]) for c in ("h", "g", "n"))
    if not len(h):
        return {}
    shard = np.repeat(np.asarray(table["shard"]), size)
    order = np.lexsort((g, h))
    h, g, n, shard = h[order], g[order], n[order], shard[order]
    heads = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
    keep = np.repeat(np.add.reduceat(n, heads) >= 2, np.diff(np.r_[heads, len(h)]))
    h, g, shard = h[keep], g[keep], shard[keep]
    order = np.argsort(shard, kind="stable")
    shards, cut = np.unique(shard[order], return_index=True)
    return {s: (h[on], g[on]) for s, on in zip(shards.tolist(), np.split(order, cut[1:]))}


def _judge(length: int):
    def run(table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        times: list[int] = []
        held: dict[int, set[int]] = {}
        for shard, bodies, counts in zip(table["shard"].to_pylist(), table["bodies"].to_pylist(), table["times"].to_pylist()):
            for b, n in zip(bodies, counts):
                i = number.setdefault(b, len(number))
                if i == len(times):
                    times.append(0)
                times[i] += n
                held.setdefault(shard, set()).add(i)
        bodies = list(number)
        body, start = recurring_windows(bodies, np.array(times, np.int64), length)
        key = np.sort(body << 32 | start)
        body, start = key >> 32, key & ((1 << 32) - 1)
        heads = np.flatnonzero(np.r_[True, (body[1:] != body[:-1]) | (start[1:] != start[:-1] + 1)]) if len(body) else body
        of, low = body[heads], start[heads]
        high = start[np.r_[heads[1:], len(body)] - 1] + length if len(body) else low
        ids = np.array([xxhash.xxh3_64_intdigest(b) for b in bodies], np.uint64).view(np.int64)
        prints, none = _recurring_prints(table), np.zeros(0, np.int64)
        shards, columns = sorted({*held, *prints}), ([], [], [], [], [])
        for shard in shards:
            on = np.array(sorted(held.get(shard, ())), np.int64)
            on = _windows(np.searchsorted(of, on), np.searchsorted(of, on, "right"))
            for column, x in zip(columns, (ids[of[on]], low[on], high[on], *prints.get(shard, (none, none)))):
                column.append(x)
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        lists = {name: pa.array(c, pa.list_(t)) for name, c, t in zip(("ids", "lows", "highs", "h", "g"), columns, kinds)}
        return pa.table({"shard": pa.array(shards, pa.int32()), **lists})

    return run


def _among(h: np.ndarray, g: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Which pairs (h, g) are rows of the sorted prints."""
    low, high = (np.searchsorted(prints[:, 0], h, side) for side in ("left", "right"))
    found = np.zeros(len(h), bool)
    for k in range(int((high - low).max(initial=0))):  # one round, but where first hashes clash
        on = np.flatnonzero(low + k < high)
        found[on] |= prints[low[on] + k, 1] == g[on]
    return found


def _remove(length: int, gram: int, most: int, id_type: pa.DataType, texts: bool):
    def run(table: pa.Table, ranges: pa.Table) -> pa.Table:
        marked: dict[int, list[tuple[int, int]]] = {}
        for ids, lows, highs in zip(*(ranges[c].to_pylist() for c in ("ids", "lows", "highs"))):
            for i, a, b in zip(ids or (), lows or (), highs or ()):
                marked.setdefault(i, []).append((a, b))
        h, g, hot = (flat(ranges[c])[0].view(np.uint64) if ranges.num_rows else np.zeros(0, np.uint64) for c in ("h", "g", "hot"))
        prints, hot = np.array([h, g]).T, np.unique(hot)
        prints = prints[np.lexsort((prints[:, 1], prints[:, 0]))]
        doc_ids, out = table["doc_id"].to_pylist(), []
        for at, own, part in _parts(table, length, gram):
            change = np.zeros(len(part.data) + 1, np.int64)
            first, last = part.segments(most) if marked or len(prints) else (None, None)
            if len(prints):
                spread = look_up(part.least[first], hot) >= 0
                w = _windows(first[spread], last[spread])
                w = w[_among(part.hashes(w, w + length), part.hashes(w, w + length, _SECOND), prints)]
                np.add.at(change, w, 1)
                np.subtract.at(change, w + length, 1)
            if marked:
                data, starts, stops = part.data, [], []
                for s, e in zip(first.tolist(), last.tolist()):
                    h = xxhash.xxh3_64_intdigest(data[s : e + length - 1])
                    for a, b in marked.get(h - (1 << 64) if h >> 63 else h, ()):
                        starts.append(s + a), stops.append(s + b)
                np.add.at(change, np.array(starts, np.int64), 1)
                np.subtract.at(change, np.array(stops, np.int64), 1)
            gone = np.cumsum(change)[:-1] > 0
            raw = np.frombuffer(part.data, np.uint8)
            for i, text in enumerate(own):
                a, b = int(part.begins[i]), int(part.ends[i]) - 1
                lost = gone[a:b]
                spans = int((np.diff(np.r_[False, lost].astype(np.int8)) == 1).sum())
                kept = raw[a:b][~lost].tobytes() if spans else text
                out.append((doc_ids[at + i], b - a, int(lost.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if texts else None))
        columns = list(zip(*out)) or [[]] * 6
        kinds = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        arrays = {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)}
        if not texts:
            del arrays["kept"]
        return pa.table(arrays)

    return run


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST, texts: bool = False, hot: int = HOT) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if wanted."""
    if length % SYMBOL:
        raise ValueError(f"length must be a multiple of {SYMBOL}")
    rows, n = sharded(docs)
    shards = rows.groupBy("shard")
    anchors = stage(answered(shards.applyInArrow(_ask_anchors(length, gram, most, n), QUESTION), _twice), "anchors")
    asked = shards.cogroup(anchors.groupBy("shard")).applyInArrow(_ask_segments(length, gram, most, n, hot), _SEGMENTS)
    ranges = stage(asked.groupBy("bucket").applyInArrow(_judge(length), _RANGES), "ranges")
    hottest = F.transform(F.filter(F.arrays_zip("h", "a"), lambda x: x["a"] > hot), lambda x: x["h"])
    hottest = stage(anchors.select("shard", hottest.alias("hot")).where(F.size("hot") > 0), "hot", False)
    unstage(anchors)
    ranges = ranges.unionByName(hottest, allowMissingColumns=True)
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = {"int": pa.int32(), "bigint": pa.int64(), "smallint": pa.int16()}[kind]
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if texts else "")
    return shards.cogroup(ranges.groupBy("shard")).applyInArrow(_remove(length, gram, most, id_type, texts), schema)
