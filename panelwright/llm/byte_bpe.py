"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation (operator 9).

No pattern is run over a text. Each code point gets a class from an array; an automaton over
classes says where a piece begins. The automaton is evaluated as a scan over transition
functions, whose composition is associative: texts are laid out in rows of fixed length, every
row is run for all start states at once, the rows' functions are composed, and a second pass
knows each row's true start state. The slices between boundaries feed pair merging by rank,
cached per distinct piece. Ids are int32 arrays with the end offset of each token in the
text's bytes, by which any range of ids decodes to its range of bytes.

Pieces are those of the usual byte-level pattern: contractions ('s 't 're 've 'm 'll 'd), an
optional blank before letters, digits or other signs, white space that leaves its last
character to what follows. Special tokens are not treated.

Defined results: a null text counts as empty and has no tokens. Repeated rows give repeated
results. An empty table gives no rows. Other columns are ignored. Texts of any length are
encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from panelwright.llm.common import pieces

#: Distinct pieces in each of the two generations whose merges a worker remembers.
CACHE = 250_000
_NEVER = 1 << 60
ROW = 64

LETTER, DIGIT, OTHER, SPACE, GAP, JOIN, SHORT, LONG = range(8)
#   GAP: white space that another white space character or the end follows; SPACE: the last
#   white space before something else, when it isn't a blank; JOIN: when it is a blank.
#   SHORT, LONG: an apostrophe before one or two letters that would make a contraction.
IN_LETTERS, IN_DIGITS, IN_OTHER, IN_GAP, JOINED, ONE_LEFT, TWO_LEFT, FRESH = range(8)


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece begins, by class and state."""
    following, begins = np.zeros((8, 8), np.uint8), np.zeros((8, 8), bool)
    plain = {LETTER: IN_LETTERS, DIGIT: IN_DIGITS, OTHER: IN_OTHER, GAP: IN_GAP, SPACE: FRESH, JOIN: JOINED}
    for state in range(8):
        for kind in range(8):
            if kind in (SHORT, LONG):  # a contraction only where a piece would begin anyway
                inside = state in (IN_OTHER, JOINED)
                after = IN_OTHER if inside else ONE_LEFT if kind == SHORT else TWO_LEFT
                starts = not inside
            elif state in (ONE_LEFT, TWO_LEFT):  # only letters can follow
                after, starts = (FRESH if state == ONE_LEFT else ONE_LEFT), False
            else:
                after = plain[kind]
                run = {LETTER: IN_LETTERS, DIGIT: IN_DIGITS, OTHER: IN_OTHER, GAP: IN_GAP}.get(kind)
                joins = state == JOINED and kind in (LETTER, DIGIT, OTHER)
                starts = not (joins or (run is not None and run == state))
            following[kind, state], begins[kind, state] = after, starts
    return following, begins


_NEXT, _BEGINS = _machine()


@lru_cache(1)
def _classes() -> np.ndarray:
    """Letter, digit, other or white space (as GAP) of every code point."""
    kind = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, value in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT), (r"\s+", GAP)):
        for m in regex.finditer(pattern, every):
            shift = 0x800 if m.start() >= 0xD800 else 0
            end = m.end() + (0x800 if m.end() > 0xD800 else 0)
            kind[m.start() + shift : end] = value
    kind[0xD800:0xE000] = OTHER
    return kind


def _symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Classes of the code points of several texts, each followed by one filler that ends lists."""
    kind = _classes()[points]
    last = np.zeros(len(points), bool)
    last[ends[ends > 0] - 1] = True
    last[ends] = True
    white = kind == GAP
    next_white = np.r_[white[1:], True] | last
    tail = white & ~next_white
    kind[tail] = np.where(points[tail] == 0x20, JOIN, SPACE)
    at = np.flatnonzero((points == 0x27) & ~last)
    if len(at):
        p1 = points[at + 1]
        two = ~last[at + 1]
        p2 = np.where(two, points[np.minimum(at + 2, len(points) - 1)], 0)
        short = np.isin(p1, [ord(c) for c in "stmd"])
        long = ((p1 == ord("r")) & (p2 == ord("e"))) | ((p1 == ord("v")) & (p2 == ord("e"))) | ((p1 == ord("l")) & (p2 == ord("l")))
        kind[at[short]] = SHORT
        kind[at[long & ~short]] = LONG
    kind[ends] = SPACE  # the state after it is a fresh one
    return kind


def boundaries(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces begin (each text's filler counts as one), over texts with their fillers."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    symbols = _symbols(points, ends)
    rows = -(-n // ROW)
    grid = np.full(rows * ROW, SPACE, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(rows, ROW).T) * np.uint8(8)
    follow, begin = _NEXT.ravel(), _BEGINS.ravel()
    function = np.repeat(np.arange(8, dtype=np.uint8)[:, None], rows, axis=1)  # of each row: start state to end state
    for column in grid:
        function = follow[column[None, :] + function]
    start = _prefix(function)
    out = np.empty((ROW, rows), bool)
    state = start
    for k, column in enumerate(grid):
        at = column + state
        out[k] = begin[at]
        state = follow[at]
    found = out.T.ravel()[:n]
    found[ends] = True
    return np.flatnonzero(found)


def _prefix(function: np.ndarray) -> np.ndarray:
    """State before each row, by doubling: compose functions over ever longer runs of rows."""
    total = function.copy()
    step = 1
    while step < total.shape[1]:
        joined = np.take_along_axis(total[:, step:], total[:, :-step], axis=0)
        total = np.concatenate([total[:, :step], joined], axis=1)
        step *= 2
    return np.r_[np.uint8(FRESH), total[FRESH, :-1]]


class Codec:
    """Merges by rank, and the bytes of every id."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.words = [b""] * (max(self.ranks.values()) + 1)
        for word, rank in self.ranks.items():
            self.words[rank] = word
        self.cache: dict[bytes, tuple[int, ...]] = {}
        self.old: dict[bytes, tuple[int, ...]] = {}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.names = [str(i) for i in range(len(self.words))]
        self.pair_keys = None

    def merge(self, piece: bytes) -> tuple[int, ...]:
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(piece) > 512:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        get = ranks.get
        pairs = [get(piece[i : i + 2], _NEVER) for i in range(len(piece) - 1)]
        while pairs:
            best = min(pairs)
            if best == _NEVER:
                break
            i = pairs.index(best)
            word = parts[i] + parts[i + 1]
            parts[i : i + 2] = [word]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + word, _NEVER)
            if i < len(pairs):
                pairs[i] = get(word + parts[i + 1], _NEVER)
        return tuple([ranks[p] for p in parts])

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same merges by a heap, for runs without a break."""
        import heapq

        ranks, n = self.ranks, len(piece)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                rank = ranks.get(piece[i : end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[i], end[j]))

        for i in range(n):
            offer(i)
        alive = [True] * n
        while heap:
            _, i, mid, stop = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or end[i] != mid or j >= n or end[j] != stop:
                continue
            end[i], alive[j], after[i] = stop, False, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = after[i]
        return tuple(out)

    def learn(self, pieces: set[bytes]) -> None:
        """See that the young generation of the cache holds every one of these pieces."""
        if len(self.cache) + len(pieces) > CACHE:
            self.old, self.cache = self.cache, {}
        old = self.old
        known = {p: old[p] for p in pieces if p in old}
        self.cache.update(known)
        ranks = self.ranks
        rest = []
        for p in pieces.difference(known):
            if p in ranks:
                self.cache[p] = (ranks[p],)
            elif len(p) > 64:
                self.cache[p] = self.merge(p)
            else:
                rest.append(p)
        if rest:
            self.cache.update(zip(rest, self._merge_many(rest)))

    def _slot(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return ((left.astype(np.uint64) * np.uint64(0x9E3779B1) + right.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)

    def _pair_table(self) -> None:
        """Rank of what two ids make, as two arrays hashed by the pair; the few that clash in a dict."""
        left, right, rank = [], [], []
        for word, r in self.ranks.items():
            for cut in range(1, len(word)):
                a, b = self.ranks.get(word[:cut]), self.ranks.get(word[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        left, right, rank = (np.array(x, np.int64) for x in (left, right, rank))
        slot = self._slot(left, right)
        self.pair_keys = np.full(1 << 20, -1, np.int64)
        self.pair_ranks = np.zeros(1 << 20, np.int64)
        keys = (left << 32) | right
        self.pair_keys[slot], self.pair_ranks[slot] = keys, rank
        lost = np.flatnonzero(self.pair_keys[slot] != keys)
        order = lost[np.argsort(keys[lost])]
        self.more_keys, self.more_ranks = np.r_[keys[order], np.iinfo(np.int64).max], np.r_[rank[order], 0]

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, slot = (left << 32) | right, self._slot(left, right)
        held = self.pair_keys[slot]
        found = np.where(held == keys, self.pair_ranks[slot], _NEVER)
        other = np.flatnonzero((held != keys) & (held >= 0))
        if len(other):
            at = np.searchsorted(self.more_keys, keys[other])
            hit = self.more_keys[at] == keys[other]
            found[other[hit]] = self.more_ranks[at[hit]]
        return found

    def _merge_many(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Merges of many short pieces together: each round joins the best pair of every piece."""
        if self.pair_keys is None:
            self._pair_table()
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), size)
        rank = np.full(len(ids), _NEVER)  # of the pair that begins here
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inner] = self._pair_rank(ids[inner], ids[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, heads)
            over = np.repeat(best == _NEVER, np.diff(np.r_[heads, len(ids)]))
            if over.any():
                done.append((owner[over], ids[over]))
                ids, owner, rank = ids[~over], owner[~over], rank[~over]
                if not len(ids):
                    break
                heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                best = best[best != _NEVER]
            spread = np.repeat(best, np.diff(np.r_[heads, len(ids)]))
            hits = np.flatnonzero(rank == spread)
            hits = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]  # the leftmost of each piece
            ids[hits] = rank[hits]
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            at = np.cumsum(keep)[hits] - 1
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            rank[at] = _NEVER
            for i in (at, at - 1):
                i = i[(i >= 0) & (i + 1 < len(ids))]
                i = i[owner[i] == owner[i + 1]]
                rank[i] = self._pair_rank(ids[i], ids[i + 1])
        owners, found = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(owners, kind="stable")
        found = found[order].tolist()
        ends = np.cumsum(np.bincount(owners, minlength=len(pieces))).tolist()
        return [tuple(found[a:b]) for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        joined = "\n".join([*texts, ""])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        starts = boundaries(points, ends)
        width = (points >= 0x80).view(np.uint8) + (points >= 0x800) + (points >= 0x10000)
        at = np.arange(len(points)) + np.r_[0, np.cumsum(width, dtype=np.int64)[:-1]] if width.any() else np.arange(len(points))
        data = joined.encode()
        cut = at[starts].tolist()
        fillers = np.searchsorted(starts, ends).tolist()
        found = [data[s:e] for s, e in zip(cut, cut[1:])]
        new = set(found).difference(self.cache)
        if new:
            if len(self.cache) + len(new) > CACHE:
                new = set(found)
            self.learn(new)
        cache, out, first = self.cache, [], 0
        for last in fillers:
            out.append([i for piece in found[first:last] for i in cache[piece]])
            first = last + 1
        return out

    def decode(self, ids: list[int]) -> bytes:
        words = self.words
        return b"".join([words[i] for i in ids])

    def offsets(self, ids: list[int]) -> np.ndarray:
        """End of each token in the bytes of its text."""
        return np.cumsum([len(self.words[i]) for i in ids], dtype=np.int64)


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def _texts(part: pa.RecordBatch) -> list[str]:
    return [t or "" for t in part.column("text").to_pylist()]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and ends (bytes up to the end of each token)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for part in pieces(batch):
                ids = c.encode(_texts(part))
                ends = [c.offsets(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int64()))], ["doc_id", "ids", "ends"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, ends array<bigint>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the bytes that its ids stand for; null ids decode to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                data = [c.decode(ids or []) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, data binary")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded and decoded in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        names = c.names
        for batch in batches:
            for part in pieces(batch):
                rows = []
                for ids in c.encode(_texts(part)):
                    listed = ",".join([names[i] for i in ids]).encode()
                    rows.append((len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()))
                n, ids_sha, decoded_sha = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
