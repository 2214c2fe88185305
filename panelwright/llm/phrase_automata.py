"""Substring dedup by repeated-phrase automata (operator 1).

A window is ``WINDOW`` consecutive words of a document. Words covered by a window whose word
sequence also starts in a document with a smaller id are removed; windows are judged on the
input.

1. Every window is represented by the phrase (``PHRASE`` consecutive words) of least hash in
   it. Equal windows have equal phrases, so only windows of a recurring phrase, one seen in
   two documents or more, can recur. About one word in five begins a phrase.
2. Documents lie in shards. Each shard compiles an Aho-Corasick automaton of its recurring
   phrases and streams its documents through it: every occurrence is located, and the windows
   around it are candidates.
3. Candidate windows are put to the corpus by hash (64 bits of the window beside 64 of its
   phrase), which yields the smallest document each is in.
4. Shards remove the covered words of their documents.

Nothing is capped: a shard's automaton holds what its few megabytes of text contain, and a
phrase or window with a third of all documents is one entry per shard.

Defined results: a null or empty text has no words. Rows with a null id neither lose words nor
cause others to. Rows that share an id don't take words from one another. An empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelwright.llm.common import stage, unstage
from panelwright.llm.shards import QUESTION, answer, answered, look_up, mix, question, sharded, sliding, span_hashes

WINDOW = 13
PHRASE = 5
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(9, 14)]] = True
_PART = 1 << 20  # bytes turned into arrays at once, whole documents always


class Words:
    """The words of some documents, laid end to end."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join([*texts, b""])
        raw = np.frombuffer(self.data, np.uint8)
        white = _WHITE[raw]
        edge = np.diff(np.r_[True, white, True].astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        stops = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(stops, self.starts, side="right")
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.hashes = span_hashes(_TABLE[raw], self.starts, self.ends)

    def runs(self, width: int) -> np.ndarray:
        """Hash of each run of so many words, also where it crosses documents."""
        n = max(0, len(self.hashes) - width + 1)
        at = np.arange(n)
        return span_hashes(self.hashes, at, at + width, 0xD1342543DE82EF95)

    def windows(self, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of every phrase; and for every run of a window's length its least phrase, and whether it lies in one document."""
        phrases = self.runs(phrase)
        least = sliding(phrases, window - phrase + 1)
        whole = self.doc[: len(least)] == self.doc[window - 1 :][: len(least)]
        return phrases, least, whole

    def texts(self, i: int) -> list[bytes]:
        data = self.data
        a, b = self.first[i], self.first[i + 1]
        return [data[s:e] for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())]


def _parts(table: pa.Table):
    """(ids, which are not null, Words) of a shard, some documents at a time."""
    ids = table["doc_id"].to_pylist()
    texts = [t for t in table["text"].cast(pa.binary()).to_pylist()]
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= _PART):
            size += len(texts[end])
            end += 1
        own = ids[at:end]
        yield np.array([0 if i is None else i for i in own], np.int64), np.array([i is not None for i in own]), Words(texts[at:end])
        at = end


def _spans(h: list[np.ndarray], ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes with their smallest and largest document."""
    every, owner = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((h, np.uint64), (ids, np.int64)))
    if not len(every):
        return every, owner, owner
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    heads = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    return every[heads], np.minimum.reduceat(owner, heads), np.maximum.reduceat(owner, heads)


def _phrases(window: int, phrase: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        hashes, owners = [], []
        for ids, known, words in _parts(table):
            _, least, whole = words.windows(window, phrase)
            doc = words.doc[: len(least)]
            at = np.flatnonzero(whole & known[doc])
            at = at[np.r_[True, (least[at[1:]] != least[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])]] if len(at) else at
            hashes.append(least[at])
            owners.append(ids[doc[at]])
        return question(table["shard"][0].as_py(), buckets, *_spans(hashes, owners))

    return run


def _automaton(words: Words, at: np.ndarray, phrase: int) -> ahocorasick.Automaton:
    """Of the phrases that begin at these words, each between blanks."""
    machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    data, starts, ends = words.data, words.starts, words.ends
    for i in at.tolist():
        machine.add_word(" " + b" ".join([data[s:e] for s, e in zip(starts[i : i + phrase].tolist(), ends[i : i + phrase].tolist())]).decode() + " ")
    machine.make_automaton()
    return machine


def locate(words: Words, machine: ahocorasick.Automaton, phrase: int) -> np.ndarray:
    """Whether a phrase of the automaton begins at each word: all documents stream through it."""
    hit = np.zeros(len(words.starts) + 1, bool)
    if not len(machine):
        return hit
    for i in range(len(words.first) - 1):
        a, b = words.first[i], words.first[i + 1]
        if b - a < phrase:
            continue
        found = words.texts(i)
        line = " " + b" ".join(found).decode() + " "
        ends = np.fromiter((end for end, _ in machine.iter(line)), np.int64)
        if len(ends):
            stops = np.cumsum([len(w.decode()) + 1 for w in found]) if not line.isascii() else np.cumsum([len(w) + 1 for w in found])
            hit[a + np.searchsorted(stops, ends) - phrase + 1] = True
    return hit


def _window_key(words: Words, least: np.ndarray, window: int, at: np.ndarray) -> np.ndarray:
    """64 bits that stand for the window and, mixed in, for its phrase."""
    return mix(words.runs(window)[at] ^ (least[at] * np.uint64(0x9E3779B97F4A7C15)))


def _windows(window: int, phrase: int, buckets: int):
    reach = window - phrase + 1

    def run(table: pa.Table, recurring: pa.Table) -> pa.Table:
        if not table.num_rows:
            return question(0, buckets, *_spans([], []))
        known, _ = answer(recurring)
        hashes, owners = [], []
        for ids, named, words in _parts(table):
            phrases, least, whole = words.windows(window, phrase)
            first = np.flatnonzero(look_up(phrases, known) >= 0)
            _, once = np.unique(phrases[first], return_index=True)
            hit = locate(words, _automaton(words, first[once], phrase), phrase)
            near = np.zeros(len(least), bool)
            for k in range(reach):
                near |= hit[k : k + len(least)] & (phrases[k : k + len(least)] == least)
            doc = words.doc[: len(least)]
            at = np.flatnonzero(near & whole & named[doc])
            hashes.append(_window_key(words, least, window, at))
            owners.append(ids[doc[at]])
        return question(table["shard"][0].as_py(), buckets, *_spans(hashes, owners))

    return run


def _remove(window: int, phrase: int, id_type: pa.DataType, texts: bool):
    def run(table: pa.Table, recurring: pa.Table) -> pa.Table:
        known, smallest = answer(recurring)
        out: list[tuple] = []
        for ids, named, words in _parts(table):
            _, least, whole = words.windows(window, phrase)
            doc = words.doc[: len(least)]
            at = np.flatnonzero(whole & named[doc])
            place = look_up(_window_key(words, least, window, at), known)
            at = at[(place >= 0) & (smallest[place] < ids[doc[at]])] if len(known) else at[:0]
            change = np.zeros(len(words.starts) + 1, np.int64)
            change[at] += 1
            np.subtract.at(change, at + window, 1)
            keep = np.cumsum(change)[:-1] == 0
            for i, (n, there) in enumerate(zip(ids.tolist(), named.tolist())):
                a, b = words.first[i], words.first[i + 1]
                own = keep[a:b]
                kept = b" ".join([w for w, k in zip(words.texts(i), own.tolist()) if k])
                out.append((n if there else None, int(b - a), int((~own).sum()), hashlib.sha256(kept).hexdigest(), kept if texts else None))
        columns = list(zip(*out)) or [[]] * 5
        kinds = [id_type, pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        if texts:
            arrays[4] = arrays[4].cast(pa.string())
        return pa.table(dict(zip(names, arrays if texts else arrays[:4])))

    return run


def _recurs(a: np.ndarray, b: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In two documents or more; the smallest of them."""
    if not len(heads):
        return np.zeros(0, bool), a
    low, high = np.minimum.reduceat(a, heads), np.maximum.reduceat(b, heads)
    return low < high, low


def remove_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, texts: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256, and the kept text if wanted."""
    rows, n = sharded(docs)
    shards = rows.groupBy("shard")
    phrases = stage(answered(shards.applyInArrow(_phrases(window, phrase, n), QUESTION), _recurs), "phrases")
    asked = shards.cogroup(phrases.groupBy("shard")).applyInArrow(_windows(window, phrase, n), QUESTION)
    windows = stage(answered(asked, _recurs), "windows")
    unstage(phrases)
    kind = docs.schema["doc_id"].dataType
    id_type = {"int": pa.int32(), "bigint": pa.int64(), "smallint": pa.int16()}[kind.simpleString()]
    schema = f"doc_id {kind.simpleString()}, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept string" if texts else "")
    return shards.cogroup(windows.groupBy("shard")).applyInArrow(_remove(window, phrase, id_type, texts), schema)

