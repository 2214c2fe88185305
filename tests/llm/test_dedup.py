"""Operators 1, 3, 4, 6, 7 against brute force."""

import hashlib
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from panelwright.llm import column_bwt, exact_dedup, metric_join, phrase_automata, simhash_tiles
from panelwright.llm.common import Forest, components

from .helpers import SF, documents, empty, have_tables, messy, messy_rows

sha = lambda b: hashlib.sha256(b).hexdigest()
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
raw = lambda t: (t or "").encode()
got = lambda df: Counter(tuple(r) for r in df.collect())


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# operator 1


def windows_by_hand(rows, n=13):
    words = [WORD.findall(raw(t)) for _, t in rows]
    least = {}
    for (i, _), ws in zip(rows, words):
        for k in range(len(ws) - n + 1) if i is not None else ():
            w = tuple(ws[k : k + n])
            least[w] = min(i, least.get(w, i))
    out = []
    for (i, _), ws in zip(rows, words):
        gone = set()
        for k in range(len(ws) - n + 1) if i is not None else ():
            if least[tuple(ws[k : k + n])] < i:
                gone |= set(range(k, k + n))
        out.append((i, len(ws), len(gone), sha(b" ".join(w for k, w in enumerate(ws) if k not in gone))))
    return Counter(out)


def test_repeated_windows_go(spark):
    rows = messy_rows()
    found = phrase_automata.remove_repeats(messy(spark))
    assert got(found) == windows_by_hand(rows)
    assert sum(r.n_removed for r in found.collect()) > 100


def test_repeated_windows_of_a_common_line(spark):
    line = " ".join(f"w{k}" for k in range(20))
    rows = [(i, f"a{i} b{i} {line} c{i} {line}") for i in range(60)]
    assert got(phrase_automata.remove_repeats(messy(spark, rows))) == windows_by_hand(rows)


def test_kept_text_is_returned(spark):
    rows = [(1, "a b c d e f"), (2, "x a b c d e f y")]
    found = phrase_automata.remove_repeats(messy(spark, rows), window=5, phrase=2, texts=True)
    assert {r.doc_id: r.kept for r in found.collect()} == {1: "a b c d e f", 2: "x y"}


def test_a_window_and_phrase_never_cross_documents(spark):
    rows = [(1, "a b c d e f g h i j k l m n o"), (2, "a b c d e f g"), (3, "h i j k l m n o p q r")]
    assert all(r.n_removed == 0 for r in phrase_automata.remove_repeats(messy(spark, rows)).collect())


# operator 3


def exact_by_hand(rows):
    groups = defaultdict(list)
    norm = lambda t: re.sub(rb"[A-Z]", lambda m: m[0].lower(), raw(t))
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[norm(t)]), i == keep, sha(norm(t))))
    return Counter(out)


def test_exact_groups(spark):
    assert got(exact_dedup.exact_groups(messy(spark))) == exact_by_hand(messy_rows())


def test_drop_exact_keeps_one_of_each(spark):
    docs = messy(spark)
    found = exact_dedup.drop_exact(docs)
    assert found.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in found.collect()]
    want = {(i, s) for i, k, _, kept, s in exact_by_hand(messy_rows()) if kept}
    assert sorted((str(i), sha(raw(t).lower())) for i, t in kept) == sorted((str(i), s) for i, s in want)


def test_cuts_follow_content():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 123, 200_000, dtype=np.uint8).tobytes()
    a, b = exact_dedup._chunks(body), exact_dedup._chunks(b"shifted" + body)
    assert b"".join(a) == body and len(set(a) & set(b)) > 0.8 * len(a)
    assert max(map(len, exact_dedup._chunks(b"x" * 300_000))) <= exact_dedup.LONGEST


def test_a_clash_of_identifiers_is_an_error(spark, monkeypatch):
    def clash(batches):
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([b"same"] * n), pa.array([str(i).encode() for i in range(n)])], ["id", "body"])

    monkeypatch.setattr(exact_dedup, "_bodies", clash)
    with pytest.raises(ValueError):
        exact_dedup.verify_chunks(messy(spark))


# operator 4


def fingerprint_by_hand(text):
    words = WORD.findall(raw(text).lower())
    shingles = [b" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_by_hand(rows, radius=4):
    prints = [fingerprint_by_hand(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= radius]
    root = roots(len(rows), links)
    least = {}
    for r, (i, _) in zip(root, rows):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return Counter((i, struct.unpack("<q", struct.pack("<Q", p))[0], least.get(r)) for (i, _), p, r in zip(rows, prints, root))


@pytest.mark.parametrize("tile", [8, 1 << 14])
def test_near_components(spark, tile):
    assert got(simhash_tiles.near_components(messy(spark), tile=tile)) == near_by_hand(messy_rows())


@pytest.mark.skipif(not have_tables(), reason="test tables are not there")
def test_near_components_of_the_test_table(spark):
    rows = [r[:2] for r in documents()]
    assert got(simhash_tiles.near_components(spark.read.parquet(f"{SF}/documents.parquet"))) == near_by_hand(rows)


def test_tile_links_find_every_close_pair():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    more = base[rng.integers(0, 300, 500)]
    for _ in range(3):
        more = more ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64))
    a, b = base, np.unique(more)
    x, y = simhash_tiles.tile_links(a, b, 4)
    every = np.concatenate([a, b])
    at = {v: i for i, v in reversed(list(enumerate(every.tolist())))}
    close = [(i, len(a) + j) for i, p in enumerate(a.tolist()) for j, q in enumerate(b.tolist()) if (p ^ q).bit_count() <= 4]
    found = [(at[p], at[q]) for p, q in zip(x.tolist(), y.tolist())]
    assert all((int(every[i]) ^ int(every[j])).bit_count() <= 64 for i, j in found)
    same = [(at[v], i) for i, v in enumerate(every.tolist())]
    assert roots(len(every), found + same) == roots(len(every), close + same)


def test_drop_near_keeps_one_of_each(spark):
    docs = messy(spark)
    found = simhash_tiles.drop_near(docs)
    assert found.columns == docs.columns
    want = {i for i, _, c in near_by_hand(messy_rows()) if i == c or i is None}
    assert {r.doc_id for r in found.collect()} == want


# operator 6


def bytes_by_hand(rows, n=200):
    seen = Counter()
    texts = [raw(t) for _, t in rows]
    for t in texts:
        seen.update(t[k : k + n] for k in range(len(t) - n + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - n + 1):
            if seen[t[k : k + n]] > 1:
                gone[k : k + n] = True
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, sha(bytes(b for b, g in zip(t, gone) if not g))))
    return Counter(out)


def test_repeated_bytes_go(spark):
    rows = messy_rows()
    found = column_bwt.remove_repeated_bytes(messy(spark))
    assert got(found) == bytes_by_hand(rows)


def test_repeated_bytes_of_periodic_and_shared_texts(spark):
    shared = "".join(chr(97 + (k * k + 3 * k) % 26) for k in range(230))
    rows = [(i, f"{i}" * (i % 7) + shared[i % 4 :] + f"-{i}-" * 30) for i in range(40)]
    rows += [(90, "abc" * 400), (91, "é" * 350), (92, "q" * 200), (93, "q" * 199), (94, shared * 3)]
    assert got(column_bwt.remove_repeated_bytes(messy(spark, rows))) == bytes_by_hand(rows)


def lines_in_other_surroundings(line, n=120):
    rng = np.random.default_rng(6)
    word = lambda k: "".join(map(chr, rng.integers(97, 123, k)))
    rows = [(i, word(260) + line + word(240)) for i in range(n)]
    return rows + [(n + i, "head" + rows[i][1][100 + i : -i]) for i in range(1, 9)]


@pytest.mark.parametrize("size", [40, 130, 199])
def test_repeated_bytes_around_a_hot_anchor(spark, size):
    rows = lines_in_other_surroundings("".join(chr(97 + (k * k + 5 * k) % 23) for k in range(size)))
    found = column_bwt.remove_repeated_bytes(messy(spark, rows), hot=16)
    assert got(found) == bytes_by_hand(rows) and sum(r.n_removed for r in found.collect()) > 1000
    assert got(column_bwt.remove_repeated_bytes(messy(spark, messy_rows()), hot=0)) == bytes_by_hand(messy_rows())


def test_a_hot_anchor_fills_no_bucket():
    texts = [t for _, t in lines_in_other_surroundings("".join(chr(97 + (k * k + 5 * k) % 23) for k in range(190)))]
    docs = pa.table({"doc_id": range(len(texts)), "text": texts, "shard": pa.array([0] * len(texts), pa.int32())})
    anchors = np.concatenate([part.anchors() for _, _, part in column_bwt._parts(docs, 200, 32)])
    values, times = np.unique(anchors, return_counts=True)
    hot = values[times > 60].view(np.int64)
    recurring = pa.table({"shard": pa.array([0], pa.int32()), "h": [hot], "a": [np.full(len(hot), 1_000_000)]})
    asked = column_bwt._ask_segments(200, 32, 128, 16)(docs, recurring).to_pylist()
    held = [sum(map(len, r["bodies"])) + 24 * len(r.get("h", ())) for r in asked]
    assert len(hot) and len(held) == 16 and max(held) < 1.3 * sum(held) / 16


def test_collection_is_the_sorted_order_of_suffixes():
    rng = np.random.default_rng(4)
    part = rng.integers(97, 99, 60, dtype=np.uint8).tobytes()
    bodies = [part + rng.integers(97, 99, rng.integers(20, 90), dtype=np.uint8).tobytes() for _ in range(12)]
    body, start, shared = column_bwt.collection(bodies, length=24, symbol=8)
    found = [bodies[b][s:] for b, s in zip(body, start)]
    assert len(found) == sum(len(b) - 23 for b in bodies)
    heads = [f[:24] for f in found]
    assert heads == sorted(heads)
    assert [a == b for a, b in zip(heads, heads[1:])] == [x >= 3 for x in shared[1:].tolist()]


@pytest.mark.parametrize("symbol", [4, 8, 20, 40])
def test_any_width_of_symbols_finds_the_same_windows(symbol, monkeypatch):
    monkeypatch.setattr(column_bwt, "SYMBOL", symbol)
    monkeypatch.setattr(column_bwt.collection, "__defaults__", (200, symbol))
    rng = np.random.default_rng(9)
    part = rng.integers(97, 123, 260, dtype=np.uint8).tobytes()
    bodies = [part, part[:205] + b"x" * 30, b"y" * 7 + part[30:], b"z" * 240, rng.integers(97, 123, 230, dtype=np.uint8).tobytes()]
    times = np.array([1, 1, 1, 1, 2])
    seen = Counter(b[k : k + 200] for b, n in zip(bodies, times) for k in range(len(b) - 199) for _ in range(n))
    want = {(i, k) for i, b in enumerate(bodies) for k in range(len(b) - 199) if seen[b[k : k + 200]] > 1}
    body, start = column_bwt.recurring_windows(bodies, times)
    assert set(zip(body.tolist(), start.tolist())) == want and len(body) == len(want)


# operator 7


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<float>, label int, node string, cell double").repartition(3)


def links_by_hand(rows, threshold=0.98):
    good = []
    for _, v, label in rows:
        x = None if v is None or label is None or any(e is None for e in v) else np.array(v, np.float32).astype(float)
        good.append(x if x is not None and len(x) and np.isfinite(x).all() and x.any() else None)
    links = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if good[a] is not None and good[b] is not None and rows[a][2] == rows[b][2] and len(good[a]) == len(good[b])
        and good[a] @ good[b] / (np.linalg.norm(good[a]) * np.linalg.norm(good[b])) >= threshold
    ]
    n = Counter(x for pair in links for x in pair)
    least = {}
    root = roots(len(rows), links)
    for r, row in zip(root, rows):
        least[r] = min([i for i in (row[0], least.get(r)) if i is not None], default=None)
    return Counter((row[0], n[k], least[r], row[0] == least[r]) for k, (r, row) in enumerate(zip(root, rows)))


def vector_rows():
    rng = np.random.default_rng(11)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(8)
        for _ in range(14):
            rows.append((len(rows), (centre + rng.standard_normal(8) * 0.12).astype(np.float32).tolist(), c % 3))
    rows += [(len(rows) + k, rows[5][1], rows[5][2]) for k in range(9)]
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 8, 1), (503, [1.0] * 7 + [float("nan")], 1), (504, [1.0, None], 1)]
    rows += [(505, rows[0][1], None), (506, [float("inf")] + [1.0] * 7, 1), (507, [1.0, 2.0], 1), (508, [2.0, 4.0], 1), (None, rows[20][1], rows[20][2])]
    return rows


@pytest.mark.parametrize("size", [{}, {"cell": 10, "most": 40, "width": 5}])
def test_linked_vectors(spark, size):
    rows = vector_rows()
    assert got(metric_join.linked_vectors(vectors(spark, rows), **size)) == links_by_hand(rows)


def scaled_copies(kind, n=60):
    rng = np.random.default_rng(2)
    base = rng.standard_normal(64)
    return [(base * x).astype(kind) for x in rng.uniform(0.1, 9, n)]


@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_parallel_pivots_lose_no_partner(kind):
    vecs = [v.astype(np.float64).tobytes() for v in scaled_copies(kind)]
    radius = float(np.sqrt(2 - 2 * metric_join.THRESHOLD))
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(vecs)), pa.array(vecs, pa.binary())], ["label", "vec"])
    lost = 0
    for k in range(0, 60, 6):
        placed = next(metric_join._places([(1, v) for v in vecs[k : k + 6]], radius)(iter([batch])))["places"].to_pylist()
        cells = [{p["cell"] for p in places} for places in placed]
        lost += sum(p["cell"] not in c for places in placed for p in places if p["home"] for c in cells)
    assert lost == 0


def test_links_of_scaled_copies(spark):
    rows = [(k, v.tolist(), 1) for k, v in enumerate(scaled_copies(np.float64))]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    found = metric_join.linked_vectors(docs, cell=5, most=12, width=20).collect()
    assert {tuple(r)[1:3] for r in found} == {(59, 0)} and len(found) == 60


# shared


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 200 + k) for k in range(20)] + [(300, 301), (301, 300), (7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(1, 31)} | {200 + k: 100 for k in range(20)} | {301: 300}


def test_forest_joins_as_union_find():
    rng = np.random.default_rng(0)
    forest, links = Forest(200), []
    for _ in range(12):
        i, j = rng.integers(0, 200, 9), rng.integers(0, 200, 9)
        forest.link(i, j)
        links += zip(i.tolist(), j.tolist())
    assert forest.root.tolist() == roots(200, links)


@pytest.mark.parametrize(
    "apply",
    [phrase_automata.remove_repeats, exact_dedup.exact_groups, exact_dedup.drop_exact, simhash_tiles.near_components, simhash_tiles.drop_near, column_bwt.remove_repeated_bytes],
)
def test_empty_tables(spark, apply):
    assert apply(empty(spark)).collect() == []


def test_empty_vectors(spark):
    assert metric_join.linked_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_hashes_of_runs_and_windows_of_short_empty_and_repeated_strings():
    """Words are hashed by slices of the prefix sums; a string that stands for two places recurs, short ones hold no window."""
    from panelwright.llm.column_bwt import recurring_windows
    from panelwright.llm.shards import run_hashes, span_hashes

    rng = np.random.default_rng(3)
    for n in (0, 1, 39, 40, 41, 500):
        values, at = rng.integers(0, 1 << 63, n, dtype=np.uint64), np.arange(max(0, n - 39))
        assert (run_hashes(values, 40) == span_hashes(values, at, at + 40)).all()
    raw = [bytes(rng.integers(97, 100, k, dtype=np.uint8)) for k in (0, 10, 199, 200, 260, 300, 0)]
    bodies = [*raw, raw[5][20:290] + raw[4], raw[4][5:] + b"x", b"q" * 240]
    times = np.array([3, 2, 2, 1, 1, 2, 1, 1, 1, 1], np.int64)
    counts = Counter()
    for body, k in zip(bodies, times.tolist()):
        for i in range(len(body) - 199):
            counts[body[i : i + 200]] += k
    body, start = recurring_windows(bodies, times)
    expected = {(b, i) for b, s in enumerate(bodies) for i in range(len(s) - 199) if counts[s[i : i + 200]] >= 2}
    assert set(zip(body.tolist(), start.tolist())) == expected and len(body) == len(expected)


def test_words_that_agree_in_their_upper_bits_keep_their_order():
    rng = np.random.default_rng(8)
    for n in (0, 1, 2, 7, 3000):
        far = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        near = (far[rng.integers(0, max(n, 1), n)] if n else far) ^ rng.integers(0, 4, n, dtype=np.uint64)  # lower bits differ alone
        for values in (far, near, far >> np.uint64(40)):
            assert (values[column_bwt._ordered(values)] == np.sort(values)).all()
            assert (column_bwt._ranks(values) == np.unique(values, return_inverse=True)[1]).all()


def test_no_string_is_laid_out_for_a_phase_that_holds_no_window():
    """A body of 200 bytes has one window, so one of 40 phases; words are numbered once for the cut and the columns."""
    rng = np.random.default_rng(6)
    bodies = [rng.integers(97, 123, 200, dtype=np.uint8).tobytes() for _ in range(50)]
    asked = []

    class Spied(np.ndarray):
        def __getitem__(self, at):
            asked.append(np.size(at))
            return np.asarray(super().__getitem__(at))

    ranks = column_bwt._ranks(column_bwt._words(np.frombuffer(b"".join(bodies) + bytes(40), np.uint8), 40)).view(Spied)
    body, start, _ = column_bwt.collection(bodies, ranks=ranks)
    assert sorted(body.tolist()) == list(range(50)) and not start.any()
    assert asked == [50] * 5


def test_segments_are_the_runs_of_one_anchor():
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 99, k, dtype=np.uint8).tobytes() for k in (0, 199, 200, 201, 900, 0, 3000)] + [b"a" * 700]
    for most in (1, 7, 128):
        part, want = column_bwt.Bytes(texts, 200, 32), []
        for begin, end in zip(part.begins.tolist(), part.ends.tolist()):
            for w in range(begin, end - 200):
                if want and want[-1][1] == w > begin and part.least[w] == part.least[w - 1] and w - want[-1][0] < most:
                    want[-1][1] += 1
                else:
                    want.append([w, w + 1])
        assert np.stack(part.segments(most), 1).tolist() == want
