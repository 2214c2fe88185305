"""Operators 11, 12, 13: brute force, held-out accuracy, exact pairs, messy and empty rows."""

import hashlib
import itertools
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_file
from panelwright.llm import factor_machine, k2_treap, merkle_rollup

from .helpers import empty, messy, messy_rows

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def sql_rows(name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(entry_file.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    return [dict(zip(columns, r)) for r in cur.fetchall()]


def same_rows(df, want):
    got = [r.asDict() for r in df.collect()]
    order = lambda rows: sorted((sorted(r.items(), key=lambda x: x[0]) for r in rows), key=str)
    assert order(got) == order(want)


# operator 11


def test_pair_sum_is_the_sum_over_pairs():
    rng = np.random.default_rng(4)
    machine = factor_machine.Machine(-0.3, np.arange(12), rng.normal(size=12), rng.normal(size=(12, 3)))
    texts = [[0, 3, 7], [], [5], list(range(12)), []]
    at, value = np.array(sum(texts, [])), rng.uniform(1, 3, 16)
    got, k = machine.logits(at, value, np.array([len(t) for t in texts])), 0
    for j, text in enumerate(texts):
        x, k = value[k : k + len(text)], k + len(text)
        want = -0.3 + sum(machine.weights[i] * v for i, v in zip(text, x))
        for (i, a), (l, b) in itertools.combinations(list(zip(text, x)), 2):
            want += machine.factors[i] @ machine.factors[l] * a * b
        assert math.isclose(got[j], want, rel_tol=1e-9, abs_tol=1e-9)


def test_learns_a_pair_that_no_additive_weights_can():
    """Toxic where exactly both or none of two terms occur: each alone says nothing."""
    rows = [([i for i, there in enumerate(x) if there] + [2], [1] * (sum(x) + 1)) for x in itertools.product((0, 1), repeat=2)] * 80
    toxic = np.array([int(a == b) for a, b in itertools.product((0, 1), repeat=2)] * 80)
    machine = factor_machine.fit(np.arange(3), rows, toxic, passes=150)
    at, value, sizes = factor_machine._gather(rows[:4])
    assert ((machine.logits(at, value, sizes) > 0) == toxic[:4].astype(bool)).all()
    machine.factors[:] = 0
    assert ((machine.logits(at, value, sizes) > 0) != toxic[:4].astype(bool)).any()


def test_stems_are_told_from_words_and_signs_do_not_matter():
    batch = pa.RecordBatch.from_pydict({"text": ["Idiot!IDIOT,x9%%idiot", None, "", "ÉCOLE école"]})
    found = list(factor_machine.words(batch))
    assert found == [Counter({b"idiot": 3, b"x": 1}), Counter(), Counter(), Counter({"école".encode(): 2})]
    assert len(factor_machine.terms(b"abc")) == 1 and len(set(factor_machine.terms(b"abcdefgh"))) == 5
    assert factor_machine.terms(b"abcd")[1] != factor_machine.terms(b"abc")[0]


@tables
def test_toxicity_of_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/../sf0.1/documents.parquet"), spark.read.parquet(f"{SF}/../sf0.1/labels.parquet")
    found = {r.doc_id: r for r in factor_machine.rate_toxicity(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for i, r in found.items())
    held = [(r.toxic, found[r.doc_id].predicted) for r in labels.collect() if found[r.doc_id].held_out]
    hits, toxic, said = sum(t and p for t, p in held), sum(t for t, _ in held), sum(p for _, p in held)
    assert hits / toxic > 0.85 and hits / said > 0.97  # labels of junk are noisy


@tables
def test_labels_that_are_held_out_do_not_matter(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    turned = labels.withColumn("toxic", F.when(factor_machine.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted(factor_machine.rate_toxicity(docs, x).collect()) for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_toxicity_of_messy_and_empty_rows(spark):
    rows = [(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (7, 1, None), (900, 0, 1), *((i, 1, i % 2) for i in range(10, 40))]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    found = factor_machine.rate_toxicity(messy(spark), labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in messy_rows())
    assert all(0 <= r.score <= 1 for r in found) and [r.held_out for r in found if r.doc_id is None] == [False, False]
    alike = {r.score for r in found if r.doc_id in (0, 1, 2)}  # null, empty, blanks
    assert len(alike) == 1
    none = factor_machine.rate_toxicity(messy(spark), labels.where("toxic = 0")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert factor_machine.rate_toxicity(empty(spark), labels).collect() == []
    assert factor_machine.rate_toxicity(messy(spark), labels.limit(0)).count() == len(messy_rows())


# operator 12


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, i):
    out = []
    for nodes in tree[:-1]:
        at = i // 8 * 8
        out.append((nodes[at:i], nodes[i + 1 : at + 8]))
        i //= 8
    return out


def manifest_by_hand(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = lambda t: None if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)
    by = defaultdict(list)
    for id, source, lang, n, text in rows:
        leaf = digest(*map(field, (id, source, lang, n, text)))
        hit = id is not None and zlib.crc32(str(id).encode()) % 3 == 0
        by[lang].append((id is not None, id or 0, leaf, digest(*map(field, (id, source, lang, n, lower(text)))) if hit else leaf, id))
    order = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: levels([r[2] for r in sorted(by[k])]) for k in order}
    top = levels([trees[k][-1][0] for k in order])
    out = []
    for at, k in enumerate(order):
        for i, (_, _, leaf, changed, id) in enumerate(sorted(by[k])):
            path = siblings(trees[k], i) + siblings(top, at)
            h = changed
            for left, right in path:
                h = digest(*left, h, *right)
            proof = digest(*(x for left, right in path for x in (*left, *right)))
            root = top[-1][0]
            out.append(
                {"doc_id": id, "leaf": leaf, "subroot": trees[k][-1][0], "root": root, "proof_sha256": proof, "folded_root": h, "verified": h == root}
            )
    return out


def as_rows(df):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]


@tables
def test_manifest_matches_its_sql(spark):
    found = merkle_rollup.manifest(read(spark, "documents"))
    same_rows(found, sql_rows("op12_merkle_rollup"))


def test_manifest_of_messy_and_empty_rows(spark):
    docs = messy(spark)
    same_rows(merkle_rollup.manifest(docs), manifest_by_hand(as_rows(docs)))
    assert merkle_rollup.manifest(empty(spark)).collect() == []
    assert merkle_rollup.manifest(empty(spark)).columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("sizes", [[1], [1, 1], [8, 9], [513, 64, 1], [4097]])
def test_manifest_of_trees_of_many_sizes(spark, sizes):
    """A lone leaf, full runs, a last run of one, a tree of several blocks."""
    rows = [(100_000 * k + i, "S", None if k == 1 else f"l{k}", None, f"Text {i} É") for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    found = merkle_rollup.manifest(docs)
    same_rows(found, manifest_by_hand(rows))
    verified = Counter(r.verified for r in found.collect())
    assert verified[False] == sum(zlib.crc32(str(r[0]).encode()) % 3 == 0 for r in rows)


def test_manifest_of_hundreds_of_languages(spark):
    rows = [(i, "s", f"l{i % 600}", i, "a") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    same_rows(merkle_rollup.manifest(docs), manifest_by_hand(rows))


def test_manifest_runs_no_python(spark):
    plan = merkle_rollup.manifest(messy(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# operator 13


def search_by_hand(docs, items, k=10):
    """docs: (doc_id, text); items: (item_id, text)."""
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(id, Counter(find(t))) for id, t in docs]
    bags = [(id, b) for id, b in bags if b]
    count, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for id, b in bags:
            m = 10 + 90 * sum(b.values()) * count // length
            s = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (1000000000 * b[t] // (1000 * b[t] + 8 * m)) for t in set(find(text)) if t in b
            )
            if s > 0:
                scored.append((-s, id is None, id or 0, id))
        out += [{"item_id": item, "rank": r + 1, "doc_id": x[3], "score": -x[0]} for r, x in enumerate(sorted(scored)[:k])]
    return out


def test_treap_keeps_every_cell_and_its_maxima():
    rng = np.random.default_rng(5)
    for rows, columns, n in ((1, 1, 1), (9, 3, 12), (40, 300, 900), (500, 5, 700)):
        cells = rng.choice(rows * columns, min(n, rows * columns), replace=False)
        row, column, value = cells // columns, cells % columns, rng.integers(1, 1_000_000, len(cells))
        packed = k2_treap.Treap.build(row, column, value).pack()
        treap = k2_treap.Treap.unpack(*packed)
        assert len(treap.maxima[-1]) == len(cells) and treap.maxima[0].tolist() == [value.max()]
        search = k2_treap.Search(*packed)
        for _ in range(20):
            own = rng.choice(rows, rng.integers(1, min(rows, 6) + 1), replace=False)
            weights = rng.integers(1, 9, len(own))
            score = Counter()
            for r, w in zip(own, weights):
                for c, v in zip(column[row == r], value[row == r]):
                    score[int(c)] += int(w * v)
            want = sorted(((s, c) for c, s in score.items()), key=lambda x: (-x[0], x[1]))[:4]
            assert search.best(own, weights, 4) == want


def test_equal_scores_go_by_column_however_many_there_are():
    treap = k2_treap.Treap.build(np.zeros(5000, int), np.arange(5000), np.full(5000, 7))
    assert k2_treap.Search(*treap.pack()).best(np.array([0]), np.array([2]), 3) == [(14, 0), (14, 1), (14, 2)]


def test_search_looks_at_a_small_part_of_the_grid():
    rng = np.random.default_rng(6)
    column = np.flatnonzero(rng.random(1 << 14) < 0.3)
    value = rng.integers(1, 50, len(column))
    value[100] = 10_000
    search = k2_treap.Search(*k2_treap.Treap.build(np.full(len(column), 3), column, value).pack())
    looked, below = [], search.below
    search.below = lambda level, at, quarter: (looked.append(len(at)), below(level, at, quarter))[1]
    assert search.best(np.array([3]), np.array([1]), 1) == [(10_000, int(column[100]))]
    assert sum(looked) < len(column) / 4


@tables
def test_search_matches_its_sql(spark):
    found = k2_treap.ranked_documents(read(spark, "documents"), read(spark, "benchmark"))
    same_rows(found, sql_rows("op13_k2_treap"))


def test_search_of_messy_and_empty_rows(spark, monkeypatch):
    rows = messy_rows()
    items = [(1, "alpha7 THE12 gamma3"), (2, None), (3, "no such terms"), (4, rows[20][1]), (5, "the1 " * 50), (None, "日本4 bêta9")]
    items += [(10 + i, t) for i, (_, t) in enumerate(rows[:30])]
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    want = search_by_hand(rows, items)
    same_rows(k2_treap.ranked_documents(messy(spark), table), want)
    monkeypatch.setattr(k2_treap, "BLOCK_ITEMS", 7)
    same_rows(k2_treap.ranked_documents(messy(spark), table), want)
    same_rows(k2_treap.ranked_documents(messy(spark), spark.createDataFrame([*items, items[0]], "item_id long, text string")), want)
    assert k2_treap.ranked_documents(empty(spark), table).collect() == []
    assert k2_treap.ranked_documents(messy(spark), table.limit(0)).collect() == []


def test_shards_are_bounded_and_hold_every_row():
    rows = [(i, f"word{i % 50} " * (1 + i % 9)) for i in range(300)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": [t for _, t in rows]})
    old, k2_treap.SHARD_BYTES = k2_treap.SHARD_BYTES, 1000
    try:
        shards = list(k2_treap._shards(iter([batch])))
    finally:
        k2_treap.SHARD_BYTES = old
    assert len(shards) > 5
    assert sorted(i for s in shards for i in s.column("ids")[0].as_py()) == list(range(300))
    assert all(s.column("length")[0].as_py() * 6 < 1200 for s in shards)
