"""Operators 2, 5, 8, 9, 10: held-out accuracy, exact round trips, brute force."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.llm import byte_bpe, byte_gru, pii_votes, quality_ordinal, temperature_mix

from .helpers import empty, messy, messy_rows

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")
sha = lambda b: hashlib.sha256(b).hexdigest()


# operator 2


def test_fit_orders_its_thresholds_and_learns():
    rng = np.random.default_rng(0)
    make = quality_ordinal.Features()
    rows, grades = [], []
    for n in range(600):
        words = [f"w{rng.integers(40)}" for _ in range(rng.integers(5, 60))]
        grade = n % 3
        if grade == 1:
            words[rng.integers(len(words))] = "scoundrel"
        if grade == 0:
            words = [w.upper() + "!!" for w in words]
        rows.append(make.row(" ".join(words).encode())), grades.append(grade)
    model = quality_ordinal.fit(rows[:450], np.array(grades[:450]))
    ends = np.cumsum([len(i) for i, _ in rows[450:]])
    tails = model.tails(model.score(np.concatenate([i for i, _ in rows[450:]]), np.concatenate([v for _, v in rows[450:]]), ends))
    assert model.thresholds[0] < model.thresholds[1] and (tails[:, 0] >= tails[:, 1]).all()
    assert np.mean((tails >= 0.5).sum(axis=1) == np.array(grades[450:])) > 0.95


@tables
def test_quality_ranks_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_ordinal.train(docs.where("doc_id % 3 <> 0"), labels)
    rated = {r.doc_id: r.tail for r in quality_ordinal.rate(docs, model).collect()}
    held = [(rated[r.doc_id], r.quality == 1 and r.toxic == 0) for r in labels.where("doc_id % 3 = 0").collect()]
    good, bad = [s for s, g in held if g], [s for s, g in held if not g]
    assert np.mean([a > b for a in good for b in bad]) > 0.75
    assert np.mean([s >= quality_ordinal.KEEP for s in good]) > 0.9


def test_quality_of_messy_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, None), (None, 1, 1), (7, 1, None), (900, 0, 1)], "doc_id long, quality int, toxic int")
    docs = messy(spark)
    model = quality_ordinal.train(docs, labels)
    found = quality_ordinal.rate(docs, model).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in messy_rows())
    assert all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 and r.kept == (r.tail >= quality_ordinal.KEEP) for r in found)
    kept = quality_ordinal.select_quality(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in found if r.kept)


def test_quality_without_labels_keeps_all(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_ordinal.select_quality(messy(spark), none).count() == len(messy_rows())
    assert quality_ordinal.select_quality(empty(spark), none).collect() == []


# operator 5


def test_gradients_are_those_of_the_loss():
    net = byte_gru.Network.fresh(["a", "b", "c"], units=3)
    for p in net.params:
        p *= 2
    codes = np.random.default_rng(0).integers(97, 103, (6, 5))
    codes[4:, 2] = 256
    target = np.array([0, 1, 2, 1, 0])
    _, grads = byte_gru.gradients(net, codes, target)
    rng = np.random.default_rng(1)
    for p, g in zip(net.params, grads):
        for _ in range(6):
            at = tuple(rng.integers(n) for n in p.shape)
            if p is net.inputs:
                at = (at[0], int(codes[rng.integers(6), 0]), at[2])
            old, step = p[at], 1e-2
            p[at] = old + step
            up, _ = byte_gru.gradients(net, codes, target)
            p[at] = old - step
            down, _ = byte_gru.gradients(net, codes, target)
            p[at] = old
            assert abs((up - down) / (2 * step) - g[at]) < 2e-3


@tables
def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    found = byte_gru.identify(docs).collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert len(held) > 100 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_sample_holds_every_language_and_no_copies(spark, monkeypatch):
    rows = [(i, "the same long text again " * 200, "en") for i in range(400)]
    rows += [(1000 + i, f"english text number {i} " * 90, "en") for i in range(900)]
    rows += [(3000 + i, f"texte rare {i} " * 20, "fr") for i in range(5)] + [(4000 + i, "lang " * 9000, "de") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    seen = {}
    monkeypatch.setattr(byte_gru, "learn", lambda texts, langs: seen.update(texts=texts, langs=langs))
    byte_gru.train(docs)
    may = {t for i, t, lang in rows if lang == "fr" and zlib.crc32(str(i).encode()) % 5}
    assert Counter(seen["langs"])["fr"] == len(may) and Counter(seen["langs"])["de"] == 1
    assert len(set(seen["texts"])) == len(seen["texts"]) <= byte_gru.SAMPLE
    assert 0.95 * byte_gru.SAMPLE_BYTES < sum(map(len, seen["texts"])) <= byte_gru.SAMPLE_BYTES
    byte_gru.train(docs, rows=6, size=900, longest=100)
    assert Counter(seen["langs"]).keys() == {"en", "fr", "de"} and len(seen["texts"]) <= 6
    assert sum(map(len, seen["texts"])) <= 900 and max(map(len, seen["texts"])) <= 100


def test_languages_of_messy_rows(spark):
    found = byte_gru.identify(messy(spark)).collect()
    texts = defaultdict(set)
    for i, t in messy_rows():
        texts[i].add(any(map(str.isalpha, t or "")))
    assert len(found) == len(messy_rows())
    assert all((r.lang_pred == "en" or False in texts[r.doc_id]) and (r.lang_pred == "en" or r.score == 0) for r in found)
    assert byte_gru.identify(empty(spark)).collect() == []
    unknown = byte_gru.identify(spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")).collect()
    assert [(r.lang_pred, r.score) for r in unknown] == [("und", 0.0)]


# operator 8


def mix_by_hand(rows, budget, a, **how):
    tokens = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for *_, t in rows]
    total = Counter()
    for (_, s, _), n in zip(rows, tokens):
        total[s] += n
    whole = sum(total.values())
    power = {s: (n / whole) ** a for s, n in total.items() if n}
    return {s: math.floor(p / sum(power.values()) * budget) for s, p in power.items()}, total, dict(zip([r[0] for r in rows], tokens))


@pytest.mark.parametrize("block", [5, 4096])
def test_mixture_meets_its_quotas(spark, block):
    rng = np.random.default_rng(3)
    rows = [(i, None if s == 3 else f"s{s}", "w " * int(rng.integers(0, 40))) for s, n in enumerate((300, 60, 20, 12)) for i in range(1000 * s, 1000 * s + n)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, block int").repartition(4)
    budget = 9000
    totals = docs.select(temperature_mix._source().alias("of"), temperature_mix.token_count().alias("n")).groupBy("of").sum("n").toDF("of", "tokens")
    a = temperature_mix.exponent(totals, budget)
    quota, total, tokens = mix_by_hand(rows, budget, a)
    found = temperature_mix.mixture(docs, budget, block=block).collect()
    used, copies = Counter(), defaultdict(Counter)
    for r in found:
        used[r.source] += r.n_tokens
        copies[r.source][r.doc_id] += 1
        assert r.n_tokens == tokens[r.doc_id]
    for s, q in quota.items():
        assert q <= used[s] < q + 40  # the last document in turn begins within the quota
        full = q // total[s]
        ids = [i for i, source, _ in rows if source == s]
        assert all(full <= copies[s][i] <= full + 1 for i in ids if tokens[i])
    assert len({(r.epoch, r.block_order, r.place) for r in found}) == len(found)
    shares = np.array([q for q in quota.values()]) / sum(quota.values())
    entropy = -(shares * np.log(shares)).sum()
    repeats = max(q / total[s] for s, q in quota.items())
    assert repeats <= temperature_mix.EPOCHS + 0.01
    assert entropy >= temperature_mix.ENTROPY * math.log(4) - 0.01 or repeats > temperature_mix.EPOCHS - 0.05


def replayed(spark, rows, budget, block, seed=temperature_mix.SEED):
    """The mixture by walking each source's permutation document by document; only the hashes are Spark's."""
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    totals = docs.select(temperature_mix._source().alias("of"), temperature_mix.token_count().alias("n")).groupBy("of").sum("n").toDF("of", "tokens")
    quota, total, tokens = mix_by_hand(rows, budget, temperature_mix.exponent(totals, budget))
    sizes = Counter(s for _, s, _ in rows)
    place = {s: (quota[s] // total[s], quota[s] % total[s], -(-sizes[s] // block)) for s in quota}
    ends = spark.createDataFrame([(s, full, blocks) for s, (full, _, blocks) in place.items()], "s string, full long, blocks long")
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    hashed = docs.join(ends, F.col("source").eqNullSafe(F.col("s"))).withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id", key), "blocks"))
    order = F.xxhash64(F.lit(seed), "full", temperature_mix._source(), "block").alias("order")
    turn = F.xxhash64(F.lit(seed + 1), "full", "doc_id", key).alias("turn")
    walk = sorted(tuple(r) for r in hashed.select(order, "block", turn, "doc_id", "source").collect())
    copies, so_far = Counter(), Counter()
    for _, _, _, i, s in walk:
        copies[i] += place[s][0] + (so_far[s] < place[s][1])
        so_far[s] += tokens[i]
    return quota, tokens, +copies


CASES = {
    "one long document among short ones": [(i, "a", "w " * 10) for i in range(2000)] + [(5000 + i, "b", "w " * 10) for i in range(40)] + [(6000, "b", "w " * 3000)],
    "a single document above its quota": [(i, "a", "w " * 10) for i in range(200)] + [(900, "b", "w " * 900)],
    "a source without tokens": [(i, "a", "w " * (i % 9)) for i in range(300)] + [(500, "none", ""), (501, "none", None), (502, None, "x y")],
}


@pytest.mark.parametrize("name, budget", list(zip(CASES, (6000, 1000, 1500))))
def test_mixture_walks_its_permutation(spark, name, budget):
    rows = CASES[name]
    quota, tokens, want = replayed(spark, rows, budget, 7)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    found = Counter(r.doc_id for r in temperature_mix.mixture(docs, budget, block=7).collect())
    assert found == want
    used = Counter()
    for i, s, _ in rows:
        used[s] += found[i] * tokens[i]
    longest = {s: max(tokens[i] for i, t, _ in rows if t == s) for s in quota}
    assert all(q <= used[s] < q + longest[s] for s, q in quota.items() if q)
    assert "none" not in {s for i, s, _ in rows if found[i]}


def test_exponent_by_entropy_and_by_limit(spark):
    totals = spark.createDataFrame([("a", 900), ("b", 90), ("c", 10)], "of string, tokens long")
    share = np.array([0.9, 0.09, 0.01])

    def entropy(a):
        w = share**a / (share**a).sum()
        return -(w * np.log(w)).sum()

    a = temperature_mix.exponent(totals, 10, entropy=0.6, epochs=1e9)
    assert abs(entropy(a) - 0.6 * math.log(3)) < 1e-4
    limited = temperature_mix.exponent(totals, 1000, entropy=0.99, epochs=2.0)
    w = share**limited / (share**limited).sum()
    assert abs((w / share).max() - 2.0) < 1e-3
    assert temperature_mix.exponent(totals, 5000, epochs=2.0) == 1.0
    assert temperature_mix.exponent(totals, 10, entropy=0.1) == 1.0


def test_mixed_documents_of_messy_rows(spark):
    docs = messy(spark)
    mixed = temperature_mix.mixed_documents(docs)
    assert mixed.columns == docs.columns
    listed = temperature_mix.mixture(docs).collect()
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(r.doc_id for r in listed)
    again = temperature_mix.mixture(docs.repartition(7)).collect()
    assert Counter(map(tuple, listed)) == Counter(map(tuple, again))
    assert temperature_mix.mixed_documents(empty(spark)).collect() == []
    assert temperature_mix.mixture(spark.createDataFrame([(1, None, "s")], "doc_id long, text string, source string")).collect() == []


# operator 9

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.codec(PATH).ranks, special_tokens={})


def test_pieces_and_ids_of_odd_texts(reference):
    import random

    rng = random.Random(1)
    signs = "aZéß'stmdrevl  \n\t\xa0　 09٣!?.-中あ😀\x1c\x85'ʼ "
    codec = byte_bpe.Codec(PATH)
    for _ in range(60):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 80))) for _ in range(20)]
        ids = codec.encode(texts)
        assert ids == [reference.encode_ordinary(t) for t in texts]
        assert [codec.decode(x) for x in ids] == [t.encode() for t in texts]


def test_every_code_point(reference):
    points = [chr(x) for x in [*range(0xD800), *range(0xE000, 0x110000)]]
    texts = ["".join(f"a{c}1{c} {c}!" for c in points[i : i + 4000]) for i in range(0, len(points), 4000)]
    assert byte_bpe.Codec(PATH).encode(texts) == [reference.encode_ordinary(t) for t in texts]


def test_long_runs_and_a_small_cache(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 20)
    texts = ["x" * 3000 + "ab" * 900, " " * 700, "word " * 300, *[f"n{i} {i * i}" for i in range(90)], "zq" * 300]
    assert byte_bpe.Codec(PATH).encode(texts) == [reference.encode_ordinary(t) for t in texts]


def test_round_trip_and_offsets(spark, reference):
    docs = messy(spark)
    want = Counter()
    for i, t in messy_rows():
        ids = reference.encode_ordinary(t or "")
        want[(i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode()))] += 1
    assert Counter(tuple(r) for r in byte_bpe.round_trip(docs, PATH).collect()) == want
    encoded = byte_bpe.encode(docs, PATH)
    texts = defaultdict(set)
    for i, t in messy_rows():
        texts[i].add((t or "").encode())
    words = byte_bpe.codec(PATH).words
    for r in encoded.collect():
        assert (r.ends[-1] if r.ends else 0) in {len(t) for t in texts[r.doc_id]}
        assert [b - a for a, b in zip([0, *r.ends], r.ends)] == [len(words[i]) for i in r.ids]
    assert all(bytes(r.data) in texts[r.doc_id] for r in byte_bpe.decode(encoded, PATH).collect())
    assert byte_bpe.round_trip(empty(spark), PATH).collect() == []


# operator 10

PII_ROWS = [
    (1, "Mail x.y+z@site-1.example.com, call +1 (555) 010-2345; from 10.0.0.256 and 192.168.001.12."),
    (2, "Card 4111 1111 1111 1111, not 4111 1111 1111 1112, nor 1-2-3. IP 1.2.3.4.5.6.7.8"),
    (3, "é+49 30 1234567 ü a@b@c.de 4111111111111111a +1-2 ++12345678901234567"),
    (4, None),
    (5, ""),
    (6, "card 5500 0000 0000 0005 phone (555) 123-4567 or mail bob [at] site [dot] com"),
    (None, "a@b.cc"),
    (1, "a@b.cc 255.255.255.255"),
]


def base_by_hand(text):
    text = text or ""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    luhn = lambda d: sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [(k, *m.span()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m[0])]


def check_spans(found, rows):
    texts = {(i, sha(",".join(f"{k}:{s}:{e}" for k, s, e in base_by_hand(t)).encode())): t for i, t in rows}
    assert len(found) == len(rows)
    for r in found:
        base = base_by_hand(texts[r.doc_id, r.base_sha256])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, *_ in base) for k in pii_votes.KINDS]
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda x: (pii_votes.KINDS.index(x[0]), x[1]))
        more = sorted(x[1:] for x in spans if x not in base)
        assert all(a[1] <= b[0] for a, b in zip(more, more[1:]))
        assert all(e <= s or b <= a for a, e in more for _, s, b in base if not e <= s)


def test_spans_of_odd_texts(spark):
    check_spans(pii_votes.find_personal_data(messy(spark, PII_ROWS)).collect(), PII_ROWS)
    check_spans(pii_votes.find_personal_data(messy(spark)).collect(), messy_rows())
    assert pii_votes.find_personal_data(empty(spark)).collect() == []


@tables
def test_spans_of_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = pii_votes.find_personal_data(docs).collect()
    check_spans(found, rows)
    assert sum(r.n_phone for r in found) > 5


def test_reliabilities_find_the_better_labeler():
    rng = np.random.default_rng(5)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < right, truth + 1, 2 - truth) for right in (0.95, 0.9, 0.6)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    table, p = pii_votes.reliabilities(patterns, counts.astype(float))
    right = [(table[1, j, 2] + table[0, j, 1]) / 2 for j in range(3)]
    assert right[0] > right[1] > right[2] and abs(right[0] - 0.95) < 0.04
    by = {tuple(k): q for k, q in zip(patterns.tolist(), p)}
    assert np.mean([(by[tuple(v)] > 0.5) == t for v, t in zip(votes.tolist(), truth)]) > 0.93


@pytest.mark.parametrize("unit", ["a", "7", "ab(", "1.", "a@", "+1(", "x.", "0 ", "a@b.c_", "5-5-", "(at)", "a [at] b", "12 345-6789 ", "0" * 5000 + "1."])
def test_spans_of_a_megabyte_of_anything_in_linear_time(unit):
    import time

    for text in (unit * (1_000_000 // len(unit)), "@ (" + unit * (1_000_000 // len(unit)) + " a@b.cc"):
        start = time.process_time()
        base = pii_votes.base_spans(text)
        pii_votes.candidates(text, base)
        assert time.process_time() - start < 6  # quadratic scans take minutes


def test_base_spans_of_touching_runs():
    rng = np.random.default_rng(8)
    for alphabet in ("a@.b_ ", "1. 2", "+1( ).", "a@b.c-1 +(["):
        for _ in range(3000):
            text = "".join(rng.choice(list(alphabet), rng.integers(0, 24)))
            assert sorted(pii_votes.base_spans(text)) == sorted(base_by_hand(text)), text


ADDED = ["phone (555) 123-4567", "call me: 212-555-0187", "tel. 415.555.2671 now", "card 4111.1111.1111.1111", "mail bob [at] site [dot] com", "contact eve (at) mail.org", "fax (030) 555 1234"]
REFUSED = ["order no. 12 3456789", "version 1.2345678", "key 98.70157079", "card 9870157079875996", "token 1 2 3 4 5 6 7 8 9", "page 1234567", "secret 4111.1111.1111.1112"]


@pytest.mark.parametrize("times", [1, 400])
def test_what_is_added_does_not_hang_on_the_size_of_the_table(spark, times):
    lines = [*ADDED, *REFUSED, "write to a.b@c.com", "visa 4111 1111 1111 1111", "phone +1 555 010 9999", "host 10.0.0.7", "nothing at all"]
    docs = spark.createDataFrame([(i + 100 * k, t) for k in range(times) for i, t in enumerate(lines)], "doc_id long, text string")
    found = {r.doc_id: r for r in pii_votes.find_personal_data(docs).collect()}
    spans = [found[i].spans for i in range(len(lines))]
    more = [bool(s) and not (r.n_email or r.n_ip or r.n_card or r.n_phone) for s, r in zip(spans, (found[i] for i in range(len(lines))))]
    assert more[: len(ADDED)] == [True] * len(ADDED)
    assert more[len(ADDED) : len(ADDED) + len(REFUSED)] == [False] * len(REFUSED)


def test_mask():
    assert pii_votes.mask("to a@b.cc or +1 555 010 9999.", "email:3:9,phone:13:28") == "to [email] or [phone]."
