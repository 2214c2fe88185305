"""Small tables with what real ones hold: nulls, empty and long texts, copies, clashing columns."""

import os

import duckdb

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, shard int, `key` string, fp string, "
    "_id long, _key long, block int, kept boolean, label int"
)


def messy_rows(seed=3):
    import random

    rng = random.Random(seed)
    vocabulary = ["alpha", "bêta", "gamma,", "the", "of", "Delta", "x1", "émile", "zz", "and", "run-on", "日本"]
    word = lambda: rng.choice(vocabulary) + str(rng.randint(0, 60))
    passage = [word() for _ in range(40)]
    block = " ".join(word() for _ in range(60))
    texts = [None, "", "   \n\t", "one", "a b c", "A b C", passage[0]]
    for n in range(40):
        words = [word() for _ in range(rng.randint(1, 90))]
        if n % 3 == 0:
            at = rng.randint(0, len(words))
            a, b = sorted(rng.sample(range(41), 2))
            words[at:at] = passage[a:b]
        sep = " " if n % 2 else rng.choice([" ", "  ", "\n", "\t"])
        texts.append(sep.join(words))
        if n % 7 == 0:
            texts.append(texts[-1])
        if n % 7 == 1:
            texts.append(texts[-1].upper())
        if n % 7 == 2:
            texts.append(texts[-1] + " tail")
        if n % 8 == 3:
            texts.append("pre" + str(n) + " " + block + " post")
    texts.append("ab" * 700)
    texts.append(" ".join(word() for _ in range(6000)))
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows.append(rows[5])
    rows += [(None, rows[9][1]), (None, None)]
    return rows


def messy(spark, rows=None):
    rows = messy_rows() if rows is None else rows
    full = [(i, t, "en" if (i or 0) % 3 else None, f"s{(i or 0) % 4}" if (i or 0) % 5 else None, None, 7, "k", "f", 1, 2, 3, None, 4) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def have_tables():
    return os.path.isdir(SF)
