"""The stages one by one against brute force, and the registered queries."""

import inspect
from collections import Counter

import __spark_entry__ as entry_file
import corpus_pipeline
from panelwright.llm import quality_ordinal, simhash_tiles

from .helpers import SF, empty, messy
from .test_dedup import exact_by_hand, near_by_hand


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mix", "tokens"]
    names = [k for k in entry_file.queries() if k.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_file.queries()
    assert all(len(inspect.signature(f).parameters) == 3 for _, f in corpus_pipeline.STAGES)


def test_stages_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    pairs = lambda df: [(r.doc_id, r.text) for r in df.collect()]

    kept = stages["quality"](spark, docs, SF)
    model = quality_ordinal.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r.doc_id for r in quality_ordinal.rate(docs, model).collect() if r.kept}
    assert kept.columns == columns and {i for i, _ in pairs(kept)} == want

    exact = stages["exact"](spark, kept, SF)
    want = {i for i, _, _, stays, _ in exact_by_hand(pairs(kept)) if stays}
    assert exact.columns == columns and Counter(i for i, _ in pairs(exact)) == Counter(want)

    near = stages["near"](spark, exact, SF)
    want = {i for i, _, c in near_by_hand(pairs(exact)) if i == c}
    assert near.columns == columns and Counter(i for i, _ in pairs(near)) == Counter(want)

    mixed = stages["mix"](spark, near, SF)
    assert mixed.columns == columns and {i for i, _ in pairs(mixed)} <= want

    tokens = stages["tokens"](spark, mixed, SF)
    assert Counter(r.doc_id for r in tokens.collect()) == Counter(i for i, _ in pairs(mixed))
    whole = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, tokens.collect()))


def test_stages_on_messy_and_empty_rows(spark, tmp_path):
    labels = str(tmp_path / "labels.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(labels)
    for docs in (messy(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            docs.collect()
    assert simhash_tiles.RADIUS == 4
