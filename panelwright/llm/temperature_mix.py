"""Mixing sources to target weights by temperature (operator 8).

Each source's share of all tokens is raised to an exponent a between 0 and 1 and normalised.
The exponent is bisected: the largest a whose weights have the wanted entropy, raised where a
source would otherwise be repeated more often than allowed (the limit wins). Every bisection
round is one aggregate over per-source totals that tries fifteen exponents, four halvings at
once; no list of sources comes to the driver.

Weights are realised as block permutations under a token budget. A source's documents are
dealt into blocks by hash; an epoch is a permutation of the blocks and of the documents
within each. A source runs through its whole epochs and, in the last one, through the
blocks in order until its quota is used: block totals tell which blocks are in, and only the
block on the edge is summed document by document. So a source with a third of all rows is
never gathered in one place; the largest group is one block.

Defined results: a null source is a source of its own. A document is taken in the last epoch if
it begins within the quota, so a source gets its quota and at most the rest of the one document that
crosses it, however long; a source whose only document is above its quota is in the mixture. Null
and empty texts have no tokens and ride along with their block. A source without any tokens has no
share to be given, and its documents are left out. If the budget is above what the limit allows even
at a = 1, a is 1. Repeated rows are separate documents of the source; of rows that agree in id, source
and text the first by a hash of all columns have the copies that can't be shared out evenly. An empty
table, or one without tokens, gives no rows.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import stage, text_key

ENTROPY = 0.95  # of the entropy of equal weights
EPOCHS = 4.0  # times that a document may be seen, at most
BLOCK = 4096  # documents of a block, on average at most
SEED = 7
_ROUNDS = 9  # of four halvings each
WORD = r"[^\x20\x09-\x0D]+"


def token_count() -> Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint")


def _source() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))


def exponent(totals: DataFrame, budget: int, entropy: float = ENTROPY, epochs: float = EPOCHS) -> float:
    """The exponent for per-source totals (tokens)."""
    whole, n = totals.where("tokens > 0").agg(F.sum("tokens"), F.count("*")).first()
    if not n:
        return 1.0
    share = totals.where("tokens > 0").select((F.col("tokens") / F.lit(float(whole))).alias("s"))

    def measure(tries: list[float]) -> list[tuple[float, float]]:
        """Entropy, and epochs of the most repeated source, for each exponent."""
        columns = []
        for i, a in enumerate(tries):
            p = F.pow("s", F.lit(a))
            columns += [F.sum(p).alias(f"z{i}"), F.sum(p * F.log("s")).alias(f"l{i}"), F.max(F.pow("s", F.lit(a - 1))).alias(f"m{i}")]
        row = share.agg(*columns).first()
        return [
            (float(log(row[f"z{i}"]) - a * row[f"l{i}"] / row[f"z{i}"]), budget / whole * row[f"m{i}"] / row[f"z{i}"])
            for i, a in enumerate(tries)
        ]

    wanted = entropy * log(n)

    def bisect(good_low: bool, good) -> float:
        """The edge of good between 0 and 1; good holds below it if good_low, else above."""
        low, high = 0.0, 1.0
        ends = measure([low, high])
        if good(ends[1] if good_low else ends[0]):
            return high if good_low else low
        for _ in range(_ROUNDS):
            tries = [low + (high - low) * k / 16 for k in range(1, 16)]
            fits = [good(x) for x in measure(tries)]
            k = sum(fits)  # monotone: the good ones lie together
            edge = k if good_low else 15 - k
            grid = [low, *tries, high]
            low, high = grid[edge], grid[edge + 1]
        return low if good_low else high

    a = bisect(True, lambda x: x[0] >= wanted - 1e-12)
    return max(a, bisect(False, lambda x: x[1] <= epochs * (1 + 1e-12)))


def mixture(docs: DataFrame, budget: int | None = None, entropy: float = ENTROPY, epochs: float = EPOCHS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """One row per copy of a document in the mixture.

    doc_id, source, key (hash of the text), n_tokens, epoch, block_order, place: sort by
    (epoch, block_order, place) for the training order. The budget is in tokens, by default
    those of the corpus.
    """
    rows = stage(docs.select("doc_id", "source", text_key().alias("key"), _source().alias("of"), token_count().alias("n_tokens")), "tokens")
    totals = stage(rows.groupBy("of").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "totals")
    if budget is None:
        budget = totals.agg(F.sum("tokens")).first()[0] or 0
    a = exponent(totals, budget, entropy, epochs)
    some = totals.where("tokens > 0")
    whole = some.agg(F.sum("tokens")).first()[0] or 1
    power = F.pow(F.col("tokens") / F.lit(float(whole)), F.lit(a))
    z = some.agg(F.sum(power)).first()[0] or 1.0
    plan = some.select(
        "of",
        F.ceil(F.col("docs") / block).alias("blocks"),
        F.floor(power / F.lit(z) * F.lit(float(budget))).alias("quota"),
        "tokens",
    ).select("of", "blocks", F.expr("quota div tokens").alias("full"), F.expr("quota % tokens").alias("rest"))

    dealt = rows.join(plan, "of").withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "key"), "blocks"))
    dealt = dealt.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full"))))
    dealt = dealt.withColumn("block_order", F.xxhash64(F.lit(seed), "epoch", "of", "block"))
    dealt = dealt.withColumn("turn", F.xxhash64(F.lit(seed + 1), "epoch", "doc_id", "key"))
    in_block = Window.partitionBy("of", "epoch", "block").orderBy("turn", "doc_id", "key").rowsBetween(Window.unboundedPreceding, 0)
    dealt = dealt.withColumns({"place": F.row_number().over(in_block), "sum_in": F.sum("n_tokens").over(in_block)})

    last = rows.join(plan, "of").withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "key"), "blocks"))
    sums = last.groupBy("of", "block", "full").agg(F.sum("n_tokens").alias("in_block"))
    sums = sums.withColumn("order", F.xxhash64(F.lit(seed), F.col("full"), "of", "block"))
    before = Window.partitionBy("of").orderBy("order", "block").rowsBetween(Window.unboundedPreceding, -1)
    edges = sums.select(
        "of", "block", F.col("full").alias("epoch"), F.coalesce(F.sum("in_block").over(before), F.lit(0)).alias("before")
    )
    chosen = dealt.join(edges, ["of", "block", "epoch"], "left").where(
        (F.col("epoch") < F.col("full")) | ((F.col("rest") > 0) & (F.col("before") + F.col("sum_in") - F.col("n_tokens") < F.col("rest")))
    )
    return chosen.select("doc_id", "source", "key", "n_tokens", "epoch", "block_order", "place")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """Docs as the mixture has them: rows left out or repeated, columns as they came."""
    key = ["doc_id", "source", "key"]
    copies = mixture(docs, **how).groupBy(key).agg(F.count("*").alias("copies"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", text_key().alias("key"))
    # rows that repeat id, source and text share their copies: whole ones go to each, the rest to the first
    alike = rows.groupBy(key).agg(F.count("*").alias("rows"))
    same = lambda a, b: F.expr(f"{a}.key = {b}.key AND {a}.doc_id <=> {b}.doc_id AND {a}.source <=> {b}.source")
    counts = stage(copies.alias("c").join(alike.alias("s"), same("c", "s")).select(*[f"c.{k}" for k in key], "copies", "rows"), "copies")
    joined = rows.alias("r").join(counts.alias("c"), same("r", "c")).select("r.*", "copies", "rows")
    if counts.where("rows > 1").isEmpty():
        joined = joined.withColumn("nth", F.lit(1))
    else:
        joined = joined.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64("row"))))
    times = F.expr("copies div rows + if(nth <= copies % rows, 1, 0)")
    return joined.withColumn("times", times).where("times > 0").withColumn("copy", F.explode(F.expr("sequence(1L, times)"))).select("row.*")
