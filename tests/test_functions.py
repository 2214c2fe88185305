import math
import random
import re
import unicodedata

from pyspark.sql import functions as F

from panelwright import functions as fn


def apply(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_casefold_key_follows_python(spark):
    def expected(s):
        return "" if s is None else re.sub(r"\s+", " ", s).strip().casefold()

    names = [
        None,
        "",
        "  Côte  d'Ivoire ",
        "TÜRKIYE \t x",
        "STRAẞE straße",
        "ΣΑΣ ΟΔΟΣ",
        "ılık İstanbul",
        "a\x1cb c\n",
        "ﬁn ŉ ǰ",
    ]
    names += [f"A{chr(c)} {chr(c)}b" for c in range(0x20, 0x2FFF) if not 0x13A0 <= c <= 0x13FF and c != 0x1C89]
    assert apply(spark, names, "string", fn.casefold_key) == [expected(s) for s in names]


def test_accent_fold_follows_python(spark):
    def expected(s):
        folded = unicodedata.normalize("NFKD", s or "").encode("ascii", "ignore").decode()
        return folded.upper().strip()

    names = [None, "São Tomé and Príncipe", "Türkiye ", "Curaçao", "CO₂ ½ ﬁ ß…", "中国"]
    assert apply(spark, names, "string", fn.accent_fold) == [expected(s) for s in names]


def test_parse_number(spark):
    cells = ["0,360", "..", "1.085.191", "-12,5%", "+7", "ca. 3", "", None, "—", "5."]
    assert apply(spark, cells, "string", fn.parse_number) == [
        0.36, None, 1.085, -12.5, 7.0, 3.0, None, None, None, 5.0,
    ]


def test_extract_year(spark):
    cells = ["2022/2023 M", "2019 M", "—", None, "x1899 1901", "2105"]
    assert apply(spark, cells, "string", fn.extract_year) == [2022, 2019, None, None, 1901, None]


def test_to_double_takes_whole_numbers_only(spark):
    cells = ["1.5", " 2e3 ", "1d", "1f", "NaN", "inf", "x", "", None, "-.5", "1,5"]
    assert apply(spark, cells, "string", fn.to_double) == [
        1.5, 2000.0, None, None, None, None, None, None, None, -0.5, None,
    ]


def test_round_exact_is_python_round(spark):
    rng = random.Random(7)
    values = [2.675, 1.005, 0.125, 0.375, -2.675, -0.125, 1e9 + 0.005, 0.0, 12.345, 4887.915]
    values += [rng.uniform(-1e6, 1e6) for _ in range(2000)]
    values += [rng.randrange(-(10**7), 10**7) / 1000 for _ in range(4000)]
    assert apply(spark, values, "double", lambda c: fn.round_exact(c, 2)) == [round(v, 2) for v in values]


def test_round_scaled_and_scaled_int_round_half_even(spark):
    values = [0.125, 0.375, 2.5, 0.25, math.nan, None]
    assert apply(spark, values, "double", lambda c: fn.round_scaled(c, 2)) == [0.12, 0.38, 2.5, 0.25, None, None]
    assert apply(spark, values, "double", lambda c: fn.scaled_int(c, 10)) == [1, 4, 25, 2, None, None]


def test_whole_number_truncates(spark):
    assert apply(spark, [1.9, -1.9, math.nan, None], "double", fn.whole_number) == [1, -1, None, None]


def test_ratio_and_share(spark):
    df = spark.sql(
        "SELECT cast(a AS decimal(12,4)) a, cast(b AS decimal(12,4)) b FROM VALUES "
        "(1, '6472.95', '13259.64'), (2, '2', '5'), (3, '1', '0'), (4, null, '1'), (5, '12.45', '100') AS t(i, a, b)"
    )
    shares = [r[0] for r in df.select(fn.share_text(F.col("a"), F.col("b"))).collect()]
    assert shares == ["48.8%", "40.0%", None, None, "12.5%"]
    per_unit = [r[0] for r in df.select(fn.ratio(F.col("a"), F.col("b"), 1000, 1)).collect()]
    assert [None if v is None else float(v) for v in per_unit] == [488.2, 400.0, None, None, 124.5]


def test_nan_enters_as_null(spark):
    assert apply(spark, [1.0, math.nan, None], "double", fn.null_if_nan) == [1.0, None, None]


def test_accent_fold_of_every_sign(spark):
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    lines = ["".join(f"a{s}b" for s in signs[i : i + 64]) for i in range(0, len(signs), 64)]
    got = apply(spark, lines, "string", fn.accent_fold)
    assert got == [unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode().upper().strip() for s in lines]
    alone = [s for s in signs if s.isspace() or ord(s) < 0x3000]
    got = apply(spark, alone, "string", fn.accent_fold)
    assert got == [unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode().upper().strip() for s in alone]
