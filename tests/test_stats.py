import math

import pytest
from pyspark.sql import functions as F

from cohortlift.functions import stats as ST


def _betacf(a, b, x):
    # continued fraction of the incomplete beta function (modified Lentz)
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-15:
            break
    return h


def _betai(a, b, x):
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def ref_t_p(t, df):
    return _betai(df / 2.0, 0.5, df / (df + t * t))


def _eval(spark, cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


@pytest.mark.parametrize("z", [0.0, 0.3, 1.0, 1.959964, 2.5, 4.0, 7.5, -2.2])
def test_normal_p_matches_erfc(spark, z):
    got = _eval(spark, [ST.normal_two_sided_p(F.lit(z))])[0]
    assert got == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-9)


@pytest.mark.parametrize("t,df", [(0.1, 1), (1.0, 1), (2.0, 3), (2.228139, 10), (1.5, 30), (3.0, 57),
                                  (-2.5, 200), (4.0, 5000), (2.0, 1e6), (0.0, 12)])
def test_t_p_matches_incomplete_beta(spark, t, df):
    got = _eval(spark, [ST.t_two_sided_p(F.lit(t), F.lit(float(df)))])[0]
    assert got == pytest.approx(ref_t_p(t, df), abs=1e-8)


def test_pooled_t_statistic(spark):
    # equal-variance Student t from summary statistics, computed by hand
    m1, s1, n1, m2, s2, n2 = 5.0, 2.0, 40, 4.2, 1.5, 35
    df = n1 + n2 - 2
    sp = ((n1 - 1) * s1 ** 2 + (n2 - 1) * s2 ** 2) / df
    t = (m1 - m2) / math.sqrt(sp * (1 / n1 + 1 / n2))
    gt, gdf = _eval(spark, list(ST.pooled_t(*[F.lit(x) for x in (m1, s1, n1, m2, s2, n2)])))
    assert gt == pytest.approx(t, rel=1e-12) and gdf == df


def test_pooled_z_and_symmetry(spark):
    x1, n1, x2, n2 = 30, 100, 45, 110
    p = (x1 + x2) / (n1 + n2)
    z = (x1 / n1 - x2 / n2) / math.sqrt(p * (1 - p) * (1 / n1 + 1 / n2))
    a, b = _eval(spark, [ST.pooled_z(*[F.lit(v) for v in (x1, n1, x2, n2)]),
                         ST.pooled_z(*[F.lit(v) for v in (x2, n2, x1, n1)])])
    assert a == pytest.approx(z, rel=1e-12) and b == pytest.approx(-z, rel=1e-12)
    pa, pb = _eval(spark, [ST.normal_two_sided_p(F.lit(a)), ST.normal_two_sided_p(F.lit(b))])
    assert pa == pytest.approx(pb, abs=1e-15)


def test_undefined_tests_are_null_and_flag_yes(spark):
    null = F.lit(None).cast("double")
    # zero saves in both arms: pooled proportion 0 -> variance 0 -> z NULL
    z = ST.pooled_z(F.lit(0), F.lit(10), F.lit(0), F.lit(12))
    # a single viewer: sd NULL
    t1, df1 = ST.pooled_t(F.lit(2.0), null, F.lit(1), F.lit(1.0), F.lit(0.5), F.lit(9))
    # zero variance in both arms
    t2, df2 = ST.pooled_t(F.lit(2.0), F.lit(0.0), F.lit(5), F.lit(1.0), F.lit(0.0), F.lit(9))
    # df = 0
    t3, df3 = ST.pooled_t(F.lit(2.0), F.lit(1.0), F.lit(1), F.lit(1.0), F.lit(1.0), F.lit(1))
    r = _eval(spark, [z, ST.normal_two_sided_p(z), ST.significance_flag(ST.normal_two_sided_p(z)),
                      ST.t_two_sided_p(t1, df1), ST.significance_flag(ST.t_two_sided_p(t1, df1)),
                      ST.t_two_sided_p(t2, df2), ST.t_two_sided_p(t3, df3)])
    assert r[0] is None and r[1] is None and r[2] == "Yes"
    assert r[3] is None and r[4] == "Yes"
    assert r[5] is None and r[6] is None


def test_flag_threshold(spark):
    r = _eval(spark, [ST.significance_flag(F.lit(0.05)), ST.significance_flag(F.lit(0.0499)),
                      ST.significance_flag(F.lit(0.9))])
    assert tuple(r) == ("No", "Yes", "No")


def test_random_tests_against_references(spark):
    """Hundreds of random two-sample inputs in one query, against Python references."""
    import random

    rnd = random.Random(5)
    zrows = []
    for _ in range(400):
        n1, n2 = rnd.randrange(1, 5000), rnd.randrange(1, 5000)
        zrows.append((rnd.randrange(0, n1 + 1), n1, rnd.randrange(0, n2 + 1), n2))
    df = spark.createDataFrame(zrows, "x1 long, n1 long, x2 long, n2 long")
    z = ST.pooled_z(F.col("x1"), F.col("n1"), F.col("x2"), F.col("n2"))
    zr = ST.pooled_z(F.col("x2"), F.col("n2"), F.col("x1"), F.col("n1"))
    got = df.select("x1", "n1", "x2", "n2", z.alias("z"), zr.alias("zr"),
                    ST.normal_two_sided_p(z).alias("p")).collect()
    for r in got:
        p = (r.x1 + r.x2) / (r.n1 + r.n2)
        var = p * (1 - p) * (1 / r.n1 + 1 / r.n2)
        if var == 0:
            assert r.z is None and r.p is None
            continue
        ez = (r.x1 / r.n1 - r.x2 / r.n2) / math.sqrt(var)
        assert r.z == pytest.approx(ez, rel=1e-9, abs=1e-12) and r.zr == pytest.approx(-ez, rel=1e-9, abs=1e-12)
        assert r.p == pytest.approx(math.erfc(abs(ez) / math.sqrt(2)), abs=1e-9)

    trows = []
    for _ in range(300):
        trows.append((rnd.uniform(0, 10), rnd.uniform(0.1, 5), rnd.randrange(2, 3000),
                      rnd.uniform(0, 10), rnd.uniform(0.1, 5), rnd.randrange(2, 3000)))
    df = spark.createDataFrame(trows, "m1 double, s1 double, n1 long, m2 double, s2 double, n2 long")
    t, dfree = ST.pooled_t(*[F.col(c) for c in ("m1", "s1", "n1", "m2", "s2", "n2")])
    got = df.select(t.alias("t"), dfree.alias("df")).select(
        "t", "df", ST.t_two_sided_p(F.col("t"), F.col("df")).alias("p")).collect()
    for r in got:
        assert 0.0 <= r.p <= 1.0
        assert r.p == pytest.approx(ref_t_p(r.t, r.df), abs=1e-8)
