"""Distributed order operators against plain Python, with hot values and hot groups."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from locusloom.operators.ordered import average_rank, bh_adjust, digest_rank, group_median, ordered_scan


def brute_bh(ps):
    order = sorted(range(len(ps)), key=lambda i: ps[i])
    out, running = [0.0] * len(ps), 1.0
    for rank in range(len(ps), 0, -1):
        i = order[rank - 1]
        running = min(running, ps[i] * len(ps) / rank)
        out[i] = running
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 40), min_size=1, max_size=120))
def test_bh_matches_definition(spark, values):
    ps = [v / 40 for v in values]
    df = spark.createDataFrame(list(enumerate(ps)), "id long, p double")
    got = {r["id"]: r["fdr_bh"] for r in bh_adjust(df, "p").collect()}
    want = brute_bh(ps)
    assert all(abs(got[i] - want[i]) < 1e-12 for i in range(len(ps)))


def test_bh_keeps_null(spark):
    df = spark.createDataFrame([(1, 0.01), (2, None), (3, 0.04)], "id long, p double")
    got = {r["id"]: r["fdr_bh"] for r in bh_adjust(df, "p").collect()}
    assert got == {1: pytest.approx(0.02), 2: None, 3: pytest.approx(0.04)}


@pytest.mark.parametrize("partitions", [8, 200])
def test_scan_rank_and_median_with_hot_value(spark, partitions):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        # one value holds a third of all rows, and one group most of them
        value = 7.0 if i % 3 == 0 else rng.randint(0, 4000) / 4
        rows.append((i, "hot" if i % 10 else "cold", value))
    df = spark.createDataFrame(rows, "id long, g string, v double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        ranks = {r["id"]: r["rank"] for r in average_rank(df, ["g"], "v").collect()}
        medians = {r["g"]: (r["n"], r["median"]) for r in group_median(df, ["g"], "v").collect()}
        scan = ordered_scan(df, ["g"], "id", {"s": F.col("v")}, {"m": F.col("v")}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for g in ("hot", "cold"):
        group = [(i, v) for i, k, v in rows if k == g]
        vs = sorted(v for _, v in group)
        first, count = {}, {}
        for pos, v in enumerate(vs, start=1):
            first.setdefault(v, pos)
            count[v] = count.get(v, 0) + 1
        assert all(ranks[i] == first[v] + (count[v] - 1) / 2 for i, v in group)
        n = len(vs)
        assert medians[g] == (n, (vs[(n - 1) // 2] + vs[n // 2]) / 2)
        total, top, want = 0.0, None, {}
        for i, v in group:
            want[i] = (total, top)
            total += v
            top = v if top is None else max(top, v)
        for r in scan:
            if r["g"] == g:
                assert r["s_before"] == pytest.approx(want[r["id"]][0]) and r["m_before"] == want[r["id"]][1]
                assert r["s_all"] == pytest.approx(total)


def test_digest_rank_is_dense(spark):
    df = spark.range(2000).select("id", (F.col("id") % 2).alias("g"), F.md5(F.col("id").cast("string")).alias("d"))
    rows = digest_rank(df, ["g"], "d").collect()
    for g in (0, 1):
        part = sorted((r["d"], r["rank"]) for r in rows if r["g"] == g)
        assert [rank for _, rank in part] == list(range(1, 1001))
