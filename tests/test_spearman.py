"""Spearman pairs as a product of rank blocks, held against pandas."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from locusloom.operators import association


def expected(table, metrics):
    found = {}
    for k, a in enumerate(metrics):
        for b in metrics[k + 1 :]:
            both = table[[a, b]].dropna()
            if len(both) >= 3 and both[a].nunique() > 1 and both[b].nunique() > 1:
                found[(a, b)] = (len(both), both[a].rank().corr(both[b].rank()))
    return found


@pytest.mark.parametrize("band", [association.BAND, 40])
def test_pairs_equal_pandas(spark, monkeypatch, band):
    """Ties, gaps shared by a family of metrics, a constant, an empty and a nearly empty metric, NaN; one band and many."""
    monkeypatch.setattr(association, "BAND", band)
    rng = np.random.default_rng(7)
    metrics = [f"m {i}" for i in range(9)]
    table = pd.DataFrame({m: rng.integers(0, 12, 211).astype(float) for m in metrics})
    table.loc[5:40, ["m 1", "m 2"]] = None
    table.loc[30:90, "m 3"] = None
    table["m 4"] = table["m 0"] * 2 + 1
    table["m 5"] = 3.0
    table["m 6"] = np.nan
    table.loc[2:, "m 7"] = None
    table.insert(0, "sample_id", [f"s{i}" for i in range(len(table))])
    got = {
        (r["metric_x"], r["metric_y"]): (r["n_samples"], r["spearman_rho"])
        for r in association.spearman_pairs(spark.createDataFrame(table)).collect()
    }
    want = expected(table, metrics)
    assert got.keys() == want.keys() and len(want) == 15
    for pair, (n, rho) in want.items():
        assert got[pair][0] == n and got[pair][1] == pytest.approx(rho, abs=1e-12)
    assert got[("m 0", "m 4")][1] == 1.0


def test_pairs_of_repeated_and_absent_samples(spark):
    rows = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 1.0), ("b", 3.0, 3.0)], "sample_id string, x double, y double")
    with pytest.raises(Exception, match="more than one row"):
        association.spearman_pairs(rows).collect()
    assert association.spearman_pairs(rows.limit(0)).collect() == []
    assert association.spearman_pairs(rows.select("sample_id", "x")).collect() == []


def test_a_task_sends_one_row_per_pair():
    """However many batches of samples a task reads, it sends each pair of its band once."""
    ranks = [[{"ranking": 0, "rank": float(k)}, {"ranking": 1, "rank": float(8 - k)}] for k in range(1, 8)]
    kind = pa.list_(pa.struct([("ranking", pa.int32()), ("rank", pa.float64())]))
    batches = [pa.record_batch([pa.array(part, kind)], ["ranks"]) for part in (ranks[:3], ranks[3:4], ranks[4:])]
    pairs = np.array([[0], [1], [0], [1]], dtype=np.int32)
    sent = list(association._band_products(iter(batches), np.array([4.0, 4.0]), pairs, 0, 1))
    assert [b.to_pylist() for b in sent] == [[{"a": 0, "b": 1, "vx": 28.0, "vy": 28.0, "xy": -28.0}]]
