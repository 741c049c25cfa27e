"""Levels of bins against comparing every point with every interval."""

import random

import pytest

from locusloom.operators import intervals


@pytest.mark.parametrize("size,salts", [(None, 1), (1, 1), (1000, 3), (1 << 40, 1)])
def test_lengths_from_one_to_a_chromosome(spark, size, salts):
    rng = random.Random(6)
    spans = []
    for i in range(150):
        length = int(10 ** rng.uniform(0, 8.4))
        start = rng.randrange(0, 250_000_000 - length + 1) if length < 250_000_000 else 0
        spans.append((i, f"chr{i % 2}", start, start + length - 1))
    spans += [(900, "chr0", 0, 249_999_999), (901, "chr0", 8, 7), (902, "chr0", None, 9), (903, "chr1", 5, None), (904, None, 1, 9)]
    spots = [(j, f"chr{j % 3}", rng.choice([rng.randrange(250_000_000), rng.choice(spans[:150])[rng.choice([2, 3])]])) for j in range(300)]
    spots += [(990, "chr0", None), (991, None, 5), (992, "chr0", 0), (993, "chr0", 249_999_999)]
    want = sorted((j, i) for j, c, p in spots for i, d, a, b in spans if None not in (c, p, a, b) and c == d and a <= p <= b)
    points = spark.createDataFrame(spots, "spot long, chrom string, pos long")
    table = spark.createDataFrame(spans, "span long, chrom string, start long, end long")
    got = intervals.interval_join(points, table, bin_size=size, salts=salts).select("spot", "span").collect()
    assert sorted(map(tuple, got)) == want


def test_a_long_interval_is_listed_in_two_bins_at_most(spark):
    table = spark.createDataFrame([(1, "chr1", 3, 249_999_999), (2, "chr1", 7, 7)], "span long, chrom string, start long, end long")
    points = spark.createDataFrame([("chr1", 7)], "chrom string, pos long")
    plan = intervals.interval_join(points, table, bin_size=10)
    assert plan.count() == 2
    assert intervals.interval_join(points, table.limit(0)).count() == 0
    for length in (1, 10, 11, 80, 81, 1 << 30):
        width = next(w for w in intervals.bin_widths(10) if w >= length)
        assert max((s + length - 1) // width - s // width + 1 for s in range(0, 2000, 7)) <= 2
