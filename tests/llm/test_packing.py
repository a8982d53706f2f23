import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from symgraph.llm import packing


def _packed(spark, sizes, capacities, **options):
    items = spark.createDataFrame([(i, s, "clash") for i, s in sizes], "item_id long, size int, unit string")
    budgets = spark.createDataFrame([(b, c) for b, c in enumerate(capacities)], "budget_id int, capacity int")
    return [r for r in packing.pack(items, budgets, **options).collect()], items, budgets


def _check(rows, sizes, capacities):
    for b, c in enumerate(capacities):
        fill, got = defaultdict(int), defaultdict(list)
        for r in rows:
            if r.budget_id == b:
                fill[r.bin_id] += r.n_tokens
                got[r.item_id].append((r.token_from, r.n_tokens))
        assert all(f <= c for f in fill.values())
        want = defaultdict(list)
        for i, s in sizes:
            want[i] += [(p * c, min(c, (s or 0) - p * c)) for p in range(max(1, math.ceil((s or 0) / c)))]
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    return {b: len({r.bin_id for r in rows if r.budget_id == b}) for b in range(len(capacities))}


def test_nothing_is_lost_and_bins_are_full(spark):
    sizes = [(i, (i * 7919) % 300 + 1) for i in range(3000)]
    rows, items, budgets = _packed(spark, sizes, [512, 100], slot_rows=200)
    bins = _check(rows, sizes, [512, 100])
    assert bins[0] <= math.ceil(sum(s for _, s in sizes) / 512) * 1.01 + 1


def _bins(size, capacity):
    """Bins of one best-fit over everything."""
    rest = np.where(size > capacity, size % capacity, size)
    return int(np.where(size > capacity, size // capacity, 0).sum()) + max(packing.best_fit(rest[rest > 0].tolist(), capacity)) + 1


def test_what_never_fits_together_ends(spark):
    sizes = [(i, 60) for i in range(400)]
    assert _check(_packed(spark, sizes, [100], slot_rows=50)[0], sizes, [100])[0] == 400


@pytest.mark.parametrize("kind", ["halves", "log-normal", "long"])
def test_many_slots_are_as_good_as_one(spark, kind):
    rng = np.random.default_rng(5)
    size = {"halves": lambda: rng.integers(200, 400, 51000), "log-normal": lambda: np.exp(rng.normal(4.5, 1.2, 51000)).astype(int), "long": lambda: rng.integers(1, 4000, 51000)}[kind]()
    sizes = list(enumerate(size.tolist()))
    many = _check(_packed(spark, sizes, [512, 2048], slot_rows=1000)[0], sizes, [512, 2048])
    one = {b: _bins(size, c) for b, c in enumerate([512, 2048])}
    assert all(many[b] <= one[b] * 1.01 + 1 for b in one)


def test_check_finds_what_is_wrong(spark):
    rows, items, budgets = _packed(spark, [(1, 250), (2, 30), (3, 60), (4, 10)], [100])
    good = packing.pack(items, budgets)
    assert tuple(packing.check(good, items, budgets).head()) == (0, 4, 0, 0, 0)
    lost = good.filter("not (item_id = 1 and part_no = 1)")
    assert tuple(packing.check(lost, items, budgets).head())[2:] == (0, 1, 0)
    assert tuple(packing.check(good.unionByName(good.filter("item_id = 3")), items, budgets).head())[4] == 1
    assert tuple(packing.check(good.withColumn("bin_id", F.lit("x")), items, budgets).head())[2] == 1


def test_nulls_zeros_repeats_splits_and_nothing(spark):
    sizes = [(1, None), (1, 0), (None, 5), (2, 250), (2, 250), (3, 100), (4, 200)]
    rows, items, budgets = _packed(spark, sizes, [100])
    _check(rows, sizes, [100])
    report = packing.fill_report(packing.pack(items, budgets), budgets).head()
    assert (report.n_parts, report.n_tokens, report.fullest, report.least_bins) == (12, 805, 100, 9)
    assert _packed(spark, [], [100])[0] == []


@given(st.lists(st.integers(0, 50), max_size=60))
def test_best_fit(sizes):
    bins = packing.best_fit(sizes, 50)
    fill = defaultdict(int)
    for s, b in zip(sizes, bins):
        fill[b] += s
    assert all(f <= 50 for f in fill.values()) and len(bins) == len(sizes)
    assert len(fill) <= max(1, 2 * math.ceil(sum(sizes) / 50)) or not sizes
