from __future__ import annotations

import itertools
import time

import numpy as np
import pytest

from foliolens.operators.sections import SSE_DIGITS, size_borders, split_points


def brute(points, counts, groups):
    """All splits, the first of the cheapest at six decimals."""
    points, counts = np.asarray(points, float), np.asarray(counts, float)
    points = points - (points * counts).sum() / counts.sum()

    def cost(i, j):
        mean = (points[i:j] * counts[i:j]).sum() / counts[i:j].sum()
        return (counts[i:j] * (points[i:j] - mean) ** 2).sum()

    best = None
    for borders in itertools.combinations(range(1, len(points)), groups - 1):
        ends = [0, *borders, len(points)]
        total = round(sum(cost(i, j) for i, j in zip(ends, ends[1:])), SSE_DIGITS)
        if best is None or total < best[0]:
            best = total, list(borders)
    return best


def spread_of(points, counts, borders):
    ends = [0, *borders, len(points)]
    points, counts = np.asarray(points, float), np.asarray(counts, float)
    means = [(points[i:j] * counts[i:j]).sum() / counts[i:j].sum() for i, j in zip(ends, ends[1:])]
    return sum((counts[i:j] * (points[i:j] - m) ** 2).sum() for (i, j), m in zip(zip(ends, ends[1:]), means))


@pytest.mark.parametrize("groups", [1, 2, 3, 4])
def test_against_all_splits(groups):
    random = np.random.default_rng(groups)
    for _ in range(80):
        n = int(random.integers(max(groups, 2), 14))
        points = np.sort(random.choice(np.arange(1, 60) / 4, n, replace=False))
        counts = random.integers(1, 5 if random.random() < 0.5 else 400, n)
        assert split_points(points, counts, groups) == brute(points, counts, groups)[1]


def test_ties_go_to_the_first_borders():
    for points in ([1, 2, 3, 4, 5, 6], [1, 2, 3, 4], [10, 11, 20, 21, 30, 31, 40, 41], [0.5, 1, 1.5, 2, 2.5, 3, 3.5]):
        for groups in (2, 3):
            assert split_points(points, [1] * len(points), groups) == brute(points, [1] * len(points), groups)[1]


def test_twenty_thousand_sizes_in_seconds():
    random = np.random.default_rng(0)
    points = np.cumsum(random.integers(1, 5, 20_000)) / 100
    counts = random.integers(1, 1000, 20_000)
    start = time.perf_counter()
    borders = split_points(points, counts, 3)
    assert time.perf_counter() - start < 10
    for moved in ([1, 0], [-1, 0], [0, 1], [0, -1], [1, 1], [-1, -1]):
        assert spread_of(points, counts, borders) <= spread_of(points, counts, [b + m for b, m in zip(borders, moved)]) + 1e-6


def test_many_sizes_of_one_document(spark):
    blocks = spark.range(8000).selectExpr("1L AS doc_id", "cast(id AS int) AS block_idx", "id / 100 AS font_size")
    row = size_borders(blocks).first()
    assert (row.h2_from, row.h1_from) == (26.66, 53.33)
