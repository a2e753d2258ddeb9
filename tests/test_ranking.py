"""Ordered slices equal a sort on every edge."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinark.operators.ranking import ordered_slice


def _rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture()
def table(spark):
    data = [(i % 7 if i % 11 else None, f"k{i:03d}") for i in range(60)]
    return spark.createDataFrame(data, "score int, key string").repartition(5)


def order():
    return [F.desc_nulls_last("score"), F.asc("key")]


@pytest.mark.parametrize("limit,offset", [(10, 0), (7, 13), (5, 55), (10, 60), (3, 200), (0, 4),
                                          (60, 0)])
def test_slice_of_the_sorted_rows(table, limit, offset):
    topk = _rows(ordered_slice(table, order(), limit, offset))
    assert topk == _rows(table.orderBy(*order()))[offset:offset + limit]
    assert len(topk) == max(0, min(limit, 60 - offset))


def test_nulls_last_and_total_order(table):
    everything = _rows(ordered_slice(table, order(), 60))
    scores = [s for s, _ in everything]
    assert scores[-6:] == [None] * 6 and scores[:-6] == sorted(scores[:-6], reverse=True)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "score int, key string")
    assert _rows(ordered_slice(empty, order(), 5, 2)) == []


def test_arguments_checked(table):
    with pytest.raises(ValueError):
        ordered_slice(table, order(), -1)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), max_size=80),
       st.integers(0, 90), st.integers(0, 30), st.integers(1, 6))
def test_slices_equal_python_sort(spark, scores, offset, limit, parts):
    data = [(s, f"k{i:03d}") for i, s in enumerate(scores)]
    df = spark.createDataFrame(data, "score int, key string").repartition(parts)
    expected = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = expected[offset:offset + limit]
    assert _rows(ordered_slice(df, order(), limit, offset)) == expected
