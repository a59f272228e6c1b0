"""Queries have their twins' rows on the smallest tables: some of each kind; the driver compares them all."""

import math

import duckdb
import pytest

from figloom.plans import registry
from figloom.plans.fixtures import GIVEN
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in GIVEN:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def normal(v):
    return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v


SOME = "a8_insert_ignore a10_annotation_scan b6_article_links b9_open_links b12_figure_blocks b12_within b13_captions c2_delimiter c5_molecule_table c10_likely_label c21_taxonomy h5_indexed_keyword i10_smooth c1_label_spans c15_segments c23_unique_remainder d4_contained d7_letterbox e2_nms_overlap e6_classify f7_nearest_label f10_physical_size g1_assign_captions g6_subfigure_table h6_search i5_annotations i13_diff_results j1_stream_run j2_stream_distinct".split()


@pytest.mark.parametrize("name", SOME)
def test_rows_equal_the_twin(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    found = duck.execute(registry.ORACLES[name])
    columns = [c[0] for c in found.description]
    want = sorted(repr([normal(r[columns.index(c)]) for c in sorted(columns)]) for r in found.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr([normal(r[c]) for c in sorted(columns)]) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_queries_without_twin_run(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
