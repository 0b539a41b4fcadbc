"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from allelix.plans import registry

DATA = "/root/testdata/sf0.001"


def plain(rows):
    return sorted(str([None if x is None else round(x, 9) if isinstance(x, float) else str(x) for x in r]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_says_what_sql_says(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    cursor = duck.execute(registry.oracle_sql()[name])
    have = [x[0] for x in cursor.description]
    assert sorted(have) == columns
    expected = [[r[have.index(c)] for c in columns] for r in cursor.fetchall()]
    assert plain(df.select(*columns).collect()) == plain(expected)


def test_filter_over_all_labels_is_overall(spark):
    from allelix.operators import aggregates as ag
    from allelix.operators import records as rec
    from allelix.plans.points import PRIORITY, points

    kept = rec.dedup_by_source(rec.core_keys(points(spark, DATA)), PRIORITY)
    scope = ["dataset_type", "gene_id"]
    names = [r[0] for r in kept.select("phenotype").distinct().collect()]
    assert plain(ag.filtered(kept, names, scope).collect()) == plain(ag.aggregate_variants(kept, scope).collect())
