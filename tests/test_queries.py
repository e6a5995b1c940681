"""Every registered query against its SQL twin; queries without one against brute force or row counts."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from bazaarline.operators.templates import TEMPLATES
from bazaarline.queries import ORACLES, QUERIES
from test_gold_quality import brute_mapping

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_the_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"onb03_map_columns_fuzzy"}
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], FOLDER) == []


def test_fuzzy_mapping_against_the_standard_library(spark):
    from bazaarline.queries.onboarding import _typed
    from bazaarline.queries.registry import Feeds

    uploads = {}
    for r in _typed(Feeds(spark, FOLDER)).orderBy("dataset", "position", "column").collect():
        uploads.setdefault((r.dataset, r.type), []).append(r.column)
    got = {}
    for r in QUERIES["onb03_map_columns_fuzzy"](spark, FOLDER).collect():
        got.setdefault((r.dataset, r.type), {})[r.field] = r.column_name
    assert set(got) == set(uploads)
    known = {}
    for key, cols in uploads.items():
        shape = (key[1], tuple(cols))
        if shape not in known:
            known[shape] = brute_mapping(cols, key[1])
        assert got[key] == known[shape]
    assert all(set(m) == set(TEMPLATES[t]) for (_, t), m in got.items())


def test_listings_against_a_pattern(spark):
    import html
    import re

    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html").collect()
    want = sorted((p.page_id, html.unescape(re.sub(r"<[^>]*>", "", m)).strip())
                  for p in pages for m in re.findall(r"<li><a [^>]*>(.*?)</a>", p.html, re.S))
    got = sorted((r.page_id, r.label) for r in QUERIES["src17_listings"](spark, FOLDER).collect())
    assert got == want
