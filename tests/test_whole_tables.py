"""Queries that cover their whole tables, not a part of them."""

from __future__ import annotations

from datetime import timedelta

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"


def test_exact_exchange_has_every_pair_of_years(spark):
    name = "stat10_exact_exchange"
    found = entry.queries()[name](spark, SF)
    assert compare(found, connect(SF), entry.oracle_sql()[name]) is None
    years = {r.first_year for r in found.select("first_year").distinct().collect()}
    assert years > {1995} and len(years) > 4


def test_complete_day_stream_has_the_last_days(spark):
    name = "str2_complete_day_stream"
    found = entry.queries()[name](spark, SF).cache()
    assert compare(found, connect(SF), entry.oracle_sql()[name]) is None
    days = {(r.location_id, r.date): r.streamed for r in found.collect()}
    last = max(d for _, d in days)
    # whole days come out of the stream, up to the last; a site whose files have no record is not there
    assert any(streamed for (_, d), streamed in days.items() if d >= last - timedelta(days=4))
    assert not any(site == "error" for site, _ in days)
