"""Dips of small tables against their SQL."""

import datetime
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from folio.queries import ORACLES, QUERIES

SCHEMA = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()), ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string())])


def rows(user, values, hour=5):
    """Events of a user, an hour between two; a number per event, whatever the user."""
    at = datetime.datetime(2024, 1, 1, hour)
    return [(100 * user + i, at + datetime.timedelta(hours=i), user, "view", v, "{}") for i, v in enumerate(values)]


def both(spark, folder, name, events):
    """The rows of a query and of its SQL over events."""
    pq.write_table(pa.Table.from_pylist([dict(zip(SCHEMA.names, e, strict=True)) for e in events], SCHEMA), f"{folder}/events.parquet")
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    con.sql("SET threads = 1")
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet')")
    want = con.sql(ORACLES[name])
    df = QUERIES[name](spark, str(folder)).select(want.columns)
    return Counter(map(tuple, df.collect())), Counter(want.fetchall())


# the last two are the same values, whose sums differ in their last bit
MEANS = {1: [10.28, 18.44, 10.43], 2: [16.4, 10.9], 3: [-10.28, -18.44, -10.43], 4: [6.06, 5.69, 5.09, 7.76], 5: [7.76, 5.09, 5.69, 6.06]}


def test_means(spark, tmp_path):
    got, want = both(spark, tmp_path, "q_dips", [e for u, v in MEANS.items() for e in reversed(rows(u, v))])
    assert got == want
    assert {r[0]: r[7] for r in got} == {1: 13.1, 2: 13.7, 3: -13.1, 4: 6.2, 5: 6.1}


@pytest.mark.parametrize("more", ["repeated", "no time", "no number"])
def test_odd_rows(spark, tmp_path, more):
    events = rows(1, [5.0, 7.5, 90.0, 3.0, 4.0])
    no, at, *rest = events[1]
    events += {"repeated": [events[1]], "no time": [(9, None, *rest), (8, None, 1, "view", 50.0, "{}")], "no number": [(None, at, 1, "view", 90.0, "{}")]}[more]
    got, want = both(spark, tmp_path, "q_dips", events)
    assert got == want and got


def test_peaks(spark, tmp_path):
    events = rows(1, [5.0, 410.54999999999995, 300.25, 299.99, 7.5, float("inf"), 10.28, 18.44, 10.43])
    got, want = both(spark, tmp_path, "q_detect", events)
    assert got == want
    assert sorted(r[5] for r in got if r[6] == "peak") == [300.3, 410.6, float("inf")]
    assert [r[5] for r in got if r[6] == "dip"] == [13.1]
