"""Every query of the domain against its SQL on the smallest tables."""

import datetime

import numpy as np
import pandas as pd
import pytest

from wattlake.plans import registry

SQL = registry.oracle_sql()


def cell(v):
    if v is None or v != v:
        return None
    if isinstance(v, (datetime.date, np.datetime64)):
        # one engine's dates come back as dates, the other's as times
        return str(pd.Timestamp(v))
    if isinstance(v, bool) or str(type(v)).endswith("bool_'>") or str(type(v)).endswith("numpy.bool'>"):
        return bool(v)
    if isinstance(v, (int, float)) or hasattr(v, "dtype"):
        try:
            return round(float(v), 5) + 0.0
        except (TypeError, ValueError):
            return str(v)
    return str(v)


def table(df):
    names = sorted(df.columns)
    return names, sorted((tuple(cell(v) for v in row) for row in df[names].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, sf, name):
    ours = table(registry.queries()[name](spark, sf).toPandas())
    theirs = table(duck.execute(SQL[name]).df())
    assert ours == theirs
    assert ours[1]


def test_every_query_has_a_name_of_its_own():
    assert set(SQL) <= set(registry.queries())
