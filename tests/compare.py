"""Run registered queries beside their DuckDB SQL and compare rows as bags."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

from pigeonhole.plans.oracles import ORACLES
from pigeonhole.plans.queries import QUERIES


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def difference(spark, con, name, sf_dir):
    """None if equal, else a short description of what differs."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = Counter(tuple(r[i] for i in order) for r in cursor.fetchall())
    if got == want:
        return None if want else "no rows on either side"
    return (
        f"{sum(got.values())} rows against {sum(want.values())};"
        f" only here: {list((got - want))[:3]}; only there: {list((want - got))[:3]}"
    )
