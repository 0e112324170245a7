"""Run queries beside their SQL: ``python -m checks.compare [sf_dir] [query …]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracles import ORACLES
from checks.queries import QUERIES
from marketloom.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    text = frame.astype(object).where(frame.notna(), None).map(lambda v: repr(_plain(v)))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def _plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return value


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    left, right = canonical(got), canonical(want)
    unequal = (left != right).any(axis=1)
    if unequal.any():
        at = unequal.idxmax()
        return f"{unequal.sum()} rows differ, first {dict(left.loc[at])} against {dict(right.loc[at])}"
    return None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, connection, failures = local_session(8), duck(sf_dir), 0
    for name in names:
        began = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            spent = time.time() - began
            if name not in ORACLES:
                verdict = f"{len(got)} rows, no SQL"
            else:
                problem = difference(got, connection.execute(ORACLES[name]).df())
                verdict = problem or f"equal, {len(got)} rows"
                failures += problem is not None
        except Exception as error:  # report and go on with the next query
            spent = time.time() - began
            verdict, failures = f"{type(error).__name__}: {str(error)[:1500]}", failures + 1
        print(f"{name:26s} {spent:6.2f}s  {verdict}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
