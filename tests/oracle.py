"""Holds a query against its SQL: rows as multisets of values by column name."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def compare(spark, name, sf_dir):
    """None if the rows agree, else what differs."""
    import __spark_entry__ as entry

    got = entry.queries()[name](spark, sf_dir).toPandas()
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = db.sql(entry.oracle_sql()[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows"
    cols = sorted(got.columns)
    show = lambda x: "NULL" if pd.isna(x) is True or pd.isna(x) else repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    rows = lambda df: sorted(tuple(show(v) for v in r) for r in df[cols].astype(object).itertuples(index=False, name=None))
    a, b = rows(got), rows(want)
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"{dict(zip(cols, x, strict=True))} and {dict(zip(cols, y, strict=True))}"
    return None
