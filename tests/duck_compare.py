"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat") and not isinstance(v, str):
        try:
            return v.replace(tzinfo=None).isoformat(sep=" ")
        except TypeError:
            return v.isoformat()
    if hasattr(v, "tolist"):
        return str([norm(x) for x in v.tolist()])
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    if isinstance(v, dict):
        return str({k: norm(x) for k, x in v.items()})
    return v


def canonical(cols, records):
    """Columns sorted by name; rows as sorted tuples of normalised text."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = sorted(tuple(str(norm(r[i])) for i in order) for r in records)
    return [cols[i] for i in order], rows


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    sc, sr = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    dc, dr = canonical([d[0] for d in res.description], res.fetchall())
    if sc != dc:
        return f"columns differ: spark={sc} duckdb={dc}"
    if sr != dr:
        ds = set(dr)
        return (f"rows differ: spark={len(sr)} duckdb={len(dr)}; "
                f"spark-only sample {[r for r in sr if r not in ds][:2]}")
    return None
