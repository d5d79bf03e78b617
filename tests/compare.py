"""Row-set comparison of a Spark result with DuckDB SQL on the same tables."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def close(a, b) -> bool:
    """Floats may differ by one unit of the rounding that the queries apply."""
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-7, abs_tol=2e-6)
    return cell(a) == cell(b)


def rows_of(names, rows, floats):
    """Rows with columns by name, ordered by their non-float columns first."""
    order = sorted(range(len(names)), key=lambda i: (names[i] in floats, names[i]))
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: [cell(v) for v in r])


def compare(df, con, sql: str, exact: bool = True) -> str | None:
    """None when equal, else a short account of the first difference."""
    got_names = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if any("DECIMAL" in k or "HUGEINT" in k for k in kinds.values()):
        return f"oracle types {kinds}"
    floats = {n for n, k in kinds.items() if k in ("DOUBLE", "FLOAT")}
    pairs = zip(rows_of(got_names, got, floats), rows_of(want_names, want, floats))
    same = (lambda x, y: cell(x) == cell(y)) if exact else close
    bad = [(x, y) for x, y in pairs if not all(same(p, q) for p, q in zip(x, y))]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0][0]} != {bad[0][1]}"
    return None
