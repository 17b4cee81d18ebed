"""Local twin of the driver's correctness gate.

Runs every ``queries()`` entry on Spark and its ``oracle_sql()`` twin on DuckDB
over the same parquet tables, then compares row count, column names and the
order-insensitive multiset of values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}


def _norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) if digits is not None else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    try:
        import numpy as np

        if isinstance(v, np.ndarray):
            return tuple(_norm(x, digits) for x in v.tolist())
        if isinstance(v, np.generic):
            return _norm(v.item(), digits)
    except ImportError:
        pass
    return v


def rows_of(cols: list[str], rows: list[tuple], digits: int | None):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def check(spark, sf_dir: str, names: list[str] | None = None) -> dict:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_connect(sf_dir)
    report = {}
    for name in names or list(qs):
        t0 = time.time()
        entry = {"oracle": name in sqls}
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
            entry["rows"] = len(s_rows)
            entry["spark_sec"] = round(time.time() - t0, 2)
            if name in sqls:
                res = con.execute(sqls[name])
                d_cols = [c[0] for c in res.description]
                d_rows = [tuple(r) for r in res.fetchall()]
                entry["oracle_rows"] = len(d_rows)
                entry["schema_ok"] = sorted(s_cols) == sorted(d_cols)
                s_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
                d_types = {c[0]: str(c[1]).upper() for c in res.description}
                entry["types_ok"] = all(s_types.get(c) == d_types.get(c) for c in d_types)
                if not entry["types_ok"]:
                    entry["types"] = [s_types, d_types]
                entry["exact"] = rows_of(s_cols, s_rows, None) == rows_of(d_cols, d_rows, None)
                entry["round9"] = rows_of(s_cols, s_rows, 9) == rows_of(d_cols, d_rows, 9)
                if not entry["schema_ok"]:
                    entry["cols"] = [sorted(s_cols), sorted(d_cols)]
                if not entry["round9"]:
                    a = rows_of(s_cols, s_rows, 9)
                    b = rows_of(d_cols, d_rows, 9)
                    sa, sb = set(a), set(b)
                    entry["only_spark"] = [repr(x)[:300] for x in list(sa - sb)[:3]]
                    entry["only_oracle"] = [repr(x)[:300] for x in list(sb - sa)[:3]]
        except Exception as exc:  # report and continue
            entry["error"] = f"{type(exc).__name__}: {str(exc)[:800]}"
        report[name] = entry
        print(name, json.dumps(entry, default=str), flush=True)
    return report


if __name__ == "__main__":
    from voxpop.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]")
    rep = check(spark, sf, names)
    bad = [k for k, v in rep.items() if "error" in v or (v.get("oracle") and not (v.get("round9") and v.get("schema_ok")))]
    print("SUMMARY", len(rep), "queries;", "failing:", bad)
