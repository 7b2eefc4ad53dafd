"""Local twin of the driver's correctness check: Spark query vs DuckDB oracle.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if v != v:
            return "nan"
        return repr(float(v))
    return str(v)


def digest(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("spark-error", str(e)[:300])
            print(name, "SPARK ERROR", str(e)[:500], flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            results[name] = ("rows-only", len(srows))
            print(f"{name:40s} rows-only {len(srows)} rows  spark {t1 - t0:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("sql-error", str(e)[:300])
            print(name, "SQL ERROR", str(e)[:500], flush=True)
            continue
        sh, sl = digest(srows, scols)
        dh, dl = digest(drows, dcols)
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and sh == dh
        results[name] = ("match" if ok else "MISMATCH", len(srows), len(drows))
        print(f"{name:40s} {'ok' if ok else 'MISMATCH'} spark={len(srows)} duck={len(drows)} "
              f"{t1 - t0:.1f}s", flush=True)
        if not ok and verbose:
            if sorted(scols) != sorted(dcols):
                print("   columns", sorted(set(scols) ^ set(dcols)))
            else:
                a, b = set(sl), set(dl)
                print("   cols:", sorted(scols))
                for x in sorted(a - b)[:3]:
                    print("   spark:", x)
                for x in sorted(b - a)[:3]:
                    print("   duck: ", x)
    return results


if __name__ == "__main__":
    from arrears.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("match", "rows-only")}
    print(f"{len(res) - len(bad)}/{len(res)} good; bad: {sorted(bad)}")
