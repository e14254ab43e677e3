"""Run the catalogue beside its SQL and compare: ``check_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from stallweave.catalogue import ORACLES, QUERIES  # noqa: E402
from stallweave.session import build_session  # noqa: E402


def norm(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return str(v)


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for f in sorted(os.listdir(sf)):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{sf}/{f}')")
    failed = []
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf)
            cols = sorted(df.columns)
            got = sorted(tuple(norm(v) for v in row) for row in df.select(*cols).toPandas().astype(object).where(lambda x: x.notna(), None).itertuples(index=False))
            took = time.time() - start
            if name not in ORACLES:
                print(f"rows  {name}: {len(got)} rows {took:.1f}s", flush=True)
                continue
            start = time.time()
            rel = con.sql(ORACLES[name])
            ocols = sorted(rel.columns)
            want = sorted(tuple(norm(v) for v in row) for row in rel.df()[ocols].astype(object).where(lambda x: x.notna(), None).itertuples(index=False))
            otook = time.time() - start
            types = dict(zip(rel.columns, map(str, rel.types)))
            ok = cols == ocols and got == want
            print(f"{'ok   ' if ok else 'FAIL '} {name}: {len(got)}/{len(want)} rows spark {took:.1f}s sql {otook:.1f}s", flush=True)
            if not ok:
                failed.append(name)
                print("   cols", cols, ocols, {k: v for k, v in types.items()}, [(f.name, f.dataType.simpleString()) for f in df.schema])
                for a, b in zip(got, want):
                    if a != b:
                        for c, x, y in zip(cols, a, b):
                            if x != y:
                                print("   ", c, repr(x)[:200], repr(y)[:200])
                        print("   spark", str(a)[:300]); print("   sql  ", str(b)[:300])
                        break
        except Exception as err:  # noqa: BLE001
            failed.append(name)
            print(f"ERROR {name}: {type(err).__name__}: {str(err)[:1500]}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
