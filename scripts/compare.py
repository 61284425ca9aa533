"""Run registered queries beside their SQL and report differences.

    python scripts/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tidemark.registry import ORACLES, QUERIES  # noqa: E402
from tidemark.registry.base import TABLES  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(v).__name__, v) for v in (plain(r[i]) for i in order)) for r in rows)


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = build_session("compare", "local[3]", 4, **{"spark.driver.memory": "6g",
                            "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{opts.sf}/{t}.parquet'")
    bad = 0
    for name in opts.names or list(QUERIES):
        start = time.time()
        try:
            df = QUERIES[name](spark, opts.sf)
            got = df.collect()
            took = time.time() - start
        except Exception as exc:
            print(f"FAIL  {name}: {str(exc)[:1500]}", flush=True)
            traceback.print_exc(limit=-6)
            bad += 1
            continue
        if name not in ORACLES:
            print(f"rows  {name}: {len(got)} ({took:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(ORACLES[name])
            cols, want = [c[0] for c in cur.description], cur.fetchall()
        except Exception as exc:
            print(f"SQL   {name}: {str(exc)[:800]}", flush=True)
            bad += 1
            continue
        if sorted(cols) != sorted(df.columns):
            print(f"COLS  {name}: {sorted(df.columns)} / {sorted(cols)}", flush=True)
            bad += 1
            continue
        a, b = rows_of(df.columns, got), rows_of(cols, want)
        if a == b:
            print(f"ok    {name}: {len(got)} ({took:.1f}s)", flush=True)
        else:
            bad += 1
            print(f"DIFF  {name}: spark {len(got)}, sql {len(want)}, "
                  f"only spark {sum((a - b).values())}, only sql {sum((b - a).values())}")
            names = sorted(cols)
            for label, only in (("spark", a - b), ("sql", b - a)):
                for row in sorted(only, key=str)[:3]:
                    print("   ", label, dict(zip(names, [v for _, v in row])))
            sys.stdout.flush()
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
