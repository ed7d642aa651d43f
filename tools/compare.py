"""Compare registered queries with their SQL on one scale folder (development aid)."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession


def session(cores=8):
    return (SparkSession.builder.master(f"local[{cores}]").appName("ledgerloom")
            .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
            .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
            .getOrCreate())


def duck(sf):
    con = duckdb.connect()
    for f in sorted(os.listdir(sf)):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf}/{f}'")
    return con


def norm(v):
    if isinstance(v, decimal.Decimal):
        return ("DECIMAL", float(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return ("DATE", str(v))
    return repr(v)


def compare(df, con, statement):
    """Problems as text; empty when columns, kinds and rows agree."""
    timer = threading.Timer(60, con.interrupt)
    timer.start()
    cur = con.execute(statement)
    timer.cancel()
    cols = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    got = df.collect()
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(cols)}"
    order = sorted(cols)
    for name in order:
        if "HUGEINT" in kinds[name] or "DECIMAL" in kinds[name] or "[" in kinds[name]:
            return f"sql type of {name} is {kinds[name]}"
        if df.schema[name].dataType.simpleString().split("(")[0].split("<")[0] in (
                "decimal", "array", "map", "struct", "date", "timestamp"):
            return f"spark type of {name} is {df.schema[name].dataType.simpleString()}"
    a = sorted([tuple(norm(r[c]) for c in order) for r in got], key=repr)
    b = sorted([tuple(norm(r[cols.index(c)]) for c in order) for r in want], key=repr)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        only_a, only_b = sorted(set(a) - set(b), key=repr)[:2], sorted(set(b) - set(a), key=repr)[:2]
        return f"{len(bad)} rows differ; {order}\n   spark {only_a}\n   sql   {only_b}"
    return "" if a else "no rows"


def main():
    sf = os.environ.get("SF", "/root/testdata/sf0.01")
    from ledgerloom.queries import ORACLES, QUERIES

    spark = session()
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf)
    names = [n for n in QUERIES if not sys.argv[1:] or any(n.startswith(a) for a in sys.argv[1:])]
    failed = []
    for n in names:
        t = time.time()
        try:
            df = QUERIES[n](spark, sf)
            problem = compare(df, con, ORACLES[n]) if n in ORACLES else ("" if df.count() else "no rows")
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{'FAIL' if problem else 'ok':5}{n:34}{time.time() - t:6.1f}s {'' if n in ORACLES else 'rows'} {problem}", flush=True)
        if problem:
            failed.append(n)
    print(f"{len(names) - len(failed)} of {len(names)} fine; failed: {failed}")


if __name__ == "__main__":
    main()
