"""Run registered queries and their DuckDB checks side by side: tools/check.py [sf] [name prefix ...]."""

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pageloom import catalog  # noqa: E402
from pageloom.fixtures import BASE_TABLES  # noqa: E402
from pageloom.session import build_session  # noqa: E402

KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
         "TIMESTAMP": "timestamp_ntz"}


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    want = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    bad = []
    for name, q in catalog.load().items():
        if want and not any(name.startswith(w) for w in want):
            continue
        try:
            t0 = time.time()
            df = q.run(catalog.Tables(spark, folder))
            cols = sorted(df.columns)
            rows = [tuple(norm(r[c]) for c in cols) for r in df.collect()]
            t1 = time.time()
            msg = f"{len(rows)} rows {t1 - t0:.1f}s"
            if q.sql:
                res = con.execute(q.sql)
                ocols = [d[0] for d in res.description]
                otypes = {d[0]: str(d[1]) for d in res.description}
                order = sorted(ocols)
                pos = [ocols.index(c) for c in order]
                orows = [tuple(norm(r[i]) for i in pos) for r in res.fetchall()]
                t2 = time.time()
                msg += f" / oracle {len(orows)} rows {t2 - t1:.1f}s"
                status = "ok"
                if order != cols:
                    status = f"COLUMNS {cols} vs {order}"
                else:
                    a, b = sorted(rows, key=repr), sorted(orows, key=repr)
                    if a != b:
                        sa, sb = set(map(repr, a)), set(map(repr, b))
                        status = f"VALUES differ\n   spark only {sorted(sa - sb)[:3]}\n   sql only   {sorted(sb - sa)[:3]}"
                    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
                    off = {c: (types[c], otypes[c]) for c in cols if KINDS.get(otypes[c], types[c]) != types[c]
                           or otypes[c] in ("HUGEINT",) or otypes[c].startswith("DECIMAL")}
                    if off:
                        status += f"  TYPES {off}"
                if not rows:
                    status += "  EMPTY"
            else:
                status = "rows only"
        except Exception as err:  # noqa: BLE001
            status, msg = f"ERROR {type(err).__name__}: {str(err)[:700]}", ""
        if status not in ("ok", "rows only"):
            bad.append(name)
        print(f"{name}: {status} ({msg})", flush=True)
    print("BAD:", bad)
    spark.stop()


main()
