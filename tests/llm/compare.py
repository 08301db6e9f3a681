"""Run queries at a scale and compare with DuckDB: python tests/llm/compare.py DIR NAME..."""
import sys, time, os
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import duckdb
from pyspark.sql import SparkSession
import __spark_entry__ as E

d, names = sys.argv[1], sys.argv[2:]
s = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
s.sparkContext.setLogLevel("ERROR")
q, o = E.queries(), E.oracle_sql()
con = duckdb.connect()
con.execute("set timezone='UTC'")
for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
    p = f"{d}/{t}.parquet"
    con.execute(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")


def norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "normalize"):
        return float(v)
    return v


bad = []
for n in names or list(q):
    t = time.time()
    try:
        df = q[n](s, d)
        rows = [tuple(norm(x) for x in r) for r in df.select(*sorted(df.columns)).collect()]
    except Exception as e:
        print("FAIL", n, str(e)[:1500]); bad.append(n); continue
    took = time.time() - t
    msg = f"{n}: {len(rows)} rows {took:.1f}s {sorted(df.columns)}"
    if n in o:
        try:
            r = con.execute(o[n]); cols = [c[0] for c in r.description]; order = sorted(range(len(cols)), key=cols.__getitem__)
            want = [tuple(norm(x[i]) for i in order) for x in r.fetchall()]
        except Exception as e:
            print("SQLFAIL", n, str(e)[:800]); bad.append(n); continue
        a, b = sorted(rows, key=repr), sorted(want, key=repr)
        if sorted(cols) != sorted(df.columns) or a != b:
            bad.append(n)
            msg = "DIFF " + msg + f" want {len(b)} {sorted(cols)}\n   ours-not-theirs {[x for x in a if x not in set(b)][:2]}\n   theirs {[x for x in b if x not in set(a)][:2]}"[:3000]
        else:
            msg = "ok " + msg
    else:
        msg = "rows " + msg + (f" e.g. {rows[0]}"[:300] if rows else "")
    print(msg, flush=True)
print("BAD", bad)
