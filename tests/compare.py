"""Compare a Spark result with its reference SQL on the same Parquet files."""

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def mismatch(df, con, sql):
    """``None`` when schema and rows agree, otherwise a short explanation."""
    described = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    names = sorted(df.columns)
    if sorted(described) != names:
        return f"columns {sorted(set(described) ^ set(names))}"
    types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    wrong = {n: (types[n], described[n]) for n in names if types[n] != described[n]}
    # a literal's integer width or a decimal is normal for neither side
    if wrong:
        return f"types {wrong}"
    got = sorted((tuple(_value(v) for v in r) for r in df.select(*names).collect()), key=_key)
    quoted = ", ".join(f'"{n}"' for n in names)
    want = sorted((tuple(_value(v) for v in r)
                   for r in con.execute(f"select {quoted} from ({sql})").fetchall()), key=_key)
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        pairs = [dict(zip(names, zip(g, w))) for g, w in bad[:2]]
        short = [{k: v for k, v in p.items() if v[0] != v[1]} for p in pairs]
        return f"{len(bad)} of {len(got)} rows differ, e.g. {short}"
    return None
