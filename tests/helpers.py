"""Rows and inputs that the roll-up tests share."""

import datetime as dt
import json

from tallyspark.sources.inputs import Inputs

SF_SMALL = "/root/testdata/sf0.001"


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def payload(**kw) -> str:
    return json.dumps(kw)


def make_inputs(spark, logs=(), footprint=(), static=(), ccu=()):
    """Literal-row inputs. logs: (oid, time, command, payload)."""
    g = spark.createDataFrame(
        [(o, ts(t), c, p if isinstance(p, str) or p is None else json.dumps(p)) for o, t, c, p in logs],
        "oidaccount bigint, time timestamp, command string, payload string")
    f = spark.createDataFrame([(o, ts(c) if c else None) for o, c in footprint], "oidaccount bigint, created timestamp")
    s = spark.createDataFrame(list(static), "oidaccount bigint, country string")
    c = spark.createDataFrame([(ts(t), v) for t, v in ccu], "time timestamp, ccu int")
    return Inputs(gamelogs=g, footprint=f, staticaccount=s, ccu=c)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
