import datetime as dt

from marketpulse.schemas import TICK

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def tick(id_, secs, price=None, change=None, cap=None, vol=None, seq=0, symbol=None):
    ts = None if secs is None else at(secs)
    return (id_, symbol, price, change, cap, vol, ts, seq)


def ticks_df(spark, rows):
    return spark.createDataFrame(rows, TICK)


def rows_of(df, *cols):
    cols = cols or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)
