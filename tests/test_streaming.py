import datetime as dt
import random

from pyspark.sql import functions as F

from barflow.functions.series import with_scans
from barflow.operators import indicators
from barflow.schemas import BRONZE
from barflow.sources import tables
from barflow.streaming import jobs
from helpers import START

TICKS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def test_bars_that_come_late_correct_the_averages(spark, bars, tmp_path):
    rng = random.Random(3)
    whole = bars({s: [100 + rng.uniform(-5, 5) for _ in range(60)] for s in "ABC"}).cache()
    day = F.datediff("date", F.lit(START))
    part = (F.when(F.col("symbol") == "C", F.when(day < 40, 0).otherwise(1))
            .when((F.col("symbol") == "A") & day.isin(0, 7, 20), 2).when((F.col("symbol") == "B") & (day == 30), 1)
            .when(day < 30, 0).when(day < 50, 1).otherwise(2))
    path, root = str(tmp_path / "landing"), str(tmp_path)
    for i in range(4):  # the last one repeats a stored bar with another price
        if i < 3:
            whole.filter(part == i).write.mode("append").parquet(path)
        else:
            whole.filter((F.col("symbol") == "B") & (day == 10)).withColumn("close", F.lit(1.0)).write.mode("append").parquet(path)
        out = jobs.running_averages(spark, path, f"{root}/bars", f"{root}/state", f"{root}/checkpoint")
    names = ["row_pos", *indicators.EMA_SPANS, "obv"]
    want = {(r.symbol, r.date): r for r in with_scans(whole, indicators.EMA_SPANS, balance=("obv", "volume")).collect()}
    found = {(r.symbol, r.date): r for r in out.collect()}
    assert found.keys() == want.keys() and len(want) == out.count() == 180
    assert all(abs(found[k][c] - want[k][c]) < 1e-9 for k in want for c in names)
    repeated = spark.read.parquet(f"{root}/state/repeated").collect()
    assert [(r.symbol, r.date, r.close) for r in repeated] == [("B", START + dt.timedelta(days=10), 1.0)]


def test_ticks_that_come_late_are_in_their_bars(spark, tmp_path):
    rng = random.Random(5)
    begin = dt.datetime(2024, 3, 1)
    ticks = [(i, begin + dt.timedelta(minutes=rng.randrange(20 * 24 * 60)), 1, rng.choice("xy"), rng.uniform(1, 9), "")
             for i in range(300)]
    path = str(tmp_path / "ticks")
    half = begin + dt.timedelta(days=10)
    late = lambda t: t[0] % 5 == 0
    for part in ([t for t in ticks if t[1] >= half and not late(t)], [t for t in ticks if t[1] < half or late(t)]):
        spark.createDataFrame(part, TICKS).write.mode("append").parquet(path)
        out = jobs.bars_from_ticks(spark, path, str(tmp_path / "bars"), str(tmp_path / "checkpoint"))
    want = {}
    for i, ts, _, symbol, value, _ in sorted(ticks, key=lambda t: (t[1], t[0])):
        want.setdefault((symbol, ts.replace(minute=0)), []).append(value)
    found = {(r.symbol, r.bar_time): tuple(r)[2:] for r in out.withColumn(
        "bar_time", F.col("bar_time").cast("timestamp_ntz")).select(
        "symbol", "bar_time", "open", "high", "low", "close", "volume").collect()}
    assert found == {k: (v[0], max(v), min(v), v[-1], len(v)) for k, v in want.items()}


def test_repeated_records_end_in_the_state_or_in_the_append(spark, tmp_path, monkeypatch):
    """Copies inside the time of the state never reach the append, after a restart neither; later ones end there."""
    stamp = dt.datetime(2024, 3, 1)
    record = lambda i, batch="b1", at=stamp, close=1.0: (f"S{i}", START, close, 2.0, 1.0, close, close, 5, "s", at, batch)
    path, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    reached = []
    append = tables.append_new
    monkeypatch.setattr(tables, "append_new", lambda spark, to, batch, keys: reached.append(batch.count()) or append(spark, to, batch, keys))

    def deliver(rows, **settings):
        spark.createDataFrame(rows, BRONZE).coalesce(1).write.mode("append").parquet(path)
        jobs.ingest_bronze(spark, path, bronze, str(tmp_path / "checkpoint"), **settings)  # each call starts anew from the checkpoint

    deliver([record(i) for i in range(10)] + [record(0)])
    deliver([record(i) for i in range(5, 15)])
    assert sum(reached) == 15
    # Another delivery of a bar is not a repeated record: the append keeps the first one, and an old stamp is not too late.
    deliver([record(1, "b2", stamp + dt.timedelta(days=1), 9.0), record(99, "b0", stamp - dt.timedelta(days=900))])
    assert sum(reached) == 17
    found = {r.symbol: r.close for r in tables.read_layer(spark, bronze).collect()}
    assert len(found) == 16 and found["S1"] == 1.0 and found["S99"] == 1.0
