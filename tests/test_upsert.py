import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from barflow.operators import clean, quality, reports, upsert
from barflow.operators.indicators import gold
from barflow.plans import layers
from barflow.schemas import BRONZE
from barflow.session import staged
from barflow.sources import deltas, landing, tables, zones
from barflow.sources.bars import bars_dirty, bars_priority
from helpers import START, collected

SF = "/root/testdata/sf0.001"
KEY = ["symbol", "date"]


def rows(spark, *values):
    made = [(s, START + dt.timedelta(days=d), x, t) for s, d, x, t in values]
    return spark.createDataFrame(made, "symbol string, date date, x double, stamp int")


def plain(df):
    return sorted((r.symbol, (r.date - START).days, r.x, r.stamp) for r in df.collect())


def test_merge_rules(spark):
    old = rows(spark, ("A", 0, 1.0, 1), ("A", 1, 2.0, 1))
    new = rows(spark, ("A", 1, None, 2), ("A", 2, 9.0, 2))
    assert plain(upsert.merge(old, new, KEY).fillna(-1.0)) == [("A", 0, 1.0, 1), ("A", 1, -1.0, 2), ("A", 2, 9.0, 2)]
    assert plain(upsert.merge(old, new, KEY, fill=["x"])) == [("A", 0, 1.0, 1), ("A", 1, 2.0, 2), ("A", 2, 9.0, 2)]
    assert plain(upsert.touch(old, new, KEY, "stamp")) == [("A", 0, 1.0, 1), ("A", 1, 2.0, 2), ("A", 2, 9.0, 2)]
    assert plain(upsert.merge(old, new, KEY, keep=["stamp"]).fillna(-1.0)) == [
        ("A", 0, 1.0, 1), ("A", 1, -1.0, 1), ("A", 2, 9.0, 2)]


def test_merge_is_idempotent(spark):
    old, new = rows(spark, ("A", 0, 1.0, 1)), rows(spark, ("A", 0, 5.0, 2), ("B", 0, 6.0, 2))
    once = upsert.merge(old, new, KEY)
    assert plain(upsert.merge(once, new, KEY)) == plain(once)


def test_insert_ignore_and_reload(spark):
    old = rows(spark, ("A", 0, 1.0, 1), ("B", 0, 2.0, 1))
    new = rows(spark, ("A", 0, 5.0, 2), ("A", 1, 6.0, 2))
    assert plain(upsert.insert_ignore(old, new, KEY)) == [("A", 0, 1.0, 1), ("A", 1, 6.0, 2), ("B", 0, 2.0, 1)]
    assert plain(upsert.reload_symbols(old, new)) == [("A", 0, 5.0, 2), ("A", 1, 6.0, 2), ("B", 0, 2.0, 1)]


def test_layer_tables(spark, tmp_path):
    path = f"{tmp_path}/layer"
    first = rows(spark, ("A", 0, 1.0, 1), ("A", 400, 2.0, 1))
    tables.append_new(spark, path, first, KEY)
    tables.append_new(spark, path, rows(spark, ("A", 0, 9.0, 2), ("B", 1, 3.0, 2)), KEY)
    assert plain(tables.read_layer(spark, path)) == [("A", 0, 1.0, 1), ("A", 400, 2.0, 1), ("B", 1, 3.0, 2)]
    tables.upsert(spark, path, rows(spark, ("A", 0, 7.0, 3)), KEY)
    assert plain(tables.read_layer(spark, path)) == [("A", 0, 7.0, 3), ("A", 400, 2.0, 1), ("B", 1, 3.0, 2)]
    tables.reload(spark, path, rows(spark, ("A", 5, 8.0, 4)))
    assert plain(tables.read_layer(spark, path)) == [("A", 5, 8.0, 4), ("B", 1, 3.0, 2)]


def test_increments_equal_rebuild(spark):
    raw = bars_dirty(spark, SF)
    cut = F.lit("1998-01-01").cast("date")
    stored = clean.silver(raw.filter(F.col("date") < cut))
    fresh = layers.silver_increment(raw, stored)
    whole = collected(clean.silver(raw).filter(F.col("date") >= cut))
    got = collected(fresh)
    assert len(got) == len(whole) > 100
    assert (got.return_log - whole.return_log).abs().max() < 1e-12
    assert (got.close == whole.close).all() and (got.quality_score == whole.quality_score).all()


def test_layer_runs_lose_no_row(spark, tmp_path):
    raw = bars_dirty(spark, SF)
    delivered = staged(clean.dedup_first(raw, layers.BRONZE_KEY), "delivered")
    held = F.pmod(F.xxhash64("symbol", "date"), F.lit(9)) == 0
    root = str(tmp_path)
    layers.run(spark, raw.filter(~held & (F.col("date") < "1999-01-01")), root, "1999-01-01")
    layers.run(spark, raw.filter(F.col("date") < "2000-01-01"), root, "2000-01-01")
    layers.run(spark, raw, root, "2002-01-01")
    silver = tables.read_layer(spark, f"{root}/silver")
    late = spark.read.parquet(f"{root}/late")
    assert late.count() > 0
    assert silver.count() + layers.quarantined(spark, root).count() + late.count() == delivered.count()
    kept = delivered.join(late.select(*layers.BRONZE_KEY), list(layers.BRONZE_KEY), "left_anti")
    whole = clean.silver(kept)
    got, want = collected(silver.select(whole.columns)), collected(whole)
    assert got[["symbol", "date", "close", "high", "is_imputed"]].equals(want[["symbol", "date", "close", "high", "is_imputed"]])
    assert (got.return_log - want.return_log).abs().max() < 1e-12
    first = collected(tables.read_layer(spark, f"{root}/gold"))
    want = collected(gold(whole))
    assert len(first) == len(want) and (first.sma_63 - want.sma_63).abs().max() < 1e-9
    assert (first.obv == want.obv).all() and (first.ema_26 - want.ema_26).abs().max() < 1e-6
    assert first.target_direction_5d.isna().equals(want.target_direction_5d.isna())
    logged = spark.read.parquet(f"{root}/ingestion_log").agg(F.sum("rows_ingested")).first()[0]
    assert logged == delivered.count()
    layers.run(spark, raw, root, "2002-01-01")
    assert first.equals(collected(tables.read_layer(spark, f"{root}/gold")))
    assert spark.read.parquet(f"{root}/ingestion_log").agg(F.sum("rows_ingested")).first()[0] == logged
    assert {str(r[0]) for r in spark.read.parquet(f"{root}/quality_checks").select("check_date").distinct().collect()} == {
        "1999-01-01", "2000-01-01", "2002-01-01"}


def test_bars_without_prices_are_kept_apart(spark, tmp_path):
    days = [("A", START + dt.timedelta(days=i), o, 2.0, 1.0, c, 1.5, 10, "x", None, "b1")
            for i, (o, c) in enumerate([(None, 1.5), (None, None), (1.0, 1.5), (None, None)])]
    layers.run(spark, spark.createDataFrame(days, BRONZE), str(tmp_path), "2020-02-01")
    assert [r.date.day for r in layers.quarantined(spark, str(tmp_path)).orderBy("date").collect()] == [1, 2]
    assert [(r.date.day, r.open) for r in tables.read_layer(spark, f"{tmp_path}/silver").orderBy("date").collect()] == [
        (3, 1.0), (4, 1.0)]


def test_a_failed_delivery_is_logged(spark, tmp_path):
    (tmp_path / "bronze").mkdir()
    (tmp_path / "bronze" / "part-0.parquet").write_text("not a table")
    with pytest.raises(Exception):
        layers.run(spark, bars_dirty(spark, SF), str(tmp_path), "2020-02-01")
    log = spark.read.parquet(f"{tmp_path}/ingestion_log").collect()
    assert {(r.status, r.rows_ingested) for r in log} == {("failed", 0)} and len({r.batch_id for r in log}) == 2


def test_landing_formats(spark, tmp_path):
    bars = bars_priority(spark, SF)
    for fmt in ("parquet", "json", "csv"):
        path = f"{tmp_path}/{fmt}"
        if fmt == "csv":
            landing.write_csv(bars, path)
        else:
            bars.write.format(fmt).save(path)
        back = landing.read_bars(spark, path, fmt, start="1997-01-01", end="1997-12-31", symbols=["2-HIGH"])
        want = landing.prices_between(bars, "1997-01-01", "1997-12-31", ["2-HIGH"])
        assert collected(back).equals(collected(want)) and back.count() > 10


def test_wide_to_long_skips_missing(spark):
    wide = spark.createDataFrame([(START, 1.0, None), (START, None, 2.0)], "date date, A_close double, B_close double")
    got = landing.wide_to_long(wide, ["A", "B", "C"], ["close"])
    assert sorted((r.symbol, r.close) for r in got.collect()) == [("A", 1.0), ("B", 2.0)]
    with pytest.raises(ValueError):
        landing.wide_to_long(wide, ["Z"], ["close"])


def test_quality_and_logs(bars):
    df = bars({"A": [1, -2], "B": [3]})
    checks = {(r.symbol, r.check_name): r for r in quality.quality_checks(df, "2020-02-01").collect()}
    assert len(checks) == 8
    assert checks["A", "validity_no_negative_prices"].details == '{"negative_count":1}'
    assert not checks["A", "validity_no_negative_prices"].passed
    late = {r.symbol: r for r in quality.extended_checks(df, "2020-01-09").collect()}
    assert late["A"].lag_business_days == 5 and late["A"].is_recent
    assert late["B"].lag_business_days == 6 and not late["B"].is_recent
    failed = reports.failure_log(df, "b9", "disk full").collect()
    assert {(r.symbol, r.status, r.rows_ingested, r.error_message) for r in failed} == {
        ("A", "failed", 0, "disk full"), ("B", "failed", 0, "disk full")}


def test_an_unreadable_layer_is_not_overwritten(spark, tmp_path):
    path = f"{tmp_path}/layer"
    tables.write_layer(rows(spark, ("A", 0, 1.0, 1), ("B", 0, 2.0, 1)), path)
    stray = spark.createDataFrame([("A", "B")], "symbol string, SYMBOL2 string").withColumnRenamed("SYMBOL2", "Symbol2")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        stray.withColumnRenamed("Symbol2", "SYMBOL").coalesce(1).write.mode("append").parquet(path)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    with pytest.raises(Exception):
        tables.append_new(spark, path, rows(spark, ("C", 0, 9.0, 2)), KEY)
    assert spark.read.schema("symbol string").option("recursiveFileLookup", "true").parquet(path).count() >= 2


def test_the_run_folder_needs_a_shared_place(spark, tmp_path, monkeypatch):
    from barflow import session

    monkeypatch.setattr(session, "_run_folders", {})
    monkeypatch.setattr(session, "shared_folder", lambda spark: f"file://{tmp_path}/")
    made = session.work_dir(spark, "x")
    assert made.startswith(f"file://{tmp_path}/barflow/{spark.sparkContext.applicationId}/x-")
    spark.range(1).write.parquet(made)
    session.remove_run_folder(spark)
    assert not any((tmp_path / "barflow").iterdir())
    monkeypatch.setattr(session, "_run_folders", {})
    monkeypatch.setattr(session, "shared_folder", lambda spark: None)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(spark, "x")


def test_dates_prune_the_years_of_a_layer(spark, tmp_path):
    path = f"{tmp_path}/layer"
    tables.write_layer(rows(spark, *[("A", 200 * i, float(i), 1) for i in range(8)], ("B", 5, 1.0, 1)), path)
    some = tables.read_layer(spark, path, since="2021-01-01", until="2022-12-31")
    assert sorted(r.x for r in some.collect()) == [2.0, 3.0, 4.0, 5.0]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "period#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    tables.reload(spark, path, rows(spark, ("A", 3000, 7.0, 2)))
    assert plain(tables.read_layer(spark, path)) == [("A", 3000, 7.0, 2), ("B", 5, 1.0, 1)]
    assert sorted(p.name for p in (tmp_path / "layer").glob("period=*")) == ["period=2020", "period=2028"]


def test_one_day_reads_only_touched_periods(spark, bars, tmp_path):
    """With the folders of older years out of reach, a run over one new day gives what a rebuild gives."""
    rng = np.random.default_rng(4)
    path = {s: (100 * np.exp(np.cumsum(rng.normal(0, 0.01, 930)))).tolist() for s in ("A", "B")}
    all_ = staged(bars(path).withColumns({
        "source": F.lit("s"), "ingested_at": F.lit("2022-01-01").cast("timestamp_ntz"), "batch_id": F.lit("b")}), "zone-bars")
    last = all_.agg(F.max("date")).first()[0]
    root = str(tmp_path)
    layers.run(spark, all_.filter(F.col("date") < last), root, "2022-01-01")
    away = []
    for layer in ("bronze", "silver", "gold"):
        for year in (2020, 2021):
            away.append((f"{root}/{layer}/period={year}", f"{root}/away-{layer}-{year}"))
            os.rename(*away[-1])
    layers.run(spark, all_.filter(F.col("date") == last), root, "2022-07-20")
    for here, there in away:
        os.rename(there, here)
    whole = clean.silver(all_)
    got, want = collected(tables.read_layer(spark, f"{root}/silver")), collected(whole)
    assert len(got) == len(want) and np.allclose(got.return_log, want.return_log, equal_nan=True)
    got, want = collected(tables.read_layer(spark, f"{root}/gold")), collected(gold(whole))
    assert len(got) == len(want)
    for c in ("sma_63", "ema_12", "macd_signal", "obv", "future_return_5d"):
        assert np.allclose(got[c], want[c], equal_nan=True), c
    zone = {(r.symbol, r.period): r for r in zones.read(spark, f"{root}/silver").collect()}
    assert zone["A", 2022].last_date == last and sum(r.n for r in zone.values()) == 2 * 930


def test_zones_of_a_write_that_broke_off_are_made_again(spark, bars, tmp_path):
    path = str(tmp_path / "layer")
    tables.write_layer(bars({"A": [1, 2, 3]}), path)
    more = staged(bars({"A": [9], "B": [5, 6]}, start=START + dt.timedelta(days=400)), "more")
    zones.begin(spark, path, [2021])
    tables._write(more, path, "append", False)  # and then the job dies
    found = {(r.symbol, r.period): (r.n, r.last_date) for r in zones.read(spark, path).collect()}
    assert found == {("A", 2020): (3, START + dt.timedelta(days=2)), ("A", 2021): (1, START + dt.timedelta(days=400)),
                     ("B", 2021): (2, START + dt.timedelta(days=401))}
    assert {r.symbol: r.last_date for r in zones.newest(spark, path).collect()}["B"] == START + dt.timedelta(days=401)
    tables.reload(spark, path, bars({"A": [4]}))
    assert {(r.symbol, r.period, r.n) for r in zones.read(spark, path).collect()} == {("A", 2020, 1), ("B", 2021, 2)}


def test_a_run_that_broke_off_is_taken_up_again(spark, bars, tmp_path, monkeypatch):
    all_ = staged(bars({"A": [100 + i % 7 for i in range(200)]}).withColumns({
        "source": F.lit("s"), "ingested_at": F.lit("2022-01-01").cast("timestamp_ntz"), "batch_id": F.lit("b")}), "zone-bars")
    cut = START + dt.timedelta(days=190)
    root = str(tmp_path)
    layers.run(spark, all_.filter(F.col("date") < cut), root, "2020-08-01")
    for broken in ("_update_silver", "_update_gold"):
        with monkeypatch.context() as m:
            m.setattr(layers, broken, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                layers.run(spark, all_, root, "2020-08-02")
    layers.run(spark, all_.limit(0), root, "2020-08-03")
    assert tables.read_layer(spark, f"{root}/silver").count() == 200
    got, want = collected(tables.read_layer(spark, f"{root}/gold")), collected(gold(clean.silver(all_)))
    assert len(got) == len(want) and np.allclose(got.ema_26, want.ema_26)


def _files(path):
    return {f: os.stat(f"{folder}/{f}").st_mtime_ns for folder, _, names in os.walk(path) for f in names}


def test_changes_are_written_beside_the_layer_and_compacted(spark, bars, tmp_path, monkeypatch):
    path = str(tmp_path / "layer")
    closes = {"A": [float(i) for i in range(500)], "B": [float(i) for i in range(500)]}
    tables.write_layer(bars(closes), path)
    before = _files(path)
    read = lambda: sorted((r.symbol, r.date, r.close) for r in tables.read_layer(spark, path).collect())
    day = lambda i: START + dt.timedelta(days=i)
    state = {(s, day(i)): float(i) for s in "AB" for i in range(500)}
    tables.upsert(spark, path, bars({"A": [7000.0]}, start=day(3)), KEY)
    tables.upsert(spark, path, bars({"A": [8000.0], "C": [1.0]}, start=day(3)), KEY)
    tables.reload(spark, path, bars({"B": [5.0, 6.0]}, start=day(499)))
    state = {k: v for k, v in state.items() if k[0] != "B"} | {("A", day(3)): 8000.0, ("C", day(3)): 1.0, ("B", day(499)): 5.0, ("B", day(500)): 6.0}
    want = sorted((s, d, c) for (s, d), c in state.items())
    assert read() == want
    zone = {(r.symbol, r.period): r.n for r in zones.read(spark, path).collect()}
    assert zone["C", 2020] == 1 and zone["B", 2021] == 2 and ("B", 2020) not in zone
    # A deleted key may come back, and a write that dies leaves what was there.
    tables.append_new(spark, path, bars({"B": [9.0]}, start=day(1)), KEY)
    want = sorted([*want, ("B", day(1), 9.0)])
    assert read() == want
    with monkeypatch.context() as m:
        m.setattr(deltas, "write", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            tables.upsert(spark, path, bars({"A": [1.0]}, start=day(9)), KEY)
    assert read() == want and zones.read(spark, path).filter("symbol = 'A'").agg(F.sum("n")).first()[0] == 500
    deltas.compact(spark, path)
    assert read() == want and deltas.readable(spark, deltas.deltas_path(path)) is None
    assert deltas.readable(spark, path).count() == len(want)
    # Few changes rewrite nothing; many are compacted by themselves.
    after = _files(path)
    tables.upsert(spark, path, bars({"A": [3.0]}, start=day(5)), KEY)
    assert _files(path) == after and after != before
    tables.upsert(spark, path, bars({"A": [1.0] * 300}), KEY)
    assert deltas.readable(spark, deltas.deltas_path(path)) is None and _files(path) != after
    assert [c for s, d, c in read() if s == "A"][:300] == [1.0] * 300
