import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import few_rounds
from ebbtide.plans import profile, rfm
from ebbtide.plans.analysis import insights
from ebbtide.plans.run import regenerate_report, run
from ebbtide.session import shared_folder
from ebbtide.sources import catalog, sinks, tables
from ebbtide.sources.schemas import ORDER_HEADER, ORDER_ITEM, PREDICTIONS


def folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def test_text_dates_are_normalised(spark):
    raw = spark.createDataFrame(
        [(1, 7, "2001-07-30 18:45:00", 5.0, "A", "GOLD", "n1")],
        "id long, member_id long, order_date string, grand_total double, outlet_name string, "
        "member_tier_when_transact string, order_number string",
    )
    df = tables.normalise_header(raw)
    assert df.schema == ORDER_HEADER or [f.name for f in df.schema] == ORDER_HEADER.names
    row = df.first()
    assert row.order_date == dt.date(2001, 7, 30)
    assert row.order_ts == dt.datetime(2001, 7, 30, 18, 45)


def test_parquet_tables(spark, orders, items):
    base = folder()
    orders([{"days": 1}]).write.parquet(f"{base}/h")
    items([{"number": "1"}]).write.parquet(f"{base}/i")
    found = tables.read_parquet(spark, f"{base}/h", f"{base}/i")
    found.as_views()
    joined = catalog.run_sql(
        spark,
        "SELECT count(*) AS n FROM order_header JOIN order_item USING (order_number) WHERE id = :id",
        {"id": 1},
    )
    assert joined.first().n == 1


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="member_id"):
        tables.conform(spark.range(1), ORDER_HEADER)


def test_jdbc_options_come_from_the_environment():
    with pytest.raises(ValueError):
        tables.jdbc_options("order_header", {})
    found = tables.jdbc_options("order_header", {"ORDERS_DB_URL": "jdbc:x", "ORDERS_DB_USER": "u"})
    assert found["dbtable"] == "order_header" and found["user"] == "u" and "password" not in found


def test_text_splits_cover_every_row():
    parts = tables.text_splits("order_number", 3)
    assert len(parts) == 3
    assert "IS NULL" in parts[0] and "IS NULL" not in parts[1]
    assert [p.count("= 2") for p in parts] == [0, 0, 1]


def test_liveness(spark, orders):
    assert tables.is_readable(orders([{"days": 1}]))
    lost = spark.read.schema("a int").parquet(folder()).where(F.raise_error(F.lit("x")).isNull())
    assert tables.is_readable(lost)  # no rows, nothing to raise
    assert not tables.is_readable(spark.range(1).select(F.raise_error(F.lit("down"))))


def test_append_skips_cover_and_failures(spark, items):
    base = folder()
    items([{"number": "0"}]).write.parquet(f"{base}/cover")
    items([{"number": "1"}, {"number": "2"}]).write.parquet(f"{base}/one")
    items([{"number": "3"}]).drop("sku").write.parquet(f"{base}/two")
    text = items([{"number": "4"}]).withColumn("quantity", F.lit("many"))
    text.write.option("header", True).csv(f"{base}/three.csv")
    items([{"number": "5"}]).write.option("header", True).csv(f"{base}/four.csv")
    paths = [f"{base}/{n}" for n in ("cover", "one", "two", "three.csv", "four.csv")]
    result = sinks.append_inputs(spark, paths, f"{base}/target", ORDER_ITEM)
    assert result.rows == 3
    assert result.appended == [paths[1], paths[4]]
    assert set(result.failed) == {paths[2], paths[3]}
    stored = spark.read.parquet(f"{base}/target")
    assert sorted(r.order_number for r in stored.collect()) == ["1", "2", "5"]


@pytest.mark.parametrize("crash", ["staged", "ready", "first file", "moved"])
def test_append_after_a_crash_leaves_each_input_in_once(spark, items, monkeypatch, crash):
    """A crash before the first note, before the move, inside it, and before the last note."""
    base = folder()
    for name in ("one", "two"):
        items([{"number": f"{name}{i}"} for i in range(6)]).repartition(3).write.parquet(f"{base}/{name}")
    target = f"{base}/target"
    items([{"number": "older"}]).write.parquet(target)
    paths = [f"{base}/one", f"{base}/two"]

    class Killed(BaseException):
        pass

    def killed(*args):
        raise Killed

    moves = []

    def killed_after_one(self, other, name, take=sinks.Folder.take):
        if moves:
            raise Killed
        moves.append(name)
        take(self, other, name)

    with monkeypatch.context() as patch:
        if crash == "staged":
            patch.setattr(sinks.Manifest, "commit", killed)
        elif crash == "ready":
            patch.setattr(sinks._Append, "move", killed)
        elif crash == "first file":
            patch.setattr(sinks.Folder, "take", killed_after_one)
        else:
            patch.setattr(sinks.Folder, "remove", killed)
            commit = sinks.Manifest.commit
            patch.setattr(
                sinks.Manifest, "commit",
                lambda self, name, facts: commit(self, name, facts) if "files" in facts else killed(),
            )
        with pytest.raises(Killed):
            sinks.append_inputs(spark, paths, target, ORDER_ITEM, skip_first=False)
    result = sinks.append_inputs(spark, paths, target, ORDER_ITEM, skip_first=False)
    assert (result.rows, result.appended, result.repeated) == (12, paths, [])
    again = sinks.append_inputs(spark, paths, target, ORDER_ITEM, skip_first=False)
    assert (again.rows, again.appended, again.repeated) == (0, [], paths)
    stored = sorted(r.order_number for r in spark.read.parquet(target).collect())
    assert stored == ["older", *[f"one{i}" for i in range(6)], *[f"two{i}" for i in range(6)]]


def test_a_changed_input_and_an_empty_one(spark, items):
    base = folder()
    items([{"number": "1"}]).write.parquet(f"{base}/a b")
    items([]).write.parquet(f"{base}/none")
    paths = [f"{base}/a b", f"{base}/none"]
    first = sinks.append_inputs(spark, paths, f"{base}/t", ORDER_ITEM, skip_first=False)
    assert (first.rows, first.appended, first.failed) == (1, paths, {})
    items([{"number": "2"}, {"number": "3"}]).write.mode("overwrite").parquet(f"{base}/a b")
    second = sinks.append_inputs(spark, paths, f"{base}/t", ORDER_ITEM, skip_first=False)
    assert (second.rows, second.appended, second.repeated) == (2, paths[:1], paths[1:])
    assert spark.read.parquet(f"{base}/t").count() == 3


def test_csv_keeps_predictions(spark):
    row = [(1, None, 1, 0, 0.15, "Low Risk"), (2, "GOLD", 0, 1, 0.85, "High Risk")]
    df = spark.createDataFrame(row, PREDICTIONS)
    path = sinks.write_csv(df, sinks.stamped(folder(), "churn_predictions"))
    assert tables.read_csv(spark, path, PREDICTIONS).exceptAll(df).isEmpty()


def test_profile(spark, orders, params):
    header = orders([{"days": 1, "total": None}, {"days": 1, "member": None}, {"days": 500}])
    row = profile.data_quality(header).first()
    assert (row.total_orders, row.unique_customers, row.null_amounts, row.null_member_ids) == (3, 1, 1, 1)
    assert profile.summary_stats(header, params).first().total_orders == 2
    assert catalog.date_range(header, "order_date").first().unique_dates == 2
    info = catalog.table_info(header, "order_header").collect()
    assert [r.ordinal_position for r in info] == list(range(1, 9))
    assert profile.missing_values(header.select("grand_total", "member_id")).first()[0] == 2


def test_insights_follow_the_columns(modelling):
    sections = {r.section for r in insights(modelling).select("section").collect()}
    assert sections == {"basic_stats", "risk_factors"}
    segmented = rfm.rfm_segments(modelling)
    assert "segment_analysis" in {r.section for r in insights(segmented).collect()}
    bare = insights(modelling.select("member_id", "is_churned")).collect()
    assert {r.metric for r in bare} == {"total_customers", "churn_rate"}


def test_shared_folder_is_the_session_setting(spark):
    assert spark.sparkContext.getCheckpointDir() is not None
    assert shared_folder(spark)


def test_whole_run_and_regenerated_report(spark, params):
    source = tables.sample_tables(spark, "/root/testdata/sf0.001")
    out = folder()
    result = run(source, params, few_rounds(2), out)
    # At this scale no tier has enough rows: everything uses the global model.
    assert result.model.tiers == []
    assert result.predictions.count() == 71
    sections = {r.section for r in result.report.select("section").distinct().collect()}
    assert sections == {"pipeline_summary", "cohort_analysis", "data_summary", "model_performance", "top_features"}
    again = regenerate_report(spark, source, params, result.paths["model"], result.paths["predictions"])
    from ebbtide.__main__ import main

    source.order_header.write.parquet(f"{out}/h")
    source.order_item.write.parquet(f"{out}/i")
    main(
        ["report", "--header", f"{out}/h", "--items", f"{out}/i", "--as-of", "2001-08-01",
         "--model", result.paths["model"], "--predictions", result.paths["predictions"],
         "--output", f"{out}/again"],
        spark,
    )
    assert spark.read.parquet(f"{out}/again/*").count() == again.count()
    keep = ["cohort_analysis", "model_performance", "top_features"]
    a, b = (r.where(F.col("section").isin(keep)) for r in (result.report, again))
    assert a.exceptAll(b).isEmpty()
    data = {r.metric: r.value for r in again.where("section = 'data_summary'").collect()}
    assert data["total_customers"] == 71


@pytest.mark.parametrize("cut", ["save_model", "write_csv", "write_parquet"])
def test_a_run_that_is_cut_off_goes_on(spark, params, monkeypatch, cut):
    """The driver ends while a stage is written; finished stages are not made again."""
    import ebbtide.plans.run as whole

    source = tables.sample_tables(spark, "/root/testdata/sf0.001")
    out, settings = folder(), few_rounds(2)

    class Killed(BaseException):
        pass

    def half_written(df, path, *rest):
        spark.range(1).write.parquet(path if isinstance(path, str) else rest[0])
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(whole, cut, half_written if cut != "save_model" else lambda m, path, s: half_written(m, path))
        with pytest.raises(Killed):
            run(source, params, settings, out)
    with monkeypatch.context() as patch:
        made = []
        for name in ("churn_labels", "feature_set", "train_models", "predictions"):
            real = getattr(whole, name)
            patch.setattr(whole, name, lambda *a, name=name, real=real: made.append(name) or real(*a))
        result = run(source, params, settings, out)
    left = {"save_model": ["train_models", "predictions"], "write_csv": ["predictions"], "write_parquet": []}
    assert made == left[cut]
    assert result.predictions.count() == result.dataset.count() == 71
    fresh = run(source, params, settings, out, resume=False)
    assert not set(fresh.paths.values()) & set(result.paths.values())
    assert fresh.report.exceptAll(result.report).isEmpty() and result.report.exceptAll(fresh.report).isEmpty()


def test_a_run_is_known_by_settings_and_files(spark, params, orders, items):
    from dataclasses import replace

    from ebbtide.plans.run import run_key

    source = tables.sample_tables(spark, "/root/testdata/sf0.001")
    settings = few_rounds(2)
    key = run_key(source, params, settings)
    assert key == run_key(tables.sample_tables(spark, "/root/testdata/sf0.001"), params, settings)
    others = [
        run_key(source, replace(params, threshold=0.3), settings),
        run_key(source, params, few_rounds(3)),
        run_key(tables.sample_tables(spark, "/root/testdata/sf0.01"), params, settings),
    ]
    assert len({key, *others}) == 4
    assert run_key(tables.Tables(orders([{"days": 1}]), items([])), params, settings) is None


def test_append_command(spark, items, capsys):
    from ebbtide.__main__ import main

    base = folder()
    items([{"number": "1"}]).write.parquet(f"{base}/a")
    main(["append", "--target", f"{base}/t", f"{base}/a", f"{base}/a"], spark)
    assert "1 rows appended, 0 inputs left out" in capsys.readouterr().out


def test_bucketed_tables_join_without_a_shuffle(spark, orders, items):
    base = folder()
    header = orders([{"days": d, "number": str(d)} for d in range(40)])
    lines = items([{"number": str(n % 40)} for n in range(200)])
    sinks.write_bucketed(header, "bucketed_header", f"{base}/h", "order_number", 4)
    sinks.write_bucketed(lines, "bucketed_item", f"{base}/i", "order_number", 4)
    joined = (
        spark.table("bucketed_header").hint("merge").join(spark.table("bucketed_item"), "order_number")
    )
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert joined.count() == 200
    spark.sql("DROP TABLE bucketed_header")
    spark.sql("DROP TABLE bucketed_item")


def test_block_ranges_cover_a_table_once():
    for blocks, splits in ((0, 4), (1, 4), (10, 3), (64, 64), (1000, 7)):
        parts = tables.block_splits(blocks, splits)
        assert 1 <= len(parts) <= splits
        starts = [int(p.split("(")[1].split(",")[0]) for p in parts]
        ends = [int(p.split("(")[2].split(",")[0]) for p in parts if p.count("ctid") == 2]
        assert starts[0] == 0 and starts[1:] == ends and "<" not in parts[-1]
