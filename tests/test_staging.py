"""Where staged tables live and when they go."""

import os
import subprocess
import sys
import textwrap

from tillscope.sources.lake import scratch, stage


def test_scratch_removes_its_tables(spark):
    with scratch(spark) as folder:
        df = stage(spark.range(10), "numbers")
        assert df.count() == 10
        place = folder.removeprefix("file:")
        assert os.listdir(place)
    assert not os.path.exists(place)
    assert stage(spark.range(3), "later").count() == 3


def test_nothing_is_left_when_the_application_ends(tmp_path):
    code = textwrap.dedent(
        """
        import sys
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
        spark = spark.config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
        from tillscope.sources.lake import stage
        stage(spark.range(5), "five").count()
        import os
        print("FILES", len([f for f in os.listdir(sys.argv[1]) if f.startswith("tillscope-")]))
        spark.stop()
        """
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tmp_path / "shared"
    folder.mkdir()
    done = subprocess.run(
        [sys.executable, "-c", code, str(folder)], capture_output=True, text=True, timeout=120, cwd=str(tmp_path),
        env=os.environ | {"PYTHONPATH": root},
    )
    assert "FILES 1" in done.stdout, done.stderr[-2000:]
    assert not [f for f in os.listdir(folder) if f.startswith("tillscope-")]


def test_columns_that_follow_are_not_moved(spark, monkeypatch):
    """Raw rows are not written on the way to the transactions, and only what nothing else gives is shuffled by month."""
    from tests.conftest import SF_DIR
    from tillscope import lakehouse as lakes

    moved, stage = {}, lakes.stage

    def recording(df, name, *args, **options):
        moved[name] = df.columns
        return stage(df, name, *args, **options)

    monkeypatch.setattr(lakes, "stage", recording)
    lake = lakes.Lakehouse(spark, SF_DIR)
    assert lake.transactions.columns == [*lakes._TRANSACTION_COLUMNS[:-1], "is_fraud", "txn_month"]
    assert "raw-transactions" not in moved
    follow = {"fraud_score", "risk_level", "transaction_hour", "weekend_flag", "txn_hour", "is_weekend", "is_high_value", "is_late_night", "is_fraud"}
    assert follow == set(lake.transactions.columns) - set(moved["transactions"])
    assert moved["transactions"] == moved["scored-transactions"]
    # The label of the top fraction is the same as over the scored rows.
    rest = lake.transactions.select(lake.scored.columns + ["is_fraud"])
    assert rest.exceptAll(lake.top_fraction.label(lake.scored)).count() == 0
    assert rest.count() == lake.scored.count()


def test_reviews_do_not_write_the_raw_transactions(spark, monkeypatch):
    from tests.conftest import SF_DIR
    from tillscope import lakehouse as lakes

    names, stage = [], lakes.stage

    def recording(df, name, *args, **options):
        names.append(name)
        return stage(df, name, *args, **options)

    monkeypatch.setattr(lakes, "stage", recording)
    lake = lakes.Lakehouse(spark, SF_DIR)
    assert lake.reviews.count() > 0
    assert sorted(names) == ["customers", "merchants", "reviews", "scored-transactions"]
