from __future__ import annotations

from shelfstar import session


def test_fixed_settings_are_left_alone(spark, monkeypatch):
    fixed = {"spark.sql.warehouse.dir": "elsewhere", "spark.sql.session.timeZone": "UTC"}
    monkeypatch.setattr(session, "SETTINGS", fixed)
    session.use_settings(spark)
    assert spark.conf.get("spark.sql.warehouse.dir") != "elsewhere"


def test_settled_rows_are_kept(spark):
    assert session.settle(spark.range(5)).count() == 5
    assert spark.sparkContext.getCheckpointDir()
