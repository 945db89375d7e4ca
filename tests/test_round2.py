"""Values that once came out wrong: constants, NaN, odd numbers, grids, absent tables, staging."""

from __future__ import annotations

import dataclasses
import os
import subprocess
import sys

from pyspark.sql import functions as F

from churnlake.functions.expressions import to_number
from churnlake.operators.evaluate import grid_points
from churnlake.operators.mlprep import fit_scaler
from churnlake.operators.snapshot import training_features
from churnlake.session import clear_staged, drop_staged, stage
from churnlake.sources.tables import read_table, read_tables
from tests.conftest import REF


def test_constant_column_has_its_value_and_scale_one(spark):
    scaler = fit_scaler(spark.range(1000).select(F.lit(0.1).alias("x")), ["x"])
    assert scaler.means == {"x": 0.1}
    assert list(vars(scaler).values())[1] == {"x": 1.0}


def test_numbers_as_texts(spark):
    rows = [("1.0d",), ("2f",), ("1_0",), (" 3e2\n",), ("x",), ("1__0",), ("-.5",), ("inf",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t STRING").select(
        to_number(F.col("t"))).collect()]
    assert got == [None, None, 10.0, 300.0, None, None, -0.5, float("inf")]


def test_grid_is_clipped_and_unique():
    points = grid_points((-0.5, 1.5, 9))
    assert points[0] == 0.0 and points[-1] == 1.0 and len(points) == len(set(points)) == 5


def test_nan_is_missing_and_types_are_declared(spark, tmp_path):
    frame = spark.sql("SELECT '7' AS order_id, 1L AS user_id, double('nan') AS total_amount")
    frame.write.parquet(f"{tmp_path}/o.parquet")
    row = read_table(spark, f"{tmp_path}/o.parquet", "orders", "parquet").first()
    assert row["order_id"] == 7 and row["total_amount"] is None


def test_order_items_may_be_absent(spark, small_shop, tmp_path):
    for name in ("users", "orders", "user_logins", "cart_items"):
        getattr(small_shop, name).write.parquet(f"{tmp_path}/{name}.parquet")
    tables = read_tables(spark, str(tmp_path), "parquet")
    assert tables.order_items is None
    without = dataclasses.replace(small_shop, order_items=None, user_interests=None)
    assert training_features(without, REF).count() == small_shop.users.count()


def test_staged_tables_can_be_dropped(spark):
    kept, gone = stage(spark.range(3), "kept"), stage(spark.range(3), "gone")
    drop_staged(gone)
    assert kept.count() == 3
    assert clear_staged(spark) >= 1


def test_entry_runs_without_any_spark_configuration(tmp_path):
    code = ("import __spark_entry__ as e; from pyspark.sql import SparkSession as S; "
            "s = S.builder.master('local[2]').config('spark.sql.shuffle.partitions', 2)"
            ".config('spark.ui.enabled', 'false').getOrCreate(); "
            "assert not s.conf.get('spark.checkpoint.dir', None); print(e.entry(s).count())")
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=top, capture_output=True, text=True,
                          env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)}, timeout=300)
    assert done.stdout.strip().endswith("4"), done.stderr[-2000:]
