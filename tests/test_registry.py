"""Every registered query runs on the smallest data set and equals its oracle SQL."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
import tools_check
from tests.conftest import TESTDATA

from churnlake.registry import ORACLE, QUERIES  # noqa: E402

# The operator inventory: S1-S11, P1-P16, J1-J4, A1-A25, W1-W6, T1-T5, F, H, M, L, E.
INVENTORY = {"s": 11, "p": 16, "j": 4, "a": 25, "w": 6, "t": 5, "f": 14, "h": 3, "m": 6, "l": 12, "e": 16}
# Fits without an SQL form; each is held against a computation of our own in test_models.
ROWS_ONLY = {"h_p_values", "l1_logistic_scores", "l2_coefficients", "l3_forest_scores",
             "l4_boosting_scores", "l5_feature_importance", "l6_cox_model", "l7_kmeans",
             "l8_silhouette_by_k", "l9_ward_groups", "l10_merge_table", "l11_pca",
             "l12_multi_model"}


@pytest.fixture(scope="module")
def duck():
    return tools_check.connect(TESTDATA)


def test_every_operator_is_registered():
    ids = {m.group(1) for name in QUERIES if (m := re.match(r"([a-z]\d+)_", name))}
    for name in QUERIES:                                # f5_f11_conditions covers F5 to F11
        if m := re.match(r"([a-z])(\d+)_\1(\d+)_", name):
            ids |= {f"{m.group(1)}{i}" for i in range(int(m.group(2)), int(m.group(3)) + 1)}
    missing = {f"{k}{i}" for k, n in INVENTORY.items() for i in range(1, n + 1)} - ids
    assert missing == set()


def test_all_but_the_fits_have_an_oracle():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, clean_cache, duck, name):
    result, _, _ = tools_check.compare(spark, duck, TESTDATA, name)
    assert result.startswith("rows only" if name in ROWS_ONLY else "ok"), result


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == entry.entry(spark).columns
    assert df.count() == 4
