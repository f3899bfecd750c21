"""Large tables are joined by shuffle: no plan broadcasts one because its estimate is small."""

from __future__ import annotations

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from cadastra import session
from cadastra.plans import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "name",
    [
        "points_in_cells",
        "points_listed",
        "cell_label_distinct",
        "bisect_mixed_cells",
        "pairs_differing_label",
        "majority_neighbor_fill",
        "nearest_foot_on_boundary",
        "road_length_in_cells",
        "roads_in_area_semi",
        "dissolve_area",
        "fill_sequential",
        "straighten_borders",
        "shared_border_lines",
    ],
)
def test_no_broadcast(spark, monkeypatch, name):
    """Tables that are written on the way count as large."""
    plans, parquet = [], DataFrameWriter.parquet

    def noted(self, *args, **options):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        parquet(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    monkeypatch.setattr(session, "MOST_BROADCAST", -1, raising=False)
    df = registry.queries()[name](spark, FOLDER)
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert [p for p in plans if "BroadcastExchange" in p] == []
