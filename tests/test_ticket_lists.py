"""The entries that list every inactive ticket leave none out."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from footfall.operators import export as ex
from footfall.plans.views import tables
from footfall.rules import STATE

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["d5_state_in_all_lifetimes", "a10_a11_all_tickets_export"])
def test_every_inactive_ticket_is_listed(spark, name):
    made = tables(spark, SF)
    gone = {r[0] for r in made[STATE].where("state_value = 'Inactive' and ticket_id is not null").select("ticket_id").distinct().collect()}
    living = {r.ticket_id for r in ex.ticket_timeframes(made).collect() if r.first_seen < r.last_seen}
    rows = entry_points.queries()[name](spark, SF)
    if "table_name" in rows.columns:
        rows = rows.where(F.col("table_name") == STATE)
    assert any(not t.endswith("3") for t in gone & living)
    assert {r[0] for r in rows.select("for_ticket").distinct().collect()} == gone & living
