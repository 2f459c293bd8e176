"""The models between tables and marts as lasting SQL views.

A view is its text in the catalog: any session of the catalog sees it, and it is evaluated when it is read, so it shows what is stored
then. The texts read the tables' folders, whose files are listed each time, and need no refresh after a load.
"""

from __future__ import annotations

from fareline.functions.scalars import DAY_PARTS, OTHER_DAY_PART
from fareline.schemas import CONFORMED, DERIVED, QUALITY_TABLE, REJECTED_TABLE, TRIPS_TABLE, TableLayout
from fareline.sources.lake import Lake


def _columns(layout: TableLayout) -> str:
    return ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in layout.schema.fields)


def _stored(lake: Lake, layout: TableLayout) -> str:
    return f"SELECT {_columns(layout)} FROM parquet.`{lake.location(layout)}`"


def _hundredths(scaled: str) -> str:
    """Rounded to a whole number, halves away from zero, and divided by 100."""
    return f"(CASE WHEN abs({scaled} - rint({scaled})) = 0.5D THEN {scaled} + signum({scaled}) * 0.5D ELSE rint({scaled}) END / 100.0D)"


def _day_part(hour: str) -> str:
    return "CASE " + " ".join(f"WHEN {hour} BETWEEN {low} AND {high} THEN '{name}'" for name, low, high in DAY_PARTS) + (
        f" ELSE '{OTHER_DAY_PART}' END")


def view_texts(lake: Lake) -> dict[str, str]:
    """SQL by view name; later views read earlier ones."""
    staged, database = ", ".join(f"`{name}`" for name in CONFORMED.names), f"`{lake.database}`"
    derived = {
        "trip_duration_minutes": "(dropoff_datetime - pickup_datetime) DIV INTERVAL '1' MINUTE",
        "tip_percentage": _hundredths("scaled_tip"), "revenue_per_mile": _hundredths("scaled_revenue"),
        "time_of_day": _day_part("hour(pickup_datetime)"), "pickup_hour": "hour(pickup_datetime)",
        "day_of_week": "dayofweek(pickup_date)", "pickup_month": "month(pickup_date)", "pickup_year": "year(pickup_date)"}
    added = ", ".join(f"{derived[f.name]} AS `{f.name}`" for f in DERIVED.fields)
    order = ", ".join(f"`{key[1:]}` DESC" if key.startswith("-") else f"`{key}`" for key in QUALITY_TABLE.read_order)
    return {
        "stg_trips": _stored(lake, TRIPS_TABLE),
        "int_trips_enriched": f"""SELECT {staged}, {added} FROM (
  SELECT *, CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount END * 100.0D * 100.0D AS scaled_tip,
         CASE WHEN trip_distance > 0 THEN total_amount / trip_distance END * 100.0D AS scaled_revenue
  FROM {database}.`stg_trips`)""",
        "int_data_quality": f"""SELECT trunc(ingestion_date, 'month') AS ingestion_month, service_type, reason_code,
  count(*) AS rejected_count FROM ({_stored(lake, REJECTED_TABLE)}) GROUP BY ALL""",
        "monthly_data_quality": f"SELECT * FROM ({_stored(lake, QUALITY_TABLE)}) ORDER BY {order}",
    }


def create_views(lake: Lake) -> list[str]:
    """Create or replace every view whose table was stored, in the lake's database; their names."""
    lake.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{lake.database}` LOCATION '{lake.root}'")
    needed = {"stg_trips": TRIPS_TABLE, "int_trips_enriched": TRIPS_TABLE, "int_data_quality": REJECTED_TABLE,
              "monthly_data_quality": QUALITY_TABLE}
    made = []
    for name, text in view_texts(lake).items():
        if lake.exists(needed[name]):
            lake.spark.sql(f"CREATE OR REPLACE VIEW `{lake.database}`.`{name}` AS {text}")
            made.append(name)
    return made
