"""What the operators are strung into: feed loads, models, and the whole refresh."""

from .bucketed import CrashBuckets
from .catalog import publish_catalog
from .feeds import (
    KeyForm,
    Layout,
    clean_pages,
    conform,
    conform_csv,
    keyed_rows,
    load_conformed,
    load_pages,
    page_report,
    report_pages,
    stage_pages,
    widen,
)
from .kept_fact import KeptFact
from .models import (
    age_distri,
    build_models,
    crashes_location,
    fact_traffic_accidents,
    stg_persons_data,
    stg_traffic_data,
    stg_vehicles_data,
)
from .refresh import compact_feeds, full_refresh, publish_models, read_tables

__all__ = [
    "CrashBuckets",
    "KeptFact",
    "KeyForm",
    "Layout",
    "age_distri",
    "build_models",
    "clean_pages",
    "compact_feeds",
    "conform",
    "conform_csv",
    "crashes_location",
    "fact_traffic_accidents",
    "full_refresh",
    "keyed_rows",
    "load_conformed",
    "load_pages",
    "page_report",
    "publish_catalog",
    "publish_models",
    "read_tables",
    "report_pages",
    "stage_pages",
    "stg_persons_data",
    "stg_traffic_data",
    "stg_vehicles_data",
    "widen",
]
