"""Page-view attribution monitor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmeter import constants as C
from trailmeter.functions.labels import has_click_macro
from trailmeter.sources.days import read_days


def page_view_monitor(page_views: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Views, views joined to a billed click, and views with an unreplaced macro, per channel."""
    measures = {
        "pv": F.count(F.lit(1)),
        "join_click_pv": F.count_if(F.col("is_join_clikc_flag") == "1"),
        "jdv_click_id_macro_replace_faild": F.count_if(has_click_macro(F.col("clk_utm_term"))),
    }
    return (
        read_days(page_views, start, end)
        .groupBy("dt", *C.PAGE_VIEW_CHANNELS)
        .agg(*[m.cast("double").alias(name) for name, m in measures.items()])
    )
