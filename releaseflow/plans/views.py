"""SQL access: the serving views as temp views over the enriched table.

``register_views(spark, enriched)`` exposes ``releases_enriched`` and the four
views users query today, each being the report of ``operators.reports`` it names,
so their SQL keeps working, for example ``SELECT * FROM surprise_leaderboard`` or
``SELECT release_name, period, value FROM releases_enriched WHERE is_anomaly``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from releaseflow.operators import reports


def register_views(spark: SparkSession, enriched: DataFrame, as_of: str | None = None,
                   recent_days: int = 90) -> list[str]:
    """Register ``releases_enriched`` and the serving views as temp views; return their names."""
    views = {
        "releases_enriched": enriched,
        "latest_by_indicator": reports.latest_by_indicator(enriched),
        "recent_high_impact": reports.recent_high_impact(enriched, recent_days, as_of),
        "fomc_history": reports.fomc_rate_change(enriched),
        "surprise_leaderboard": reports.surprise_leaderboard(enriched),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
