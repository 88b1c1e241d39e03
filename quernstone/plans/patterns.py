"""Event patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quernstone.operators.patterns import sequences
from quernstone.plans.catalog import query
from quernstone.sources.tables import table


@query("""
    WITH pairs AS (SELECT c.user_id, c.event_id AS click, c.ts AS clicked, v.event_id AS view, v.ts AS viewed FROM (SELECT * FROM events WHERE event_type = 'click') c ASOF JOIN (SELECT * FROM events WHERE event_type = 'view') v ON c.user_id = v.user_id AND v.ts < c.ts),
    found AS (SELECT view AS view_1, click AS click_2, p.event_id AS purchase_3, row_number() OVER (PARTITION BY p.event_id ORDER BY clicked DESC) AS place FROM events p JOIN pairs ON p.user_id = pairs.user_id AND clicked < p.ts AND viewed >= p.ts - INTERVAL 1 DAY WHERE p.event_type = 'purchase')
    SELECT view_1, click_2, purchase_3 FROM found WHERE place = 1""")
def event_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases that a click came before, and before that a view, of the same user within a day."""
    return sequences(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", "event_type", ["view", "click", "purchase"], 86_400)
