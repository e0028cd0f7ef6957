"""The catalogue as SQL text over the archive's views."""

from __future__ import annotations

from zonelens.operators.housekeeping import shard_config
from zonelens.plans import fixture as X
from zonelens.plans.q_archive import W_ARCH
from zonelens.plans.registry import register
from zonelens.sources.views import register_views


def _sql(spark, sf, text: str):
    register_views(spark, X.archive_root(spark, sf), prefix="archive_")
    return spark.sql(text)


@register("sql_top_asn", W_ARCH + """
SELECT a AS asn, count(*) AS n_rows FROM aobs WHERE k = 'ip' AND topic = 'domains'
GROUP BY a QUALIFY row_number() OVER (ORDER BY n_rows DESC, asn NULLS LAST) <= 15""")
def sql_top_asn(spark, sf):
    return _sql(spark, sf, """
        SELECT a AS asn, count(*) AS n_rows FROM archive_observations
        WHERE topic_name = 'newly_registered_domains_measurements' AND k = 'ip'
        GROUP BY a ORDER BY n_rows DESC, asn NULLS LAST LIMIT 15""")


@register("sql_window_counts", W_ARCH + """
SELECT topic_name AS topic, date, hour, count(*) AS n_rows FROM aobs GROUP BY ALL""")
def sql_window_counts(spark, sf):
    return _sql(spark, sf, """
        SELECT topic_name AS topic, date, hour, count(*) AS n_rows FROM archive_observations GROUP BY 1, 2, 3""")


@register("sql_short_windows", W_ARCH + """
SELECT topic_name AS topic, date, hour, count(DISTINCT shard) AS shards_present, any_value(shards) AS shards_expected
FROM aobs JOIN cfg USING (topic_name) GROUP BY 1, 2, 3 HAVING shards_present < shards_expected""")
def sql_short_windows(spark, sf):
    shard_config(spark).createOrReplaceTempView("archive_shards")
    return _sql(spark, sf, """
        SELECT topic, date, hour, shards_present, shards AS shards_expected
        FROM (SELECT topic, date, hour, count(DISTINCT shard) AS shards_present
              FROM archive_inventory GROUP BY topic, date, hour)
        JOIN archive_shards USING (topic) WHERE shards_present < shards""")
