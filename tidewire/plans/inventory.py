"""Queries over the catalog, declared layouts and scalar functions."""

from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.functions.text import is_blank, is_uuid, utf16_length
from tidewire.operators import catalog, layout
from tidewire.plans.oracle import blank, model, utf16, values
from tidewire.plans.records import published
from tidewire.plans.registry import register
from tidewire.sources import tables

# Layout the audit expects: one topic as published, one with another count, one that does not exist.
DESIRED = {schemas.USER_ACTIONS_TOPIC: 12, schemas.CONTENT_INTERACTIONS_TOPIC: 8, "dead-letters": 3}

_CATALOG = values(
    "c", "ordinal, category, event_type, description",
    [(at, *entry) for at, entry in enumerate(catalog.TAXONOMY, start=1)],
)
_DESIRED = values("d", "name, partitions", list(DESIRED.items()))


def _desired(spark):
    return spark.createDataFrame(list(DESIRED.items()), "name string, partitions int")


def _observed(spark, folder):
    return layout.observed_layout(published(spark, folder))


@register("taxonomy_catalog", model("typed", f"""
SELECT CAST(c.ordinal AS INTEGER) AS ordinal, c.category, c.event_type, c.description, count(t.event_id) AS n
FROM {_CATALOG} LEFT JOIN typed t ON c.category = t.category AND c.event_type = t.event_type GROUP BY ALL"""))
def taxonomy_catalog(spark, folder):
    return catalog.usage(tables.social_events(spark, folder))


@register("topic_catalog", model("pub", """
SELECT d.name, CAST(d.partitions AS INTEGER) AS partitions, CAST(3 AS SMALLINT) AS replication_factor,
       count(p.event_id) AS n
FROM (VALUES ('user-actions', 1000), ('content-interactions', 500)) AS d(name, partitions)
LEFT JOIN pub p ON p.topic = d.name GROUP BY ALL"""))
def topic_catalog(spark, folder):
    return catalog.topic_usage(published(spark, folder))


@register("catalog_report", model("typed", f"""
SELECT CAST(c.ordinal AS INTEGER) AS ordinal,
       CASE WHEN lag(c.category) OVER (ORDER BY c.ordinal) IS DISTINCT FROM c.category THEN c.category END AS header,
       c.event_type, coalesce(t.n, 0) AS n
FROM {_CATALOG}
LEFT JOIN (SELECT category, event_type, count(*) AS n FROM typed GROUP BY ALL) t
  ON c.category = t.category AND c.event_type = t.event_type"""))
def catalog_report(spark, folder):
    listed = catalog.report(catalog.usage(tables.social_events(spark, folder)))
    return listed.select("ordinal", "header", "event_type", "n")


@register("catalog_by_category", model("typed", """
SELECT category, CAST(CASE category WHEN 'UserActionEvent' THEN 5 WHEN 'ContentInteractionEvent' THEN 3 ELSE 2 END
       AS BIGINT) AS types, count(*) AS n
FROM typed GROUP BY category"""))
def catalog_by_category(spark, folder):
    return catalog.by_category(tables.social_events(spark, folder))


@register("catalog_lookup", model("typed", f"""
SELECT t.event_type, c.description, count(*) AS n
FROM typed t LEFT JOIN {_CATALOG} ON c.category = t.category AND c.event_type = t.event_type GROUP BY ALL"""))
def catalog_lookup(spark, folder):
    described = catalog.lookup(tables.social_events(spark, folder))
    return described.groupBy("event_type", "description").agg(F.count("*").alias("n"))


@register("catalog_unknown", model("typed", "SELECT 'MISC' AS event_type, count(*) AS n FROM typed WHERE k = 99"))
def catalog_unknown(spark, folder):
    read = F.when(F.col("k") == 99, F.lit("MISC")).otherwise(F.col("event_type"))
    unknown = catalog.unknown_types(tables.social_events(spark, folder).withColumn("event_type", read))
    return unknown.groupBy("event_type").agg(F.count("*").alias("n"))


@register("layout_missing", model("pub", f"""
SELECT DISTINCT name FROM {_DESIRED} WHERE name NOT IN (SELECT topic FROM pub)"""))
def layout_missing(spark, folder):
    return layout.missing(_desired(spark), _observed(spark, folder))


@register("layout_present", model("pub", f"SELECT name FROM {_DESIRED} WHERE name IN (SELECT topic FROM pub)"))
def layout_present(spark, folder):
    return layout.present(_desired(spark), _observed(spark, folder))


@register("layout_set_ops", model("pub", f"""
SELECT 'difference' AS operation, name FROM (SELECT name FROM {_DESIRED} EXCEPT ALL SELECT DISTINCT topic FROM pub)
UNION ALL
SELECT 'intersection', name FROM (SELECT name FROM {_DESIRED} INTERSECT SELECT topic FROM pub)"""))
def layout_set_ops(spark, folder):
    desired, observed = _desired(spark), _observed(spark, folder)
    left = layout.name_difference(desired, observed).select(F.lit("difference").alias("operation"), "name")
    both = layout.name_intersection(desired, observed).select(F.lit("intersection").alias("operation"), "name")
    return left.unionByName(both)


@register("layout_audit", model("pub", f"""
SELECT name,
  CASE WHEN found IS NULL THEN 'missing' WHEN found = partitions THEN 'verified' ELSE 'mismatched' END AS status,
  CASE WHEN found <> partitions
       THEN name || ' (expected ' || partitions || ' partitions, found ' || found || ')' END AS detail
FROM {_DESIRED} LEFT JOIN (SELECT topic, count(DISTINCT partition) AS found FROM pub GROUP BY topic) o
  ON o.topic = d.name"""))
def layout_audit(spark, folder):
    return layout.audit(_desired(spark), _observed(spark, folder))


@register("observed_layout", model("pub", """
SELECT topic, CAST(count(DISTINCT partition) AS INTEGER) AS partitions FROM pub GROUP BY topic"""))
def observed_layout(spark, folder):
    return _observed(spark, folder)


@register("scalar_functions", model("typed", f"""
SELECT event_id,
  category || '/' || event_type AS concatenated,
  event_type || ' … ' || k AS formatted,
  printf('%-28s', event_type) AS padded,
  contains(event_type, 'POST') AS has_post,
  user_id IS NOT DISTINCT FROM 'user-1' AS is_user_1,
  repeat('-', k) AS ruled,
  {blank('user_id')} AS blank,
  CAST({utf16('event_type')} AS INTEGER) AS units,
  coalesce(target_id, '-') AS target,
  CAST(coalesce(CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) END, '1000') AS INTEGER) AS option_value,
  k % 7 AS remainder,
  CAST(length(event_type) AS DOUBLE) / (k + 1) AS quotient,
  CAST(greatest(1, k) AS INTEGER) AS at_least_one,
  CAST(least(ceil(k / 30.0), 2) AS BIGINT) AS capped,
  epoch_us(TIMESTAMP '2024-01-30 00:00:00' - occurred_at) AS elapsed_us,
  occurred_at + INTERVAL 7 DAY AS kept_until,
  k % 5 <> 0 AS uuid_shaped,
  CASE category WHEN 'UserActionEvent' THEN 'userId' WHEN 'ContentInteractionEvent' THEN 'contentId' END AS key_field,
  ['CONTENT_LIKED', 'CONTENT_COMMENTED', 'CONTENT_SHARED'][k % 3 + 1] AS picked,
  '1,2,' || k AS last_three,
  CAST(k AS VARCHAR) AS from_json_text
FROM typed"""))
def scalar_functions(spark, folder):
    """One column per family of scalar functions, over every event."""
    k = F.col("k")
    keys = F.create_map(
        F.lit(schemas.USER_ACTION), F.lit("userId"), F.lit(schemas.CONTENT_INTERACTION), F.lit("contentId")
    )
    option = F.create_map(F.lit("partitions"), F.when(k % 2 == 0, k.cast("string")))["partitions"]
    appended = F.concat(F.array(F.lit(0), F.lit(1), F.lit(2)), F.array(k))
    elapsed = F.timestamp_diff("MICROSECOND", F.col("occurred_at"), F.expr(tables.NOW))
    document = F.to_json(F.struct(k.alias("k")))
    return tables.social_events(spark, folder).select(
        "event_id",
        F.concat("category", F.lit("/"), "event_type").alias("concatenated"),
        F.format_string("%s … %d", "event_type", k).alias("formatted"),
        F.format_string("%-28s", "event_type").alias("padded"),
        F.col("event_type").contains("POST").alias("has_post"),
        F.col("user_id").eqNullSafe("user-1").alias("is_user_1"),
        F.repeat(F.lit("-"), k).alias("ruled"),
        F.expr(is_blank("user_id")).alias("blank"),
        F.expr(utf16_length("event_type")).alias("units"),
        F.coalesce("target_id", F.lit("-")).alias("target"),
        F.coalesce(option, F.lit("1000")).cast("int").alias("option_value"),
        F.pmod(k, F.lit(7)).alias("remainder"),
        (F.length("event_type") / (k + 1)).alias("quotient"),
        F.greatest(F.lit(1), k).alias("at_least_one"),
        F.least(F.ceil(k / 30), F.lit(2)).cast("bigint").alias("capped"),
        elapsed.alias("elapsed_us"),
        (F.col("occurred_at") + F.expr("INTERVAL 7 DAYS")).alias("kept_until"),
        # One id in five is a digit short.
        F.expr(is_uuid("IF(k % 5 = 0, left(event_id, 35), event_id)")).alias("uuid_shaped"),
        F.element_at(keys, F.col("category")).alias("key_field"),
        F.element_at(F.array(*map(F.lit, schemas.INTERACTION_TYPES)), k % 3 + 1).alias("picked"),
        F.array_join(F.slice(appended, 2, 3).cast("array<string>"), ",").alias("last_three"),
        F.from_json(document, "k string")["k"].alias("from_json_text"),
    )
