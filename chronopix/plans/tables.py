"""Queries over wide tables, cohorts and worklists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.functions import scalar
from chronopix.functions.scalar import tidy
from chronopix.operators import linalg, ordering, stats
from chronopix.registry import query
from chronopix.sources.roles import KEYPOINTS, keypoints, table

K = f"WITH {KEYPOINTS}"
ID = ["trial_id", "l_orderkey", "l_linenumber", "l_partkey"]
ID_SQL = "trial_id, l_orderkey, l_linenumber, l_partkey"


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity * 100 * 5, 6) AS v_raw, round((l_discount - pi()) / pi() * 180, 6) + 0.0 AS th_raw, round(l_tax * 5, 6) AS x FROM lineitem")
def unit_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed by frame rate and radius, direction in degrees around zero."""
    rate, radius = 100, 5
    turn = (F.col("l_discount") - F.pi()) / F.pi() * 180
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_quantity") * rate * radius, 6).alias("v_raw"), tidy(turn).alias("th_raw"), F.round(F.col("l_tax") * radius, 6).alias("x"))


@query("SELECT COLUMNS('l_.*key|l_tax') FROM lineitem")
def regex_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.expr("*")).select(table(spark, sf_dir, "lineitem").colRegex("`l_.*key|l_tax`"))


@query(f"""{K}, s AS (SELECT *, sqrt((ax - bx) ** 2 + (ay - "by") ** 2) * sqrt((cx - bx) ** 2 + (cy - "by") ** 2) AS size FROM keypoints)
 SELECT {ID_SQL}, round(degrees(acos(greatest(least(((ax - bx) * (cx - bx) + (ay - "by") * (cy - "by")) / nullif(size, 0), 1), -1))), 4) + 0.0 AS angle FROM s""")
def joint_angle(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = keypoints(spark, sf_dir)
    return k.select(*ID, tidy(scalar.angle(*[F.col(c) for c in ("ax", "ay", "bx", "by", "cx", "cy")]), 4).alias("angle"))


@query(f"""{K}, m AS (SELECT trial_id, quantile_cont(bx, 0.5) AS mx FROM keypoints GROUP BY ALL) SELECT {ID_SQL}, round(sqrt((ax - bx) * (ax - bx) + (ay - "by") * (ay - "by")), 4) AS dist, round(ax - mx, 8) + 0.0 AS rel FROM keypoints JOIN m USING (trial_id)""")
def keypoint_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = keypoints(spark, sf_dir)
    middle = k.groupBy("trial_id").agg(F.percentile("bx", F.lit(0.5)).alias("mx"))
    return k.join(middle, "trial_id").select(*ID, F.round(scalar.distance(*[F.col(c) for c in ("ax", "ay", "bx", "by")]), 4).alias("dist"), tidy(F.col("ax") - F.col("mx"), 8).alias("rel"))


@query(f"{K} SELECT trial_id, round(1 - var_pop(cy - 2 * cx) / nullif(var_pop(cy), 0), 6) + 0.0 AS explained FROM keypoints GROUP BY ALL")
def var_explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keypoints(spark, sf_dir).groupBy("trial_id").agg(tidy(stats.variance_explained(F.col("cy"), 2 * F.col("cx"))).alias("explained"))


@query(f"""{K} SELECT trial_id, round(avg(cx), 6) AS centre_x, round(avg(cy), 6) AS centre_y, round(sqrt(1 + corr(cx, cy)), 6) AS radius_x, round(sqrt(1 - corr(cx, cy)), 6) AS radius_y,
 round(sqrt(var_samp(cx)) * 2, 6) AS scale_x, round(sqrt(var_samp(cy)) * 2, 6) AS scale_y FROM keypoints GROUP BY ALL""")
def ellipse_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = stats.ellipse(keypoints(spark, sf_dir), "cx", "cy", 2.0, ["trial_id"])
    return got.select("trial_id", *[F.round(c, 6).alias(c) for c in got.columns[1:]])


@query(f"{K} SELECT trial_id, round(sum(cx * cy) / (sum(cx * cx) + 0.001), 6) AS weight FROM keypoints GROUP BY ALL")
def ridge_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.ridge_1d(keypoints(spark, sf_dir), "cx", "cy", 0.001, ["trial_id"]).withColumn("weight", F.round("weight", 6))


@query(f"""{K}, p AS (SELECT trial_id, cx, cy, CASE WHEN s = 0 THEN 0 ELSE least(frame // s, 5) END AS fold FROM (SELECT *, count(*) OVER (PARTITION BY trial_id) // 6 AS s FROM keypoints)),
 s AS (SELECT trial_id, fold, sum(cx * cy) AS xy, sum(cx * cx) AS xx FROM p GROUP BY ALL), w AS (SELECT trial_id, fold, (sum(xy) OVER t - xy) / (sum(xx) OVER t - xx + 0.001) AS w FROM s WINDOW t AS (PARTITION BY trial_id))
 SELECT trial_id, round(1 - var_pop(cy - w * cx) / nullif(var_pop(cy), 0), 6) + 0.0 AS var_explained FROM p JOIN w USING (trial_id, fold) GROUP BY ALL""")
def ridge_cv_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.ridge_cv_1d(keypoints(spark, sf_dir), "cx", "cy", 0.001, 6).withColumn("var_explained", tidy(F.col("var_explained")))


@query()
def ridge_nested_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = keypoints(spark, sf_dir).withColumns({"outer": F.pmod(F.xxhash64(*ID), F.lit(6)), "inner": F.pmod(F.xxhash64(*ID, F.lit(1)), F.lit(5)), "one": F.lit(1.0)})
    return linalg.ridge_nested(k, ["cx", "ay", "by", "one"], "cy", "outer", "inner", [10.0**e for e in range(-3, 4)])


@query("SELECT d.doc_id, d.lang, CASE WHEN l.quality = 1 THEN 'good' ELSE 'poor' END AS quality, CASE WHEN l.toxic = 1 THEN 'toxic' ELSE 'clean' END AS toxic FROM documents d JOIN labels l USING (doc_id)")
def label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    return named.select("doc_id", "lang", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("quality"), F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("toxic"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')")
def todo_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").where(F.col("o_orderpriority").startswith("1")).select(F.col("o_custkey").alias("c_custkey"))
    return ordering.still_to_do(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), done, ["c_custkey"])


@query("""WITH p AS (SELECT * FROM (VALUES ('UNITED S'), ('UNITED'), ('CHI'), ('FRA'), ('nation_1'), ('NATION_2')) v(prefix)) SELECT prefix, n_nationkey, n_name FROM nation JOIN p ON starts_with(n_name, prefix) QUALIFY count(*) OVER (PARTITION BY prefix) = 1""")
def prefix_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefixes = spark.createDataFrame([("UNITED S",), ("UNITED",), ("CHI",), ("FRA",), ("nation_1",), ("NATION_2",)], "prefix string")
    return ordering.picked_by_prefix(table(spark, sf_dir, "nation"), "n_name", prefixes).select("prefix", "n_nationkey", "n_name")


@query("""SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS place FROM orders""")
def priority_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places within each priority; ordering by (priority, place) is the global order."""
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("double")
    return ordering.numbered(orders, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], day).select("o_orderpriority", "o_orderkey", "place")


@query("""SELECT s_suppkey, CASE WHEN TRY_CAST(substr(s_name, 1, 6) AS INTEGER) IS NULL THEN 123456 ELSE TRY_CAST(substr(s_name, 1, 6) AS INTEGER) END AS date,
 CASE WHEN length(s_name) > 7 THEN substr(s_name, 8) ELSE 'param' END AS genotype, coalesce(TRY_CAST(right(s_name, 1) AS INTEGER), 0) AS fly FROM supplier""")
def experiment_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scalar.experiment(F.col("s_name"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", *[c.alias(n) for n, c in got.items()])


@query("""SELECT c_mktsegment AS cohort, c_name AS trial FROM customer WHERE NOT contains(c_name, '7')""")
def discover_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cohort's trials, one row each."""
    return table(spark, sf_dir, "customer").where(~F.col("c_name").contains("7")).select(F.col("c_mktsegment").alias("cohort"), F.col("c_name").alias("trial"))


@query("""SELECT 'a' AS dir, 'all' AS trials, 'tif' AS task, false AS forced, '' AS arguments UNION ALL SELECT 'a', 'all', 'dff', true, '' UNION ALL SELECT 'b', 't1,t2', 'df', false, 'x=1'""")
def worklist_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.createDataFrame([("a || all || tif, !dff",), ("# nothing",), ("",), ("b||t1,t2||df||x=1 # later",)], "value string")
    return ordering.parsed_worklist(lines)


@query("SELECT 'a' AS dir, 'dff' AS task UNION ALL SELECT 'b', 'tif'")
def dag_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = spark.createDataFrame([("a", "dff"), ("b", "dff"), ("b", "tif"), ("a", "video")], "dir string, task string")
    needs = spark.createDataFrame([("dff", "tif"), ("video", "dff"), ("video", "sync")], "task string, before string")
    done = spark.createDataFrame([("a", "tif"), ("a", "sync")], "dir string, task string")
    return ordering.ready_tasks(todo, needs, done)


@query("SELECT count(DISTINCT l_returnflag) AS flags, count(DISTINCT l_suppkey) AS suppliers, count(*) AS n FROM lineitem")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.count_distinct("l_returnflag").alias("flags"), F.count_distinct("l_suppkey").alias("suppliers"), F.count("*").alias("n"))
