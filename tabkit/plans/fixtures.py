"""Stand-in inputs built from the test tables, each as a Spark plan and as the
equivalent DuckDB SQL (used inside the oracle queries of the catalog).

``survey`` (one row per order) plays the study's survey table: keys, nullable
strings, nullable numbers and a 0/1 target; gaps are made by rule because the
test tables have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.session import table

SURVEY_SQL = """
select o_orderkey as id, c_name as name,
       case when o_orderkey % 11 = 0 then null else o_orderstatus end as status,
       c_mktsegment as segment,
       case when o_orderkey % 19 = 0 then null else o_orderpriority end as priority,
       n_name as nation,
       case when o_orderkey % 13 = 0 then null else o_totalprice end as price,
       case when c_custkey % 17 = 0 then null else c_acctbal end as acctbal,
       cast(extract(month from o_orderdate) as int) as month,
       case when o_totalprice/1000 + c_acctbal/100 + (o_orderkey*7919+104729)%101 > 345
            then 1 else 0 end as label
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""

# Column roles of the survey stand-in.
SURVEY_TARGET = "label"
SURVEY_NUMERIC = ["price", "acctbal", "month"]
SURVEY_ONE_HOT = ["status", "segment"]
SURVEY_ORDINAL = ["priority", "nation"]
SURVEY_CATEGORICAL = ["status", "segment", "priority", "nation"]
SURVEY_DROP = ["id", "name"]


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("o_orderkey")
    score = F.col("o_totalprice") / 1000 + F.col("c_acctbal") / 100 + (key * 7919 + 104729) % 101
    return j.select(
        key.alias("id"),
        F.col("c_name").alias("name"),
        F.when(key % 11 == 0, None).otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("c_mktsegment").alias("segment"),
        F.when(key % 19 == 0, None).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.col("n_name").alias("nation"),
        F.when(key % 13 == 0, None).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(F.col("c_custkey") % 17 == 0, None).otherwise(F.col("c_acctbal")).alias("acctbal"),
        F.month("o_orderdate").cast("int").alias("month"),
        F.when(score > 345, 1).otherwise(0).alias("label"),
    )


# Fixed scorer used where a model's output is needed with a known answer.
PRICE_CUT = 250000.0
PRICE_SCALE = 100000.0


def fixed_prediction(price="price"):
    return F.when(F.coalesce(F.col(price), F.lit(0.0)) > PRICE_CUT, 1).otherwise(0)


def fixed_probability(price="price"):
    z = (F.coalesce(F.col(price), F.lit(0.0)) - PRICE_CUT) / PRICE_SCALE
    return F.round(1 / (1 + F.exp(-z)), 4)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey rows with the fixed scorer's class and rounded probability."""
    s = survey(spark, sf_dir)
    return s.select("id", "label", fixed_prediction().alias("prediction"), fixed_probability().alias("prob"),
                    "price", "acctbal", "month", "status", "segment", "priority", "nation")


SCORED_SQL = f"""
select id, label,
       case when coalesce(price, 0) > 250000 then 1 else 0 end as prediction,
       round(1/(1+exp(-(coalesce(price,0)-250000)/100000)), 4) as prob,
       price, acctbal, month, status, segment, priority, nation
from ({SURVEY_SQL}) s
"""


def doc_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their (partial) quality labels: natural gaps from an outer join."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id", "left")


DOC_QUALITY_SQL = """
select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
from documents d left join labels l on d.doc_id = l.doc_id
"""

MEASURE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", *MEASURE_COLS, "l_returnflag", "l_linestatus")


def with_sql(body: str, **ctes: str) -> str:
    """Prefix a query with named CTEs."""
    parts = ",\n".join(f"{k} as ({v})" for k, v in ctes.items())
    return f"with {parts}\n{body}"
