"""Query catalog: every operator as a Spark query over the test tables, with the
equivalent DuckDB SQL beside it where one exists (the correctness oracle).

Each Spark query is ``fn(spark, sf_dir) -> DataFrame``. Computed columns carry
the same aliases on both sides; doubles are rounded to 6 digits on both sides.
Queries that write files do so under the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.scalar import NUMBER_PATTERN, number_or, portable_hash, r6
from tabkit.operators import boosting, charts, evaluate, experiments, features, models, profile, profile_state, splits, tuning
from tabkit.plans import boost_sql
from tabkit.plans import fixtures as fx
from tabkit.plans.fixtures import DOC_QUALITY_SQL, SCORED_SQL, SURVEY_SQL, with_sql
from tabkit.session import scratch_path
from tabkit.sources import csv as csvio
from tabkit.sources import tables as tabio
from tabkit.sources import text as textio

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def sv(body: str) -> str:
    return with_sql(body, survey=SURVEY_SQL)


def sc(body: str) -> str:
    return with_sql(body, scored=SCORED_SQL)


SURVEY_COLS = ["id", "name", "status", "segment", "priority", "nation", "price", "acctbal", "month", "label"]
SURVEY_TYPES = ["bigint", "string", "string", "string", "string", "string", "double", "double", "int", "int"]
HASH_SQL = "cast(('0x' || substr(md5('42|' || cast({c} as varchar)), 1, 8)) as bigint)"
TEST_CUT = int(0.2 * 4294967296)


def union_sql(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


# ============================================================== profiling
@query("table_shape", sv("select count(*) as rows, cast(10 as int) as columns from survey"))
def q_table_shape(spark, d):
    return profile.table_shape(fx.survey(spark, d))


@query("schema_profile", sv(union_sql([
    f"select '{c}' as column, cast({i} as int) as position, '{t}' as dtype, count({c}) as non_null from survey"
    for i, (c, t) in enumerate(zip(SURVEY_COLS, SURVEY_TYPES))
])))
def q_schema_profile(spark, d):
    return profile.schema_profile(fx.survey(spark, d))


@query("null_counts", sv(union_sql([
    f"select '{c}' as column, count(*) filter (where {c} is null) as nulls from survey" for c in SURVEY_COLS
])))
def q_null_counts(spark, d):
    return profile.null_counts(fx.survey(spark, d))


@query("value_counts", sv(
    "select priority as value, count(*) as count from survey where priority is not null group by priority"
))
def q_value_counts(spark, d):
    return profile.value_counts(fx.survey(spark, d), "priority")


REPEAT_COLS = ["l_returnflag", "l_linestatus", "l_quantity"]


@query("duplicate_rows", f"""
select cast(coalesce(sum(c - 1), 0) as bigint) as duplicates
from (select count(*) as c from lineitem group by {', '.join(REPEAT_COLS)})
""")
def q_duplicate_rows(spark, d):
    return profile.duplicate_rows(fx.measures(spark, d), REPEAT_COLS)


TOP_COLS = ["status", "segment", "priority", "nation"]


@query("top_values", sv(f"""
select "column", value, count, cast(rank as int) as rank from (
  select "column", value, count, row_number() over (partition by "column" order by count desc, value) as rank
  from ({union_sql([f"select '{c}' as column, {c} as value, count(*) as count from survey where {c} is not null group by {c}" for c in TOP_COLS])})
) where rank <= 10
"""))
def q_top_values(spark, d):
    return profile.top_values(fx.survey(spark, d), TOP_COLS, 10)


def _state_of_two_deliveries(spark, d) -> DataFrame:
    """The survey arrives as files in two deliveries; the second update scans the new files alone."""
    path, s = scratch_path(spark, "deliveries"), fx.survey(spark, d)
    state = None
    for half in (0, 1):
        s.where(F.pmod("id", F.lit(2)) == half).write.mode("append").parquet(path)
        kept = scratch_path(spark, "profile-state")
        profile_state.update_profile(spark, path, state).write.parquet(kept)
        state = spark.read.parquet(kept)
    return state


_NUMBERS = [c for c, t in zip(SURVEY_COLS, SURVEY_TYPES) if t != "string"]


@query("incremental_profile", sv(union_sql([
    f"select '{c}' as column, '{t}' as dtype, count(*) as rows, count(*) - count({c}) as missing, count({c}) as present, "
    + (f"round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as stddev, round(skewness({c}), 6) as skewness, "
       f"min({c})::double as least, max({c})::double as greatest" if c in _NUMBERS else
       "null::double as mean, null::double as stddev, null::double as skewness, null::double as least, null::double as greatest")
    + " from survey" for c, t in zip(SURVEY_COLS, SURVEY_TYPES)
])))
def q_incremental_profile(spark, d):
    """The exact part of a profile that is merged from the states of two deliveries."""
    out = profile_state.profile_from_state(_state_of_two_deliveries(spark, d))
    return out.select("column", "dtype", "rows", "missing", "present", r6("mean").alias("mean"), r6("stddev").alias("stddev"),
                      r6("skewness").alias("skewness"), "least", "greatest")


DISTINCT_COLS = ["status", "priority", "month"]


@query("distinct_values", sv(union_sql([
    f"select distinct '{c}' as column, cast({c} as varchar) as value from survey" for c in DISTINCT_COLS
])))
def q_distinct_values(spark, d):
    return profile.distinct_values(fx.survey(spark, d), DISTINCT_COLS)


NDISTINCT_COLS = ["name", "status", "segment", "priority", "nation", "month"]


@query("distinct_counts", sv(union_sql([
    f"select '{c}' as column, count(distinct {c}) as n_distinct from survey" for c in NDISTINCT_COLS
])))
def q_distinct_counts(spark, d):
    return profile.distinct_counts(fx.survey(spark, d), NDISTINCT_COLS)


@query("head_rows", sv("select * from survey order by id limit 10"))
def q_head_rows(spark, d):
    return profile.head_rows(fx.survey(spark, d), 10, ["id"])


@query("skewness", union_sql([
    f"select '{c}' as column, round(skewness({c}), 6) as skewness from lineitem" for c in fx.MEASURE_COLS
]))
def q_skewness(spark, d):
    return profile.skewness(fx.measures(spark, d), fx.MEASURE_COLS).select("column", r6("skewness").alias("skewness"))


@query("columns_by_type", sv(union_sql([
    f"select '{c}' as column, '{'categorical' if t == 'string' else 'numeric'}' as kind, count({c}) as non_null from survey"
    for c, t in zip(SURVEY_COLS, SURVEY_TYPES) if c != "label"
])))
def q_columns_by_type(spark, d):
    s = fx.survey(spark, d)
    kinds = profile.columns_by_type(s, "label")
    counts = profile.schema_profile(s).select("column", "non_null")
    return kinds.join(counts, "column")  # one row per column


@query("cross_tab", sv("""
select priority, count(*) filter (where label = 0) as "0", count(*) filter (where label = 1) as "1"
from survey where priority is not null and label is not null group by priority
"""))
def q_cross_tab(spark, d):
    return profile.cross_tab(fx.survey(spark, d), "priority", "label", [0, 1])


# ============================================================== chart data
def _hist_sql(cols, bins=20):
    """A value's bin is the number of inner edges that are not above it."""
    parts = []
    for c in cols:
        parts.append(f"""
select '{c}' as column, cast(e.i as int) as bin, round(e.edge, 6) as "left", round(e.next, 6) as "right",
       count(v.x) as count
from (select r.i, r.lo + r.i * r.step as edge, case when r.i = {bins - 1} then r.hi else r.lo + (r.i + 1) * r.step end as next,
             r.i = {bins - 1} as last
      from (select range as i, lo, hi, (hi - lo) / {bins} as step from range({bins}),
                   (select case when max({c}) > min({c}) then min({c}) else min({c}) - 0.5 end as lo,
                           case when max({c}) > min({c}) then max({c}) else max({c}) + 0.5 end as hi from lineitem)) r) e
left join (select {c} as x from lineitem where {c} is not null) v
  on v.x >= e.edge and (e.last or v.x < e.next)
group by e.i, e.edge, e.next""")
    return union_sql(parts)


@query("histogram", _hist_sql(fx.MEASURE_COLS))
def q_histogram(spark, d):
    return charts.histogram(fx.measures(spark, d), fx.MEASURE_COLS, 20)


COUNT_COLS = ["status", "segment", "priority", "nation", "month", "label"]


@query("category_counts", sv(union_sql([
    f"select '{c}' as column, cast({c} as varchar) as value, count(*) as count from survey where {c} is not null group by {c}"
    for c in COUNT_COLS
])))
def q_category_counts(spark, d):
    return charts.category_counts(fx.survey(spark, d), COUNT_COLS)


@query("stacked_counts", sv(union_sql([
    f"select '{c}' as column, cast(v.{c} as varchar) as value, t.label as target, count(s.id) as count "
    f"from (select distinct {c} from survey where {c} is not null) v cross join (select distinct label from survey) t "
    f"left join survey s on s.{c} = v.{c} and s.label = t.label group by v.{c}, t.label"
    for c in TOP_COLS
])))
def q_stacked_counts(spark, d):
    return charts.stacked_counts(fx.survey(spark, d), TOP_COLS, "label")


CLASS_NAMES = {0: "negative", 1: "positive"}


@query("class_shares", sv("""
select label as class, count(*) as count, round(count(*) / sum(count(*)) over (), 6) as share,
       printf('%.1f%%', count(*) / sum(count(*)) over () * 100) as label,
       case label when 0 then 'negative' when 1 then 'positive' end as name
from survey where label is not null group by label
"""))
def q_class_shares(spark, d):
    return charts.class_shares(fx.survey(spark, d), "label", CLASS_NAMES)


VIOLIN_COLS = ["price", "acctbal", "month"]


@query("violin_quartiles", sv(union_sql([
    f"select label as class, '{c}' as column, round(quantile_cont({c}, 0.25), 6) as q1, "
    f"round(quantile_cont({c}, 0.5), 6) as median, round(quantile_cont({c}, 0.75), 6) as q3 "
    f"from survey where {c} is not null group by label"
    for c in VIOLIN_COLS
])))
def q_violin_quartiles(spark, d):
    return charts.violin_quartiles(fx.survey(spark, d), "label", VIOLIN_COLS)


def _violin_density_sql(cols, grid=100, cut=2.0):
    parts = []
    for c in cols:
        parts.append(f"""
select p.class, '{c}' as column, cast(g.i as int) as point,
       round(p.g0 + p.step * g.i, 6) as x,
       round(sum(w.w * exp(-0.5 * pow((p.g0 + p.step * g.i - w.x) / p.bw, 2))) / (p.n * p.bw * sqrt(2 * pi())), 6) as density
from (select label as class, count(*) as n, stddev_samp({c}) * pow(count(*), -0.2) as bw,
             min({c}) - {cut} * stddev_samp({c}) * pow(count(*), -0.2) as g0,
             (max({c}) - min({c}) + 2 * {cut} * stddev_samp({c}) * pow(count(*), -0.2)) / {grid - 1} as step
      from survey where {c} is not null and label is not null group by label) p
join (select label as class, {c} as x, count(*) as w from survey where {c} is not null group by label, {c}) w
  on w.class = p.class
cross join (select range as i from range({grid})) g
where p.bw > 0
group by p.class, g.i, p.g0, p.step, p.n, p.bw""")
    return sv(union_sql(parts))


@query("violin_density", _violin_density_sql(VIOLIN_COLS))
def q_violin_density(spark, d):
    return charts.violin_density(fx.survey(spark, d), "label", VIOLIN_COLS)


# ============================================================== evaluation
@query("accuracy", sc(
    "select count(*) as n, count(*) filter (where label <> prediction) as mismatches, "
    "round(1 - count(*) filter (where label <> prediction) / count(*), 6) as accuracy from scored"
))
def q_accuracy(spark, d):
    a = evaluate.accuracy(fx.scored(spark, d))
    return a.select("n", "mismatches", r6("accuracy").alias("accuracy"))


CLASS_SQL = """
per as (
  select c as class, support, predicted, tp,
         coalesce(tp / nullif(predicted, 0), 0) as precision, coalesce(tp / nullif(support, 0), 0) as recall
  from (select coalesce(y.c, p.c) as c, coalesce(support, 0) as support, coalesce(predicted, 0) as predicted,
               coalesce(tp, 0) as tp
        from (select label as c, count(*) as support, count(*) filter (where label = prediction) as tp
              from scored group by label) y
        full outer join (select prediction as c, count(*) as predicted from scored group by prediction) p
        on y.c = p.c)
),
perf as (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1 from per)
"""


@query("weighted_precision_recall", sc(f"""
, {CLASS_SQL.strip()}
select round(sum(precision * support) / sum(support), 6) as weighted_precision,
       round(sum(recall * support) / sum(support), 6) as weighted_recall from perf
"""))
def q_weighted_pr(spark, d):
    m = evaluate.weighted_precision_recall(fx.scored(spark, d))
    return m.select(r6("weighted_precision").alias("weighted_precision"), r6("weighted_recall").alias("weighted_recall"))


@query("classification_report", sc(f"""
, {CLASS_SQL.strip()},
pos as (select * from perf where support > 0)
select cast(class as varchar) as class, round(precision, 6) as precision, round(recall, 6) as recall,
       round(f1, 6) as f1, support from pos
union all
select 'accuracy', null, null, round(sum(tp) / sum(support), 6), cast(sum(support) as bigint) from pos
union all
select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), cast(sum(support) as bigint) from pos
union all
select 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from pos
"""))
def q_classification_report(spark, d):
    r = evaluate.classification_report(fx.scored(spark, d))
    return r.select("class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


def _auc_sql(score: str) -> str:
    return sc(f"""
, g as (select cast({score} as double) as sc, sum(cast(label as double)) as p, sum(1 - cast(label as double)) as n
       from scored group by 1),
c as (select sc, p, n, sum(p) over (order by sc desc) as tp, sum(n) over (order by sc desc) as fp,
             sum(p) over () as tot_p, sum(n) over () as tot_n from g),
r as (select tp / tot_p as tpr, fp / tot_n as fpr, (tp - p) / tot_p as ptpr, (fp - n) / tot_n as pfpr,
             tp / nullif(tp + fp, 0) as pr,
             coalesce((tp - p) / nullif((tp - p) + (fp - n), 0), tp / nullif(tp + fp, 0)) as ppr from c)
select round(sum((fpr - pfpr) * (tpr + ptpr) / 2), 6) as auroc,
       round(sum((tpr - ptpr) * (pr + ppr) / 2), 6) as aupr from r
""")


@query("auc_hard", _auc_sql("prediction"))
def q_auc_hard(spark, d):
    a = evaluate.auc(fx.scored(spark, d), "prediction", "label")
    return a.select(r6("auroc").alias("auroc"), r6("aupr").alias("aupr"))


@query("auc_prob", _auc_sql("prob"))
def q_auc_prob(spark, d):
    a = evaluate.auc(fx.scored(spark, d), "prob", "label")
    return a.select(r6("auroc").alias("auroc"), r6("aupr").alias("aupr"))


@query("mismatch_filter", sc("select id, label, prediction from scored where label <> prediction"))
def q_mismatch_filter(spark, d):
    return evaluate.mismatches(fx.scored(spark, d)).select("id", "label", "prediction")


# ============================================================== splits
@query("hash_split", sv(
    f"select id, case when {HASH_SQL.format(c='id')} < {TEST_CUT} then 'test' else 'train' end as split from survey"
))
def q_hash_split(spark, d):
    return splits.hash_split(fx.survey(spark, d), "id").select("id", "split")


@query("assign_folds", sv(f"select id, cast({HASH_SQL.format(c='id')} % 4 as int) as fold from survey"))
def q_assign_folds(spark, d):
    return splits.assign_folds(fx.survey(spark, d), "id", 4).select("id", "fold")


@query("exact_split", sv(f"""
select id, case when row_number() over (order by h, id) <= ceil(0.2 * count(*) over ()) then 'test' else 'train' end as split
from (select id, {HASH_SQL.format(c='id')} as h from survey)
"""))
def q_exact_split(spark, d):
    return splits.exact_split(fx.survey(spark, d), "id", 0.2).select("id", "split")


@query("split_sizes", sv(f"""
select 'split' as kind, part, count(*) as rows from (
  select case when {HASH_SQL.format(c='id')} < {TEST_CUT} then 'test' else 'train' end as part from survey) group by part
union all
select 'fold' as kind, part, count(*) as rows from (
  select cast({HASH_SQL.format(c='id')} % 4 as varchar) as part from survey) group by part
"""))
def q_split_sizes(spark, d):
    s = fx.survey(spark, d)
    a = splits.split_sizes(splits.hash_split(s, "id"), "split").select(F.lit("split").alias("kind"), "part", "rows")
    b = splits.split_sizes(splits.assign_folds(s, "id", 4), "fold").select(F.lit("fold").alias("kind"), "part", "rows")
    return a.unionByName(b)


@query("union_folds", sv(f"""
select id, fold from (select id, cast({HASH_SQL.format(c='id')} % 4 as int) as fold from survey) where fold <> 0
"""))
def q_union_folds(spark, d):
    f = splits.assign_folds(fx.survey(spark, d), "id", 4).select("id", "fold")
    parts = [f.where(F.col("fold") == k) for k in (1, 2, 3)]  # fold tables 1..3, fold 0 held out
    return splits.union_folds(parts)


@query("align_predictions", sc("select id, label, prediction from scored"))
def q_align_predictions(spark, d):
    s = fx.scored(spark, d)
    return splits.align_predictions(s.select("id", "label"), s.select("id", "prediction"), "id")


FOLD_CUTS = [200000, 250000, 300000]


@query("fold_mean", sv(f"""
select cut, round(avg(acc), 6) as mean_accuracy from (
  select cut, fold, avg(case when (case when coalesce(price, 0) > cut then 1 else 0 end) = label then 1.0 else 0.0 end) as acc
  from (select *, cast({HASH_SQL.format(c='id')} % 4 as int) as fold from survey) s,
       (values {', '.join(f'({c})' for c in FOLD_CUTS)}) t(cut)
  group by cut, fold) group by cut
"""))
def q_fold_mean(spark, d):
    s = splits.assign_folds(fx.survey(spark, d), "id", 4)
    preds = s.select("fold", "label", *[
        F.when(F.coalesce("price", F.lit(0.0)) > c, 1).otherwise(0).alias(str(c)) for c in FOLD_CUTS
    ]).unpivot(["fold", "label"], [str(c) for c in FOLD_CUTS], "cut", "prediction")
    per_fold = preds.groupBy(F.col("cut").cast("int").alias("cut"), "fold").agg(
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("acc")
    )
    return evaluate.fold_mean(per_fold, ["cut"], "acc", "mean_accuracy").select("cut", r6("mean_accuracy").alias("mean_accuracy"))


# ============================================================== features
@query("impute_median", sv(
    "select id, " + ", ".join(f"round(coalesce({c}, (select median({c}) from survey)), 6) as {c}" for c in fx.SURVEY_NUMERIC)
    + " from survey"
))
def q_impute_median(spark, d):
    s = fx.survey(spark, d).select("id", *fx.SURVEY_NUMERIC)
    out = features.impute_median(s, fx.SURVEY_NUMERIC)
    return out.select("id", *[r6(c).alias(c) for c in fx.SURVEY_NUMERIC])


@query("impute_constant", sv(
    "select id, " + ", ".join(f"coalesce({c}, 'missing') as {c}" for c in fx.SURVEY_CATEGORICAL) + " from survey"
))
def q_impute_constant(spark, d):
    s = fx.survey(spark, d).select("id", *fx.SURVEY_CATEGORICAL)
    return features.fill_constant(s, fx.SURVEY_CATEGORICAL)


@query("standard_scale", "select l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - (select avg({c}) from lineitem)) / coalesce(nullif((select stddev_pop({c}) from lineitem), 0), 1), 6) as {c}"
    for c in fx.MEASURE_COLS) + " from lineitem")
def q_standard_scale(spark, d):
    m = fx.measures(spark, d).select("l_orderkey", "l_linenumber", *fx.MEASURE_COLS)
    out = features.standard_scale(m, fx.MEASURE_COLS)
    return out.select("l_orderkey", "l_linenumber", *[r6(c).alias(c) for c in fx.MEASURE_COLS])


TRAIN_WHERE = f"{HASH_SQL.format(c='id')} >= {TEST_CUT}"
TEST_WHERE = f"{HASH_SQL.format(c='id')} < {TEST_CUT}"


def _train_test(spark, d):
    s = splits.hash_split(fx.survey(spark, d), "id")
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")


def _cat_dict_sql(col: str, src: str, fill: bool) -> str:
    v = f"coalesce({col}, 'missing')" if fill else col
    return (f"(select v, cast(row_number() over (order by v) - 1 as int) as code "
            f"from (select distinct {v} as v from {src} where {v} is not null))")


@query("one_hot", sv(
    "select id, " + ", ".join(
        f"case when coalesce({c}, 'missing') = '{v}' then cast(1 as double) else cast(0 as double) end as \"{c}_{v}\""
        for c, vals in (("status", ["F", "O", "P", "missing"]),
                        ("segment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]))
        for v in vals) + " from survey"
))
def q_one_hot(spark, d):
    s = features.fill_constant(fx.survey(spark, d).select("id", *fx.SURVEY_ONE_HOT), fx.SURVEY_ONE_HOT)
    return features.one_hot(s, fx.SURVEY_ONE_HOT)


@query("ordinal_encode", sv(
    "select s.id, " + ", ".join(f"coalesce(d{i}.code, -1) as {c}" for i, c in enumerate(fx.SURVEY_ORDINAL))
    + " from survey s " + " ".join(
        f"left join {_cat_dict_sql(c, 'survey', True)} d{i} on coalesce(s.{c}, 'missing') = d{i}.v"
        for i, c in enumerate(fx.SURVEY_ORDINAL))
))
def q_ordinal_encode(spark, d):
    s = features.fill_constant(fx.survey(spark, d).select("id", *fx.SURVEY_ORDINAL), fx.SURVEY_ORDINAL)
    return features.ordinal_encode(s, fx.SURVEY_ORDINAL)


CODE_COLS = ["status", "priority", "nation"]


@query("category_codes", sv(
    "select s.id, " + ", ".join(f"coalesce(d{i}.code, -1) as {c}" for i, c in enumerate(CODE_COLS))
    + " from survey s " + " ".join(
        f"left join {_cat_dict_sql(c, 'survey', False)} d{i} on s.{c} = d{i}.v" for i, c in enumerate(CODE_COLS))
))
def q_category_codes(spark, d):
    s = fx.survey(spark, d).select("id", *CODE_COLS)
    return features.apply_category_codes(s, CODE_COLS)


@query("category_dictionary", sv(
    "select v as value, code from " + _cat_dict_sql("nation", "survey", False)
))
def q_category_dictionary(spark, d):
    return features.category_dictionary(fx.survey(spark, d), "nation").table


@query("dictionary_lookup", sv(
    f"select s.id, coalesce(d.code, -1) as name_code from (select * from survey where {TEST_WHERE}) s "
    f"left join {_cat_dict_sql('name', f'(select * from survey where {TRAIN_WHERE})', False)} d on s.name = d.v"
))
def q_dictionary_lookup(spark, d):
    train, test = _train_test(spark, d)
    dictionary = features.category_dictionary(train, "name")
    out = features.dictionary_lookup(test.select("id", "name"), "name", dictionary, -1, out="name_code")
    return out


@query("assemble_vector", sv(
    "select id, 3 as n_features, " + ", ".join(
        f"round(coalesce({c}, (select median({c}) from survey)), 6) as f{i}" for i, c in enumerate(fx.SURVEY_NUMERIC))
    + " from survey"
))
def q_assemble_vector(spark, d):
    s = features.impute_median(fx.survey(spark, d).select("id", *fx.SURVEY_NUMERIC), fx.SURVEY_NUMERIC)
    v = features.assemble(s, fx.SURVEY_NUMERIC)
    arr = vector_to_array("features")
    return v.select("id", F.size(arr).alias("n_features"), *[r6(arr[i]).alias(f"f{i}") for i in range(3)])


@query("index_label", sv(
    "select segment, cast(row_number() over (order by count(*) desc, segment) - 1 as double) as idx "
    "from survey group by segment"
))
def q_index_label(spark, d):
    out, _ = features.index_label(fx.survey(spark, d), "segment", "idx")
    return out.select("segment", "idx").distinct()


@query("drop_columns", sv("select id, status, priority, nation, price, acctbal, month, label from survey"))
def q_drop_columns(spark, d):
    return features.drop_columns(fx.survey(spark, d), ["name", "segment"])


@query("select_columns", sv("select id, label, price from survey"))
def q_select_columns(spark, d):
    return features.select_columns(fx.survey(spark, d), ["id", "label", "price"])


@query("target_first", sv("select label, id, name, status, segment, priority, nation, price, acctbal, month from survey"))
def q_target_first(spark, d):
    return features.target_first(fx.survey(spark, d), "label")


@query("concat_columns", sv(
    f"select coalesce(a.id, b.id) as id, a.price, b.segment from (select id, price from survey where {TRAIN_WHERE}) a "
    "full outer join (select id, segment from survey) b on a.id = b.id"
))
def q_concat_columns(spark, d):
    train, _ = _train_test(spark, d)
    return features.concat_columns(train.select("id", "price"), fx.survey(spark, d).select("id", "segment"), "id")


ONE_HOT_VALUES = (("status", ["F", "O", "P", "missing"]),
                  ("segment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]))


def _prep_sql(fit_where: str, apply_where: str) -> str:
    """The whole preparation in SQL: fit on rows matching ``fit_where``, apply to ``apply_where``."""
    num = fx.SURVEY_NUMERIC
    med = ", ".join(f"median({c}) as m_{c}" for c in num)
    filled = ", ".join(f"coalesce({c}, m_{c}) as f_{c}" for c in num)
    stats = ", ".join(f"avg(f_{c}) as a_{c}, stddev_pop(f_{c}) as s_{c}" for c in num)
    scaled = ", ".join(
        f"round((coalesce(x.{c}, p.m_{c}) - st.a_{c}) / coalesce(nullif(st.s_{c}, 0), 1), 6) as {c}" for c in num)
    onehot = ", ".join(
        f"case when coalesce(x.{c}, 'missing') = '{v}' then cast(1 as double) else cast(0 as double) end as \"{c}_{v}\""
        for c, vals in ONE_HOT_VALUES for v in vals)
    ords = ", ".join(f"coalesce(d{i}.code, -1) as {c}" for i, c in enumerate(fx.SURVEY_ORDINAL))
    joins = " ".join(
        f"left join {_cat_dict_sql(c, 'fit', True)} d{i} on coalesce(x.{c}, 'missing') = d{i}.v"
        for i, c in enumerate(fx.SURVEY_ORDINAL))
    return sv(f"""
, fit as (select * from survey where {fit_where}),
p as (select {med} from fit),
st as (select {stats} from (select {filled} from fit, p))
select x.label, {ords}, {scaled}, {onehot}
from (select * from survey where {apply_where}) x cross join p cross join st {joins}
""")


PREP_ARGS = dict(target="label", numeric=fx.SURVEY_NUMERIC, one_hot_cols=fx.SURVEY_ONE_HOT,
                 ordinal_cols=fx.SURVEY_ORDINAL, drop=fx.SURVEY_DROP)


def _rounded(df: DataFrame, cols=fx.SURVEY_NUMERIC) -> DataFrame:
    return df.select(*[(r6(c).alias(c) if c in cols else F.col(f"`{c}`")) for c in df.columns])


@query("prep_pipeline", _prep_sql(TRAIN_WHERE, TRAIN_WHERE))
def q_prep_pipeline(spark, d):
    train, _ = _train_test(spark, d)
    out, _model = features.prepare(train, **PREP_ARGS)
    return _rounded(out)


@query("prep_apply_test", _prep_sql(TRAIN_WHERE, TEST_WHERE))
def q_prep_apply_test(spark, d):
    train, test = _train_test(spark, d)
    model = features.PrepModel.fit(train, **PREP_ARGS)
    return _rounded(model.transform(test))


@query("prep_refit_test", _prep_sql(TEST_WHERE, TEST_WHERE))
def q_prep_refit_test(spark, d):
    _, test = _train_test(spark, d)
    out, _model = features.prepare(test, **PREP_ARGS)
    return _rounded(out)


# ============================================================== sources and sinks
SURVEY_SCHEMA = T.StructType([
    T.StructField(c, {"bigint": T.LongType(), "string": T.StringType(), "double": T.DoubleType(),
                      "int": T.IntegerType()}[t], True)
    for c, t in zip(SURVEY_COLS, SURVEY_TYPES)
])


@query("csv_scan_header", sv("select * from survey"))
def q_csv_scan_header(spark, d):
    """The file has its columns in another order, a further column of quotes, commas and
    missing words, and ``NaN`` / ``NA`` where numbers are missing."""
    path = scratch_path(spark, "survey-header")
    s = fx.survey(spark, d)
    note = F.concat(F.lit('say "hi", '), F.coalesce("status", F.lit("NA")), F.lit(' "'))
    numbers = [F.coalesce(F.col(c).cast("string"), F.lit(word)).alias(c) for c, word in (("acctbal", "NaN"), ("price", "NA"))]
    shuffled = s.select("label", note.alias("note"), *numbers, *[c for c in reversed(SURVEY_COLS) if c not in ("label", "acctbal", "price")])
    shuffled.write.option("header", True).option("escape", '"').csv(path)
    return csvio.read_table_csv(spark, path, SURVEY_SCHEMA)


@query("csv_scan_multiline", sv("select id, name || chr(10) || chr(10) || coalesce(status, '\"\"') || ', ' as note, price from survey"))
def q_csv_scan_multiline(spark, d):
    """Quoted fields with line breaks, quotes and commas in them; the files differ in column order."""
    path = scratch_path(spark, "survey-lines")
    note = F.concat("name", F.lit("\n\n"), F.coalesce("status", F.lit('""')), F.lit(", ")).alias("note")
    s = fx.survey(spark, d).select("id", note, "price")
    halves = (s.where("id % 2 = 0"), s.where("id % 2 = 1").select("price", "note", "id"))
    for half in halves:
        half.write.mode("append").option("header", True).option("escape", '"').option("quoteAll", True).option("ignoreTrailingWhiteSpace", False).csv(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("price", T.DoubleType())])
    return csvio.read_table_csv(spark, path, schema, multi_line=True)


@query("csv_sink_indexed", sv("select * from survey"))
def q_csv_sink_indexed(spark, d):
    path = scratch_path(spark, "survey-indexed")
    csvio.write_indexed_csv(fx.survey(spark, d), path, "id")
    back = csvio.read_indexed_csv(spark, path, SURVEY_SCHEMA, "id")
    return back.select(*SURVEY_COLS)


POSITIONAL_COLS = ["label", "price", "acctbal", "month"]


@query("csv_sink_headerless", sv(
    "select cast(label as double) as \"0\", price as \"1\", acctbal as \"2\", cast(month as double) as \"3\" from survey"
))
def q_csv_sink_headerless(spark, d):
    path = scratch_path(spark, "survey-headerless")
    s = fx.survey(spark, d).select(*[F.col(c).cast("double") for c in POSITIONAL_COLS])
    csvio.write_headerless_csv(s, path)
    return csvio.read_positional_csv(spark, path, len(POSITIONAL_COLS))


@query("csv_scan_positional", _prep_sql(TRAIN_WHERE, TRAIN_WHERE).replace(
    "select x.label,", "select cast(x.label as double) as label,"))
def q_csv_scan_positional(spark, d):
    """The prepared training file written headerless, read back by position and
    renamed to the prepared column names."""
    train, _ = _train_test(spark, d)
    prepared, _m = features.prepare(train, **PREP_ARGS)
    names = prepared.columns
    path = scratch_path(spark, "prepared-train")
    csvio.write_headerless_csv(prepared, path)
    back = csvio.read_positional_csv(spark, path, len(names))
    out = back.toDF(*names)
    return out.select(*[(F.col(f"`{c}`").cast("int").alias(c) if c in fx.SURVEY_ORDINAL else
                         r6(F.col(f"`{c}`")).alias(c) if c in fx.SURVEY_NUMERIC else F.col(f"`{c}`")) for c in names])


@query("prediction_sink", sc("select id, prediction as label from scored"))
def q_prediction_sink(spark, d):
    path = scratch_path(spark, "predictions")
    csvio.write_predictions(fx.scored(spark, d), path, "id", "label")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.IntegerType())])
    return csvio.read_table_csv(spark, path, schema)


@query("file_inventory", "select 'lineitem.parquet' as file_name, count(*) as rows from lineitem")
def q_file_inventory(spark, d):
    return tabio.file_inventory(spark, f"{d.rstrip('/')}/lineitem.parquet")


@query("file_inventory_folders", sv(
    "select case label when 0 then 'label=0' else 'label=1' end as folder, count(*) as rows from survey group by 1"))
def q_file_inventory_folders(spark, d):
    """Files of equal names in different folders stay apart; summed per folder."""
    path = scratch_path(spark, "inventory")
    fx.survey(spark, d).select("id", "label").write.partitionBy("label").parquet(path)
    files = tabio.file_inventory(spark, path)
    return files.groupBy(F.substring_index("file_name", "/", 1).alias("folder")).agg(F.sum("rows").alias("rows"))


# Text lines of the study's prepared-file shape: label, numbers, and text fields
# (status, priority) that do not read as numbers; NULLs left empty.
LINE_SQL = ("cast(label as varchar) || ',' || coalesce(printf('%.2f', price), '') || ',' || "
            "coalesce(printf('%.2f', acctbal), '') || ',' || coalesce(cast(month as varchar), '') || ',' || "
            "coalesce(status, '') || ',' || coalesce(priority, '')")


def _line_col():
    def s(c):
        return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    def num(c):  # format_string renders NULL as the word null, so guard it
        return F.when(F.col(c).isNotNull(), F.format_string("%.2f", c))

    return F.concat_ws(
        ",", F.col("label").cast("string"), s(num("price")), s(num("acctbal")),
        s(F.col("month").cast("string")), s(F.col("status")), s(F.col("priority")),
    ).alias("value")


def _write_lines(spark, d) -> str:
    path = scratch_path(spark, "lines")
    s = fx.survey(spark, d)
    s.select(_line_col()).write.text(path)
    return path


@query("text_line_scan", sv(f"select count(*) as lines, cast(sum(length({LINE_SQL})) as bigint) as chars from survey"))
def q_text_line_scan(spark, d):
    lines = textio.read_lines(spark, _write_lines(spark, d))
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).cast("bigint").alias("chars"))


NUM_SQL = (f"case when regexp_matches(trim(tok), '{NUMBER_PATTERN}') then try_cast(trim(tok) as double) "
           "else -1.0 end")


@query("number_or_default", sv(f"""
select distinct tok as field, {NUM_SQL} as number
from (select unnest(string_split({LINE_SQL}, ',')) as tok from survey)
"""))
def q_number_or_default(spark, d):
    lines = textio.read_lines(spark, _write_lines(spark, d))
    toks = lines.select(F.explode(F.split("value", ",", -1)).alias("field")).distinct()
    return toks.select("field", number_or("field").alias("number"))


@query("parse_labeled_points", sv(f"""
select label, n_features, round(feature_sum, 6) as feature_sum, count(*) as rows from (
  select cast(label as double) as label, 5 as n_features,
         coalesce(price, -1) + coalesce(acctbal, -1) + coalesce(month, -1) - 2 as feature_sum
  from (select label, round(price, 2) as price, round(acctbal, 2) as acctbal, month from survey))
group by 1, 2, 3
"""))
def q_parse_labeled_points(spark, d):
    lines = textio.read_lines(spark, _write_lines(spark, d))
    pts = textio.parse_labeled_points(lines, as_vector=False)
    agg = pts.select(
        "label", F.size("features").alias("n_features"),
        r6(F.aggregate("features", F.lit(0.0), lambda a, x: a + x)).alias("feature_sum"),
    )
    return agg.groupBy("label", "n_features", "feature_sum").agg(F.count(F.lit(1)).alias("rows"))


# ============================================================== models: closed-form checks
STUMP_CTES = """
, x as (select label, cast(month as double) as f0, floor(coalesce(price, 0) / 25000) as f1,
              floor(coalesce(acctbal, 0) / 1000) as f2 from survey),
long as (select 0 as feature, f0 as v, label from x union all select 1, f1, label from x
         union all select 2, f2, label from x),
g as (select feature, v, count(*) as c, sum(label) as p from long group by feature, v),
cum as (select feature, v, lead(v) over (partition by feature order by v) as nv,
               sum(c) over (partition by feature order by v) as nl, sum(p) over (partition by feature order by v) as pl,
               sum(c) over (partition by feature) as n, sum(p) over (partition by feature) as pt from g),
gains as (select feature, (v + nv) / 2 as threshold,
                 (1 - (pt / n) * (pt / n) - (1 - pt / n) * (1 - pt / n))
                 - nl / n * (1 - (pl / nl) * (pl / nl) - (1 - pl / nl) * (1 - pl / nl))
                 - (n - nl) / n * (1 - ((pt - pl) / (n - nl)) * ((pt - pl) / (n - nl))
                                   - (1 - (pt - pl) / (n - nl)) * (1 - (pt - pl) / (n - nl))) as gain
          from cum where nv is not null)
"""
STUMP_SQL = sv(STUMP_CTES + """
select cast(feature as int) as feature, threshold, round(gain, 6) as gain from gains order by gain desc, feature limit 1
""")
STUMP_NAMES = ["month", "price_bucket", "acct_bucket"]


@query("rf_stump", STUMP_SQL)
def q_rf_stump(spark, d):
    """Random forest of one unbootstrapped depth-1 tree on all features: its split is
    the best gini cut over all features; the gain is recomputed from the data."""
    s = fx.survey(spark, d)
    x = s.select(
        F.col("label").cast("double").alias("label"), F.col("month").cast("double").alias("f0"),
        F.floor(F.coalesce("price", F.lit(0.0)) / 25000).cast("double").alias("f1"),
        F.floor(F.coalesce("acctbal", F.lit(0.0)) / 1000).cast("double").alias("f2"),
    )
    v = features.assemble(x, ["f0", "f1", "f2"])
    model = models.fit_on(v, models.train_rf, 1, 1, 32, featureSubsetStrategy="all", bootstrap=False)
    f, t = models.stump_split(model)
    gain = models.gini_gain(x, f"f{f}", t)
    return gain.select(F.lit(f).alias("feature"), F.lit(t).alias("threshold"), r6("gain").alias("gain"))


@query("feature_importance_stump", sv(STUMP_CTES + f""",
best as (select feature from gains order by gain desc, feature limit 1)
select n.name as feature, case when n.idx = best.feature then cast(1 as double) else cast(0 as double) end
       as importance
from (values {', '.join(f"({i}, '{n}')" for i, n in enumerate(STUMP_NAMES))}) n(idx, name) cross join best
"""))
def q_feature_importance_stump(spark, d):
    """M9 with a closed form: a single depth-1 tree puts all importance on its split feature."""
    s = fx.survey(spark, d)
    x = s.select(
        F.col("label").cast("double").alias("label"), F.col("month").cast("double").alias("f0"),
        F.floor(F.coalesce("price", F.lit(0.0)) / 25000).cast("double").alias("f1"),
        F.floor(F.coalesce("acctbal", F.lit(0.0)) / 1000).cast("double").alias("f2"),
    )
    v = features.assemble(x, ["f0", "f1", "f2"])
    model = models.fit_on(v, models.train_rf, 1, 1, 32, featureSubsetStrategy="all", bootstrap=False)
    return models.feature_importance(model, STUMP_NAMES, 10)


CV_FOLDS = 4
CV_STUMP_SQL = sv(f"""
, x as (select cast({HASH_SQL.format(c='id')} % {CV_FOLDS} as int) as fold, label, cast(month as double) as f0,
              floor(coalesce(price, 0) / 25000) as f1, floor(coalesce(acctbal, 0) / 1000) as f2 from survey),
ks as (select range as k from range({CV_FOLDS})),
long as (select k, 0 as feature, f0 as v, label from x join ks on x.fold <> ks.k
         union all select k, 1, f1, label from x join ks on x.fold <> ks.k
         union all select k, 2, f2, label from x join ks on x.fold <> ks.k),
g as (select k, feature, v, count(*) as c, sum(label) as p from long group by k, feature, v),
cum as (select k, feature, v, lead(v) over (partition by k, feature order by v) as nv,
               sum(c) over (partition by k, feature order by v) as nl, sum(p) over (partition by k, feature order by v) as pl,
               sum(c) over (partition by k, feature) as n, sum(p) over (partition by k, feature) as pt from g),
gains as (select k, feature, (v + nv) / 2 as threshold, nl, pl, n, pt,
                 (1 - (pt / n) * (pt / n) - (1 - pt / n) * (1 - pt / n))
                 - nl / n * (1 - (pl / nl) * (pl / nl) - (1 - pl / nl) * (1 - pl / nl))
                 - (n - nl) / n * (1 - ((pt - pl) / (n - nl)) * ((pt - pl) / (n - nl))
                                   - (1 - (pt - pl) / (n - nl)) * (1 - (pt - pl) / (n - nl))) as gain
          from cum where nv is not null),
best as (select k, feature, threshold,
                case when pl > nl - pl then 1 else 0 end as left_class,
                case when pt - pl > (n - nl) - (pt - pl) then 1 else 0 end as right_class
         from (select *, row_number() over (partition by k order by gain desc, feature, threshold) as r from gains)
         where r = 1),
acc as (select b.k, avg(case when (case when (case b.feature when 0 then x.f0 when 1 then x.f1 else x.f2 end) <= b.threshold
                                        then b.left_class else b.right_class end) = x.label then 1.0 else 0.0 end) as a
        from x join best b on x.fold = b.k group by b.k)
select 0 as setting, 1 as num_trees, 1 as max_depth, 32 as max_bins, round(avg(a), 6) as mean_accuracy from acc
""")


@query("cross_validate_stump", CV_STUMP_SQL)
def q_cross_validate_stump(spark, d):
    """H1 with a closed form: 4-fold cross-validation of unbootstrapped depth-1
    trees on all features; each fold's split is the best gini cut of the other folds."""
    s = splits.assign_folds(fx.survey(spark, d), "id", CV_FOLDS)
    x = s.select(
        "fold", F.col("label").cast("double").alias("label"), F.col("month").cast("double").alias("f0"),
        F.floor(F.coalesce("price", F.lit(0.0)) / 25000).cast("double").alias("f1"),
        F.floor(F.coalesce("acctbal", F.lit(0.0)) / 1000).cast("double").alias("f2"),
    )
    v = features.assemble(x, ["f0", "f1", "f2"])
    cv = tuning.cross_validate(v, [(1, 1, 32)], CV_FOLDS, featureSubsetStrategy="all", bootstrap=False)
    return cv.select("setting", "num_trees", "max_depth", "max_bins", r6("mean_accuracy").alias("mean_accuracy"))


def _p1():
    return vector_to_array(F.col("probability"))[1]


@query("lr_saturated", sv(
    "select coalesce(status, 'missing') as status, round(avg(label), 5) as prob from survey group by 1"
))
def q_lr_saturated(spark, d):
    """Unpenalised LR without intercept on the one-hot of one column: the fitted
    probability of each category is the category's label mean."""
    s = fx.survey(spark, d).select(
        F.coalesce("status", F.lit("missing")).alias("status"), F.col("label").cast("double").alias("label")
    )
    cats = features.fit_one_hot(s, ["status"])
    oh = features.apply_one_hot(s, cats, drop_source=False)
    cols = [f"status_{v}" for v in cats["status"]]
    v = features.assemble(oh, cols)
    model = models.fit_on(v, models.train_lr, fit_intercept=False, reg=0.0, max_iter=100, tol=1e-9)
    scored = model.transform(v)
    return scored.groupBy("status").agg(F.max(F.round(_p1(), 5)).alias("prob"))


@query("gbt_one_round", sv(
    "select cast(floor(coalesce(price, 0) / 125000) as int) as bucket, "
    "round(1 / (1 + exp(-2 * (2 * avg(label) - 1))), 5) as prob from survey group by 1"
))
def q_gbt_one_round(spark, d):
    """One boosting round of depth 5 on a 4-valued feature: each value is a leaf
    with margin mean(2y-1), probability 1 / (1 + exp(-2 margin))."""
    s = fx.survey(spark, d).select(
        F.floor(F.coalesce("price", F.lit(0.0)) / 125000).cast("int").alias("bucket"),
        F.col("label").cast("double").alias("label"),
    ).withColumn("f", F.col("bucket").cast("double"))
    v = features.assemble(s, ["f"])
    model = models.fit_on(v, models.train_gbt, max_depth=5, learning_rate=0.1, n_estimators=1)
    return model.transform(v).groupBy("bucket").agg(F.max(F.round(_p1(), 5)).alias("prob"))


LINEAR_WEIGHTS = {"price": 1.2345678e-05, "acctbal": 0.0002137913, "month": -0.05173}
LINEAR_INTERCEPT = -3.5


def _margin_sql():
    m = f"cast({LINEAR_INTERCEPT!r} as double)"
    for c, w in LINEAR_WEIGHTS.items():
        m = f"({m} + cast({w!r} as double) * coalesce(cast({c} as double), 0))"
    return m


@query("score_linear", sv(f"""
select id, round(m, 6) as margin, round(1 / (1 + exp(-m)), 6) as probability,
       case when 1 / (1 + exp(-m)) > 0.5 then 1 else 0 end as prediction
from (select id, {_margin_sql()} as m from survey)
"""))
def q_score_linear(spark, d):
    s = fx.survey(spark, d).select("id", *LINEAR_WEIGHTS)
    out = models.score_linear(s, LINEAR_WEIGHTS, LINEAR_INTERCEPT, "lr")
    return out.select("id", r6("margin").alias("margin"), r6("probability").alias("probability"), "prediction")


ES_ROUNDS = 20
ES_PATIENCE = 3


def _round_scores(spark, d) -> DataFrame:
    """Per-round validation scores of two threshold scorers whose cut moves each
    round (data-derived rounds for the patience rule)."""
    s = fx.survey(spark, d)
    keys = s.select(
        "label",
        F.ceil(F.coalesce("price", F.lit(0.0)) / 25000).alias("price"),
        F.ceil((F.coalesce("acctbal", F.lit(0.0)) + 1000) / 500).alias("acctbal"),
    ).unpivot(["label"], ["price", "acctbal"], "model", "key")
    g = keys.groupBy("model", "key").agg(F.count(F.lit(1)).alias("c"), F.sum("label").alias("p"))
    r = g.select("*", F.explode(F.sequence(F.lit(1), F.lit(ES_ROUNDS))).alias("round"))
    right = F.when(F.col("key") > F.col("round"), F.col("p")).otherwise(F.col("c") - F.col("p"))
    return r.groupBy("model", "round").agg(F.round(F.sum(right) / F.sum("c"), 6).alias("score"))


ROUND_SCORES_SQL = f"""
, keys as (select label, 'price' as model, ceil(coalesce(price, 0) / 25000) as key from survey
           union all select label, 'acctbal', ceil((coalesce(acctbal, 0) + 1000) / 500) from survey),
g as (select model, key, count(*) as c, sum(label) as p from keys group by model, key),
sc as (select model, cast(r.round as int) as round,
              round(sum(case when key > r.round then p else c - p end) / sum(c), 6) as score
       from g cross join (select range as round from range(1, {ES_ROUNDS + 1})) r group by model, r.round)
"""


@query("early_stop_round", sv(ROUND_SCORES_SQL + f""",
m as (select *, max(score) over (partition by model order by round rows between unbounded preceding and 1 preceding) as prev_best from sc),
i as (select *, max(case when prev_best is null or score > prev_best then round end)
                  over (partition by model order by round rows between unbounded preceding and current row) as best_round from m),
st as (select model, coalesce(min(case when round - best_round >= {ES_PATIENCE} then round end), max(round)) as stop_round
       from i group by model)
select i.model, i.best_round, b.score as best_score, st.stop_round
from i join st on i.model = st.model and i.round = st.stop_round join sc b on b.model = i.model and b.round = i.best_round
"""))
def q_early_stop_round(spark, d):
    return models.early_stop(_round_scores(spark, d), ES_PATIENCE)


# ---- data-derived grid and run tables for the result operators
PICK_GRID = {"price_cut": [150000, 200000, 250000, 300000], "acct_cut": [-1000, 0, 2500, 5000]}


def _grid_scores(spark, d) -> DataFrame:
    """Accuracy of the rule ``price > price_cut or acctbal > acct_cut`` at every grid
    point. Rows are first counted per (price key, balance key, label); the grid
    points then spread over those counts only."""
    grid = tuning.param_grid(spark, PICK_GRID).collect()  # parameters: 16 rows
    s = fx.survey(spark, d)
    g = s.groupBy(
        F.ceil(F.coalesce("price", F.lit(0.0)) / 50000).alias("kp"),
        F.ceil(F.coalesce("acctbal", F.lit(0.0)) / 500).alias("ka"), "label",
    ).agg(F.count(F.lit(1)).alias("c"))
    pts = F.array(*[F.struct(F.lit(r.combo).alias("combo"), F.lit(r.price_cut).alias("price_cut"),
                             F.lit(r.acct_cut).alias("acct_cut")) for r in grid])
    e = g.select("*", F.explode(pts).alias("g")).select("kp", "ka", "label", "c", "g.*")
    pred = ((F.col("kp") > F.col("price_cut") / 50000) | (F.col("ka") > F.col("acct_cut") / 500)).cast("int")
    return e.groupBy("combo", "price_cut", "acct_cut").agg(
        F.round(F.sum(F.when(pred == F.col("label"), F.col("c")).otherwise(0)) / F.sum("c"), 6).alias("score")
    )


def _grid_sql():
    vals = ", ".join(
        f"({i + 1}, {p}, {a})" for i, (p, a) in enumerate((p, a) for p in PICK_GRID["price_cut"] for a in PICK_GRID["acct_cut"]))
    return f"""
, grid as (select * from (values {vals}) t(combo, price_cut, acct_cut)),
scores as (select combo, price_cut, acct_cut,
                  round(count(*) filter (where (case when coalesce(price, 0) > price_cut or coalesce(acctbal, 0) > acct_cut
                                                     then 1 else 0 end) = label) / count(*), 6) as score
           from survey cross join grid group by combo, price_cut, acct_cut)
"""


@query("pick_best", sv(_grid_sql() + "select * from scores where score > 0 order by score desc, combo limit 1"))
def q_pick_best(spark, d):
    return tuning.pick_best(_grid_scores(spark, d))


RUN_MODELS = {"price": ("price", 250000.0), "acctbal": ("acctbal", 4500.0), "month": ("month", 6.0)}
RUN_METRIC_COLS = ["accuracy", "precision", "recall", "max_shard_rows"]


def _runs(spark, d) -> DataFrame:
    """Run table (model, partitions, accuracy, precision, recall, max_shard_rows):
    each scorer evaluated on the data split into p hash shards (shard metrics
    averaged), with the largest shard as the cost of the run."""
    s = fx.survey(spark, d)
    base = s.select(
        F.pmod(portable_hash("id"), F.lit(64)).alias("s64"), "label",
        *[F.when(F.coalesce(c, F.lit(0.0)) > cut, 1).otherwise(0).alias(m) for m, (c, cut) in RUN_MODELS.items()],
    ).unpivot(["s64", "label"], list(RUN_MODELS), "model", "pred")
    g = base.groupBy("model", "s64", "label", "pred").agg(F.count(F.lit(1)).alias("c"))
    e = g.select("*", F.explode(F.array(*[F.lit(p) for p in experiments.PARTITION_COUNTS])).alias("partitions"))
    per = e.groupBy("model", "partitions", (F.col("s64") % F.col("partitions")).alias("shard")).agg(
        F.sum("c").alias("n"),
        F.sum(F.when(F.col("label") == F.col("pred"), F.col("c")).otherwise(0)).alias("correct"),
        F.sum(F.when((F.col("label") == 1) & (F.col("pred") == 1), F.col("c")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("pred") == 1, F.col("c")).otherwise(0)).alias("pred1"),
        F.sum(F.when(F.col("label") == 1, F.col("c")).otherwise(0)).alias("pos1"),
    )
    return per.groupBy("model", F.col("partitions").cast("int").alias("partitions")).agg(
        F.round(F.avg(F.col("correct") / F.col("n")), 6).alias("accuracy"),
        F.round(F.avg(F.coalesce(F.col("tp") / F.nullif(F.col("pred1"), F.lit(0)), F.lit(0.0))), 6).alias("precision"),
        F.round(F.avg(F.coalesce(F.col("tp") / F.nullif(F.col("pos1"), F.lit(0)), F.lit(0.0))), 6).alias("recall"),
        F.max("n").cast("double").alias("max_shard_rows"),
    )


def _runs_sql():
    preds = ", ".join(
        f"case when coalesce({c}, 0) > {cut} then 1 else 0 end as {m}" for m, (c, cut) in RUN_MODELS.items())
    unp = " union all ".join(f"select s64, label, '{m}' as model, {m} as pred from b" for m in RUN_MODELS)
    parts = ", ".join(f"({p})" for p in experiments.PARTITION_COUNTS)
    return f"""
, b as (select {HASH_SQL.format(c='id')} % 64 as s64, label, {preds} from survey),
u as ({unp}),
per as (select model, cast(t.p as int) as partitions, s64 % t.p as shard, count(*) as n,
               count(*) filter (where label = pred) as correct,
               count(*) filter (where label = 1 and pred = 1) as tp,
               count(*) filter (where pred = 1) as pred1, count(*) filter (where label = 1) as pos1
        from u cross join (values {parts}) t(p) group by model, t.p, s64 % t.p),
runs as (select model, partitions, round(avg(correct / n), 6) as accuracy,
                round(avg(coalesce(tp / nullif(pred1, 0), 0)), 6) as precision,
                round(avg(coalesce(tp / nullif(pos1, 0), 0)), 6) as recall,
                cast(max(n) as double) as max_shard_rows
         from per group by model, partitions),
long as (select model, partitions, 'accuracy' as metric, accuracy as value from runs
         union all select model, partitions, 'precision', precision from runs
         union all select model, partitions, 'recall', recall from runs
         union all select model, partitions, 'max_shard_rows', max_shard_rows from runs),
keyed as (select *, case when metric = 'max_shard_rows' then value else -value end as k from long)
"""


@query("best_worst_runs", sv(_runs_sql() + """
select b.model, b.metric, b.partitions as best_partitions, b.value as best_value,
       w.partitions as worst_partitions, w.value as worst_value
from (select * from (select *, row_number() over (partition by model, metric order by k, partitions) as r from keyed) where r = 1) b
join (select * from (select *, row_number() over (partition by model, metric order by k desc, partitions) as r from keyed) where r = 1) w
  on b.model = w.model and b.metric = w.metric
"""))
def q_best_worst_runs(spark, d):
    return experiments.best_worst_runs(_runs(spark, d), RUN_METRIC_COLS, ("max_shard_rows",))


@query("improvement_summary", sv(_runs_sql() + """
select model, min(max_shard_rows) as best_time, max(max_shard_rows) as worst_time,
       round((max(max_shard_rows) - min(max_shard_rows)) / nullif(max(max_shard_rows), 0) * 100, 6) as improvement_pct
from runs group by model
"""))
def q_improvement_summary(spark, d):
    out = experiments.improvement_summary(_runs(spark, d), "max_shard_rows")
    return out.select("model", "best_time", "worst_time", r6("improvement_pct").alias("improvement_pct"))


@query("metric_series", sv(_runs_sql() + """
select model, partitions, metric, round(value, 6) as value,
       row_number() over (partition by model, metric order by k, partitions) = 1 as is_best,
       row_number() over (partition by model, metric order by k desc, partitions) = 1 as is_worst
from keyed
"""))
def q_metric_series(spark, d):
    return charts.metric_series(_runs(spark, d), RUN_METRIC_COLS, ("max_shard_rows",))


# ============================================================== models trained on the prepared survey
CHECK_GBT = dict(max_depth=3, learning_rate=0.1, n_estimators=10)


def _model_data(spark, d):
    """Prepared survey (fit on the train split), assembled, label as double; the
    id stays as a key and out of the features. Returns (train, test, feature names)."""
    train, test = _train_test(spark, d)
    prep = features.PrepModel.fit(train, "label", fx.SURVEY_NUMERIC, fx.SURVEY_ONE_HOT, fx.SURVEY_ORDINAL, ["name"])

    def ready(df):
        out = prep.transform(df).withColumn("label", F.col("label").cast("double"))
        names = [c for c in out.columns if c not in ("id", "label")]
        return features.assemble(out, names).select("id", "label", "features"), names

    tr, names = ready(train)
    te, _ = ready(test)
    return tr, te, names


def _predictions(model, test: DataFrame) -> DataFrame:
    return model.transform(test).select("id", "label", "prediction")


@query("rf_predict")
def q_rf_predict(spark, d):
    tr, te, _ = _model_data(spark, d)
    return _predictions(models.fit_on(tr, models.train_rf, *models.RF_SETTINGS["large"]), te)


@query("lr_predict")
def q_lr_predict(spark, d):
    tr, te, _ = _model_data(spark, d)
    sweep = models.LR_SWEEP
    return _predictions(models.fit_on(tr, models.train_lr, max_iter=sweep["maxIter"], reg=sweep["regParam"]), te)


@query("gbt_predict")
def q_gbt_predict(spark, d):
    tr, te, _ = _model_data(spark, d)
    return _predictions(models.fit_on(tr, models.train_gbt, **CHECK_GBT), te)


@query("feature_importance")
def q_feature_importance(spark, d):
    tr, _te, names = _model_data(spark, d)
    return models.feature_importance(models.fit_on(tr, models.train_rf, *models.RF_SETTINGS["large"]), names, 10)


@query("cross_validate")
def q_cross_validate(spark, d):
    """The study's 4 settings over 4 folds."""
    tr, _te, _ = _model_data(spark, d)
    return tuning.cross_validate(splits.assign_folds(tr, "id", 4), models.CV_SETTINGS, 4)


# ============================================================== models with a known answer
# On the one-hot of four price buckets, none of whose label shares is near one half, every
# classifier that fits at all predicts each bucket's majority class.
BUCKETS = 4
BUCKET_SQL = f"least(cast(floor(coalesce(price, 0) / 125000) as int), {BUCKETS - 1})"
BUCKET_CTES = f"""
, b as (select *, {BUCKET_SQL} as bucket from survey),
cls as (select bucket, case when 2 * sum(label) > count(*) then 1 else 0 end as prediction,
               avg(label) as share from b where {TRAIN_WHERE} group by bucket),
scored as (select b.id, b.label, cls.prediction, cls.share from b join cls using (bucket) where {TEST_WHERE})"""


#: From the starting weights of seed 42 MLlib's line search fails before the first step here.
MLP_SEED = 1


def _bucket(price="price"):
    return F.least(F.floor(F.coalesce(F.col(price), F.lit(0.0)) / 125000).cast("int"), F.lit(BUCKETS - 1))


def _bucket_data(spark, d, label: bool = True):
    """(train, test) with the one-hot of the price bucket as features."""
    def ready(df):
        keep = [F.col("label").cast("double").alias("label")] if label else []
        x = df.select("id", *keep, *[F.when(_bucket() == i, 1.0).otherwise(0.0).alias(f"b{i}") for i in range(BUCKETS)])
        return features.assemble(x, [f"b{i}" for i in range(BUCKETS)])

    train, test = _train_test(spark, d)
    return ready(train), ready(test)


BUCKET_PREDICT_SQL = sv(BUCKET_CTES + " select id, cast(label as double) as label, cast(prediction as double) as prediction from scored")


@query("svm_predict", BUCKET_PREDICT_SQL)
def q_svm_predict(spark, d):
    tr, te = _bucket_data(spark, d)
    return _predictions(models.fit_on(tr, models.train_svm, 0.01), te)


@query("mlp_predict", BUCKET_PREDICT_SQL)
def q_mlp_predict(spark, d):
    tr, te = _bucket_data(spark, d)
    return _predictions(models.fit_on(tr, models.train_mlp, BUCKETS, seed=MLP_SEED), te)


# ---------------------------------------------------------------- text to model
TEXT_MODELS = ["RF large", "RF medium", "RF small", "LR", "SVM"]


def _text_auc(score="prediction"):
    return f"""
g as (select cast({score} as double) as sc, sum(label) as p, sum(1 - label) as n from scored group by 1),
c as (select sc, p, n, sum(p) over (order by sc desc) as tp, sum(n) over (order by sc desc) as fp,
             sum(p) over () as tot_p, sum(n) over () as tot_n from g),
r as (select tp / tot_p as tpr, fp / tot_n as fpr, (tp - p) / tot_p as ptpr, (fp - n) / tot_n as pfpr,
             tp / nullif(tp + fp, 0) as pr, coalesce((tp - p) / nullif((tp - p) + (fp - n), 0), tp / nullif(tp + fp, 0)) as ppr from c),
a as (select sum((fpr - pfpr) * (tpr + ptpr) / 2) as auroc, sum((tpr - ptpr) * (pr + ppr) / 2) as aupr from r)"""


@query("text_to_model", sv(BUCKET_CTES + "," + _text_auc() + f"""
select t.m as model, (select count(*) from b) as rows, round((select avg(case when label = prediction then 1.0 else 0.0 end) from scored), 6) as accuracy,
       round(a.aupr, 6) as aupr, round(a.auroc, 6) as auroc
from a cross join (values {', '.join(f"('{m}')" for m in TEXT_MODELS)}) t(m)
"""))
def q_text_to_model(spark, d):
    """Lines of text to labelled points, points without a 0/1 label left out, five models,
    and accuracy, area under PR and ROC of each on the test split."""
    path = scratch_path(spark, "lines")
    s = splits.hash_split(fx.survey(spark, d), "id")
    line = F.concat_ws(",", F.col("label").cast("string"), *[F.when(_bucket() == i, "1").otherwise("0") for i in range(BUCKETS)],
                       F.when(F.col("split") == "test", "1.0").otherwise("0"))
    broken = s.where(F.col("id") % 10 == 0).select(F.concat_ws(",", F.lit("n/a"), F.lit("1"), F.lit("0"), F.lit("0"), F.lit("0"), F.lit("0")).alias("value"))
    s.select(line.alias("value")).union(broken).write.text(path)
    points = textio.binary_points(textio.parse_labeled_points(textio.read_lines(spark, path)))
    cells = vector_to_array("features")
    points = points.select("label", *[cells[i].alias(f"b{i}") for i in range(BUCKETS)], cells[BUCKETS].alias("test"))
    points = features.assemble(points, [f"b{i}" for i in range(BUCKETS)])
    train, test = points.where("test = 0").select("label", "features").persist(), points.where("test = 1").select("label", "features").persist()
    rows = train.count() + test.count()
    fits = {
        **{f"RF {k}": (lambda df, v=v: models.train_rf(df, *v, featureSubsetStrategy="all")) for k, v in models.RF_SETTINGS.items()},
        "LR": lambda df: models.train_lr(df, fit_intercept=False),
        "SVM": models.train_svm,
    }
    out = []
    for name, fit in fits.items():
        scored = fit(train).transform(test)
        a = evaluate.auc(scored, "prediction").first()
        out.append((name, rows, evaluate.accuracy(scored).first()["accuracy"], a["aupr"], a["auroc"]))
    train.unpersist()
    test.unpersist()
    result = spark.createDataFrame(out, "model string, rows long, accuracy double, aupr double, auroc double")
    return result.select("model", "rows", *[r6(c).alias(c) for c in ("accuracy", "aupr", "auroc")])


# ---------------------------------------------------------------- grid search and final model
KNOWN_GRID = {"max_depth": [2], "learning_rate": [0.1, 0.3], "n_estimators": [4, 6],
              "min_child_weight": [1, 3], "subsample": [0.9, 1.0]}
KNOWN_PATIENCE = 2


def _bucket_frames(spark, d):
    """(train, test) with the price bucket as the one feature."""
    def ready(df):
        x = df.select("id", F.col("label").cast("double").alias("label"), _bucket().cast("double").alias("f"))
        return features.assemble(x, ["f"])

    train, test = _train_test(spark, d)
    return ready(train), ready(test)


def _grid_points(grid: dict):
    """(combos as SQL rows, the models that they share, (combo, model, rounds) as SQL rows)."""
    import itertools

    combos = list(itertools.product(*grid.values()))
    shared = list(dict.fromkeys((d, rate, w, sub) for d, rate, _n, w, sub in combos))
    values = ", ".join(f"({i + 1}, {', '.join(map(str, c))})" for i, c in enumerate(combos))
    points = ", ".join(f"({i + 1}, {shared.index((d, rate, w, sub))}, {n})" for i, (d, rate, n, w, sub) in enumerate(combos))
    return values, [boosting.Settings(d, rate, max(grid["n_estimators"]), w, sub) for d, rate, w, sub in shared], points


#: Training and test rows with the price bucket as the one feature.
ONE_FEATURE_CTES = f"""
, b as (select id, {HASH_SQL.format(c='id')} as u, {BUCKET_SQL} as f0, 0 as f1, label from survey),
tr as (select * from b where {TRAIN_WHERE}), te as (select * from b where {TEST_WHERE}),"""


def _grid_sql_boosted(grid: dict, patience: int, metric: str) -> str:
    values, settings, points = _grid_points(grid)
    scores = boost_sql.AUC_CTES if metric == "auc" else boost_sql.LOSS_CTES
    shown = "round(value, 6) as score" if metric == "auc" else "round(value, 6) as val_loss, round(exp(-value), 6) as score"
    return sv(ONE_FEATURE_CTES + boost_sql.boosted(settings, max(grid["n_estimators"])) + "," + scores + ","
              + boost_sql.stops(points, patience, ">" if metric == "auc" else "<") + f"""
select g.combo, max_depth, cast(learning_rate as double) as learning_rate, n_estimators, min_child_weight,
       cast(subsample as double) as subsample, best_round, stop_round, {shown}
from (values {values}) g(combo, max_depth, learning_rate, n_estimators, min_child_weight, subsample) join res using (combo)
""")


@query("grid_search", _grid_sql_boosted(KNOWN_GRID, KNOWN_PATIENCE, "auc"))
def q_grid_search(spark, d):
    """H3 with early stopping on AUC, sampled rows and hessian weights, against boosting written in SQL."""
    tr, te = _bucket_frames(spark, d)
    out = tuning.grid_search(tr, te, tuning.param_grid(spark, KNOWN_GRID), patience=KNOWN_PATIENCE, key="id")
    return out.select(*KNOWN_GRID, "combo", "best_round", "stop_round", r6("score").alias("score"))


@query("grid_search_best", _grid_sql_boosted(KNOWN_GRID, KNOWN_PATIENCE, "auc").rstrip() + " order by res.value desc, combo limit 1")
def q_grid_search_best(spark, d):
    """H4 on the scores of a real search: the best point, the first among equals."""
    tr, te = _bucket_frames(spark, d)
    out = tuning.pick_best(tuning.grid_search(tr, te, tuning.param_grid(spark, KNOWN_GRID), patience=KNOWN_PATIENCE, key="id"))
    return out.select(*KNOWN_GRID, "combo", "best_round", "stop_round", r6("score").alias("score"))


def _best_model(spark, d, path=None):
    tr, te = _bucket_frames(spark, d)
    best = tuning.pick_best(tuning.grid_search(tr, te, tuning.param_grid(spark, {**KNOWN_GRID, "subsample": [1.0]}),
                                               patience=KNOWN_PATIENCE, key="id")).first().asDict()
    # the table to predict on has no label
    return tuning.best_model_report(tr, te, best, ["bucket"], te.drop("label"), path, patience=KNOWN_PATIENCE, key="id")


@query("best_model_report", sv(BUCKET_CTES + f""",
{CLASS_SQL.strip()},
pos as (select * from perf where support > 0)
select cast(cast(class as double) as varchar) as class, round(precision, 6) as precision, round(recall, 6) as recall,
       round(f1, 6) as f1, support from pos
union all select 'accuracy', null, null, round(sum(tp) / sum(support), 6), cast(sum(support) as bigint) from pos
union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), cast(sum(support) as bigint) from pos
union all select 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from pos
union all select 'importance of bucket', null, null, 1.0, (select count(*) from scored)
"""))
def q_best_model_report(spark, d):
    """The refitted model's class report with its accuracy, and the one feature's importance."""
    report, importance, predictions = _best_model(spark, d)
    n = predictions.count()
    weight = importance.select(F.concat(F.lit("importance of "), "feature").alias("class"), F.lit(None).cast("double").alias("precision"),
                               F.lit(None).cast("double").alias("recall"), F.col("importance").alias("f1"), F.lit(n).cast("long").alias("support"))
    # rows of the report are few: they are held, so that the result's plan does not score the table again
    report = spark.createDataFrame(report.collect(), report.schema)
    return report.select("class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support").unionByName(weight)


@query("best_model_predictions", sv(BUCKET_CTES + " select id, prediction as label from scored"))
def q_best_model_predictions(spark, d):
    """Predictions of the unlabelled table, written to a file and read back."""
    path = scratch_path(spark, "best-predictions")
    _best_model(spark, d, path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.IntegerType())])
    return csvio.read_table_csv(spark, path, schema)


# ---------------------------------------------------------------- partition sweep
SWEEP_MODELS = ["LR", "MLP", "RF"]


def _sweep(spark, d):
    from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier

    tr, te = _bucket_data(spark, d)
    trees, depth = models.RF_SWEEP
    estimators = {
        "LR": LogisticRegression(**models.LR_SWEEP),
        "MLP": MultilayerPerceptronClassifier(layers=[BUCKETS, *models.MLP_HIDDEN, 2], maxIter=models.MLP_ITERATIONS, seed=MLP_SEED),
        "RF": RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=42, featureSubsetStrategy="all"),
    }
    return experiments.partition_sweep(estimators, tr, te, experiments.PARTITION_COUNTS)


SWEEP_CTES = BUCKET_CTES + f""",
{CLASS_SQL.strip()},
m as (select round(sum(tp) / sum(support), 6) as accuracy, round(sum(precision * support) / sum(support), 6) as precision,
             round(sum(recall * support) / sum(support), 6) as recall from perf)"""
SWEEP_VALUES = ", ".join(f"('{m}')" for m in SWEEP_MODELS)


@query("partition_sweep", sv(SWEEP_CTES + f"""
select t.m as model, cast(p.p as int) as partitions, m.accuracy, m.precision, m.recall from m
cross join (values {SWEEP_VALUES}) t(m) cross join (values {', '.join(f'({c})' for c in experiments.PARTITION_COUNTS)}) p(p)
"""))
def q_partition_sweep(spark, d):
    """LR, MLP and RF at 1, 2, 4, 8, 16 and 32 partitions; the timing column is left out."""
    return _sweep(spark, d).select("model", "partitions", *[r6(c).alias(c) for c in ("accuracy", "precision", "recall")])


@query("sweep_best_worst", sv(SWEEP_CTES + f"""
select t.m as model, k.k as metric, 1 as best_partitions, k.v as best_value, 1 as worst_partitions, k.v as worst_value
from (values {SWEEP_VALUES}) t(m) cross join
     (select 'accuracy' as k, accuracy as v from m union all select 'precision', precision from m union all select 'recall', recall from m) k
"""))
def q_sweep_best_worst(spark, d):
    """Best and worst runs of the sweep: its metrics do not depend on the partition count,
    so the first count is both."""
    out = experiments.best_worst_runs(_sweep(spark, d), ["accuracy", "precision", "recall"], ())
    return out.select("model", "metric", "best_partitions", r6("best_value").alias("best_value"),
                      "worst_partitions", r6("worst_value").alias("worst_value"))


@query("phase_times", sv(f"""
select 'read' as phase, count(*) as rows from survey union all
select 'train', count(*) from survey where {TRAIN_WHERE} union all
select 'test', count(*) from survey where {TEST_WHERE}
"""))
def q_phase_times(spark, d):
    """Phases with the rows each worked on; the seconds are left out of the check."""
    tr, te = (x.persist() for x in _bucket_data(spark, d))
    state = {}

    def train():
        state["model"] = models.train_rf(tr, *models.RF_SETTINGS["small"])
        return tr.count()

    out = experiments.timed_phases(spark, {
        "read": lambda: tr.count() + te.count(), "train": train,
        "test": lambda: evaluate.accuracy(state["model"].transform(te)).first()["n"]})
    tr.unpersist()
    te.unpersist()
    return out.select("phase", "rows")


# ============================================================== top-k and labels
@query("top_k", sv("select id, price from survey where price is not null order by price desc, id limit 10"))
def q_top_k(spark, d):
    return profile.top_k(fx.survey(spark, d).select("id", "price").where(F.col("price").isNotNull()), "price", 10, "id")


@query("percent_label", sv("""
select nation, count(*) as rows, printf('%.1f%%', avg(label) * 100) as positive_share,
       printf('%.2f', count(*) / (select count(*) from survey) * 100) as row_share
from survey group by nation
"""))
def q_percent_label(spark, d):
    from tabkit.functions.scalar import decimal_label, percent_label

    s = fx.survey(spark, d)
    per = s.groupBy("nation").agg(F.count(F.lit(1)).alias("rows"), F.avg("label").alias("p"))
    total = F.sum("rows").over(Window.partitionBy())  # over one row per nation
    per = per.withColumn("total", total)
    return per.select(
        "nation", "rows", percent_label(F.col("p") * 100).alias("positive_share"),
        decimal_label(F.col("rows") / F.col("total") * 100, 2).alias("row_share"),
    )


@query("gbt_early_stop")
def q_gbt_early_stop(spark, d):
    """M6 on a real boosting run: validation log-loss after each of 10 rounds, then
    the patience rule (3 rounds, lower is better)."""
    tr, te, _ = _model_data(spark, d)
    model = models.fit_on(tr, models.train_gbt, max_depth=3, learning_rate=0.3, n_estimators=10)
    losses = models.gbt_round_losses(model, te).withColumn("model", F.lit("gbt"))
    return models.early_stop(losses, 3, score="loss", higher_better=False)


@query("null_counts_docs", with_sql("""
select 'doc_id' as column, count(*) filter (where doc_id is null) as nulls from dq
union all select 'lang', count(*) filter (where lang is null) from dq
union all select 'source', count(*) filter (where source is null) from dq
union all select 'n_chars', count(*) filter (where n_chars is null) from dq
union all select 'quality', count(*) filter (where quality is null) from dq
union all select 'toxic', count(*) filter (where toxic is null) from dq
""", dq=DOC_QUALITY_SQL))
def q_null_counts_docs(spark, d):
    """P4 on natural gaps: documents left-joined with their partial labels."""
    return profile.null_counts(fx.doc_quality(spark, d))


@query("results_frame", sv(union_sql([
    f"select '{m}' as model, round(avg(case when (case when coalesce({c}, 0) > {cut} then 1 else 0 end) = label "
    f"then 1.0 else 0.0 end), 6) as accuracy from survey"
    for m, (c, cut) in RUN_MODELS.items()
])))
def q_results_frame(spark, d):
    """Metric rows computed on Spark (one aggregate, three scorers) become a
    small results table, the way run results are collected."""
    s = fx.survey(spark, d)
    row = s.agg(*[
        F.avg((F.when(F.coalesce(c, F.lit(0.0)) > cut, 1).otherwise(0) == F.col("label")).cast("double")).alias(m)
        for m, (c, cut) in RUN_MODELS.items()
    ]).first()  # one row of three metrics
    rows = [(m, round(float(row[m]), 6)) for m in RUN_MODELS]
    return tabio.results_frame(spark, rows, "model string, accuracy double")


GRID_COLS = {"price_cut": "price", "acct_cut": "acctbal"}


@query("param_grid", sv(f"""
, q as (select {', '.join(f"round(quantile_cont({c}, {p}), 6) as {k}_{i}" for k, c in GRID_COLS.items() for i, p in enumerate((0.25, 0.5, 0.75)))}
       from survey),
a as (select 0 as i, price_cut_0 as price_cut from q union all select 1, price_cut_1 from q union all select 2, price_cut_2 from q),
b as (select 0 as j, acct_cut_0 as acct_cut from q union all select 1, acct_cut_1 from q union all select 2, acct_cut_2 from q)
select cast(row_number() over (order by i, j) as int) as combo, price_cut, acct_cut from a cross join b
"""))
def q_param_grid(spark, d):
    """H2: every combination of candidate cuts, numbered in nested-loop order; the
    candidates are the quartiles of each column, computed exactly on Spark."""
    from tabkit.functions.distributed import column_quantiles

    q = column_quantiles(fx.survey(spark, d), list(GRID_COLS.values()), [0.25, 0.5, 0.75]).collect()  # 6 values
    cuts = {c: [round(r.value, 6) for r in sorted((r for r in q if r.column == c), key=lambda r: r.prob)]
            for c in GRID_COLS.values()}
    return tuning.param_grid(spark, {k: cuts[c] for k, c in GRID_COLS.items()})


CHECK_SHARED_GRID = {"max_depth": [2, 3], "learning_rate": [0.1, 0.3], "n_estimators": [5, 10],
                     "min_child_weight": [1], "subsample": [1.0]}


@query("grid_search_shared")
def q_grid_search_shared(spark, d):
    """H3 with fits shared across n_estimators (4 fits for 8 points) and the
    patience rule on the validation AUC per round."""
    tr, te, _ = _model_data(spark, d)
    return tuning.grid_search(tr, te, tuning.param_grid(spark, CHECK_SHARED_GRID), patience=3, key="id")


GBT_CURVE_ROUNDS = 10
GBT_CURVE_RATE = 0.3


@query("gbt_round_losses", sv(f"""
, tr as (select floor(coalesce(price, 0) / 125000) as v, count(*) as n, sum(label) as p
         from survey where {TRAIN_WHERE} group by 1),
te as (select floor(coalesce(price, 0) / 125000) as v, count(*) as m, sum(label) as q
       from survey where {TEST_WHERE} group by 1),
recursive f(round, v, mg) as (
  select 1, v, (2.0 * p - n) / n from tr
  union all
  select f.round + 1, f.v,
         f.mg + {GBT_CURVE_RATE} * ((tr.p * 4 / (1 + exp(2 * f.mg)) - (tr.n - tr.p) * 4 / (1 + exp(-2 * f.mg))) / tr.n)
  from f join tr on f.v = tr.v where f.round < {GBT_CURVE_ROUNDS}
)
select cast(f.round as int) as round,
       round(sum(te.q * ln(1 + exp(-2 * f.mg)) + (te.m - te.q) * ln(1 + exp(2 * f.mg))) / sum(te.m), 6) as loss
from f join te on f.v = te.v group by f.round
""").replace("with survey as", "with recursive survey as", 1).replace(",\nrecursive f(", ",\nf(", 1))
def q_gbt_round_losses(spark, d):
    """Validation log-loss after each boosting round, with a closed form: on one
    4-valued feature each round's tree gives every value its own leaf, whose
    value is the mean pseudo-residual of Spark's logistic loss."""
    train, test = _train_test(spark, d)

    def prep(df):
        x = df.select(F.floor(F.coalesce("price", F.lit(0.0)) / 125000).cast("double").alias("f"),
                      F.col("label").cast("double").alias("label"))
        return features.assemble(x, ["f"])

    model = models.fit_on(prep(train), models.train_gbt, max_depth=5, learning_rate=GBT_CURVE_RATE,
                             n_estimators=GBT_CURVE_ROUNDS)
    losses = models.gbt_round_losses(model, prep(test))
    return losses.select("round", r6("loss").alias("loss"))


CURVE_GRID = {"max_depth": [5], "learning_rate": [0.1, 0.3], "n_estimators": [4, 8],
              "min_child_weight": [1], "subsample": [1.0]}
CURVE_PATIENCE = 2


@query("grid_search_curve", _grid_sql_boosted(CURVE_GRID, CURVE_PATIENCE, "loss"))
def q_grid_search_curve(spark, d):
    """H3 and M6 on the validation loss: learning rates and numbers of rounds of one boosting run."""
    tr, te = _bucket_frames(spark, d)
    res = tuning.grid_search(tr, te, tuning.param_grid(spark, CURVE_GRID), patience=CURVE_PATIENCE, metric="loss", key="id")
    return res.select("combo", "max_depth", "learning_rate", "n_estimators", "min_child_weight", "subsample",
                      "best_round", "stop_round", r6("val_loss").alias("val_loss"), r6("score").alias("score"))


# ---------------------------------------------------------------- boosted trees on two features
BOOST_CHECK = boosting.Settings(max_depth=2, learning_rate=0.3, n_estimators=5, min_child_weight=3, subsample=0.9)
BOOST_NAMES = ["bucket", "month"]
TWO_FEATURE_CTES = f"""
, b as (select id, {HASH_SQL.format(c='id')} as u, {BUCKET_SQL} as f0, month as f1, label from survey),
tr as (select * from b where {TRAIN_WHERE}), te as (select * from b where {TEST_WHERE}),"""


def _two_features(spark, d):
    def ready(df):
        x = df.select("id", F.col("label").cast("double").alias("label"), _bucket().cast("double").alias("bucket"), F.col("month").cast("double").alias("month"))
        return features.assemble(x, BOOST_NAMES)

    train, test = _train_test(spark, d)
    return ready(train), ready(test)


@query("boost_margins", sv(TWO_FEATURE_CTES + boost_sql.boosted([BOOST_CHECK], BOOST_CHECK.n_estimators) + f"""
select f0 as bucket, f1 as month, count(*) as rows, round(any_value(mg), 6) as margin
from te join mg{BOOST_CHECK.n_estimators} using (f0, f1) group by all
"""))
def q_boost_margins(spark, d):
    """M5 with second-order statistics: five rounds of depth 2 on nine tenths of the rows, a hessian
    sum of 3 in each child; the margin of every pair of values."""
    tr, te = _two_features(spark, d)
    scored = boosting.fit(tr, BOOST_CHECK, key="id").transform(te)
    out = scored.groupBy(F.col("bucket").cast("int").alias("bucket"), F.col("month").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("margin").alias("margin"))
    out = spark.createDataFrame(out.toArrow())  # a row for each pair of values
    return out.select("bucket", "month", "rows", r6("margin").alias("margin"))


# ---- run tables of trained models: (model, rounds, auc)
RUN_SETTINGS = {"fast": boosting.Settings(2, 0.5, 6, 3, 0.8), "slow": boosting.Settings(1, 0.1, 6, 1, 0.9)}
_RUNS_CTES = TWO_FEATURE_CTES + boost_sql.boosted(list(RUN_SETTINGS.values()), 6) + "," + boost_sql.AUC_CTES + f""",
runs as (select n.name as model, r as rounds, round(value, 9) as auc from sc join (values {', '.join(f"({i}, '{n}')" for i, n in enumerate(RUN_SETTINGS))}) n(m, name) using (m))"""


def _boost_runs(spark, d) -> DataFrame:
    """Two models, trained together, as a results table with the test AUC after every round."""
    tr, te = _two_features(spark, d)
    _, scores, _ = boosting.fit_many(tr, list(RUN_SETTINGS.values()), te, key="id")
    names = list(RUN_SETTINGS)
    return tabio.results_frame(spark, [(names[m], r, round(v, 9)) for m, r, v in scores], "model string, rounds int, auc double")


@query("boost_best_worst_runs", sv(_RUNS_CTES + """
select model, 'auc' as metric, arg_max(rounds, (auc, -rounds)) as best_rounds, max(auc) as best_value,
       arg_min(rounds, (auc, rounds)) as worst_rounds, min(auc) as worst_value from runs group by model
"""))
def q_boost_best_worst_runs(spark, d):
    """X2 on trained models: the best and the worst number of rounds."""
    return experiments.best_worst_runs(_boost_runs(spark, d), ["auc"], (), x="rounds")


@query("boost_series", sv(_RUNS_CTES + """
select model, rounds, 'auc' as metric, round(auc, 6) as value,
       row_number() over (partition by model order by auc desc, rounds) = 1 as is_best,
       row_number() over (partition by model order by auc, rounds) = 1 as is_worst from runs
"""))
def q_boost_series(spark, d):
    """C6 on trained models: the AUC by number of rounds."""
    return charts.metric_series(_boost_runs(spark, d), ["auc"], (), x="rounds")


@query("boost_importance", sv(TWO_FEATURE_CTES + boost_sql.boosted([BOOST_CHECK], BOOST_CHECK.n_estimators) + f""",
per as (select k, count(*) as splits, sum(gain) as total_gain, avg(gain) as mean from cuts group by k)
select n.name as feature, coalesce(splits, 0) as splits, round(coalesce(total_gain, 0), 3) as total_gain,
       round(coalesce(mean, 0) / (select sum(mean) from per), 6) as importance
from (values {', '.join(f"({i}, '{n}')" for i, n in enumerate(BOOST_NAMES))}) n(k, name) left join per using (k)
"""))
def q_boost_importance(spark, d):
    """M9 as the boosting library measures it: mean gain of a feature's splits, scaled to sum 1."""
    tr, _te = _two_features(spark, d)
    out = boosting.gain_importance(boosting.fit(tr, BOOST_CHECK, key="id"), BOOST_NAMES)
    return out.select("feature", "splits", F.round("total_gain", 3).alias("total_gain"), r6("importance").alias("importance"))


SWEEP_COUNTS = [1, 2, 4]


@query("partition_sweep_metrics", sv(f"""
, tr as (select floor(coalesce(price, 0) / 125000) as v, count(*) as n, sum(label) as p
         from survey where {TRAIN_WHERE} group by 1),
cls as (select v, case when 2 * p - n > 0 then 1 else 0 end as prediction from tr),
scored as (select s.label, c.prediction from survey s
           join cls c on floor(coalesce(s.price, 0) / 125000) = c.v where {TEST_WHERE.replace('id', 's.id')}),
{CLASS_SQL.strip()},
m as (select sum(tp) / sum(support) as accuracy, sum(precision * support) / sum(support) as precision,
             sum(recall * support) / sum(support) as recall from perf)
select 'GBT1' as model, cast(t.p as int) as partitions, round(m.accuracy, 6) as accuracy,
       round(m.precision, 6) as precision, round(m.recall, 6) as recall
from m cross join (values {', '.join(f'({c})' for c in SWEEP_COUNTS)}) t(p)
"""))
def q_partition_sweep_metrics(spark, d):
    """X1 with a closed form: a one-round boosting model on one 4-valued feature
    predicts each value's majority class at every partition count; only the
    deterministic columns (no timing) are compared."""
    from pyspark.ml.classification import GBTClassifier

    train, test = _train_test(spark, d)

    def prep(df):
        x = df.select(F.floor(F.coalesce("price", F.lit(0.0)) / 125000).cast("double").alias("f"),
                      F.col("label").cast("double").alias("label"))
        return features.assemble(x, ["f"])

    est = {"GBT1": GBTClassifier(maxIter=1, maxDepth=5, seed=42)}
    res = experiments.partition_sweep(est, prep(train), prep(test), SWEEP_COUNTS)
    return res.select("model", "partitions", *[r6(c).alias(c) for c in ("accuracy", "precision", "recall")])
