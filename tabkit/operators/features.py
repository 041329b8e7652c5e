"""Feature preparation (T1–T10), dictionaries (W1, N3), column moves.

Fitting reads small parameter tables (one row per column, or per category);
applying is one wide ``select`` that stays inside whole-stage codegen, with a
broadcast hash join only for dictionaries too large to inline.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.distributed import BROADCAST_ROWS, column_quantiles, dense_index, present

# Fixed value: the fill word for missing categories.
MISSING = "missing"
# Dictionaries up to this size are inlined as a literal map; larger ones join.
INLINE_DICT = 256


def _c(name: str):
    return F.col(f"`{name}`")


# ---------------------------------------------------------------- T1 median fill
def fit_median(df: DataFrame, cols: list[str], exact: bool = True, accuracy: int = 10000) -> dict:
    """Median of each column, NULL/NaN skipped (one row per column reaches the driver).

    ``exact=True`` gives the interpolated median of pandas / scikit-learn through
    a distributed selection (no group's values held in one task);
    ``exact=False`` uses ``percentile_approx`` in a single pass.
    """
    if not cols:
        return {}
    if not exact:
        row = df.agg(*[
            F.percentile_approx(F.when(~F.isnan(_c(c).cast("double")), _c(c).cast("double")), 0.5, accuracy).alias(f"m{i}")
            for i, c in enumerate(cols)
        ]).first()
        return {c: row[f"m{i}"] for i, c in enumerate(cols)}
    got = {r["column"]: r["value"] for r in column_quantiles(df, cols, [0.5]).collect()}
    return {c: got.get(c) for c in cols}


def filled_moments(df: DataFrame, cols: list[str], medians: dict) -> dict:
    """Mean and population deviation that each column will have once its gaps hold the
    median, from one aggregate over the observed values.

    The observed moments merge with k copies of the median (the pairwise update of
    Chan et al.), so the filled table is never read.
    """
    if not cols:
        return {}
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[
        x for i, c in enumerate(cols) for x in (
            F.count(present(_c(c))).alias(f"n{i}"), F.avg(present(_c(c))).alias(f"m{i}"), F.var_pop(present(_c(c))).alias(f"v{i}"))
    ]).first()
    scale = {}
    for i, c in enumerate(cols):
        rows, n, med = row["rows"], row[f"n{i}"], medians.get(c)
        if not n:
            scale[c] = (None, None)
            continue
        k, delta = rows - n, med - row[f"m{i}"]
        mean = row[f"m{i}"] + delta * k / rows
        m2 = row[f"v{i}"] * n + delta * delta * n * k / rows
        scale[c] = (mean, math.sqrt(max(m2 / rows, 0.0)))
    return scale


def apply_fill(df: DataFrame, values: dict) -> DataFrame:
    """Fill NULL (and NaN) of each column with its value; other columns untouched."""
    exprs = []
    for c in df.columns:
        if c in values and values[c] is not None:
            x = _c(c)
            num = F.when(F.isnan(x.cast("double")), None).otherwise(x) if _is_float(df, c) else x
            exprs.append(F.coalesce(num, F.lit(values[c]).cast(df.schema[c].dataType)).alias(c))
        else:
            exprs.append(_c(c))
    return df.select(*exprs)


def _is_float(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("double", "float")


def impute_median(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """T1 in one call: fit medians on ``df`` and fill them in (as doubles)."""
    cast = df.select(*[(_c(c).cast("double") if c in cols else _c(c)).alias(c) for c in df.columns])
    return apply_fill(cast, fit_median(cast, cols, exact))


# ---------------------------------------------------------------- T2 constant fill
def fill_constant(df: DataFrame, cols: list[str], value: str = MISSING) -> DataFrame:
    """NULL strings become ``value``."""
    return df.select(*[(F.coalesce(_c(c), F.lit(value)) if c in cols else _c(c)).alias(c) for c in df.columns])


# ---------------------------------------------------------------- T3 scaling
def fit_scale(df: DataFrame, cols: list[str]) -> dict:
    """Mean and population deviation of each column (NULL and NaN skipped), one aggregate."""
    if not cols:
        return {}
    row = df.agg(*[
        x for i, c in enumerate(cols)
        for x in (F.avg(present(_c(c))).alias(f"m{i}"), F.stddev_pop(present(_c(c))).alias(f"s{i}"))
    ]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def apply_scale(df: DataFrame, params: dict) -> DataFrame:
    """(x - mean) / deviation; a zero deviation divides by 1 (scikit-learn)."""
    exprs = []
    for c in df.columns:
        if c in params:
            mean, sd = params[c]
            sd = sd if sd not in (None, 0.0) else 1.0
            exprs.append(((_c(c) - F.lit(mean)) / F.lit(sd)).alias(c))
        else:
            exprs.append(_c(c))
    return df.select(*exprs)


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    return apply_scale(df, fit_scale(df, cols))


# ---------------------------------------------------------------- T4 one-hot
def fit_one_hot(df: DataFrame, cols: list[str]) -> dict:
    """Sorted distinct categories of each column (NULL excluded). They become columns, so
    they are read to the driver; ``one_hot_vector`` keeps them distributed."""
    return fit_categories(df, cols, [])[0]


def apply_one_hot(df: DataFrame, categories: dict, drop_source: bool = True) -> DataFrame:
    """One 0/1 double column per category, named ``<col>_<value>``; unseen → all zeros."""
    keep = [_c(c) for c in df.columns if not (drop_source and c in categories)]
    new = [
        F.when(_c(c).cast("string") == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{v}")
        for c, values in categories.items() for v in values
    ]
    return df.select(*keep, *new)


def one_hot(df: DataFrame, cols: list[str]) -> DataFrame:
    return apply_one_hot(df, fit_one_hot(df, cols))


def one_hot_vector(df: DataFrame, col: str, out: str, dictionary: "Dictionary | None" = None) -> DataFrame:
    """T4 for any number of categories: one sparse 0/1 vector column beside the others,
    position = rank of the category; unseen and NULL give an empty vector."""
    dictionary = dictionary or category_dictionary(df, col)
    size = max(dictionary.size, 1)
    code = f"_code_{uuid.uuid4().hex[:12]}"
    coded = dictionary_lookup(df.withColumn(code, _c(col)), code, dictionary, default=size)
    # the position past the last category stands for none and is dropped
    sizes = df.sparkSession.range(size, size + 1).select(F.col("id").cast("int").alias(code))
    encoder = OneHotEncoder(inputCols=[code], outputCols=[out], dropLast=True).fit(sizes)
    return encoder.transform(coded).drop(code)


# ---------------------------------------------------------------- W1 / N3 dictionaries
@dataclass
class Dictionary:
    """Value → code table of one column, with its size known.

    Small dictionaries keep only ``inline`` (value → code); their table is made
    on demand. Large ones keep a distributed table (value string, code int).
    """

    column: str
    distributed: DataFrame | None
    size: int
    inline: dict | None = None  # filled when size <= INLINE_DICT

    @property
    def table(self) -> DataFrame:
        if self.distributed is None:
            spark = SparkSession.getActiveSession()
            rows = sorted(self.inline.items(), key=lambda kv: kv[1])
            self.distributed = spark.createDataFrame(rows, "value string, code int")
        return self.distributed


def category_dictionary(df: DataFrame, col: str) -> Dictionary:
    """Distinct non-NULL values in ascending order; code = rank (0-based)."""
    return fit_categories(df, [], [col])[1][col]


def fit_categories(df: DataFrame, one_hot_cols: list[str], ordinal_cols: list[str]) -> tuple[dict, dict]:
    """Fit one-hot categories and ordinal dictionaries in one pass over ``df``.

    All categorical columns are unpivoted and de-duplicated together (one
    shuffle of distinct (column, value) pairs). Categories sort in their column's own type:
    numbers as numbers, other values as text. One-hot categories reach the driver (they
    become columns), and so do ordinal dictionaries of up to INLINE_DICT values; larger
    ones stay distributed and are numbered by ``dense_index``.
    """
    cols = list(dict.fromkeys([*one_hot_cols, *ordinal_cols]))
    if not cols:
        return {}, {}
    numeric = {c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)}
    long = df.select(*[_c(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    pairs = long.where(F.col("value").isNotNull()).distinct().persist()
    try:
        sizes = {c: 0 for c in cols}
        sizes.update({r["column"]: r["n"] for r in pairs.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()})
        small = [c for c in cols if c in one_hot_cols or sizes[c] <= INLINE_DICT]
        found: dict = {c: [] for c in small}
        for r in pairs.where(F.col("column").isin(small)).collect() if small else ():
            found[r["column"]].append(r["value"])
        order = {c: (lambda v: (float(v), v)) if c in numeric else (lambda v: v) for c in cols}
        categories = {c: sorted(found[c], key=order[c]) for c in one_hot_cols}
        dictionaries = {}
        for c in ordinal_cols:
            if sizes[c] <= INLINE_DICT:
                values = sorted(found[c], key=order[c])
                dictionaries[c] = Dictionary(c, None, sizes[c], {v: i for i, v in enumerate(values)})
            else:
                own = pairs.where(F.col("column") == c).select(F.col("value").cast(df.schema[c].dataType if c in numeric else "string").alias("value"))
                table = dense_index(own, "value").select(F.col("value").cast("string").alias("value"), "code").checkpoint(eager=True)
                dictionaries[c] = Dictionary(c, table, sizes[c], None)
    finally:
        pairs.unpersist()
    return categories, dictionaries


def dictionary_lookup(df: DataFrame, col: str, dictionary: Dictionary, default: int = -1,
                      out: str | None = None) -> DataFrame:
    """Replace ``col`` by its code; values not in the dictionary (and NULL) get ``default``.

    Small dictionaries are a literal map; larger ones a broadcast hash join when
    their size is under the broadcast bound, else a shuffled join.
    """
    out = out or col
    key = _c(col).cast("string")
    if dictionary.inline is not None:
        if dictionary.inline:
            m = F.create_map(*[x for k, v in sorted(dictionary.inline.items()) for x in (F.lit(k), F.lit(v))])
            code = F.coalesce(m[key], F.lit(default))
        else:
            code = F.lit(default)
        return df.select(*[(code.cast("int").alias(out) if c == col else _c(c)) for c in df.columns])
    tag = f"_code_{uuid.uuid4().hex[:12]}"  # unique per lookup, so lookups can be chained
    d = dictionary.table.select(F.col("value").alias(f"{tag}_v"), F.col("code").alias(tag))
    if dictionary.size <= BROADCAST_ROWS:
        d = F.broadcast(d)
    # a NULL key matches nothing: it goes to a partition of its own hash, not to one with all NULLs
    spread = F.coalesce(key, F.concat(F.lit("\x00"), F.xxhash64(*[_c(c) for c in df.columns]).cast("string")))
    joined = df.join(d, spread == F.col(f"{tag}_v"), "left")
    return joined.select(*[
        (F.coalesce(F.col(tag), F.lit(default)).cast("int").alias(out) if c == col else _c(c)) for c in df.columns
    ])


# ---------------------------------------------------------------- T5 / T6 codes
def fit_ordinal(df: DataFrame, cols: list[str]) -> dict:
    return fit_categories(df, [], cols)[1]


def apply_ordinal(df: DataFrame, dictionaries: dict, default: int = -1) -> DataFrame:
    """T5: code = rank among the fitted categories; unseen → -1."""
    for c, d in dictionaries.items():
        df = dictionary_lookup(df, c, d, default)
    return df


def ordinal_encode(df: DataFrame, cols: list[str]) -> DataFrame:
    return apply_ordinal(df, fit_ordinal(df, cols))


def apply_category_codes(df: DataFrame, cols: list[str], dictionaries: dict | None = None) -> DataFrame:
    """Category codes with NULL → -1. Without ``dictionaries`` each table is
    coded on its own (as the reference does per table); pass the training
    dictionaries to share codes."""
    dictionaries = dictionaries or fit_ordinal(df, cols)
    return apply_ordinal(df, dictionaries, default=-1)


# ---------------------------------------------------------------- T7 / T8
def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Gather feature columns in one dense vector (invalid values raise)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)


def index_label(df: DataFrame, col: str, out: str = "label"):
    """Most frequent class → 0.0, ties by name (``StringIndexer`` default)."""
    model = StringIndexer(inputCol=col, outputCol=out).fit(df)
    return model.transform(df), model


# ---------------------------------------------------------------- J1–J3, N2
def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[_c(c) for c in cols])


def target_first(df: DataFrame, target: str) -> DataFrame:
    """Move the target to the first position."""
    return df.select(_c(target), *[_c(c) for c in df.columns if c != target])


def concat_columns(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Two tables side by side; rows pair up by key (full outer, like index alignment)."""
    return a.join(b, key, "full_outer")


# ---------------------------------------------------------------- T9 / T10
@dataclass
class PrepModel:
    """Fitted preparation: medians, scaling, categories and dictionaries."""

    target: str | None
    numeric: list[str]
    categorical: list[str]
    one_hot_cols: list[str]
    ordinal_cols: list[str]
    drop: list[str]
    medians: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)
    dictionaries: dict = field(default_factory=dict)
    fill_value: str = MISSING

    @classmethod
    def fit(cls, df: DataFrame, target, numeric, one_hot_cols, ordinal_cols, drop=(),
            categorical=None, fill_value: str = MISSING, exact_median: bool = True) -> "PrepModel":
        categorical = list(categorical) if categorical is not None else list(one_hot_cols) + list(ordinal_cols)
        m = cls(target, list(numeric), categorical, list(one_hot_cols), list(ordinal_cols), list(drop),
                fill_value=fill_value)
        used = [c for c in df.columns if c in m.numeric or c in m.categorical]
        # The fit reads its input several times (quantiles, moments, categories):
        # keep the used columns, spilling to disk when they do not fit in memory.
        base = df.select(*[(_c(c).cast("double") if c in m.numeric else _c(c)).alias(c) for c in used])
        base = base.persist(StorageLevel.MEMORY_AND_DISK)
        m.medians = fit_median(base, m.numeric, exact_median)
        m.scale = filled_moments(base, m.numeric, m.medians)
        cats = fill_constant(base, m.categorical, fill_value)
        m.categories, m.dictionaries = fit_categories(cats, m.one_hot_cols, m.ordinal_cols)
        base.unpersist()
        return m

    def transform(self, df: DataFrame) -> DataFrame:
        """Apply with the fitted parameters: fill, scale, fill strings, one-hot,
        ordinal codes, drop, target first, as one projection (after a broadcast
        join for each dictionary too large to inline)."""
        joined = df
        code_cols = {}
        for i, (c, d) in enumerate(self.dictionaries.items()):
            if d.inline is None and c in df.columns:
                tag = f"_code{i}"
                table = d.table.select(F.col("value").alias(f"{tag}_v"), F.col("code").alias(tag))
                table = F.broadcast(table) if d.size <= BROADCAST_ROWS else table
                key = F.coalesce(_c(c).cast("string"), F.lit(self.fill_value))
                joined = joined.join(table, key == F.col(f"{tag}_v"), "left")
                code_cols[c] = tag

        def filled(c):
            return F.coalesce(_c(c).cast("string") if c in self.dictionaries or c in self.categories else _c(c),
                              F.lit(self.fill_value))

        def column(c):
            if c in self.numeric:
                x = _c(c).cast("double")
                x = F.when(F.isnan(x), None).otherwise(x)
                if self.medians.get(c) is not None:
                    x = F.coalesce(x, F.lit(float(self.medians[c])))
                if c in self.scale:
                    mean, sd = self.scale[c]
                    sd = sd if sd not in (None, 0.0) else 1.0
                    x = (x - F.lit(mean)) / F.lit(sd)
                return x.alias(c)
            if c in self.dictionaries:
                d = self.dictionaries[c]
                if c in code_cols:
                    code = F.col(code_cols[c])
                elif d.inline:
                    m = F.create_map(*[x for k, v in sorted(d.inline.items()) for x in (F.lit(k), F.lit(v))])
                    code = m[filled(c)]
                else:
                    code = F.lit(None)
                return F.coalesce(code, F.lit(-1)).cast("int").alias(c)
            if c in self.categorical:
                return filled(c).alias(c)
            return _c(c)

        kept = [c for c in df.columns if c not in self.drop and c not in self.categories]
        if self.target in kept:
            kept = [self.target] + [c for c in kept if c != self.target]
        one_hot = [
            F.when(filled(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{v}")
            for c, values in self.categories.items() if c in df.columns for v in values
        ]
        return joined.select(*[column(c) for c in kept], *one_hot)

    def feature_columns(self, df: DataFrame) -> list[str]:
        return [c for c in self.transform(df).columns if c != self.target]


def prepare(df: DataFrame, target, numeric, one_hot_cols, ordinal_cols, drop=(), **kw):
    """Fit on ``df`` and return (prepared frame, fitted model).

    T10: ``model.transform(test)`` applies the training parameters; calling
    ``prepare(test, ...)`` instead refits on the test table, as the reference does.
    """
    model = PrepModel.fit(df, target, numeric, one_hot_cols, ordinal_cols, drop, **kw)
    return model.transform(df), model
