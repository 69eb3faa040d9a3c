"""Catalog: preprocessing fit/apply (F*) and feature engineering (G*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import engineer as G
from ..operators import prep
from ..operators.prep import FeaturePipeline
from .catalog import DOCS_SQL, LINEITEM_NULLS_SQL, MIX_SQL, R, T, docs_labels, lineitem_nulls, mix, r, register


# --------------------------------------------------------------------------
# imputers
# --------------------------------------------------------------------------

@register("f1_f3_fit_imputers", f"""
SELECT 'n_chars' AS column_name, 'median' AS strategy, CAST(quantile_cont(CAST(n_chars AS DOUBLE), 0.5) AS VARCHAR) AS value FROM {DOCS_SQL}
UNION ALL SELECT 'quality', 'median', CAST(quantile_cont(CAST(quality AS DOUBLE), 0.5) AS VARCHAR) FROM {DOCS_SQL}
UNION ALL SELECT 'toxic', 'median', CAST(quantile_cont(CAST(toxic AS DOUBLE), 0.5) AS VARCHAR) FROM {DOCS_SQL}
UNION ALL SELECT 'lang', 'mode', coalesce((SELECT lang FROM {DOCS_SQL} WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1), 'missing')
UNION ALL SELECT 'source', 'mode', coalesce((SELECT source FROM {DOCS_SQL} WHERE source IS NOT NULL GROUP BY source ORDER BY count(*) DESC, source LIMIT 1), 'missing')
UNION ALL SELECT 'text', 'missing_token', 'missing'""")
def fit_imputers_q(spark, sf_dir):
    """Median (numbers), mode with lowest value on ties (categories), token (high cardinality)."""
    d = docs_labels(spark, sf_dir).join(T(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return prep.fit_imputers(d, numeric=["n_chars", "quality", "toxic"], categorical=["lang", "source"],
                             high_cardinality=["text"])


@register("f4_apply_imputers", f"""
SELECT l_orderkey, l_linenumber,
  coalesce(l_discount, (SELECT quantile_cont(l_discount, 0.5) FROM {LINEITEM_NULLS_SQL})) AS l_discount,
  coalesce(l_linestatus, (SELECT l_linestatus FROM {LINEITEM_NULLS_SQL} WHERE l_linestatus IS NOT NULL
                          GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS l_linestatus
FROM {LINEITEM_NULLS_SQL}""")
def apply_imputers_q(spark, sf_dir):
    """fitted values fill NULLs (numbers as double)."""
    li = lineitem_nulls(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_discount", "l_linestatus")
    params = {r_["column_name"]: r_["value"] for r_ in
              prep.fit_imputers(li, numeric=["l_discount"], categorical=["l_linestatus"]).collect()}
    return prep.impute(li, {"l_discount": float(params["l_discount"]), "l_linestatus": params["l_linestatus"]})


@register("f5_f6_levels", """
SELECT 'l_returnflag' AS column_name, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS idx, v AS value
FROM (SELECT DISTINCT l_returnflag AS v FROM lineitem WHERE l_returnflag IS NOT NULL)
UNION ALL
SELECT 'l_linenumber', CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER), CAST(v AS VARCHAR)
FROM (SELECT DISTINCT l_linenumber AS v FROM lineitem WHERE l_linenumber IS NOT NULL)""")
def levels_q(spark, sf_dir):
    """sorted distinct training values (one-hot categories, ordinal levels)."""
    li = T(spark, sf_dir, "lineitem")
    one = li.agg(F.array_sort(F.collect_set("l_returnflag")).alias("a"),
                 F.array_sort(F.collect_set("l_linenumber")).alias("b"))
    a = one.select(F.lit("l_returnflag").alias("column_name"), F.posexplode("a").alias("idx", "value"))
    b = one.select(F.lit("l_linenumber").alias("column_name"), F.posexplode("b").alias("idx", "value"))
    return a.unionByName(b.select("column_name", "idx", F.col("value").cast("string").alias("value")))


@register("f7_ordinal_codes", """
WITH lv AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
            FROM (SELECT DISTINCT CAST(l_tax AS DOUBLE) AS v FROM lineitem WHERE l_returnflag = 'R' AND l_tax IS NOT NULL))
SELECT l_orderkey, l_linenumber, l_tax, coalesce(lv.code, -1) AS code
FROM lineitem LEFT JOIN lv ON CAST(lineitem.l_tax AS DOUBLE) = lv.v""")
def ordinal_q(spark, sf_dir):
    """levels fitted on returned lines, applied to all lines (unseen → -1)."""
    li = T(spark, sf_dir, "lineitem")
    levels = li.where(F.col("l_returnflag") == "R").agg(
        F.array_sort(F.collect_set(F.col("l_tax").cast("double"))).alias("lv")).collect()[0]["lv"]
    return li.select("l_orderkey", "l_linenumber", "l_tax", prep.ordinal_codes(F.col("l_tax"), levels).alias("code"))


@register("f8_onehot", """
SELECT l_orderkey, l_linenumber,
  CAST(l_returnflag = 'A' AS INTEGER) AS l_returnflag__A, CAST(l_returnflag = 'N' AS INTEGER) AS l_returnflag__N,
  CAST(l_returnflag = 'R' AS INTEGER) AS l_returnflag__R,
  CAST(coalesce(nullif(l_linestatus, 'F') = 'O', false) AS INTEGER) AS l_linestatus__O
FROM lineitem""")
def onehot_q(spark, sf_dir):
    """One 0/1 column per training category; NULL and unseen → all 0."""
    li = lineitem_nulls(spark, sf_dir)
    cats = li.agg(F.array_sort(F.collect_set("l_returnflag")).alias("rf"),
                  F.array_sort(F.collect_set("l_linestatus")).alias("ls")).collect()[0]
    return li.select("l_orderkey", "l_linenumber",
                     *prep.onehot_columns(F.col("l_returnflag"), "l_returnflag", cats["rf"]),
                     *prep.onehot_columns(F.col("l_linestatus"), "l_linestatus", cats["ls"]))


def _md5_mod_sql(expr: str, n: int) -> str:
    h = f"md5(CAST({expr} AS VARCHAR))"
    base = (2 ** 32) % n
    acc = "CAST(0 AS BIGINT)"
    for i in range(4):
        piece = f"CAST(('0x' || substr({h}, {8 * i + 1}, 8)) AS BIGINT)"
        acc = f"(({acc} * {base} + ({piece} % {n})) % {n})"
    return acc


@register("f9_hashing", f"SELECT p_partkey, CAST({_md5_mod_sql('p_name', 8)} AS BIGINT) AS bucket, "
                        f"CAST({_md5_mod_sql('p_brand', 7)} AS BIGINT) AS brand_bucket FROM part")
def hashing_q(spark, sf_dir):
    """md5 of the text modulo n, computed exactly with built-ins."""
    p = T(spark, sf_dir, "part")
    return p.select("p_partkey", prep.md5_mod(F.col("p_name"), 8).alias("bucket"),
                    prep.md5_mod(F.col("p_brand"), 7).alias("brand_bucket"))


@register("f8_f9_sparse_vector", f"""
WITH b AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS place, count(*) OVER () AS brands FROM (SELECT DISTINCT p_brand FROM part)),
k AS (SELECT count(*) AS brands FROM (SELECT DISTINCT p_brand FROM part))
SELECT p_partkey, CAST(1 + 100000 + CASE WHEN k.brands <= 20 THEN k.brands ELSE 100000 END AS INTEGER) AS size,
  CAST(CASE WHEN k.brands <= 20 THEN 1 + place ELSE 1 + 100000 + {_md5_mod_sql('p_brand', 100000)} END AS BIGINT) AS brand_place,
  CAST(1 + CASE WHEN k.brands <= 20 THEN k.brands ELSE 0 END + {_md5_mod_sql('p_name', 100000)} AS BIGINT) AS name_place
FROM part JOIN b USING (p_brand), k""")
def sparse_vector_q(spark, sf_dir):
    """Price, brand (one-hot, or hashed where there are many) and name (hashed into 100,000
    buckets) as one sparse vector per row; the places of the entries that are set."""
    from ..operators import stages as ST
    p = T(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_name", "p_brand")
    model = ST.TabularFeatures(config={"hashing_dim": 100_000}, ignored=["p_partkey"], outputCol="x").fit(p)
    out = model.transform(p)
    start = {x["column"]: x for x in ST.vector_parts(out, "x")}
    v = out.select("p_partkey", F.unwrap_udt("x").alias("v"))

    def place(c):
        lo, hi = start[c]["from"], start[c]["from"] + start[c]["size"]
        return F.element_at(F.filter("v.indices", lambda i: (i >= lo) & (i < hi)), 1).cast("long")

    return v.select("p_partkey", F.col("v.size").alias("size"), place("p_brand").alias("brand_place"), place("p_name").alias("name_place"))


@register("f10_f13_scalers", f"""
WITH s AS (SELECT avg(o_totalprice) AS mu, stddev_samp(o_totalprice) AS sd, min(o_totalprice) AS lo,
                  max(o_totalprice) AS hi, quantile_cont(o_totalprice, 0.25) AS q1,
                  quantile_cont(o_totalprice, 0.5) AS med, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)
SELECT o_orderkey, {r('(o_totalprice - mu) / sd')} AS standard, {r('(o_totalprice - lo) / (hi - lo)')} AS minmax,
  {r('(o_totalprice - med) / (q3 - q1)')} AS robust FROM orders, s""")
def scalers_q(spark, sf_dir):
    """Standard, min-max and robust scaling fitted on the column."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    out = {}
    for method in ("standard", "minmax", "robust"):
        p = FeaturePipeline({"scaler": method, "quantiles": "exact"})
        p.fit(o.select("o_totalprice"))
        out[method] = p.state["scalers"]["o_totalprice"]
    cols = [R((F.col("o_totalprice") - F.lit(a)) / F.lit(b)).alias(m) for m, (_, a, b) in out.items()]
    return o.select("o_orderkey", *cols)


@register("f14_f17_datetime_parts", """
WITH ref AS (SELECT min(ts) AS m FROM events)
SELECT event_id, CAST(ts IS NULL AS INTEGER) AS ts__missing, CAST(year(ts) AS INTEGER) AS ts__year,
  CAST(month(ts) AS INTEGER) AS ts__month, CAST(day(ts) AS INTEGER) AS ts__day,
  CAST(isodow(ts) - 1 AS INTEGER) AS ts__dayofweek, CAST(isodow(ts) - 1 IN (5, 6) AS INTEGER) AS ts__is_weekend,
  CAST(hour(ts) AS INTEGER) AS ts__hour, CAST(minute(ts) AS INTEGER) AS ts__minute,
  CAST(second(ts) AS INTEGER) AS ts__second,
  CAST(floor((epoch_us(ts) - epoch_us(ref.m)) / 86400000000) AS BIGINT) AS ts__days_since
FROM events, ref""")
def datetime_q(spark, sf_dir):
    """Parse, date parts (Monday = 0) and floored days since the minimum."""
    ev = T(spark, sf_dir, "events")
    ref = ev.agg(F.min("ts").alias("m")).collect()[0]["m"]
    return ev.select("event_id", *prep.datetime_features(F.col("ts"), "ts", ref.isoformat(sep=" ")))


LI_NUM = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("f18_variance_filter", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {r(f'var_samp(CAST({c} AS DOUBLE))', 4)} AS variance, "
    f"coalesce(var_samp(CAST({c} AS DOUBLE)) > 0.001, false) AS keep FROM lineitem" for c in LI_NUM))
def variance_q(spark, sf_dir):
    """drop numeric columns with variance <= threshold (0.001)."""
    v = prep.variance_filter(T(spark, sf_dir, "lineitem"), LI_NUM, 0.001)
    return v.select("column_name", R("variance", 4).alias("variance"), "keep")


def _corr_filter_sql(cols, t):
    pairs = [(i, j) for j in range(len(cols)) for i in range(j)]
    corr = ", ".join(f"corr(CAST({cols[i]} AS DOUBLE), CAST({cols[j]} AS DOUBLE)) AS c{i}_{j}" for i, j in pairs)
    parts = []
    for j, c in enumerate(cols):
        conds = [f"coalesce(abs(c{i}_{j}) > {t}, false)" for i in range(j)]
        drop = " OR ".join(conds) if conds else "false"
        parts.append(f"SELECT '{c}' AS column_name, NOT ({drop}) AS kept FROM cc")
    return f"WITH cc AS (SELECT {corr} FROM lineitem)\n" + "\nUNION ALL\n".join(parts)


@register("f19_correlation_filter", _corr_filter_sql(LI_NUM, 0.5))
def corr_filter_q(spark, sf_dir):
    """of each pair with |corr| > 0.5 the later column is dropped."""
    li = T(spark, sf_dir, "lineitem")
    kept = set(prep.correlation_filter(li, LI_NUM, 0.5))
    return spark.createDataFrame([(c, c in kept) for c in LI_NUM], "column_name string, kept boolean")


ORDER_CATS = {"o_orderstatus": ["F", "O", "P"],
              "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]}


def _pipeline_sql():
    nums = ["o_orderkey", "o_custkey", "o_totalprice"]
    sel = []
    for c in nums:
        sel.append(f"{r(f'({c} - (SELECT avg(CAST({c} AS DOUBLE)) FROM orders)) / (SELECT stddev_samp(CAST({c} AS DOUBLE)) FROM orders)')} AS {c}")
    d = "o_orderdate"
    sel += [f"CAST({d} IS NULL AS INTEGER) AS {d}__missing", f"CAST(year({d}) AS INTEGER) AS {d}__year",
            f"CAST(month({d}) AS INTEGER) AS {d}__month", f"CAST(day({d}) AS INTEGER) AS {d}__day",
            f"CAST(isodow({d}) - 1 AS INTEGER) AS {d}__dayofweek",
            f"CAST(isodow({d}) - 1 IN (5, 6) AS INTEGER) AS {d}__is_weekend", f"CAST(hour({d}) AS INTEGER) AS {d}__hour",
            f"CAST(minute({d}) AS INTEGER) AS {d}__minute", f"CAST(second({d}) AS INTEGER) AS {d}__second",
            f"CAST(floor((epoch_us({d}) - epoch_us((SELECT min({d}) FROM orders))) / 86400000000) AS BIGINT) AS {d}__days_since"]
    for c, cats in ORDER_CATS.items():
        for v in cats:
            sel.append(f"CAST({c} = '{v}' AS INTEGER) AS \"{c}__{v}\"")
    return "SELECT " + ",\n  ".join(sel) + " FROM orders"


@register("f22_pipeline_transform", _pipeline_sql(), headline=True)
def pipeline_q(spark, sf_dir):
    """full fit (typing → parameters) and one-projection transform of orders."""
    o = T(spark, sf_dir, "orders")
    p = FeaturePipeline({"scaler": "standard", "hashing_dim": 8}).fit(o)
    out = p.transform(o)
    dbl = {f.name for f in out.schema.fields if f.dataType.typeName() == "double"}
    return out.select(*[R(prep.qcol(c)).alias(c) if c in dbl else prep.qcol(c) for c in out.columns])


# --------------------------------------------------------------------------
# G: feature engineering
# --------------------------------------------------------------------------

@register("g2_interactions", """
SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS l_quantity_x_l_extendedprice,
  l_quantity * l_discount AS l_quantity_x_l_discount, l_quantity * l_tax AS l_quantity_x_l_tax FROM lineitem""")
def interactions_q(spark, sf_dir):
    """Products of the first pairs in column order."""
    li = T(spark, sf_dir, "lineitem")
    pairs = G.interaction_pairs(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 3)
    return G.add_interactions(li, pairs).select("l_orderkey", "l_linenumber", *[f"{a}_x_{b}" for a, b in pairs])


def _binned_mi_sql(table: str, exprs: dict, target: str, bins: int = 32) -> str:
    """MI (nats) of quantile-binned numeric expressions with a discrete target."""
    probs = ", ".join(str(i / bins) for i in range(1, bins))
    parts = []
    for name, e in exprs.items():
        parts.append(f"""SELECT '{name}' AS feature, CAST(len(list_filter(ed.e, lambda q: x > q)) AS VARCHAR) AS v, y
FROM (SELECT CAST({e} AS DOUBLE) AS x, CAST({target} AS VARCHAR) AS y FROM {table}) b,
     (SELECT quantile_cont(CAST({e} AS DOUBLE), [{probs}]) AS e FROM {table}) ed
WHERE x IS NOT NULL AND y IS NOT NULL""")
    cells = "\nUNION ALL\n".join(parts)
    return f"""WITH cells AS (SELECT feature, v, y, count(*) AS cnt FROM ({cells}) GROUP BY 1, 2, 3),
m AS (SELECT *, sum(cnt) OVER (PARTITION BY feature) AS n, sum(cnt) OVER (PARTITION BY feature, v) AS nv,
             sum(cnt) OVER (PARTITION BY feature, y) AS ny FROM cells)
SELECT feature, greatest(sum(cnt / n * ln(cnt * n / (nv * ny))), 0.0) AS mi FROM m GROUP BY feature"""


_G3_NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_G3_PAIRS = [(a, b) for i, a in enumerate(_G3_NUMS) for b in _G3_NUMS[i + 1:]]


@register("g3_rank_pairs", f"""
WITH s AS ({_binned_mi_sql(MIX_SQL, {f'{a}_x_{b}': f'{a} * {b}' for a, b in _G3_PAIRS}, 'is_returned')})
SELECT feature_1, feature_2, {r('mi')} AS mi FROM s JOIN (VALUES {", ".join(f"('{a}_x_{b}', '{a}', '{b}')" for a, b in _G3_PAIRS)})
  AS p(feature, feature_1, feature_2) USING (feature) ORDER BY mi DESC, feature LIMIT 3""")
def rank_pairs_q(spark, sf_dir):
    """The 3 of 6 pair products with the highest binned MI with the target."""
    ranked = G.rank_interaction_pairs(mix(spark, sf_dir), _G3_NUMS, "is_returned", 3)
    return ranked.select("feature_1", "feature_2", R("mi").alias("mi"))


@register("g4_polynomial", """
SELECT l_orderkey, l_linenumber, l_quantity * l_quantity AS l_quantity_pow2, pow(l_quantity, 3.0) AS l_quantity_pow3,
  l_linenumber * l_linenumber AS l_linenumber_pow2, pow(CAST(l_linenumber AS DOUBLE), 3.0) AS l_linenumber_pow3
FROM lineitem""")
def polynomial_q(spark, sf_dir):
    """Powers 2..3."""
    li = T(spark, sf_dir, "lineitem")
    return G.add_polynomials(li, ["l_quantity", "l_linenumber"], 3).select(
        "l_orderkey", "l_linenumber", "l_quantity_pow2", "l_quantity_pow3", "l_linenumber_pow2", "l_linenumber_pow3")


def _bins_sql(cols, n=5):
    sel = []
    for c in cols:
        e = f"e_{c}"
        sel.append(f"""CASE WHEN {c} > {e}[1] AND {c} <= {e}[{n + 1}]
  THEN CAST(len(list_filter({e}[2:{n}], lambda q: {c} > q)) AS DOUBLE) END AS {c}_binned""")
    edges = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        edges.append(f"""(SELECT list_transform(range({n + 1}), lambda k: CASE WHEN k = 0 THEN k * ((hi - lo) / {n}) + lo - (hi - lo) * 0.001
                                         WHEN k = {n} THEN hi ELSE k * ((hi - lo) / {n}) + lo END)
   FROM (SELECT min({x}) AS lo, max({x}) AS hi FROM lineitem)) AS e_{c}""")
    return f"SELECT l_orderkey, l_linenumber, {', '.join(sel)} FROM lineitem, (SELECT {', '.join(edges)})"


@register("g5_binning", _bins_sql(["l_extendedprice", "l_quantity"]))
def binning_q(spark, sf_dir):
    """Five equal-width right-closed bins per column."""
    li = T(spark, sf_dir, "lineitem")
    return G.add_bins(li, ["l_extendedprice", "l_quantity"], 5).select(
        "l_orderkey", "l_linenumber", "l_extendedprice_binned", "l_quantity_binned")


@register("g6_group_aggregates", f"""
WITH g AS (SELECT o_custkey, avg(o_totalprice) AS m, coalesce(stddev_samp(o_totalprice), 0.0) AS s
           FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1)
SELECT o_orderkey, {r('g.m', 6)} AS o_custkey_o_totalprice_mean, {r('coalesce(g.s, 0.0)', 4)} AS o_custkey_o_totalprice_std
FROM orders LEFT JOIN g USING (o_custkey)""")
def group_agg_q(spark, sf_dir):
    """Group mean and sd of each row's group (sd of one row → 0)."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = G.add_group_aggregates(o, ["o_custkey"], ["o_totalprice"])
    return out.select("o_orderkey", R("o_custkey_o_totalprice_mean", 6).alias("o_custkey_o_totalprice_mean"),
                      R("o_custkey_o_totalprice_std", 4).alias("o_custkey_o_totalprice_std"))


@register("g7_group_fit_apply", f"""
WITH g AS (SELECT o_custkey, avg(o_totalprice) AS m, coalesce(stddev_samp(o_totalprice), 0.0) AS s
           FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL GROUP BY 1)
SELECT o_orderkey, {r('g.m', 6)} AS o_custkey_o_totalprice_mean, {r('coalesce(g.s, 0.0)', 4)} AS o_custkey_o_totalprice_std
FROM orders LEFT JOIN g USING (o_custkey)""")
def group_fit_apply_q(spark, sf_dir):
    """Statistics fitted on the 'F' orders, applied to all (unseen group → NULL mean, 0 sd)."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    stats = G.fit_group_aggregates(o.where(F.col("o_orderstatus") == "F"), "o_custkey", ["o_totalprice"])
    out = G.apply_group_aggregates(o, "o_custkey", stats)
    return out.select("o_orderkey", R("o_custkey_o_totalprice_mean", 6).alias("o_custkey_o_totalprice_mean"),
                      R("o_custkey_o_totalprice_std", 4).alias("o_custkey_o_totalprice_std"))


_G8_CONFIG = {"feature_engineering": {
    "interactions": True, "max_interaction_pairs": 3, "polynomial": True, "polynomial_degree": 2,
    "binning": True, "bin_numeric_cols": ["l_quantity"], "n_bins": 5,
    "aggregations": True, "aggregation_groupby": ["l_linenumber"], "aggregation_targets": ["l_extendedprice"]}}
# l_suppkey is left out: at the smallest scale it has <= 20 values and types as categorical
_G8_NUMS = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"]


def _g8_sql():
    pairs = [(a, b) for i, a in enumerate(_G8_NUMS) for b in _G8_NUMS[i + 1:]][:3]
    inter = [f"{a} * {b} AS {a}_x_{b}" for a, b in pairs]
    poly = [f"{c} * {c} AS {c}_pow2" for c in _G8_NUMS]
    x = "CAST(l_quantity AS DOUBLE)"
    binned = (f"CASE WHEN {x} > e[1] AND {x} <= e[6] THEN CAST(len(list_filter(e[2:5], lambda q: {x} > q)) AS DOUBLE) END "
              f"AS l_quantity_binned")
    edges = (f"(SELECT list_transform(range(6), lambda k: CASE WHEN k = 0 THEN k * ((hi - lo) / 5) + lo - (hi - lo) * 0.001 "
             f"WHEN k = 5 THEN hi ELSE k * ((hi - lo) / 5) + lo END) AS e FROM (SELECT min({x}) AS lo, max({x}) AS hi FROM lineitem))")
    return f"""
WITH g AS (SELECT l_linenumber, avg(l_extendedprice) AS m, coalesce(stddev_samp(l_extendedprice), 0.0) AS s
           FROM lineitem WHERE l_linenumber IS NOT NULL GROUP BY 1)
SELECT l_orderkey, l_linenumber, {', '.join(inter)}, {', '.join(poly)}, {binned},
  {r('g.m', 6)} AS l_linenumber_l_extendedprice_mean, {r('coalesce(g.s, 0.0)', 4)} AS l_linenumber_l_extendedprice_std
FROM lineitem LEFT JOIN g USING (l_linenumber), {edges}"""


@register("g1_g8_feature_engineering", _g8_sql())
def feature_engineering_q(spark, sf_dir):
    """Typed numeric columns, then interactions → powers → bins → group statistics, by switches."""
    li = T(spark, sf_dir, "lineitem").drop("l_returnflag", "l_suppkey")
    out = G.run_feature_engineering(li, _G8_CONFIG)
    new = [c for c in out.columns if c not in li.columns]
    return out.select("l_orderkey", "l_linenumber", *[
        R(c, 6).alias(c) if c.endswith("_mean") else R(c, 4).alias(c) if c.endswith("_std") else F.col(c)
        for c in new])
