"""Leakage-free preprocessing: fit and apply.

Fitting is a handful of aggregations that return a small parameter dict
(JSON-serialisable: medians, modes, category lists, scaler constants, the
datetime reference, the selected feature list). Applying is one projection of
built-in expressions with those parameters as literals, so a fitted pipeline
is lazy, codegen-friendly and also works on a streaming DataFrame.

Fit jobs: feature typing (one wide aggregation, exact counts of few-valued columns), one parameter aggregation, one small
aggregation for scalers of ordinal codes (only when ordinal columns exist),
and the selection statistics (only when selection is configured).
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import kind_of, md5_mod, safe_timestamp
from .profile import feature_type_map, typed_columns

# Up to this many distinct values a column's quantiles come from ``percentile``
# inside the one-pass parameter aggregation (its buffer holds one entry per
# distinct value); above it they come from the distributed exact quantiles.
EXACT_MAP_MAX_DISTINCT = 10_000
APPROX_ACCURACY = 1_000_000
DATETIME_PARTS = ["year", "month", "day", "dayofweek", "is_weekend", "hour", "minute", "second"]


def qcol(name: str) -> Column:
    """Column reference that tolerates dots and spaces in generated names."""
    return F.col("`" + name.replace("`", "``") + "`")


def _py(v):
    """Plain JSON-friendly Python value."""
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return v


def _quantiles(x: Column, probs, exact: bool) -> Column:
    if exact:
        return F.percentile(x, F.array(*[F.lit(float(p)) for p in probs]))
    return F.percentile_approx(x, [float(p) for p in probs], APPROX_ACCURACY)


def part_names(part: dict) -> list[str]:
    """Names of the features that one entry of ``FeaturePipeline.coded`` stands for."""
    c = part["column"]
    if part["kind"] == "value":
        return [c]
    return [f"{c}__{v}" for v in part["levels"]] if part["kind"] == "onehot" else [f"{c}__hash_{j}" for j in range(part["size"])]


class NotFittedError(RuntimeError):
    pass


class FeaturePipeline:
    """Typing → datetime → imputers → encoders → scalers → selection.

    ``config`` keys (all optional): ``scaler`` (standard | minmax | robust),
    ``hashing_dim`` (32), ``feature_selection`` ({variance_threshold,
    correlation_threshold, protected_features, selected_features}),
    ``feature_type_overrides`` ({ordinal, nominal}), ``low_cardinality_threshold``,
    ``datetime_formats``, ``datetime_missing_fill`` (-1; None keeps NULL parts),
    ``quantiles`` ('auto' | 'exact' | 'approx').
    """

    def __init__(self, config: dict | None = None):
        self.config = dict(config or {})
        self.state: dict | None = None

    # ------------------------------------------------------------------ fit
    @property
    def fitted(self) -> bool:
        return self.state is not None

    def fit(self, df: DataFrame, target: str | None = None) -> "FeaturePipeline":
        cfg = self.config
        features = [c for c in df.columns if c != target and kind_of(df.schema[c].dataType) != "other"]
        types_df = typed_columns(df, target=target, config=cfg, columns=features)
        type_rows = types_df.select("position", "column_name", "feature_type", "n_unique", "kind").collect()
        ftypes = {k: [] for k in ("numeric", "binary", "categorical", "high_cardinality", "datetime", "ordinal")}
        n_unique = {}
        for r in sorted(type_rows, key=lambda r: r["position"]):
            ftypes[r["feature_type"]].append(r["column_name"])
            n_unique[r["column_name"]] = r["n_unique"]
        state = {"feature_types": ftypes, "input_columns": features}
        state.update(self._fit_parameters(df, ftypes, n_unique))
        self.state = state
        state["selected_features"] = None
        # names only: a wide hash has as many names as buckets, but no frame of so many columns is planned
        state["output_features"] = names = [n for part in self.coded(df)[1] for n in part_names(part)]
        wanted = cfg.get("feature_selection")
        if wanted is not None and wanted.get("selected_features") is not None:
            have = set(names)
            state["selected_features"] = [c for c in wanted["selected_features"] if c in have]
        elif wanted is not None:
            full = self._transform_no_selection(df)
            state["selected_features"] = self._fit_selection(full.select(*[qcol(c) for c in names]))
        return self

    def _quantile_mode(self, col: str, n_unique: dict) -> str:
        """'map' (one-pass percentile), 'distributed' (exact, no big buffer) or 'approx'."""
        mode = self.config.get("quantiles", "auto")
        if mode == "approx":
            return "approx"
        if (n_unique.get(col) or 0) <= EXACT_MAP_MAX_DISTINCT:
            return "map"
        return "distributed"

    def _q(self, col: str, x, probs, n_unique: dict, deferred: dict):
        """Quantile expression for the one-pass aggregation, or a deferred
        distributed computation (returns None)."""
        m = self._quantile_mode(col, n_unique)
        if m == "distributed":
            deferred.setdefault(col, set()).update(probs)
            return None
        return _quantiles(x, probs, m == "map")

    def _fit_parameters(self, df: DataFrame, ft: dict, n_unique: dict) -> dict:
        """F1-F3, F5, F6, F10-F12, F15 in one aggregation."""
        cfg = self.config
        scaler = cfg.get("scaler", "standard")
        aggs, keys = [], []

        def add(name, expr):
            keys.append(name)
            aggs.append(expr.alias(f"a{len(keys) - 1}"))

        deferred: dict = {}
        for c in ft["numeric"] + ft["ordinal"] + ft["binary"]:
            x = qcol(c).cast("double")
            q = self._q(c, x, [0.5], n_unique, deferred)
            if q is not None:
                add(("median", c), q[0])
        for c in ft["categorical"]:
            # categorical columns have at most low_cardinality values: bounded
            add(("mode", c), F.mode(qcol(c), deterministic=True))
            add(("cats", c), F.array_sort(F.collect_set(qcol(c))))
        for c in ft["ordinal"]:
            add(("levels", c), F.array_sort(F.collect_set(qcol(c).cast("double"))))
        for c in ft["datetime"]:
            add(("dtmin", c), F.min(self._parsed(df, c)))
        for c in ft["numeric"]:
            x = qcol(c).cast("double")
            if scaler == "standard":
                add(("mean", c), F.avg(x))
                add(("std", c), F.stddev_samp(x))
            elif scaler == "minmax":
                add(("min", c), F.min(x))
                add(("max", c), F.max(x))
            elif scaler == "robust":
                q = self._q(c, x, [0.25, 0.5, 0.75], n_unique, deferred)
                if q is not None:
                    add(("q", c), q)
            else:
                raise ValueError(f"Unknown scaler: {scaler}")
        vals = {}
        if aggs:
            row = df.agg(*aggs).collect()[0]
            vals = {k: row[f"a{i}"] for i, k in enumerate(keys)}
        if deferred:
            from .quantiles import quantile_arrays
            probs = sorted({p for ps in deferred.values() for p in ps})
            qa = quantile_arrays(df, list(deferred), probs)
            for c, arr in qa.items():
                at = dict(zip(probs, arr))
                if 0.5 in at:
                    vals[("median", c)] = at[0.5]
                if 0.25 in at:
                    vals[("q", c)] = [at[0.25], at[0.5], at[0.75]]

        imputers, encoders, ordinal, scalers, dt_ref = {}, {}, {}, {}, {}
        for c in ft["numeric"] + ft["ordinal"] + ft["binary"]:
            imputers[c] = ["median", vals[("median", c)]]
        for c in ft["categorical"]:
            m = vals[("mode", c)]
            imputers[c] = ["mode", _py(m) if m is not None else "missing"]
            encoders[c] = ["onehot", [_py(v) for v in vals[("cats", c)]]]
        for c in ft["high_cardinality"]:
            imputers[c] = ["missing_token", "missing"]
            encoders[c] = ["hashing", int(cfg.get("hashing_dim", 32))]
        for c in ft["ordinal"]:
            ordinal[c] = list(vals[("levels", c)])
        for c in ft["datetime"]:
            v = vals[("dtmin", c)]
            dt_ref[c] = _py(v) if v is not None else None

        def nz(v):  # constant column → 1.0, as the reference does
            return 1.0 if (v is None or v == 0 or (isinstance(v, float) and math.isnan(v))) else v

        for c in ft["numeric"]:
            if scaler == "standard":
                scalers[c] = ["standard", vals[("mean", c)], nz(vals[("std", c)])]
            elif scaler == "minmax":
                lo, hi = vals[("min", c)], vals[("max", c)]
                scalers[c] = ["minmax", lo, nz(None if lo is None or hi is None else hi - lo)]
            else:
                q = vals[("q", c)] or [None, None, None]
                scalers[c] = ["robust", q[1], nz(None if q[0] is None else q[2] - q[0])]
        if ft["ordinal"]:
            scalers.update(self._fit_ordinal_scalers(df, ordinal, scaler))
        return {"imputers": imputers, "encoders": encoders, "ordinal_encoders": ordinal,
                "scalers": scalers, "datetime_reference": dt_ref}

    def _fit_ordinal_scalers(self, df: DataFrame, ordinal: dict, scaler: str) -> dict:
        """Scalers of ordinal columns are fitted on their 0-based codes (decision Q1)."""
        aggs, keys = [], []
        for c, levels in ordinal.items():
            code = self._ordinal_code(qcol(c), levels)
            code = F.when(qcol(c).isNotNull(), code)
            if scaler == "standard":
                keys.append(c)
                aggs += [F.avg(code).alias(f"m{len(keys)}"), F.stddev_samp(code).alias(f"s{len(keys)}")]
            elif scaler == "minmax":
                keys.append(c)
                aggs += [F.min(code).alias(f"m{len(keys)}"), F.max(code).alias(f"s{len(keys)}")]
            else:
                keys.append(c)
                aggs += [F.percentile(code, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"m{len(keys)}"),
                         F.lit(None).alias(f"s{len(keys)}")]
        row = df.agg(*aggs).collect()[0]
        out = {}
        for i, c in enumerate(keys, start=1):
            a, b = row[f"m{i}"], row[f"s{i}"]
            if scaler == "standard":
                out[c] = ["standard", a, b if b not in (None, 0) and not (isinstance(b, float) and math.isnan(b)) else 1.0]
            elif scaler == "minmax":
                rng = None if a is None else b - a
                out[c] = ["minmax", a, rng if rng else 1.0]
            else:
                q = a or [None, None, None]
                iqr = None if q[0] is None else q[2] - q[0]
                out[c] = ["robust", q[1], iqr if iqr else 1.0]
        return out

    def _fit_selection(self, full: DataFrame) -> list[str]:
        """variance filter, then correlation filter."""
        fs = self.config.get("feature_selection") or {}
        cols = list(full.columns)
        vt = fs.get("variance_threshold", 0.0)
        ct = fs.get("correlation_threshold")
        protected = set(fs.get("protected_features", []) or [])
        numeric = [f.name for f in full.schema.fields if kind_of(f.dataType) in ("numeric", "boolean")]
        selected = list(cols)
        if vt and vt > 0.0 and numeric:
            row = full.agg(*[F.var_samp(qcol(c).cast("double")).alias(f"v{i}") for i, c in enumerate(numeric)]).collect()[0]
            drop = {c for i, c in enumerate(numeric) if not (row[f"v{i}"] is not None and row[f"v{i}"] > vt)}
            selected = [c for c in selected if c not in drop]
        if ct is not None:
            among = [c for c in selected if c in set(numeric)]
            kept = set(correlation_filter(full, among, ct, protected)) if len(among) > 1 else set(among)
            selected = [c for c in selected if c in kept or c not in set(among)]
        return selected

    # ------------------------------------------------------------ apply
    def _parsed(self, df: DataFrame, c: str) -> Column:
        k = kind_of(df.schema[c].dataType)
        if k == "datetime":
            return qcol(c).cast("timestamp_ntz") if df.schema[c].dataType.typeName() == "date" else qcol(c)
        return safe_timestamp(qcol(c), self.config.get("datetime_formats")).cast("timestamp_ntz")

    @staticmethod
    def _ordinal_code(x: Column, levels: list) -> Column:
        arr = F.array(*[F.lit(float(v)) for v in levels]) if levels else F.array().cast("array<double>")
        return (F.array_position(arr, x.cast("double")) - 1).cast("int")

    def coded(self, df: DataFrame) -> tuple[DataFrame, list[dict]]:
        """Features with one column per input column, and what each stands for: encoded
        columns hold a position (the level's place or the hash bucket; beyond the last for
        none) instead of one column per level. Other columns of ``df`` follow."""
        out = self._transform_no_selection(df, expand=False)
        st, rest = self.state, set(self.passthrough_columns(df))
        parts = []
        for c in out.columns:
            if c in st["encoders"]:
                kind, levels = st["encoders"][c]
                parts.append({"column": c, "kind": kind, "size": levels if kind == "hashing" else len(levels),
                              **({"levels": levels} if kind == "onehot" else {})})
            elif c not in rest:
                parts.append({"column": c, "kind": "value"})
        return out, parts

    def _transform_no_selection(self, df: DataFrame, expand: bool = True) -> DataFrame:
        if self.state is None:
            raise NotFittedError("this preprocessing has no fitted state yet: call fit() first")
        st = self.state
        ft = st["feature_types"]
        fill = self.config.get("datetime_missing_fill", -1)
        dt_cols = set(ft["datetime"])
        enc_cols = set(st["encoders"])
        features = set(st["input_columns"])
        out: list[Column] = []
        # 1) imputation, ordinal codes and scaling — all in place
        for c in df.columns:
            if c in dt_cols or c in enc_cols or c not in features:
                continue
            x = qcol(c)
            if c in st["imputers"]:
                kind, v = st["imputers"][c]
                if kind == "median":
                    x = F.coalesce(x.cast("double"), F.lit(v).cast("double"))
                else:
                    x = F.coalesce(x, F.lit(v))
            if c in st["ordinal_encoders"]:
                x = self._ordinal_code(x, st["ordinal_encoders"][c])
            if c in st["scalers"]:
                _, a, b = st["scalers"][c]
                x = (x.cast("double") - F.lit(a if a is not None else 0.0)) / F.lit(b)
            out.append(x.alias(c))
        # 2) datetime parts, appended in datetime-column order
        for c in ft["datetime"]:
            out += datetime_features(self._parsed(df, c), c, st["datetime_reference"].get(c), fill)
        # 3) encoders: one-hot then hashing, appended, sources dropped
        for c, (kind, params) in st["encoders"].items():
            imp = st["imputers"].get(c)
            x = qcol(c)
            if imp is not None:
                x = F.coalesce(x, F.lit(imp[1]))
            if expand:
                out += onehot_columns(x, c, params) if kind == "onehot" else hash_columns(x, c, params)
            elif kind == "onehot":
                kind_ = df.schema[c].dataType
                levels = F.array(*[F.lit(v).cast(kind_) for v in params])
                place = F.coalesce(F.array_position(levels, x.cast(kind_)), F.lit(0)) if params else F.lit(0)
                out.append(F.when(place > 0, place - 1).otherwise(len(params)).alias(c))
            else:
                out.append(md5_mod(x.cast("string"), params).alias(c))
        return df.select(*out, *[qcol(c) for c in df.columns if c not in features])

    def passthrough_columns(self, df: DataFrame) -> list[str]:
        """Columns that are not features (target, keys, split/fold): carried unchanged."""
        features = set(self.state["input_columns"])
        return [c for c in df.columns if c not in features]

    def transform(self, df: DataFrame) -> DataFrame:
        """impute → datetime → ordinal → encode → scale → select (one projection).

        Non-feature columns of ``df`` (the target, keys, fold) follow the features.
        """
        out = self._transform_no_selection(df)
        sel = self.state.get("selected_features")
        keep = [qcol(c) for c in self.passthrough_columns(df)]
        if sel is None:
            return out
        have = set(out.columns)
        return out.select(*[qcol(c) if c in have else F.lit(0).alias(c) for c in sel], *keep)

    def feature_names(self) -> list[str]:
        """Output feature columns (after selection when it is configured)."""
        if self.state is None:
            raise NotFittedError("Pipeline must be fitted first.")
        return list(self.state["output_features"] if self.state.get("selected_features") is None
                    else self.state["selected_features"])

    def fit_transform(self, df: DataFrame, target: str | None = None) -> DataFrame:
        """F23."""
        return self.fit(df, target).transform(df)

    # -------------------------------------------------------- persistence
    def to_json(self) -> str:
        return json.dumps({"config": self.config, "state": self.state}, default=str)

    @classmethod
    def from_json(cls, text: str) -> "FeaturePipeline":
        d = json.loads(text)
        p = cls(d["config"])
        p.state = d["state"]
        return p

    def parameter_table(self, spark) -> DataFrame:
        """The fitted pipeline as rows ``(stage, position, name, value)``, values as JSON:
        every part of the state and of the configuration."""
        if self.state is None:
            raise NotFittedError("Pipeline must be fitted first.")
        rows = []
        for stage, part in [*self.state.items(), ("config", self.config)]:
            if isinstance(part, dict):
                rows += [(stage, i, k, json.dumps(v, default=str)) for i, (k, v) in enumerate(part.items())]
            rows.append((stage, -1, None, json.dumps(None if isinstance(part, dict) else part, default=str)))
        return spark.createDataFrame(rows, "stage string, position int, name string, value string")

    @classmethod
    def from_parameter_table(cls, params: DataFrame) -> "FeaturePipeline":
        """The fitted pipeline of ``parameter_table`` rows (their number is bounded by the features)."""
        rows = sorted((r["stage"], r["position"], r["name"], json.loads(r["value"])) for r in params.select(
            "stage", "position", F.coalesce("name", F.lit("")).alias("name"), "value").collect())
        entries = {stage: {} for stage, *_ in rows}
        for stage, position, name, value in rows:
            if position >= 0:
                entries[stage][name] = value
        dicts = {stage for stage, position, _, value in rows if position < 0 and value is None}
        state = {stage: value for stage, position, _, value in rows if position < 0 and value is not None}
        # an empty value marks a dictionary, or a part that was not set
        state.update({s: entries[s] if entries[s] or s != "selected_features" else None for s in dicts})
        p = cls(state.pop("config", {}))
        p.state = {"selected_features": None, **state}
        return p


def datetime_features(ts: Column, name: str, reference=None, fill=-1) -> list[Column]:
    """Missing flag, year, month, day, dayofweek (Monday = 0), is_weekend,
    hour, minute, second and whole days since ``reference`` (floored).

    ``fill`` replaces the parts of a missing timestamp (decision Q3); ``None``
    keeps them NULL.
    """
    out = [ts.isNull().cast("int").alias(f"{name}__missing")]
    parts = {
        "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts),
        "dayofweek": F.weekday(ts),
        "is_weekend": F.coalesce(F.weekday(ts).isin(5, 6), F.lit(False)).cast("int"),
        "hour": F.hour(ts), "minute": F.minute(ts), "second": F.second(ts),
    }
    for p in DATETIME_PARTS:
        e = parts[p]
        if fill is not None and p != "is_weekend":
            e = F.coalesce(e, F.lit(fill))
        out.append(e.alias(f"{name}__{p}"))
    if reference is not None:
        ref = F.lit(str(reference)).cast("timestamp_ntz")
        diff = F.unix_micros(ts.cast("timestamp")) - F.unix_micros(ref.cast("timestamp"))
        days = F.floor(diff / F.lit(86400000000)).cast("long")
        if fill is not None:
            days = F.coalesce(days, F.lit(fill).cast("long"))
        out.append(days.alias(f"{name}__days_since"))
    return out


def onehot_columns(x: Column, name: str, categories) -> list[Column]:
    """F8: ``name__value`` = 1 when equal, else 0 (unseen and NULL → all 0)."""
    return [F.coalesce(x == F.lit(v), F.lit(False)).cast("int").alias(f"{name}__{v}") for v in categories]


def hash_columns(x: Column, name: str, n: int) -> list[Column]:
    """``name__hash_j`` = 1.0 for the bucket ``int(md5(str(x)), 16) % n``."""
    b = md5_mod(x.cast("string"), n)
    return [(b == j).cast("double").alias(f"{name}__hash_{j}") for j in range(n)]


def ordinal_codes(x: Column, levels) -> Column:
    """0-based position in the sorted training levels; unseen → -1."""
    return F.coalesce(FeaturePipeline._ordinal_code(x, list(levels)), F.lit(-1))


def impute(df: DataFrame, values: dict) -> DataFrame:
    """fill NULLs with fitted values; numbers are widened to double (no truncation)."""
    out = []
    for f in df.schema.fields:
        if f.name in values:
            v = values[f.name]
            if isinstance(v, (int, float)) and not isinstance(v, bool):
                out.append(F.coalesce(qcol(f.name).cast("double"), F.lit(float(v))).alias(f.name))
            else:
                out.append(F.coalesce(qcol(f.name), F.lit(v)).alias(f.name))
        else:
            out.append(qcol(f.name))
    return df.select(*out)


def variance_filter(df: DataFrame, cols, threshold: float) -> DataFrame:
    """``(column_name, variance, keep)`` with keep = variance > threshold."""
    one = df.agg(*[F.var_samp(qcol(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)])
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("variance"))
                                          for i, c in enumerate(cols)])).alias("r")).select("r.*")
    return rows.withColumn("keep", F.coalesce(F.col("variance") > threshold, F.lit(False)))


def correlation_filter(df: DataFrame, cols, threshold: float, protected=()) -> list[str]:
    """the columns that stay. Of every pair with |corr| > threshold the later
    column goes, unless it alone is protected: then the earlier one does. Pairs are
    judged on the input, not on what is left of it."""
    from .assoc import correlation_pairs
    place, safe = {c: i for i, c in enumerate(cols)}, set(protected)
    strong = correlation_pairs(df, list(cols)).where((F.abs("corr") > threshold) & ~F.isnan("corr"))
    gone = set()
    for r in strong.select("feature_1", "feature_2").collect():      # at most one row per pair of columns
        earlier, later = sorted((r["feature_1"], r["feature_2"]), key=place.get)
        gone.add(earlier if later in safe and earlier not in safe else later)
    return [c for c in cols if c not in gone]


def fit_imputers(df: DataFrame, numeric=(), categorical=(), high_cardinality=(), exact: bool = True) -> DataFrame:
    """F1-F3 as a table ``(column_name, strategy, value)`` (value as string)."""
    aggs, meta = [], []
    for c in numeric:
        aggs.append(_quantiles(qcol(c).cast("double"), [0.5], exact)[0].cast("string"))
        meta.append((c, "median"))
    for c in categorical:
        aggs.append(F.coalesce(F.mode(qcol(c), deterministic=True).cast("string"), F.lit("missing")))
        meta.append((c, "mode"))
    for c in high_cardinality:
        aggs.append(F.lit("missing"))
        meta.append((c, "missing_token"))
    one = df.agg(*[a.alias(f"v{i}") for i, a in enumerate(aggs)])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(s).alias("strategy"), F.col(f"v{i}").alias("value"))
        for i, (c, s) in enumerate(meta)])).alias("r")).select("r.*")
