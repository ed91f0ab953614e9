"""The tabular preparation job: fit statistics step by step, then one fused projection.

Order (as the reference): numeric nulls → invalid zeros → outliers → scaling; categorical
nulls → encoding. Numeric statistics take three scans whatever the steps (``plans/profile``), the
scaler a fourth, categorical ones a count of (column, value); ``transform`` is a single chain of projections/filters that Catalyst collapses into
one whole-stage-codegen stage, so applying a fitted job to any volume is a map-only scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..operators import prep
from ..operators.stats import null_counts
from .profile import fit_categories, fit_numeric


@dataclass
class TabularOptions:
    outliers: str = "keep"  # keep | mean | median
    scaling: str = "standardisation"  # standardisation | normalisation
    numeric_nulls: str = "mean"  # drop | mean | median
    categorical_nulls: str = "most"  # drop | most | less
    ordinal: list[str] = field(default_factory=list)
    invalid_zeros: list[str] = field(default_factory=list)
    protect_target: bool = False  # keep the target out of imputation and outlier treatment
    approx_quantiles: bool = False  # medians / quartiles from one percentile_approx pass

    def __post_init__(self):
        checks = {
            "outliers": ("keep", "mean", "median"),
            "scaling": ("standardisation", "normalisation"),
            "numeric_nulls": ("drop", "mean", "median"),
            "categorical_nulls": ("drop", "most", "less"),
        }
        for name, allowed in checks.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")
        if not all(isinstance(v, str) for v in self.ordinal + self.invalid_zeros):
            raise ValueError("ordinal and invalid_zeros must be lists of column names")


class TabularPrep:
    """fit / transform for the tabular job. ``key_columns`` pass through untouched. A categorical column
    of more than ``prep.MAX_LITERAL_LEVELS`` values becomes a sparse one-hot struct (``onehot_sparse``)."""

    def __init__(self, options: TabularOptions | None = None, key_columns: list[str] | None = None, cache_input: bool = True):
        self.options = options or TabularOptions()
        self.key_columns = list(key_columns or [])
        self.cache_input = cache_input
        self.fitted: dict | None = None

    # ------------------------------------------------------------------ fit
    def fit(self, df: DataFrame, target: str) -> "TabularPrep":
        if target not in df.columns:
            raise ValueError(f"target {target!r} is not a column")
        o = self.options
        keys = set(self.key_columns)
        num = [c for c in prep.numeric_columns(df) if c not in keys]
        cat = [c for c in prep.categorical_columns(df) if c not in keys]
        target_numeric = target in num
        protect = {target} if o.protect_target else set()
        num_treat = [c for c in num if c not in protect]
        cat_treat = [c for c in cat if c not in protect]
        missing_zero_cols = [c for c in o.invalid_zeros if c not in num]
        if missing_zero_cols:
            raise ValueError(f"invalid-zero columns not numeric: {missing_zero_cols}")

        # only the columns in use, and never a caller's own cache
        used = df.select(*num, *cat)
        own_cache = self.cache_input and df.storageLevel == StorageLevel.NONE
        src = used.persist(StorageLevel.MEMORY_AND_DISK) if own_cache else used
        f: dict = {"num": num, "cat": cat, "target": target, "target_numeric": target_numeric}
        try:
            cur = src
            if num:
                if o.numeric_nulls == "drop":
                    cur = prep.drop_null_rows(cur, num_treat)
                self._fit_numeric(cur, f, num, num_treat)
                if o.numeric_nulls != "drop":
                    cur = prep.apply_fill(cur, {c: v for c, v in f["num_fill"].items() if c not in f["no_nulls"]})
                cur = prep.apply_zero_replace(cur, f["zero_med"])
                cur = prep.apply_outliers(cur, f["fences"])
                scale_cols = [c for c in num if c != target]
                f["scaler"] = prep.fit_scaler(cur, scale_cols, o.scaling)
                cur = prep.apply_scaler(cur, f["scaler"])
            if cat:
                if o.categorical_nulls == "drop":
                    cur = prep.drop_null_rows(cur, cat_treat)
                f["cat_fill"], f["levels"] = fit_categories(cur, cat, cat_treat, o.categorical_nulls)
                cur = prep.apply_categorical_fill(cur, f["cat_fill"])
                for c in cat:
                    if f["levels"][c] is None:
                        f["levels"][c] = prep.level_codes(cur, c).checkpoint()  # a code table in the shared folder
        finally:
            if own_cache:
                src.unpersist()
        self.fitted = f
        return self

    def _fit_numeric(self, cur: DataFrame, f: dict, num: list[str], treated: list[str]) -> None:
        """Fills, zero medians and fences: all at once, or step after step for approximate quantiles."""
        o = self.options
        if not o.approx_quantiles:
            fill = "none" if o.numeric_nulls == "drop" else o.numeric_nulls
            f["num_fill"], f["zero_med"], f["fences"], found = fit_numeric(cur, num, treated, fill, o.invalid_zeros, o.outliers)
            f["no_nulls"] = [c for c in treated if not found[c]]
            return
        f["num_fill"] = {}
        if o.numeric_nulls != "drop":
            # every column gets a fill value: nulls may first come at transform
            f["num_fill"] = prep.fit_numeric_fill(cur, treated, o.numeric_nulls, None, True)
            found = null_counts(cur, treated)
            f["no_nulls"] = [c for c in treated if not found.get(c)]
            cur = prep.apply_fill(cur, {c: v for c, v in f["num_fill"].items() if found.get(c)})
        f["zero_med"] = prep.fit_zero_medians(cur, o.invalid_zeros, True) if o.invalid_zeros else {}
        f["fences"] = prep.fit_outliers(prep.apply_zero_replace(cur, f["zero_med"]), treated, o.outliers, True)

    # ------------------------------------------------------------------ transform
    def transform(self, df: DataFrame) -> DataFrame:
        if self.fitted is None:
            raise RuntimeError("fit first")
        o, f = self.options, self.fitted
        target = f["target"]
        protect = {target} if o.protect_target else set()
        cur = df
        if f["num"]:
            if o.numeric_nulls == "drop":
                cur = prep.drop_null_rows(cur, [c for c in f["num"] if c not in protect])
            else:
                cur = prep.apply_fill(cur, f["num_fill"], keep_type=f["no_nulls"])
            cur = prep.apply_zero_replace(cur, f["zero_med"])
            cur = prep.apply_outliers(cur, f["fences"])
            cur = prep.apply_scaler(cur, f["scaler"])
        if f["cat"]:
            if o.categorical_nulls == "drop":
                cur = prep.drop_null_rows(cur, [c for c in f["cat"] if c not in protect])
            else:
                cur = prep.apply_categorical_fill(cur, f["cat_fill"])
            for c in f["cat"]:
                if c == target or c in o.ordinal:
                    cur = prep.label_encode(cur, c, out=c, levels=f["levels"][c])
                    if c in o.ordinal:
                        cur = cur.withColumn(c, cur[c].cast("double"))
            onehot = [c for c in f["cat"] if c != target and c not in o.ordinal]
            wide = [c for c in onehot if not isinstance(f["levels"][c], list)]
            cur = prep.onehot_sparse(cur, wide, f["levels"])
            cur = prep.onehot_encode(cur, [c for c in onehot if c not in wide], f["levels"])
        return cur

    def fit_transform(self, df: DataFrame, target: str) -> DataFrame:
        return self.fit(df, target).transform(df)

    def split(self, prepared: DataFrame, id_col: str, test_size: float = 0.2, stratify: bool = True,
              seed: int | None = 42) -> DataFrame:
        """Train / test sets of a prepared table (``set`` column), stratified on the target."""
        from ..operators.splits import stratified_split

        if self.fitted is None:
            raise RuntimeError("fit first")
        return stratified_split(prepared, self.fitted["target"], id_col, test_size, seed, stratify)
