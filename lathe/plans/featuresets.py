"""Named, versioned feature sets (I*) and the fit / transform chain (H5, H6).

A ``FeatureSet`` holds a row pipeline (a ``DataFrame -> DataFrame`` function
built from the operators) plus the encoding lists. ``fit`` runs the row
pipeline in train mode, fits target encoders, one-hot categories and the
scaler; ``FittedFeatureSet.transform`` applies the same chain to any table
(train or test mode) as one lazy plan.

Group features of one key are computed with one aggregate + one join each;
keys with few, large groups (deck) use a size-checked broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.functions import columns as col
from lathe.operators import encode as enc
from lathe.operators import groups as grp
from lathe.operators import impute as imp
from lathe.operators.lookup import DEFAULT_BROADCAST_ROWS, bounded_table
from lathe.session import cut_lineage, stored
from lathe.sources.io import load_fit_state, save_fit_state


@dataclass(frozen=True)
class Binding:
    """Column names and domain constants of one entity table."""
    id_col: str = "PassengerId"
    target: str = "Transported"
    spend: tuple[str, ...] = ("RoomService", "FoodCourt", "ShoppingMall", "Spa", "VRDeck")
    categorical_fill: tuple[str, ...] = ("HomePlanet", "CryoSleep", "Destination", "VIP")
    deck_to_planet: tuple[tuple[str, str], ...] = tuple(imp.DECK_TO_PLANET.items())
    group: str = "TravelGroup"


#: Marks the rows that encoders learn from.
TRAINED = "__trained"

Pipeline = Callable[[DataFrame, Binding, bool, "float | None"], DataFrame]


# ------------------------------------------------------------------ pipeline steps
def _cabin_group(df: DataFrame, b: Binding) -> DataFrame:
    return col.split_group_key(col.split_cabin(df), b.id_col, b.group)


def _spending(df: DataFrame, b: Binding) -> DataFrame:
    return col.spend_totals(df, list(b.spend))


def _age_cat(df: DataFrame) -> DataFrame:
    return df.withColumn("AgeCategory", col.age_category("Age"))


def _missing(df: DataFrame, b: Binding, impute_age: bool, age_median: float | None) -> DataFrame:
    """E1 + (E2 in test mode | C1 in train mode)."""
    df = imp.impute_constant(df, list(b.categorical_fill), list(b.spend))
    if impute_age:
        return imp.impute_global_median(df, "Age", median=age_median)
    return imp.drop_null(df, ["Age"])


def _group_size(df: DataFrame, b: Binding) -> DataFrame:
    return grp.group_size(df, b.group)


def _kept_size(impute_age: bool) -> dict:
    """GroupSize as a statistic of all rows: those that stay once null ages are imputed, or dropped."""
    return {"GroupSize": F.count(F.lit(1)) if impute_age else F.count("Age")}


def _size_last(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{x}`") for x in df.columns if x != "GroupSize"], "GroupSize")


def pipeline_fs001(df, b, impute_age=False, age_median=None, group_aggs=None):
    """fs_001 rows; ``group_aggs`` of later sets ride on the same TravelGroup aggregate as GroupSize."""
    df = _age_cat(_spending(_cabin_group(df, b), b))
    rows = _missing(df, b, impute_age, age_median)
    return grp.group_stats(rows, b.group, {"GroupSize": F.count(F.lit(1)), **(group_aggs or {})})


def solo_interactions(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "IsAlone": col.flag(F.col("GroupSize") == 1),
        "IsChild": col.flag(F.col("Age") < 13),
        "SpendingIntensity": col.ratio_plus_one(F.col("TotalSpending"), F.col("SpendingCategories")),
    })


def pipeline_fs003(df, b, impute_age=False, age_median=None):
    return solo_interactions(pipeline_fs001(df, b, impute_age, age_median))


def structural_aggs() -> dict:
    """Group statistics of fs_005 (D4, D5, D6) on the TravelGroup aggregate."""
    return {"__g_mean": F.avg("TotalSpending"), "__g_std": grp.std_or_zero(F.col("TotalSpending")),
            "__g_cryo": F.avg(grp.cryo_int()), "GroupAgeDispersion": grp.std_or_zero(F.col("Age"))}


def structural_context(df: DataFrame, b: Binding) -> DataFrame:
    """B10, D5, D4, B11 from the group statistics, then D9 and D10 (their own keys)."""
    df = df.withColumns({
        "SpendingEntropy": col.spend_entropy(list(b.spend)),
        "GroupSpendingZScore": (F.col("TotalSpending") - F.col("__g_mean")) / (F.col("__g_std") + F.lit(1.0)),
        "GroupCryoAlignment": grp.group_alignment(F.col("__g_cryo")),
        "SpendingCategoryProfile": col.spend_profile(list(b.spend)),
    }).drop("__g_mean", "__g_std", "__g_cryo")
    df = grp.neighborhood_density(df)
    return grp.name_frequency(df)


def pipeline_fs005(df, b, impute_age=False, age_median=None):
    return structural_context(pipeline_fs001(df, b, impute_age, age_median, structural_aggs()), b)


def cryo_spending_aggs() -> dict:
    return {"GroupTransportedProxy": F.avg((F.coalesce(F.col("TotalSpending"), F.lit(0.0)) == 0).cast("int"))}


def cryo_spending(df: DataFrame, b: Binding) -> DataFrame:
    df = df.withColumn("CryoSpendingAnomaly", grp.cryo_int() * F.coalesce(F.col("TotalSpending"), F.lit(0.0)))
    df = grp.side_spending_diff(df)
    return df.withColumn("CryoSleepBinary", col.tri_state("CryoSleep", -1))


def pipeline_fs010(df, b, impute_age=False, age_median=None):
    return cryo_spending(pipeline_fs001(df, b, impute_age, age_median, cryo_spending_aggs()), b)


def child_aggs() -> dict:
    is_child = col.flag(F.col("Age") < 13)
    return {"GroupHasChild": F.max(is_child).cast("int"), "GroupChildRate": F.avg(is_child)}


def child_route(df: DataFrame, b: Binding, sep: str = "_") -> DataFrame:
    return df.withColumns({"IsChild": col.flag(F.col("Age") < 13), "Route": col.route(sep=sep)})


def pipeline_fs011(df, b, impute_age=False, age_median=None):
    return child_route(pipeline_fs001(df, b, impute_age, age_median, child_aggs()), b)


def pipeline_fs013(df, b, impute_age=False, age_median=None):
    """E3 and D3 + D7 share one aggregate over all rows; GroupSize is recounted after the drop."""
    df = _spending(_cabin_group(df, b), b).withColumn("__raw", col.total(list(b.spend)))
    df = grp.group_stats(df, b.group, {"__gmed": F.median("Age"),
                                       "GroupAllCryo": F.min(grp.cryo_int()).cast("int"),
                                       "GroupAnyCryo": F.max(grp.cryo_int()).cast("int"),
                                       "__gsum": F.sum("__raw")})
    df = df.withColumn("Age", F.coalesce(F.col("Age"), F.col("__gmed")))
    df = _age_cat(df).withColumns({
        "SpendShare": F.col("__raw") / (F.col("__gsum") + F.lit(1.0)),
        "GroupSpendOthers_Log": F.log1p(F.greatest(F.col("__gsum") - F.col("__raw"), F.lit(0.0))),
    }).drop("__raw", "__gsum", "__gmed")
    return _group_size(_missing(df, b, impute_age, age_median), b)


def group_spending_aggs() -> dict:
    return {"GroupCryoSleepRate": F.avg(grp.cryo_int()), "GroupSpendingMean": F.avg("TotalSpending")}


def group_spending(df: DataFrame, b: Binding) -> DataFrame:
    """fs-002 extras: Route, violation, luxury ratio, deck position (group stats ride on GroupSize)."""
    lux = col.zero_if_null("Spa") + col.zero_if_null("VRDeck")
    df = df.withColumns({
        "Route": col.route(sep="_to_"),
        "CryoSleepViolation": col.flag(col.is_true("CryoSleep") & (col.total(list(b.spend)) > 0)),
        "LuxurySpendingRatio": col.ratio_plus_one(lux, F.col("TotalSpending")),
    })
    return grp.minmax_position(df)


def pipeline_fs002(df, b, impute_age=False, age_median=None):
    return group_spending(pipeline_fs001(df, b, impute_age, age_median, group_spending_aggs()), b)


def pipeline_fs006(df, b, impute_age=False, age_median=None):
    df = _age_cat(_cabin_group(df, b))
    df = imp.impute_constant(df, list(b.categorical_fill), [])
    df = imp.impute_spend_group_aware(df, list(b.spend), b.group, extra=_kept_size(impute_age))
    df = _spending(df, b)
    return _size_last(imp.impute_global_median(df, "Age", median=age_median) if impute_age else imp.drop_null(df, ["Age"]))


def pipeline_fs007(df, b, impute_age=False, age_median=None):
    df = _cabin_group(df, b)
    df = imp.apply_domain_rules(df, list(b.spend), b.group, b.id_col, deck_to_planet=dict(b.deck_to_planet),
                                extra=_kept_size(impute_age))
    df = _missing(_age_cat(df), b, impute_age, age_median)
    return _size_last(_spending(df, b))


def pipeline_fs009(df, b, impute_age=False, age_median=None):
    df = _cabin_group(df, b)
    df = imp.apply_domain_rules(df, list(b.spend), b.group, b.id_col, deck_to_planet=dict(b.deck_to_planet),
                                extra=_kept_size(impute_age))
    df = _spending(_missing(_age_cat(df), b, impute_age, age_median), b)
    return _size_last(grp.minmax_position(df))


# ------------------------------------------------------------------ feature set + fit state
@dataclass(frozen=True)
class FeatureSet:
    name: str
    description: str
    pipeline: Pipeline
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    drop: tuple[str, ...]
    target_encode: tuple[str, ...] = ()
    parent: str | None = None
    deprecated: bool = False

    def rows(self, df: DataFrame, b: Binding, train: bool = True, age_median: float | None = None) -> DataFrame:
        return self.pipeline(col.nan_to_null(df), b, not train, age_median)

    def fit(self, df: DataFrame, b: Binding = Binding(), train_ids: DataFrame | None = None) -> "FittedFeatureSet":
        """Fit encoders and scaler on the train-mode rows.

        Row features see all of ``df``; with ``train_ids`` (one id column) encoders, scaler and the
        age median learn from those rows only, so held-out labels never reach a feature.

        The rows feed several passes (category statistics, age median, scaler): the row
        pipeline runs once and its rows are written to ``spark.checkpoint.dir``; ``train_matrix`` reads
        them too. The category
        statistics of all columns are one aggregate, kept locally if small, else written too.
        """
        whole = _label_encode(self.rows(df, b, train=True))
        read = {b.id_col, b.target, *self.target_encode, *self.categorical}
        whole = col.drop_if_present(whole, [x for x in (*self.drop, "CryoSleep", "Side") if x not in read])     # no later step reads them
        if train_ids is None:
            rows = whole = stored(whole, f"rows-{self.name}")
        else:
            known = train_ids.select(b.id_col).distinct().withColumn(TRAINED, F.lit(True))
            whole = stored(whole.join(known, on=b.id_col, how="left"), f"rows-{self.name}")
            rows, whole = whole.where(TRAINED).drop(TRAINED), whole.drop(TRAINED)
        stat_cols = list(dict.fromkeys([*self.target_encode, *self.categorical]))
        stats = enc.category_stats(rows, stat_cols, b.target) if stat_cols else None
        if stats is not None:
            stats = cut_lineage(stats)
            small = bounded_table(stats, DEFAULT_BROADCAST_ROWS)
            stats = stats if small is None else small
        tes = {x: enc.fit_target_encoding(stats, x) for x in self.target_encode}
        ohe = enc.one_hot_fit(stats, list(self.categorical)) if self.categorical else {}
        age_median = imp.global_medians(rows, ["Age"])["Age"] if "Age" in rows.columns else None
        fitted = FittedFeatureSet(self, b, tes, ohe, enc.Scaler({}), [], age_median)
        matrix = fitted._encode(rows, train=True)
        feature_cols = [x for x in matrix.columns if x not in (b.id_col, b.target)]
        scaler = enc.standard_scale_fit(matrix, [x for x in self.numeric if x in matrix.columns])
        return FittedFeatureSet(self, b, tes, ohe, scaler, feature_cols, fitted.age_median, whole)


def _label_encode(df: DataFrame) -> DataFrame:
    return df.withColumns({"CryoSleep_Encoded": col.tri_state("CryoSleep", -1),
                           "Side_Encoded": col.side_code("Side")})


@dataclass(frozen=True)
class FittedFeatureSet:
    fs: FeatureSet
    binding: Binding
    target_encoders: dict[str, enc.TargetEncoding]
    one_hot: dict[str, list[str]]
    scaler: enc.Scaler
    feature_cols: list[str] = field(default_factory=list)
    age_median: float | None = None
    train_rows: DataFrame | None = field(default=None, compare=False, repr=False)      # of all rows given to ``fit``

    def _encode(self, rows: DataFrame, train: bool, fill_unseen: bool | None = None) -> DataFrame:
        b = self.binding
        df = rows
        for x, te in self.target_encoders.items():
            df = te.apply(df, f"{x}_TE", fill_unseen=not train if fill_unseen is None else fill_unseen)
        df = enc.one_hot_apply(df, self.one_hot)
        drop = [x for x in (*self.fs.drop, "CryoSleep", "Side", *self.fs.target_encode) if x != b.id_col]
        df = col.drop_if_present(df, drop)
        return col.bool_to_int(df.withColumn(b.target, F.col(b.target).cast("int")) if b.target in df.columns else df)

    def transform(self, df: DataFrame, train: bool = False, test_median: str = "fitted",
                  scaled: bool = True, fill_unseen: bool | None = None) -> DataFrame:
        """Feature matrix with ``id`` (and the target when present) in front.

        ``fill_unseen`` gives categories the encoders never saw the mean of means (default: in test mode).

        ``train=True`` replays the training path (null ages dropped).
        Test mode imputes Age with the fitted train median (``test_median="self"``
        uses the median of ``df`` itself, as the reference does).
        """
        med = None if test_median == "self" else self.age_median
        return self._matrix(_label_encode(self.fs.rows(df, self.binding, train=train, age_median=med)), train, scaled, fill_unseen)

    def train_matrix(self, scaled: bool = True, fill_unseen: bool | None = None) -> DataFrame:
        """``transform(df, train=True)`` of the table given to ``fit``, from the rows that ``fit`` wrote."""
        return self._matrix(self.train_rows, True, scaled, fill_unseen)

    def _matrix(self, rows: DataFrame, train: bool, scaled: bool, fill_unseen: bool | None) -> DataFrame:
        b = self.binding
        matrix = self._encode(rows, train=train, fill_unseen=fill_unseen)
        keep = [b.id_col] + ([b.target] if b.target in matrix.columns else [])
        out = col.align_schema(matrix, self.feature_cols, keep=keep)
        return self.scaler.apply(out) if scaled else out

    def state(self, spark: SparkSession) -> DataFrame:
        """The fitted state as one table (kind, name, item, value): scaler means and scales, target encodings and the value
        of unseen categories, one-hot categories, the age median, the number of features."""
        rows = [("scaler", x, k, v) for x, (mean, scale) in self.scaler.stats.items() for k, v in (("mean", mean), ("scale", scale))]
        rows += [("unseen", x, "", te.default) for x, te in self.target_encoders.items()]
        rows += [("one_hot", x, v, 1.0) for x, values in self.one_hot.items() for v in values]
        rows += [("median", "Age", "", self.age_median), ("features", "all", "", float(len(self.feature_cols)))]
        out = spark.createDataFrame(rows, "kind string, name string, item string, value double")
        for x, te in self.target_encoders.items():
            out = out.unionByName(te.table.select(F.lit("target_encoding").alias("kind"), F.lit(x).alias("name"),
                                                  F.col("value").alias("item"), F.col("mean").alias("value")))
        return out

    def save(self, spark: SparkSession, root: str) -> str:
        """Write the fitted state: one table per target encoder and one metadata row."""
        meta = {"feature_set": self.fs.name, "binding": asdict(self.binding), "one_hot": self.one_hot,
                "scaler": self.scaler.stats, "feature_cols": self.feature_cols, "age_median": self.age_median,
                "encoders": {x: te.default for x, te in self.target_encoders.items()}}
        tables = {f"te_{i}": te.table for i, te in enumerate(self.target_encoders.values())}
        return save_fit_state(tables, meta, root, spark)

    @staticmethod
    def load(spark: SparkSession, root: str) -> "FittedFeatureSet":
        """The fitted state that ``save`` wrote, ready to transform; nothing is fitted again."""
        _, meta = load_fit_state(spark, root, [])
        tables, _ = load_fit_state(spark, root, [f"te_{i}" for i in range(len(meta["encoders"]))])
        encoders = {}
        for (x, default), table in zip(meta["encoders"].items(), tables.values()):
            local = bounded_table(table, DEFAULT_BROADCAST_ROWS)
            encoders[x] = enc.TargetEncoding(x, table if local is None else local, default, local is not None)
        plain = {k: tuple(tuple(v) if isinstance(v, list) else v for v in x) if isinstance(x, list) else x
                 for k, x in meta["binding"].items()}
        scaler = enc.Scaler({x: (mean, scale) for x, (mean, scale) in meta["scaler"].items()})
        return FittedFeatureSet(FEATURE_SETS[meta["feature_set"]], Binding(**plain), encoders, meta["one_hot"], scaler,
                                meta["feature_cols"], meta["age_median"])


# ------------------------------------------------------------------ registry (fixed lists of the reference)
FS001_NUMERIC = ("Age", "RoomService", "FoodCourt", "ShoppingMall", "Spa", "VRDeck",
                 "GroupSize", "CabinNumber", "TotalSpending_Log", "SpendingCategories")
FS001_CATEGORICAL = ("HomePlanet", "Destination", "Deck", "AgeCategory")
FS001_DROP = ("PassengerId", "Name", "Cabin", "TravelGroup", "CryoSleep", "VIP", "Side", "TotalSpending")
FS004_TE = ("Deck", "HomePlanet")
FS004_NUMERIC = FS001_NUMERIC + ("Deck_TE", "HomePlanet_TE")
FS004_CATEGORICAL = ("Destination", "AgeCategory")
FS012_TE = FS004_TE + ("Route",)
FS012_NUMERIC = FS004_NUMERIC + ("IsChild", "GroupHasChild", "GroupChildRate", "Route_TE")

FEATURE_SETS: dict[str, FeatureSet] = {fs.name: fs for fs in [
    FeatureSet("fs_001", "base: cabin parts, group size, spend totals, age category", pipeline_fs001,
               FS001_NUMERIC, FS001_CATEGORICAL, FS001_DROP),
    FeatureSet("fs_003", "fs_001 + IsAlone, IsChild, SpendingIntensity", pipeline_fs003,
               FS001_NUMERIC + ("IsAlone", "IsChild", "SpendingIntensity"), FS001_CATEGORICAL, FS001_DROP,
               parent="fs_001"),
    FeatureSet("fs_004", "fs_001 with Deck and HomePlanet target-encoded", pipeline_fs001,
               FS004_NUMERIC, FS004_CATEGORICAL, FS001_DROP, FS004_TE, parent="fs_001"),
    FeatureSet("fs_005", "fs_001 + 7 structural context features", pipeline_fs005,
               FS001_NUMERIC + ("SpendingEntropy", "GroupSpendingZScore", "CabinNeighborhoodDensity",
                                "FamilySizeFromName", "GroupCryoAlignment", "GroupAgeDispersion",
                                "SpendingCategoryProfile_TE"),
               FS001_CATEGORICAL, FS001_DROP, ("SpendingCategoryProfile",), parent="fs_001"),
    FeatureSet("fs_010", "fs_004 + cryo x spending interactions", pipeline_fs010,
               FS004_NUMERIC + ("CryoSpendingAnomaly", "GroupTransportedProxy", "SideSpendingDiff", "CryoSleepBinary"),
               FS004_CATEGORICAL, FS001_DROP, FS004_TE, parent="fs_004"),
    FeatureSet("fs_011", "fs_004 + child context + Route (one-hot)", pipeline_fs011,
               FS004_NUMERIC + ("IsChild", "GroupHasChild", "GroupChildRate"),
               FS004_CATEGORICAL + ("Route",), FS001_DROP, FS004_TE, parent="fs_004"),
    FeatureSet("fs_012", "fs_011 with Route target-encoded", pipeline_fs011,
               FS012_NUMERIC, FS004_CATEGORICAL, FS001_DROP, FS012_TE, parent="fs_011"),
    FeatureSet("fs_013", "fs_004 + group-median age + collective group features", pipeline_fs013,
               FS004_NUMERIC + ("GroupAllCryo", "GroupAnyCryo", "SpendShare", "GroupSpendOthers_Log"),
               FS004_CATEGORICAL, FS001_DROP, FS004_TE, parent="fs_004"),
    FeatureSet("fs_002", "fs_001 + route, cryo rate, violation, luxury ratio, deck position, group spend",
               pipeline_fs002,
               FS001_NUMERIC + ("GroupCryoSleepRate", "CryoSleepViolation", "LuxurySpendingRatio",
                                "CabinNumber_DeckPercentile", "GroupSpendingMean"),
               FS001_CATEGORICAL + ("Route",), FS001_DROP, parent="fs_001", deprecated=True),
    FeatureSet("fs_006", "fs_001 with group-aware spend imputation", pipeline_fs006,
               FS001_NUMERIC, FS001_CATEGORICAL, FS001_DROP, parent="fs_001", deprecated=True),
    FeatureSet("fs_007", "domain rules + TravelGroup target encoding (leaky)", pipeline_fs007,
               FS001_NUMERIC + ("TravelGroup_TE",), FS001_CATEGORICAL,
               tuple(x for x in FS001_DROP if x != "TravelGroup"), ("TravelGroup",), parent="fs_001",
               deprecated=True),
    FeatureSet("fs_008", "domain rules only", pipeline_fs007,
               FS001_NUMERIC, FS001_CATEGORICAL, FS001_DROP, parent="fs_001", deprecated=True),
    FeatureSet("fs_009", "domain rules + deck position instead of cabin number", pipeline_fs009,
               ("Age", "RoomService", "FoodCourt", "ShoppingMall", "Spa", "VRDeck", "GroupSize",
                "CabinNumber_DeckPercentile", "TotalSpending_Log", "SpendingCategories"),
               FS001_CATEGORICAL, FS001_DROP + ("CabinNumber",), parent="fs_008", deprecated=True),
]}

DEFAULT_FEATURE_SET = "fs_001"
