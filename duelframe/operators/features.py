"""Differential features, fills, rank differences, encoders and selection.

Every per-column expression of the stage is built in Python and emitted in a
single ``select`` so the logical plan stays one flat projection (~80 outputs)
instead of a chain of ``withColumn`` nodes.  The only job this stage triggers
is category discovery (one small distinct aggregation), which is skipped when
an explicit vocabulary is passed.

Wide one-hot columns suit a schema's categories.  A column whose categories
grow with the data is encoded by ``sparse_one_hot``: a category table with
positions, and one (key, position) row per value, without any limit.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe import config as C
from duelframe.functions.exprs import flag_equals
from duelframe.functions.ordering import positions


class SchemaError(ValueError):
    pass


# --- O32 / O33 / O34: numeric derivations ------------------------------------

def present_pairs(columns, pairs: dict) -> dict:
    return {k: v for k, v in pairs.items() if v[0] in columns and v[1] in columns}


def paired_diff_exprs(columns) -> dict[str, Column]:
    """Red - Blue per configured pair whose two columns exist (NULL-propagating)."""
    return {name: (F.col(r) - F.col(b))
            for name, (r, b) in present_pairs(columns, C.PAIRED_STATS).items()}


def neutral_fill(exprs: dict[str, Column]) -> dict[str, Column]:
    """Fill the neutral-zero columns (odds, performance %, EmptyArena) with 0."""
    return {k: (F.coalesce(v, F.lit(0)) if k in C.ZERO_FILL_COLUMNS else v)
            for k, v in exprs.items()}


def rank_diff_exprs(columns) -> dict[str, Column]:
    """Each side filled with the unranked sentinel before subtracting."""
    s = F.lit(C.UNRANKED_SENTINEL)
    return {name: F.coalesce(F.col(r), s) - F.coalesce(F.col(b), s)
            for name, (r, b) in present_pairs(columns, C.RANKING_PAIRS).items()}


def contextual_exprs(columns) -> dict[str, Column]:
    out = {}
    for c in C.CONTEXTUAL_NUMERIC:
        if c in columns:
            e = F.col(c)
            if c == "TitleBout":
                e = e.cast("int")  # boolean travels as 0/1
            out[c] = e
    return neutral_fill(out)


# --- O35: stance matchup -----------------------------------------------------

def stance_matchup_expr() -> Column:
    unk = F.lit(C.STANCE_UNKNOWN)
    # fill before joining: concat of a NULL is NULL
    return F.concat_ws(C.STANCE_JOINER, F.coalesce(F.col("RedStance"), unk),
                       F.coalesce(F.col("BlueStance"), unk))


# --- O43-O48: categorical encoders -------------------------------------------

@dataclass
class Vocabulary:
    """Sorted category lists per encoded column (``None`` = column absent)."""
    stance: list[str] = field(default_factory=list)
    weight_class: list[str] | None = None
    better_rank: list[str] | None = None

    def as_rows(self):
        for group, vals in (("stance_matchup", self.stance),
                            ("WeightClass", self.weight_class),
                            ("BetterRank", self.better_rank)):
            for i, v in enumerate(vals or []):
                yield group, i, v


def _category_source(df: DataFrame) -> DataFrame:
    cols = df.columns
    parts = [F.struct(F.lit("stance_matchup").alias("g"), stance_matchup_expr().alias("v"))]
    if "WeightClass" in cols:
        parts.append(F.struct(F.lit("WeightClass").alias("g"), F.col("WeightClass").alias("v")))
    if "BetterRank" in cols:
        parts.append(F.struct(F.lit("BetterRank").alias("g"), F.col("BetterRank").alias("v")))
    return df.select(F.inline(F.array(*parts))).filter(F.col("v").isNotNull())


def category_table(df: DataFrame) -> DataFrame:
    """(column, category) distinct pairs -- a map-side partial aggregation."""
    return (_category_source(df).groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("g").alias("column_name"), F.col("v").alias("category"),
                    F.col("n").alias("n_rows")))


def discover_vocabulary(df: DataFrame) -> Vocabulary:
    """Distinct non-missing categories, sorted; one small job.

    The lists become columns, so they reach the driver as any schema does;
    for categories that grow with the rows use ``sparse_one_hot``.
    """
    groups = ["stance_matchup"] + [c for c in ("WeightClass", "BetterRank") if c in df.columns]
    found: dict[str, list[str]] = {g: [] for g in groups}
    for r in _category_source(df).select("g", "v").distinct().collect():
        found[r["g"]].append(r["v"])
    for vals in found.values():
        vals.sort()
    return Vocabulary(stance=found["stance_matchup"],
                      weight_class=found.get("WeightClass"),
                      better_rank=found.get("BetterRank"))


def column_names(prefix: str, categories: list[str]) -> list[str]:
    """A column name per category: ``prefix_category``, made safe.

    Dots and backticks, which Spark reads as syntax, become underscores; a
    name that equals an earlier one but for case gets its place appended.
    """
    taken: set[str] = set()
    out = []
    for i, cat in enumerate(categories):
        name = f"{prefix}_{cat}".replace(".", "_").replace("`", "_")
        if name.lower() in taken:
            name = f"{name}__{i}"
        taken.add(name.lower())
        out.append(name)
    return out


def one_hot_exprs(value: Column, prefix: str, categories: list[str]) -> dict[str, Column]:
    """0/1 column per category; a missing value gives all zeros."""
    return {name: flag_equals(value, cat) for name, cat in zip(column_names(prefix, categories), categories)}


def sparse_one_hot(df: DataFrame, value: Column, key: str = "bout_id") -> tuple[DataFrame, DataFrame]:
    """One-hot encoding of a column with any number of categories.

    Returns the category table (category, position in sorted order) and the
    set cells (key, position); a missing value has no cell.
    """
    cells = df.select(F.col(key), value.alias("category")).where(F.col("category").isNotNull())
    categories = positions(cells, "category")
    return categories, cells.join(categories, "category").select(key, "position")


def gender_expr() -> Column:
    return flag_equals(F.col("Gender"), C.GENDER_MALE)


def target_expr() -> Column:
    """1 when Winner is exactly 'Red'; Blue, draws and missing are 0."""
    return flag_equals(F.col(C.TARGET_COLUMN), C.TARGET_POSITIVE)


# --- O13 / O15: the feature stage --------------------------------------------

@dataclass
class FeatureSpec:
    """Ordered feature columns by group, as produced for a given input."""
    existing: list[str]
    paired: list[str]
    ranks: list[str]
    contextual: list[str]
    stance: list[str]
    weight_class: list[str]
    better_rank: list[str]
    other: list[str]
    labels: dict[str, str] = field(default_factory=dict)  # encoded column -> its category's text

    @property
    def columns(self) -> list[str]:
        cols = (self.existing + self.paired + self.ranks + self.contextual + self.stance
                + self.weight_class + self.better_rank + self.other)
        return list(dict.fromkeys(cols))

    @classmethod
    def from_columns(cls, columns: list[str]) -> "FeatureSpec":
        """Groups of an existing feature table, read back from its names."""
        cols = [c for c in columns if c not in REFERENCE_COLUMNS + ["bout_id", "stance_matchup", "year"]]

        def pref(p):
            return [c for c in cols if c.startswith(p + "_") and c not in C.RANKING_PAIRS]
        return cls(existing=[c for c in C.EXISTING_DIFF_COLUMNS if c in cols],
                   paired=[c for c in C.PAIRED_STATS if c in cols],
                   ranks=[c for c in C.RANKING_PAIRS if c in cols],
                   contextual=[c for c in C.CONTEXTUAL_NUMERIC if c in cols],
                   stance=pref(C.STANCE_PREFIX), weight_class=pref(C.WEIGHTCLASS_PREFIX),
                   better_rank=pref(C.BETTERRANK_PREFIX),
                   other=[c for c in cols if c == "is_male"])

    def groups(self) -> dict[str, list[str]]:
        return {"existing_diffs": self.existing, "paired_diffs": self.paired,
                "rank_diffs": self.ranks, "contextual": self.contextual,
                "stance_dummies": self.stance, "weightclass_dummies": self.weight_class,
                "betterrank_dummies": self.better_rank, "other": self.other}


REFERENCE_COLUMNS = ["target", "RedFighter", "BlueFighter", "Date"]


def feature_exprs(df: DataFrame, vocab: Vocabulary) -> tuple[dict[str, Column], FeatureSpec]:
    cols = df.columns
    for required in ("RedStance", "BlueStance", C.TARGET_COLUMN):
        if required not in cols:
            raise SchemaError(f"required column {required!r} not found")
    existing = {c: F.col(c) for c in C.EXISTING_DIFF_COLUMNS if c in cols}
    paired = neutral_fill(paired_diff_exprs(cols))
    ranks = rank_diff_exprs(cols)
    context = contextual_exprs(cols)
    sm = stance_matchup_expr()
    stance = one_hot_exprs(sm, C.STANCE_PREFIX, vocab.stance)
    wc = (one_hot_exprs(F.col("WeightClass"), C.WEIGHTCLASS_PREFIX, vocab.weight_class)
          if vocab.weight_class is not None and "WeightClass" in cols else {})
    br = (one_hot_exprs(F.col("BetterRank"), C.BETTERRANK_PREFIX, vocab.better_rank)
          if vocab.better_rank is not None and "BetterRank" in cols else {})
    other = {"is_male": gender_expr()} if "Gender" in cols else {}
    labels = {name: f"{prefix}_{cat}" for prefix, cats, names in (
        (C.STANCE_PREFIX, vocab.stance, stance), (C.WEIGHTCLASS_PREFIX, vocab.weight_class or [], wc),
        (C.BETTERRANK_PREFIX, vocab.better_rank or [], br)) for name, cat in zip(names, cats)}
    spec = FeatureSpec(list(existing), list(paired), list(ranks), list(context),
                       list(stance), list(wc), list(br), list(other), labels)
    exprs: dict[str, Column] = {}
    for group in (existing, paired, ranks, context, stance, wc, br, other):
        for k, v in group.items():
            exprs.setdefault(k, v)
    return exprs, spec


def feature_matrix(df: DataFrame, vocab: Vocabulary | None = None,
                   key: str = "bout_id") -> tuple[DataFrame, FeatureSpec]:
    """X columns in reference order, then target and the display columns.

    ``stance_matchup`` is kept as a display column, not a feature: dummies
    are selected by the encoder's own list, never by name prefix.
    """
    vocab = vocab or discover_vocabulary(df)
    exprs, spec = feature_exprs(df, vocab)
    out = [v.alias(k) for k, v in exprs.items()]
    out += [target_expr().alias("target")]
    out += [F.col(c) for c in ("RedFighter", "BlueFighter", "Date") if c in df.columns]
    if key in df.columns:
        out.append(F.col(key))
    out.append(stance_matchup_expr().alias("stance_matchup"))
    return df.select(*out), spec


def fill_counts(df: DataFrame) -> DataFrame:
    """How many values the neutral fill replaces, per filled column (one agg)."""
    cols = df.columns
    raw = paired_diff_exprs(cols)
    if "EmptyArena" in cols:
        raw["EmptyArena"] = F.col("EmptyArena")
    targets = [c for c in C.ZERO_FILL_COLUMNS if c in raw]
    if not targets:
        return df.sparkSession.createDataFrame([], "column_name string, filled bigint")
    agg = df.agg(*[F.count_if(raw[c].isNull()).alias(c) for c in targets])
    return agg.unpivot([], targets, "column_name", "filled")
