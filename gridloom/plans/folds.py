"""Expanding time folds fitted from statistics of time blocks.

Rows in time order are cut where validation parts begin: block 0 lies before the
first of them, block j is the validation part of fold j. What fold j fits on is
blocks 0 to j - 1, and every statistic the preprocessor needs - counts, moments,
label sums by category, missing ratings by group, document frequencies - adds up
over blocks. So each statistic is taken by block in one aggregate of all rows,
added up to every fold at once, and a fold's fitted stages are made from its sums.
Rows are written once, whatever the number of folds; a fold's tables are a filter on the block and the
expressions of its stages over that copy.

Only medians do not add up: a numeric column with gaps counts its distinct values by fold.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from gridloom.functions.dates import extract_date_features, parse_date
from gridloom.functions.numeric import transform_value
from gridloom.models.splits import time_bounds, time_ordered
from gridloom.models.stages import (
    NULL_NAME,
    CategoryText,
    Dropped,
    FillScaleModel,
    GroupMeanFillModel,
    TargetEncoderModel,
    ValueTransform,
    column_moments,
)
from gridloom.operators import encode
from gridloom.operators.joins import filter_by_ids
from gridloom.operators.ordered import grouped_quantiles
from gridloom.operators.reshape import combine_blocks
from gridloom.operators.tfidf import smooth_idf, term_counts
from gridloom.plans.features import SETS, TABULAR, FeatureConfig, FeatureTables, add_sets, add_words, text_stages, words_column
from gridloom.sources.scratch import materialise

BLOCK, FOLD = "__block", "__fold"
VALUE, FLAG = "avg_mmr", "mmr_missing"
GROUP = ("region", "game_mode")


def fold_features(
    train: DataFrame,
    cfg: FeatureConfig,
    *,
    players: DataFrame | None = None,
    key: str = "match_id",
    n_splits: int = 5,
    target_col: str = "radiant_win",
    heroes: DataFrame | None = None,
    chat: DataFrame | None = None,
    chat_order: str | None = None,
    use_tabular: bool = True,
    use_heroes: bool = False,
    split_teams: bool = True,
) -> list[FeatureTables]:
    """Feature tables of every expanding fold, each fitted on its own past; no fold is written.

    Set features need the item table: items are known before any match.
    """
    if use_heroes and heroes is None:
        raise ValueError("set features of folds need an item table")
    if not use_tabular and not use_heroes and not cfg.of("text"):
        raise ValueError("at least one feature block must be on")
    dated = extract_date_features(train) if use_tabular else train.withColumn("date", parse_date("date"))
    rows = time_ordered(dated, "date", key, "__row")
    bounds = time_bounds(rows.count(), n_splits)
    block = sum((F.col("__row") >= first).cast("int") for first, _ in bounds)
    rows = rows.withColumn(BLOCK, block).drop("__row")
    if cfg.of("text"):
        rows = add_words(rows, cfg, key, chat, chat_order)
    width: dict[str, int] = {}
    if use_heroes:
        encoder = encode.SetEncoder.fit(heroes, split_teams)
        rows = add_sets(rows, encoder, filter_by_ids(players, rows, key), key)
        width[SETS] = encoder.n_features
    if cfg.of("text") or use_heroes:
        rows = materialise(rows)
    folds = range(1, len(bounds) + 1)
    steps: dict[int, list] = {j: [] for j in folds}
    widths = {j: {} for j in folds}
    if use_tabular:
        _tabular_stages(rows, cfg, target_col, steps, widths)
    if cfg.of("text"):
        _text_stages(rows, cfg, key, steps, widths)

    def side(j: int, part: Column) -> DataFrame:
        df = rows.filter(part)
        for step in steps[j]:
            df = step.transform(df)
        label = F.col(target_col).cast("double") if target_col in rows.columns else F.lit(None).cast("double")
        return combine_blocks(df, list(widths[j])).select(key, label.alias("label"), "features")

    for j in folds:
        widths[j] |= width
        if not sum(widths[j].values()):
            raise ValueError("the assembled table has no feature")
    b = F.col(BLOCK)
    return [FeatureTables(side(j, b < j), side(j, b == j), sum(widths[j].values()), tuple(widths[j])) for j in folds]


def upto(stats: DataFrame, n_folds: int) -> DataFrame:
    """Each block's statistics under every fold that fits on it."""
    return stats.filter(F.col(BLOCK) < n_folds).withColumn(FOLD, F.explode(F.sequence(F.col(BLOCK) + 1, F.lit(n_folds))))


def _by_fold(stats: DataFrame, n_folds: int, keys: Sequence[str], *sums: Column) -> DataFrame:
    """Sums over the past of every fold, written once."""
    return materialise(upto(stats, n_folds).groupBy(FOLD, *keys).agg(*sums))


def _tabular_stages(rows: DataFrame, cfg: FeatureConfig, label: str, steps: dict, widths: dict) -> None:
    n = len(steps)
    rated = {VALUE, *GROUP} <= set(rows.columns)
    made = {FLAG} if rated else set()
    absent = [c for c in cfg.of(*TABULAR) if c not in rows.columns and c not in made]
    if absent:
        raise ValueError(f"no such feature columns: {absent}")
    moments: dict[int, dict[str, tuple[float, float]]] = {j: {} for j in steps}
    if rated:
        _rating(rows, cfg.mmr_transform, steps, moments)
    for step in steps.values():
        step.append(ValueTransform(mode=cfg.mmr_transform))
    for i, c in enumerate(cfg.of("target")):
        _target(rows, c, label, f"__te{i}", steps)
        for w in widths.values():
            w[f"__te{i}"] = 1
    if ohe := cfg.of("ohe"):
        _one_hot(rows, ohe, steps, widths)
    if numeric := cfg.of("numeric"):
        _numbers(rows, numeric, steps, moments, n)
        for w in widths.values():
            w |= {f"__n{i}": 1 for i in range(len(numeric))}


def _rating(rows: DataFrame, mode: str, steps: dict, moments: dict) -> None:
    """Group means for the gaps of the rating, and the moments of the filled and transformed column and of its flag.

    A gap holds its group's mean, so the filled column's moments follow from those of the
    known values and the number of gaps in each group.
    """
    x = F.col(VALUE).try_cast("double")
    shaped = F.when(x.isNotNull(), transform_value(VALUE, mode))
    cells = rows.groupBy(BLOCK, *GROUP).agg(
        F.count(x).alias("n"), F.sum(x).alias("total"), F.count_if(x.isNull()).alias("gaps"), F.sum(shaped).alias("shaped"),
        F.avg(shaped).alias("mean"), F.var_pop(shaped).alias("var"),
    )
    cells = materialise(cells)
    whole = cells.agg(F.sum("shaped").alias("s"), F.sum("n").alias("n")).first()
    centre = whole["s"] / whole["n"] if whole["n"] else 0.0  # squares are taken around it
    squares = F.sum(F.col("n") * (F.col("var") + F.pow(F.col("mean") - centre, 2)))
    sums = [F.sum(c).alias(c) for c in ("n", "total", "gaps", "shaped")]
    by_group = _by_fold(cells, len(steps), GROUP, *sums, squares.alias("squares"))

    def means(keys: Sequence[str], name: str) -> DataFrame:
        total = by_group.groupBy(FOLD, *keys).agg(F.sum("total").alias("t"), F.sum("n").alias("k"))
        return total.select(FOLD, *keys, F.when(F.col("k") > 0, F.col("t") / F.col("k")).alias(name))

    groups, regions = materialise(means(GROUP, "__group_mean")), materialise(means(GROUP[:1], "__region_mean"))
    overall = {r[FOLD]: r["m"] for r in means((), "m").collect()}
    g, r = groups.alias("g"), regions.alias("r")
    filled = by_group.alias("s").join(g, _same("s", "g", (FOLD, *GROUP))).join(r, _same("s", "r", (FOLD, GROUP[0])))
    by_hand = F.create_map(*[F.lit(v) for j, m in overall.items() for v in (j, float(m or 0.0))])
    fill = F.coalesce("g.__group_mean", "r.__region_mean", by_hand[F.col(f"s.{FOLD}")])
    shaped_gap = filled.select(F.col(f"s.{FOLD}").alias(FOLD), "s.gaps", "s.n", "s.shaped", "s.squares", fill.alias(VALUE))
    shaped_gap = shaped_gap.withColumn("f", transform_value(VALUE, mode))
    found = shaped_gap.groupBy(FOLD).agg(
        F.sum("n").alias("n"), F.sum("gaps").alias("gaps"), F.sum(F.coalesce("shaped", F.lit(0.0)) + F.col("gaps") * F.col("f")).alias("s1"),
        F.sum(F.coalesce("squares", F.lit(0.0)) + F.col("gaps") * F.pow(F.col("f") - centre, 2)).alias("s2"),
    ).collect()
    for row in found:
        j, size = row[FOLD], row["n"] + row["gaps"]
        mean, share = row["s1"] / size, row["gaps"] / size
        moments[j][VALUE] = mean, _deviation(row["s2"] / size - (mean - centre) ** 2, centre)
        moments[j][FLAG] = share, math.sqrt(share * (1 - share)) or 1.0
    for j, step in steps.items():
        fitted = GroupMeanFillModel(overall=float(overall.get(j) or 0.0))
        step.append(fitted.holding(
            group_means=groups.filter(F.col(FOLD) == j).drop(FOLD), region_means=regions.filter(F.col(FOLD) == j).drop(FOLD)
        ))


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return cond


def _deviation(variance: float, centre: float) -> float:
    """Of a column whose squares were summed around ``centre``; what rounding leaves of a constant counts as 0, and 0 as 1."""
    return math.sqrt(variance) if variance > 1e-20 * (1 + centre * centre) else 1.0


def _target(rows: DataFrame, col: str, label: str, out: str, steps: dict) -> None:
    y = F.col(label).cast("double")
    cells = materialise(rows.groupBy(BLOCK, col).agg(F.count("*").alias("n"), F.count(y).alias("k"), F.sum(y).alias("s")))
    sums = _by_fold(cells, len(steps), [col], *[F.sum(c).alias(c) for c in ("n", "k", "s")])
    priors = {r[FOLD]: r["s"] / r["k"] if r["k"] else 0.0 for r in sums.groupBy(FOLD).agg(F.sum("s").alias("s"), F.sum("k").alias("k")).collect()}
    weight = encode.category_weight(F.col("n"))
    for j, step in steps.items():
        prior = float(priors.get(j, 0.0))
        mean = F.when(F.col("k") > 0, F.col("s") / F.col("k"))
        known = sums.filter((F.col(FOLD) == j) & F.col(col).isNotNull())
        table = known.select(F.col(col).alias("category"), (F.lit(prior) * (1 - weight) + mean * weight).alias("encoding"))
        step.append(TargetEncoderModel(inputCol=col, outputCol=out, prior=prior).holding(encodings=table))


def _one_hot(rows: DataFrame, cols: Sequence[str], steps: dict, widths: dict) -> None:
    """A category belongs to the folds after the block that first has it."""
    out = [f"__h{i}" for i in range(len(cols))]
    text, index = [f"{o}__text" for o in out], [f"{o}__index" for o in out]
    pairs = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.coalesce(F.col(c).cast("string"), F.lit(NULL_NAME)).alias("name")) for i, c in enumerate(cols)
    ]))
    first = rows.select(BLOCK, pairs.alias("p")).groupBy("p.i", "p.name").agg(F.min(BLOCK).alias("first"))
    listed = first.limit(encode.MOST_NAMES * len(cols) + 1).collect()
    if len(listed) > encode.MOST_NAMES * len(cols):
        raise ValueError(f"more than {encode.MOST_NAMES} distinct values in a column of {list(cols)}")
    named = CategoryText(inputCols=list(cols), outputCols=text)
    for j, step in steps.items():
        labels = [sorted((r["name"] for r in listed if r["i"] == i and r["first"] < j), key=str.encode) for i in range(len(cols))]
        indexers = [StringIndexerModel.from_labels(*x, "keep") for x in zip(labels, text, index, strict=True)]
        none = PipelineModel([named, *indexers]).transform(rows.limit(0))
        encoder = OneHotEncoder(inputCols=index, outputCols=out, dropLast=True).fit(none)
        step += [named, *indexers, encoder, Dropped(inputCols=[*text, *index])]
        widths[j] |= dict(zip(out, map(len, labels), strict=True))


def _numbers(rows: DataFrame, cols: Sequence[str], steps: dict, moments: dict, n_folds: int) -> None:
    plain = [c for c in cols if c not in next(iter(moments.values()))]
    fills: dict[int, dict[str, float]] = {j: {} for j in steps}
    if plain:
        blocks = rows.groupBy(BLOCK).agg(*[column_moments(c).alias(f"m{i}") for i, c in enumerate(plain)]).collect()
        blocks.sort(key=lambda r: r[BLOCK])
        holes = [c for i, c in enumerate(plain) if any(r[f"m{i}"]["gaps"] for r in blocks)]
        for c in holes:
            values = upto(rows.select(BLOCK, F.col(c).cast("double").alias("v")), n_folds)
            for r in grouped_quantiles(values, "v", [0.5], [FOLD]).collect():
                fills[r[FOLD]][c] = r["value"]
        for j in steps:
            past = [r for r in blocks if r[BLOCK] < j]
            for i, c in enumerate(plain):
                moments[j][c] = merged([r[f"m{i}"] for r in past], float(fills[j].get(c) or 0.0))
    for j, step in steps.items():
        step.append(FillScaleModel(
            inputCols=list(cols), outputCols=[f"__n{i}" for i in range(len(cols))], fills=[float(fills[j].get(c) or 0.0) for c in cols],
            means=[moments[j][c][0] for c in cols], deviations=[moments[j][c][1] for c in cols],
        ))


def merged(parts: Sequence[Row], fill: float) -> tuple[float, float]:
    """Mean and deviation of several blocks' values together, once gaps hold ``fill``."""
    groups = [(p["n"], p["mean"], p["var"]) for p in parts if p["n"]] + [(sum(p["gaps"] for p in parts), fill, 0.0)]
    size = sum(n for n, _, _ in groups)
    if not size:
        return 0.0, 1.0
    mean = sum(n * m for n, m, _ in groups) / size
    return mean, _deviation(sum(n * (v + (m - mean) ** 2) for n, m, v in groups) / size, mean)


def _text_stages(rows: DataFrame, cfg: FeatureConfig, key: str, steps: dict, widths: dict) -> None:
    sizes = {r[BLOCK]: r["count"] for r in rows.groupBy(BLOCK).count().collect()}
    options = cfg.text
    for i in range(len(cfg.of("text"))):
        words = words_column(i)
        keyed = rows.select(F.struct(key, BLOCK).alias("k"), words)
        cells = term_counts(keyed, "k", words, *options.ngram_range)
        blocks = cells.groupBy(F.col(f"k.{BLOCK}").alias(BLOCK), "term").agg(F.count("*").alias("df"), F.sum("tf").alias("freq"))
        sums = _by_fold(materialise(blocks), len(steps), ["term"], F.sum("df").alias("df"), F.sum("freq").alias("freq"))
        for j in steps:
            n_docs = sum(n for b, n in sizes.items() if b < j)
            low, high = (v if isinstance(v, int) else v * n_docs for v in (options.min_df, options.max_df))
            kept = sums.filter((F.col(FOLD) == j) & (F.col("df") >= low) & (F.col("df") <= high))
            if options.max_features is not None:
                kept = kept.orderBy(F.desc("freq"), "term").limit(options.max_features)
            terms = kept.select("term", smooth_idf(n_docs, F.col("df")).alias("idf")).orderBy("term").collect()
            if terms:
                made, out = text_stages(i, terms, options)
                steps[j] += made
                widths[j][out] = len(terms)
