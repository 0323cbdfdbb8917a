"""Encoders, splits, models and metrics."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import metrics
from gridloom.models import linear, search, splits, stages, statistics
from gridloom.models.logistic import fit_logistic, positive_probability
from gridloom.models.target import fit_log_target, fit_transformed_target
from gridloom.operators import encode, tfidf
from gridloom.operators.frame import fill_const
from gridloom.operators.reshape import combine_blocks
from gridloom.plans.features import FeatureConfig, FeatureSelection, TextOptions, build_feature_tables
from gridloom.plans.folds import fold_features
from gridloom.plans.runs import Run, cross_validate, fit_and_predict, fold_tables, score_folds
from gridloom.queries.catalog import query
from gridloom.queries.inputs import GROUP_SIZE, HOUSE_ORDER, HOUSE_X, Tables, r
from gridloom.queries.shaping import CLEAN_SQL, TOKEN_SQL, WORD_SQL, collapse_sql
from gridloom.sources import sinks
from gridloom.sources.scratch import materialise, scratch_path

# Train is three quarters of the matches by id; "other" is every match, with some
# regions and modes that train does not have.
_PARTS = """tr AS (SELECT * FROM matches WHERE match_id % 4 <> 0),
    ot AS (SELECT match_id, date, CASE WHEN match_id % 19 = 0 THEN 'ATLANTIS' WHEN match_id % 23 = 0 THEN NULL ELSE region END
           AS region, game_mode, avg_mmr, radiant_win FROM matches)"""


def _parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    k = F.col("match_id")
    region = F.when(k % 19 == 0, "ATLANTIS").when(k % 23 == 0, F.lit(None)).otherwise(F.col("region"))
    train, _ = splits.split_at(t.matches, F.pmod(k + 3, F.lit(4)), 3)
    return train, t.matches.withColumn("region", region)


# --- encoders -----------------------------------------------------------------------

_CELLS = """dict AS (SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS col FROM heroes),
    placed AS (SELECT match_id, col, CASE WHEN player_slot BETWEEN 0 AND 4 THEN 1 ELSE -1 END AS s
               FROM players JOIN dict ON hero_id = id
               WHERE player_slot BETWEEN 0 AND 4 OR player_slot BETWEEN 128 AND 132)"""


@query(
    "fe1_set_encoder",
    f"""WITH {_CELLS} SELECT match_id, col, CAST(sign(sum(s)) AS INTEGER) AS value FROM placed GROUP BY match_id, col
        HAVING sum(s) <> 0""",
)
def _(t: Tables) -> DataFrame:
    return encode.SetEncoder.fit(t.heroes).coordinates(t.players)


@query(
    "fe1_set_vectors",
    f"""WITH {_CELLS}, v AS (SELECT match_id, col, CAST(sign(sum(s)) AS INTEGER) AS value FROM placed GROUP BY match_id, col),
    n AS (SELECT count(*) AS k FROM dict)
    SELECT match_id, array_to_string([coalesce(m[c], 0) FOR c IN range(k)], ',') AS cells FROM
    (SELECT match_id, map_from_entries(list((col, value)) FILTER (col IS NOT NULL)) AS m, any_value(k) AS k
     FROM (SELECT match_id FROM matches) LEFT JOIN v USING (match_id), n GROUP BY match_id)""",
)
def _(t: Tables) -> DataFrame:
    rows = encode.SetEncoder.fit(t.heroes).vectors(t.players, t.matches)
    return rows.select("match_id", F.array_join(vector_to_array("features").cast("array<int>"), ",").alias("cells"))


@query(
    "fe2_set_encoder_split",
    f"""WITH {_CELLS} SELECT DISTINCT match_id, CAST(col + CASE WHEN s < 0 THEN (SELECT count(*) FROM dict) ELSE 0 END AS INTEGER)
        AS col, CAST(1 AS INTEGER) AS value FROM placed""",
)
def _(t: Tables) -> DataFrame:
    return encode.SetEncoder.fit(t.heroes, split_teams=True).coordinates(t.players)


@query(
    "fe3_one_hot",
    f"""WITH {_PARTS}
    SELECT match_id, 'region' AS feature, region AS category, CAST(1 AS INTEGER) AS value FROM ot WHERE region IN (SELECT region FROM tr)
    UNION ALL SELECT match_id, 'game_mode', game_mode, 1 FROM ot WHERE game_mode IN (SELECT game_mode FROM tr)""",
)
def _(t: Tables) -> DataFrame:
    train, other = _parts(t)
    return encode.one_hot(train, other, ["region", "game_mode"], "match_id")


_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query(
    "fe4_one_hot_named",
    f"WITH {_PARTS} SELECT match_id, "
    + ", ".join(f"""CAST(coalesce(region = '{v}', false) AS INTEGER) AS "region_{v}\"""" for v in _REGIONS)
    + """, CAST(region IS NULL OR region NOT IN (SELECT region FROM tr) AS INTEGER) AS region_unknown FROM ot""",
)
def _(t: Tables) -> DataFrame:
    train, other = _parts(t)
    out = encode.one_hot_named(train, other, "region")
    return out.select("match_id", *[f"region_{v}" for v in _REGIONS], "region_unknown")


_TARGET = """te AS (SELECT region, prior * (1 - w) + m * w AS enc FROM (SELECT region, avg(radiant_win) AS m,
    1 / (1 + exp(-(count(*) - 20) / 10.0)) AS w, (SELECT avg(radiant_win) FROM tr) AS prior FROM tr GROUP BY region))"""


@query(
    "fe5_target_encode",
    f"""WITH {_PARTS}, {_TARGET}
    SELECT match_id, round(coalesce(enc, (SELECT avg(radiant_win) FROM tr)), 6) AS region_te FROM ot LEFT JOIN te USING (region)""",
)
def _(t: Tables) -> DataFrame:
    train, other = _parts(t)
    out = encode.target_encode(train, other, "region", "radiant_win")
    return out.select("match_id", r("region_te").alias("region_te"))


@query(
    "fe6_impute_median",
    f"WITH {_PARTS} SELECT match_id, round(coalesce(avg_mmr, (SELECT median(avg_mmr) FROM tr)), 4) AS avg_mmr FROM ot",
)
def _(t: Tables) -> DataFrame:
    train, other = _parts(t)
    return encode.impute_median(train, other, ["avg_mmr"]).select("match_id", r("avg_mmr", 4).alias("avg_mmr"))


@query(
    "fe7_impute_mean",
    f"WITH {_PARTS} SELECT match_id, round(coalesce(avg_mmr, (SELECT avg(avg_mmr) FROM tr)), 4) AS avg_mmr FROM ot",
)
def _(t: Tables) -> DataFrame:
    train, other = _parts(t)
    return encode.impute_mean(train, other, ["avg_mmr"]).select("match_id", r("avg_mmr", 4).alias("avg_mmr"))


@query(
    "fe8_fill_const",
    f"WITH {_PARTS} SELECT match_id, coalesce(region, 'NotGiven') AS region, game_mode FROM ot",
)
def _(t: Tables) -> DataFrame:
    return fill_const(_parts(t)[1], ["region", "game_mode"]).select("match_id", "region", "game_mode")


@query(
    "fe9_scale",
    """WITH s AS (SELECT avg(quantity) AS mq, stddev_pop(quantity) AS sq, avg(retail) AS mr, stddev_pop(retail) AS sr FROM house)
    SELECT orderkey, linenumber, partkey, round((quantity - mq) / sq, 6) AS quantity, round((retail - mr) / sr, 6) AS retail,
           CAST(0 AS DOUBLE) AS bias FROM house, s""",
)
def _(t: Tables) -> DataFrame:
    out = encode.scale(t.house, t.house, ["quantity", "retail", "bias"])
    keys = ("orderkey", "linenumber", "partkey")
    return out.select(*keys, *[r(c).alias(c) for c in ("quantity", "retail", "bias")])


@query(
    "fe10_preprocessor",
    f"""WITH {_PARTS}, {_TARGET}, g AS (SELECT region, game_mode, avg(avg_mmr) AS gm FROM tr GROUP BY ALL),
    o AS (SELECT region, avg(avg_mmr) AS rm FROM tr GROUP BY ALL), mean AS (SELECT avg(avg_mmr) AS am FROM tr),
    fit AS (SELECT coalesce(avg_mmr, gm) AS x, CASE WHEN avg_mmr IS NULL THEN 1.0 ELSE 0.0 END AS miss
            FROM tr JOIN g USING (region, game_mode)),
    s AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(miss) AS mm, stddev_pop(miss) AS sm FROM fit)
    SELECT match_id, round(coalesce(enc, (SELECT avg(radiant_win) FROM tr)), 6) AS encoded,
           CAST(date_part('month', date) AS BIGINT) AS month_check,
           round((coalesce(avg_mmr, gm, rm, am) - mx) / sx, 6) AS mmr,
           round((CASE WHEN avg_mmr IS NULL THEN 1.0 ELSE 0.0 END - mm) / sm, 6) AS missing
    FROM ot LEFT JOIN te ON ot.region = te.region
    LEFT JOIN g ON ot.region = g.region AND ot.game_mode = g.game_mode LEFT JOIN o ON ot.region = o.region, mean, s""",
)
def _(t: Tables) -> DataFrame:
    train, other = _parts(t)
    train = materialise(train)  # every estimator reads it anew
    unfitted = stages.make_preprocessor(["region"], ["month"], ["avg_mmr", "mmr_missing"], "radiant_win", mode="raw")
    path = scratch_path(t.spark, "preprocessor")
    sinks.save(unfitted.fit(train), path)
    v = sinks.load(PipelineModel, path).transform(other).select("match_id", vector_to_array("features").alias("v"))
    # One target column, twelve months in text order, two numeric columns.
    months = F.array(*[F.lit(int(m)) for m in sorted(map(str, range(1, 13)))])
    hot = F.slice("v", 2, 12)
    return v.select(
        "match_id",
        r(F.get("v", 0)).alias("encoded"),
        F.element_at(months, F.array_position(hot, 1.0).cast("int")).cast("long").alias("month_check"),
        r(F.get("v", 13)).alias("mmr"),
        r(F.get("v", 14)).alias("missing"),
    )


@query(
    "io6_pipeline_save_load",
    f"""WITH {_PARTS}, {_TARGET}, q AS (SELECT quantile_cont(avg_mmr, [0.25, 0.5, 0.75]) AS q, avg(avg_mmr) AS m FROM tr)
    SELECT match_id, round(coalesce(enc, (SELECT avg(radiant_win) FROM tr)), 6) AS encoded,
           CAST((coalesce(avg_mmr, m) >= q[1])::INT + (coalesce(avg_mmr, m) >= q[2])::INT + (coalesce(avg_mmr, m) >= q[3])::INT AS INTEGER) AS bin,
           round(coalesce(avg_mmr, m), 4) AS filled
    FROM ot LEFT JOIN te USING (region), q""",
)
def _(t: Tables) -> DataFrame:
    train, other = _parts(t)
    parts = [
        stages.TargetEncoder(inputCol="region", outputCol="encoded", labelCol="radiant_win"),
        stages.FillScale(inputCols=["avg_mmr"], outputCols=["filled"], strategy="mean", scaled=False),
        # Bins of the known values: fitted before the gaps are filled, applied to the filled column.
        stages.QuantileBins(inputCol="avg_mmr", outputCol="bin", bins=4),
    ]
    path = scratch_path(t.spark, "pipeline")
    sinks.save(Pipeline(stages=parts).fit(train), path)
    encoder, fill, bins = sinks.load(PipelineModel, path).stages
    filled = fill.transform(encoder.transform(other))
    binned = bins.copy({bins.inputCol: "filled"}).transform(filled)
    return binned.select("match_id", r("encoded").alias("encoded"), "bin", r("filled", 4).alias("filled"))


@query(
    "fe11_tfidf",
    f"""WITH w AS (SELECT doc_id, [x FOR x IN regexp_extract_all({collapse_sql(CLEAN_SQL)}, '{TOKEN_SQL}') IF {WORD_SQL}] AS w FROM documents),
    grams AS (SELECT doc_id, unnest(w) AS term FROM w
              UNION ALL SELECT doc_id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM w),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY ALL),
    vocab AS (SELECT term, count(*) AS df, sum(tf) AS freq FROM tf WHERE doc_id % 4 <> 0 GROUP BY term
              HAVING count(*) BETWEEN 5 AND 0.5 * (SELECT count(*) FROM documents WHERE doc_id % 4 <> 0)
              ORDER BY freq DESC, term LIMIT 1500),
    raw AS (SELECT doc_id, term, tf * (ln((1.0 + (SELECT count(*) FROM documents WHERE doc_id % 4 <> 0)) / (1.0 + df)) + 1) AS x
            FROM tf JOIN vocab USING (term))
    SELECT doc_id, term, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""",
)
def _(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text").repartition("doc_id")  # one supplied file, many task slots
    # The fitting texts are among those to weigh: all are cleaned and written once.
    words = materialise(docs.select("doc_id", tfidf.clean_words("text").alias("words")))
    model = tfidf.TfIdf.fit(words.filter(F.col("doc_id") % 4 != 0), "doc_id", "words", max_features=1500, min_df=5, max_df=0.5)
    weights = model.transform(words, "doc_id", "words")
    return weights.select("doc_id", "term", r("weight").alias("weight"))


@query(
    "fe12_polynomial",
    """SELECT orderkey, linenumber, partkey, round(quantity, 4) AS poly_quantity, round(tax, 4) AS poly_tax,
       round(quantity * quantity, 4) AS poly_quantity_quantity, round(quantity * tax, 4) AS poly_quantity_tax,
       round(tax * tax, 4) AS poly_tax_tax FROM house""",
)
def _(t: Tables) -> DataFrame:
    out = encode.polynomial(t.house, ["quantity", "tax"], 2)
    made = [c for c in out.columns if c.startswith("poly_")]
    return out.select("orderkey", "linenumber", "partkey", *[r(c, 4).alias(c) for c in made])


@query(
    "fe13_quantile_bins",
    """WITH e AS (SELECT quantile_cont(y, [0.2, 0.4, 0.6, 0.8]) AS q FROM house)
    SELECT b AS y_bin, CAST(count(*) AS BIGINT) AS n, round(min(y), 2) AS lo, round(max(y), 2) AS hi,
           CAST(sum(CASE WHEN b = 2 THEN 1 ELSE 0 END) AS BIGINT) AS ones
    FROM (SELECT y, CAST((y >= q[1])::INT + (y >= q[2])::INT + (y >= q[3])::INT + (y >= q[4])::INT AS INTEGER) AS b FROM house, e) GROUP BY b""",
)
def _(t: Tables) -> DataFrame:
    return encode.quantile_bins(t.house, t.house, "y", 5).groupBy("y_bin").agg(
        F.count("*").alias("n"), r(F.min("y"), 2).alias("lo"), r(F.max("y"), 2).alias("hi"),
        F.sum("y_bin_2").cast("long").alias("ones"),
    )


@query("fe14_quantile_normal", "SELECT o_orderkey, true AS is_back, true AS is_bounded FROM orders")
def _(t: Tables) -> DataFrame:
    law = encode.QuantileNormal.fit(t.orders, "o_totalprice", 300)
    z = t.orders.select("o_orderkey", "o_totalprice", law.forward("o_totalprice").alias("z"))
    back = z.withColumn("back", law.inverse("z"))
    return back.select(
        "o_orderkey",
        (F.abs(F.col("back") - F.col("o_totalprice")) < 0.5).alias("is_back"),
        (F.abs("z") < 5.2).alias("is_bounded"),
    )


_SHARES = ", ".join(repr(float(p)) for p in np.linspace(0, 1, 300))


def _sql_polynomial(coefficients: Sequence[float], x: str) -> str:
    out = repr(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c!r})"
    return out


@query(
    "fe14_normal_scores",
    f"""WITH l AS (SELECT quantile_cont(o_totalprice, [{_SHARES}]) AS q FROM orders),
    c AS (SELECT o_orderkey, o_totalprice AS x, q, len(list_filter(q, lambda v: v < o_totalprice)) AS under,
                 len(list_filter(q, lambda v: v <= o_totalprice)) AS upto FROM orders, l),
    s AS (SELECT o_orderkey, CASE WHEN x - 1e-7 < q[1] THEN 0.0 WHEN x + 1e-7 > q[300] THEN 1.0 WHEN upto > under THEN (under + upto - 1) / 2.0 / 299
                 ELSE (under - 1 + (x - q[under]) / (q[under + 1] - q[under])) / 299 END AS share FROM c),
    e AS (SELECT *, least(greatest(share, 1e-7), 1 - 1e-7) AS p FROM s),
    f AS (SELECT *, sqrt(-2 * ln(least(p, 1 - p))) AS u, p - 0.5 AS w, (p - 0.5) * (p - 0.5) AS r FROM e)
    SELECT o_orderkey, round(share, 8) AS share, round(CASE WHEN least(p, 1 - p) < {encode._TAIL} THEN CASE WHEN p < 0.5 THEN 1 ELSE -1 END
           * {_sql_polynomial(encode._C, 'u')} / {_sql_polynomial(encode._D, 'u')}
           ELSE {_sql_polynomial(encode._A, 'r')} * w / {_sql_polynomial(encode._B, 'r')} END, 6) + 0.0 AS z FROM f""",
)
def _(t: Tables) -> DataFrame:
    law = encode.QuantileNormal.fit(t.orders, "o_totalprice", 300)
    return t.orders.select("o_orderkey", r(law.share(F.col("o_totalprice")), 8).alias("share"), r(law.forward("o_totalprice")).alias("z"))


@query(
    "fe15_trim_outliers",
    """WITH e AS (SELECT orderkey, linenumber, partkey, pow(y - quantity * retail, 2) AS err FROM house)
    SELECT orderkey, linenumber, partkey, round(err, 0) AS err FROM e WHERE err < (SELECT quantile_cont(err, 0.95) FROM e)""",
)
def _(t: Tables) -> DataFrame:
    d = F.col("y") - F.col("quantity") * F.col("retail")
    e = t.house.select("orderkey", "linenumber", "partkey", F.pow(d, F.lit(2)).alias("err"))
    return encode.trim_outliers(e, "err", 0.95).withColumn("err", r("err", 0))


@query(
    "fe16_feature_tables",
    f"""WITH {_CELLS}, n AS (SELECT count(*) AS k FROM dict),
    hero AS (SELECT match_id, count(*) AS h FROM (SELECT DISTINCT match_id, col, s FROM placed) GROUP BY match_id)
    SELECT match_id, CAST(5 + 2 * k AS INTEGER) AS width, CAST(1 + coalesce(h, 0) AS BIGINT) AS nonzero
    FROM matches LEFT JOIN hero USING (match_id), n""",
)
def _(t: Tables) -> DataFrame:
    late = F.col("match_id") % 4 == 0
    tables = build_feature_tables(
        t.matches.filter(~late), t.matches.filter(late), FeatureConfig({"ohe": ("region",)}),
        train_players=t.players.filter(~late), other_players=t.players.filter(late),
        heroes=t.heroes, use_heroes=True,
    )
    v = vector_to_array("features")
    both = tables.train.unionByName(tables.other)
    return both.select(
        "match_id", F.size(v).alias("width"), F.size(F.filter(v, lambda x: x != 0)).cast("long").alias("nonzero")
    )


@query(
    "fe16_text_blocks",
    """SELECT CAST(doc_id AS BIGINT) AS match_id, true AS is_unit FROM documents""",
)
def _(t: Tables) -> DataFrame:
    docs = t.documents.select(F.col("doc_id").alias("match_id"), F.col("text").alias("radiant_chat")).repartition("match_id")
    cfg = FeatureConfig({"text": ("radiant_chat",)}, text=TextOptions(max_features=500, min_df=5))
    tables = build_feature_tables(docs, docs, cfg, use_tabular=False)
    v = vector_to_array("features")
    length = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    # Rows are scaled to length one; a row without any known term stays zero.
    return tables.other.select("match_id", ((F.abs(length - 1) < 1e-9) | (length == 0)).alias("is_unit"))


# --- splits ---------------------------------------------------------------------------

@query(
    "ml1_split",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 7 THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def _(t: Tables) -> DataFrame:
    a, b = splits.split_at(t.orders.select("o_orderkey"), F.col("o_orderkey") % 10, 7)
    return a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test")))


@query(
    "ml1_random_split",
    "SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_shared, true AS near_share FROM orders",
)
def _(t: Tables) -> DataFrame:
    a, b = splits.random_split(t.orders.select("o_orderkey"), "o_orderkey", 0.7, seed=10)
    both = a.withColumn("train", F.lit(1)).unionByName(b.withColumn("train", F.lit(0)))
    per = both.groupBy("o_orderkey").agg(F.count("*").alias("k"), F.max("train").alias("train"))
    return per.agg(
        F.count("*").alias("n"), F.count_if(F.col("k") > 1).alias("n_shared"),
        (F.abs(F.avg("train") - 0.7) < 0.02).alias("near_share"),
    )


_FOLDS = """rn AS (SELECT match_id, radiant_win, row_number() OVER (ORDER BY date NULLS LAST, match_id) - 1 AS rw FROM matches),
    sz AS (SELECT count(*) AS n, count(*) // {k1} AS size FROM matches),
    fd AS (SELECT i AS fold, n - ({k1} - i) * size AS a, n - ({k} - i) * size AS b FROM sz, (SELECT unnest(range(1, {k1})) AS i))"""


@query(
    "ml2_time_split",
    f"""WITH {_FOLDS.format(k=5, k1=6)}
    SELECT match_id, CAST(rw AS BIGINT) AS row, CAST(fold AS INTEGER) AS fold,
    CASE WHEN rw < a THEN 'train' ELSE 'valid' END AS role FROM rn JOIN fd ON rw < b""",
)
def _(t: Tables) -> DataFrame:
    return splits.time_split_table(t.matches, "date", "match_id", 5)


@query(
    "ml3_kfold",
    """WITH k AS (SELECT match_id, row_number() OVER (ORDER BY match_id) - 1 AS rw, count(*) OVER () AS n FROM matches)
    SELECT match_id, CAST(rw AS BIGINT) AS row, CAST(CASE WHEN rw < (n % 7) * (n // 7 + 1) THEN rw // (n // 7 + 1)
    ELSE (rw - n % 7) // (n // 7) END AS INTEGER) AS fold FROM k""",
)
def _(t: Tables) -> DataFrame:
    return splits.kfold_table(t.matches.select("match_id"), ["match_id"], 7)


# --- closed forms -----------------------------------------------------------------------

def _weights(t: Tables, model: linear.LinearModel, digits: int = 4) -> DataFrame:
    rows = [(n, round(float(w), digits) + 0.0) for n, w in zip(model.names, model.weights)]
    rows.append(("intercept", round(float(model.intercept), digits) + 0.0))
    return t.spark.createDataFrame(rows, "name string, weight double")


@query(
    "ml4_ols",
    """SELECT 'quantity' AS name, round(regr_slope(y, quantity), 4) AS weight FROM house
       UNION ALL SELECT 'intercept', round(regr_intercept(y, quantity), 4) FROM house""",
)
def _(t: Tables) -> DataFrame:
    return _weights(t, linear.fit_ols(t.house, ["quantity"], "y"))


@query(
    "ml5_gram_table",
    """SELECT 'quantity' AS row, 'quantity' AS col, round(sum(quantity * quantity), 2) AS value FROM house
       UNION ALL SELECT 'quantity', 'size', round(sum(quantity * size), 2) FROM house
       UNION ALL SELECT 'size', 'size', round(sum(size * size), 2) FROM house
       UNION ALL SELECT 'quantity', 'tax', round(sum(quantity * tax), 2) FROM house
       UNION ALL SELECT 'size', 'tax', round(sum(size * tax), 2) FROM house""",
)
def _(t: Tables) -> DataFrame:
    return statistics.gram_table(t.house, ["quantity", "size"], "tax").withColumn("value", r("value", 2))


@query(
    "ml5_closed_form",
    """SELECT 'quantity' AS name, round(regr_slope(y, quantity), 4) AS weight FROM house
       UNION ALL SELECT 'bias', round(regr_intercept(y, quantity), 4) FROM house
       UNION ALL SELECT 'intercept', 0.0 FROM (SELECT count(*) FROM house)""",
)
def _(t: Tables) -> DataFrame:
    return _weights(t, linear.fit_closed_form(t.house, ["quantity", "bias"], "y"))


@query(
    "ml6_svd",
    """WITH g AS (SELECT sum(quantity * quantity) AS a, sum(quantity * size) AS b, sum(size * size) AS c,
                  sum(quantity * y) AS p, sum(size * y) AS q FROM house),
    e AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS lam FROM g),
    v AS (SELECT *, b AS v1, lam - a AS v2 FROM e)
    SELECT 'quantity' AS name, round(v1 * (v1 * p + v2 * q) / (v1 * v1 + v2 * v2) / lam, 4) AS weight FROM v
    UNION ALL SELECT 'size', round(v2 * (v1 * p + v2 * q) / (v1 * v1 + v2 * v2) / lam, 4) FROM v
    UNION ALL SELECT 'intercept', 0.0 FROM v""",
)
def _(t: Tables) -> DataFrame:
    return _weights(t, linear.fit_svd(t.house, ["quantity", "size"], "y"))


_RIDGE = """rg AS (SELECT count(*) AS n, avg(quantity) AS m1, avg(size) AS m2, avg(y) AS my,
    var_pop(quantity) * count(*) + {alpha} AS a, covar_pop(quantity, size) * count(*) AS b, var_pop(size) * count(*) + {alpha} AS c,
    covar_pop(quantity, y) * count(*) AS p, covar_pop(size, y) * count(*) AS q FROM {source}),
    rw AS (SELECT *, (c * p - b * q) / (a * c - b * b) AS w1, (a * q - b * p) / (a * c - b * b) AS w2 FROM rg)"""


@query(
    "ml7_ridge",
    f"""WITH {_RIDGE.format(alpha=5000, source='house')} SELECT 'quantity' AS name, round(w1, 4) AS weight FROM rw
    UNION ALL SELECT 'size', round(w2, 4) FROM rw UNION ALL SELECT 'intercept', round(my - w1 * m1 - w2 * m2, 4) FROM rw""",
)
def _(t: Tables) -> DataFrame:
    return _weights(t, linear.fit_ridge(t.house, ["quantity", "size"], "y", 5000.0))


@query(
    "io6_linear_save_load",
    f"""WITH {_RIDGE.format(alpha=5000, source='house')} SELECT orderkey, linenumber, partkey,
    round(my + w1 * (quantity - m1) + w2 * (size - m2), 2) AS prediction FROM house, rw""",
)
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "linear")
    sinks.save(linear.fit_ridge(t.house, ["quantity", "size"], "y", 5000.0), path)
    out = sinks.load(linear.LinearModel, path).predict(t.house)
    return out.select("orderkey", "linenumber", "partkey", r("prediction", 2).alias("prediction"))


@query(
    "ml8_lasso",
    """WITH s AS (SELECT 'quantity' AS name, covar_pop(quantity, y) AS c, var_pop(quantity) AS v FROM house
                  UNION ALL SELECT 'tax', covar_pop(tax, y), var_pop(tax) FROM house)
    SELECT name, round(sign(c) * greatest(abs(c) - 2000, 0) / v, 4) AS weight,
           CAST(CASE WHEN abs(c) <= 2000 THEN 1 ELSE 0 END AS INTEGER) AS zeros FROM s""",
)
def _(t: Tables) -> DataFrame:
    rows = []
    for name in ("quantity", "tax"):
        model = linear.fit_lasso(t.house, [name], "y", 2000.0)
        rows.append((name, round(float(model.weights[0]), 4) + 0.0, model.zeros))
    return t.spark.createDataFrame(rows, "name string, weight double, zeros int")


def _large_sale(t: Tables) -> DataFrame:
    """Was a sale large, from its size and price: (features, label) rows."""
    scaled = encode.scale(t.house, t.house, ["quantity", "retail", "discount"])
    labelled = scaled.withColumn("label", (F.col("y") > 30000).cast("double"))
    return combine_blocks(labelled, ["quantity", "retail", "discount"])


@query("ml9_logistic", "SELECT CAST(count(*) AS BIGINT) AS n, true AS at_optimum, true AS better_than_chance FROM house")
def _(t: Tables) -> DataFrame:
    rows = _large_sale(t)
    model = fit_logistic(rows, C=0.01, tol=1e-9)
    scored = positive_probability(model, rows).withColumn("v", vector_to_array("features"))
    miss = F.col("score") - F.col("label")
    w = [float(x) for x in model.coefficients]
    # Gradient of the mean objective: mean(miss * x) + w / (C n).
    slopes = [F.avg(miss * F.get("v", i)) + F.lit(w[i]) / (F.lit(0.01) * F.count("*")) for i in range(3)]
    worst = F.greatest(*[F.abs(s) for s in slopes], F.abs(F.avg(miss)))
    loss = -F.avg(F.when(F.col("label") > 0, F.log("score")).otherwise(F.log(1 - F.col("score"))))
    return scored.agg(
        F.count("*").alias("n"), (worst < 1e-4).alias("at_optimum"), (loss < 0.6).alias("better_than_chance")
    )


# --- losses -------------------------------------------------------------------------------

_X3 = ["quantity", "discount", "bias"]
_W3 = [1.5, -2.0, 0.5]
_LOSS_ROWS = """lr AS (SELECT quantity, discount, bias, 1.5 * quantity - 2.0 * discount + 0.5 * bias - y / 1000 AS e FROM house)"""


def _thousands(t: Tables) -> DataFrame:
    return t.house.withColumn("y", F.col("y") / 1000)


def _loss(t: Tables, loss) -> DataFrame:
    out = linear.loss_table(_thousands(t), loss, _X3, "y", _W3)
    return out.select(*[r(c, 5).alias(c) for c in out.columns])


def _loss_sql(value: str, slope: str, mu: float = 0.0) -> str:
    pen = [mu * 1.5, mu * -2.0, 0.0]
    grads = ", ".join(f"round(avg(({slope}) * {x}) + {p}, 5) AS grad_{x}" for x, p in zip(_X3, pen))
    return f"WITH {_LOSS_ROWS} SELECT round(avg({value}) + {mu / 2 * (1.5**2 + 2.0**2)}, 5) AS loss, {grads} FROM lr"


_COSH = ("abs(e) + ln(1 + exp(-2 * abs(e))) - ln(2)", "tanh(e)")
_HUBER = ("CASE WHEN abs(e) < 4 THEN 0.5 * e * e ELSE 4 * abs(e) - 8 END", "CASE WHEN abs(e) < 4 THEN e ELSE 4 * sign(e) END")


@query("ml10_mse", _loss_sql("e * e", "2 * e"))
def _(t: Tables) -> DataFrame:
    return _loss(t, linear.Mse())


@query("ml11_log_cosh", _loss_sql(*_COSH))
def _(t: Tables) -> DataFrame:
    return _loss(t, linear.LogCosh())


@query("ml12_huber", _loss_sql(*_HUBER))
def _(t: Tables) -> DataFrame:
    return _loss(t, linear.Huber(4.0))


@query("ml13_l2", _loss_sql(*_HUBER, mu=0.25))
def _(t: Tables) -> DataFrame:
    return _loss(t, linear.L2(linear.Huber(4.0), 0.25))


# --- descent ---------------------------------------------------------------------------------

def _fitted(t: Tables, model: linear.LinearModel, digits: int = 5) -> DataFrame:
    rows = [(f"w_{n}", round(float(w), digits) + 0.0) for n, w in zip(model.names, model.weights)]
    rows += [(f"loss_{i}", round(float(v), digits) + 0.0) for i, v in enumerate(model.loss_history)]
    return t.spark.createDataFrame(rows, "name string, value double")


def _huber_sql(x: str = "e") -> str:
    return f"CASE WHEN abs({x}) < 4 THEN 0.5 * {x} * {x} ELSE 4 * abs({x}) - 8 END"


def _huber_slope_sql(x: str) -> str:
    return f"CASE WHEN abs({x}) < 4 THEN {x} ELSE 4 * sign({x}) END"


@query(
    "ml14_gradient_descent",
    f"""WITH h AS (SELECT quantity AS q, y / 1000 AS y FROM house),
    g0 AS (SELECT avg({_huber_sql('(-y)')}) AS l0, -0.001 * avg(({_huber_slope_sql('(-y)')}) * q) AS a1,
           -0.001 * avg({_huber_slope_sql('(-y)')}) AS b1 FROM h),
    g1 AS (SELECT l0, a1, b1, avg({_huber_sql('(a1 * q + b1 - y)')}) AS l1,
           a1 - 0.001 * avg(({_huber_slope_sql('(a1 * q + b1 - y)')}) * q) AS a2,
           b1 - 0.001 * avg({_huber_slope_sql('(a1 * q + b1 - y)')}) AS b2 FROM h, g0 GROUP BY l0, a1, b1),
    g2 AS (SELECT l0, l1, a2, b2, avg({_huber_sql('(a2 * q + b2 - y)')}) AS l2 FROM h, g1 GROUP BY ALL)
    SELECT unnest(['w_quantity', 'w_bias', 'loss_0', 'loss_1', 'loss_2']) AS name,
           unnest([round(a2, 5), round(b2, 5), round(l0, 5), round(l1, 5), round(l2, 5)]) AS value FROM g2""",
)
def _(t: Tables) -> DataFrame:
    model = linear.fit_gd(
        _thousands(t), ["quantity", "bias"], "y", linear.Huber(4.0), linear.ConstantLR(0.001), max_iter=2
    )
    return _fitted(t, model)


# With one feature the squared loss at w is k - 2 b w + a w^2 and its slope 2 (a w - b).
_ONE = "m AS (SELECT avg(quantity * quantity) AS a, avg(quantity * y / 1000) AS b, avg(y * y / 1000000) AS k FROM house)"


def _steps_sql(steps: Sequence[str]) -> str:
    """Weights w1, w2, ... given by expressions over the earlier ones, with the losses."""
    ctes = [_ONE, "s0 AS (SELECT *, 0.0::DOUBLE AS w0 FROM m)"]
    for i, e in enumerate(steps, start=1):
        ctes.append(f"s{i} AS (SELECT *, {e} AS w{i} FROM s{i - 1})")
    n = len(steps)
    names = ["'w_quantity'"] + [f"'loss_{i}'" for i in range(n + 1)]
    values = [f"round(w{n}, 5)"] + [f"round(k - 2 * b * w{i} + a * w{i} * w{i}, 5)" for i in range(n + 1)]
    return f"WITH {', '.join(ctes)} SELECT unnest([{', '.join(names)}]) AS name, unnest([{', '.join(values)}]) AS value FROM s{n}"


@query(
    "ml14_squared_loss",
    _steps_sql([f"w{i} - 0.0002 * 2 * (a * w{i} - b)" for i in range(4)]),
)
def _(t: Tables) -> DataFrame:
    return _fitted(t, linear.fit_gd(_thousands(t), ["quantity"], "y", lr=linear.ConstantLR(0.0002), max_iter=4))


@query(
    "ml15_sgd",
    "SELECT round(avg(y * y / 1000000), 5) AS first_loss, true AS improved, CAST(13 AS BIGINT) AS n_losses FROM house",
)
def _(t: Tables) -> DataFrame:
    model = linear.fit_sgd(
        _thousands(t), ["quantity", "bias"], "y", HOUSE_ORDER[:4], lr=linear.ConstantLR(0.0003),
        batch_size=32, max_iter=12, tolerance=0.0, seed=3,
    )
    return _improvement(t, model)


@query(
    "ml16_sag",
    "SELECT round(avg(y * y / 1000000), 5) AS first_loss, true AS improved, CAST(9 AS BIGINT) AS n_losses FROM house",
)
def _(t: Tables) -> DataFrame:
    model = linear.fit_sag(
        _thousands(t), ["quantity", "bias"], "y", HOUSE_ORDER[:4], lr=linear.ConstantLR(0.05),
        batch_size=64, max_iter=8, tolerance=0.0, seed=3,
    )
    return _improvement(t, model)


_SAG_BLOCKS, _SAG_STEPS, _SAG_SEED = 4, 6, 11


def _block_sag_sql() -> str:
    """The steps of ``ml16_block_sag`` over sums a, b and n of each block; a slope sum is remembered until its block is drawn again."""
    sums = ", ".join(
        f"sum(quantity * quantity) FILTER (orderkey % {_SAG_BLOCKS} = {b}) AS a{b}, sum(quantity * y / 1000) FILTER (orderkey % {_SAG_BLOCKS} = {b}) AS b{b}"
        for b in range(_SAG_BLOCKS)
    )
    ones = "avg(quantity * quantity) AS a, avg(quantity * y / 1000) AS b, avg(y * y / 1000000) AS k, count(*) AS n"
    ctes, known = [f"s0 AS (SELECT {sums}, {ones}, 0.0::DOUBLE AS w0 FROM house)"], {}
    for i in range(_SAG_STEPS):
        known |= {b: f"2 * (a{b} * w{i} - b{b})" for b in linear.drawn_blocks(_SAG_SEED, i, _SAG_BLOCKS, 1)}
        ctes.append(f"s{i + 1} AS (SELECT *, w{i} - 0.0003 * ({' + '.join(known.values())}) / n AS w{i + 1} FROM s{i})")
    names = ["'w_quantity'"] + [f"'loss_{i}'" for i in range(_SAG_STEPS + 1)]
    values = [f"round(w{_SAG_STEPS}, 5)"] + [f"round(k - 2 * b * w{i} + a * w{i} * w{i}, 5)" for i in range(_SAG_STEPS + 1)]
    return f"WITH {', '.join(ctes)} SELECT unnest([{', '.join(names)}]) AS name, unnest([{', '.join(values)}]) AS value FROM s{_SAG_STEPS}"


@query("ml16_block_sag", _block_sag_sql())
def _(t: Tables) -> DataFrame:
    model = linear.fit_block_sag(
        _thousands(t), ["quantity"], "y", F.col("orderkey") % _SAG_BLOCKS, _SAG_BLOCKS, lr=linear.ConstantLR(0.0003),
        max_iter=_SAG_STEPS, tolerance=0.0, seed=_SAG_SEED,
    )
    return _fitted(t, model)


def _improvement(t: Tables, model: linear.LinearModel) -> DataFrame:
    h = model.loss_history
    row = (round(h[0], 5) + 0.0, bool(h[-1] < h[0]), len(h))
    return t.spark.createDataFrame([row], "first_loss double, improved boolean, n_losses long")


@query(
    "ml17_momentum",
    _steps_sql([
        "-(0.0002 * 2 * (a * w0 - b))",
        "w1 + 0.5 * (w1 - w0) - 0.0002 * 2 * (a * w1 - b)",
        "w2 + 0.5 * (w2 - w1) - 0.0002 * 2 * (a * w2 - b)",
    ]),
)
def _(t: Tables) -> DataFrame:
    return _fitted(
        t, linear.fit_momentum(_thousands(t), ["quantity"], "y", beta=0.5, lr=linear.ConstantLR(0.0002), max_iter=3)
    )


_G = [f"(2 * (a * w{i} - b))" for i in range(2)]


@query(
    "ml18_adam",
    _steps_sql([
        f"-0.1 * {_G[0]} / (abs({_G[0]}) + 1e-8)",
        f"""w1 - 0.1 * ((0.9 * 0.1 * {_G[0]} + 0.1 * {_G[1]}) / (1 - 0.81))
        / (sqrt((0.999 * 0.001 * pow({_G[0]}, 2) + 0.001 * pow({_G[1]}, 2)) / (1 - pow(0.999, 2))) + 1e-8)""",
    ]),
)
def _(t: Tables) -> DataFrame:
    return _fitted(t, linear.fit_adam(_thousands(t), ["quantity"], "y", lr=linear.ConstantLR(0.1), max_iter=2))


@query(
    "ml19_time_decay",
    _steps_sql([f"w{i} - 0.0004 * sqrt(1.0 / (1 + {i})) * 2 * (a * w{i} - b)" for i in range(3)]),
)
def _(t: Tables) -> DataFrame:
    return _fitted(t, linear.fit_gd(_thousands(t), ["quantity"], "y", lr=linear.TimeDecayLR(0.0004), max_iter=3))


@query(
    "ml20_predict",
    """SELECT orderkey, linenumber, partkey, round(1500 * quantity - 20 * tax + 3, 4) AS prediction FROM house""",
)
def _(t: Tables) -> DataFrame:
    model = linear.LinearModel(("quantity", "tax", "bias"), np.array([1500.0, -20.0, 3.0]))
    return model.predict(t.house).select("orderkey", "linenumber", "partkey", r("prediction", 4).alias("prediction"))


# --- searches and validation -----------------------------------------------------------------

@query(
    "ml21_grid_search",
    """WITH x AS (SELECT o_orderkey AS k, CAST(o_custkey AS DOUBLE) AS x, o_totalprice / 1000 AS y,
            row_number() OVER (ORDER BY o_orderkey) - 1 AS rw, count(*) OVER () AS n FROM orders),
    f AS (SELECT *, CASE WHEN rw < (n % 5) * (n // 5 + 1) THEN rw // (n // 5 + 1) ELSE (rw - n % 5) // (n // 5) END AS fold FROM x),
    al AS (SELECT unnest([0.01, 1000000.0, 100000000000.0]) AS alpha), fs AS (SELECT unnest(range(5)) AS fold),
    w AS (SELECT alpha, fs.fold AS fold, covar_pop(y, x) * count(*) / (var_pop(x) * count(*) + alpha) AS w, avg(x) AS mx, avg(y) AS my
          FROM f, al, fs WHERE f.fold <> fs.fold GROUP BY alpha, fs.fold)
    SELECT alpha::DOUBLE AS alpha, CAST(f.fold AS INTEGER) AS fold, round(sqrt(avg(pow(y - (my + w * (x - mx)), 2))), 6) AS rmse
    FROM f JOIN w USING (fold) GROUP BY alpha, f.fold""",
)
def _(t: Tables) -> DataFrame:
    x = t.orders.select("o_orderkey", F.col("o_custkey").cast("double").alias("x"), (F.col("o_totalprice") / 1000).alias("y"))
    found = search.grid_search(x, ["x"], "y", [0.01, 1e6, 1e11], 5, ["o_orderkey"])
    return found.table(t.spark).withColumn("rmse", r("rmse"))


@query(
    "ml21_lasso_scores",
    """WITH x AS (SELECT o_orderkey AS k, CAST(o_custkey AS DOUBLE) AS x, o_totalprice / 1000 AS y,
            row_number() OVER (ORDER BY o_orderkey) - 1 AS rw, count(*) OVER () AS n FROM orders),
    f AS (SELECT *, CASE WHEN rw < (n % 5) * (n // 5 + 1) THEN rw // (n // 5 + 1) ELSE (rw - n % 5) // (n // 5) END AS fold FROM x),
    al AS (SELECT unnest([1000000.0, 0.01, 20.0]) AS alpha), fs AS (SELECT unnest(range(5)) AS fold),
    w AS (SELECT alpha, fs.fold AS fold, sign(covar_pop(y, x)) * greatest(abs(covar_pop(y, x)) - alpha, 0) / var_pop(x) AS w, avg(x) AS mx, avg(y) AS my
          FROM f, al, fs WHERE f.fold <> fs.fold GROUP BY alpha, fs.fold)
    SELECT alpha::DOUBLE AS alpha, CAST(f.fold AS INTEGER) AS fold, round(sqrt(avg(pow(y - (my + w * (x - mx)), 2))), 6) AS rmse
    FROM f JOIN w USING (fold) GROUP BY alpha, f.fold""",
)
def _(t: Tables) -> DataFrame:
    x = t.orders.select("o_orderkey", F.col("o_custkey").cast("double").alias("x"), (F.col("o_totalprice") / 1000).alias("y"))
    found = search.grid_search(x, ["x"], "y", [1e6, 0.01, 20.0], 5, ["o_orderkey"], "lasso")
    return found.table(t.spark).withColumn("rmse", r("rmse"))


@query("ml21_grid_search_lasso", "SELECT true AS best_is_least, CAST(25 AS BIGINT) AS n_fits, true AS some_zero FROM (SELECT count(*) FROM house)")
def _(t: Tables) -> DataFrame:
    found = search.grid_search(
        _thousands(t), HOUSE_X, "y", [float(a) for a in np.logspace(-2, 2, 5)], 5, HOUSE_ORDER, "lasso"
    )
    means = found.scores.mean(axis=1)
    strongest = linear.fit_lasso(_thousands(t), HOUSE_X, "y", 1.0)
    row = (bool(means.min() == means[found.alphas.index(found.best_alpha)]), int(found.scores.size), strongest.zeros > 0)
    return t.spark.createDataFrame([row], "best_is_least boolean, n_fits long, some_zero boolean")


_RATING = {"numeric": ("avg_mmr", "mmr_missing")}
_BASE = FeatureConfig({"ohe": ("region", "game_mode", "month", "is_weekend"), **_RATING}, mmr_transform="sqrt")

SEARCH_SPACE = {
    "penalty": search.Choice(("l1", "l2", "elasticnet", None)),
    "C": search.LogUniform(1e-4, 1e2),
    "tol": search.LogUniform(1e-6, 1e-2),
    "max_iter": search.IntStep(200, 3000, 500),
    "class_weight": search.Choice((None, "balanced")),
    "l1_ratio": search.OnlyIf("penalty", "elasticnet", search.Uniform(0.0, 1.0)),
}


@query(
    "ml22_random_search",
    """SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS trial, true AS in_range, CAST(2 AS INTEGER) AS n_folds
       FROM (SELECT count(*) FROM matches)""",
)
def _(t: Tables) -> DataFrame:
    folds = fold_tables(t.matches, FeatureConfig({"target": ("region",), **_RATING}, mmr_transform="sqrt"), n_splits=2)
    board = search.random_search(
        t.spark, lambda params: score_folds(folds, params), SEARCH_SPACE, 3, 5, {"groups": ["region_te", "avg_mmr"]}
    )
    return board.select(
        "trial", F.col("mean_score").between(-1, 1).alias("in_range"), F.size("fold_scores").alias("n_folds")
    )


@query(
    "ml23_cross_validate",
    f"""WITH {_FOLDS.format(k=3, k1=4)} SELECT CAST(fold AS INTEGER) AS fold, CAST(b - a AS BIGINT) AS n_valid,
    CAST(a AS BIGINT) AS n_train, true AS in_range FROM fd""",
)
def _(t: Tables) -> DataFrame:
    folds = fold_features(t.matches, _BASE, n_splits=3)
    mean, ginis = score_folds(folds)
    rows = [
        (i, f.other.count(), f.train.count(), bool(-1 <= g <= 1 and -1 <= mean <= 1))
        for i, (f, g) in enumerate(zip(folds, ginis), start=1)
    ]
    return t.spark.createDataFrame(rows, "fold int, n_valid long, n_train long, in_range boolean")


# With the smoothed region alone, a score rises with the encoding: Gini and order of the scores follow from it.
_RISING = FeatureConfig({"target": ("region",)})
_WEIGHT = "1 / (1 + exp(-(n - 20) / 10.0))"


@query(
    "ml23_fold_ginis",
    f"""WITH rr AS (SELECT *, row_number() OVER (ORDER BY date NULLS LAST, match_id) - 1 AS rw FROM matches), {_FOLDS.format(k=3, k1=4)},
    te AS (SELECT fold, region, count(*) AS n, avg(radiant_win) AS m FROM rr JOIN fd ON rr.rw < a GROUP BY fold, region),
    pr AS (SELECT fold, sum(n * m) / sum(n) AS prior FROM te GROUP BY fold),
    v AS (SELECT fd.fold, radiant_win AS y, coalesce(prior * (1 - {_WEIGHT}) + m * {_WEIGHT}, prior) AS s
          FROM rr JOIN fd ON rr.rw >= a AND rr.rw < b JOIN pr ON pr.fold = fd.fold LEFT JOIN te ON te.fold = fd.fold AND te.region = rr.region),
    k AS (SELECT fold, y, rank() OVER (PARTITION BY fold ORDER BY s) + (count(*) OVER (PARTITION BY fold, s) - 1) / 2.0 AS rk FROM v),
    p AS (SELECT fold, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q, sum(rk) FILTER (y = 1) AS rs FROM k GROUP BY fold)
    SELECT CAST(fold AS INTEGER) AS fold, round(2 * ((rs - p * (p + 1) / 2.0) / (p * q)) - 1, 8) AS gini FROM p""",
)
def _(t: Tables) -> DataFrame:
    _, ginis = cross_validate(t.matches, _RISING, n_splits=3)
    return t.spark.createDataFrame([(i, round(g, 8) + 0.0) for i, g in enumerate(ginis, start=1)], "fold int, gini double")


@query(
    "ml24_score_order",
    f"""WITH te AS (SELECT region, count(*) AS n, avg(radiant_win) AS m FROM matches WHERE match_id % 4 <> 0 GROUP BY region),
    pr AS (SELECT sum(n * m) / sum(n) AS prior FROM te)
    SELECT match_id, CAST(dense_rank() OVER (ORDER BY coalesce(prior * (1 - {_WEIGHT}) + m * {_WEIGHT}, prior)) AS INTEGER) AS place
    FROM matches LEFT JOIN te USING (region), pr WHERE match_id % 4 = 0""",
)
def _(t: Tables) -> DataFrame:
    late = F.col("match_id") % 4 == 0
    _, scored = fit_and_predict(t.matches.filter(~late), t.matches.filter(late).drop("radiant_win"), _RISING)
    scored = materialise(scored)
    # As many distinct scores as regions.
    places = scored.select("score").distinct().withColumn("place", F.dense_rank().over(Window.orderBy("score")))
    return scored.join(F.broadcast(places), "score").select("match_id", "place")


@query(
    "ml24_fit_predict",
    "SELECT match_id, true AS is_share FROM matches WHERE match_id % 4 = 0",
)
def _(t: Tables) -> DataFrame:
    late = F.col("match_id") % 4 == 0
    _, scored = fit_and_predict(t.matches.filter(~late), t.matches.filter(late).drop("radiant_win"), _BASE)
    return scored.select("match_id", F.col("score").between(0, 1).alias("is_share"))


@query(
    "ml25_segmented",
    """WITH s AS (SELECT quantity <= 25 AS low, covar_pop(retail, y) * count(*) / (var_pop(retail) * count(*) + 1) AS w,
                  avg(retail) AS mx, avg(y) AS my FROM house GROUP BY 1)
    SELECT orderkey, linenumber, partkey, round(my + w * (retail - mx), 2) AS prediction FROM house JOIN s ON low = (quantity <= 25)""",
)
def _(t: Tables) -> DataFrame:
    models = linear.fit_segmented(t.house, ["retail"], "y", "quantity", 25.0)
    out = linear.predict_segmented(t.house, models, "quantity", 25.0)
    return out.select("orderkey", "linenumber", "partkey", r("prediction", 2).alias("prediction"))


@query(
    "ml26_log_target",
    """WITH s AS (SELECT regr_slope(ln(y), quantity) AS w, regr_intercept(ln(y), quantity) AS b FROM house)
    SELECT orderkey, linenumber, partkey, round(exp(b + w * quantity), 2) AS prediction FROM house, s""",
)
def _(t: Tables) -> DataFrame:
    model = fit_log_target(t.house, ["quantity"], "y")
    return model.predict(t.house).select("orderkey", "linenumber", "partkey", r("prediction", 2).alias("prediction"))


@query(
    "ml26_quantile_target",
    "SELECT orderkey, linenumber, partkey, true AS in_range FROM house",
)
def _(t: Tables) -> DataFrame:
    model = fit_transformed_target(t.house, HOUSE_X, "y", alpha=None, order=HOUSE_ORDER)
    lo, hi = t.house.agg(F.min("y"), F.max("y")).first()
    out = model.predict(t.house)
    return out.select("orderkey", "linenumber", "partkey", F.col("prediction").between(lo, hi).alias("in_range"))


@query("ml27_run", 'SELECT match_id AS "ID", true AS is_share FROM matches WHERE match_id % 4 = 0')
def _(t: Tables) -> DataFrame:
    late = F.col("match_id") % 4 == 0
    root = scratch_path(t.spark, "run")
    run = Run(
        FeatureSelection(enabled=("region_ohe", "avg_mmr"), use_heroes=True),
        results_path=f"{root}/results", submission_path=f"{root}/submission", n_splits=2, group_size=GROUP_SIZE,
    )
    out = run(
        t.matches.filter(~late), t.matches.filter(late).drop("radiant_win"), players=t.players, heroes=t.heroes
    )
    return out["submission"].select("ID", F.col("Value").between(0, 1).alias("is_share"))


@query(
    "ml28_weights_report",
    f"""WITH {_RIDGE.format(alpha=1, source='house')} SELECT 'quantity' AS feature, round(w1, 4) AS weight,
    (SELECT round(stddev_samp(quantity), 6) FROM house) AS scale FROM rw
    UNION ALL SELECT 'size', round(w2, 4), (SELECT round(stddev_samp(size), 6) FROM house) FROM rw""",
)
def _(t: Tables) -> DataFrame:
    x = ["quantity", "size"]
    model = linear.fit_ridge(t.house, x, "y")
    scales = t.house.agg(*[F.stddev_samp(c).alias(c) for c in x]).first().asDict()
    report = linear.weights_report(t.spark, model, scales)
    return report.select("feature", r("weight", 4).alias("weight"), r("scale").alias("scale"))


# --- metrics ------------------------------------------------------------------------------------

@query(
    "me1_gini",
    """WITH s AS (SELECT radiant_win AS y, floor(coalesce(avg_mmr, 0) / 50) AS s FROM matches),
    k AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM s),
    p AS (SELECT count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q, sum(rk) FILTER (y = 1) AS rs FROM k)
    SELECT round(2 * ((rs - p * (p + 1) / 2.0) / (p * q)) - 1, 8) AS gini FROM p""",
)
def _(t: Tables) -> DataFrame:
    scored = t.matches.withColumn("score", F.floor(F.coalesce("avg_mmr", F.lit(0.0)) / 50))
    return metrics.gini_table(scored, "radiant_win", "score").withColumn("gini", r("gini", 8))


_GUESS = "pg AS (SELECT y, quantity * retail AS p, flag FROM house)"


def _guess(t: Tables) -> DataFrame:
    return t.house.withColumn("p", F.col("quantity") * F.col("retail"))


@query("me2_rmse", f"WITH {_GUESS} SELECT flag, round(sqrt(avg(pow(y - p, 2))), 4) AS rmse FROM pg GROUP BY flag")
def _(t: Tables) -> DataFrame:
    return _guess(t).groupBy("flag").agg(r(metrics.rmse("y", "p"), 4).alias("rmse"))


@query("me3_mae", f"WITH {_GUESS} SELECT flag, round(avg(abs(y - p)), 4) AS mae FROM pg GROUP BY flag")
def _(t: Tables) -> DataFrame:
    return _guess(t).groupBy("flag").agg(r(metrics.mae("y", "p"), 4).alias("mae"))


@query(
    "me4_constant_baseline",
    """WITH h AS (SELECT y, orderkey % 10 < 7 AS tr FROM house), m AS (SELECT avg(y) AS c FROM h WHERE tr)
    SELECT CASE WHEN tr THEN 'train' ELSE 'test' END AS part, round(sqrt(avg(pow(y - c, 2))), 4) AS rmse FROM h, m GROUP BY tr""",
)
def _(t: Tables) -> DataFrame:
    a, b = splits.split_at(t.house, F.col("orderkey") % 10, 7)
    return metrics.constant_baseline(a, b, "y").withColumn("rmse", r("rmse", 4))


@query("me5_scorer", f"WITH {_GUESS} SELECT round(-sqrt(avg(pow(y - p, 2))), 4) AS score FROM pg")
def _(t: Tables) -> DataFrame:
    scorer = metrics.make_scorer(metrics.rmse, greater_is_better=False)
    return scorer.table(_guess(t), "y", "p").withColumn("score", r("score", 4))
