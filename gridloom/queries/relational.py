"""Sources, projections, joins, aggregates, windows, sorts and set operators."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators import frame, joins, ordered, profile
from gridloom.operators.clean import fit_fill_stats
from gridloom.operators.reshape import collect_ordered
from gridloom.plans.allocation import ASSIGNMENT, build_applications
from gridloom.queries.catalog import query
from gridloom.queries.inputs import CAPACITY, DEFAULT_CAPACITY, LATER_PREFS, PREFS, Tables, r
from gridloom.sources import sinks
from gridloom.sources.scratch import materialise, scratch_path
from gridloom.sources.tables import read_csv, read_table


# --- sources and sinks ---------------------------------------------------------

@query("io1_read_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer")
    sinks.write_csv(t.customer, path)
    return read_csv(t.spark, path, t.customer.schema)


@query("io2_read_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t: Tables) -> DataFrame:
    return read_table(
        t.spark, f"{t.folder}/supplier.parquet", "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
    )


@query("io3_write_csv", "SELECT id, required, p1, p2 FROM survey")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "survey")
    sinks.write_csv(t.survey.select("id", "required", "p1", "p2"), path)
    return read_csv(t.spark, path, "id string, required long, p1 string, p2 string")


@query("io4_submission", "SELECT match_id AS ID, round(coalesce(avg_mmr, 0) / 10000, 6) AS Value FROM matches")
def _(t: Tables) -> DataFrame:
    scored = t.matches.select("match_id", r(F.coalesce("avg_mmr", F.lit(0.0)) / 10000).alias("score"))
    return sinks.save_test_predictions(t.matches, scored, scratch_path(t.spark, "submission"))


@query(
    "io5_run_record",
    """WITH s AS (SELECT region, avg(radiant_win) AS m FROM matches GROUP BY region)
    SELECT round(avg(m), 6) AS cv_mean_gini, CAST(count(*) AS BIGINT) AS n_folds, round(max(m), 6) AS best FROM s""",
)
def _(t: Tables) -> DataFrame:
    # One score per region stands in for one score per fold.
    scores = [row["rate"] for row in t.matches.groupBy("region").agg(F.avg("radiant_win").alias("rate")).collect()]
    record = sinks.run_record(sum(scores) / len(scores), scores)
    saved = sinks.save_run_record(t.spark, record, scratch_path(t.spark, "record"))
    return saved.select(
        r("cv_mean_gini").alias("cv_mean_gini"),
        F.size("cv_fold_ginis").cast("long").alias("n_folds"),
        F.array_max("cv_fold_ginis").alias("best"),
    )


@query(
    "io6_model_save_load",
    "SELECT p_brand, CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS n_same FROM part GROUP BY p_brand",
)
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "model")
    model = StringIndexer(inputCol="p_brand", outputCol="code").fit(t.part)
    sinks.save(model, path)
    again = sinks.load(StringIndexerModel, path).setOutputCol("code_again")
    both = again.transform(model.transform(t.part))
    return both.groupBy("p_brand").agg(
        F.count("*").alias("n"), F.count_if(F.col("code") == F.col("code_again")).alias("n_same")
    )


@query(
    "io7_repeat_rows",
    "SELECT user_id, CAST(3 * count(*) AS BIGINT) AS n, round(3 * sum(value), 2) AS total FROM events GROUP BY user_id",
)
def _(t: Tables) -> DataFrame:
    copies = frame.repeat_df(t.events.withColumnRenamed("ts", "timestamp"), 3)
    return copies.groupBy("user_id").agg(F.count("*").alias("n"), r(F.sum("value"), 2).alias("total"))


@query(
    "io8_empty_table",
    "SELECT id, p1 AS course, CAST(1 AS BIGINT) AS wave, CAST(1 AS BIGINT) AS pref_order FROM survey WHERE p1 IS NOT NULL",
)
def _(t: Tables) -> DataFrame:
    one = F.lit(1).cast("long")
    rows = t.survey.filter("p1 IS NOT NULL").select("id", F.col("p1").alias("course"), one.alias("wave"), one.alias("pref_order"))
    return frame.empty(t.spark, ASSIGNMENT).unionByName(rows)


# --- projections, filters, schema work -----------------------------------------

@query("pf1_select", "SELECT o_orderkey AS id, CAST(floor(o_totalprice) AS BIGINT) AS price, o_orderstatus AS status FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.floor("o_totalprice").cast("long").alias("price"),
        F.col("o_orderstatus").alias("status"),
    )


@query(
    "pf2_with_columns",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS net,
       l_quantity >= 25 AS is_large FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    added = t.lineitem.withColumns({
        "net": r(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4),
        "is_large": F.col("l_quantity") >= 25,
    })
    return added.select("l_orderkey", "l_linenumber", "l_partkey", "net", "is_large")


@query("pf3_drop", "SELECT s_suppkey, s_nationkey FROM supplier")
def _(t: Tables) -> DataFrame:
    return t.supplier.drop("s_name", "s_acctbal")


@query(
    "pf4_filter_compare",
    """SELECT match_id, account_id, hero_id, player_slot FROM players
       WHERE (account_id IS NULL OR account_id <> -1) AND player_slot >= 128""",
)
def _(t: Tables) -> DataFrame:
    return t.players.filter(frame.not_equal("account_id", -1) & (F.col("player_slot") >= 128))


@query(
    "pf5_null_predicates",
    """SELECT id, p1, p3 FROM survey
       WHERE (p6 IS NOT NULL OR p1 IS NULL) AND NOT (p3 IS NULL OR p3 = '')""",
)
def _(t: Tables) -> DataFrame:
    keep = (F.col("p6").isNotNull() | F.col("p1").isNull()) & ~(F.col("p3").isNull() | (F.col("p3") == ""))
    return t.survey.filter(keep).select("id", "p1", "p3")


@query(
    "pf6_is_in",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def _(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("pf7_between", "SELECT event_id, value FROM events WHERE value BETWEEN 5 AND 12.5")
def _(t: Tables) -> DataFrame:
    return t.events.filter(F.col("value").between(5, 12.5)).select("event_id", "value")


@query(
    "pf8_case_when",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_totalprice > 200000 THEN 'done-large'
       ELSE 'done-small' END WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS state FROM orders""",
)
def _(t: Tables) -> DataFrame:
    done = F.when(F.col("o_totalprice") > 200000, "done-large").otherwise("done-small")
    state = F.when(F.col("o_orderstatus") == "F", done).when(F.col("o_orderstatus") == "O", "open").otherwise("other")
    return t.orders.select("o_orderkey", state.alias("state"))


@query(
    "pf9_mask_split",
    """SELECT match_id, CASE WHEN coalesce(avg_mmr > 5000, false) THEN 'yes' ELSE 'no' END AS part FROM matches""",
)
def _(t: Tables) -> DataFrame:
    yes, no = frame.partition_by_mask(t.matches, F.col("avg_mmr") > 5000)
    return yes.select("match_id", F.lit("yes").alias("part")).unionByName(no.select("match_id", F.lit("no").alias("part")))


@query(
    "pf10_fill_by_type",
    """SELECT id, coalesce(p3, '') AS p3, coalesce(p6, '') AS p6,
       CASE WHEN custkey % 11 = 0 THEN 0 ELSE custkey END AS num,
       CASE WHEN custkey % 13 = 0 OR custkey % 17 = 0 THEN 0.0 ELSE round(percentile, 6) END AS share,
       CASE WHEN custkey % 3 = 0 THEN false ELSE required = 2 END AS flag FROM survey""",
)
def _(t: Tables) -> DataFrame:
    k = F.col("custkey")
    holes = t.survey.select(
        "id", "p3", "p6",
        F.when(k % 11 != 0, k).alias("num"),
        F.when(k % 17 == 0, float("nan")).when(k % 13 != 0, r("percentile")).alias("share"),
        F.when(k % 3 != 0, F.col("required") == 2).alias("flag"),
    )
    return frame.fill_by_type(holes)


@query(
    "pf11_drop_nulls",
    """SELECT match_id, account_id, hero_id, player_slot, 'any' AS form FROM players
       WHERE account_id IS NOT NULL AND hero_id IS NOT NULL
       UNION ALL SELECT match_id, account_id, hero_id, player_slot, 'subset' FROM players WHERE hero_id IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    some = frame.drop_nulls(t.players).withColumn("form", F.lit("any"))
    return some.unionByName(frame.drop_nulls(t.players, ["hero_id"]).withColumn("form", F.lit("subset")))


@query(
    "pf12_to_numeric",
    """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END
       AS BIGINT) AS code FROM orders""",
)
def _(t: Tables) -> DataFrame:
    mixed = F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string"))
    return frame.to_numeric(t.orders.select("o_orderkey", mixed.alias("code")), ["code", "absent"])


@query(
    "pf13_align",
    """SELECT s_suppkey, CAST(s_acctbal AS DOUBLE) AS s_acctbal, CAST(NULL AS VARCHAR) AS s_region FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    return frame.align(t.supplier, {"s_suppkey": "long", "s_acctbal": "double", "s_region": "string"})


@query(
    "pf14_cols_of_type",
    """SELECT p_partkey, p_size, p_retailprice, upper(p_name) AS p_name, upper(p_brand) AS p_brand,
       upper(p_type) AS p_type FROM part""",
)
def _(t: Tables) -> DataFrame:
    text = frame.cols_of_type(t.part, (T.StringType,))
    return t.part.select(*frame.numeric_cols(t.part), *[F.upper(c).alias(c) for c in text])


@query(
    "pf15_shift_priorities",
    """SELECT id, CASE WHEN g THEN p5 ELSE p4 END AS p4, CASE WHEN g THEN p6 ELSE p5 END AS p5,
       CASE WHEN g THEN '' ELSE p6 END AS p6
       FROM (SELECT *, coalesce(required = 2 AND p4 = 'Supplier#000000003', false) AS g FROM survey)""",
)
def _(t: Tables) -> DataFrame:
    moved = frame.shift_priorities(t.survey, LATER_PREFS, "Supplier#000000003", F.col("required") == 2)
    return moved.select("id", *LATER_PREFS)


@query(
    "pf16_lookup",
    """SELECT s_name, CAST(CASE s_name WHEN 'Supplier#000000003' THEN 25 WHEN 'Supplier#000000007' THEN 40 ELSE 10 END
       AS BIGINT) AS capacity FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    return t.supplier.select("s_name", frame.lookup("s_name", CAPACITY, DEFAULT_CAPACITY).cast("long").alias("capacity"))


@query("pf17_fill_null", "SELECT match_id, coalesce(avg_mmr, -1) AS avg_mmr FROM matches")
def _(t: Tables) -> DataFrame:
    return t.matches.select("match_id", frame.fill_null("avg_mmr", -1.0).alias("avg_mmr"))


@query(
    "pf18_required",
    """SELECT id, segment IN ('BUILDING', 'MACHINERY') OR (nation <> 0 AND custkey % 2 = 1) AS is_special,
       CAST(CASE WHEN segment IN ('BUILDING', 'MACHINERY') THEN 2 ELSE 1 END AS BIGINT) AS courses FROM survey""",
)
def _(t: Tables) -> DataFrame:
    flagged = frame.with_required(
        t.survey, "segment", ["BUILDING", "MACHINERY"], F.col("nation") != 0, F.col("custkey") % 2 == 1, "courses"
    )
    return flagged.select("id", "is_special", "courses")


# --- joins -----------------------------------------------------------------------

@query(
    "jn1_inner_join",
    """SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return joins.inner(t.orders, c, "o_custkey").select("o_orderkey", "o_custkey", "c_mktsegment")


@query(
    "jn2_left_join",
    """SELECT c_custkey, n FROM customer LEFT JOIN
       (SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def _(t: Tables) -> DataFrame:
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return joins.left(t.customer.select("c_custkey"), per, "c_custkey")


@query(
    "jn3_semi_join",
    """SELECT match_id, hero_id, player_slot FROM players WHERE match_id IN
       (SELECT match_id FROM matches WHERE avg_mmr IS NULL)""",
)
def _(t: Tables) -> DataFrame:
    ids = t.matches.filter("avg_mmr IS NULL").select("match_id")
    return joins.filter_by_ids(t.players, ids, "match_id").select("match_id", "hero_id", "player_slot")


@query(
    "jn4_anti_join",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def _(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.anti(t.orders.select("o_orderkey", "o_custkey"), lines, "o_orderkey")


@query(
    "jn5_anti_join_two_keys",
    """SELECT l_orderkey, l_suppkey, l_linenumber FROM lineitem a WHERE NOT EXISTS
       (SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'R' AND a.l_orderkey = b.l_orderkey AND a.l_suppkey = b.l_suppkey)""",
)
def _(t: Tables) -> DataFrame:
    returned = t.lineitem.filter("l_returnflag = 'R'")
    kept = joins.anti(t.lineitem, returned, ["l_orderkey", "l_suppkey"])
    return kept.select("l_orderkey", "l_suppkey", "l_linenumber")


@query(
    "jn6_null_safe_join",
    """WITH m AS (SELECT match_id, CASE WHEN region <> 'ASIA' THEN region END AS region, game_mode, avg_mmr FROM matches),
    s AS (SELECT region, game_mode, round(avg(avg_mmr), 4) AS mean_mmr FROM m GROUP BY ALL)
    SELECT match_id, m.region AS region, m.game_mode AS game_mode, mean_mmr FROM m LEFT JOIN s
    ON m.region IS NOT DISTINCT FROM s.region AND m.game_mode IS NOT DISTINCT FROM s.game_mode""",
)
def _(t: Tables) -> DataFrame:
    m = t.matches.select("match_id", F.nullif("region", F.lit("ASIA")).alias("region"), "game_mode", "avg_mmr")
    s = m.groupBy("region", "game_mode").agg(r(F.avg("avg_mmr"), 4).alias("mean_mmr"))
    return joins.lookup_null_safe(m.drop("avg_mmr"), s, ["region", "game_mode"])


@query(
    "jn7_lookup_ordered",
    """SELECT o_orderkey, o_custkey AS doc_id, coalesce(lang, '') AS lang FROM orders LEFT JOIN documents ON o_custkey = doc_id""",
)
def _(t: Tables) -> DataFrame:
    ids = t.orders.select("o_orderkey", F.col("o_custkey").alias("doc_id"))
    return joins.lookup_ordered(ids, t.documents, "doc_id", "lang").select("o_orderkey", "doc_id", "lang")


@query(
    "jn8_split_by_ids",
    """SELECT match_id, hero_id, player_slot, CASE WHEN match_id % 4 = 0 THEN 'test' ELSE 'train' END AS part
       FROM players""",
)
def _(t: Tables) -> DataFrame:
    held_out = F.col("match_id") % 4 == 0
    a, b = joins.split_by_ids(
        t.players, t.matches.filter(~held_out), t.matches.filter(held_out), "match_id"
    )
    both = a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test")))
    return both.select("match_id", "hero_id", "player_slot", "part")


# --- aggregates -------------------------------------------------------------------

@query("ag1_row_count", "SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem")
def _(t: Tables) -> DataFrame:
    return frame.row_count(t.lineitem)


@query("ag2_distinct_count", "SELECT CAST(count(DISTINCT l_partkey) AS BIGINT) AS n FROM lineitem WHERE l_returnflag = 'R'")
def _(t: Tables) -> DataFrame:
    return profile.distinct_count(t.lineitem, "l_partkey", F.col("l_returnflag") == "R")


@query(
    "ag3_null_counts",
    """SELECT 'match_id' AS column_name, CAST(count(*) FILTER (match_id IS NULL) AS BIGINT) AS nulls FROM players
       UNION ALL SELECT 'account_id', count(*) FILTER (account_id IS NULL) FROM players
       UNION ALL SELECT 'hero_id', count(*) FILTER (hero_id IS NULL) FROM players
       UNION ALL SELECT 'player_slot', count(*) FILTER (player_slot IS NULL) FROM players""",
)
def _(t: Tables) -> DataFrame:
    return profile.null_counts(t.players)


@query(
    "ag4_group_having",
    """SELECT p1, p2, CAST(count(*) AS BIGINT) AS n FROM survey GROUP BY p1, p2 HAVING count(*) > 1""",
)
def _(t: Tables) -> DataFrame:
    return profile.group_count(t.survey, ["p1", "p2"], F.col("n") > 1)


@query(
    "ag5_value_share",
    """SELECT region, CAST(count(*) AS BIGINT) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent
       FROM matches GROUP BY region""",
)
def _(t: Tables) -> DataFrame:
    return profile.value_share(t.matches, "region").withColumn("percent", r("percent"))


@query(
    "ag6_group_mean",
    """SELECT p1, round(avg(percentile), 6) AS mean_percentile, CAST(count(*) AS BIGINT) AS n FROM survey GROUP BY p1""",
)
def _(t: Tables) -> DataFrame:
    return profile.group_mean(t.survey, "p1", "percentile", "mean_percentile", "n").withColumn(
        "mean_percentile", r("mean_percentile")
    )


@query(
    "ag7_target_rate",
    """SELECT 'date' AS unit, strftime(date, '%Y-%m-%d') AS key, round(avg(radiant_win), 6) AS rate FROM matches GROUP BY 2
       UNION ALL SELECT 'weekday', CAST(isodow(date) - 1 AS VARCHAR), round(avg(radiant_win), 6) FROM matches GROUP BY 2
       UNION ALL SELECT 'month', CAST(month(date) AS VARCHAR), round(avg(radiant_win), 6) FROM matches GROUP BY 2
       UNION ALL SELECT 'weekend', CAST(isodow(date) >= 6 AS VARCHAR), round(avg(radiant_win), 6) FROM matches GROUP BY 2""",
)
def _(t: Tables) -> DataFrame:
    parts = [
        profile.target_rate(t.matches, "date", u, "radiant_win").select(
            F.lit(u).alias("unit"), F.col(u).cast("string").alias("key"), r("rate").alias("rate")
        )
        for u in ("date", "weekday", "month", "weekend")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "ag8_group_nunique",
    """SELECT match_id, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT hero_id)
       + max(CASE WHEN hero_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_items FROM players GROUP BY match_id
       HAVING n_rows <> n_items""",
)
def _(t: Tables) -> DataFrame:
    return profile.group_nunique(t.players, "match_id", "hero_id", count_null=True).filter("n_rows <> n_items")


@query(
    "ag9_group_count_if",
    "SELECT match_id, CAST(count(*) FILTER (hero_id = 0) AS BIGINT) AS n_zero FROM players GROUP BY match_id",
)
def _(t: Tables) -> DataFrame:
    return profile.group_count_if(t.players, "match_id", F.col("hero_id") == 0, "n_zero")


_APPLICATIONS = """
    SELECT id, percentile, required, course, pref_order,
           CASE WHEN pref_order = 1 THEN 1 WHEN required = 2 THEN pref_order - 1 ELSE pref_order END AS wave
    FROM (SELECT id, percentile, required, course, CAST(pref_order AS BIGINT) AS pref_order,
                 row_number() OVER (PARTITION BY id, course ORDER BY pref_order) AS nth
          FROM (SELECT id, percentile, required, p1 AS course, 1 AS pref_order FROM survey
                UNION ALL SELECT id, percentile, required, p2, 2 FROM survey
                UNION ALL SELECT id, percentile, required, p3, 3 FROM survey)
          WHERE course IS NOT NULL AND course <> '') WHERE nth = 1"""


@query(
    "ag10_collect_ordered",
    f"""WITH app AS ({_APPLICATIONS})
    SELECT id, string_agg(course, ',' ORDER BY wave, pref_order) AS courses FROM app GROUP BY id""",
)
def _(t: Tables) -> DataFrame:
    lists = collect_ordered(build_applications(t.survey, PREFS, "required"), "id", "course", ["wave", "pref_order"], "courses")
    return lists.select("id", F.array_join("courses", ",").alias("courses"))


def _describe_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS "count",
        CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS nulls, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(max({c}), 4) AS max,
        round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
        round(quantile_cont({c}, 0.75), 4) AS q75 FROM {table}"""
        for c in cols
    )


@query("ag11_describe", _describe_sql("matches", ["match_id", "avg_mmr", "radiant_win"]))
def _(t: Tables) -> DataFrame:
    d = profile.describe(t.matches, ["match_id", "avg_mmr", "radiant_win"])
    stats = ["mean", "std", "min", "max", "q25", "q50", "q75"]
    return d.select("column_name", "count", "nulls", *[r(s, 4).alias(s) for s in stats])


@query(
    "ag12_group_median",
    "SELECT substr(id, 1, 1) AS first_letter, round(median(percentile), 6) AS median FROM survey GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    lettered = t.survey.select(F.substring("id", 1, 1).alias("first_letter"), "percentile")
    return ordered.group_median(lettered, "first_letter", "percentile").withColumn("median", r("median"))


@query(
    "ag13_bootstrap_ci",
    """SELECT substr(id, 1, 1) AS first_letter, round(median(percentile), 6) AS median, true AS inside,
       true AS within_range FROM survey GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    lettered = t.survey.select(F.substring("id", 1, 1).alias("first_letter"), "percentile")
    ci = profile.bootstrap_ci(lettered, "first_letter", "percentile", level=0.96, replicates=500, seed=7)
    spread = lettered.groupBy("first_letter").agg(F.min("percentile").alias("lo"), F.max("percentile").alias("hi"))
    return ci.join(spread, "first_letter").select(
        "first_letter",
        r("median").alias("median"),
        F.col("median").between(F.col("low"), F.col("high")).alias("inside"),
        ((F.col("low") >= F.col("lo")) & (F.col("high") <= F.col("hi"))).alias("within_range"),
    )


@query(
    "ag14_quantiles",
    """SELECT p, round(quantile_cont(l_extendedprice, p), 4) AS value FROM lineitem
       , (SELECT unnest([0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0])::DOUBLE AS p) GROUP BY p""".replace(
        "quantile_cont(l_extendedprice, p)",
        "list_extract(quantile_cont(l_extendedprice, [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]),"
        " list_position([0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]::DOUBLE[], p))",
    ),
)
def _(t: Tables) -> DataFrame:
    q = ordered.quantiles(t.lineitem, "l_extendedprice", [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0])
    return q.select("p", r("value", 4).alias("value"))


@query(
    "ag15_correlations",
    """SELECT unnest(['quantity', 'discount', 'tax', 'size', 'retail']) AS feature,
       unnest([round(corr(quantity, y), 6), round(corr(discount, y), 6), round(corr(tax, y), 6),
               round(corr(size, y), 6), round(corr(retail, y), 6)]) AS corr FROM house""",
)
def _(t: Tables) -> DataFrame:
    found = profile.correlations(t.house, ["quantity", "discount", "tax", "size", "retail"], "y")
    return found.select("feature", r("corr").alias("corr"))


@query(
    "ag16_histogram",
    """WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
    SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 50)) AS BIGINT), 49) AS bin,
           round(lo + bin * ((hi - lo) / 50), 4) AS bin_left, CAST(count(*) AS BIGINT) AS n FROM lineitem, b GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    return profile.histogram(t.lineitem, "l_extendedprice", 50).withColumn("bin_left", r("bin_left", 4))


@query(
    "ag16_histogram_auto",
    """WITH v AS (SELECT avg_mmr AS x FROM matches WHERE avg_mmr IS NOT NULL),
    s AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS n, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM v),
    w AS (SELECT lo, hi, CAST(ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), 2 * iqr / pow(n, 1.0 / 3))) AS INTEGER) AS k FROM s)
    SELECT least(CAST(floor((x - lo) / ((hi - lo) / k)) AS BIGINT), k - 1) AS bin,
           round(lo + bin * ((hi - lo) / k), 4) AS bin_left, CAST(count(*) AS BIGINT) AS n FROM v, w GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    return profile.histogram(t.matches, "avg_mmr", "auto").withColumn("bin_left", r("bin_left", 4))


@query(
    "ag17_fallback_means",
    """SELECT 'group' AS level, region, game_mode, round(avg(avg_mmr), 4) AS mean FROM matches GROUP BY region, game_mode
       UNION ALL SELECT 'region', region, NULL, round(avg(avg_mmr), 4) FROM matches GROUP BY region
       UNION ALL SELECT 'global', NULL, NULL, round(avg(avg_mmr), 4) FROM matches""",
)
def _(t: Tables) -> DataFrame:
    s = fit_fill_stats(t.matches)
    none = F.lit(None).cast("string")
    group = s.group_means.select(F.lit("group").alias("level"), "region", "game_mode", r("__group_mean", 4).alias("mean"))
    outer = s.region_means.select(F.lit("region").alias("level"), "region", none.alias("game_mode"), r("__region_mean", 4).alias("mean"))
    whole = t.matches.agg(F.count("*")).select(
        F.lit("global").alias("level"), none.alias("region"), none.alias("game_mode"), r(F.lit(s.global_mean), 4).alias("mean")
    )
    return group.unionByName(outer).unionByName(whole)


# --- windows ------------------------------------------------------------------------

@query(
    "wn1_rank_in_group",
    f"""WITH app AS ({_APPLICATIONS})
    SELECT id, course, CAST(row_number() OVER (PARTITION BY course ORDER BY percentile, id) - 1 AS BIGINT) AS rank FROM app""",
)
def _(t: Tables) -> DataFrame:
    apps = materialise(build_applications(t.survey, PREFS, "required"))
    return ordered.rank_in_group(apps, ["course"], ["percentile", "id"]).select("id", "course", "rank")


@query(
    "wn2_rank_in_id",
    f"""WITH app AS ({_APPLICATIONS})
    SELECT id, course, CAST(row_number() OVER (PARTITION BY id ORDER BY pref_order, course) - 1 AS BIGINT) AS rank FROM app""",
)
def _(t: Tables) -> DataFrame:
    apps = materialise(build_applications(t.survey, PREFS, "required"))
    return ordered.rank_in_group(apps, ["id"], ["pref_order", "course"]).select("id", "course", "rank")


@query(
    "wn3_top_by_limit",
    f"""WITH app AS ({_APPLICATIONS}),
    lim AS (SELECT *, CASE course WHEN 'Supplier#000000003' THEN 25 WHEN 'Supplier#000000007' THEN 40 ELSE 10 END AS cap,
            row_number() OVER (PARTITION BY course ORDER BY percentile, id) AS nth FROM app)
    SELECT id, course, pref_order FROM lim WHERE nth <= cap""",
)
def _(t: Tables) -> DataFrame:
    apps = build_applications(t.survey, PREFS, "required").withColumn(
        "cap", frame.lookup("course", CAPACITY, DEFAULT_CAPACITY)
    )
    return ordered.top_by_limit(apps, ["course"], ["percentile", "id"], "cap").select("id", "course", "pref_order")


@query(
    "wn4_row_index",
    "SELECT event_id, CAST(row_number() OVER (ORDER BY value, event_id) - 1 AS BIGINT) AS row FROM events",
)
def _(t: Tables) -> DataFrame:
    return ordered.row_index(t.events.select("event_id", "value"), ["value", "event_id"]).select("event_id", "row")


@query(
    "wn5_sortedness",
    """WITH p AS (SELECT ts, value, lag(ts) OVER (ORDER BY event_id) AS a, lag(value) OVER (ORDER BY event_id) AS b FROM events),
    c AS (SELECT 'ts' AS column_name, bool_and(coalesce(ts >= a, true)) AS up, bool_and(coalesce(ts <= a, true)) AS down FROM p
          UNION ALL SELECT 'value', bool_and(coalesce(value >= b, true)), bool_and(coalesce(value <= b, true)) FROM p)
    SELECT column_name, CASE WHEN up THEN 'ascending' WHEN down THEN 'descending' ELSE 'unsorted' END AS verdict FROM c""",
)
def _(t: Tables) -> DataFrame:
    parts = [
        ordered.sortedness(t.events, "event_id", c).select(F.lit(c).alias("column_name"), "verdict") for c in ("ts", "value")
    ]
    return parts[0].unionByName(parts[1])


# --- sorts, limits, samples -----------------------------------------------------------

@query("st1_sort", "SELECT match_id, region, avg_mmr FROM matches ORDER BY region, avg_mmr DESC NULLS LAST, match_id")
def _(t: Tables) -> DataFrame:
    return frame.order_by(
        t.matches.select("match_id", "region", "avg_mmr"), ["region", "avg_mmr", "match_id"], [False, True, False]
    )


@query(
    "st2_head_tail",
    """(SELECT 'head' AS part, event_id, value FROM events ORDER BY value, event_id LIMIT 5)
       UNION ALL (SELECT 'tail', event_id, value FROM events ORDER BY value DESC, event_id DESC LIMIT 3)""",
)
def _(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "value")
    a = frame.head(e, ["value", "event_id"], 5).select(F.lit("head").alias("part"), "event_id", "value")
    b = frame.tail(e, ["value", "event_id"], 3).select(F.lit("tail").alias("part"), "event_id", "value")
    return a.unionByName(b)


@query(
    "st3_most_frequent",
    """SELECT p1, CAST(count(*) AS BIGINT) AS n FROM survey WHERE p1 IS NOT NULL GROUP BY p1 ORDER BY n DESC, p1 LIMIT 1""",
)
def _(t: Tables) -> DataFrame:
    return profile.most_frequent(t.survey.filter("p1 IS NOT NULL"), "p1")


@query(
    "st4_argmin_group",
    """SELECT p1, round(avg(percentile), 6) AS mean_value, CAST(count(*) AS BIGINT) AS n FROM survey
       WHERE p1 IS NOT NULL GROUP BY p1 ORDER BY avg(percentile), p1 LIMIT 1""",
)
def _(t: Tables) -> DataFrame:
    return profile.argmin_group(t.survey.filter("p1 IS NOT NULL"), "p1", "percentile").withColumn(
        "mean_value", r("mean_value")
    )


@query(
    "st5_sample_n",
    """SELECT CAST(250 AS BIGINT) AS n, CAST(250 AS BIGINT) AS n_distinct, CAST(250 AS BIGINT) AS n_known
       FROM orders HAVING count(*) >= 250""",
)
def _(t: Tables) -> DataFrame:
    drawn = frame.sample_n(t.orders.select("o_orderkey"), 250, 11, ["o_orderkey"])
    known = drawn.join(t.orders.select("o_orderkey", F.lit(1).alias("known")), "o_orderkey", "left")
    return known.agg(
        F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("n_distinct"), F.sum("known").alias("n_known")
    )


@query(
    "st5_sample_rows",
    """SELECT o_orderkey FROM orders ORDER BY CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15) AS BIGINT), o_orderkey LIMIT 250""",
)
def _(t: Tables) -> DataFrame:
    # A hash that both engines have, so that the rows themselves can be compared.
    hashed = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 15), 16, 10).cast("long")
    return frame.sample_n(t.orders.select("o_orderkey"), 250, 0, ["o_orderkey"], hashed)


# --- sets and duplicates ----------------------------------------------------------------

@query("so1_distinct", "SELECT DISTINCT p1 AS a, p2 AS b FROM survey")
def _(t: Tables) -> DataFrame:
    return frame.distinct(t.survey.select(F.col("p1").alias("a"), F.col("p2").alias("b")), ["a", "b"])


@query(
    "so2_latest_row",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events) WHERE nth = 1""",
)
def _(t: Tables) -> DataFrame:
    return ordered.latest(t.events, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query(
    "so3_first_row",
    """SELECT l_orderkey, l_returnflag, l_extendedprice, l_partkey FROM (SELECT *, row_number() OVER
       (PARTITION BY l_orderkey, l_returnflag ORDER BY l_extendedprice, l_partkey, l_suppkey) AS nth FROM lineitem) WHERE nth = 1""",
)
def _(t: Tables) -> DataFrame:
    got = ordered.first_by(t.lineitem, ["l_orderkey", "l_returnflag"], ["l_extendedprice", "l_partkey", "l_suppkey"])
    return got.select("l_orderkey", "l_returnflag", "l_extendedprice", "l_partkey")


@query(
    "so4_keep_last",
    """SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS nth
       FROM conversations) WHERE nth = 1""",
)
def _(t: Tables) -> DataFrame:
    return ordered.keep_last(t.conversations, "conv_id", "turn").select("conv_id", "turn", "role")


_COHORT_VALUES = """
    SELECT DISTINCT course FROM (SELECT segment, unnest([p1, p2, p3, p4, p5, p6]) AS course FROM survey)
    WHERE course <> '' AND segment = '{}'"""


@query(
    "so5_common_values",
    f"SELECT course FROM ({_COHORT_VALUES.format('BUILDING')}) INTERSECT SELECT course FROM ({_COHORT_VALUES.format('MACHINERY')})",
)
def _(t: Tables) -> DataFrame:
    a, b = (t.survey.filter(F.col("segment") == s) for s in ("BUILDING", "MACHINERY"))
    return frame.common_values(a, b, PREFS + LATER_PREFS, "course")


_ONE_NATION = """
    SELECT DISTINCT course FROM (SELECT nation, unnest([p1, p2, p3]) AS course FROM survey)
    WHERE course <> '' AND nation = {}"""


@query(
    "so6_only_in",
    f"""SELECT 'a' AS side, course FROM (({_ONE_NATION.format(1)}) EXCEPT ({_ONE_NATION.format(2)}))
    UNION ALL SELECT 'b', course FROM (({_ONE_NATION.format(2)}) EXCEPT ({_ONE_NATION.format(1)}))""",
)
def _(t: Tables) -> DataFrame:
    a, b = (t.survey.filter(F.col("nation") == n) for n in (1, 2))
    only_a = frame.only_in(a, b, PREFS, "course").select(F.lit("a").alias("side"), "course")
    return only_a.unionByName(frame.only_in(b, a, PREFS, "course").select(F.lit("b").alias("side"), "course"))


@query(
    "so7_union_all",
    "SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier",
)
def _(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    return frame.union_all(a, t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")))


@query(
    "so8_union_aligned",
    """SELECT c_custkey AS key, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
       UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    return frame.union_aligned(a, t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance")))


@query(
    "so9_has_ties",
    """SELECT count(*) > 0 AS has_ties FROM (SELECT percentile FROM (SELECT DISTINCT id, percentile FROM survey)
       GROUP BY percentile HAVING count(*) > 1)""",
)
def _(t: Tables) -> DataFrame:
    return frame.has_ties(t.survey, "id", "percentile")
