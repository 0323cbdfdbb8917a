"""Reshape, scalar functions, and the composite table operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import numeric, text
from gridloom.functions.dates import extract_date_features
from gridloom.operators import clean, frame, reshape
from gridloom.operators.encode import SetEncoder
from gridloom.plans import allocation
from gridloom.plans.features import TABULAR, FeatureSelection, advantage_features, build_feature_config
from gridloom.queries.catalog import query
from gridloom.queries.inputs import (
    CAPACITY, DEFAULT_CAPACITY, GROUP_SIZE, LATER_PREFS, PREFS, Tables, r,
)
from gridloom.sources.scratch import materialise

# --- SQL of the allocation -----------------------------------------------------


def applications_sql(prefs: Sequence[str], source: str = "survey") -> str:
    union = " UNION ALL ".join(
        f"SELECT id, percentile, required, {p} AS course, {i} AS pref_order FROM {source}"
        for i, p in enumerate(prefs, start=1)
    )
    return f"""
    SELECT id, percentile, required, course, pref_order,
           CAST(CASE WHEN pref_order = 1 THEN 1 WHEN required = 2 THEN pref_order - 1 ELSE pref_order END AS BIGINT) AS wave
    FROM (SELECT id, percentile, required, course, CAST(pref_order AS BIGINT) AS pref_order,
                 row_number() OVER (PARTITION BY id, course ORDER BY pref_order) AS nth
          FROM ({union}) WHERE course IS NOT NULL AND course <> '') WHERE nth = 1"""


def allocation_sql(prefs: Sequence[str], waves: int = 3, source: str = "survey") -> str:
    """CTE list that ends in ``seats`` (id, course, wave, pref_order)."""
    cap = " ".join(f"WHEN '{c}' THEN {n}" for c, n in CAPACITY.items())
    ctes = [
        f"app AS ({applications_sql(prefs, source)})",
        f"offer AS (SELECT *, CASE course {cap} ELSE {DEFAULT_CAPACITY} END AS cap FROM app)",
        "a0 AS (SELECT id, course, wave, pref_order FROM offer WHERE false)",
    ]
    for w in range(1, waves + 1):
        ctes += [
            f"""c{w} AS (SELECT o.*, required - coalesce(held, 0) AS need, cap - coalesce(taken, 0) AS cap_left
            FROM offer o LEFT JOIN (SELECT id, count(*) AS held FROM a{w - 1} GROUP BY 1) h ON o.id = h.id
            LEFT JOIN (SELECT course, count(*) AS taken FROM a{w - 1} GROUP BY 1) k ON o.course = k.course
            WHERE wave = {w})""",
            f"""r{w} AS (SELECT *, row_number() OVER (PARTITION BY course ORDER BY percentile, id) AS rk FROM c{w}
            WHERE need > 0 AND cap_left > 0)""",
            f"""s{w} AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pref_order, course) AS nth FROM r{w}
            WHERE rk <= cap_left)""",
            f"a{w} AS (SELECT * FROM a{w - 1} UNION ALL SELECT id, course, wave, pref_order FROM s{w} WHERE nth <= need)",
        ]
    ctes.append(f"seats AS (SELECT * FROM a{waves})")
    return ",\n".join(ctes)


WIDE_SQL = """wide AS (SELECT s.id AS "ID", c[1] AS course1, c[2] AS course2, required FROM {source} s LEFT JOIN
    (SELECT id, list(course ORDER BY wave, pref_order) AS c FROM seats GROUP BY id) l ON s.id = l.id)"""
FINAL_SQL = """SELECT "ID", coalesce(course1, '???') AS course1,
    CASE WHEN required = 1 THEN '-' ELSE coalesce(course2, '???') END AS course2 FROM wide"""

OPTIONS = {"default_capacity": DEFAULT_CAPACITY, "capacity": CAPACITY}
FORBIDDEN = "Supplier#000000003"

# --- reshape ---------------------------------------------------------------------


@query(
    "rs1_unpivot",
    """SELECT id, pref, course FROM survey UNPIVOT INCLUDE NULLS (course FOR pref IN (p1, p2, p3))""",
)
def _(t: Tables) -> DataFrame:
    return reshape.unpivot(t.survey, ["id"], PREFS, "pref", "course")


@query(
    "rs2_explode_columns",
    """SELECT course, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest([p1, p2, p3, p4, p5, p6]) AS course FROM survey)
       GROUP BY course""",
)
def _(t: Tables) -> DataFrame:
    return frame.explode_columns(t.survey, PREFS + LATER_PREFS, "course").groupBy("course").agg(F.count("*").alias("n"))


@query(
    "rs3_list_get",
    """SELECT o_orderkey, string_split(o_orderpriority, ' ')[1] AS a, string_split(o_orderpriority, ' ')[2] AS b FROM orders""",
)
def _(t: Tables) -> DataFrame:
    words = t.orders.select("o_orderkey", F.split("o_orderpriority", " ").alias("w"))
    return words.select("o_orderkey", reshape.list_get("w", 0).alias("a"), reshape.list_get("w", 1).alias("b"))


@query("rs4_to_wide", f"WITH {allocation_sql(PREFS, 1)}, {WIDE_SQL.format(source='survey')} SELECT * FROM wide")
def _(t: Tables) -> DataFrame:
    survey = materialise(t.survey)
    seats = allocation.allocate(survey, PREFS, "required", max_wave=1, **OPTIONS)
    return reshape.to_wide(survey, seats, "required")


@query("rs5_finalize", f"WITH {allocation_sql(PREFS)}, {WIDE_SQL.format(source='survey')} {FINAL_SQL}")
def flagship(t: Tables) -> DataFrame:
    survey = materialise(t.survey)
    seats = allocation.allocate(survey, PREFS, "required", **OPTIONS)
    return reshape.finalize_result(reshape.to_wide(survey, seats, "required"), "required")


@query("rs6_repeat_rows", "SELECT p_partkey, CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS copy FROM part")
def _(t: Tables) -> DataFrame:
    return frame.repeat_rows(t.part.select("p_partkey"), 4, "copy")


@query(
    "rs7_coordinates_to_rows",
    """SELECT l_orderkey, concat_ws(',', """
    + ", ".join(f"count(*) FILTER (l_linenumber = {i})" for i in range(1, 8))
    + ") AS cells FROM lineitem GROUP BY l_orderkey",
)
def _(t: Tables) -> DataFrame:
    coords = t.lineitem.groupBy("l_orderkey", (F.col("l_linenumber") - 1).alias("col")).agg(F.count("*").alias("value"))
    rows = reshape.to_vectors(coords, "l_orderkey", 7)
    return rows.select("l_orderkey", F.array_join(vector_to_array("features").cast("array<int>"), ",").alias("cells"))


@query(
    "rs8_combine_blocks",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(4 AS INTEGER) AS width,
       round(l_quantity + l_discount + l_tax + 1, 4) AS total FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    blocks = t.lineitem.withColumn("one", F.lit(1.0))
    both = reshape.combine_blocks(blocks, ["l_quantity", "l_discount", "l_tax", "one"])
    v = vector_to_array("features")
    total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    return both.select("l_orderkey", "l_linenumber", "l_partkey", F.size(v).alias("width"), r(total, 4).alias("total"))


@query("rs9_any_nonzero", "SELECT count(*) FILTER (l_tax <> 0 OR l_discount <> 0) > 0 AS any_nonzero FROM lineitem")
def _(t: Tables) -> DataFrame:
    return frame.has_any_nonzero(t.lineitem, ["l_tax", "l_discount"])


# --- scalar functions ---------------------------------------------------------------

LETTERS = [chr(c) for c in range(ord("a"), ord("z") + 1)] + [chr(c) for c in range(ord("а"), ord("я") + 1)]


def collapse_sql(value: str) -> str:
    """One replacement per letter, since the check engine's patterns have no back-references."""
    for letter in LETTERS:
        value = f"regexp_replace({value}, '{letter}{{3,}}', '{letter}{letter}', 'g')"
    return value


CLEAN_SQL = "lower(replace(text, '|', ' '))"
TOKEN_SQL = "[\\p{L}\\p{N}_]+|[()?!]+"
WORD_SQL = "regexp_matches(x, '^[a-zа-я]+$') AND length(x) >= 3"


@query("sc1_prefix", "SELECT page_id, substr(url, 1, 9) AS start FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.prefix("url", 9).alias("start"))


@query("sc2_clean_case", f"SELECT doc_id, {CLEAN_SQL} AS clean FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.clean_case("text").alias("clean"))


@query("sc3_collapse_repeats", f"SELECT doc_id, {collapse_sql('lower(text)')} AS short FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.collapse_repeats(F.lower("text")).alias("short"))


@query(
    "sc4_tokens",
    f"""SELECT doc_id, len(tk) AS n, array_to_string(tk, '~') AS tokens
        FROM (SELECT doc_id, regexp_extract_all(text, '{TOKEN_SQL}') AS tk FROM documents)""",
)
def _(t: Tables) -> DataFrame:
    tk = t.documents.select("doc_id", text.tokens("text").alias("tk"))
    return tk.select("doc_id", F.size("tk").cast("long").alias("n"), F.array_join("tk", "~").alias("tokens"))


@query(
    "sc5_keep_words",
    f"""SELECT doc_id, array_to_string([x FOR x IN regexp_extract_all(lower(text), '{TOKEN_SQL}') IF {WORD_SQL}], ' ')
        AS words FROM documents""",
)
def _(t: Tables) -> DataFrame:
    tk = t.documents.select("doc_id", text.tokens(F.lower("text")).alias("tk"))
    return tk.select("doc_id", F.array_join(text.keep_words("tk"), " ").alias("words"))


_DOC_TOKENS = f"SELECT doc_id, regexp_extract_all({collapse_sql(CLEAN_SQL)}, '{TOKEN_SQL}') AS tk FROM documents"
_LEMMAS = """SELECT DISTINCT token, left(token, length(token) - 3) AS lemma
    FROM (SELECT unnest(tk) AS token FROM dt) WHERE token LIKE '%ing' AND length(token) > 5"""


@query(
    "sc6_lemmatise",
    f"""WITH dt AS ({_DOC_TOKENS}), lem AS ({_LEMMAS}),
    e AS (SELECT doc_id, generate_subscripts(tk, 1) AS pos, unnest(tk) AS token FROM dt)
    SELECT e.doc_id AS doc_id, string_agg(coalesce(lemma, e.token), ' ' ORDER BY pos) AS lemmas
    FROM e LEFT JOIN lem ON e.token = lem.token GROUP BY e.doc_id
    UNION ALL SELECT doc_id, '' FROM dt WHERE len(tk) = 0""",
)
def _(t: Tables) -> DataFrame:
    # The tokens make the dictionary, meet it and hold the result: texts are tokenised and written once.
    docs = materialise(t.documents.repartition("doc_id").select("doc_id", text.raw_tokens("text").alias("tk")))
    out = text.lemmatise(docs, "doc_id", "tk", _suffix_dictionary(docs))
    return out.select("doc_id", F.array_join("lemmas", " ").alias("lemmas"))


def _suffix_dictionary(docs: DataFrame) -> DataFrame:
    """(token, lemma) for the long tokens of the texts that end in "ing"."""
    token = docs.select(F.explode("tk").alias("token")).distinct()
    return token.filter(F.col("token").endswith("ing") & (F.length("token") > 5)).select(
        "token", F.expr("left(token, length(token) - 3)").alias("lemma")
    )


@query(
    "sc7_preprocess_text",
    f"""WITH dt AS ({_DOC_TOKENS})
    SELECT doc_id, array_to_string([x FOR x IN tk IF {WORD_SQL}], ' ') AS words FROM dt""",
)
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.array_join(text.preprocess_text("text"), " ").alias("words"))


@query(
    "sc8_date_features",
    """WITH d AS (SELECT match_id, TRY_CAST(CASE WHEN match_id % 50 = 0 THEN 'unknown'
       ELSE strftime(date, '%Y-%m-%d') END AS TIMESTAMP) AS d FROM matches)
    SELECT match_id, strftime(d, '%Y-%m-%d') AS day, CAST(month(d) AS VARCHAR) AS month,
       CASE WHEN isodow(d) >= 6 THEN 'True' ELSE 'False' END AS is_weekend FROM d""",
)
def _(t: Tables) -> DataFrame:
    written = F.when(F.col("match_id") % 50 == 0, "unknown").otherwise(F.date_format("date", "yyyy-MM-dd"))
    out = extract_date_features(t.matches.select("match_id", written.alias("date")))
    return out.select("match_id", F.date_format("date", "yyyy-MM-dd").alias("day"), "month", "is_weekend")


@query(
    "sc9_transform_value",
    """WITH m AS (SELECT match_id, greatest(coalesce(avg_mmr - 2000, 0), 0) AS x FROM matches)
    SELECT match_id, round(x, 4) AS raw, round(ln(1 + x), 6) AS log1p, round(sqrt(x), 6) AS root, round(x, 4) AS other FROM m""",
)
def _(t: Tables) -> DataFrame:
    m = t.matches.select("match_id", (F.col("avg_mmr") - 2000).alias("x"))
    modes = {"raw": ("raw", 4), "log1p": ("log1p", 6), "root": ("sqrt", 6), "other": ("cube", 4)}
    return m.select("match_id", *[r(numeric.transform_value("x", k), d).alias(n) for n, (k, d) in modes.items()])


@query(
    "sc10_transform_known",
    """SELECT match_id, round(ln(1 + avg_mmr), 6) AS log, round(sqrt(avg_mmr), 6) AS sqrt, round(1 / (1 + avg_mmr), 6) AS inv,
       round(CASE WHEN avg_mmr > 0 THEN exp(ln(avg_mmr)) WHEN avg_mmr = 0 THEN 0 END, 4) AS exp_log FROM matches""",
)
def _(t: Tables) -> DataFrame:
    digits = {"log": 6, "sqrt": 6, "inv": 6, "exp_log": 4}
    return t.matches.select("match_id", *[r(numeric.transform_known("avg_mmr", m), d).alias(m) for m, d in digits.items()])


@query(
    "sc11_log_target",
    """SELECT o_orderkey, round(ln(o_totalprice), 6) AS logged, round(exp(ln(o_totalprice)), 2) AS back FROM orders""",
)
def _(t: Tables) -> DataFrame:
    logged = t.orders.select("o_orderkey", numeric.log_target("o_totalprice").alias("l"))
    return logged.select("o_orderkey", r("l").alias("logged"), r(numeric.exp_target("l"), 2).alias("back"))


@query(
    "sc12_sign_clip",
    """SELECT event_id, CAST(sign(v) AS INTEGER) AS sign, round(greatest(least(v, 5), -5), 4) AS clipped, round(abs(v), 4) AS magnitude,
       CASE WHEN abs(v) < 5 THEN 'near' ELSE 'far' END AS zone FROM series""",
)
def _(t: Tables) -> DataFrame:
    v = F.col("v")
    return t.series.select(
        "event_id",
        F.signum(v).cast("int").alias("sign"),
        r(numeric.clip(v, -5.0, 5.0), 4).alias("clipped"),
        r(F.abs(v), 4).alias("magnitude"),
        F.when(F.abs(v) < 5, "near").otherwise("far").alias("zone"),
    )


@query(
    "sc13_residuals",
    """SELECT orderkey, linenumber, partkey, round(y - quantity * retail, 2) AS residual FROM house""",
)
def _(t: Tables) -> DataFrame:
    out = numeric.residuals(t.house.withColumn("p", F.col("quantity") * F.col("retail")), "y", "p")
    return out.select("orderkey", "linenumber", "partkey", r("residual", 2).alias("residual"))


# --- allocation ------------------------------------------------------------------------


@query("co1_applications", f"SELECT id, round(percentile, 6) AS percentile, required, course, pref_order, wave FROM ({applications_sql(PREFS)})")
def _(t: Tables) -> DataFrame:
    return allocation.build_applications(t.survey, PREFS, "required").withColumn("percentile", r("percentile"))


@query("co2_allocate", f"WITH {allocation_sql(PREFS)} SELECT id, course, wave, pref_order FROM seats")
def _(t: Tables) -> DataFrame:
    return allocation.allocate(t.survey, PREFS, "required", **OPTIONS)


_SEASON = f"""season AS (SELECT id, percentile, required,
    CASE WHEN g THEN p5 ELSE p4 END AS p4, CASE WHEN g THEN p6 ELSE p5 END AS p5, CASE WHEN g THEN '' ELSE p6 END AS p6
    FROM (SELECT *, coalesce(segment IN ('BUILDING', 'MACHINERY') AND p4 = '{FORBIDDEN}', false) AS g FROM survey))"""


@query(
    "co3_allocate_season",
    f"""WITH {_SEASON}, {allocation_sql(LATER_PREFS, 3, 'season')}, {WIDE_SQL.format(source='season')} {FINAL_SQL}""",
)
def _(t: Tables) -> DataFrame:
    survey = materialise(t.survey)
    guard = F.col("segment").isin("BUILDING", "MACHINERY")
    seats = allocation.allocate_season(survey, LATER_PREFS, "required", FORBIDDEN, guard, **OPTIONS)
    return reshape.finalize_result(reshape.to_wide(survey, seats, "required"), "required")


@query(
    "co4_compare_assignments",
    f"""WITH {allocation_sql(PREFS, 1)}, {WIDE_SQL.format(source='survey')},
    sets AS (SELECT "ID", CAST("ID" AS BIGINT) AS k, required,
             array_to_string(list_sort([x FOR x IN [course1, course2] IF x IS NOT NULL]), '|') AS got_set,
             coalesce(course2, '') AS rest FROM wide)
    SELECT "ID", got_set, CASE WHEN k % 13 = 0 THEN rest ELSE got_set END AS want_set FROM sets
    WHERE k % 13 = 0 AND rest <> got_set AND k <> 13""",
)
def _(t: Tables) -> DataFrame:
    survey = materialise(t.survey)
    got = reshape.to_wide(survey, allocation.allocate(survey, PREFS, "required", max_wave=1, **OPTIONS), "required")
    # The other table lists the places the other way round and lacks some of them.
    k = F.col("ID").cast("long")
    want = got.select(
        "ID", "required", F.col("course2").alias("course1"), F.when(k % 13 != 0, F.col("course1")).alias("course2")
    )
    listed = got.filter("ID = '13'").select(F.array_compact(F.array("course1", "course2")).alias("c")).first()
    diff = allocation.compare_assignments(got, want, {"13": [listed["c"], []]})
    return diff.select("ID", "got_set", "want_set")


# --- cleaning -----------------------------------------------------------------------------

_CLEAN = f"""kept AS (SELECT * FROM players WHERE (account_id IS NULL OR account_id <> -1) AND hero_id IS NOT NULL),
    proper AS (SELECT match_id FROM kept GROUP BY match_id HAVING count(*) = {GROUP_SIZE}
               AND count(DISTINCT hero_id) = {GROUP_SIZE} AND count(*) FILTER (hero_id = 0) = 0),
    cleaned AS (SELECT * FROM kept WHERE match_id IN (SELECT match_id FROM proper))"""


@query("co5_clean_groups", f"WITH {_CLEAN} SELECT * FROM cleaned")
def _(t: Tables) -> DataFrame:
    return clean.preprocess_players(t.players, GROUP_SIZE)


@query(
    "co6_clean_groups_strict",
    """WITH bad AS (SELECT match_id FROM players GROUP BY match_id HAVING count(*) <> count(DISTINCT hero_id)
                    + max(CASE WHEN hero_id IS NULL THEN 1 ELSE 0 END)
                    UNION SELECT match_id FROM players WHERE hero_id = 0)
    SELECT * FROM players WHERE match_id NOT IN (SELECT match_id FROM bad)
    AND account_id IS NOT NULL AND hero_id IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    return clean.clean_groups_strict(t.players)


@query(
    "co6_item_zero_users",
    "SELECT account_id, CAST(count(*) AS BIGINT) AS n FROM players WHERE hero_id = 0 GROUP BY account_id",
)
def _(t: Tables) -> DataFrame:
    return clean.item_zero_users(t.players)


@query(
    "co7_prepare_players",
    f"""WITH {_CLEAN} SELECT *, CASE WHEN match_id % 4 = 0 THEN 'test' ELSE 'train' END AS part FROM cleaned""",
)
def _(t: Tables) -> DataFrame:
    late = F.col("match_id") % 4 == 0
    train, test = t.matches.filter(~late), t.matches.filter(late)
    a, b = clean.prepare_players_for_run(
        t.players.filter(~late), t.players.filter(late), train, test, GROUP_SIZE
    )
    return a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test")))


_FILL = """m AS (SELECT match_id, date, CASE WHEN match_id % 31 <> 0 THEN region END AS region, game_mode, avg_mmr FROM matches),
    tr AS (SELECT * FROM m WHERE match_id % 4 <> 0),
    g AS (SELECT region, game_mode, avg(avg_mmr) AS gm FROM tr GROUP BY ALL),
    o AS (SELECT region, avg(avg_mmr) AS rm FROM tr GROUP BY ALL),
    filled AS (SELECT match_id, date, CAST(CASE WHEN avg_mmr IS NULL THEN 1 ELSE 0 END AS INTEGER) AS mmr_missing,
      coalesce(avg_mmr, gm, rm, (SELECT avg(avg_mmr) FROM tr)) AS avg_mmr
      FROM m LEFT JOIN g ON m.region IS NOT DISTINCT FROM g.region AND m.game_mode = g.game_mode
      LEFT JOIN o ON m.region IS NOT DISTINCT FROM o.region)"""


def _gappy_matches(t: Tables) -> DataFrame:
    return t.matches.withColumn("region", F.when(F.col("match_id") % 31 != 0, F.col("region")))


@query("co8_mean_fill", f"WITH {_FILL} SELECT match_id, mmr_missing, round(avg_mmr, 4) AS avg_mmr FROM filled")
def _(t: Tables) -> DataFrame:
    m = _gappy_matches(t)
    stats = clean.fit_fill_stats(m.filter(F.col("match_id") % 4 != 0))
    out = clean.transform_fill(m, stats)
    return out.select("match_id", F.col("mmr_missing").cast("int").alias("mmr_missing"), r("avg_mmr", 4).alias("avg_mmr"))


@query(
    "co9_preprocess_fold",
    f"""WITH {_FILL} SELECT match_id, CAST(month(date) AS VARCHAR) AS month,
    CASE WHEN isodow(date) >= 6 THEN 'True' ELSE 'False' END AS is_weekend, mmr_missing, round(sqrt(avg_mmr), 6) AS avg_mmr,
    CASE WHEN match_id % 4 = 0 THEN 'other' ELSE 'train' END AS part FROM filled""",
)
def _(t: Tables) -> DataFrame:
    m = _gappy_matches(t)
    late = F.col("match_id") % 4 == 0
    a, b = clean.preprocess_fold(m.filter(~late), m.filter(late), "sqrt")
    both = a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("other")))
    return both.select(
        "match_id", "month", "is_weekend", F.col("mmr_missing").cast("int").alias("mmr_missing"), r("avg_mmr").alias("avg_mmr"), "part"
    )


@query(
    "co10_normalize_chat",
    """SELECT match_id, turn, coalesce(radiant_chat, '') AS radiant_chat, coalesce(dire_chat, '') AS dire_chat
       FROM (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY turn DESC) AS nth FROM chat) WHERE nth = 1""",
)
def _(t: Tables) -> DataFrame:
    return clean.normalize_chat(t.chat, ["radiant_chat", "dire_chat"], "turn").select(
        "match_id", "turn", "radiant_chat", "dire_chat"
    )


@query(
    "co11_feature_groups",
    f"""WITH {_FILL} SELECT f.match_id AS match_id, region, game_mode, CAST(month(f.date) AS VARCHAR) AS month,
    round(ln(1 + f.avg_mmr), 6) AS avg_mmr, mmr_missing FROM filled f JOIN matches USING (match_id)""",
)
def _(t: Tables) -> DataFrame:
    cfg = build_feature_config(
        FeatureSelection(enabled=("region_te", "game_mode_ohe", "month_ohe", "avg_mmr", "avg_mmr"), mmr_transform="log1p")
    )
    m = _gappy_matches(t)
    late = F.col("match_id") % 4 == 0
    a, b = clean.preprocess_fold(m.filter(~late), m.filter(late), cfg.mmr_transform)
    out = a.unionByName(b).drop("region").join(t.matches.select("match_id", "region"), "match_id")
    return out.select("match_id", *cfg.of(*TABULAR)).withColumns({
        "avg_mmr": r("avg_mmr"), "mmr_missing": F.col("mmr_missing").cast("int")
    })


@query(
    "co12_series_features",
    """SELECT user_id, round(avg(v), 6) AS adv_mean, round(coalesce(stddev_samp(v), 0), 6) AS adv_std, round(min(v), 6) AS adv_min,
       round(max(v), 6) AS adv_max, round(max(abs(v)), 6) AS abs_max, round(greatest(max(v), 0), 6) AS peak_a,
       round(greatest(-min(v), 0), 6) AS peak_b, round(avg(CASE WHEN v > 0 THEN 1.0 ELSE 0.0 END), 6) AS share_positive,
       round(max_by(v, t), 6) AS last,
       round(avg(v) FILTER (t < 10), 9) AS third1, round(avg(v) FILTER (t >= 10 AND t < 20), 9) AS third2,
       round(CASE WHEN var_pop(t) > 0 THEN regr_slope(v, t) ELSE 0 END, 6) AS slope,
       round(CASE WHEN var_pop(t) > 0 THEN regr_intercept(v, t) ELSE 0 END, 6) AS intercept,
       round(CASE WHEN var_pop(t) > 0 AND var_pop(v) > 0 THEN regr_r2(v, t) ELSE 0 END, 6) AS r2,
       CAST(CASE WHEN var_pop(t) > 0 THEN 0 ELSE 1 END AS INTEGER) AS trend_was_imputed
       FROM series GROUP BY user_id""",
)
def _(t: Tables) -> DataFrame:
    s = clean.series_features(t.series, "user_id", "t", "v", [("third1", 0.0, 10.0), ("third2", 10.0, 20.0)])
    keep = ("user_id", "trend_was_imputed")
    digits = {"third1": 9, "third2": 9}
    return s.select(*keep, *[r(c, digits.get(c, 6)).alias(c) for c in s.columns if c not in keep])


@query(
    "co12_advantage_features",
    """SELECT user_id, round(-avg(v), 6) AS dire_mean_gold_adv, round(max_by(v, t), 6) AS radiant_last_gold_adv,
       round(avg(v) FILTER (t < 5), 6) AS gold_bin_m5,
       round(coalesce(avg(v) FILTER (t >= 10 AND t < 15), avg(v) FILTER (t >= 5 AND t < 10), avg(v) FILTER (t < 5)), 6) AS gold_bin_last
       FROM series GROUP BY user_id""",
)
def _(t: Tables) -> DataFrame:
    a = advantage_features(t.series, "user_id", "t", "v", "gold")
    cols = ["dire_mean_gold_adv", "radiant_last_gold_adv", "gold_bin_m5", "gold_bin_last"]
    return a.select("user_id", *[r(c).alias(c) for c in cols])


@query(
    "st6_batches",
    """WITH m AS (SELECT match_id, CAST(floor((row_number() OVER (ORDER BY match_id) - 1) / 1000) AS BIGINT) AS batch FROM matches),
    cells AS (SELECT match_id, hero_id, sign(sum(s)) AS v FROM (SELECT match_id, hero_id,
        CASE WHEN player_slot BETWEEN 0 AND 4 THEN 1 WHEN player_slot BETWEEN 128 AND 132 THEN -1 END AS s FROM players
        WHERE hero_id <> 0) WHERE s IS NOT NULL GROUP BY ALL)
    SELECT batch, CAST(count(DISTINCT m.match_id) AS BIGINT) AS n, round(CAST(coalesce(sum(v), 0) AS DOUBLE), 1) AS total,
           round(CAST(coalesce(sum(abs(v)), 0) AS DOUBLE), 1) AS nonzero FROM m LEFT JOIN cells USING (match_id) GROUP BY batch""",
)
def _(t: Tables) -> DataFrame:
    encoder = SetEncoder.fit(t.heroes)
    rows = encoder.transform_batches(t.players, t.matches, 1000)
    add = lambda a, x: a + x
    cells = vector_to_array("features")
    total = F.aggregate(cells, F.lit(0.0), add)
    size = F.aggregate(F.transform(cells, F.abs), F.lit(0.0), add)
    return rows.groupBy("batch").agg(
        F.count("*").alias("n"), r(F.sum(total), 1).alias("total"), r(F.sum(size), 1).alias("nonzero")
    )
