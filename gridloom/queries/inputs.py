"""The supplied tables, and the operator inputs derived from them.

Every derived input exists twice: as a DataFrame here and as a SQL text in
``VIEWS``, so that checks start from the same rows.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

PREFS = ["p1", "p2", "p3"]
LATER_PREFS = ["p4", "p5", "p6"]
CAPACITY = {"Supplier#000000003": 25, "Supplier#000000007": 40}
DEFAULT_CAPACITY = 10
GROUP_SIZE = 4
HOUSE_X = ["quantity", "discount", "tax", "size", "retail"]
HOUSE_ORDER = ["orderkey", "linenumber", "partkey", "suppkey", "y"]
EPOCH = "2024-01-01"

VIEWS: dict[str, str] = {
    "spend": """
        SELECT o_custkey, l_suppkey, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "choice": """
        SELECT o_custkey, s_name, row_number() OVER (PARTITION BY o_custkey ORDER BY cents DESC, l_suppkey) AS rk
        FROM spend JOIN supplier ON l_suppkey = s_suppkey""",
    "survey": """
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey AS custkey,
               (9999.99 - c_acctbal) / 10999.98 AS percentile,
               CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END AS BIGINT) AS required,
               c_mktsegment AS segment, c_nationkey AS nation,
               max(CASE WHEN rk = 1 THEN s_name END) AS p1, max(CASE WHEN rk = 2 THEN s_name END) AS p2,
               CASE WHEN c_custkey % 7 = 0 THEN '' ELSE max(CASE WHEN rk = 3 THEN s_name END) END AS p3,
               max(CASE WHEN rk = 4 THEN s_name END) AS p4,
               CASE WHEN c_custkey % 5 = 0 THEN max(CASE WHEN rk = 4 THEN s_name END)
                    ELSE max(CASE WHEN rk = 5 THEN s_name END) END AS p5,
               max(CASE WHEN rk = 6 THEN s_name END) AS p6
        FROM customer LEFT JOIN choice ON c_custkey = o_custkey
        GROUP BY c_custkey, c_acctbal, c_mktsegment, c_nationkey""",
    "matches": """
        SELECT o_orderkey AS match_id, o_orderdate AS date, r_name AS region, o_orderpriority AS game_mode,
               CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS avg_mmr,
               CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS radiant_win
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "players": """
        SELECT l_orderkey AS match_id,
               CASE WHEN l_suppkey % 50 = 7 THEN -1 WHEN l_suppkey % 50 = 9 THEN NULL ELSE l_suppkey END AS account_id,
               CASE WHEN l_partkey % 200 = 5 THEN 0 WHEN l_partkey % 200 = 6 THEN NULL
                    ELSE CAST(substr(p_brand, 7) AS BIGINT) END AS hero_id,
               CAST(CASE WHEN l_linestatus = 'O' THEN l_linenumber - 1 ELSE 127 + l_linenumber END AS BIGINT) AS player_slot
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "heroes": "SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS id FROM part",
    "chat": """
        SELECT conv_id AS match_id, turn, CASE WHEN role = 'user' THEN text END AS radiant_chat,
               CASE WHEN role <> 'user' THEN text END AS dire_chat
        FROM conversations""",
    "house": """
        SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_partkey AS partkey, l_suppkey AS suppkey,
               l_extendedprice AS y, l_quantity AS quantity, l_discount AS discount, l_tax AS tax,
               CAST(p_size AS DOUBLE) AS size, p_retailprice AS retail, p_type AS type, p_brand AS brand,
               l_returnflag AS flag, CAST(1 AS DOUBLE) AS bias
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "series": """
        SELECT event_id, user_id, event_type, value - 10 AS v,
               (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 86400000000.0 AS t
        FROM events""",
}


def sql(body: str) -> str:
    """Put the views that ``body`` mentions in front of it as common table expressions."""
    body = body.strip()
    needed: list[str] = []

    def need(text: str) -> None:
        for name, view in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                need(view)
                if name not in needed:
                    needed.append(name)

    need(body)
    if not needed:
        return body
    views = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed)
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {views},\n{body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


def r(col: Column | str, digits: int = 6) -> Column:
    """Rounded double; minus zero becomes zero."""
    return F.round(col, digits) + F.lit(0.0)


class Tables:
    """Lazy readers of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def survey(self) -> DataFrame:
        cents = F.round(F.col("l_extendedprice") * 100).cast("long")
        spend = (
            self.lineitem.join(self.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_custkey", "l_suppkey")
            .agg(F.sum(cents).alias("cents"))
            .join(self.supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
        )
        top = self._six_best(spend)
        c = self.customer.join(top, F.col("c_custkey") == F.col("o_custkey"), "left")
        key = F.col("c_custkey")
        return c.select(
            key.cast("string").alias("id"),
            key.alias("custkey"),
            ((F.lit(9999.99) - F.col("c_acctbal")) / F.lit(10999.98)).alias("percentile"),
            F.when(F.col("c_mktsegment") == "BUILDING", 2).otherwise(1).cast("long").alias("required"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_nationkey").alias("nation"),
            "p1",
            "p2",
            F.when(key % 7 == 0, "").otherwise(F.col("p3")).alias("p3"),
            "p4",
            F.when(key % 5 == 0, F.col("p4")).otherwise(F.col("p5")).alias("p5"),
            "p6",
        )

    @staticmethod
    def _six_best(spend: DataFrame) -> DataFrame:
        w = Window.partitionBy("o_custkey").orderBy(F.desc("cents"), "l_suppkey")
        ranked = spend.withColumn("rk", F.row_number().over(w)).filter("rk <= 6")
        return ranked.groupBy("o_custkey").agg(*[
            F.max(F.when(F.col("rk") == i, F.col("s_name"))).alias(f"p{i}") for i in range(1, 7)
        ])

    @cached_property
    def matches(self) -> DataFrame:
        return (
            self.orders.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("o_orderkey").alias("match_id"),
                F.col("o_orderdate").alias("date"),
                F.col("r_name").alias("region"),
                F.col("o_orderpriority").alias("game_mode"),
                F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("avg_mmr"),
                F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("int").alias("radiant_win"),
            )
        )

    @cached_property
    def players(self) -> DataFrame:
        supp, part_key = F.col("l_suppkey"), F.col("l_partkey")
        return self.lineitem.join(self.part, part_key == F.col("p_partkey")).select(
            F.col("l_orderkey").alias("match_id"),
            F.when(supp % 50 == 7, -1).when(supp % 50 == 9, None).otherwise(supp).cast("long").alias("account_id"),
            F.when(part_key % 200 == 5, 0)
            .when(part_key % 200 == 6, None)
            .otherwise(F.substring("p_brand", 7, 10).cast("long"))
            .cast("long")
            .alias("hero_id"),
            F.when(F.col("l_linestatus") == "O", F.col("l_linenumber") - 1)
            .otherwise(127 + F.col("l_linenumber"))
            .cast("long")
            .alias("player_slot"),
        )

    @cached_property
    def heroes(self) -> DataFrame:
        return self.part.select(F.substring("p_brand", 7, 10).cast("int").alias("id")).distinct()

    @cached_property
    def chat(self) -> DataFrame:
        user = F.col("role") == "user"
        return self.conversations.select(
            F.col("conv_id").alias("match_id"),
            "turn",
            F.when(user, F.col("text")).alias("radiant_chat"),
            F.when(~user, F.col("text")).alias("dire_chat"),
        )

    @cached_property
    def house(self) -> DataFrame:
        return self.lineitem.join(self.part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_orderkey").alias("orderkey"),
            F.col("l_linenumber").alias("linenumber"),
            F.col("l_partkey").alias("partkey"),
            F.col("l_suppkey").alias("suppkey"),
            F.col("l_extendedprice").alias("y"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_discount").alias("discount"),
            F.col("l_tax").alias("tax"),
            F.col("p_size").cast("double").alias("size"),
            F.col("p_retailprice").alias("retail"),
            F.col("p_type").alias("type"),
            F.col("p_brand").alias("brand"),
            F.col("l_returnflag").alias("flag"),
            F.lit(1.0).alias("bias"),
        )

    @cached_property
    def series(self) -> DataFrame:
        micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col("ts"))
        return self.events.select(
            "event_id",
            "user_id",
            "event_type",
            (F.col("value") - 10).alias("v"),
            (micros / F.lit(86400000000.0)).alias("t"),
        )
