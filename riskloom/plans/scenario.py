"""The credit domain laid over the driver tables.

``clients``  one row per customer, in the client-table layout (application columns, history
             counts, target, split and scores). Built with DataFrame code here and restated as
             SQL for the checks. The target is a threshold on points from the external scores, a missing
             occupation and hash noise; no other column uses it except the frozen score, an arithmetic mix.
``bureau``, ``bureau_balance``, ``instalments``, ``pos_cash``, ``credit_card`` child and grandchild tables from orders
and lineitem.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators import features

def event_sql(key: str) -> str:
    """Whether a client defaults, in words that both engines read: low external scores, a missing third score and a
    missing occupation add points, and so does noise from the key; about one client in ten passes the line."""
    k = f"CAST({key} AS BIGINT)"
    points = [
        f"6 * (1009 - ({k} * 337) % 1009)",
        f"CASE WHEN {k} % 5 = 2 THEN 2500 ELSE 4 * (997 - ({k} * 419) % 997) END",
        f"CASE WHEN {k} % 7 = 0 THEN 1200 ELSE 0 END",
        f"({k} * 40487 + {k} * {k} * 7) % 10007",
    ]
    return f"({' + '.join(points)} > 14700)"


# ---------------------------------------------------------------- SQL restatement

SQL_TABLES: dict[str, str] = {}

SQL_TABLES["history"] = """
SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS avg_price, max(o_totalprice) AS max_price,
       min(o_totalprice) AS min_price, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_final
FROM orders GROUP BY o_custkey
"""

SQL_TABLES["visits"] = "SELECT user_id, count(*) AS n FROM events GROUP BY user_id"

SQL_TABLES["base_clients"] = f"""
SELECT c_custkey AS "SK_ID_CURR",
       CAST(CASE WHEN {event_sql("c_custkey")} THEN 1 ELSE 0 END AS INTEGER) AS "TARGET",
       CASE WHEN c_custkey % 97 = 5 THEN NULL WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'F' END AS "CODE_GENDER",
       CASE WHEN c_custkey % 53 = 7 THEN NULL ELSE -(7300 + (c_custkey * 7919) % 18000) END AS "DAYS_BIRTH",
       CASE WHEN c_custkey % 11 = 4 THEN NULL ELSE -((c_custkey * 104729) % 9000) END AS "DAYS_EMPLOYED",
       -((c_custkey * 31) % 8000) AS "DAYS_REGISTRATION",
       -((c_custkey * 17) % 4000) AS "DAYS_ID_PUBLISH",
       -((c_custkey * 13) % 2000) AS "DAYS_LAST_PHONE_CHANGE",
       CAST(c_custkey % 8 AS INTEGER) AS "CNT_CHILDREN",
       CAST((c_custkey % 8) + (c_custkey % 2) AS INTEGER) AS "CNT_FAM_MEMBERS",
       h.avg_price AS "AMT_INCOME_TOTAL",
       h.max_price * 2e0 AS "AMT_CREDIT",
       h.min_price AS "AMT_ANNUITY",
       CASE WHEN c_custkey % 29 = 3 THEN 0e0 ELSE h.max_price * 1.8e0 END AS "AMT_GOODS_PRICE",
       c_mktsegment AS "NAME_EDUCATION_TYPE",
       CASE WHEN c_nationkey % 2 = 0 THEN 'Cash loans' ELSE 'Revolving loans' END AS "NAME_CONTRACT_TYPE",
       CASE WHEN c_nationkey % 5 = 0 THEN 'Pensioner' WHEN c_nationkey % 5 = 1 THEN 'Working' ELSE 'Commercial associate' END AS "NAME_INCOME_TYPE",
       CASE WHEN c_nationkey % 3 = 0 THEN 'Married' WHEN c_nationkey % 3 = 1 THEN 'Single' ELSE 'Widow' END AS "NAME_FAMILY_STATUS",
       CASE WHEN c_custkey % 4 = 0 THEN 'Rented apartment' ELSE 'House / apartment' END AS "NAME_HOUSING_TYPE",
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 < 4 THEN 'Laborers' ELSE 'Managers' END AS "OCCUPATION_TYPE",
       CASE WHEN c_custkey % 6 < 2 THEN 'School' WHEN c_custkey % 6 < 4 THEN 'Trade' ELSE 'Self-employed' END AS "ORGANIZATION_TYPE",
       CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS "FLAG_OWN_CAR",
       CASE WHEN c_custkey % 5 < 3 THEN 'Y' ELSE 'N' END AS "FLAG_OWN_REALTY",
       CASE WHEN c_custkey % 9 < 5 THEN NULL ELSE ((c_custkey * 271) % 1000) / 1000e0 END AS "EXT_SOURCE_1",
       ((c_custkey * 337) % 1009) / 1009e0 AS "EXT_SOURCE_2",
       CASE WHEN c_custkey % 5 = 2 THEN NULL ELSE ((c_custkey * 419) % 997) / 997e0 END AS "EXT_SOURCE_3",
       v.n AS "BUREAU_COUNT",
       h.n AS "PREV_COUNT",
       h.n_final AS "INST_COUNT",
       CASE WHEN c_custkey % 3 = 1 THEN h.n END AS "POS_COUNT",
       CASE WHEN c_custkey % 4 = 1 THEN h.n END AS "CC_COUNT"
FROM customer
LEFT JOIN history h ON h.o_custkey = c_custkey
LEFT JOIN visits v ON v.user_id = c_custkey
"""

SQL_TABLES["scores"] = f"""
SELECT "SK_ID_CURR", split, y_true,
       round(raw, 2) AS proba_champion, raw AS proba_champion_raw,
       CASE WHEN split = 'train' THEN NULL ELSE raw * 0.7e0 + ((k * 53) % 101) / 500e0 END AS proba_baseline
FROM (
  SELECT c_custkey AS "SK_ID_CURR", c_custkey AS k,
         CASE WHEN c_custkey % 10 IN (1, 2) THEN 'test' WHEN c_custkey % 10 IN (3, 4) THEN 'valid' ELSE 'train' END AS split,
         CAST(CASE WHEN {event_sql("c_custkey")} THEN 1 ELSE 0 END AS INTEGER) AS y_true,
         round(0.002e0 + pow(((c_custkey * 7919 + 13) % 10007) / 10007e0, 3) * 0.5e0
               + CASE WHEN {event_sql("c_custkey")} THEN ((c_custkey * 31) % 11) / 40e0 ELSE 0e0 END, 6) AS raw
  FROM customer
) s
"""

# a score table that lacks clients, for the joins that must find some without a score
SQL_TABLES["partial_scores"] = """SELECT * FROM scores WHERE "SK_ID_CURR" % 10 <> 5"""

SQL_TABLES["clients"] = """
SELECT b.*,
       round_even(-b."DAYS_BIRTH" / 365.25e0, 1) + 0e0 AS "AGE_YEARS",
       round_even(-b."DAYS_EMPLOYED" / 365.25e0, 1) + 0e0 AS "YEARS_EMPLOYED",
       b."AMT_CREDIT" / nullif(b."AMT_INCOME_TOTAL", 0) AS "CREDIT_INCOME_RATIO",
       b."AMT_ANNUITY" / nullif(b."AMT_INCOME_TOTAL", 0) AS "ANNUITY_INCOME_RATIO",
       b."AMT_ANNUITY" / nullif(b."AMT_CREDIT", 0) AS "CREDIT_TERM",
       (coalesce(b."EXT_SOURCE_1", 0) + coalesce(b."EXT_SOURCE_2", 0) + coalesce(b."EXT_SOURCE_3", 0))
         / nullif(CAST(b."EXT_SOURCE_1" IS NOT NULL AS INTEGER) + CAST(b."EXT_SOURCE_2" IS NOT NULL AS INTEGER)
         + CAST(b."EXT_SOURCE_3" IS NOT NULL AS INTEGER), 0) AS "EXT_SOURCE_MEAN",
       CAST(b."EXT_SOURCE_1" IS NOT NULL AS INTEGER) + CAST(b."EXT_SOURCE_2" IS NOT NULL AS INTEGER)
         + CAST(b."EXT_SOURCE_3" IS NOT NULL AS INTEGER) AS "N_EXT_SOURCE_PRESENT",
       s.split, s.y_true, s.proba_champion, s.proba_champion_raw, s.proba_baseline
FROM base_clients b LEFT JOIN scores s ON s."SK_ID_CURR" = b."SK_ID_CURR"
"""

SQL_TABLES["bureau"] = """
SELECT o_custkey AS "SK_ID_CURR", o_orderkey AS "SK_ID_BUREAU", o_totalprice AS amt,
       CASE WHEN o_orderkey % 6 = 1 THEN NULL ELSE o_orderstatus END AS active,
       o_orderpriority AS kind, date_diff('day', o_orderdate, TIMESTAMP '2001-08-01') * -1 AS "DAYS_DECISION"
FROM orders
"""

SQL_TABLES["bureau_balance"] = """
SELECT l_orderkey AS "SK_ID_BUREAU", l_quantity AS qty, l_returnflag AS status FROM lineitem
"""

SQL_TABLES["instalments"] = """
SELECT o_custkey AS "SK_ID_CURR", o_orderkey AS "SK_ID_PREV",
       CASE WHEN l_linenumber = 7 THEN 0e0 ELSE l_extendedprice END AS "AMT_INSTALMENT",
       CASE WHEN l_orderkey % 19 = 3 THEN NULL ELSE l_extendedprice * (1 - l_discount) END AS "AMT_PAYMENT",
       CASE WHEN l_partkey % 13 = 5 THEN NULL
            ELSE date_diff('day', TIMESTAMP '2001-08-01', o_orderdate) + l_partkey % 61 - 30 END AS "DAYS_ENTRY_PAYMENT",
       date_diff('day', TIMESTAMP '2001-08-01', o_orderdate) AS "DAYS_INSTALMENT"
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
"""


SQL_TABLES["loans"] = """
SELECT o_orderkey AS id, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS y, o_orderpriority AS grp,
       CAST(year(o_orderdate) AS INTEGER) AS yr,
       round(((o_orderkey * 7919 + 13) % 99991) / 99991e0 * 0.6e0
             + CASE WHEN o_orderstatus = 'F' THEN ((o_orderkey * 31) % 11) / 40e0 ELSE 0e0 END, 6) AS raw,
       round(((o_orderkey * 7919 + 13) % 99991) / 99991e0 * 0.6e0
             + CASE WHEN o_orderstatus = 'F' THEN ((o_orderkey * 31) % 11) / 40e0 ELSE 0e0 END, 2) AS score
FROM orders
"""


# monthly balances, one per line: urgent and high orders are cards, all others are point-of-sale loans
MONTHS_SQL = """-CAST(floor(date_diff('day', o_orderdate, TIMESTAMP '2001-08-01') / 30e0) AS BIGINT) AS "MONTHS_BALANCE" """

SQL_TABLES["pos_cash"] = f"""
SELECT o_custkey AS "SK_ID_CURR", o_orderkey AS "SK_ID_PREV", {MONTHS_SQL},
       CAST(l_quantity AS BIGINT) AS "CNT_INSTALMENT", l_partkey % 25 AS "CNT_INSTALMENT_FUTURE",
       CASE WHEN l_partkey % 13 = 5 THEN l_suppkey % 60 ELSE 0 END AS "SK_DPD", l_linestatus AS "NAME_CONTRACT_STATUS"
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
"""

SQL_TABLES["credit_card"] = f"""
SELECT o_custkey AS "SK_ID_CURR", o_orderkey AS "SK_ID_PREV", {MONTHS_SQL},
       l_extendedprice AS "AMT_BALANCE", l_extendedprice * l_discount AS "AMT_DRAWINGS_CURRENT",
       CASE WHEN l_quantity < 5 THEN 0e0 ELSE l_quantity * 3000 END AS "AMT_CREDIT_LIMIT_ACTUAL",
       CASE WHEN l_partkey % 13 = 5 THEN l_suppkey % 60 ELSE 0 END AS "SK_DPD", l_returnflag AS "NAME_CONTRACT_STATUS"
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
"""


# one training run per loan year: the newest runs are partly samples or rejected
SQL_TABLES["runs"] = """
SELECT CAST(yr AS VARCHAR) AS run_id, 'v' || CAST(yr % 5 AS VARCHAR) AS tag, CAST(yr AS INTEGER) AS trained_at,
       CASE WHEN yr = 1996 THEN 1000 END AS sample, CASE WHEN yr = 1999 THEN 'rejeitada' WHEN yr % 2 = 0 THEN 'aceita' END AS status,
       round(avg(score), 9) AS auc, round(avg(raw * raw), 9) AS ks, round(avg(pow(score - y, 2)), 9) AS brier,
       round(avg(CASE WHEN score < 0.35e0 THEN 1e0 ELSE 0e0 END), 9) AS approval_rate, count(*) AS n
FROM loans GROUP BY yr
"""

SQL_TABLES["run_segments"] = """
SELECT CAST(yr AS INTEGER) AS trained_at, CASE WHEN yr = 1996 THEN 1000 END AS sample, CASE WHEN yr = 1999 THEN 'rejeitada' WHEN yr % 2 = 0 THEN 'aceita' END AS status,
       'priority' AS dimension, grp AS "group", round(avg(score), 9) AS auc, count(*) AS n
FROM loans GROUP BY yr, grp
"""


def with_tables(sql: str) -> str:
    """Prefix the CTEs a check refers to (directly or through another scenario table)."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in SQL_TABLES.items():
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({SQL_TABLES[n].strip()})" for n in needed)
    stripped = sql.strip()
    if re.match(r"(?i)with\b", stripped):
        return f"WITH {ctes},\n{stripped[4:].strip()}"
    return f"WITH {ctes}\n{stripped}"


# ---------------------------------------------------------------- DataFrame twins


def base_clients(t) -> DataFrame:
    """Customers with their order history and event counts; the children are reduced before the joins."""
    history = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(
        F.count(F.lit(1)).alias("h_n"),
        F.avg("o_totalprice").alias("h_avg"),
        F.max("o_totalprice").alias("h_max"),
        F.min("o_totalprice").alias("h_min"),
        F.count_if(F.col("o_orderstatus") == "F").alias("h_final"),
    )
    visits = t.events.groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("v_n"))
    joined = t.customer.withColumnRenamed("c_custkey", "k").join(history, "k", "left").join(visits, "k", "left")
    return joined.selectExpr(
        "k AS SK_ID_CURR",
        f"int({event_sql('k')}) AS TARGET",
        "if(k % 97 = 5, NULL, if(k % 3 = 0, 'M', 'F')) AS CODE_GENDER",
        "if(k % 53 = 7, NULL, -(7300 + (k * 7919) % 18000)) AS DAYS_BIRTH",
        "if(k % 11 = 4, NULL, -((k * 104729) % 9000)) AS DAYS_EMPLOYED",
        "-((k * 31) % 8000) AS DAYS_REGISTRATION",
        "-((k * 17) % 4000) AS DAYS_ID_PUBLISH",
        "-((k * 13) % 2000) AS DAYS_LAST_PHONE_CHANGE",
        "int(k % 8) AS CNT_CHILDREN",
        "int(k % 8 + k % 2) AS CNT_FAM_MEMBERS",
        "h_avg AS AMT_INCOME_TOTAL",
        "h_max * 2D AS AMT_CREDIT",
        "h_min AS AMT_ANNUITY",
        "if(k % 29 = 3, 0D, h_max * 1.8D) AS AMT_GOODS_PRICE",
        "c_mktsegment AS NAME_EDUCATION_TYPE",
        "if(c_nationkey % 2 = 0, 'Cash loans', 'Revolving loans') AS NAME_CONTRACT_TYPE",
        "CASE c_nationkey % 5 WHEN 0 THEN 'Pensioner' WHEN 1 THEN 'Working' ELSE 'Commercial associate' END AS NAME_INCOME_TYPE",
        "CASE c_nationkey % 3 WHEN 0 THEN 'Married' WHEN 1 THEN 'Single' ELSE 'Widow' END AS NAME_FAMILY_STATUS",
        "if(k % 4 = 0, 'Rented apartment', 'House / apartment') AS NAME_HOUSING_TYPE",
        "if(k % 7 = 0, NULL, if(k % 7 < 4, 'Laborers', 'Managers')) AS OCCUPATION_TYPE",
        "CASE WHEN k % 6 < 2 THEN 'School' WHEN k % 6 < 4 THEN 'Trade' ELSE 'Self-employed' END AS ORGANIZATION_TYPE",
        "if(k % 2 = 0, 'Y', 'N') AS FLAG_OWN_CAR",
        "if(k % 5 < 3, 'Y', 'N') AS FLAG_OWN_REALTY",
        "if(k % 9 < 5, NULL, ((k * 271) % 1000) / 1000D) AS EXT_SOURCE_1",
        "((k * 337) % 1009) / 1009D AS EXT_SOURCE_2",
        "if(k % 5 = 2, NULL, ((k * 419) % 997) / 997D) AS EXT_SOURCE_3",
        "v_n AS BUREAU_COUNT",
        "h_n AS PREV_COUNT",
        "h_final AS INST_COUNT",
        "if(k % 3 = 1, h_n, NULL) AS POS_COUNT",
        "if(k % 4 = 1, h_n, NULL) AS CC_COUNT",
    )


def scores(t) -> DataFrame:
    """The score table of all clients: split, label and three scores."""
    raw = t.customer.selectExpr(
        "c_custkey AS k",
        f"{event_sql('c_custkey')} AS event",
        f"""round(0.002D + pow(((c_custkey * 7919 + 13) % 10007) / 10007D, 3) * 0.5D
                 + if({event_sql('c_custkey')}, ((c_custkey * 31) % 11) / 40D, 0D), 6) AS raw""",
    )
    return raw.selectExpr(
        "k AS SK_ID_CURR",
        "CASE WHEN k % 10 IN (1, 2) THEN 'test' WHEN k % 10 IN (3, 4) THEN 'valid' ELSE 'train' END AS split",
        "int(event) AS y_true",
        "round(raw, 2) AS proba_champion",
        "raw AS proba_champion_raw",
        "if(k % 10 IN (1, 2, 3, 4), raw * 0.7D + ((k * 53) % 101) / 500D, NULL) AS proba_baseline",
    )


def partial_scores(t) -> DataFrame:
    """The score table without one tenth of the clients."""
    return t.scores.filter("SK_ID_CURR % 10 <> 5")


def clients(t) -> DataFrame:
    """Client table left-joined with its scores."""
    base = t.base_clients
    have = ["CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO", "CREDIT_TERM"]
    ratios = features.ratio_columns()
    stats = features.nullable_stats(["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"], "EXT_SOURCE")
    wide = base.withColumns(
        {
            "AGE_YEARS": C.days_to_years("DAYS_BIRTH"),
            "YEARS_EMPLOYED": C.days_to_years("DAYS_EMPLOYED"),
            **{n: ratios[n] for n in have},
            "EXT_SOURCE_MEAN": stats["EXT_SOURCE_MEAN"],
            "N_EXT_SOURCE_PRESENT": stats["N_EXT_SOURCE_PRESENT"].cast("int"),
        }
    )
    return wide.join(t.scores, "SK_ID_CURR", "left")


def bureau(t) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_BUREAU"),
        F.col("o_totalprice").alias("amt"),
        F.when(F.col("o_orderkey") % 6 != 1, F.col("o_orderstatus")).alias("active"),
        F.col("o_orderpriority").alias("kind"),
        (-F.datediff(F.lit("2001-08-01").cast("date"), "o_orderdate")).alias("DAYS_DECISION"),
    )


def bureau_balance(t) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        F.col("l_quantity").alias("qty"),
        F.col("l_returnflag").alias("status"),
    )


def instalments(t) -> DataFrame:
    due = F.datediff(F.col("o_orderdate"), F.lit("2001-08-01").cast("date")).cast("long")
    joined = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_PREV"),
        F.when(F.col("l_linenumber") == 7, 0.0).otherwise(F.col("l_extendedprice")).alias("AMT_INSTALMENT"),
        F.when(
            F.col("l_orderkey") % 19 != 3,
            F.col("l_extendedprice") * (1 - F.col("l_discount")),
        ).alias("AMT_PAYMENT"),
        F.when(F.col("l_partkey") % 13 != 5, due + F.col("l_partkey") % 61 - 30).alias("DAYS_ENTRY_PAYMENT"),
        due.alias("DAYS_INSTALMENT"),
    )


def monthly(t, cards: bool) -> DataFrame:
    """Lines with their order, of one kind of loan, and the columns that both kinds have."""
    card = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    days = F.datediff(F.lit("2001-08-01").cast("date"), "o_orderdate")
    joined = t.lineitem.join(t.orders.filter(card if cards else ~card), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.withColumns(
        {
            "SK_ID_CURR": F.col("o_custkey"),
            "SK_ID_PREV": F.col("o_orderkey"),
            "MONTHS_BALANCE": -F.floor(days / 30.0),
            "SK_DPD": F.when(F.col("l_partkey") % 13 == 5, F.col("l_suppkey") % 60).otherwise(0),
        }
    )


def pos_cash(t) -> DataFrame:
    return monthly(t, False).select(
        "SK_ID_CURR", "SK_ID_PREV", "MONTHS_BALANCE",
        F.col("l_quantity").cast("long").alias("CNT_INSTALMENT"),
        (F.col("l_partkey") % 25).alias("CNT_INSTALMENT_FUTURE"),
        "SK_DPD",
        F.col("l_linestatus").alias("NAME_CONTRACT_STATUS"),
    )


def credit_card(t) -> DataFrame:
    return monthly(t, True).select(
        "SK_ID_CURR", "SK_ID_PREV", "MONTHS_BALANCE",
        F.col("l_extendedprice").alias("AMT_BALANCE"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("AMT_DRAWINGS_CURRENT"),
        F.when(F.col("l_quantity") < 5, 0.0).otherwise(F.col("l_quantity") * 3000).alias("AMT_CREDIT_LIMIT_ACTUAL"),
        "SK_DPD",
        F.col("l_returnflag").alias("NAME_CONTRACT_STATUS"),
    )


def loans(t) -> DataFrame:
    """Orders as scored loans: a label, a near-continuous score and its rounded, tied twin."""
    k, event = F.col("o_orderkey"), F.col("o_orderstatus") == "F"
    mix = ((k * 7919 + 13) % 99991) / 99991.0 * 0.6 + F.when(event, ((k * 31) % 11) / 40.0).otherwise(0.0)
    return t.orders.select(
        k.alias("id"),
        event.cast("int").alias("y"),
        F.col("o_orderpriority").alias("grp"),
        F.year("o_orderdate").alias("yr"),
        F.round(mix, 6).alias("raw"),
        F.round(mix, 2).alias("score"),
    )


def run_flags() -> list:
    yr = F.col("yr")
    return [
        F.when(yr == 1996, 1000).alias("sample"),
        F.when(yr == 1999, "rejeitada").when(yr % 2 == 0, "aceita").alias("status"),
    ]


def runs(t) -> DataFrame:
    yr = F.col("yr")
    per = t.loans.groupBy("yr").agg(
        F.round(F.avg("score"), 9).alias("auc"),
        F.round(F.avg(F.col("raw") * F.col("raw")), 9).alias("ks"),
        F.round(F.avg(F.pow(F.col("score") - F.col("y"), 2)), 9).alias("brier"),
        F.round(C.share(F.col("score") < 0.35), 9).alias("approval_rate"),
        F.count(F.lit(1)).alias("n"),
    )
    return per.select(
        yr.cast("string").alias("run_id"),
        F.concat(F.lit("v"), (yr % 5).cast("string")).alias("tag"),
        yr.cast("int").alias("trained_at"),
        *run_flags(),
        "auc", "ks", "brier", "approval_rate", "n",
    )


def run_segments(t) -> DataFrame:
    per = t.loans.groupBy("yr", "grp").agg(
        F.round(F.avg("score"), 9).alias("auc"), F.count(F.lit(1)).alias("n")
    )
    return per.select(
        F.col("yr").cast("int").alias("trained_at"),
        *run_flags(),
        F.lit("priority").alias("dimension"),
        F.col("grp").alias("group"),
        "auc", "n",
    )


TABLES = {
    "runs": runs,
    "run_segments": run_segments,
    "loans": loans,
    "base_clients": base_clients,
    "scores": scores,
    "partial_scores": partial_scores,
    "clients": clients,
    "bureau": bureau,
    "bureau_balance": bureau_balance,
    "instalments": instalments,
    "pos_cash": pos_cash,
    "credit_card": credit_card,
}
