"""Queries: contract, missing data, parsing, binning, encoding, descriptive tables, sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.functions.columns import cut, normalise_missing
from driftloom.functions.joins import row_bound
from driftloom.operators import bins, contract, eda, encode, missing, parse
from driftloom.session import durable, durable_dir
from driftloom.sources import tables
from driftloom.specs import FieldRule
from workload.fixtures import GAPS_SQL, MARKET_SQL, gaps, market
from workload.registry import load, query, r6

CUSTOMER_RULES = (
    FieldRule("c_custkey", required=True),
    FieldRule("segment", allowed=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"), case="upper", null_default="BUILDING"),
    FieldRule("c_acctbal", low=-500.0, high=9500.0),
    FieldRule("name", required=True, min_length=2, max_length=16),
    FieldRule("channel", default="unknown"),
)

CUSTOMER_SQL = """
raw AS (
  SELECT c_custkey, c_acctbal, substr(c_name, 1, CAST(10 + c_custkey % 9 AS INTEGER)) AS name,
         CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN '  ' || lower(c_mktsegment) || ' '
              ELSE c_mktsegment END AS segment
  FROM customer),
checked AS (
  SELECT c_custkey, c_acctbal, name, coalesce(upper(trim(segment)), 'BUILDING') AS segment, 'unknown' AS channel
  FROM raw),
marked AS (
  SELECT *, concat_ws(',',
      CASE WHEN segment NOT IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD') THEN 'segment:enum' END,
      CASE WHEN NOT c_acctbal BETWEEN -500 AND 9500 THEN 'c_acctbal:range' END,
      CASE WHEN NOT length(name) BETWEEN 2 AND 16 THEN 'name:length' END,
      CASE WHEN segment = 'BUILDING' AND c_acctbal < 0 THEN 'builders_in_credit' END) AS violations
  FROM checked)
"""


def _customers(spark, sf):
    key = F.col("c_custkey")
    padded = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    raw = load(spark, sf, "customer").select(
        "c_custkey",
        "c_acctbal",
        F.expr("substring(c_name, 1, cast(10 + c_custkey % 9 as int))").alias("name"),
        F.when(key % 13 == 0, None).when(key % 5 == 0, padded).otherwise(F.col("c_mktsegment")).alias("segment"),
    )
    cross = {"builders_in_credit": ~((F.col("segment") == "BUILDING") & (F.col("c_acctbal") < 0))}
    return contract.check(contract.normalise(raw, CUSTOMER_RULES), CUSTOMER_RULES, cross)


@query(
    f"WITH {CUSTOMER_SQL} SELECT c_custkey, c_acctbal, name, segment, channel, violations, "
    "violations = '' AS is_valid FROM marked"
)
def contract_split(spark, sf):
    checked = _customers(spark, sf)
    good = contract.valid_rows(checked).withColumns({"violations": F.lit(""), "is_valid": F.lit(True)})
    bad = contract.quarantine(checked).withColumns(
        {"violations": F.array_join("violations", ","), "is_valid": F.lit(False)}
    )
    return r6(good.unionByName(bad))


@query(
    f"WITH {CUSTOMER_SQL}, parts AS (SELECT unnest(string_split(violations, ',')) AS rule FROM marked "
    "WHERE violations <> '') SELECT rule, count(*) AS n FROM parts GROUP BY rule"
)
def contract_summary(spark, sf):
    return contract.violation_summary(_customers(spark, sf))


@query(
    f"WITH {GAPS_SQL} SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE x1 END AS x1, x2 FROM gaps"
)
def nan_is_missing(spark, sf):
    dirty = gaps(spark, sf).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("x1")).alias("x1"), "x2"
    )
    return normalise_missing(dirty)


@query(
    f"""WITH {GAPS_SQL}
    SELECT 'x1' AS "column", count(*) AS rows, count(*) - count(x1) AS missing,
           round((count(*) - count(x1)) * 100.0 / count(*), 2) AS missing_pct FROM gaps UNION ALL
    SELECT 'x2', count(*), count(*) - count(x2), round((count(*) - count(x2)) * 100.0 / count(*), 2) FROM gaps UNION ALL
    SELECT 'x3', count(*), count(*) - count(x3), round((count(*) - count(x3)) * 100.0 / count(*), 2) FROM gaps UNION ALL
    SELECT 'priority', count(*), count(*) - count(priority),
           round((count(*) - count(priority)) * 100.0 / count(*), 2) FROM gaps"""
)
def missing_pct(spark, sf):
    return missing.missing_percent(gaps(spark, sf), ["x1", "x2", "x3", "priority"])


@query(
    f"""WITH {GAPS_SQL}, masks AS (
      SELECT x1 IS NULL AS a, x2 IS NULL AS b, priority IS NULL AS c, count(*) AS n FROM gaps GROUP BY 1, 2, 3)
    SELECT row_number() OVER (ORDER BY a, b, c) AS pattern_id,
           concat_ws(',', CASE WHEN NOT a THEN 'x1' END, CASE WHEN NOT b THEN 'x2' END, CASE WHEN NOT c THEN 'priority' END)
             AS observed_columns,
           concat_ws(',', CASE WHEN a THEN 'x1' END, CASE WHEN b THEN 'x2' END, CASE WHEN c THEN 'priority' END)
             AS missing_columns,
           n AS count, round(n * 100.0 / (SELECT count(*) FROM gaps), 2) AS percentage
    FROM masks"""
)
def missing_patterns(spark, sf):
    found = missing.missing_patterns(gaps(spark, sf), ["x1", "x2", "priority"])
    return found.withColumns({c: F.array_join(c, ",") for c in ("observed_columns", "missing_columns")})


def _imputed(spark, sf, strategy):
    df = gaps(spark, sf)
    return r6(missing.fill(df, missing.fill_values(df, ["x1", "x2"], strategy)).select("o_orderkey", "x1", "x2"))


@query(
    f"""WITH {GAPS_SQL} SELECT o_orderkey, round(coalesce(x1, (SELECT avg(x1) FROM gaps)), 6) AS x1,
    round(coalesce(x2, (SELECT avg(x2) FROM gaps)), 6) AS x2 FROM gaps"""
)
def impute_mean(spark, sf):
    return _imputed(spark, sf, "mean")


@query(
    f"""WITH {GAPS_SQL} SELECT o_orderkey, round(coalesce(x1, (SELECT quantile_cont(x1, 0.5) FROM gaps)), 6) AS x1,
    round(coalesce(x2, (SELECT quantile_cont(x2, 0.5) FROM gaps)), 6) AS x2 FROM gaps"""
)
def impute_median(spark, sf):
    return _imputed(spark, sf, "median")


@query(
    f"""WITH {GAPS_SQL} SELECT o_orderkey,
    coalesce(x3, 0) AS x3,
    coalesce(priority, (SELECT priority FROM gaps WHERE priority IS NOT NULL GROUP BY 1
                        ORDER BY count(*) DESC, priority LIMIT 1)) AS priority
    FROM gaps"""
)
def impute_mode(spark, sf):
    df = gaps(spark, sf).select("o_orderkey", "x3", "priority")
    return missing.fill(df, missing.fill_values(df, ["priority"], "most_frequent"))


@query(f"WITH {GAPS_SQL} SELECT o_orderkey, coalesce(x1, 0) AS x1, coalesce(x2, 0) AS x2 FROM gaps")
def impute_constant(spark, sf):
    return _imputed(spark, sf, "constant")


@query(
    f"""WITH {GAPS_SQL} SELECT o_orderkey, CAST(x1 IS NULL AS INTEGER) AS x1_is_na,
    CAST(x2 IS NULL AS INTEGER) AS x2_is_na FROM gaps"""
)
def missing_flags(spark, sf):
    df = gaps(spark, sf).select("o_orderkey", "x1", "x2", "x3")
    cols = ["x1", "x2", "x3"]
    flagged = missing.indicators(df, missing.columns_with_missing(df, cols), cols)
    return flagged.drop(*cols)


@query(
    f"""WITH {GAPS_SQL}, med AS (SELECT x3, quantile_cont(x1, 0.5) AS m FROM gaps GROUP BY x3)
    SELECT o_orderkey, round(coalesce(x1, m), 6) AS x1 FROM gaps LEFT JOIN med USING (x3)"""
)
def impute_group_median(spark, sf):
    df = gaps(spark, sf)
    medians = durable(missing.group_medians(df, "x3", "x1"))
    filled = missing.fill_group_median(df, medians, "x3", "x1", row_bound(medians))
    return r6(filled.select("o_orderkey", "x1"))


NAMES_SQL = """
names AS (
  SELECT c_custkey,
         CASE c_custkey % 12 WHEN 0 THEN 'Cumings, Mrs. John' WHEN 1 THEN 'Noname' WHEN 2 THEN 'X, the Countess. of'
           WHEN 3 THEN 'Z, Mr. Q' WHEN 4 THEN 'Z, Mlle. Q' WHEN 5 THEN 'Z, Mme. Q' WHEN 6 THEN 'Z, Dr. Q'
           WHEN 7 THEN 'Z, Rev. Q' WHEN 8 THEN 'Z, Col. Q' WHEN 9 THEN 'Z,  Master . Q' WHEN 10 THEN NULL
           ELSE c_name || ', Ms. ' || c_mktsegment END AS name,
         CASE c_custkey % 7 WHEN 0 THEN 'A/5. ' || c_custkey WHEN 1 THEN NULL WHEN 2 THEN 'pc ' || c_custkey
           WHEN 3 THEN 'LINE' WHEN 4 THEN '' WHEN 5 THEN CAST(c_custkey AS VARCHAR) ELSE c_mktsegment END AS ticket,
         CASE c_custkey % 5 WHEN 0 THEN 'c' || c_custkey WHEN 1 THEN '  ' WHEN 2 THEN ' f g73' WHEN 3 THEN NULL
           ELSE c_name END AS cabin
  FROM customer)
"""


def _names(spark, sf):
    load(spark, sf, "customer").createOrReplaceTempView("customer")
    return spark.sql(f"WITH {NAMES_SQL.replace('VARCHAR', 'STRING')} SELECT * FROM names")


@query(
    rf"""WITH {NAMES_SQL}, titles AS (
      SELECT *, trim(coalesce(regexp_extract(name, ',\s*([^.]+)\.', 1), '')) AS title FROM names)
    SELECT c_custkey, title,
      CASE WHEN title IN ('Mr','Miss','Mrs','Master') THEN title WHEN title IN ('Mlle','Ms') THEN 'Miss'
           WHEN title = 'Mme' THEN 'Mrs' WHEN title IN ('Dr','Prof') THEN 'Rare_Prof' WHEN title = 'Rev' THEN 'Rare_Clergy'
           WHEN title IN ('Col','Major','Capt') THEN 'Rare_Military' ELSE 'Rare' END AS title_group,
      CASE WHEN cabin IS NULL OR trim(cabin) = '' THEN 'U' ELSE upper(substr(trim(cabin), 1, 1)) END AS deck,
      CASE WHEN ticket IS NULL OR ticket = '' THEN 'NUMERIC'
           WHEN regexp_matches(trim(regexp_replace(ticket, '[./]', '', 'g')), '^[0-9]+$') THEN 'NUMERIC'
           ELSE upper(string_split_regex(trim(regexp_replace(ticket, '[./]', '', 'g')), '\s+')[1]) END AS prefix
    FROM titles"""
)
def parse_strings(spark, sf):
    title = parse.courtesy_title("name")
    return _names(spark, sf).select(
        "c_custkey",
        title.alias("title"),
        parse.group_rare(title).alias("title_group"),
        parse.first_letter("cabin").alias("deck"),
        parse.code_prefix("ticket").alias("prefix"),
    )


@query(
    """SELECT page_id, coalesce(regexp_extract(url, '^https?://([^/]+)/', 1), '') AS host,
    CASE WHEN trim(url) = '' THEN 'U' ELSE upper(substr(trim(url), 1, 1)) END AS first_letter FROM pages"""
)
def parse_urls(spark, sf):
    return load(spark, sf, "pages").select(
        "page_id",
        F.regexp_extract("url", r"^https?://([^/]+)/", 1).alias("host"),
        parse.first_letter("url").alias("first_letter"),
    )


@query(
    f"""WITH {MARKET_SQL} SELECT o_orderkey, family + family % 3 + 1 AS family_size,
    CAST(family + family % 3 + 1 = 2 AS INTEGER) AS is_alone, CAST(label = 1 AS INTEGER) AS has_label,
    round(o_totalprice / (family + family % 3 + 1), 6) AS price_per_person,
    CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(family AS INTEGER) ELSE 0 END AS family_builders
    FROM market"""
)
def row_features(spark, sf):
    df = market(spark, sf).withColumn("family_size", parse.family_size("family", F.col("family") % 3))
    return df.select(
        "o_orderkey",
        "family_size",
        parse.flag(F.col("family_size") == 2).alias("is_alone"),
        parse.flag(F.col("label") == 1).alias("has_label"),
        F.round(F.col("o_totalprice") / F.col("family_size"), 6).alias("price_per_person"),
        parse.interaction("family", F.col("c_mktsegment") == "BUILDING").alias("family_builders"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity,
    CASE WHEN l_quantity < 12 THEN 'Child' WHEN l_quantity < 18 THEN 'Teen' WHEN l_quantity < 35 THEN 'Adult'
         WHEN l_quantity < 60 THEN 'Middle' ELSE 'Senior' END AS left_closed,
    CASE WHEN l_linenumber <= 1 THEN 'Solo' WHEN l_linenumber <= 4 THEN 'Small' ELSE 'Large' END AS right_closed,
    CASE WHEN l_quantity > 5 AND l_quantity <= 10 THEN 'a' WHEN l_quantity > 10 AND l_quantity <= 20 THEN 'b'
         ELSE 'none' END AS partial
    FROM lineitem"""
)
def cut_fixed(spark, sf):
    return load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        bins.age_bin("l_quantity").alias("left_closed"),
        bins.family_bin("l_linenumber").alias("right_closed"),
        cut("l_quantity", [5, 10, 20], ["a", "b"], default="none").alias("partial"),
    )


@query(
    """WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS q2,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)
    SELECT o_orderkey, CASE WHEN o_totalprice <= q1 THEN 'Q1' WHEN o_totalprice <= q2 THEN 'Q2'
      WHEN o_totalprice <= q3 THEN 'Q3' ELSE 'Q4' END AS bin FROM orders, q"""
)
def cut_quantile(spark, sf):
    orders = load(spark, sf, "orders")
    fitted = bins.quartiles(orders, "o_totalprice")
    return orders.select("o_orderkey", bins.quantile_bin("o_totalprice", fitted).alias("bin"))


@query(
    """WITH f AS (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey % 10 <> 0 GROUP BY 1)
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, coalesce(f.n, 1) AS part_frequency
    FROM lineitem l LEFT JOIN f ON l.l_partkey = f.l_partkey"""
)
def freq_encode(spark, sf):
    items = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    counts = encode.key_counts(items.where(F.col("l_partkey") % 10 != 0), "l_partkey")
    return encode.frequency_encode(items, counts, "l_partkey", "part_frequency", spread_by=["l_orderkey", "l_linenumber"])


@query(
    """SELECT o_orderkey, CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS "o_orderpriority_2-HIGH",
    CAST(o_orderpriority = '3-MEDIUM' AS INTEGER) AS "o_orderpriority_3-MEDIUM",
    CAST(o_orderpriority = '4-NOT SPECIFIED' AS INTEGER) AS "o_orderpriority_4-NOT SPECIFIED",
    CAST(o_orderpriority = '5-LOW' AS INTEGER) AS "o_orderpriority_5-LOW",
    CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O", CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P"
    FROM orders"""
)
def one_hot_drop_first(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return encode.one_hot(orders, encode.freeze_categories(orders, ["o_orderpriority", "o_orderstatus"]))


@query("SELECT o_orderkey, o_totalprice, 0 AS not_there, o_custkey FROM orders")
def align_schema(spark, sf):
    orders = encode.drop_label(load(spark, sf, "orders"), "o_orderstatus")
    return encode.align(orders, ["o_totalprice", "not_there", "o_custkey"], keep=["o_orderkey"])


@query("SELECT o_orderkey, o_custkey FROM orders")
def select_columns(spark, sf):
    return encode.select_columns(load(spark, sf, "orders"), ["o_orderkey", "not_there", "o_custkey"])


TE_SQL = """
te AS (SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END, 'nan') AS priority,
  CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS y, o_orderkey % 5 AS fold FROM orders)
"""


def _te_input(spark, sf):
    k = F.col("o_orderkey")
    return load(spark, sf, "orders").select(
        "o_orderkey",
        F.when(k % 11 != 0, F.col("o_orderpriority")).alias("priority"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (k % 5).alias("fold"),
    )


@query(
    f"""WITH {TE_SQL}, g AS (SELECT avg(y) AS g FROM te),
    enc AS (SELECT priority, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS e FROM te, g GROUP BY priority)
    SELECT o_orderkey, round(e, 6) AS "priority_TE", round(g, 6) AS "absent_TE" FROM te JOIN enc USING (priority), g"""
)
def target_encode(spark, sf):
    df = _te_input(spark, sf)
    table = encode.target_encoding(df, ["priority"], "y", 10.0)
    prior = df.agg(F.avg(F.col("y").cast("double"))).scalar()
    out = encode.apply_target_encoding(df, table, ["priority", "absent"], prior, spread_by=["o_orderkey"])
    return r6(out.select("o_orderkey", "priority_TE", "absent_TE"))


@query(
    f"""WITH {TE_SQL},
    folds AS (SELECT f.fold, avg(te.y) AS g FROM (SELECT DISTINCT fold FROM te) f JOIN te ON te.fold <> f.fold GROUP BY 1),
    enc AS (SELECT f.fold, te.priority, (sum(te.y) + 10 * any_value(f.g)) / (count(*) + 10) AS e
            FROM folds f JOIN te ON te.fold <> f.fold GROUP BY 1, 2)
    SELECT te.o_orderkey, te.fold, round(coalesce(e, g), 6) AS "priority_TE"
    FROM te JOIN folds USING (fold) LEFT JOIN enc ON enc.fold = te.fold AND enc.priority = te.priority"""
)
def target_encode_oof(spark, sf):
    df = _te_input(spark, sf)
    table = encode.fold_encoding(df, ["priority"], "y", "fold", 10.0)
    out = encode.apply_fold_encoding(df, table, ["priority"], "fold", spread_by=["o_orderkey"])
    return r6(out.select("o_orderkey", "fold", "priority_TE"))


@query(
    f"""WITH {MARKET_SQL} SELECT count(*) AS total, CAST(sum(label) AS BIGINT) AS positives,
    round(avg(label) * 100, 2) AS positive_rate, round(avg(c_acctbal), 1) AS avg_c_acctbal,
    round(avg(o_totalprice), 2) AS avg_o_totalprice, CAST(count(*) - sum(label) AS BIGINT) AS negatives,
    round(quantile_cont(o_totalprice, 0.5), 2) AS median_o_totalprice FROM market"""
)
def kpi(spark, sf):
    return eda.kpis(market(spark, sf), "label", "c_acctbal", "o_totalprice")


@query(
    f"""WITH {MARKET_SQL} SELECT o_orderpriority, c_mktsegment, count(label) AS total,
    round(avg(label) * 100, 1) AS rate_pct FROM market GROUP BY 1, 2"""
)
def group_two_keys(spark, sf):
    return eda.group_rate(market(spark, sf), ["o_orderpriority", "c_mktsegment"], "label")


@query(
    f"""WITH {MARKET_SQL} SELECT CASE r_name WHEN 'ASIA' THEN 'East' WHEN 'EUROPE' THEN 'West' ELSE 'Unknown' END AS side,
    count(label) AS total, round(avg(label) * 100, 1) AS rate_pct, round(avg(o_totalprice), 2) AS avg_o_totalprice
    FROM market GROUP BY 1"""
)
def group_lookup(spark, sf):
    df = market(spark, sf).withColumn("side", eda.named("r_name", {"ASIA": "East", "EUROPE": "West"}))
    return eda.group_rate(df, ["side"], "label", ["o_totalprice"])


@query(
    f"""WITH {MARKET_SQL}, bins(bin, lo, hi) AS (VALUES ('one', 0, 1), ('few', 1, 4), ('many', 4, 8), ('crowd', 11, 20)),
    edges(bin, lo, hi) AS (VALUES ('one', 0, 1), ('few', 1, 4), ('many', 4, 8), ('none', 8, 8.5))
    SELECT e.bin, count(m.label) AS total, round(avg(m.label) * 100, 1) AS rate_pct
    FROM edges e LEFT JOIN market m ON m.family > e.lo AND m.family <= e.hi GROUP BY e.bin"""
)
def group_empty_bins(spark, sf):
    return eda.group_by_bins(market(spark, sf), "family", [0, 1, 4, 8, 8.5], ["one", "few", "many", "none"], "label")


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "\nUNION ALL\n".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) + 0.0 AS corr FROM lineitem"
        for i, a in enumerate(CORR_COLS)
        for b in CORR_COLS[:i]
    )
)
def corr_matrix(spark, sf):
    return r6(eda.correlations(load(spark, sf, "lineitem"), CORR_COLS, lower_only=True))


@query(
    """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
      quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1)
    SELECT l_returnflag, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
      round(least(min(l_extendedprice) FILTER (l_extendedprice >= q1 - 1.5 * (q3 - q1)), any_value(q1)), 6) AS whisker_low,
      round(greatest(max(l_extendedprice) FILTER (l_extendedprice <= q3 + 1.5 * (q3 - q1)), any_value(q3)), 6) AS whisker_high
    FROM lineitem JOIN q USING (l_returnflag) GROUP BY l_returnflag"""
)
def box_stats(spark, sf):
    return r6(eda.box_stats(load(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag"))


@query(f"WITH {MARKET_SQL} SELECT o_orderpriority, o_orderstatus, round(avg(c_acctbal), 6) AS mean FROM market GROUP BY 1, 2")
def grouped_mean(spark, sf):
    df = market(spark, sf)
    return r6(eda.moments(df, "c_acctbal", ["o_orderpriority", "o_orderstatus"]).drop("std"))


@query(
    f"""WITH {MARKET_SQL}, c AS (
      SELECT 'urgent builders' AS cohort, label FROM market WHERE o_orderpriority = '1-URGENT' AND c_mktsegment = 'BUILDING'
      UNION ALL SELECT 'rich', label FROM market WHERE c_acctbal > 5000
      UNION ALL SELECT 'small family', label FROM market WHERE family BETWEEN 2 AND 4
      UNION ALL SELECT 'closed', label FROM market WHERE o_orderstatus <> 'O')
    SELECT cohort, count(*) AS n, round(avg(label) * 100, 1) AS rate_pct,
      CASE WHEN round(avg(label) * 100, 1) >= 40 THEN 'high' WHEN round(avg(label) * 100, 1) >= 33.3 THEN 'middle'
           ELSE 'low' END AS level
    FROM c GROUP BY cohort"""
)
def cohorts(spark, sf):
    named = {
        "urgent builders": (F.col("o_orderpriority") == "1-URGENT") & (F.col("c_mktsegment") == "BUILDING"),
        "rich": F.col("c_acctbal") > 5000,
        "small family": F.col("family").between(2, 4),
        "closed": F.col("o_orderstatus") != "O",
    }
    return eda.cohorts(market(spark, sf), named, "label", [(40.0, "high"), (33.3, "middle"), (0.0, "low")])


DIMS = ["o_orderpriority", "c_mktsegment", "r_name"]


def _marginal_sql(sets: str) -> str:
    return f"""WITH {MARKET_SQL} SELECT {', '.join(DIMS)}, CAST(grouping_id({', '.join(DIMS)}) AS BIGINT) AS grouping,
    count(*) AS n, round(avg(label), 6) AS rate FROM market GROUP BY {sets}"""


@query(_marginal_sql("GROUPING SETS (" + ", ".join(f"({d})" for d in DIMS) + ")"))
def grouping_sets(spark, sf):
    return r6(eda.marginals(market(spark, sf), DIMS, "label"))


@query(_marginal_sql(f"ROLLUP ({', '.join(DIMS)})"))
def rollup(spark, sf):
    return r6(eda.marginals(market(spark, sf), DIMS, "label", "rollup"))


@query(_marginal_sql(f"CUBE ({', '.join(DIMS)})"))
def cube(spark, sf):
    return r6(eda.marginals(market(spark, sf), DIMS, "label", "cube"))


@query(f"WITH {GAPS_SQL} SELECT priority, count(*) AS n FROM gaps GROUP BY 1")
def value_counts(spark, sf):
    return eda.value_counts(gaps(spark, sf), "priority")


@query(
    """WITH t AS (SELECT l_returnflag, round(avg(l_quantity), 6) AS qty, round(avg(l_discount), 6) AS disc
                  FROM lineitem GROUP BY 1)
    SELECT l_returnflag, 'qty' AS metric, qty AS value FROM t UNION ALL SELECT l_returnflag, 'disc', disc FROM t"""
)
def melt_report(spark, sf):
    wide = load(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.avg("l_quantity").alias("qty"), F.avg("l_discount").alias("disc"))
    return r6(eda.melt(wide, ["l_returnflag"], ["qty", "disc"]))


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 25")
def topk(spark, sf):
    return eda.top(load(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey", 25)


@query(
    """SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean_ms, round(quantile_cont(value, 0.95), 6) AS p95_ms,
    round(quantile_cont(value, 0.99), 6) AS p99_ms FROM events GROUP BY 1"""
)
def latency_summary(spark, sf):
    return r6(eda.latency_summary(load(spark, sf, "events"), "value", ["event_type"]))


PAYLOAD_ITEM = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType())])


@query("SELECT source, doc_id, lang FROM documents")
def nested_payload(spark, sf):
    docs = load(spark, sf, "documents").withColumn("block", F.expr("doc_id div 50"))
    records = F.collect_list(F.struct("doc_id", "lang"))
    payloads = docs.groupBy("source", "block").agg(F.to_json(records).alias("body"))
    return tables.explode_payload(payloads, "body", PAYLOAD_ITEM, keep=["source"])


def _scratch(spark, name):
    return f"{durable_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT c_custkey, 'last, \"first\" ' || c_name AS name, c_acctbal FROM customer")
def csv_round_trip(spark, sf):
    path = _scratch(spark, "csv")
    rows = load(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit('last, "first" '), "c_name").alias("name"), "c_acctbal"
    )
    rows.write.option("header", True).option("escape", '"').csv(path)
    return tables.read_csv(spark, path, rows.schema)


@query("SELECT n_name, n_regionkey, CAST(n_nationkey AS BIGINT) AS rank FROM nation")
def json_round_trip(spark, sf):
    path = _scratch(spark, "json")
    rows = load(spark, sf, "nation").select("n_name", "n_regionkey", F.col("n_nationkey").cast("long").alias("rank"))
    tables.write_json(rows, path)
    return tables.read_json(spark, path, rows.schema)


@query("SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 6) AS mean FROM part GROUP BY 1")
def report_csv(spark, sf):
    path = _scratch(spark, "report")
    report = r6(load(spark, sf, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.avg("p_retailprice").alias("mean")))
    tables.write_report(report, path, "n", "p_brand")
    return tables.read_csv(spark, path, report.schema)


@query(
    """SELECT o_orderkey AS "OrderId", CAST(o_totalprice >= 250000 AS INTEGER) AS "Large" FROM orders"""
)
def submission_csv(spark, sf):
    path = _scratch(spark, "submission")
    rows = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_totalprice") >= 250000).cast("int").alias("prediction")
    )
    tables.write_submission(rows, "OrderId", path, "Large")
    return tables.read_csv(
        spark, path, T.StructType([T.StructField("OrderId", T.LongType()), T.StructField("Large", T.IntegerType())])
    )
