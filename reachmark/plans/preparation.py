"""Projection, cleaning, lookup, sampling and encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reachmark.functions import columns as X
from reachmark.functions import text as N
from reachmark.functions.regions import STATE_REGIONS, state_regions
from reachmark.operators import arms as A
from reachmark.operators import encoding as E
from reachmark.operators import lookup as J
from reachmark.operators import sampling as B
from reachmark.operators import select as S
from reachmark.plans.registry import query, rounded
from reachmark.plans.views import campaign, contacts, names, region_dim, table, with_views

KEY, LABEL = "account_id", "flg_resp"


# Projection ----------------------------------------------------------------------------

@query("project_existing", with_views("campaign", "SELECT account_id, x_price, region FROM campaign"))
def project_existing(spark, sf_dir):
    return S.keep_columns(campaign(spark, sf_dir), ["account_id", "x_price", "not_there", "region"])


@query("project_exclude", with_views("campaign", "SELECT account_id, market_segment, list_name, region, ref_score FROM campaign"))
def project_exclude(spark, sf_dir):
    df = campaign(spark, sf_dir, "account_id", "mail_date", "load_year", "flg_resp", "market_segment", "list_name", "region", "ref_score")
    return S.drop_columns(df, ["mail_date", "load_year", "flg_resp", "not_there"])


@query(
    "column_roles",
    with_views("campaign", """, one AS (SELECT market_segment, list_name, x_price, x_qty, flg_resp FROM campaign),
 d AS (SELECT 'market_segment' AS variable, typeof(any_value(market_segment)) AS t FROM one UNION ALL SELECT 'list_name', typeof(any_value(list_name)) FROM one
  UNION ALL SELECT 'x_price', typeof(any_value(x_price)) FROM one UNION ALL SELECT 'x_qty', typeof(any_value(x_qty)) FROM one)
 SELECT variable, CASE WHEN t = 'VARCHAR' THEN 'categorical' ELSE 'numeric' END AS role,
  CAST(CASE variable WHEN 'market_segment' THEN (SELECT COUNT(market_segment) FROM one) WHEN 'list_name' THEN (SELECT COUNT(list_name) FROM one)
   WHEN 'x_price' THEN (SELECT COUNT(x_price) FROM one) ELSE (SELECT COUNT(x_qty) FROM one) END AS BIGINT) AS present FROM d"""),
)
def column_roles(spark, sf_dir):
    df = campaign(spark, sf_dir, "account_id", "market_segment", "list_name", "x_price", "x_qty", LABEL)
    roles = S.column_roles(df, LABEL, exclude=["account_id"])
    kind = {c: "categorical" for c in roles.categorical} | {c: "numeric" for c in roles.numeric}
    cols = [c for c in df.columns if c in kind and c != LABEL]
    counts = df.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], cols, "variable", "present")
    role = F.when(F.col("variable").isin(roles.categorical), "categorical").otherwise("numeric")
    return counts.select("variable", role.alias("role"), "present")


@query("filter_segment", with_views("campaign", "SELECT account_id, x_bal FROM campaign WHERE class_type = 'C1' AND market_segment IS NOT NULL AND flg_resp = 1"))
def filter_segment(spark, sf_dir):
    df = campaign(spark, sf_dir, "account_id", "x_bal", "class_type", "market_segment", LABEL)
    keep = (F.col("class_type") == "C1") & F.col("market_segment").isNotNull() & (F.col(LABEL) == 1)
    return df.filter(keep).select("account_id", "x_bal")


@query("drop_null_rows", with_views("campaign", "SELECT account_id, x_sparse FROM campaign WHERE x_sparse IS NOT NULL"))
def drop_null_rows(spark, sf_dir):
    return campaign(spark, sf_dir, "account_id", "x_sparse").na.drop(subset=["x_sparse"])


@query("fill_missing", with_views("campaign", "SELECT account_id, coalesce(market_segment, 'None') AS market_segment, coalesce(x_sparse, 0) AS x_sparse FROM campaign"))
def fill_missing(spark, sf_dir):
    df = campaign(spark, sf_dir, "account_id", "market_segment", "x_sparse")
    return S.fill_missing(df, ["market_segment"], ["x_sparse"])


@query(
    "null_tests",
    with_views("campaign", """SELECT CAST(SUM(CASE WHEN market_segment IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_segments, COUNT(x_sparse) = 0 AS sparse_is_empty,
 COUNT(CASE WHEN FALSE THEN x_price END) = 0 AS never_is_empty FROM campaign"""),
)
def null_tests(spark, sf_dir):
    df = campaign(spark, sf_dir, "market_segment", "x_sparse", "x_price")
    df = df.withColumn("never", F.when(F.lit(False), F.col("x_price")))
    empty = S.empty_columns(df.select("x_sparse", "never"))
    return df.agg(
        F.count_if(F.col("market_segment").isNull()).alias("null_segments"),
        F.lit("x_sparse" in empty).alias("sparse_is_empty"),
        F.lit("never" in empty).alias("never_is_empty"),
    )


_BASE = "totdoll_hq buydex timesmailed duns mail_date flg_mailed flg_resp".split()


@query(
    "baseline_projection",
    with_views("campaign", """SELECT x_price AS totdoll_hq, ref_score AS buydex, mail_cnt AS timesmailed, duns, mail_date, 1 AS flg_mailed, flg_resp FROM campaign"""),
)
def baseline_projection(spark, sf_dir):
    df = campaign(spark, sf_dir, "account_id", "x_price", "ref_score", "mail_cnt", "duns", "mail_date", LABEL)
    df = df.withColumnsRenamed({"x_price": "totdoll_hq", "ref_score": "buydex", "mail_cnt": "timesmailed"})
    return S.baseline_projection(df.withColumn("flg_mailed", F.lit(1)), LABEL)


# Scalar expressions --------------------------------------------------------------------

@query(
    "threshold_flags",
    with_views("campaign", """SELECT account_id, CASE WHEN fund_amt >= 25000 THEN 1 ELSE 0 END AS large_fund, CASE WHEN lead_ags >= 250000 THEN 1 ELSE 0 END AS large_ags,
 CASE WHEN score_resp >= 0.5 THEN 1 ELSE 0 END AS model_pred, CASE WHEN x_sparse >= 0 THEN 1 ELSE 0 END AS sparse_flag FROM campaign"""),
)
def threshold_flags(spark, sf_dir):
    df = campaign(spark, sf_dir, "account_id", "fund_amt", "lead_ags", "score_resp", "x_sparse")
    return df.select(
        "account_id",
        X.threshold_flag(F.col("fund_amt"), 25_000).alias("large_fund"),
        X.threshold_flag(F.col("lead_ags"), 250_000).alias("large_ags"),
        X.threshold_flag(F.col("score_resp"), 0.5).alias("model_pred"),
        X.threshold_flag(F.col("x_sparse"), 0).alias("sparse_flag"),
    )


@query("coerce_numeric", with_views("names", "SELECT name_id, TRY_CAST(regexp_extract(business_name, '[^ ]*$') AS DOUBLE) AS number, TRY_CAST(sic_8 AS DOUBLE) AS sic FROM names"))
def coerce_numeric(spark, sf_dir):
    last = F.regexp_extract("business_name", "[^ ]*$", 0)
    return names(spark, sf_dir).select(
        "name_id", X.coerce_number(last).alias("number"), X.coerce_number(F.col("sic_8")).alias("sic")
    )


@query("cast_flags", with_views("campaign", "SELECT account_id, CAST(flg_resp AS INT) AS flg_resp, CAST(fund_amt AS DOUBLE) AS fund_amt, CAST(load_year AS VARCHAR) AS load_year FROM campaign"))
def cast_flags(spark, sf_dir):
    df = campaign(spark, sf_dir, "account_id", LABEL, "fund_amt", "load_year")
    return df.select("account_id", F.col(LABEL).cast("int"), F.col("fund_amt").cast("double"), F.col("load_year").cast("string"))


@query("cap_columns", with_views("campaign", """SELECT account_id, least(greatest(x_price, 1000.0::DOUBLE), 200000.0::DOUBLE) AS x_price,
 CASE WHEN x_sparse IS NOT NULL THEN least(greatest(x_sparse, 0.0::DOUBLE), 5000.0::DOUBLE) END AS x_sparse FROM campaign"""))
def cap_columns(spark, sf_dir):
    df = campaign(spark, sf_dir, "account_id", "x_price", "x_sparse")
    return S.cap_columns(df, {"x_price": (1000.0, 200000.0), "x_sparse": (0.0, 5000.0)})


@query("log_transform", with_views("campaign", "SELECT account_id, round(ln(x_price + 1), 6) AS x_price, round(ln(x_qty + 1), 6) AS x_qty FROM campaign"))
def log_transform(spark, sf_dir):
    return rounded(S.log_columns(campaign(spark, sf_dir, "account_id", "x_price", "x_qty"), ["x_price", "x_qty"]))


@query(
    "scorecard_points",
    with_views("campaign", "SELECT account_id, CAST(trunc(ln((1 - score_resp) / score_resp) * 40 / ln(2) + 1130) AS INT) AS model_score FROM campaign"),
)
def scorecard_points(spark, sf_dir):
    df = campaign(spark, sf_dir, "account_id", "score_resp")
    return df.select("account_id", X.scorecard_points(F.col("score_resp")).alias("model_score"))


_CLEAN = r"trim(regexp_replace(regexp_replace(regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}_\s\p{{Z}}]', '', 'g'), '{w}', '', 'g'), '[\s\p{{Z}}]+', ' ', 'g'))"


def _stop(words) -> str:
    return "|".join(rf"\b{w}\b" for w in words)


@query("normalize_names", with_views("names", f"SELECT name_id, {_CLEAN.format(c='business_name', w=_stop(N.COMPANY_STATUSES))} AS name FROM names"))
def normalize_names(spark, sf_dir):
    return names(spark, sf_dir).select("name_id", N.normalize(F.col("business_name"), N.COMPANY_STATUSES).alias("name"))


_STREETS = (*N.STREET_DIRECTIONS, *N.STREET_TYPES)
_ADDRESS = "concat(CAST(s_suppkey AS VARCHAR), ' ', s_name, CASE s_suppkey % 3 WHEN 0 THEN ' N. Park Street' WHEN 1 THEN ' Blvd. West' ELSE '  Ave' END)"


@query("normalize_addresses", f"SELECT s_suppkey, {_CLEAN.format(c=_ADDRESS, w=_stop(_STREETS))} AS address FROM supplier")
def normalize_addresses(spark, sf_dir):
    key = F.col("s_suppkey")
    ending = F.when(key % 3 == 0, " N. Park Street").when(key % 3 == 1, " Blvd. West").otherwise("  Ave")
    address = F.concat(key.cast("string"), F.lit(" "), "s_name", ending)
    return table(spark, sf_dir, "supplier").select("s_suppkey", N.normalize(address, _STREETS).alias("address"))


@query("derive_prefix", with_views("names", "SELECT name_id, substr(sic_8, 1, 4) AS sic_4 FROM names"))
def derive_prefix(spark, sf_dir):
    return names(spark, sf_dir).select("name_id", F.substring("sic_8", 1, 4).alias("sic_4"))


@query(
    "format_rates",
    with_views("campaign", """SELECT market_segment, printf('%.2f%%', 100 * SUM(flg_resp)::DOUBLE / COUNT(*)) AS rate,
 format('{:,}', CAST(SUM(lead_ags) AS BIGINT)) AS balance FROM campaign GROUP BY market_segment"""),
)
def format_rates(spark, sf_dir):
    df = campaign(spark, sf_dir, "market_segment", LABEL, "lead_ags")
    rate = 100 * F.sum(LABEL).cast("double") / F.count(F.lit(1))
    return df.groupBy("market_segment").agg(
        X.percent(rate).alias("rate"), F.format_number(F.sum("lead_ags"), 0).alias("balance")
    )


@query(
    "campaign_calendar",
    with_views("campaign", """, m AS (SELECT CAST(date_trunc('month', mail_date) AS DATE) AS run_month, COUNT(*) AS n FROM campaign GROUP BY 1)
 SELECT run_month, strftime(run_month + INTERVAL 2 MONTH, '%Y%m') AS mail_month, strftime(run_month - INTERVAL 1 MONTH, '%Y%m') AS prior_month,
 strftime(run_month + INTERVAL 2 MONTH, '%Y%m%d') AS mail_day, CAST(n AS BIGINT) AS accounts FROM m"""),
)
def campaign_calendar(spark, sf_dir):
    run = X.first_of_month(F.col("mail_date").cast("date"))
    months = campaign(spark, sf_dir, "mail_date").groupBy(run.alias("run_month")).agg(F.count(F.lit(1)).alias("accounts"))
    mail, prior = F.add_months("run_month", 2), F.add_months("run_month", -1)
    return months.select(
        "run_month",
        F.date_format(mail, "yyyyMM").alias("mail_month"),
        F.date_format(prior, "yyyyMM").alias("prior_month"),
        F.date_format(mail, "yyyyMMdd").alias("mail_day"),
        "accounts",
    )


# Joins and set operations --------------------------------------------------------------

@query("geo_region_lookup", with_views(["campaign", "region_dim"], "SELECT account_id, region, macro_region FROM campaign LEFT JOIN region_dim ON region = member"))
def geo_region_lookup(spark, sf_dir):
    dim = region_dim(spark, sf_dir).withColumnRenamed("member", "region")
    return J.with_lookup(campaign(spark, sf_dir, "account_id", "region"), dim, ["region"])


_STATES = [s for listed in STATE_REGIONS.values() for s in listed]
_STATE_CASES = " ".join(f"WHEN state IN ({', '.join(repr(s) for s in listed)}) THEN '{r}'" for r, listed in STATE_REGIONS.items())


@query(
    "state_region_lookup",
    f"""WITH c AS (SELECT c_custkey, [{', '.join(map(repr, [*_STATES, 'XX']))}][1 + c_custkey % {len(_STATES) + 1}] AS state FROM customer)
 SELECT c_custkey, state, CASE {_STATE_CASES} END AS region FROM c""",
)
def state_region_lookup(spark, sf_dir):
    """Sales region of every customer's state; an unknown state has none."""
    codes = F.array(*[F.lit(s) for s in [*_STATES, "XX"]])
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.get(codes, (F.col("c_custkey") % (len(_STATES) + 1)).cast("int")).alias("state")
    )
    return J.with_lookup(customers, state_regions(spark).withColumnRenamed("member", "state"), ["state"])


@query(
    "left_join_rates",
    with_views("campaign", """SELECT t.market_segment, t.flg_qual, t.cnt, r.responders, round(100 * r.responders::DOUBLE / t.cnt, 6) AS rate
 FROM (SELECT market_segment, flg_qual, CAST(COUNT(*) AS BIGINT) AS cnt FROM campaign WHERE market_segment IS NOT NULL GROUP BY ALL) t
 LEFT JOIN (SELECT market_segment, flg_qual, CAST(COUNT(*) AS BIGINT) AS responders FROM campaign WHERE flg_resp = 1 GROUP BY ALL) r
 ON t.market_segment = r.market_segment AND t.flg_qual = r.flg_qual"""),
)
def left_join_rates(spark, sf_dir):
    df = campaign(spark, sf_dir, "market_segment", "flg_qual", LABEL).filter("market_segment is not null")
    return rounded(J.response_rates(df, ["market_segment", "flg_qual"], LABEL, strict_reference=True))


_MARKETABLE = "(SELECT DISTINCT substr(sic_8, 1, 4) AS code FROM names WHERE name_id % 3 = 0)"


def _marketable(spark, sf_dir):
    code = F.substring("sic_8", 1, 4).alias("code")
    return names(spark, sf_dir).filter("name_id % 3 = 0").select(code).distinct()


def _coded(spark, sf_dir):
    return names(spark, sf_dir).select("name_id", F.substring("sic_8", 1, 4).alias("sic_4"))


@query("membership_flag", with_views("names", f"SELECT name_id, substr(sic_8, 1, 4) AS sic_4, substr(sic_8, 1, 4) IN {_MARKETABLE} AS marketable FROM names"))
def membership_flag(spark, sf_dir):
    return J.membership_flag(_coded(spark, sf_dir), "sic_4", _marketable(spark, sf_dir), "marketable")


@query("semi_join", with_views("names", f"SELECT name_id, substr(sic_8, 1, 4) AS sic_4 FROM names WHERE substr(sic_8, 1, 4) IN {_MARKETABLE}"))
def semi_join(spark, sf_dir):
    return J.members_only(_coded(spark, sf_dir), _marketable(spark, sf_dir).withColumnRenamed("code", "sic_4"), ["sic_4"])


@query(
    "anti_join_new_names",
    with_views("names", """SELECT business_name, CAST(COUNT(*) AS BIGINT) AS cnt FROM names n WHERE business_name IS NOT NULL AND NOT EXISTS
 (SELECT 1 FROM names k WHERE k.business_name = n.business_name AND k.name_id % 2 = 0) GROUP BY business_name"""),
)
def anti_join_new_names(spark, sf_dir):
    df = names(spark, sf_dir).filter("business_name is not null")
    known = df.filter("name_id % 2 = 0").select("business_name")
    return J.not_members(df, known, ["business_name"]).groupBy("business_name").agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "partition_pairs",
    with_views("campaign", """, g AS (SELECT list_name, CAST(COUNT(*) AS BIGINT) AS cnt, round(AVG(lead_ags), 4) AS mean FROM campaign GROUP BY list_name)
 SELECT a.list_name AS list_name_a, a.cnt AS cnt_a, a.mean AS mean_a, b.list_name AS list_name_b, b.cnt AS cnt_b, b.mean AS mean_b FROM g a JOIN g b ON a.list_name < b.list_name"""),
)
def partition_pairs(spark, sf_dir):
    groups = campaign(spark, sf_dir, "list_name", "lead_ags").groupBy("list_name").agg(
        F.count(F.lit(1)).alias("cnt"), F.avg("lead_ags").alias("mean")
    )
    return rounded(J.group_pairs(groups, "list_name"), 4)


@query(
    "union_dedupe_keep_first",
    with_views("contacts", "SELECT duns, file_no, row_no, channel FROM contacts QUALIFY ROW_NUMBER() OVER (PARTITION BY duns ORDER BY file_no, row_no) = 1"),
)
def union_dedupe_keep_first(spark, sf_dir):
    both = contacts(spark, sf_dir)
    files = [both.filter(F.col("file_no") == n) for n in (1, 2)]
    merged = J.union_by_name(files)
    return J.keep_first(merged, ["duns"], ["file_no", "row_no"]).select("duns", "file_no", "row_no", "channel")


@query("dedupe_first", with_views("names", "SELECT business_name, MIN(name_id) AS name_id FROM names WHERE business_name IS NOT NULL GROUP BY business_name"))
def dedupe_first(spark, sf_dir):
    df = names(spark, sf_dir).select("business_name", "name_id")
    return J.keep_first(df, ["business_name"], ["name_id"])


@query("set_union", with_views("contacts", "SELECT duns FROM contacts WHERE file_no = 1 UNION SELECT duns FROM contacts WHERE file_no = 2"))
def set_union(spark, sf_dir):
    both = contacts(spark, sf_dir).select("file_no", "duns")
    return both.filter("file_no = 1").select("duns").union(both.filter("file_no = 2").select("duns")).distinct()


@query("set_difference", "SELECT p_name, p_size FROM part WHERE p_partkey % 2 = 0 EXCEPT SELECT p_name, p_size FROM part WHERE p_partkey % 2 = 1")
def set_difference(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    even, odd = (part.filter(F.col("p_partkey") % 2 == r).select("p_name", "p_size") for r in (0, 1))
    return even.subtract(odd)


# Sampling ------------------------------------------------------------------------------

def sql_hash_rank(source: str, seed: int, strata: str | None = LABEL, name: str = "hr") -> str:
    """CTE with the hash rank ``rn`` within the class and the class size ``n``."""
    part = f"PARTITION BY {strata}" if strata else ""
    return f"""{name} AS (SELECT *, ROW_NUMBER() OVER ({part} ORDER BY CAST('0x' || substr(md5(account_id || ':{seed}'), 1, 8) AS BIGINT), account_id) AS rn,
 COUNT(*) OVER ({part}) AS n FROM {source})"""


@query(
    "class_weights",
    with_views("campaign", """SELECT account_id, flg_resp, round(0.5 / (COUNT(*) OVER (PARTITION BY flg_resp)::DOUBLE / COUNT(*) OVER ()), 6) AS wt FROM campaign"""),
)
def class_weights(spark, sf_dir):
    return rounded(B.with_class_weights(campaign(spark, sf_dir, KEY, LABEL), LABEL))


def _sql_balance(size: str) -> str:
    return f""", {sql_hash_rank('campaign', 1)}, sz AS (SELECT MIN(n) AS small FROM hr)
 SELECT account_id, flg_resp, 1 AS wt FROM hr, sz WHERE rn <= CASE WHEN n = small THEN n ELSE {size} END"""


@query("balance_equal", with_views("campaign", _sql_balance("small")))
def balance_equal(spark, sf_dir):
    return B.balance(campaign(spark, sf_dir, KEY, LABEL), LABEL, "balanced", KEY)


# A third of the rows responds: where twice that is more than the rest, the rest is taken whole.
@query("balance_ratio", with_views("campaign", _sql_balance("CAST(floor(small * 2) AS BIGINT)")))
def balance_ratio(spark, sf_dir):
    return B.balance(campaign(spark, sf_dir, KEY, LABEL), LABEL, "ratio1_2", KEY, short=True)


@query(
    "balance_ratio_weighted",
    with_views("campaign", f""", {sql_hash_rank('campaign', 1, 'flg_fund')}, sz AS (SELECT MIN(n) AS small FROM hr),
 s AS (SELECT account_id, flg_fund FROM hr, sz WHERE rn <= CASE WHEN n = small THEN n ELSE CAST(floor(small * 2.5) AS BIGINT) END)
 SELECT account_id, flg_fund, round(0.5 / (COUNT(*) OVER (PARTITION BY flg_fund)::DOUBLE / COUNT(*) OVER ()), 6) AS wt FROM s"""),
)
def balance_ratio_weighted(spark, sf_dir):
    df = campaign(spark, sf_dir, KEY, "flg_fund")
    return rounded(B.balance(df, "flg_fund", "ratio1_25_weighted", KEY, short=True))


@query("stratified_split", with_views("campaign", f", {sql_hash_rank('campaign', 25)} SELECT account_id, flg_resp, rn <= floor(0.2 * n + 0.5) AS is_test FROM hr"))
def stratified_split(spark, sf_dir):
    return B.mark_test(campaign(spark, sf_dir, KEY, LABEL), KEY, 0.2, LABEL)


@query("stratified_folds", with_views("campaign", f", {sql_hash_rank('campaign', 25)} SELECT account_id, flg_resp, CAST((rn - 1) % 3 AS INT) AS fold FROM hr"))
def stratified_folds(spark, sf_dir):
    return B.stratified_folds(campaign(spark, sf_dir, KEY, LABEL), KEY, 3, LABEL)


# Arms ----------------------------------------------------------------------------------

_U = "CAST('0x' || substr(md5(account_id || ':7'), 1, 8) AS BIGINT)::DOUBLE / 4294967296"
_ARMS = {0: 0.5, 1: 0.3, 2: 0.2}


@query("random_partitions", with_views("campaign", f"SELECT account_id, CASE WHEN {_U} < 0.5 THEN 0 WHEN {_U} < 0.8 THEN 1 ELSE 2 END AS arm FROM campaign"))
def random_partitions(spark, sf_dir):
    return A.random_arms(campaign(spark, sf_dir, KEY), KEY, _ARMS, seed=7)


@query(
    "consecutive_partitions",
    with_views("campaign", "SELECT account_id, CAST((ROW_NUMBER() OVER (ORDER BY ref_score, lead_ags, account_id) - 1 + 2) % 3 AS INT) AS arm FROM campaign"),
)
def consecutive_partitions(spark, sf_dir):
    df = campaign(spark, sf_dir, KEY, "ref_score", "lead_ags")
    return A.consecutive_arms(df, KEY, 3, ["ref_score", "lead_ags"], offset=2).select(KEY, "arm")


def _sql_mw(field: str) -> str:
    return f"""SELECT a AS arm_a, b AS arm_b, '{field}' AS field, round(u, 4) AS u, round((u - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - t / ((n1 + n2) * (n1 + n2 - 1)))), 6) AS z FROM (
 SELECT a, b, n1, n2, t, greatest(r1 - n1 * (n1 + 1) / 2, n1 * n2 - (r1 - n1 * (n1 + 1) / 2)) AS u FROM (
 SELECT a, b, SUM(CASE WHEN arm = a THEN 1 ELSE 0 END)::DOUBLE AS n1, SUM(CASE WHEN arm = b THEN 1 ELSE 0 END)::DOUBLE AS n2, SUM(CASE WHEN arm = a THEN rk ELSE 0 END) AS r1, SUM((m * m - 1)::DOUBLE) AS t FROM (
 SELECT a, b, arm, COUNT(*) OVER (PARTITION BY a, b, v) AS m, RANK() OVER (PARTITION BY a, b ORDER BY v) + (COUNT(*) OVER (PARTITION BY a, b, v) - 1) / 2.0::DOUBLE AS rk FROM (
 SELECT p.a, p.b, arm, {field} AS v FROM armed JOIN (VALUES (0, 1), (0, 2), (1, 2)) p(a, b) ON arm = a OR arm = b)) GROUP BY a, b))"""


@query(
    "mann_whitney",
    with_views("campaign", f", armed AS (SELECT *, CASE WHEN {_U} < 0.5 THEN 0 WHEN {_U} < 0.8 THEN 1 ELSE 2 END AS arm FROM campaign) {_sql_mw('lead_ags')} UNION ALL {_sql_mw('ref_score')}"),
)
def mann_whitney(spark, sf_dir):
    df = A.random_arms(campaign(spark, sf_dir, KEY, "lead_ags", "ref_score"), KEY, _ARMS, seed=7, check=False)
    out = A.mann_whitney(df, "arm", ["lead_ags", "ref_score"])
    return out.select("arm_a", "arm_b", "field", F.round("u", 4).alias("u"), F.round("z", 6).alias("z"))


@query(
    "wasserstein_check",
    with_views("campaign", f""", g AS (SELECT CASE WHEN {_U} < 0.5 THEN 0 WHEN {_U} < 0.8 THEN 1 ELSE 2 END AS arm, COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM campaign) AS share FROM campaign GROUP BY 1),
 a AS (SELECT share, ROW_NUMBER() OVER (ORDER BY share) AS r FROM g), b AS (SELECT s, ROW_NUMBER() OVER (ORDER BY s) AS r FROM (VALUES (0.5::DOUBLE), (0.3::DOUBLE), (0.2::DOUBLE)) t(s))
 SELECT round(AVG(abs(share - s)), 6) AS distance, AVG(abs(share - s)) < 0.03 AS same FROM a JOIN b ON a.r = b.r"""),
)
def wasserstein_check(spark, sf_dir):
    df = A.random_arms(campaign(spark, sf_dir, KEY), KEY, _ARMS, seed=7, check=False)
    wanted = spark.createDataFrame([(s,) for s in _ARMS.values()], "share double")
    distance = A.pmf_distance(A.arm_shares(df, "arm"), wanted)
    return rounded(distance.withColumn("same", F.col("distance") < A.SHARE_DISTANCE))


@query(
    "uniformity_check",
    with_views("campaign", """, g AS (SELECT COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM campaign) AS share FROM campaign GROUP BY list_name),
 a AS (SELECT AVG(abs(share - 1.0::DOUBLE / n)) AS d FROM g, (SELECT COUNT(*) AS n FROM g)) SELECT round(d, 6) AS distance, d < 0.03 AS uniform FROM a"""),
)
def uniformity_check(spark, sf_dir):
    shares = A.arm_shares(campaign(spark, sf_dir, "list_name"), "list_name")
    n = shares.count()
    distance = A.pmf_distance(shares, A.equal_shares(shares, n))
    return rounded(distance.withColumn("uniform", F.col("distance") < 0.03))


# Weight of evidence --------------------------------------------------------------------

_CATS = ("market_segment", "list_name", "region")


def sql_woe(source: str, cats, label: str = LABEL) -> str:
    """CTE ``woe``: the weight-of-evidence table."""
    rows = " UNION ALL ".join(f"SELECT '{c}' AS v, coalesce({c}, 'None') AS c, {label} AS y FROM {source}" for c in cats)
    return f"""
w0 AS (SELECT v, c, COUNT(y) AS n, greatest(SUM(y)::DOUBLE, 0.5::DOUBLE) AS e, greatest((COUNT(y) - SUM(y))::DOUBLE, 0.5::DOUBLE) AS ne FROM ({rows}) GROUP BY v, c),
w1 AS (SELECT *, e / SUM(e) OVER (PARTITION BY v) AS pe, ne / SUM(ne) OVER (PARTITION BY v) AS pn FROM w0),
woe AS (SELECT v AS "Variable", c AS "Cutoff", CAST(n AS BIGINT) AS "N", e AS "Events", ne AS "NonEvents", ln(pe / pn) AS "WoE", ln(pe / pn) * (pe - pn) AS "IV" FROM w1)"""


@query("woe_table", with_views("campaign", f""", {sql_woe('campaign', _CATS)} SELECT "Variable", "Cutoff", "N", "Events", "NonEvents", round("WoE", 6) AS "WoE", round("IV", 6) AS "IV" FROM woe"""))
def woe_table(spark, sf_dir):
    return rounded(E.woe_table(campaign(spark, sf_dir, *_CATS, LABEL), _CATS, LABEL))


@query("iv_ranking", with_views("campaign", f""", {sql_woe('campaign', _CATS)} SELECT "Variable", round(SUM("IV"), 6) AS "IV" FROM woe GROUP BY "Variable" ORDER BY 2 DESC"""))
def iv_ranking(spark, sf_dir):
    table_ = E.woe_table(campaign(spark, sf_dir, *_CATS, LABEL), _CATS, LABEL)
    return rounded(E.information_value(table_)).orderBy(F.desc("IV"), "Variable")


def _sql_encoded(source: str, cats, extra: str) -> str:
    joins = " ".join(f"""LEFT JOIN woe w{i} ON w{i}."Variable" = '{c}' AND w{i}."Cutoff" = coalesce(s.{c}, 'None')""" for i, c in enumerate(cats))
    cols = ", ".join(f"""round(w{i}."WoE", 6) AS {c}""" for i, c in enumerate(cats))
    return f"SELECT {extra}, {cols} FROM {source} s {joins}"


@query("woe_encode", with_views("campaign", f", {sql_woe('campaign', _CATS)} {_sql_encoded('campaign', _CATS, 's.account_id')}"))
def woe_encode(spark, sf_dir):
    df = campaign(spark, sf_dir, KEY, *_CATS, LABEL)
    return rounded(E.WoeModel.fit(df, _CATS, LABEL).transform(df).drop(LABEL))


_NUMS = ("x_price", "x_qty", "fund_amt")
_VARS = (KEY, LABEL, "market_segment", "list_name", *_NUMS)


def _prepared(spark, sf_dir):
    df = campaign(spark, sf_dir, *_VARS, "load_year")
    dev, oot = df.filter("load_year <= 1999"), df.filter("load_year > 1999")
    fitted = E.prepare_training(
        dev, LABEL, KEY, ["market_segment", "list_name"], _NUMS, _VARS, balance_kind="balanced", log=True, woe=True
    )
    return fitted, oot


# Which numbers get a log follows from the balanced training rows, in SQL as well.
_FITTED = f""", dev AS (SELECT * FROM campaign WHERE load_year <= 1999), {sql_hash_rank('dev', 1)},
 sample AS (SELECT * FROM hr WHERE rn <= (SELECT MIN(n) FROM hr)), {sql_woe('sample', ('market_segment', 'list_name'))},
 lg AS (SELECT """ + ", ".join(f"skewness({c}::DOUBLE) > 1 AND MIN({c}) >= 0 AND COUNT(DISTINCT {c}) <> 2 AS l_{c}" for c in _NUMS) + " FROM sample)"


def _sql_logged(cols) -> str:
    return ", ".join(f"round(CASE WHEN l_{c} THEN ln(s.{c}::DOUBLE + 1) ELSE s.{c}::DOUBLE END, 6) AS {c}" for c in cols)


def _doubles(df, cols):
    return rounded(df.withColumns({c: F.col(c).cast("double") for c in cols}))


@query(
    "prepare_training",
    with_views("campaign", f"{_FITTED} " + _sql_encoded("sample", ("market_segment", "list_name"), "s.account_id, s.flg_resp, 1 AS wt, " + _sql_logged(_NUMS)).replace("FROM sample s", "FROM lg, sample s")),
)
def prepare_training(spark, sf_dir):
    fitted, _ = _prepared(spark, sf_dir)
    return _doubles(fitted.data, _NUMS)


@query(
    "prepare_holdout",
    with_views("campaign", f"{_FITTED}, oot AS (SELECT * FROM campaign WHERE load_year > 1999) " + _sql_encoded("oot", ("market_segment", "list_name"), "s.account_id, s.flg_resp, " + _sql_logged(("x_price", "fund_amt"))).replace("FROM oot s", "FROM lg, oot s")),
)
def prepare_holdout(spark, sf_dir):
    fitted, oot = _prepared(spark, sf_dir)
    out = E.prepare_holdout(oot, fitted, [KEY, "x_price", "fund_amt", "market_segment", "list_name"], label=LABEL)
    return _doubles(out, ("x_price", "fund_amt"))
