"""Data products (DP-1..24) built from relations derived from the given tables."""

from pyspark.sql import functions as F

from brokerdw.catalog import derived as d
from brokerdw.catalog.registry import query, table
from brokerdw.plans import dimensions as dims
from brokerdw.plans import carried, facts, increments, stages

DATES = "CAST(effectivedate AS VARCHAR) AS effectivedate, CAST(enddate AS VARCHAR) AS enddate, iscurrent"
CUSTOMER_COLS = """
    sk_customerid customerid status lastname firstname gender tier dob addressline1 postalcode city nationaltaxratedesc
    nationaltaxrate localtaxratedesc localtaxrate agencyid creditrating networth marketingnameplate batchid
""".split()


def _customer_sql(name: str) -> str:
    cols = ", ".join("CAST(dob AS VARCHAR) AS dob" if c == "dob" else c for c in CUSTOMER_COLS)
    return f" SELECT {cols}, {DATES} FROM {name}"


def _customer_columns(df):
    rates = {c: F.col(c).cast("double") for c in ("nationaltaxrate", "localtaxrate")}
    return df.withColumns(rates).select(*CUSTOMER_COLS, "effectivedate", "enddate", "iscurrent")


@query("dim_customer", d.with_ctes(d.CUSTOMER, _customer_sql("dimcustomer")))
def dim_customer(spark, sf):
    return _customer_columns(d.dim_customer(spark, sf))


ACCOUNT_COLS = "sk_accountid accountid sk_brokerid sk_customerid accountdesc taxstatus status batchid".split()


@query("dim_account", d.with_ctes(d.ACCOUNT, f" SELECT {', '.join(ACCOUNT_COLS)}, {DATES} FROM dimaccount"))
def dim_account(spark, sf):
    return d.dim_account(spark, sf).select(*ACCOUNT_COLS, "effectivedate", "enddate", "iscurrent")


@query(
    "dim_broker",
    d.with_ctes(
        "dimbroker",
        " SELECT sk_brokerid, brokerid, managerid, firstname, branch, CAST(effectivedate AS VARCHAR) AS effectivedate "
        "FROM dimbroker",
    ),
)
def dim_broker(spark, sf):
    return d.dim_broker(spark, sf).select("sk_brokerid", "brokerid", "managerid", "firstname", "branch", "effectivedate")


COMPANY_COLS = "sk_companyid companyid name status industry sprating islowgrade ceo".split()


@query(
    "dim_company",
    d.with_ctes(
        "dimcompany",
        f" SELECT {', '.join(COMPANY_COLS)}, CAST(foundingdate AS VARCHAR) AS foundingdate, {DATES} FROM dimcompany",
    ),
)
def dim_company(spark, sf):
    return d.dim_company(spark, sf).select(*COMPANY_COLS, "foundingdate", "effectivedate", "enddate", "iscurrent")


SECURITY_COLS = "sk_securityid symbol sk_companyid sharesoutstanding dividend".split()


@query("dim_security", d.with_ctes(d.COMPANY, f" SELECT {', '.join(SECURITY_COLS)}, {DATES} FROM dimsecurity"))
def dim_security(spark, sf):
    return d.dim_security(spark, sf).select(*SECURITY_COLS, "effectivedate", "enddate", "iscurrent")


FIN_COLS = "sk_companyid fi_year fi_qtr fi_revenue fi_net_earn fi_basic_eps fi_out_basic".split()


@query(
    "financial",
    d.with_ctes(
        "dimcompany financial",
        f" SELECT {', '.join(FIN_COLS)}, CAST(fi_qtr_start_date AS VARCHAR) AS fi_qtr_start_date FROM financial",
    ),
)
def financial(spark, sf):
    return d.financial(spark, sf).select(*FIN_COLS, "fi_qtr_start_date")


@query(
    "company_eps",
    d.with_ctes(
        "dimcompany financial eps", " SELECT sk_companyid, CAST(q AS VARCHAR) AS fi_qtr_start_date, sum_eps FROM eps"
    ),
)
def company_eps(spark, sf):
    wire, company = d.company_tables(spark, sf)
    stage = stages.company_eps_stage(dims.build_financial(wire, company), company)
    return stage.withColumnRenamed("sum_fi_basic_eps", "sum_eps")


TRADE_COLS = [c for c in dims.TRADE_TABLE if c != "executedby"]


@query("dim_trade", d.with_ctes(d.TRADE, f" SELECT {', '.join(TRADE_COLS)} FROM dimtrade"))
def dim_trade(spark, sf):
    return d.dim_trade(spark, sf).select(*TRADE_COLS)


@query(
    "fact_holdings",
    d.with_ctes(
        d.TRADE,
        """
    SELECT l_orderkey - l_linenumber AS tradeid, l_orderkey AS currenttradeid, sk_customerid, sk_accountid, sk_securityid,
           sk_companyid, sk_closedateid AS sk_dateid, sk_closetimeid AS sk_timeid, tradeprice AS currentprice,
           CAST(l_quantity AS INT) AS currentholding, l_linenumber % 3 + 1 AS batchid
    FROM lineitem JOIN dimtrade ON l_orderkey = dimtrade.tradeid""",
    ),
)
def fact_holdings(spark, sf):
    trade = d.stored_keys(d.dim_trade(spark, sf), d.HOLDING_COLUMNS, "dimtrade")
    return facts.build_fact_holdings(d.holdings(spark, sf), trade)


CASH_SQL = """
    SELECT sk_customerid, sk_accountid, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS sk_dateid, cash, c.batchid
    FROM cash c JOIN {dim} a ON c.accountid = a.accountid
"""


@query(
    "fact_cash_balances",
    d.with_ctes(
        f"{d.ACCOUNT} cash", CASH_SQL.format(dim="dimaccount") + " AND d >= a.effectivedate AND d < a.enddate"
    ),
)
def fact_cash_balances(spark, sf):
    account = d.stored(d.dim_account(spark, sf), "dimaccount")
    return facts.build_fact_cash_balances(stages.cash_stage(d.cash_transactions(spark, sf)), account)


@query(
    "fact_cash_balances_batch",
    d.with_ctes(f"{d.ACCOUNT} cash", CASH_SQL.format(dim="dimaccount") + " AND a.iscurrent WHERE c.batchid = 2"),
)
def fact_cash_balances_batch(spark, sf):
    """A later batch: balances of its days keyed by the current accounts."""
    stage = stages.cash_stage(d.cash_transactions(spark, sf)).filter(F.col("batchid") == 2)
    return facts.build_fact_cash_balances(stage, d.stored(d.dim_account(spark, sf), "dimaccount"), current=True)


MARKET_SQL = """
    SELECT s.sk_securityid, s.sk_companyid, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS sk_dateid,
           CASE WHEN sum_eps <> 0 THEN cl / sum_eps END AS peratio,
           CASE WHEN cl <> 0 THEN s.dividend / cl END / 100 AS yield, high52 AS fiftytwoweekhigh,
           high52date AS sk_fiftytwoweekhighdate, low52 AS fiftytwoweeklow, low52date AS sk_fiftytwoweeklowdate,
           cl AS closeprice, hi AS dayhigh, lo AS daylow, vol AS volume, m.batchid
    FROM market m JOIN dimsecurity s ON s.symbol = m.symbol AND {cond}
    LEFT JOIN eps ON eps.sk_companyid = s.sk_companyid AND quarter(d) = quarter(eps.q) AND year(d) = year(eps.q)
"""


def _market(spark, sf, only=None, current=False):
    wire, company = d.company_tables(spark, sf)
    stage = d.market_stage(spark, sf)
    eps = stages.company_eps_stage(dims.build_financial(wire, company), company)
    rows = stage if only is None else stage.filter(F.col("batchid") == only)
    security = d.stored(dims.build_dim_security(wire, company), "dimsecurity")
    return facts.build_fact_market_history(rows, security, eps, current)


@query(
    "fact_market_history",
    d.with_ctes(
        f"{d.COMPANY} financial eps market", MARKET_SQL.format(cond="d >= s.effectivedate AND d < s.enddate")
    ),
)
def fact_market_history(spark, sf):
    return _market(spark, sf)


@query(
    "fact_market_history_batch",
    d.with_ctes(f"{d.COMPANY} financial eps market", MARKET_SQL.format(cond="s.iscurrent") + " WHERE m.batchid = 2"),
)
def fact_market_history_batch(spark, sf):
    return _market(spark, sf, 2, current=True)


@query(
    "daily_market_stage",
    d.with_ctes(
        "market",
        """ SELECT CAST(d AS VARCHAR) AS dm_date, symbol AS dm_s_symb, cl AS dm_close, hi AS dm_high, lo AS dm_low,
        vol AS dm_vol, batchid, high52 AS fiftytwoweekhigh, high52date AS sk_fiftytwoweekhighdate,
        low52 AS fiftytwoweeklow, low52date AS sk_fiftytwoweeklowdate FROM market""",
    ),
)
def daily_market_stage(spark, sf):
    return d.market_stage(spark, sf)


@query(
    "fact_watches",
    d.with_ctes(
        f"{d.CUSTOMER} {d.COMPANY} watch",
        """
    SELECT c.sk_customerid, s.sk_securityid, CAST(strftime(placed, '%Y%m%d') AS BIGINT) AS sk_dateid_dateplaced,
           CAST(strftime(removed, '%Y%m%d') AS BIGINT) AS sk_dateid_dateremoved, w.batchid
    FROM watch w JOIN dimsecurity s ON s.symbol = w.symbol AND placed >= s.effectivedate AND placed < s.enddate
    JOIN dimcustomer c ON c.customerid = w.customerid AND placed >= c.effectivedate AND placed < c.enddate""",
    ),
)
def fact_watches(spark, sf):
    return facts.build_fact_watches(facts.watch_stage(d.watches(spark, sf)), *_security_customer(spark, sf))


def _security_customer(spark, sf):
    security = d.stored_keys(d.dim_security(spark, sf), d.SECURITY_KEYS, "dimsecurity")
    return security, d.stored_keys(d.dim_customer(spark, sf), d.CUSTOMER_KEYS, "dimcustomer")


PROSPECT_COLS = "agencyid batchid iscustomer lastname creditrating networth marketingnameplate".split()


def _prospect_sql(n: int) -> str:
    return f"""
    SELECT p.agencyid, CAST(strftime(r.batchdate, '%Y%m%d') AS BIGINT) AS sk_recorddateid,
           CAST(strftime(u.batchdate, '%Y%m%d') AS BIGINT) AS sk_updatedateid, p.batchid,
           EXISTS (SELECT 1 FROM dimcustomer c WHERE c.iscurrent AND upper(c.lastname) = upper(p.lastname)
                   AND upper(c.firstname) = upper(p.firstname) AND upper(c.addressline1) = upper(p.addressline1)
                   AND upper(c.postalcode) = upper(p.postalcode)) AS iscustomer,
           p.lastname, p.creditrating, p.networth, plate AS marketingnameplate
    FROM prospect p JOIN batchdate r ON least(p.recordbatchid, {n}) = r.batchid JOIN batchdate u ON p.batchid = u.batchid
    WHERE p.batchid <= {n} AND p.recordbatchid >= {n}"""


@query("prospect", d.with_ctes(d.CUSTOMER, _prospect_sql(3)))
def prospect(spark, sf):
    return _prospect(spark, sf, 3)


@query("prospect_batch2", d.with_ctes(d.CUSTOMER, _prospect_sql(2)))
def prospect_batch2(spark, sf):
    return _prospect(spark, sf, 2)


def _prospect(spark, sf, n):
    customer = d.stored(d.dim_customer(spark, sf), "dimcustomer")
    built = facts.build_prospect(d.prospect_stage(spark, sf), n, customer, d.batch_date(spark))
    return built.select("sk_recorddateid", "sk_updatedateid", *PROSPECT_COLS)


@query(
    "prospect_stage",
    d.with_ctes(
        "psnap prospect",
        " SELECT agencyid, networth, plate AS marketingnameplate, recordbatchid, batchid FROM prospect",
    ),
)
def prospect_stage(spark, sf):
    return d.prospect_stage(spark, sf).select("agencyid", "networth", "marketingnameplate", "recordbatchid", "batchid")


# -- batches one after the other, from what the batch before left ---------------------

FOUR = (1, 2, 3, 4)
# A batch holds the days of two years, and every fiftieth order comes late.
_BATCH = "CAST(CASE WHEN {key} % 50 = 0 THEN 4 ELSE least(4, (year({day}) - 1992) // 2 + 1) END AS INT)"


def _batch(key, day):
    by_day = F.least(F.lit(4), F.floor((F.year(day) - 1992) / 2).cast("int") + 1)
    return F.when(F.col(key) % 50 == 0, 4).otherwise(by_day).alias("batchid")


def _after_each(sql: str) -> str:
    """The rows of each batch as a run over all batches up to it gives them."""
    return " UNION ALL ".join(f"SELECT * FROM ({sql.format(n=n)}) WHERE batchid = {n}" for n in FOUR)


@query(
    "cash_opening_balances",
    f"""WITH days AS (SELECT o_custkey AS accountid, CAST(o_orderdate AS DATE) AS d, {_BATCH.format(key="o_orderkey", day="o_orderdate")} AS batchid,
        sum(CAST(o_totalprice AS DECIMAL(18,4))) AS t FROM orders GROUP BY ALL) """
    + _after_each(
        """SELECT accountid, CAST(d AS VARCHAR) AS datevalue, batchid,
        CAST(sum(t) OVER (PARTITION BY accountid ORDER BY d) AS DOUBLE) AS cash FROM days WHERE batchid <= {n}"""
    ),
)
def cash_opening_balances(spark, sf):
    """Balances of four batches, each from its own transactions and the closing balances before; some come late."""
    orders = table(spark, sf, "orders")
    cash = orders.select(
        F.col("o_custkey").alias("accountid"), F.col("o_orderdate").alias("ct_dts"), F.col("o_totalprice").alias("ct_amt"), _batch("o_orderkey", "o_orderdate")
    )
    days = d.stored(carried.cash_days(cash), "cash-days")
    of = lambda n: days.filter(F.col("batchid") == n)
    out, closing = stages.cash_stage(cash.filter("batchid = 1")), carried.close_balances(of(1))
    for n in FOUR[1:]:
        closing = d.stored(closing, "closing")
        out = out.unionByName(carried.cash_after(of(n), closing, days.filter(F.col("batchid") < n)))
        closing = carried.close_balances(of(n), closing)
    return out


@query(
    "market_year_tails",
    f"""WITH quotes AS (SELECT CAST(l_shipdate AS DATE) AS d, 'S' || (l_partkey % 20) AS s, {_BATCH.format(key="l_orderkey", day="l_shipdate")} AS batchid,
        max(l_extendedprice) AS hi, min(l_extendedprice) AS lo FROM lineitem GROUP BY ALL) """
    + _after_each(
        """SELECT CAST(d AS VARCHAR) AS dm_date, s AS dm_s_symb, hi AS dm_high, lo AS dm_low, batchid, max(hi) OVER w AS fiftytwoweekhigh,
        CAST(strftime(arg_max(d, (hi, -date_diff('day', DATE '1970-01-01', d))) OVER w, '%Y%m%d') AS BIGINT) AS sk_fiftytwoweekhighdate,
        min(lo) OVER w AS fiftytwoweeklow, CAST(strftime(arg_min(d, (lo, d)) OVER w, '%Y%m%d') AS BIGINT) AS sk_fiftytwoweeklowdate
        FROM quotes WHERE batchid <= {n} WINDOW w AS (PARTITION BY s ORDER BY d, batchid ROWS 364 PRECEDING)"""
    ),
)
def market_year_tails(spark, sf):
    """Yearly extremes of four batches, each from its own quotes and the year before them; some come late."""
    price = F.col("l_extendedprice")
    day, symbol = F.to_date("l_shipdate").alias("dm_date"), F.concat(F.lit("S"), d.text(F.col("l_partkey") % 20)).alias("dm_s_symb")
    quotes = table(spark, sf, "lineitem").groupBy(day, symbol, _batch("l_orderkey", "l_shipdate")).agg(F.max(price).alias("dm_high"), F.min(price).alias("dm_low"))
    quotes = d.stored(quotes, "quotes")
    of = lambda n: quotes.filter(F.col("batchid") == n)
    out, tails = stages.daily_market_stage(of(1)), carried.quote_tails(of(1))
    for n in FOUR[1:]:
        tails = d.stored(tails, "tails")
        out = out.unionByName(carried.market_after(of(n), tails, quotes.filter(F.col("batchid") < n)))
        tails = carried.quote_tails(of(n), tails)
    return out


@query(
    "prospect_state",
    d.with_ctes(
        "psnap prospect",
        " SELECT agencyid, networth, plate AS marketingnameplate, recordbatchid, batchid FROM prospect",
    ),
)
def prospect_state(spark, sf):
    """Prospect records with their first and last batch, one snapshot merged after the other."""
    snapshots = d.prospect_snapshots(spark, sf)
    state = stages.prospect_stage(snapshots.filter("batchid = 1"))
    for n in (2, 3):
        state = d.stored(state, "prospect-state")
        state = stages.with_tags(carried.seen_after(state, snapshots.filter(F.col("batchid") == n), ["marketingnameplate"]))
    return state.select("agencyid", "networth", "marketingnameplate", "recordbatchid", "batchid")


# -- incremental forms ------------------------------------------------------------
NEXT = "SELECT *, enddate = DATE '9999-12-31' AS cur FROM"


def _increment_customer(spark, sf):
    base = d.stored(d.dim_customer(spark, sf, changes=False), "dimcustomer")
    merged = increments.merge_dim_customer(
        base, d.customer_changes(spark, sf), 2, d.tax_rate(spark, sf), d.prospect_stage(spark, sf), d.batch_date(spark)
    )
    return merged.with_history(base.filter(~F.col("iscurrent")))


INCREMENT_COLS = "sk_customerid customerid status lastname gender tier addressline1 localtaxratedesc agencyid networth batchid".split()
INCREMENT_SQL = """
    , chg AS (SELECT c.*, b.batchdate FROM custchg c JOIN batchdate b ON c.batchid = b.batchid WHERE c.batchid = 2),
    moved AS (SELECT * FROM prospect WHERE batchid = 2 OR (recordbatchid = 1 AND batchid < 2)
              QUALIFY row_number() OVER (PARTITION BY agencyid ORDER BY batchid DESC, recordbatchid DESC) = 1),
    old AS (SELECT * FROM dimcustomer1),
    kept AS (
      SELECT CASE WHEN o.iscurrent AND m.agencyid IS NOT NULL AND c.customerid IS NULL
                  THEN CASE WHEN m.batchid = 2 THEN m.agencyid END ELSE o.agencyid END AS agencyid,
             CASE WHEN o.iscurrent AND m.agencyid IS NOT NULL AND c.customerid IS NULL
                  THEN CASE WHEN m.batchid = 2 THEN m.networth END ELSE o.networth END AS networth,
             CASE WHEN o.iscurrent AND c.customerid IS NOT NULL THEN c.batchdate ELSE o.enddate END AS enddate,
             o.iscurrent AND c.customerid IS NULL AS iscurrent,
             o.sk_customerid, o.customerid, o.status, o.lastname, o.gender, o.tier, o.addressline1, o.localtaxratedesc,
             o.batchid, o.effectivedate
      FROM old o LEFT JOIN chg c ON c.customerid = o.customerid
      LEFT JOIN moved m ON upper(m.lastname) = upper(o.lastname) AND upper(m.firstname) = upper(o.firstname)
        AND upper(m.addressline1) = upper(o.addressline1) AND upper(m.postalcode) = upper(o.postalcode)),
    opened AS (
      SELECT p.agencyid, p.networth, DATE '9999-12-31' AS enddate, TRUE AS iscurrent,
             CAST(strftime(c.batchdate, '%Y%m%d') || c.customerid AS BIGINT) AS sk_customerid, c.customerid, c.status,
             o.lastname, o.gender, coalesce(c.tier, o.tier) AS tier, coalesce(c.addressline1, o.addressline1) AS addressline1,
             o.localtaxratedesc, c.batchid, c.batchdate AS effectivedate
      FROM chg c LEFT JOIN old o ON o.customerid = c.customerid AND o.iscurrent
      LEFT JOIN prospect p ON p.batchid <= 2 AND p.recordbatchid >= 2 AND upper(p.lastname) = upper(o.lastname)
        AND upper(p.firstname) = upper(o.firstname) AND upper(p.postalcode) = upper(o.postalcode)
        AND upper(p.addressline1) = upper(coalesce(c.addressline1, o.addressline1)))
"""


@query(
    "dim_customer_batch",
    d.with_ctes(
        "mgmt custchg batchdate tax psnap prospect hist1 dimcustomer1",
        INCREMENT_SQL
        + " ".join(
            f"{glue} SELECT {', '.join(INCREMENT_COLS)}, {DATES} FROM {name}"
            for glue, name in (("", "kept"), ("UNION ALL", "opened"))
        ),
    ),
)
def dim_customer_batch(spark, sf):
    """Batch 2 merged into the customers of batch 1: new versions and prospect-only updates."""
    return _increment_customer(spark, sf).select(*INCREMENT_COLS, "effectivedate", "enddate", "iscurrent")


@query(
    "dim_account_batch",
    d.with_ctes(
        f"mgmt custchg acctchg batchdate tax psnap prospect hist1 dimcustomer1 dimbroker dimaccount1",
        """
    , chg AS (SELECT c.customerid, b.batchdate FROM custchg c JOIN batchdate b ON c.batchid = b.batchid WHERE c.batchid = 2),
    cur AS (SELECT * FROM dimcustomer1 WHERE iscurrent),
    owner AS (SELECT cur.customerid, cur.sk_customerid AS old_sk,
                     CASE WHEN chg.customerid IS NULL THEN cur.sk_customerid
                          ELSE CAST(strftime(chg.batchdate, '%Y%m%d') || cur.customerid AS BIGINT) END AS new_sk,
                     chg.customerid IS NOT NULL AS moved
              FROM cur LEFT JOIN chg ON chg.customerid = cur.customerid),
    direct AS (SELECT a.accountid, o.new_sk AS sk_customerid, b.sk_brokerid, a.accountdesc, a.status
               FROM acctchg a JOIN owner o ON a.customerid = o.customerid LEFT JOIN dimbroker b ON a.brokerid = b.brokerid
               WHERE a.batchid = 2 AND (a.brokerid IS NULL OR b.sk_brokerid IS NOT NULL)),
    forced AS (SELECT t.accountid, o.new_sk AS sk_customerid, t.sk_brokerid, t.accountdesc, t.taxstatus, t.status
               FROM dimaccount1 t JOIN owner o ON t.sk_customerid = o.old_sk AND o.moved WHERE t.iscurrent),
    src AS (SELECT coalesce(x.accountid, f.accountid) AS accountid, coalesce(x.sk_customerid, f.sk_customerid) AS sk_customerid,
                   coalesce(x.sk_brokerid, f.sk_brokerid) AS sk_brokerid, coalesce(x.accountdesc, f.accountdesc) AS accountdesc,
                   f.taxstatus, coalesce(x.status, f.status) AS status
            FROM direct x FULL JOIN forced f ON x.accountid = f.accountid),
    opened AS (SELECT CAST('20020101' || s.accountid AS BIGINT) AS sk_accountid, s.accountid,
                      coalesce(s.sk_brokerid, t.sk_brokerid) AS sk_brokerid, s.sk_customerid,
                      coalesce(s.accountdesc, t.accountdesc) AS accountdesc, coalesce(s.taxstatus, t.taxstatus) AS taxstatus,
                      coalesce(s.status, t.status) AS status, 2 AS batchid, DATE '2002-01-01' AS effectivedate,
                      DATE '9999-12-31' AS enddate, TRUE AS iscurrent
               FROM src s LEFT JOIN dimaccount1 t ON t.accountid = s.accountid AND t.iscurrent),
    kept AS (SELECT t.sk_accountid, t.accountid, t.sk_brokerid, t.sk_customerid, t.accountdesc, t.taxstatus, t.status, t.batchid,
                    t.effectivedate,
                    CASE WHEN t.iscurrent AND s.accountid IS NOT NULL THEN DATE '2002-01-01' ELSE t.enddate END AS enddate,
                    t.iscurrent AND s.accountid IS NULL AS iscurrent
             FROM dimaccount1 t LEFT JOIN src s ON s.accountid = t.accountid)
    """
        + " ".join(
            f"{glue} SELECT {', '.join(ACCOUNT_COLS)}, {DATES} FROM {name}"
            for glue, name in (("", "kept"), ("UNION ALL", "opened"))
        ),
    ),
)
def dim_account_batch(spark, sf):
    """Batch 2 merged into the accounts of batch 1: own changes and moves to new customer versions."""
    customer = d.stored(d.dim_customer(spark, sf, changes=False), "dimcustomer")
    account = d.stored(d.dim_account(spark, sf, customer, changes=False), "dimaccount")
    moved = d.stored(_increment_customer(spark, sf), "dimcustomer2")
    merged = increments.merge_dim_account(
        account, d.account_changes(spark, sf), 2, moved, d.dim_broker(spark, sf), d.batch_date(spark)
    )
    out = merged.with_history(account.filter(~F.col("iscurrent")))
    return out.select(*ACCOUNT_COLS, "effectivedate", "enddate", "iscurrent")


@query(
    "dim_trade_batch",
    d.with_ctes(
        d.TRADE,
        """
    , base AS (SELECT t.* FROM dimtrade t WHERE NOT (t.tradeid % 7 > 4 AND t.tradeid % 2 = 0)
               UNION ALL SELECT * REPLACE (NULL AS sk_closedateid, NULL AS sk_closetimeid, 'Pending' AS status,
                                           fee - 1 AS fee, 1 AS batchid)
               FROM dimtrade t WHERE t.tradeid % 7 > 4 AND t.tradeid % 2 = 0),
    upd AS (SELECT f.tradeid, f.fee FROM tradesfinal f JOIN dimsecurity s ON s.symbol = f.symbol AND s.iscurrent
            JOIN dimaccount a ON a.accountid = f.accountid AND a.iscurrent WHERE f.batchid = 2)
    SELECT b.* REPLACE (CASE WHEN u.tradeid IS NOT NULL THEN 20020101 ELSE sk_closedateid END AS sk_closedateid,
                        CASE WHEN u.tradeid IS NOT NULL THEN 101112 ELSE sk_closetimeid END AS sk_closetimeid,
                        CASE WHEN u.tradeid IS NOT NULL THEN 'Completed' ELSE b.status END AS status,
                        CASE WHEN u.tradeid IS NOT NULL THEN u.fee ELSE b.fee END AS fee,
                        CASE WHEN u.tradeid IS NOT NULL THEN 2 ELSE b.batchid END AS batchid)
    FROM base b LEFT JOIN upd u ON b.tradeid = u.tradeid
    UNION ALL
    SELECT f.tradeid, a.sk_brokerid, NULL, NULL, 20020101, 101112, f.status, f.type, f.cashflag, s.sk_securityid,
           s.sk_companyid, f.quantity, f.bidprice, a.sk_customerid, a.sk_accountid, f.tradeprice, f.fee, f.commission, f.tax, 2
    FROM tradesfinal f JOIN dimsecurity s ON s.symbol = f.symbol AND s.iscurrent
    JOIN dimaccount a ON a.accountid = f.accountid AND a.iscurrent
    WHERE f.batchid = 2 AND f.tradeid NOT IN (SELECT tradeid FROM dimtrade)""",
    ),
)
def dim_trade_batch(spark, sf):
    """Updates of batch 2 merged into the trades of batch 1."""
    security, account = d.security_account(spark, sf)
    rows = d.trades(spark, sf)
    first = dims.trades_final(rows.filter(F.col("batchid") == 1), d.trade_history(spark, sf, rows))
    target = d.stored(dims.build_dim_trade(first, security, account), "dimtrade")
    return increments.merge_dim_trade(target, rows, 2, security, account).select(*TRADE_COLS)


@query(
    "fact_watches_batch",
    d.with_ctes(
        f"{d.CUSTOMER} {d.COMPANY}",
        f"""
    , w1 AS (SELECT o_custkey AS customerid, 'S' || (o_orderkey % 50 + 1) AS symbol,
                    CAST(min(CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END) AS DATE) AS placed,
                    CAST(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS DATE) AS removed
             FROM orders WHERE o_orderdate < TIMESTAMP '{d.SPLIT}' GROUP BY 1, 2),
    w2 AS (SELECT o_custkey AS customerid, 'S' || (o_orderkey % 50 + 1) AS symbol,
                  CAST(min(CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END) AS DATE) AS placed,
                  CAST(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS DATE) AS removed
           FROM orders WHERE o_orderdate >= TIMESTAMP '{d.SPLIT}' GROUP BY 1, 2),
    t AS (SELECT c.sk_customerid, s.sk_securityid, w1.* FROM w1
          JOIN dimsecurity s ON s.symbol = w1.symbol AND placed >= s.effectivedate AND placed < s.enddate
          JOIN dimcustomer c ON c.customerid = w1.customerid AND placed >= c.effectivedate AND placed < c.enddate)
    SELECT t.sk_customerid, t.sk_securityid, CAST(strftime(t.placed, '%Y%m%d') AS BIGINT) AS sk_dateid_dateplaced,
           CAST(strftime(coalesce(t.removed, x.removed), '%Y%m%d') AS BIGINT) AS sk_dateid_dateremoved,
           CASE WHEN t.removed IS NULL AND x.customerid IS NOT NULL THEN 2 ELSE 1 END AS batchid
    FROM t LEFT JOIN (SELECT * FROM w2 WHERE placed IS NULL) x
      ON x.customerid = t.customerid AND x.symbol = t.symbol AND t.removed IS NULL
    UNION ALL
    SELECT c.sk_customerid, s.sk_securityid, CAST(strftime(placed, '%Y%m%d') AS BIGINT),
           CAST(strftime(removed, '%Y%m%d') AS BIGINT), 2
    FROM w2 JOIN dimsecurity s ON s.symbol = w2.symbol AND s.iscurrent
    JOIN dimcustomer c ON c.customerid = w2.customerid AND c.iscurrent WHERE placed IS NOT NULL""",
    ),
)
def fact_watches_batch(spark, sf):
    """Placements and cancellations of batch 2 merged into the watches of batch 1."""
    security, customer = _security_customer(spark, sf)
    rows = d.watches(spark, sf)
    batch = lambda n: facts.watch_stage(rows.filter(F.col("batchid") == n))
    target = d.stored(facts.build_fact_watches(batch(1), security, customer), "factwatches")
    return facts.merge_fact_watches(target, batch(2), security, customer)
