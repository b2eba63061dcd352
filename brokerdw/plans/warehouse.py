"""Loads of the whole warehouse: collective, batch by batch, and as a stream."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerdw.operators.checks import expect
from brokerdw.plans import audit as audit_plan
from brokerdw.plans import dimensions as dims
from brokerdw.plans import carried, facts, increments, messages, stages
from brokerdw.sources import scans, schemas
from brokerdw.sources.store import TableStore
from brokerdw.streaming import cdc

REFERENCE = ["taxrate", "dimdate", "dimtime", "statustype", "industry", "tradetype", "batchdate"]
STATIC = ["dimbroker", "dimcompany", "dimsecurity", "financial"]
WAREHOUSE = [
    "dimaccount", "dimbroker", "dimcompany", "dimcustomer", "dimdate", "dimsecurity", "dimtime", "dimtrade",
    "factcashbalances", "factholdings", "factmarkethistory", "factwatches", "financial", "industry", "prospect",
    "statustype", "taxrate", "tradetype",
]
# Layout of the stored tables: facts are looked up by any of these columns.
CLUSTER = {
    "factholdings": ["sk_securityid", "sk_accountid"],
    "factcashbalances": ["sk_dateid", "sk_accountid"],
    "factmarkethistory": ["sk_dateid", "sk_securityid"],
}


def _closed(df: DataFrame) -> DataFrame:
    """Flag trades that can no longer change."""
    return df.withColumn("closed", F.col("sk_closedateid").isNotNull())


def _removed(df: DataFrame) -> DataFrame:
    """Flag watches that can no longer change."""
    return df.withColumn("removed", F.col("sk_dateid_dateremoved").isNotNull())


@dataclass
class Warehouse:
    """A raw-file root and the store its tables are loaded into."""

    spark: SparkSession
    raw: str
    store: TableStore

    # -- raw relations ------------------------------------------------------
    def raw_table(self, name: str, batches: Sequence[int] | None = None) -> DataFrame:
        """Rows of a file in the folders of ``batches`` (all that are there)."""
        spec = next(s for s in scans.RAW_TABLES if s.name == name)
        return scans.ingest(self.spark, self.raw, [spec], batches)[name]

    def change_table(self, name: str, batches: Sequence[int] | None = None, keep_cdc: bool = False) -> DataFrame:
        spec = next(s for s in scans.CHANGE_TABLES if s.name == name)
        return scans.scan_all_batches(self.spark, self.raw, spec, batches, keep_cdc)

    def last_batch(self) -> int:
        return self.store.read("batchdate").agg(F.max("batchid")).first()[0]

    def finwire(self) -> DataFrame:
        return self.store.read("stage_finwire")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.store.read(name) for name in WAREHOUSE}

    # -- stages -------------------------------------------------------------
    def load_reference(self, batches: Sequence[int] | None = None) -> None:
        for name in REFERENCE:
            self.store.write(name, self.raw_table(name, batches))

    def load_stages(self, batches: Sequence[int] | None = None) -> None:
        """Everything derived from the raw files of ``batches`` (all that are there)."""
        s, store = self.spark, self.store
        wire = scans.scan_finwire(s, f"{self.raw}/Batch1/FINWIRE[0-9][0-9][0-9][0-9]Q[1-4]")
        store.write("stage_finwire", wire, partition_by=["rectype"])
        scans.check_xml(s, f"{self.raw}/Batch1", schemas.XML_ROW_TAG, "CustomerMgmt.xml")
        actions = scans.scan_xml(
            s, f"{self.raw}/Batch1", schemas.XML_ROW_TAG, schemas.CUSTOMER_MGMT, "CustomerMgmt.xml"
        )
        store.write("stage_customermgmt", stages.customer_mgmt(actions), partition_by=["actiontype"])
        store.write("stage_prospect", stages.prospect_stage(self.raw_table("prospect", batches)))
        quotes = store.write("stage_quotes", self.change_table("dailymarket", batches), partition_by=["batchid"])
        store.write("stage_market", stages.daily_market_stage(quotes), partition_by=["batchid"])
        cash = stages.cash_stage(self.change_table("cashtransaction", batches))
        store.write("stage_cash", cash, partition_by=["batchid"])

    def carry_first(self) -> None:
        """What the historical load leaves to the next batch."""
        store, flow = self.store, "batch-1"
        days = store.write("cash_days", carried.cash_days(self.change_table("cashtransaction", [1])), partition_by=["batchid"])
        store.write("state_cash", carried.close_balances(days), flow=flow)
        store.write("state_quotes", carried.quote_tails(store.read("stage_quotes")), flow=flow)

    def load_batch_stages(self, n: int) -> None:
        """The stages of batch ``n`` from its own files and what the batch before left; no other folder is opened.

        A state is replaced after everything that is derived from the one before, so a load
        that was stopped is taken up where it was.
        """
        store, flow = self.store, f"batch-{n}"

        def todo(name: str) -> bool:
            return not store.has_flow(name, flow)

        def before(state: str) -> DataFrame:
            if not store.has_flow(state, f"batch-{n - 1}"):
                raise ValueError(f"{state}: batch {n - 1} has to be loaded before batch {n}")
            return store.read(state)

        def of_batch(name: str) -> DataFrame:
            return store.read(name).filter(F.col("batchid") == n)

        def earlier(name: str) -> DataFrame:
            return store.read(name).filter(F.col("batchid") < n)

        def append(name: str, rows: DataFrame) -> None:
            store.write(name, rows, "append", partition_by=["batchid"], flow=flow)

        if todo("batchdate"):
            store.write("batchdate", self.raw_table("batchdate", [n]), "append", flow=flow)
        if todo("stage_prospect"):
            seen = carried.seen_after(store.read("stage_prospect"), self.raw_table("prospect", [n]), ["marketingnameplate"])
            store.write("stage_prospect", stages.with_tags(seen), flow=flow)
        if todo("state_cash"):
            if todo("cash_days"):
                append("cash_days", carried.cash_days(self.change_table("cashtransaction", [n])))
            if todo("stage_cash"):
                append("stage_cash", carried.cash_after(of_batch("cash_days"), before("state_cash"), earlier("cash_days")))
            store.write("state_cash", carried.close_balances(of_batch("cash_days"), before("state_cash")), flow=flow)
        if todo("state_quotes"):
            if todo("stage_quotes"):
                append("stage_quotes", self.change_table("dailymarket", [n]))
            if todo("stage_market"):
                append("stage_market", carried.market_after(of_batch("stage_quotes"), before("state_quotes"), earlier("stage_quotes")))
            store.write("state_quotes", carried.quote_tails(of_batch("stage_quotes"), before("state_quotes")), flow=flow)

    def load_static(self) -> None:
        """Dimensions that only batch 1 changes."""
        store, wire = self.store, self.finwire()
        store.write("dimbroker", dims.build_dim_broker(self.raw_table("hr"), store.read("dimdate")))
        company = store.write("dimcompany", dims.build_dim_company(wire, store.read("industry")))
        store.write("dimsecurity", dims.build_dim_security(wire, company))
        financial = store.write("financial", dims.build_financial(wire, company))
        store.write("stage_eps", stages.company_eps_stage(financial, company))

    # -- collective load ----------------------------------------------------
    def run_collective(self) -> None:
        """All batches in one pass, without merges."""
        self.load_reference()
        self.load_stages()
        self.load_static()
        changes = stages.customer_changes(self.raw_table("customer_cdc"))
        moves = stages.account_changes(self.raw_table("account_cdc"))
        self._load_people(changes, moves, self.last_batch())
        trades = dims.trades_final(self.change_table("trade", keep_cdc=True), self.raw_table("tradehistory"))
        self._load_facts(trades, self.change_table("holdinghistory"), self.change_table("watchhistory"), None)

    def _load_people(self, changes: DataFrame | None, moves: DataFrame | None, batch: int) -> None:
        store = self.store
        mgmt, batch_date = store.read("stage_customermgmt"), store.read("batchdate")
        prospects = store.read("stage_prospect")
        visible = prospects.filter((F.col("batchid") <= batch) & (F.col("recordbatchid") >= batch))
        history = dims.customer_history(mgmt, changes, batch_date)
        customer = store.write_scd2("dimcustomer", dims.build_dim_customer(history, store.read("taxrate"), visible))
        accounts = dims.account_history(mgmt, moves, batch_date)
        store.write_scd2("dimaccount", dims.build_dim_account(accounts, customer, store.read("dimbroker")))
        store.write("prospect", facts.build_prospect(prospects, batch, customer, batch_date))

    def _load_facts(self, trades: DataFrame, holdings: DataFrame, watches: DataFrame, batch: int | None) -> None:
        store = self.store
        security, account = store.read("dimsecurity"), store.read("dimaccount")
        trade = store.write_split("dimtrade", _closed(dims.build_dim_trade(trades, security, account)), "closed", True)
        only = (lambda df: df) if batch is None else (lambda df: df.filter(F.col("batchid") == batch))
        built = {
            "factholdings": facts.build_fact_holdings(only(holdings), trade),
            "factcashbalances": facts.build_fact_cash_balances(only(store.read("stage_cash")), account),
            "factmarkethistory": facts.build_fact_market_history(
                only(store.read("stage_market")), security, store.read("stage_eps")
            ),
        }
        for name, df in built.items():
            store.write(name, df, cluster_by=CLUSTER[name])
        watched = facts.build_fact_watches(facts.watch_stage(only(watches)), security, store.read("dimcustomer"))
        store.write_split("factwatches", _removed(watched), "removed", True)

    # -- incremental load ---------------------------------------------------
    def run_batch(self, n: int) -> None:
        """Batch 1 is the historical load, later batches are merged."""
        if n == 1:
            self._run_first()
        else:
            self._run_next(n)

    def _run_first(self) -> None:
        """The historical load; run again it loads every table afresh."""
        first = [1]
        self.load_reference(first)
        self.load_stages(first)
        self.carry_first()
        self.load_static()
        self._load_people(None, None, batch=1)
        trades = dims.trades_final(self.change_table("trade", first, keep_cdc=True), self.raw_table("tradehistory"))
        self._load_facts(trades, self.change_table("holdinghistory", first), self.change_table("watchhistory", first), 1)

    def _run_next(self, n: int) -> None:
        """Merge batch ``n``. A table that has it already is left alone, so a load can be repeated or taken up again."""
        store, flow = self.store, f"batch-{n}"
        self.load_batch_stages(n)
        batch_date, security = store.read("batchdate"), store.read("dimsecurity")
        prospects = store.read("stage_prospect")
        of_batch = F.col("batchid") == n
        todo = lambda name: not store.has_flow(name, flow)

        if todo("dimcustomer"):
            changes = stages.customer_changes(self.raw_table("customer_cdc", [n]))
            merged = increments.merge_dim_customer(
                store.read("dimcustomer"), changes, n, store.read("taxrate"), prospects, batch_date
            )
            store.merge_scd2("dimcustomer", merged, flow)
        customer = store.read("dimcustomer")

        if todo("dimaccount"):
            moves = stages.account_changes(self.raw_table("account_cdc", [n]))
            merged = increments.merge_dim_account(
                store.read("dimaccount"), moves, n, customer, store.read("dimbroker"), batch_date
            )
            store.merge_scd2("dimaccount", merged, flow)
        account = store.read("dimaccount")
        store.write("prospect", facts.build_prospect(prospects, n, customer, batch_date))

        if todo("dimtrade"):
            trades = self.change_table("trade", [n], keep_cdc=True)
            moved = increments.merge_dim_trade(
                store.read("dimtrade", "open"), trades, n, security, account, store.read("dimtrade", "final")
            )
            store.merge_split("dimtrade", _closed(moved), "closed", True, flow)
        trade = store.read("dimtrade").filter(of_batch)
        added = {
            "factholdings": lambda: facts.build_fact_holdings(self.change_table("holdinghistory", [n]), trade),
            "factcashbalances": lambda: facts.build_fact_cash_balances(
                store.read("stage_cash").filter(of_batch), account, current=True
            ),
            "factmarkethistory": lambda: facts.build_fact_market_history(
                store.read("stage_market").filter(of_batch), security, store.read("stage_eps"), current=True
            ),
        }
        for name, build in added.items():
            if todo(name):
                store.write(name, build(), "append", cluster_by=CLUSTER[name], flow=flow)
        if todo("factwatches"):
            watches = facts.watch_stage(self.change_table("watchhistory", [n]))
            moved = facts.merge_fact_watches(
                store.read("factwatches", "open").drop("removed"), watches, security, customer
            )
            store.merge_split("factwatches", _removed(moved), "removed", True, flow)

    # -- stream -------------------------------------------------------------
    def run_stream(self, checkpoints: str) -> None:
        """Customers, accounts, trades and watches by automatic change application.

        History is loaded once, later batches arrive as a file stream, and the
        dimensions are then built from the staged change logs.
        """
        self.load_reference()
        self.load_stages()
        self.load_static()
        spark, store = self.spark, self.store
        batch_date = store.read("batchdate")
        mgmt = store.read("stage_customermgmt")

        def later(name: str, schema: str) -> DataFrame:
            path = f"{self.raw}/Batch{{[2-9],[1-9][0-9]*}}"
            stream = scans.stream_delimited(spark, path, f"{schemas.CDC_COLUMNS}, {schema}", pattern=name)
            return scans.with_batch_id(stream)

        def dated(stream: DataFrame) -> DataFrame:
            """Stream-static join: change records take effect on their batch day."""
            return stream.join(batch_date, "batchid").withColumn("update_ts", F.col("batchdate").cast("timestamp"))

        people = [*stages.CUSTOMER_COLS, "batchid", "update_ts"]
        cdc.run_cdc(
            dated(stages.customer_changes(later("Customer.txt", schemas.CUSTOMER))).select(*people),
            store,
            "log_customer",
            lambda df: cdc.scd2_log(df, ["customerid"], "update_ts"),
            f"{checkpoints}/customer",
            once=mgmt.filter(F.col("actiontype").isin("NEW", "INACT", "UPDCUST"))
            .withColumn("batchid", F.lit(1))
            .select(*people),
            by=cdc.ByKey(["customerid"], cdc.combine_scd2, cdc.scd2_view),
        )
        owned = [*stages.ACCOUNT_COLS, "batchid", "update_ts"]
        cdc.run_cdc(
            dated(stages.account_changes(later("Account.txt", schemas.ACCOUNT))).select(*owned),
            store,
            "log_account",
            lambda df: cdc.scd2_log(df, ["accountid"], "update_ts"),
            f"{checkpoints}/account",
            once=mgmt.filter(~F.col("actiontype").isin("UPDCUST", "INACT"))
            .withColumn("batchid", F.lit(1))
            .select(*owned),
            by=cdc.ByKey(["accountid"], cdc.combine_scd2, cdc.scd2_view),
        )

        def history(log: str) -> DataFrame:
            versions = cdc.with_validity(store.read(f"{log}_view"))
            return versions.filter(F.col("effectivedate") < F.col("enddate")).drop("__START_AT", "__END_AT")

        prospects = store.read("stage_prospect")
        last = self.last_batch()
        visible = prospects.filter((F.col("batchid") <= last) & (F.col("recordbatchid") >= last))
        customer = store.write_scd2(
            "dimcustomer",
            dims.build_dim_customer(history("log_customer"), store.read("taxrate"), visible),
        )
        account = store.write_scd2(
            "dimaccount", dims.build_dim_account(history("log_account"), customer, store.read("dimbroker"))
        )
        store.write("prospect", facts.build_prospect(prospects, last, customer, batch_date))

        trades = self._stream_trades(later("Trade.txt", schemas.TRADE), checkpoints)
        watches = self._stream_watches(later("WatchHistory.txt", schemas.WATCH_HISTORY), checkpoints)
        security = store.read("dimsecurity")
        trade = store.write_split("dimtrade", _closed(dims.build_dim_trade(trades, security, account)), "closed", True)
        built = {
            "factholdings": facts.build_fact_holdings(self.change_table("holdinghistory"), trade),
            "factcashbalances": facts.build_fact_cash_balances(store.read("stage_cash"), account),
            "factmarkethistory": facts.build_fact_market_history(
                store.read("stage_market"), security, store.read("stage_eps")
            ),
        }
        for name, df in built.items():
            store.write(name, df, cluster_by=CLUSTER[name])
        watched = facts.build_fact_watches(watches, security, customer)
        store.write_split("factwatches", _removed(watched), "removed", True)

    def _stream_trades(self, stream: DataFrame, checkpoints: str) -> DataFrame:
        """Type 1 trades: creation and closing times are set by the rows that carry them."""
        attrs = dims.trade_attributes()
        closed = F.col("status").isin(dims.CLOSED_TRADE)
        cols = ["tradeid", "t_dts", "create_ts", "close_ts", "status", *attrs, "batchid"]
        normal = stream.withColumns(
            {
                "create_ts": F.when(F.col("cdc_flag") == "I", F.col("t_dts")),
                "close_ts": F.when(closed, F.col("t_dts")),
            }
        ).select(*cols)
        past = self.raw_table("tradehistory").groupBy("tradeid").agg(
            F.min("th_dts").alias("create_ts"),
            F.max(F.struct("th_dts", "status")).alias("last"),
        )
        first = self.change_table("trade", [1]).drop("status")
        done = F.col("last.status").isin(dims.CLOSED_TRADE)
        hydrated = first.join(past, "tradeid").withColumns(
            {
                "t_dts": F.col("last.th_dts"),
                "close_ts": F.when(done, F.col("last.th_dts")),
                "status": F.col("last.status"),
            }
        )
        cdc.run_cdc(
            normal,
            self.store,
            "log_trade",
            lambda df: cdc.scd1_log(df, ["tradeid"], "t_dts", True, ["t_dts"]),
            f"{checkpoints}/trade",
            once=hydrated.select(*cols),
            by=cdc.ByKey(["tradeid"], cdc.combine_scd1, cdc.scd1_view),
        )
        return self.store.read("log_trade_view")

    def _stream_watches(self, stream: DataFrame, checkpoints: str) -> DataFrame:
        """Type 1 watches: placement and cancellation arrive as separate rows."""
        canceled = F.col("w_action") == "CNCL"

        def shaped(df: DataFrame) -> DataFrame:
            return df.select(
                F.col("w_c_id").alias("customerid"),
                F.col("w_s_symb").alias("symbol"),
                "w_dts",
                F.when(~canceled, F.to_date("w_dts")).alias("dateplaced"),
                F.when(canceled, F.to_date("w_dts")).alias("dateremoved"),
                "batchid",
            )

        cdc.run_cdc(
            shaped(stream),
            self.store,
            "log_watch",
            lambda df: cdc.scd1_log(df, ["customerid", "symbol"], "w_dts", True, ["w_dts"]),
            f"{checkpoints}/watch",
            once=shaped(self.change_table("watchhistory", [1])),
            by=cdc.ByKey(["customerid", "symbol"], cdc.combine_scd1, cdc.scd1_view),
        )
        return self.store.read("log_watch_view")

    # -- messages and audit -------------------------------------------------
    def empty_tables(self) -> None:
        """Initial condition: every warehouse table exists without rows."""
        shapes = WarehouseShapes(self).frames()
        for name in WAREHOUSE:
            self.store.write(name, shapes[name].limit(0))
        self.store.write("dimtrade", _closed(shapes["dimtrade"]).limit(0))
        self.store.write("factwatches", _removed(shapes["factwatches"]).limit(0))

    def log(self, rows: DataFrame, flow: str) -> None:
        """Append messages, once for each ``flow``."""
        if not self.store.has_flow("dimessages", flow):
            self.store.write("dimessages", rows, "append", flow=flow)

    def finish_batch(self, n: int) -> None:
        """Validation report and phase record after a batch (0 is the empty warehouse)."""
        self.log(messages.validation_report(self.tables(), n), f"validation-{n}")
        self.log(messages.phase_complete(self.spark, n), f"phase-{n}")

    def log_visibility(self, kind: int, n: int) -> None:
        self.log(messages.visibility(self.tables(), kind, n), f"visibility-{kind}-{n}")

    def log_alerts(self) -> None:
        self.log(messages.alerts(self.tables(), self.store.read("batchdate"), self.finwire()), "alerts")

    def expectations(self) -> DataFrame:
        found = [
            expect(self.store.read(name), rules).select(F.lit(name).alias("table"), "*")
            for name, rules in messages.expectations().items()
        ]
        return scans.union_all(found)

    def audit_file(self) -> DataFrame:
        return scans.scan_delimited(self.spark, f"{self.raw}/*", schemas.AUDIT, ",", header=True, pattern="*_audit.csv")

    def audit(self) -> DataFrame:
        return audit_plan.audit(self.tables(), self.store.read("dimessages"), self.audit_file())

    def run_incremental(self, batches: Iterable[int] = (1, 2, 3)) -> DataFrame:
        """The whole incremental run with its messages; returns the audit."""
        for n in batches:
            self.run_batch(n)
            self.finish_batch(n)
            self.log_visibility(1, n)
            self.log_visibility(2, n)
        self.log_alerts()
        return self.audit()


class WarehouseShapes:
    """Column names and types of the warehouse tables, taken from their builders."""

    def __init__(self, warehouse: Warehouse):
        self.w = warehouse

    def frames(self) -> dict[str, DataFrame]:
        w = self.w
        wire = scans.classify_finwire(w.spark.createDataFrame([], "value STRING"))
        date = w.spark.createDataFrame([], schemas.DATE)
        batch_date = w.spark.createDataFrame([], schemas.BATCH_DATE).withColumn("batchid", F.lit(1))
        industry = w.spark.createDataFrame([], schemas.INDUSTRY)
        tax = w.spark.createDataFrame([], schemas.TAX_RATE)
        raw = lambda ddl: w.spark.createDataFrame([], ddl)
        tagged = lambda ddl: raw(ddl).withColumn("batchid", F.lit(1))
        company = dims.build_dim_company(wire, industry)
        security = dims.build_dim_security(wire, company)
        financial = dims.build_financial(wire, company)
        broker = dims.build_dim_broker(raw(schemas.HR), date)
        mgmt = stages.customer_mgmt(raw(schemas.CUSTOMER_MGMT))
        prospects = stages.prospect_stage(tagged(schemas.PROSPECT))
        customer = dims.build_dim_customer(dims.customer_history(mgmt, None, batch_date), tax, prospects)
        account = dims.build_dim_account(dims.account_history(mgmt, None, batch_date), customer, broker)
        trades = tagged(schemas.TRADE).withColumn("cdc_flag", F.lit("I"))
        trade = dims.build_dim_trade(dims.trades_final(trades, raw(schemas.TRADE_HISTORY)), security, account)
        return {
            "taxrate": tax,
            "dimdate": date,
            "dimtime": raw(schemas.TIME),
            "statustype": raw(schemas.STATUS_TYPE),
            "industry": industry,
            "tradetype": raw(schemas.TRADE_TYPE),
            "dimbroker": broker,
            "dimcompany": company,
            "dimsecurity": security,
            "financial": financial,
            "dimcustomer": customer,
            "dimaccount": account,
            "dimtrade": trade,
            "prospect": facts.build_prospect(prospects, 1, customer, batch_date),
            "factholdings": facts.build_fact_holdings(tagged(schemas.HOLDING_HISTORY), trade),
            "factcashbalances": facts.build_fact_cash_balances(
                stages.cash_stage(tagged(schemas.CASH_TRANSACTION)), account
            ),
            "factmarkethistory": facts.build_fact_market_history(
                stages.daily_market_stage(tagged(schemas.DAILY_MARKET)),
                security,
                stages.company_eps_stage(financial, company),
            ),
            "factwatches": facts.build_fact_watches(
                facts.watch_stage(tagged(schemas.WATCH_HISTORY)), security, customer
            ),
        }
