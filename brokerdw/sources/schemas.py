"""Declared schemas of the raw extracts. Fixed values of the input format."""

CDC_COLUMNS = "cdc_flag STRING, cdc_dsn BIGINT"

DATE = (
    "sk_dateid BIGINT, datevalue DATE, datedesc STRING, calendaryearid INT, calendaryeardesc STRING, "
    "calendarqtrid INT, calendarqtrdesc STRING, calendarmonthid INT, calendarmonthdesc STRING, "
    "calendarweekid INT, calendarweekdesc STRING, dayofweeknum INT, dayofweekdesc STRING, "
    "fiscalyearid INT, fiscalyeardesc STRING, fiscalqtrid INT, fiscalqtrdesc STRING, holidayflag BOOLEAN"
)
TIME = (
    "sk_timeid BIGINT, timevalue STRING, hourid INT, hourdesc STRING, minuteid INT, minutedesc STRING, "
    "secondid INT, seconddesc STRING, markethoursflag BOOLEAN, officehoursflag BOOLEAN"
)
INDUSTRY = "in_id STRING, in_name STRING, in_sc_id STRING"
STATUS_TYPE = "st_id STRING, st_name STRING"
TAX_RATE = "tx_id STRING, tx_name STRING, tx_rate FLOAT"
TRADE_TYPE = "tt_id STRING, tt_name STRING, tt_is_sell INT, tt_is_mrkt INT"
BATCH_DATE = "batchdate DATE"
HR = (
    "employeeid BIGINT, managerid BIGINT, employeefirstname STRING, employeelastname STRING, "
    "employeemi STRING, employeejobcode STRING, employeebranch STRING, employeeoffice STRING, employeephone STRING"
)
TRADE = (
    "tradeid BIGINT, t_dts TIMESTAMP, status STRING, t_tt_id STRING, cashflag TINYINT, t_s_symb STRING, "
    "quantity INT, bidprice DOUBLE, t_ca_id BIGINT, executedby STRING, tradeprice DOUBLE, fee DOUBLE, "
    "commission DOUBLE, tax DOUBLE"
)
TRADE_HISTORY = "tradeid BIGINT, th_dts TIMESTAMP, status STRING"
CASH_TRANSACTION = "accountid BIGINT, ct_dts TIMESTAMP, ct_amt DOUBLE, ct_name STRING"
HOLDING_HISTORY = "hh_h_t_id INT, hh_t_id INT, hh_before_qty INT, hh_after_qty INT"
DAILY_MARKET = "dm_date DATE, dm_s_symb STRING, dm_close DOUBLE, dm_high DOUBLE, dm_low DOUBLE, dm_vol INT"
WATCH_HISTORY = "w_c_id BIGINT, w_s_symb STRING, w_dts TIMESTAMP, w_action STRING"
_PHONES = ", ".join(f"c_{part}_{n} STRING" for n in (1, 2, 3) for part in ("ctry", "area", "local", "ext"))
CUSTOMER = (
    "customerid BIGINT, taxid STRING, status STRING, lastname STRING, firstname STRING, middleinitial STRING, "
    "gender STRING, tier TINYINT, dob DATE, addressline1 STRING, addressline2 STRING, postalcode STRING, "
    f"city STRING, stateprov STRING, country STRING, {_PHONES}, email1 STRING, email2 STRING, "
    "lcl_tx_id STRING, nat_tx_id STRING"
)
ACCOUNT = (
    "accountid BIGINT, brokerid BIGINT, customerid BIGINT, accountdesc STRING, taxstatus TINYINT, status STRING"
)
PROSPECT = (
    "agencyid STRING, lastname STRING, firstname STRING, middleinitial STRING, gender STRING, "
    "addressline1 STRING, addressline2 STRING, postalcode STRING, city STRING, state STRING, country STRING, "
    "phone STRING, income STRING, numbercars INT, numberchildren INT, maritalstatus STRING, age INT, "
    "creditrating INT, ownorrentflag STRING, employer STRING, numbercreditcards INT, networth INT"
)
AUDIT = "dataset STRING, batchid INT, date DATE, attribute STRING, value BIGINT, dvalue DECIMAL(15,5)"
MESSAGES = (
    "messagedateandtime TIMESTAMP, batchid INT, messagesource STRING, messagetext STRING, "
    "messagetype STRING, messagedata STRING"
)

XML_ROW_TAG = "TPCDI:Action"
_XML_PHONE = "STRUCT<C_CTRY_CODE: STRING, C_AREA_CODE: STRING, C_LOCAL: STRING, C_EXT: STRING>"
CUSTOMER_MGMT = (
    "_ActionType STRING, _ActionTS STRING, Customer STRUCT<"
    "_C_ID: STRING, _C_TAX_ID: STRING, _C_GNDR: STRING, _C_TIER: STRING, _C_DOB: STRING, "
    "Name: STRUCT<C_L_NAME: STRING, C_F_NAME: STRING, C_M_NAME: STRING>, "
    "Address: STRUCT<C_ADLINE1: STRING, C_ADLINE2: STRING, C_ZIPCODE: STRING, C_CITY: STRING, "
    "C_STATE_PROV: STRING, C_CTRY: STRING>, "
    "ContactInfo: STRUCT<C_PRIM_EMAIL: STRING, C_ALT_EMAIL: STRING, "
    f"C_PHONE_1: {_XML_PHONE}, C_PHONE_2: {_XML_PHONE}, C_PHONE_3: {_XML_PHONE}>, "
    "TaxInfo: STRUCT<C_LCL_TX_ID: STRING, C_NAT_TX_ID: STRING>, "
    "Account: STRUCT<_CA_ID: STRING, _CA_TAX_ST: STRING, CA_B_ID: STRING, CA_NAME: STRING>>"
)

# Fixed-width layouts: (name, first column on the full line, width, type).
FINWIRE_HEADER = 18
CMP_FIELDS = [
    ("companyname", 19, 60, "string"),
    ("cik", 79, 10, "string"),
    ("status", 89, 4, "string"),
    ("industryid", 93, 2, "string"),
    ("sprating", 95, 4, "string"),
    ("foundingdate", 99, 8, "date"),
    ("addressline1", 107, 80, "string"),
    ("addressline2", 187, 80, "string"),
    ("postalcode", 267, 12, "string"),
    ("city", 279, 25, "string"),
    ("stateprov", 304, 20, "string"),
    ("country", 324, 24, "string"),
    ("ceo", 348, 46, "string"),
    ("description", 394, 150, "string"),
]
SEC_FIELDS = [
    ("symbol", 19, 15, "string"),
    ("issue", 34, 6, "string"),
    ("status", 40, 4, "string"),
    ("name", 44, 70, "string"),
    ("exchangeid", 114, 6, "string"),
    ("sharesoutstanding", 120, 13, "bigint"),
    ("firsttrade", 133, 8, "date"),
    ("firsttradeonexchange", 141, 8, "date"),
    ("dividend", 149, 12, "double"),
    ("conameorcik", 161, 60, "string"),
]
FIN_FIELDS = [
    ("fi_year", 19, 4, "int"),
    ("fi_qtr", 23, 1, "int"),
    ("fi_qtr_start_date", 24, 8, "date"),
    ("fi_revenue", 40, 17, "double"),
    ("fi_net_earn", 57, 17, "double"),
    ("fi_basic_eps", 74, 12, "double"),
    ("fi_dilut_eps", 86, 12, "double"),
    ("fi_margin", 98, 12, "double"),
    ("fi_inventory", 110, 17, "double"),
    ("fi_assets", 127, 17, "double"),
    ("fi_liability", 144, 17, "double"),
    ("fi_out_basic", 161, 13, "bigint"),
    ("fi_out_dilut", 174, 13, "bigint"),
    ("conameorcik", 187, 60, "string"),
]
