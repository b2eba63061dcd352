"""A tiny three-batch raw extract, written as the source systems deliver it."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

BATCH_DATES = {1: "2017-07-07", 2: "2017-07-08", 3: "2017-07-09"}


def _write(root: Path, batch: int, name: str, lines: list[str]) -> None:
    folder = root / f"Batch{batch}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def _dates() -> list[str]:
    days = [date(1950, 1, 1)] + [date(2007, 1, 1) + timedelta(days=i) for i in range(3900)]
    return [f"{d:%Y%m%d}|{d}|d|{d.year}|y|1|q|1|m|1|w|1|wd|{d.year}|fy|1|fq|false" for d in days]


def _cmp(day: str, name: str, cik: int, rating: str, industry: str = "AM", status: str = "ACTV") -> str:
    return (
        f"{day}-120000CMP{name:<60}{cik:010d}{status:<4}{industry:<2}{rating:<4}19700101"
        f"{'1 Road':<80}{'':<80}{'12345':<12}{'Town':<25}{'ST':<20}{'Canada':<24}{'Boss':<46}{'words':<150}"
    )


def _sec(day: str, symbol: str, ref: str, dividend: str = "1.50", first: str = "19990101") -> str:
    return (
        f"{day}-120000SEC{symbol:<15}{'COMMON':<6}{'ACTV':<4}{symbol + ' share':<70}{'NYSE':<6}{1000:013d}"
        f"{first:<8}{'19990102':<8}{dividend:>12}{ref:<60}"
    )


def _fin(day: str, year: int, qtr: int, eps: float, ref: str) -> str:
    start = f"{year}{(qtr - 1) * 3 + 1:02d}01"
    return (
        f"{day}-120000FIN{year}{qtr}{start}{start}{1000.0:>17}{eps * 100:>17}{eps:>12}{eps:>12}{eps / 10:>12}"
        f"{'':>17}{5.0:>17}{6.0:>17}{100:>13}{100:>13}{ref:<60}"
    )


def _action(kind: str, ts: str, customer: int, attrs: str = "", inner: str = "") -> str:
    return (
        f'<TPCDI:Action ActionType="{kind}" ActionTS="{ts}">\n'
        f'  <Customer C_ID="{customer}" {attrs}>{inner}</Customer>\n</TPCDI:Action>'
    )


def _account(account: int, broker: str = "1", name: str = "acct", tax: str = "1") -> str:
    body = (f"<CA_B_ID>{broker}</CA_B_ID>" if broker else "") + (f"<CA_NAME>{name}</CA_NAME>" if name else "")
    return f'<Account CA_ID="{account}" CA_TAX_ST="{tax}">{body}</Account>'


def _person(last: str, first: str, line1: str, zipcode: str) -> str:
    return (
        f"<Name><C_L_NAME>{last}</C_L_NAME><C_F_NAME>{first}</C_F_NAME><C_M_NAME/></Name>"
        f"<Address><C_ADLINE1>{line1}</C_ADLINE1><C_ADLINE2></C_ADLINE2><C_ZIPCODE>{zipcode}</C_ZIPCODE>"
        "<C_CITY>X</C_CITY><C_STATE_PROV>ST</C_STATE_PROV><C_CTRY>Canada</C_CTRY></Address>"
        f"<ContactInfo><C_PRIM_EMAIL>{first}.{last}@mail.com</C_PRIM_EMAIL>"
        "<C_PHONE_1><C_CTRY_CODE>1</C_CTRY_CODE><C_AREA_CODE>212</C_AREA_CODE><C_LOCAL>555-1234</C_LOCAL>"
        "<C_EXT>99</C_EXT></C_PHONE_1><C_PHONE_2><C_LOCAL></C_LOCAL></C_PHONE_2></ContactInfo>"
        "<TaxInfo><C_LCL_TX_ID>LC1</C_LCL_TX_ID><C_NAT_TX_ID>NA1</C_NAT_TX_ID></TaxInfo>"
    )


def _customer_xml() -> list[str]:
    new = 'C_TAX_ID="123-45-6789" C_GNDR="{g}" C_TIER="{t}" C_DOB="{b}"'
    return [
        '<?xml version="1.0" encoding="UTF-8"?>',
        '<TPCDI:Actions xmlns:TPCDI="urn:actions">',
        _action(
            "NEW", "2007-07-01T10:00:00", 1, new.format(g="m", t=1, b="1950-05-05"),
            _person("Li", "Wei", "1 Road", "111") + _account(11),
        ),
        _action(
            "NEW", "2007-08-01T10:00:00", 2, new.format(g="X", t=4, b="1900-01-01"),
            _person("Ray", "Ann", "2 Road", "222") + _account(21, "3"),
        ),
        _action("ADDACCT", "2008-01-01T09:00:00", 1, "", _account(12, "3", "second")),
        _action("UPDCUST", "2009-03-01T09:00:00", 1, 'C_TIER="2"', ""),
        _action("UPDCUST", "2009-03-01T17:00:00", 1, "", "<Address><C_CITY>Y</C_CITY></Address>"),
        _action("UPDACCT", "2010-05-01T09:00:00", 1, "", _account(11, "", "renamed", "2")),
        _action("CLOSEACCT", "2011-01-01T09:00:00", 1, "", _account(12, "", "", "1")),
        _action("INACT", "2012-01-01T09:00:00", 2, "", ""),
        "</TPCDI:Actions>",
    ]


def _prospect(agency: str, last: str, first: str, line1: str, zipcode: str, worth: int, credit: int = 700) -> str:
    return (
        f"{agency},{last},{first},,M,{line1},,{zipcode},X,ST,Canada,555,60000,1,1,S,30,{credit},O,Acme,1,{worth}"
    )


def _customer_row(flag: str, dsn: int, customer: int, status: str, **given: str) -> str:
    cols = (
        "taxid lastname firstname middleinitial gender tier dob addressline1 addressline2 postalcode city stateprov country "
        "c_ctry_1 c_area_1 c_local_1 c_ext_1 c_ctry_2 c_area_2 c_local_2 c_ext_2 c_ctry_3 c_area_3 c_local_3 c_ext_3 "
        "email1 email2 lcl_tx_id nat_tx_id"
    ).split()
    values = [given.get(c, "") for c in cols]
    return "|".join([flag, str(dsn), str(customer), values[0], status, *values[1:]])


def write_extract(root: Path) -> str:
    """Write all files below ``root`` and return it as text."""
    w = lambda batch, name, *lines: _write(root, batch, name, list(lines))
    w(1, "Date.txt", *_dates())
    clock = ["09:05:07", "11:30:05", "10:00:00", "12:00:00"]
    w(1, "Time.txt", *[f"{int(t.replace(':', ''))}|{t}|{t[:2]}|h|{t[3:5]}|m|{t[6:]}|s|true|true" for t in clock])
    w(1, "Industry.txt", "AM|Aerospace|BM", "HR|Hotels|CC")
    codes = "ACTV|Active CMPT|Completed CNCL|Canceled PNDG|Pending SBMT|Submitted INAC|Inactive"
    w(1, "StatusType.txt", *codes.split())
    w(1, "TaxRate.txt", "LC1|Local one|0.05", "LC2|Local two|0.06", "NA1|National one|0.25")
    kinds = ["TMB|Market Buy|0|1", "TMS|Market Sell|1|1", "TSL|Stop Loss|1|0", "TLS|Limit Sell|1|0", "TLB|Limit Buy|0|0"]
    w(1, "TradeType.txt", *kinds)
    for n, day in BATCH_DATES.items():
        w(n, "BatchDate.txt", day)
    w(1, "HR.csv", "1,9,Bo,Boss,A,314,B1,O1,555", "2,9,No,Job,A,100,B1,O1,555", "3,9,Al,Ong,A,314,B2,O2,555", "4,9,Bl,Ank,A,,B2,O2,555")
    wire = [
        _cmp("20070101", "ACME", 1, "BB+"),
        _cmp("20070101", "Globex", 2, "ZZ"),
        _cmp("20100101", "ACME", 1, "AAA"),
        _sec("20070102", "AAA", "0000000001"),
        _sec("20070102", "BBB", "Globex", first=""),
        _sec("20080101", "AAA", "ACME", "2.00"),
    ]
    quarters = [(2010 + i // 4, i % 4 + 1) for i in range(6)]
    wire += [_fin("20100201", y, q, float(i + 1), "0000000001") for i, (y, q) in enumerate(quarters)]
    wire += [_fin("20100201", 2010, 1, 0.5, "Globex")]
    w(1, "FINWIRE2007Q1", *wire[:6])
    w(1, "FINWIRE2010Q1", *wire[6:])
    w(1, "CustomerMgmt.xml", *_customer_xml())
    w(
        2,
        "Customer.txt",
        _customer_row("U", 1, 1, "ACTV", tier="3", city="Z", gender="m", lcl_tx_id="LC2"),
        _customer_row(
            "I", 2, 3, "ACTV", taxid="999-99-9999", lastname="Doe", firstname="Jo", gender="f", tier="1", dob="2020-01-01",
            addressline1="3 Road", postalcode="333", city="C", lcl_tx_id="LC1", nat_tx_id="NA1",
        ),
    )
    w(3, "Customer.txt", _customer_row("U", 3, 3, "INAC"))
    w(2, "Account.txt", "U|1|11|3|1|changed|1|ACTV", "I|2|31|1|3|third|0|ACTV")
    w(3, "Account.txt", "U|3|21|3|2||2|INAC")
    trade = "{id}|{ts}|{st}|{tt}|1|{sy}|10|5.0|{ca}|Exec|{price}|{fee}|{comm}|0.5"
    w(
        1,
        "Trade.txt",
        trade.format(id=100, ts="2010-02-03 11:30:05", st="CMPT", tt="TMB", sy="AAA", ca=11, price=5.0, fee=1.0, comm=2.0),
        trade.format(id=101, ts="2017-07-06 09:05:07", st="SBMT", tt="TLB", sy="BBB", ca=21, price="", fee="", comm=""),
        trade.format(id=102, ts="2010-04-01 10:00:00", st="CNCL", tt="XXX", sy="AAA", ca=12, price=1.0, fee=99.0, comm=99.0),
    )
    w(
        1,
        "TradeHistory.txt",
        "100|2010-02-01 09:05:07|SBMT",
        "100|2010-02-03 11:30:05|CMPT",
        "101|2017-07-06 09:05:07|SBMT",
        "102|2010-03-31 10:00:00|PNDG",
        "102|2010-04-01 10:00:00|CNCL",
    )
    w(
        2,
        "Trade.txt",
        "U|1|" + trade.format(id=101, ts="2017-07-08 11:30:05", st="CMPT", tt="TLB", sy="BBB", ca=21, price=7.0, fee=1.0, comm=1.0),
        "I|2|" + trade.format(id=103, ts="2017-07-08 10:00:00", st="SBMT", tt="TMS", sy="AAA", ca=11, price="", fee="", comm=""),
    )
    w(
        3,
        "Trade.txt",
        "U|3|" + trade.format(id=103, ts="2017-07-09 12:00:00", st="CMPT", tt="TMS", sy="AAA", ca=11, price=6.0, fee=1.0, comm=1.0),
    )
    w(1, "HoldingHistory.txt", "100|100|0|10")
    w(2, "HoldingHistory.txt", "I|1|101|101|0|10")
    w(3, "HoldingHistory.txt", "I|2|100|103|10|0")
    w(
        1,
        "CashTransaction.txt",
        "11|2010-02-03 12:00:00|100.0|a",
        "11|2010-02-03 13:00:00|50.0|b",
        "11|2010-02-04 12:00:00|-30.0|c",
        "21|2012-01-01 12:00:00|5.5|d",
    )
    w(2, "CashTransaction.txt", "I|1|11|2017-07-08 10:00:00|10.0|e")
    w(3, "CashTransaction.txt", "I|2|21|2017-07-09 10:00:00|1.0|f", "I|3|11|2017-07-09 11:00:00|-1.0|g")
    quote = "{d}|{s}|{c}|{h}|{lo}|100"
    w(
        1,
        "DailyMarket.txt",
        quote.format(d="2010-11-01", s="AAA", c=20.0, h=25.0, lo=15.0),
        quote.format(d="2010-11-02", s="AAA", c=21.0, h=22.0, lo=14.0),
        quote.format(d="2010-11-03", s="AAA", c=21.0, h=25.0, lo=14.0),
        quote.format(d="2010-02-01", s="BBB", c=2.0, h=2.0, lo=2.0),
    )
    w(2, "DailyMarket.txt", "I|1|" + quote.format(d="2017-07-07", s="AAA", c=30.0, h=31.0, lo=13.0))
    w(3, "DailyMarket.txt", "I|2|" + quote.format(d="2017-07-08", s="BBB", c=3.0, h=3.0, lo=1.0))
    w(1, "WatchHistory.txt", "1|AAA|2010-01-01 10:00:00|ACTV", "1|AAA|2010-01-05 10:00:00|CNCL", "2|BBB|2010-01-02 10:00:00|ACTV")
    w(2, "WatchHistory.txt", "I|1|1|BBB|2017-07-08 10:00:00|ACTV")
    w(3, "WatchHistory.txt", "I|2|2|BBB|2017-07-09 10:00:00|CNCL")
    w(1, "Prospect.csv", _prospect("A1", "LI", "wei", "1 ROAD", "111", 2000000), _prospect("A2", "Un", "Known", "9 Road", "999", 5000))
    w(2, "Prospect.csv", _prospect("A1", "LI", "wei", "1 ROAD", "111", 2000000), _prospect("A3", "Ray", "Ann", "2 Road", "222", 500000))
    w(3, "Prospect.csv", _prospect("A1", "LI", "wei", "1 ROAD", "111", 500000), _prospect("A3", "Ray", "Ann", "2 Road", "222", 500000))
    _audit(root)
    return str(root)


# Expected counts of the extract, worked out by hand: (data set, attribute, values of batches 1, 2, 3).
EXPECTED = [
    ("DimCustomer", "C_NEW", (2, 1, 0)),
    ("DimCustomer", "C_UPDCUST", (2, 1, 0)),
    ("DimCustomer", "C_INACT", (1, 0, 1)),
    ("DimCustomer", "C_ID_HIST", (1, 0, 0)),
    ("DimCustomer", "C_DOB_TO", (1, 0, 0)),
    ("DimCustomer", "C_DOB_TY", (0, 1, 1)),
    ("DimCustomer", "C_TIER_INV", (1, 0, 0)),
    ("DimAccount", "CA_ADDACCT", (1, 1, 0)),
    ("DimAccount", "CA_CLOSEACCT", (1, 0, 1)),
    ("DimAccount", "CA_UPDACCT", (1, 1, 0)),
    ("DimAccount", "CA_ID_HIST", (2, 0, 0)),
    ("DimSecurity", "FW_SEC", (3, 0, 0)),
    ("DimCompany", "FW_CMP", (3, 0, 0)),
    ("Financial", "FW_FIN", (7, 0, 0)),
    ("FactWatches", "WH_ACTIVE", (2, 1, 0)),
    ("FactWatches", "WH_RECORDS", (3, 1, 1)),
    ("DimTrade", "T_NEW", (3, 1, 0)),
    ("DimTrade", "T_CanceledTrades", (1, 0, 0)),
    ("DimTrade", "T_InvalidCommision", (1, 0, 0)),
    ("DimTrade", "T_InvalidCharge", (1, 0, 0)),
    ("FactMarketHistory", "DM_RECORDS", (4, 1, 1)),
    ("FactHoldings", "HH_RECORDS", (1, 1, 1)),
    ("Prospect", "P_RECORDS", (2, 2, 2)),
    ("Generator", "SF", (3, 3, 3)),
]


def _audit(root: Path) -> None:
    head = "DataSet,BatchID,Date,Attribute,Value,DValue"
    for n, day in BATCH_DATES.items():
        first = "1950-01-01" if n == 1 else day
        lines = [head, f"Batch,{n},{first},FirstDay,,", f"Batch,{n},{day},LastDay,,"]
        lines += [f"{dataset},{n},,{attribute},{values[n - 1]}," for dataset, attribute, values in EXPECTED]
        if n == 1:
            lines.append("DimBroker,1,,HR_BROKERS,2,")
        _write(root, n, f"Batch{n}_audit.csv", lines)
