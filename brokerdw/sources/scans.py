"""Scans of raw extracts. Schemas are always declared, never inferred."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerdw.functions.exprs import col, try_date8, try_long
from brokerdw.operators.hotkeys import stored
from brokerdw.sources import schemas

Field = tuple[str, int, str]
FixedField = tuple[str, int, int, str]


def scan_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = "|", header: bool = False, pattern: str | None = None
) -> DataFrame:
    """Delimited text with a declared schema; an unreadable value becomes null.

    ``path`` may hold globs such as ``Batch{2,3}``; ``pattern`` filters file names.
    """
    reader = spark.read.schema(schema).option("sep", sep).option("header", header)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.csv(path)


def scan_text_split(
    spark: SparkSession, path: str, sep: str, fields: Sequence[Field], pattern: str | None = None
) -> DataFrame:
    """Text lines split into an array; ``fields`` are ``(name, position, type)``."""
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    quoted = "[" + sep + "]" if len(sep) == 1 else sep
    parts = reader.text(path).select(F.split("value", quoted).alias("_p"), F.col("_metadata"))
    return parts.select(
        *[try_parse(F.get("_p", F.lit(i)), kind).alias(name) for name, i, kind in fields],
        F.col("_metadata"),
    )


def try_parse(c: Column | str, kind: str) -> Column:
    """Trimmed text to a type; blanks and malformed values become null."""
    text = F.trim(col(c))
    if kind == "string":
        return text
    if kind == "date":
        slow = F.coalesce(
            F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd"))),
            F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))),
        )
        return F.coalesce(try_date8(text), F.when(text != "", slow))  # each format that fails raises an error
    return F.nullif(text, F.lit("")).try_cast(kind)


def with_batch_id(df: DataFrame, name: str = "batchid") -> DataFrame:
    """Add the number of the ``BatchN`` folder a row was read from (any number of digits)."""
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/Batch(\d+)/", 1).try_cast("int")
    visible = [c for c in df.columns if c != "_metadata"]
    return df.select(*visible, number.alias(name))


def parse_fixed(
    df: DataFrame, value: Column | str, fields: Sequence[FixedField], keep: Sequence[str] = (), shift: int = 0
) -> DataFrame:
    """Cut fixed-width fields; ``shift`` is the number of characters already removed in front."""
    text = col(value)
    # Cut first, parsed then: finding a place means counting the line's characters, and a parse reads its text more than once.
    cut = df.select(*keep, *[F.trim(F.substring(text, start - shift, width)).alias(name) for name, start, width, _ in fields])
    return cut.select(*keep, *[try_parse(name, kind).alias(name) for name, _, _, kind in fields])


def classify_finwire(lines: DataFrame, value: str = "value") -> DataFrame:
    """Split wire lines into ``rectype, recdate, value`` (header removed).

    Financial records are told apart by whether they refer to a company by number or
    by name, so that each later join has one typed key and one partition to read.
    """
    text = F.col(value)
    kind, day = F.substring(text, 16, 3), F.substring(text, 1, 8)
    by_number = try_long(F.trim(F.substring(text, 187, 60))).isNotNull()
    rectype = F.when(kind == "FIN", F.when(by_number, "FIN_COMPANYID").otherwise("FIN_NAME")).otherwise(kind)
    return lines.select(
        rectype.alias("rectype"),
        F.coalesce(try_date8(day), F.to_date(F.try_to_timestamp(day, F.lit("yyyyMMdd")))).alias("recdate"),
        F.expr(f"substring({value}, {schemas.FINWIRE_HEADER + 1})").alias("value"),
    )


def scan_finwire(spark: SparkSession, path: str) -> DataFrame:
    """Quarterly wire files, classified."""
    return classify_finwire(spark.read.text(path))


def parse_cmp(stage: DataFrame) -> DataFrame:
    return _parse_wire(stage.filter(F.col("rectype") == "CMP"), schemas.CMP_FIELDS)


def parse_sec(stage: DataFrame) -> DataFrame:
    return _parse_wire(stage.filter(F.col("rectype") == "SEC"), schemas.SEC_FIELDS)


def parse_fin(stage: DataFrame) -> DataFrame:
    rows = stage.filter(F.col("rectype").isin("FIN_COMPANYID", "FIN_NAME"))
    return _parse_wire(rows, schemas.FIN_FIELDS, ["rectype", "recdate"])


def _parse_wire(rows: DataFrame, fields: Sequence[FixedField], keep: Sequence[str] = ("recdate",)) -> DataFrame:
    return parse_fixed(rows, "value", fields, keep, schemas.FINWIRE_HEADER)


# What a piece of XML can begin in: text, a comment, a CDATA section, a processing instruction.
OPENERS = ("", "<!--", "<![CDATA[", "<?")
_WHOLE = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"
_TO_THE_END = r"(?s)(<!\[CDATA\[.*?(?:\]\]>|\z))|<!--.*?(?:-->|\z)|<\?.*?(?:\?>|\z)"
_ATTRS = """(?:[^>"']|"[^"]*"|'[^']*')*?"""
# Pieces that are put together at once on the way to the state at the start of each piece.
TOGETHER = 64


def scan_xml(spark: SparkSession, path: str, row_tag: str, schema: str, pattern: str | None = None) -> DataFrame:
    """XML records with a declared schema; attributes are ``_name``.

    The text reader cuts the file at the closing row tag, so one large file is read by many
    tasks. A closing tag inside a comment, a CDATA section or a processing instruction ends
    no record. Whether a piece begins inside one depends on all pieces before it, so each
    piece is summed up as a function from what it begins in to what it ends in; functions
    are composed in a tree, and the states come back down it. A file in which no piece ends
    inside such a construct, as nearly every file, is parsed piece by piece without that.

    Comments and instructions are dropped and CDATA becomes escaped text, so what is found
    afterwards as a tag is one. A piece may hold self-closing records before one with an end
    tag. Records are parsed by ``from_xml``. Records inside records and attributes with a
    ``<``, which XML forbids, are reported by :func:`check_xml`.
    """
    close = f"</{row_tag}>"
    start = rf"<{row_tag}(?=[\s/>])"
    alone, opened = rf"{start}{_ATTRS}/>", rf"{start}(?!{_ATTRS}/>)"
    found = _xml_text(spark, path, row_tag, pattern).withColumn("at", F.regexp_instr("value", F.lit(opened)))
    before = F.when(F.col("at") > 0, F.expr("left(value, at - 1)")).otherwise(F.col("value"))
    rest = F.when(F.col("at") > 0, F.array(F.concat(F.expr("substring(value, at)"), F.lit(close))))
    records = F.concat(F.regexp_extract_all(before, F.lit(alone), F.lit(0)), F.coalesce(rest, F.array().cast("array<string>")))
    return found.select(F.explode(records).alias("record")).select(F.from_xml("record", schema).alias("r")).select("r.*")


def check_xml(spark: SparkSession, path: str, row_tag: str, pattern: str | None = None) -> None:
    """Raise if records are opened more or less often than closed, as in a file that was cut off.

    A whole file has one piece more than closing tags: what follows the last one.
    """
    opened = rf"<{row_tag}(?=[\s/>])(?!{_ATTRS}/>)"
    pieces = _xml_text(spark, path, row_tag, pattern)
    found = F.size(F.regexp_extract_all("value", F.lit(opened), F.lit(0)))
    counts = pieces.groupBy("file").agg(F.sum(found).alias("opens"), (F.count("*") - 1).alias("closes"), F.max(found).alias("most"))
    bad = counts.filter("opens <> closes or most > 1").orderBy("file").first()
    if bad:
        raise ValueError(f"{bad['file']}: {bad['opens']} records are opened and {bad['closes']} closed, up to {bad['most']} at once")


def _end_state(text: Column) -> Column:
    """What a text that begins outside of everything ends in, as a place in ``OPENERS``."""
    left = F.regexp_extract(F.regexp_replace(text, _WHOLE, " "), r"<!--|<!\[CDATA\[|<\?", 0)
    return (F.array_position(F.array(*map(F.lit, OPENERS)), left) - 1).cast("int")


def _plain(text: Column) -> Column:
    """The text without comments and instructions, CDATA as escaped text; what is open at the end ends there."""
    kept = F.regexp_replace(text, _TO_THE_END, "$1")

    def escaped(part: Column, i: Column) -> Column:
        end = F.instr(part, F.lit("]]>"))
        data = F.when(end > 0, F.substring(part, F.lit(1), end - 1)).otherwise(part)
        for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            data = F.replace(data, F.lit(sign), F.lit(entity))
        after = F.when(end > 0, F.substring(part, end + 3, F.length(part))).otherwise(F.lit(""))
        return F.when(i == 0, part).otherwise(F.concat(data, after))

    parts = F.transform(F.split(kept, r"<!\[CDATA\["), escaped)
    return F.when(F.contains(kept, F.lit("<![CDATA[")), F.array_join(parts, "")).otherwise(kept)


def _xml_text(spark: SparkSession, path: str, row_tag: str, pattern: str | None) -> DataFrame:
    """``file, value``: the plain text up to each closing tag that ends a record, and the rest of the file."""
    close = f"</{row_tag}>"
    pieces = _text(spark, path, pattern, close).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("i"),
        "value",
    )
    if pieces.filter(_end_state(F.col("value")) != 0).isEmpty():
        return pieces.select("file", _plain(F.col("value")).alias("value"))
    states = _start_states(pieces)
    opener = F.get(F.array(*map(F.lit, OPENERS)), F.col("state"))
    whole = F.concat(opener, F.col("value"))
    # A closing tag inside CDATA is text; one inside a comment is nothing.
    tag = F.when(_end_state(whole) == 2, F.lit(f"&lt;/{row_tag}&gt;")).otherwise(F.lit(""))
    known = pieces.join(states, ["file", "block", "i"]).withColumn("value", F.concat(_plain(whole), tag))
    # What lies inside a comment is gone by now, however long it is.
    known = known.filter((F.col("value") != "") | (F.col("state") == 0))
    parts = F.array_sort(F.collect_list(F.struct("block", "i", "value")))
    records = known.groupBy("file", "record").agg(parts.alias("parts"))
    return records.select("file", F.array_join(F.transform("parts", lambda p: p["value"]), "").alias("value"))


def _start_states(pieces: DataFrame) -> DataFrame:
    """``file, block, i, state, record``: what each piece begins in, and the number of records that end before it.

    A node of the tree holds, for every state at its start, the state at its end and the
    records that end in it. Nodes are groups of ``TOGETHER`` pieces, then of as many groups,
    then the block that a task reads, then the file: none gathers more than a file's blocks
    or a block's groups of groups.
    """
    ends = [_end_state(F.concat(F.lit(o), F.col("value"))) for o in OPENERS]
    step = F.array(*[F.struct(e.alias("e"), (e == 0).cast("long").alias("c")) for e in ends]).alias("f")
    leaves = pieces.select("file", "block", "i", step)
    base = leaves.withColumn("g1", F.expr(f"i div {TOGETHER}")).withColumn("g2", F.expr(f"g1 div {TOGETHER}"))
    nothing = F.expr("transform(sequence(0, 3), s -> named_struct('e', cast(s as int), 'c', 0L))")

    def then(a: Column, b: Column) -> Column:
        return F.transform(a, lambda x: F.struct(F.get(b, x["e"])["e"].alias("e"), (x["c"] + F.get(b, x["e"])["c"]).alias("c")))

    def up(nodes: DataFrame, group: list[str], order: str) -> DataFrame:
        kids = F.array_sort(F.collect_list(F.struct(order, "f"))).alias("kids")
        grouped = nodes.groupBy(*group).agg(kids)
        return grouped.withColumn("f", F.aggregate("kids", nothing, lambda a, k: then(a, k["f"])))

    def down(nodes: DataFrame, group: list[str], order: str) -> DataFrame:
        """The state and the records before each child, from those of its node."""
        first = F.struct(F.col("state").alias("e"), F.col("record").alias("c"), F.expr(f"cast(array() as array<struct<{order}:bigint,state:int,record:bigint>>)").alias("out"))

        def one(a: Column, k: Column) -> Column:
            own = F.get(k["f"], a["e"])
            entry = F.struct(k[order].alias(order), a["e"].alias("state"), a["c"].alias("record"))
            return F.struct(own["e"].alias("e"), (a["c"] + own["c"]).alias("c"), F.concat(a["out"], F.array(entry)).alias("out"))

        return nodes.select(*group, F.inline(F.aggregate("kids", first, one, lambda a: a["out"])))

    levels = [(["file", "block", "g2", "g1"], "i"), (["file", "block", "g2"], "g1"), (["file", "block"], "g2"), (["file"], "block")]
    tree, nodes = [], base
    for group, order in levels:
        nodes = stored(up(nodes, group, order), "xml-states")
        tree.append(nodes)
    placed = down(nodes.withColumns({"state": F.lit(0), "record": F.lit(0).cast("long")}), *levels[-1])
    for nodes, (group, order) in zip(tree[-2::-1], levels[-2::-1], strict=True):
        placed = down(nodes.join(placed, group), group, order)
    return placed.select("file", "block", "i", "state", "record")


def _text(spark: SparkSession, path: str, pattern: str | None, separator: str) -> DataFrame:
    reader = spark.read.option("lineSep", separator)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).text(path)


def stream_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = "|", pattern: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Streaming form of :func:`scan_delimited` (new files become micro-batches)."""
    reader = spark.readStream.schema(schema).option("sep", sep)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


@dataclass(frozen=True)
class TableSpec:
    """Where a raw file lives and how to read it."""

    name: str
    file: str
    schema: str
    sep: str = "|"
    batches: str = "Batch1"
    tag_batch: bool = False
    cdc: bool = False


RAW_TABLES = [
    TableSpec("dimdate", "Date.txt", schemas.DATE),
    TableSpec("dimtime", "Time.txt", schemas.TIME),
    TableSpec("industry", "Industry.txt", schemas.INDUSTRY),
    TableSpec("statustype", "StatusType.txt", schemas.STATUS_TYPE),
    TableSpec("taxrate", "TaxRate.txt", schemas.TAX_RATE),
    TableSpec("tradetype", "TradeType.txt", schemas.TRADE_TYPE),
    TableSpec("batchdate", "BatchDate.txt", schemas.BATCH_DATE, batches="Batch*", tag_batch=True),
    TableSpec("hr", "HR.csv", schemas.HR, sep=","),
    TableSpec("tradehistory", "TradeHistory.txt", schemas.TRADE_HISTORY),
    TableSpec("prospect", "Prospect.csv", schemas.PROSPECT, sep=",", batches="Batch*", tag_batch=True),
    TableSpec("customer_cdc", "Customer.txt", schemas.CUSTOMER, batches="Batch*", tag_batch=True, cdc=True),
    TableSpec("account_cdc", "Account.txt", schemas.ACCOUNT, batches="Batch*", tag_batch=True, cdc=True),
]
# Batch 1 lacks the change columns that later batches carry.
CHANGE_TABLES = [
    TableSpec("trade", "Trade.txt", schemas.TRADE),
    TableSpec("cashtransaction", "CashTransaction.txt", schemas.CASH_TRANSACTION),
    TableSpec("holdinghistory", "HoldingHistory.txt", schemas.HOLDING_HISTORY),
    TableSpec("dailymarket", "DailyMarket.txt", schemas.DAILY_MARKET),
    TableSpec("watchhistory", "WatchHistory.txt", schemas.WATCH_HISTORY),
]


def ingest(
    spark: SparkSession,
    root: str,
    specs: Sequence[TableSpec] = tuple(RAW_TABLES),
    batches: Sequence[int] | None = None,
) -> dict[str, DataFrame]:
    """One generic loader for every described file; files of every batch can be limited to ``batches``."""
    return {spec.name: _load(spark, root, spec, batches) for spec in specs}


def _load(spark: SparkSession, root: str, spec: TableSpec, batches: Sequence[int] | None) -> DataFrame:
    schema = f"{schemas.CDC_COLUMNS}, {spec.schema}" if spec.cdc else spec.schema
    folders = batch_folders(batches) if batches is not None and spec.batches == "Batch*" else spec.batches
    df = scan_delimited(spark, f"{root}/{folders}", schema, spec.sep, pattern=spec.file)
    return with_batch_id(df) if spec.tag_batch else df


def scan_all_batches(
    spark: SparkSession, root: str, spec: TableSpec, batches: Sequence[int] | None = None, keep_cdc: bool = False
) -> DataFrame:
    """Historical rows of batch 1 and the change rows of later batches under one schema.

    ``batches`` names the folders to read, and no other is opened; without it all that are there.
    """
    if batches is not None and 1 not in batches:
        return _changes(spark, root, spec, batches, keep_cdc)
    first = scan_delimited(spark, f"{root}/Batch1", spec.schema, spec.sep, pattern=spec.file)
    first = first.withColumn("batchid", F.lit(1))
    if keep_cdc:
        first = first.select(F.lit("I").alias("cdc_flag"), F.lit(None).cast("bigint").alias("cdc_dsn"), *first.columns)
    if batches is not None and len(batches) == 1:
        return first
    return first.unionByName(_changes(spark, root, spec, batches, keep_cdc))


def _changes(
    spark: SparkSession, root: str, spec: TableSpec, batches: Sequence[int] | None, keep_cdc: bool
) -> DataFrame:
    schema = f"{schemas.CDC_COLUMNS}, {spec.schema}"
    names = batch_folders(batches) if batches is not None else "Batch{[2-9],[1-9][0-9]*}"
    rows = with_batch_id(scan_delimited(spark, f"{root}/{names}", schema, spec.sep, pattern=spec.file)).filter("batchid != 1")
    return rows if keep_cdc else rows.drop("cdc_flag", "cdc_dsn")


def batch_folders(batches: Sequence[int]) -> str:
    """Glob of the folders of these batches."""
    return "Batch{" + ",".join(str(n) for n in batches) + "}"


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
