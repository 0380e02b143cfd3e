"""Engine inputs derived from the driver tables.

Each input is a row-by-row derivation: it needs no shuffle, grows with its
table and has the same skew.  The SQL in ``*_SQL`` is read by both engines,
``{table}`` being the source.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.config import FieldSpec, StatementType

LINES_PER_PAGE = 40

PAGE_RULE = StatementType(name="page rule", split_type="page_start", start_pattern=r"page\s+1\s+of\s+\d+")
RANGE_RULE = StatementType(
    name="range rule",
    split_type="start_end",
    start_pattern=r"Statement number\s+(\d+)",
    start_phrase="WELCOME TO YOUR ACCOUNT",
    must_not_contain="Continued overleaf...",
)
PHRASE_RULE = StatementType(name="phrase rule", split_type="page_start", start_phrase="WELCOME TO YOUR ACCOUNT")
NO_RULE = StatementType(name="no rule")
SPLIT_TYPES = [PAGE_RULE, RANGE_RULE, PHRASE_RULE, NO_RULE]

CARD = StatementType(
    name="card",
    summary_fields=(
        FieldSpec("OpeningBalance", is_amount=True),
        FieldSpec("ClosingBalance", is_amount=True),
        FieldSpec("Label"),
        FieldSpec("Rate", is_amount=True),
        FieldSpec("DocumentName"),
    ),
    static_fields=(
        FieldSpec("StatementNumber"),
        FieldSpec("AccountName"),
        FieldSpec("AccountNumber"),
        FieldSpec("Reference"),
        FieldSpec("Missing"),
    ),
    dynamic_fields=(
        FieldSpec("Date", is_date=True),
        FieldSpec("Description"),
        FieldSpec("Amount", is_amount=True),
        FieldSpec("Reference"),
        FieldSpec("Balance", is_amount=True),
    ),
)
LISTING = StatementType(
    name="listing",
    summary_fields=(FieldSpec("ClosingBalance", is_amount=True),),
    static_fields=(FieldSpec("AccountName"),),
    dynamic_fields=(FieldSpec("Description"), FieldSpec("Balance", is_amount=True)),
)

# Two more types: one without static fields, one in which a field that others read as an amount is text.
BARE = StatementType(name="bare", summary_fields=(FieldSpec("Label"),), dynamic_fields=(FieldSpec("Amount", is_amount=True),))
NOTES = StatementType(
    name="notes",
    summary_fields=(FieldSpec("Label"), FieldSpec("OpeningBalance", is_amount=True)),
    static_fields=(FieldSpec("AccountNumber", is_amount=True), FieldSpec("Reference")),
    dynamic_fields=(FieldSpec("Date", is_date=True), FieldSpec("Description")),
)
MIXED_TYPES = [CARD, LISTING, BARE, NOTES]
TYPE_SQL = "CASE WHEN l_partkey % 7 = 5 THEN 'unlisted' WHEN l_partkey % 7 = 6 THEN NULL ELSE element_at(array('card', 'listing', 'bare', 'notes'), CAST(l_suppkey % 4 AS INT) + 1) END"

ACCOUNT_EXAMPLE = "44-1234"
STATEMENT_EXAMPLE = "Statement no. 12"
DATE_EXAMPLE = "12 NOV 2023"


class Prepared(str):
    """A data folder together with one that holds the derived inputs, so that a benchmark can time the engine alone."""

    derived: str

    def __new__(cls, sf_dir: str, derived: str):
        self = super().__new__(cls, sf_dir)
        self.derived = derived
        return self


DERIVED = {}


def derived(function):
    """Mark an engine input that can be derived ahead of time."""

    @wraps(function)
    def read_or_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
        if isinstance(sf_dir, Prepared):
            return spark.read.parquet(f"{sf_dir.derived}/{function.__name__}")
        return function(spark, sf_dir)

    DERIVED[function.__name__] = function
    return read_or_derive


def prepare(spark: SparkSession, sf_dir: str, folder: str) -> Prepared:
    """Derive all inputs once, for queries that are given the result as their data folder."""
    cores = spark.sparkContext.defaultParallelism
    for name, function in DERIVED.items():
        function(spark, sf_dir).repartition(cores).write.parquet(f"{folder}/{name}")
    return Prepared(sf_dir, folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Pages: a file is a conversation, a page is a turn.
PAGES_SQL = """
SELECT folder, file_name, page_no,
       CASE WHEN conv_id % 9 = 4 THEN '' ELSE '  ' || body || ' ' END AS text,
       CASE WHEN conv_id % 9 = 4 OR conv_id % 2 = 0 THEN body END AS ocr_text,
       CASE WHEN conv_id % 20 = 7 AND page_no % 2 = 0 THEN 'Statement number 00' || sid || '  Page I 0f 3' END AS footer_text,
       CASE WHEN conv_id % 30 = 17 AND page_no = 1 THEN 'PAGE | of 9, page 1 of 9' END AS footer_ocr_text
FROM (
  SELECT *, CASE WHEN conv_id % 6 = 5 AND page_no % 4 = 1 THEN 'WELCOME TO YOUR ACCOUNT ' ELSE '' END
         || CASE WHEN conv_id % 10 = 7 OR page_no % 3 <> 0 THEN ''
                 WHEN conv_id % 3 = 0 THEN 'Statement number ' || sid || ' Page 1 of 3 '
                 WHEN conv_id % 3 = 1 THEN 'statement  number 0' || sid || ' page I 0f 3 '
                 ELSE 'Statement number ' || sid || ' PAGE' || chr(10) || '1  of 3 ' END
         || turn_text
         || CASE WHEN (conv_id + page_no) % 2 = 0 THEN ' Continued overleaf...' ELSE '' END AS body
  FROM (
    SELECT conv_id, text AS turn_text, CAST(turn AS INT) AS page_no,
           'f' || CAST(conv_id % 5 AS STRING) AS folder,
           'conv_' || CAST(conv_id AS STRING) || '.pdf' AS file_name,
           CAST(CASE WHEN conv_id % 4 = 1 THEN CAST(FLOOR(turn / 3) AS BIGINT) % 2 + 1
                     ELSE CAST(FLOOR(turn / 3) AS BIGINT) + 1 END AS STRING) AS sid
    FROM {conversations}
  ) numbered
) marked
"""


@derived
def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PAGES_SQL, conversations=table(spark, sf_dir, "conversations"))


# The same pages, some of which lost their number; a number tells nothing about a file's other pages.
MIXED_PAGES_SQL = f"""
SELECT folder, file_name, CASE WHEN file_name LIKE '%3.pdf' AND page_no = 1 THEN NULL ELSE page_no END AS page_no,
       text, ocr_text, footer_text, footer_ocr_text
FROM ({PAGES_SQL}) pages
"""


def mixed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MIXED_PAGES_SQL, conversations=table(spark, sf_dir, "conversations"))


# The files of a batch: one for each conversation, and some whose pages are missing.
BATCH_SQL = """
SELECT DISTINCT 'f' || CAST(conv_id % 5 AS STRING) AS folder, 'conv_' || CAST(conv_id AS STRING) || '.pdf' AS file_name FROM {conversations}
UNION ALL
SELECT DISTINCT 'f' || CAST(conv_id % 5 AS STRING), 'lost_' || CAST(conv_id AS STRING) || '.pdf' FROM {conversations} WHERE conv_id % 12 = 5
"""


def batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BATCH_SQL, conversations=table(spark, sf_dir, "conversations"))


# Spans of those pages whose text holds no start: the start stands in the footer, once in two spans; a body line, a
# picture and blank footers say nothing.
_AT = {"body": (0, 500, 0), "first": (5, 950, 0), "second": (6, 960, 0), "picture": (7, 990, 1), "blank": (5, 970, 0)}


def _page_span(kind: str, text: str, where: str) -> str:
    block, bottom, block_type = _AT[kind]
    return f"""
SELECT 'f' || CAST(conv_id % 5 AS STRING) AS folder, 'conv_' || CAST(conv_id AS STRING) || '.pdf' AS file_name, CAST(turn AS INT) AS page_no,
       CAST({block} AS INT) AS block_no, CAST(0 AS INT) AS line_no, CAST(0 AS INT) AS span_no, {text} AS text,
       CAST(0 AS DOUBLE) AS x0, CAST({bottom - 10} AS DOUBLE) AS y0, CAST(300 AS DOUBLE) AS x1, CAST({bottom} AS DOUBLE) AS y1,
       CAST(1000 AS DOUBLE) AS page_height, CAST({block_type} AS INT) AS block_type
FROM {{conversations}} WHERE conv_id % 10 = 7 AND {where}"""


PAGE_SPANS_SQL = "\nUNION ALL".join(
    [
        _page_span("body", "'Statement number 99'", "turn % 2 = 1"),
        _page_span("first", "'Statement  number'", "turn % 3 = 0"),
        _page_span("second", "'00' || CAST(FLOOR(turn / 3) AS STRING) || ' Page I 0f 3'", "turn % 3 = 0"),
        _page_span("picture", "'Statement number 77'", "turn % 3 = 1"),
        _page_span("blank", "'   '", "turn % 3 = 2"),
    ]
)


def page_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PAGE_SPANS_SQL, conversations=table(spark, sf_dir, "conversations"))


# Transactions: a file is a user, a row is an event.
TRANSACTIONS_SQL = """
SELECT CASE WHEN event_type = 'signup' AND user_id % 50 = 0 THEN NULL
            ELSE 'user_' || CAST(user_id AS STRING) || '.pdf' END AS OriginalFileName,
       event_id AS row_no,
       CASE WHEN event_type IN ('error', 'view') THEN NULL
            ELSE CAST(CAST(ts AS DATE) AS STRING) END AS Date,
       value AS Amount
FROM {events}
"""


@derived
def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TRANSACTIONS_SQL, events=table(spark, sf_dir, "events"))


# Files and their pages: a file is a document, every 37th cannot be read.
INVENTORY_SQL = """
SELECT source AS folder, 'doc_' || CAST(doc_id AS STRING) || '.pdf' AS file_name,
       CASE WHEN doc_id % 37 = 0 THEN 0 ELSE CAST(FLOOR(n_chars / 1000) AS BIGINT) + 1 END AS n_pages
FROM {documents}
"""


@derived
def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(INVENTORY_SQL, documents=table(spark, sf_dir, "documents"))


def inventory_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    readable = inventory(spark, sf_dir).where(F.col("n_pages") > 0)
    page_no = F.explode(F.sequence(F.lit(0), F.col("n_pages").cast("int") - 1)).alias("page_no")
    return readable.select("folder", "file_name", page_no)


def _spans_header() -> tuple[str, str]:
    """Text put before and after a line; the same SQL for both engines."""
    account = "'Account 44-000' || CAST(doc_id % 5 AS STRING) || ' '"
    number = "CAST(10 + doc_id % 3 AS STRING) || ' from 0' || CAST(1 + doc_id % 2 AS STRING) || ' NOV 2023 '"
    before = f"""
      CASE WHEN doc_id % 11 = 5 THEN ''
           WHEN doc_id % 13 = 2 AND line_idx = 0 THEN {account} || 'Statement no.'
           WHEN doc_id % 13 = 2 AND line_idx = 1 THEN {number}
           WHEN doc_id % 13 = 6 AND line_idx = {LINES_PER_PAGE} THEN {number}
           WHEN doc_id % 13 NOT IN (2, 6) AND line_idx = 0 THEN {account} || 'Statement no. ' || {number}
           ELSE '' END"""
    after = f"CASE WHEN doc_id % 13 = 6 AND line_idx = {LINES_PER_PAGE - 1} THEN ' Statement  no. ' ELSE '' END"
    return before, after


_BEFORE, _AFTER = _spans_header()

# Spans: a file is a document, a span is a line, 40 lines make a page.
SPANS_SQL = f"""
SELECT source AS folder, 'doc_' || CAST(doc_id AS STRING) || '.pdf' AS file_name,
       CAST(FLOOR(line_idx / {LINES_PER_PAGE}) AS INT) AS page_no,
       CAST(FLOOR((line_idx % {LINES_PER_PAGE}) / 10) AS INT) AS block_no,
       CAST(line_idx % 10 AS INT) AS line_no,
       CAST(0 AS INT) AS span_no,
       {_BEFORE} || line || {_AFTER} AS text,
       CAST(0 AS DOUBLE) AS x0,
       CAST((line_idx % {LINES_PER_PAGE}) * 12 AS DOUBLE) AS y0,
       CAST(CASE WHEN line_idx % 7 = 3 THEN 8 ELSE 600 END AS DOUBLE) AS x1,
       CAST((line_idx % {LINES_PER_PAGE}) * 12 + 10 AS DOUBLE) AS y1,
       CAST({LINES_PER_PAGE} * 12 AS DOUBLE) AS page_height,
       CAST(CASE WHEN line_idx % 17 = 5 THEN 1 ELSE 0 END AS INT) AS block_type
FROM {{lines}}
"""


@derived
def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    lines = documents.select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("line_idx", "line"))
    return spark.sql(SPANS_SQL, lines=lines)


# Analysis results: a file is a line item, with l_linenumber transactions.
def _amount_sql(digits: str, kind: str) -> str:
    """Amount text in eight spellings, built from the digits of 100 cents or more."""
    plain = f"left({digits}, length({digits}) - 2) || '.' || right({digits}, 2)"
    grouped = (
        f"CASE WHEN length({digits}) > 5 THEN left({digits}, length({digits}) - 5) || ',' "
        f"|| left(right({digits}, 5), 3) || '.' || right({digits}, 2) ELSE {plain} END"
    )
    return (
        f"CASE {kind} WHEN 0 THEN NULL WHEN 1 THEN '$' || {grouped} WHEN 2 THEN '-' || {plain} "
        f"WHEN 3 THEN '-$' || {plain} WHEN 4 THEN {plain} || ' CR' WHEN 5 THEN '' WHEN 6 THEN 'n/a' "
        f"ELSE '(' || {plain} || ')' END"
    )


CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
AMOUNT_DIGITS, AMOUNT_KIND = f"CAST({CENTS} + i * 137 AS STRING)", "CAST((l_partkey + i) % 8 AS INT)"
BALANCE_DIGITS, BALANCE_KIND = f"CAST({CENTS} * i AS STRING)", "CAST((l_suppkey + i) % 8 AS INT)"
AMOUNT_SQL = _amount_sql(AMOUNT_DIGITS, AMOUNT_KIND)
BALANCE_SQL = _amount_sql(BALANCE_DIGITS, BALANCE_KIND)
OPENING_SQL = _amount_sql(f"CAST({CENTS} AS STRING)", "CAST(l_partkey % 8 AS INT)")
CLOSING_1_SQL = _amount_sql(f"CAST({CENTS} + 11 AS STRING)", "4")
CLOSING_2_SQL = _amount_sql(f"CAST({CENTS} + 22 AS STRING)", "3")
FOLDER_SQL = "'flag_' || l_returnflag"
FILE_SQL = (
    "'item_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' "
    "|| CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) || '.pdf'"
)
DATE_SQL = "CASE WHEN i % 3 = 2 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END"
DESCRIPTION_SQL = "'Item ' || CAST(i AS STRING) || ' of part ' || CAST(l_partkey AS STRING)"
REFERENCE_SQL = "CASE WHEN i = 1 THEN NULL ELSE 'ref ' || CAST(i AS STRING) END"
CONFIDENCE_1_SQL = "CAST(50 + l_partkey % 50 AS DOUBLE) / 100"
CONFIDENCE_2_SQL = "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE CAST(5 + l_suppkey % 90 AS DOUBLE) / 10000 END"
FAILED_SQL = "l_orderkey % 41 = 0"

_NO_TEXT, _NO_NUMBER = "CAST(NULL AS STRING)", "CAST(NULL AS DOUBLE)"


def _field(name: str, content: str, value: str = _NO_TEXT, confidence: str = _NO_NUMBER) -> str:
    return f"'{name}', named_struct('content', {content}, 'value', {value}, 'confidence', {confidence})"


def _entry(name: str, value: str) -> str:
    return f"{name}, named_struct('content', {_NO_TEXT}, 'value', {value})"


RESULT_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
    "l_linestatus", "l_shipdate",
]


def _once(value: str) -> str:
    """The same value, computed by lambda evaluation: generated code around it stays small."""
    return f"element_at(transform(array(1), n -> {value}), 1)"


def analysis_results(lineitem: DataFrame, *kept: str, failed: str = FAILED_SQL) -> DataFrame:
    """Nested results for any table with the columns of ``lineitem``; also a stream.

    What all items of a row share is computed once, before them. The documents
    are a plain array of structs, so a reader of only their fields or only their
    transactions doesn't have the other part computed.
    """

    def shared(text: str) -> str:
        return text.replace(CENTS, "_cents")

    # Both names stand more than once below, so that Spark doesn't move their computation into the lambda.
    shown = "CASE WHEN i % 3 = 2 OR _date IS NULL THEN NULL ELSE _date END"
    # A date that is not printed and an amount without text have no key at all.
    entries = ", ".join(
        [
            _entry("CASE WHEN x.date IS NULL THEN 'NoDate' ELSE 'Date' END", "x.date"),
            _entry("'Description'", "'Item ' || x.i || ' of part ' || l_partkey"),
            _entry("CASE WHEN x.kind = 0 THEN 'NoAmount' ELSE 'Amount' END", _amount_sql("x.digits", "x.kind")),
            _entry("'Reference'", "CASE WHEN x.i = 1 THEN NULL ELSE 'ref ' || x.i END"),
            _entry("'Balance'", _amount_sql("x.balance_digits", "x.balance_kind")),
            _entry("'NotConfigured'", "'ignored'"),
        ]
    )
    numbers = (
        f"transform(sequence(1, l_linenumber), i -> named_struct('i', i, 'date', {shown}, "
        f"'digits', {shared(AMOUNT_DIGITS)}, 'kind', {AMOUNT_KIND}, "
        f"'balance_digits', {shared(BALANCE_DIGITS)}, 'balance_kind', {BALANCE_KIND}))"
    )
    items = f"transform({numbers}, x -> map({entries}))"
    first = ", ".join(
        [
            _field("StatementNumber", "'No. ' || CAST(l_orderkey AS STRING)", "'unused'"),
            _field("AccountNumber", "''", "CAST(l_suppkey AS STRING)"),
            _field("Reference", "CASE WHEN l_partkey % 3 = 0 THEN '' END", _NO_TEXT),
            _field("OpeningBalance", shared(OPENING_SQL), _NO_TEXT, CONFIDENCE_1_SQL),
            _field("ClosingBalance", shared(CLOSING_1_SQL), "'0.00'", CONFIDENCE_1_SQL),
            _field("Label", "' two  words '", _NO_TEXT, CONFIDENCE_1_SQL),
        ]
    )
    second = ", ".join(
        [
            _field("StatementNumber", "'second'"),
            _field("AccountName", "'Supplier ' || CAST(l_suppkey AS STRING)"),
            _field("Reference", "'late'"),
            _field("ClosingBalance", _NO_TEXT, shared(CLOSING_2_SQL), CONFIDENCE_2_SQL),
            _field("Label", "'end '", _NO_TEXT, CONFIDENCE_2_SQL),
            _field("' || CASE WHEN l_partkey % 5 = 0 THEN 'Rate' ELSE 'NoRate' END || '", "'4.5%'", _NO_TEXT, CONFIDENCE_2_SQL),
        ]
    )
    later = "CASE WHEN l_linenumber > 3 THEN slice(_items, 4, 4) END"
    documents = (
        f"CASE WHEN {failed} THEN NULL ELSE array("
        f"named_struct('fields', {_once(f'map({first})')}, 'transactions', slice(_items, 1, 3)), "
        f"named_struct('fields', {_once(f'map({second})')}, 'transactions', {later})) END"
    )
    dated = lineitem.withColumns({"_cents": F.expr(CENTS), "_date": F.expr("CAST(CAST(l_shipdate AS DATE) AS STRING)")})
    return dated.withColumn("_items", F.expr(items)).select(
        F.expr(FOLDER_SQL).alias("folder"),
        F.expr(FILE_SQL).alias("file_name"),
        F.expr(documents).alias("documents"),
        "l_returnflag",
        *kept,
    )


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*RESULT_COLUMNS)


@derived
def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis_results(line_items(spark, sf_dir)).drop("l_returnflag")


def typed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of four statement types, of a type that isn't listed, and of none."""
    items = line_items(spark, sf_dir)
    typed = items.select("*", F.expr(TYPE_SQL).alias("statement_type"))
    return analysis_results(typed, "statement_type").drop("l_returnflag")


#: Failed analyses that come back in good order, and results that are delivered a second time though they were good.
RETURNED_SQL, REPEATED_SQL = "l_orderkey % 82 = 41", "l_orderkey % 10 = 3"


def deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two batches of results, each file in an object of its own name; the second has returned, repeated and still failing files."""
    items = line_items(spark, sf_dir)
    second = items.where(f"({FAILED_SQL}) OR ({REPEATED_SQL})")
    batches = []
    for rows, failed, day in ((items, FAILED_SQL, "2024-01-01"), (second, f"({FAILED_SQL}) AND NOT ({RETURNED_SQL})", "2024-01-02")):
        results = analysis_results(rows, failed=failed).drop("l_returnflag")
        batches.append(results.withColumns({"source": F.concat("folder", F.lit("/"), "file_name"), "version": F.lit(day).cast("timestamp")}))
    return batches


# Layout: text lines of documents, cells of line items.
@derived
def text_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results that hold the lines of every document, 40 to a page."""
    documents = table(spark, sf_dir, "documents").withColumn("_lines", F.split("text", "\n"))
    last_page = f"(size(_lines) - 1) div {LINES_PER_PAGE}"
    pages_of = (
        f"transform(sequence(0, CAST({last_page} AS INT)), p -> named_struct('page_no', p, 'lines', "
        f"transform(slice(_lines, p * {LINES_PER_PAGE} + 1, {LINES_PER_PAGE}), l -> named_struct('content', l))))"
    )
    return documents.select(
        F.col("source").alias("folder"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("file_name"),
        F.expr(f"CASE WHEN doc_id % 37 = 0 THEN NULL ELSE {pages_of} END").alias("pages"),
    )


@derived
def table_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results with a table of up to three columns per line item, cells unsorted."""
    lineitem = line_items(spark, sf_dir)
    last = "named_struct('row_index', r, 'column_index', 2, 'content', l_returnflag)"
    first = "named_struct('row_index', r, 'column_index', 0, 'content', CAST(l_partkey + r AS STRING))"
    cells = (
        "flatten(transform(sequence(l_linenumber - 1, 0, -1), r -> CASE WHEN (l_partkey + r) % 5 <> 0 THEN "
        f"array({last}, {first}, named_struct('row_index', r, 'column_index', 1, 'content', CAST(CAST(l_quantity AS INT) AS STRING))) "
        f"ELSE array({last}, {first}) END))"
    )
    single = "array(named_struct('row_index', 3, 'column_index', 7, 'content', l_linestatus))"
    none = "slice(array(named_struct('row_index', 0, 'column_index', 0, 'content', l_linestatus)), 1, 0)"
    return lineitem.select(
        F.expr(FOLDER_SQL).alias("folder"),
        F.expr(FILE_SQL).alias("file_name"),
        F.expr(
            f"array(named_struct('cells', {cells}), named_struct('cells', {none}), named_struct('cells', {single}))"
        ).alias("tables"),
    )
