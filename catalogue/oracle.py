"""The SQL each query is checked against, in DuckDB's dialect.

Plain windows and joins per file: these state what a result is, not how to get
it at scale.
"""

from __future__ import annotations

from catalogue import fixtures as fx

PAGES = fx.PAGES_SQL.format(conversations="conversations")
TRANSACTIONS = fx.TRANSACTIONS_SQL.format(events="events")
INVENTORY = fx.INVENTORY_SQL.format(documents="documents")
_LINES = """(SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_idx FROM documents) lines"""
SPANS = fx.SPANS_SQL.format(lines=_LINES)
ITEMS = "(SELECT *, CAST(unnest(generate_series(1, l_linenumber)) AS BIGINT) AS i FROM lineitem) items"
GOOD = f"NOT ({fx.FAILED_SQL})"

_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def strip(text: str) -> str:
    return f"trim({text}, {_SPACES})"


def collapse(text: str) -> str:
    return rf"regexp_replace({text}, '\s+', ' ', 'g')"


def normalise(text: str) -> str:
    return rf"regexp_replace(replace({collapse(text)}, ' 0f ', ' of '), '(?i)(page)\s*[|I]\b', '\1 1', 'g')"


def amount(text: str) -> str:
    number = rf"TRY_CAST(replace(regexp_extract({text}, '[-+]?[\d,]*\.?\d+'), ',', '') AS DOUBLE)"
    return f"CASE WHEN {text} LIKE '%-%' THEN -({number}) ELSE {number} END"


def amount_ok(text: str) -> str:
    return rf"coalesce({text} = '' OR regexp_matches({text}, '\d'), TRUE)"


def resolved(pages: str) -> str:
    """CTEs from a page table to the text that is searched."""
    return f"""
p AS ({pages}),
readable AS (SELECT folder, file_name, length({strip('text')}) > 20 AS machine_readable FROM p WHERE page_no = 0),
resolved AS (
  SELECT p.*, machine_readable,
         CASE WHEN NOT machine_readable OR {strip('text')} = '' THEN ocr_text ELSE {strip('text')} END AS page_text,
         coalesce(nullif({strip('footer_text')}, ''), {strip('footer_ocr_text')}, '') AS footer,
         coalesce({strip('footer_ocr_text')}, '') AS footer_ocr
  FROM p JOIN readable USING (folder, file_name))"""


RESOLVED = resolved(PAGES)


def matched(pattern: str | None, phrase: str | None = None, continues: str | None = None, pages: str = PAGES) -> str:
    """CTEs from pages to ``events(folder, file_name, page_no, start_id, closes)``."""
    tests, grouped = [], "NULL"
    if pattern:
        texts = {"page": "page_text", "footer": "footer", "footer_ocr": "footer_ocr"}
        tests = [(name, normalise(text)) for name, text in texts.items()]
        if "(" in pattern:
            cases = " ".join(f"WHEN '{n}' THEN regexp_extract({t}, '(?i){pattern}', 1)" for n, t in tests)
            grouped = f"CASE source {cases} END"
    whens = " ".join(f"WHEN regexp_matches({t}, '(?i){pattern}') THEN '{n}'" for n, t in tests)
    source = f"CASE {whens} END" if whens else "CAST(NULL AS VARCHAR)"
    has_phrase = f"contains(page_text, '{phrase}')" if phrase else "FALSE"
    has_end = f"NOT contains(page_text, '{continues}')" if continues else "FALSE"
    return f"""{resolved(pages)},
sourced AS (SELECT *, {source} AS source FROM resolved),
numbered AS (SELECT *, {grouped} AS g1 FROM sourced),
marked AS (
  SELECT *, source IS NOT NULL AS matched,
         source IS NULL AND coalesce({has_phrase}, FALSE) AS phrase_matched,
         CASE WHEN source IS NULL THEN NULL
              WHEN regexp_matches(g1, '^[0-9]+$') THEN CAST(CAST(g1 AS BIGINT) AS VARCHAR)
              ELSE CAST(page_no AS VARCHAR) END AS match_id
  FROM numbered),
events AS (
  SELECT folder, file_name, page_no,
         CASE WHEN phrase_matched THEN CAST(page_no AS VARCHAR) ELSE match_id END AS start_id,
         source IS NULL AND coalesce({has_end}, TRUE) AS closes
  FROM marked)"""


BY_PAGE = matched(fx.PAGE_RULE.start_pattern)
BY_RANGE = matched(fx.RANGE_RULE.start_pattern, fx.RANGE_RULE.start_phrase, fx.RANGE_RULE.must_not_contain)
BY_PHRASE = matched(None, fx.PHRASE_RULE.start_phrase)
_RANGE = (fx.RANGE_RULE.start_pattern, fx.RANGE_RULE.start_phrase, fx.RANGE_RULE.must_not_contain)


def footers(spans: str) -> str:
    return f"""
        SELECT * FROM (
          SELECT folder, file_name, page_no,
                 nullif({strip("string_agg(text, ' ' ORDER BY block_no, line_no, span_no)")}, '') AS footer_text
          FROM ({spans}) WHERE block_type = 0 AND y1 > page_height - greatest(80, floor(page_height * 0.1))
          GROUP BY folder, file_name, page_no) WHERE footer_text IS NOT NULL"""


MIXED_PAGES = fx.MIXED_PAGES_SQL.format(conversations="conversations")
BATCH = fx.BATCH_SQL.format(conversations="conversations")
#: Files with a page that has no number aren't split.
MIXED = f"mixed AS ({MIXED_PAGES}), unnumbered AS (SELECT DISTINCT folder, file_name FROM mixed WHERE page_no IS NULL)"
BY_RANGE_MIXED = MIXED + "," + matched(*_RANGE, pages="SELECT * FROM mixed ANTI JOIN unnumbered USING (folder, file_name)")
BY_RANGE_FOOTERS = matched(
    *_RANGE,
    pages=f"""SELECT t.* REPLACE (coalesce(f.footer_text, t.footer_text) AS footer_text) FROM ({PAGES}) t
              LEFT JOIN ({footers(fx.PAGE_SPANS_SQL.format(conversations="conversations"))}) f USING (folder, file_name, page_no)""",
)

# Every start opens a document that ends before the next start.
STARTS = """
ends AS (SELECT folder, file_name, max(page_no) AS last_page FROM events GROUP BY ALL),
statements AS (
  SELECT folder, file_name, row_number() OVER w AS ordinal, page_no AS start_page,
         CAST(coalesce(lead(page_no) OVER w - 1, last_page) AS INTEGER) AS end_page
  FROM events JOIN ends USING (folder, file_name) WHERE start_id IS NOT NULL
  WINDOW w AS (PARTITION BY folder, file_name ORDER BY page_no))"""

# Event pages, the closing pages between them, and the next of either kind.
RUNS = """
flagged AS (
  SELECT *, start_id IS NOT NULL AS ev,
         max(CASE WHEN start_id IS NOT NULL THEN page_no END) OVER prev AS last_ev,
         max(CASE WHEN closes THEN page_no END) OVER prev AS last_close,
         last_value(start_id IGNORE NULLS) OVER prev AS last_id,
         max(page_no) OVER (PARTITION BY folder, file_name) AS last_page
  FROM events
  WINDOW prev AS (PARTITION BY folder, file_name ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
opened AS (
  SELECT *, ev AND start_id IS DISTINCT FROM
         CASE WHEN last_close IS NULL OR last_close < last_ev THEN last_id END AS opens
  FROM flagged),
bounded AS (
  SELECT *, min(CASE WHEN opens THEN page_no END) OVER nxt AS next_open,
         min(CASE WHEN closes THEN page_no END) OVER here AS next_close
  FROM opened
  WINDOW nxt AS (PARTITION BY folder, file_name ORDER BY page_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),
         here AS (PARTITION BY folder, file_name ORDER BY page_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
runs AS (
  SELECT folder, file_name, start_id AS statement_id, page_no AS start_page,
         CAST(least(coalesce(next_open - 1, last_page), coalesce(next_close, last_page)) AS INTEGER) AS end_page,
         row_number() OVER (PARTITION BY folder, file_name, start_id ORDER BY page_no DESC) AS recency
  FROM bounded WHERE opens),
statements AS (SELECT * EXCLUDE (recency) FROM runs WHERE recency = 1)"""

STEM = "regexp_replace(file_name, '[.]pdf$', '')"

DETAIL = f"SELECT folder, file_name, n_pages AS total_pages FROM ({INVENTORY})"
FOLDER_TOTALS = """
SELECT CASE WHEN grouping(folder) = 1 THEN 'Total' ELSE folder END AS folder,
       CAST(sum(files) AS BIGINT) AS number_of_documents, CAST(sum(pages) AS BIGINT) AS total_pages
FROM (SELECT folder, 1 AS files, total_pages AS pages FROM ({detail}) {extra}) GROUP BY ROLLUP (folder)"""

STATIC = {
    "StatementNumber": "'No. ' || CAST(l_orderkey AS VARCHAR)",
    "AccountName": "'Supplier ' || CAST(l_suppkey AS VARCHAR)",
    "AccountNumber": "CAST(l_suppkey AS VARCHAR)",
    "Reference": "''",
    "Missing": "''",
}
_OK = f"({amount_ok('amount_text')}) AND ({amount_ok('balance_text')})"
ROWS = f"""
SELECT {fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS "OriginalFileName", i - 1 AS row_no,
       {fx.DATE_SQL} AS "Date", {fx.DESCRIPTION_SQL} AS "Description", {fx.REFERENCE_SQL} AS "Reference",
       {fx.AMOUNT_SQL} AS amount_text, {fx.BALANCE_SQL} AS balance_text,
       {STATIC['StatementNumber']} AS "StatementNumber", {STATIC['AccountName']} AS "AccountName",
       {STATIC['AccountNumber']} AS "AccountNumber", '' AS "Missing", l_returnflag
FROM {ITEMS} WHERE {GOOD}"""
_MONEY = f"""{amount('amount_text')} AS "Amount", {amount('balance_text')} AS "Balance", {_OK} AS "ConversionSuccess" """

_CLOSING = f"({fx.CLOSING_1_SQL}) || ' ' || ({fx.CLOSING_2_SQL})"
_CONF_1 = f"CAST({fx.CONFIDENCE_1_SQL} AS VARCHAR)"
_CONF_2 = f"coalesce(CAST({fx.CONFIDENCE_2_SQL} AS VARCHAR), 'N/A')"
_OPENING = f"coalesce({fx.OPENING_SQL}, '')"
_RATE = "CASE WHEN l_partkey % 5 = 0 THEN '4.5%' ELSE '' END"
_RATE_CONF = f"CASE WHEN l_partkey % 5 = 0 THEN {_CONF_2} ELSE '' END"
SUMMARY_LONG = f"""
SELECT folder, "DocumentName", field_name, is_amount, text, CASE WHEN is_amount THEN {amount('text')} END AS amount,
       confidence
FROM (
  SELECT {fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS "DocumentName",
         unnest(['OpeningBalance', 'ClosingBalance', 'Label', 'Rate', 'DocumentName']) AS field_name,
         unnest([TRUE, TRUE, FALSE, TRUE, FALSE]) AS is_amount,
         unnest([{_OPENING}, {_CLOSING}, 'two  words  end', {_RATE}, '']) AS text,
         unnest([{_CONF_1}, {_CONF_1} || ' ' || {_CONF_2}, {_CONF_1} || ' ' || {_CONF_2}, {_RATE_CONF}, '']) AS confidence
  FROM lineitem WHERE {GOOD})"""


def found_value(pattern: str, fraction: float, name: str) -> str:
    """CTE ``name(folder, file_name, value)`` of files with a match in the region."""
    inside = f"block_type = 0 AND x1 - x0 > y1 - y0 AND y1 < page_height * {fraction}"
    return rf"""{name} AS (
  SELECT folder, file_name, nullif({strip(f"regexp_extract(whole, '{pattern}')")}, '') AS value FROM (
    SELECT folder, file_name,
           {collapse("string_agg(text || ' ', '' ORDER BY page_no, block_no, line_no, span_no)")} AS whole
    FROM spans WHERE {inside} GROUP BY folder, file_name))"""


ACCOUNT = r"(?i)\d{2}\-\d{4}"
NUMBER = r"(?i)[A-Za-z]{9}\s+[A-Za-z]{2}\.\s+\d{2}"
DATE = r"(?i)\d{2}\s+[A-Za-z]{3}\s+\d{4}"
FILES = f"spans AS MATERIALIZED ({SPANS}), files AS (SELECT DISTINCT folder, file_name FROM spans)"


def values_of(pattern: str, fraction: float) -> str:
    return f"""WITH {FILES}, {found_value(pattern, fraction, 'found')}
SELECT folder, file_name, value FROM files LEFT JOIN found USING (folder, file_name)"""


_DAY = "strftime(try_strptime(value, '%d %b %Y'), '%Y%m%d')"
_CATEGORY = "'AccountNumber-' || value"
CATEGORISED = f"""
SELECT folder, file_name, 'categorise_by_value' AS task,
       CASE WHEN value IS NULL THEN 'none' ELSE 'move' END AS action,
       CASE WHEN value IS NULL THEN folder ELSE folder || '/' || {_CATEGORY} END AS target_folder,
       CASE WHEN value IS NULL THEN file_name ELSE {_CATEGORY} || '-' || file_name END AS target_name,
       value AS detail
FROM ({values_of(ACCOUNT, 0.5)})"""
PREFIXED = f"""
SELECT folder, file_name, 'add_date_prefix_to_filenames' AS task,
       CASE WHEN value IS NULL THEN 'none' WHEN {_DAY} IS NULL THEN 'error' ELSE 'rename' END AS action,
       folder AS target_folder,
       CASE WHEN {_DAY} IS NULL THEN file_name ELSE {_DAY} || '-' || file_name END AS target_name,
       value AS detail
FROM ({values_of(DATE, 1.0)})"""
DUPLICATES = f"""
WITH {FILES}, {found_value(ACCOUNT, 0.5, 'a')}, {found_value(NUMBER, 1.0, 'n')}, {found_value(DATE, 1.0, 'd')},
identified AS (
  SELECT folder, file_name,
         nullif(concat(a.value, regexp_replace(n.value, '[^0-9]', '', 'g'), d.value), '') AS identifier
  FROM files LEFT JOIN a USING (folder, file_name) LEFT JOIN n USING (folder, file_name)
       LEFT JOIN d USING (folder, file_name)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY folder, identifier ORDER BY file_name) AS seen FROM identified)
SELECT folder, file_name, 'identify_and_move_duplicates' AS task,
       CASE WHEN identifier IS NOT NULL AND seen > 1 THEN 'move' ELSE 'none' END AS action,
       CASE WHEN identifier IS NOT NULL AND seen > 1 THEN folder || '/duplicate' ELSE folder END AS target_folder,
       file_name AS target_name, identifier AS detail
FROM ranked"""

_FILL = 'last_value("Date" IGNORE NULLS) OVER (PARTITION BY "OriginalFileName" ORDER BY row_no)'
FILLED = f"""
SELECT "OriginalFileName", row_no, "Date",
       CASE WHEN "OriginalFileName" IS NOT NULL THEN {_FILL} END AS "Date_Processed", "Amount"
FROM ({TRANSACTIONS})"""

TYPE = fx.TYPE_SQL.replace("element_at(array(", "list_extract(list_value(")
TYPED_ROWS = ROWS.replace("AS \"Missing\", l_returnflag", f"AS \"Missing\", {TYPE} AS kind")

_TYPE_ROWS = ", ".join(
    "("
    + ", ".join("NULL" if v is None else f"'{v}'" for v in (n, t.name, t.split_type, t.start_pattern, t.start_phrase, t.must_not_contain))
    + ")"
    for n, t in enumerate(fx.SPLIT_TYPES)
)

ORACLE_PHRASE = f"WITH {BY_PHRASE} SELECT {STEM} AS stem FROM (SELECT folder, file_name FROM events GROUP BY ALL HAVING count(start_id) = 0)"
ORACLE_PAGE = f"WITH {BY_PAGE} SELECT {STEM} AS stem FROM (SELECT folder, file_name FROM events GROUP BY ALL HAVING count(start_id) = 0)"

# Every cell of the nested results that has a name of its own.
_FIELDS = [
    (0, "StatementNumber", "'No. ' || CAST(l_orderkey AS VARCHAR)", "'unused'", "NULL"),
    (0, "AccountNumber", "''", "CAST(l_suppkey AS VARCHAR)", "NULL"),
    (0, "Reference", "CASE WHEN l_partkey % 3 = 0 THEN '' END", "NULL", "NULL"),
    (0, "OpeningBalance", fx.OPENING_SQL, "NULL", fx.CONFIDENCE_1_SQL),
    (0, "ClosingBalance", fx.CLOSING_1_SQL, "'0.00'", fx.CONFIDENCE_1_SQL),
    (0, "Label", "' two  words '", "NULL", fx.CONFIDENCE_1_SQL),
    (1, "StatementNumber", "'second'", "NULL", "NULL"),
    (1, "AccountName", "'Supplier ' || CAST(l_suppkey AS VARCHAR)", "NULL", "NULL"),
    (1, "Reference", "'late'", "NULL", "NULL"),
    (1, "ClosingBalance", "NULL", fx.CLOSING_2_SQL, fx.CONFIDENCE_2_SQL),
    (1, "Label", "'end '", "NULL", fx.CONFIDENCE_2_SQL),
]
_CELLS = [
    ("Date", fx.DATE_SQL, f"{fx.DATE_SQL} IS NOT NULL"),
    ("Description", fx.DESCRIPTION_SQL, "TRUE"),
    ("Amount", fx.AMOUNT_SQL, f"{fx.AMOUNT_KIND} <> 0"),
    ("Reference", fx.REFERENCE_SQL, "TRUE"),
    ("Balance", fx.BALANCE_SQL, "TRUE"),
    ("NotConfigured", "'ignored'", "TRUE"),
]
_FILE = f"{fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS file_name"
_FIELD_ROWS = [
    f"SELECT rid, {_FILE}, {n} AS document, '{name}' AS name, {content} AS content, {value} AS value, CAST({confidence} AS VARCHAR) AS confidence FROM numbered WHERE {GOOD}"
    for n, name, content, value, confidence in _FIELDS
] + [f"SELECT rid, {_FILE}, 1, 'Rate', '4.5%', NULL, CAST({fx.CONFIDENCE_2_SQL} AS VARCHAR) FROM numbered WHERE {GOOD} AND l_partkey % 5 = 0"]
_CELL_ROWS = [f"SELECT rid, {_FILE}, i, '{name}' AS name, {value} AS value FROM {ITEMS.replace('FROM lineitem', 'FROM numbered')} WHERE {GOOD} AND {there}" for name, value, there in _CELLS]
_SHOWN = "name || '=' || coalesce(content, '~') || '|' || coalesce(value, '~') || '|' || coalesce(confidence, '~')"
DOCUMENTS = f"""
WITH numbered AS MATERIALIZED (SELECT *, row_number() OVER () AS rid FROM lineitem),
fields AS (
  SELECT rid, folder, file_name, document, string_agg({_SHOWN}, ';' ORDER BY {_SHOWN}) AS fields FROM ({" UNION ALL ".join(_FIELD_ROWS)}) GROUP BY 1, 2, 3, 4),
lines AS (
  SELECT rid, folder, file_name, i, string_agg(name || '=~|' || coalesce(value, '~'), ';' ORDER BY name || '=~|' || coalesce(value, '~')) AS line
  FROM ({" UNION ALL ".join(_CELL_ROWS)}) GROUP BY 1, 2, 3, 4),
items AS (
  SELECT rid, folder, file_name, CASE WHEN i > 3 THEN 1 ELSE 0 END AS document, string_agg(line, chr(10) ORDER BY i) AS items FROM lines GROUP BY 1, 2, 3, 4)
SELECT folder, file_name, CAST(document AS INTEGER) AS document, fields, items FROM fields LEFT JOIN items USING (rid, folder, file_name, document)
UNION ALL SELECT {_FILE}, NULL, NULL, NULL FROM lineitem WHERE {fx.FAILED_SQL}"""

ORACLE: dict[str, str] = {
    "analysis_documents": DOCUMENTS,
    "page_table": PAGES,
    "analysis_round_trip": f"""
        SELECT {fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS file_name, {fx.FAILED_SQL} AS failed,
               CASE WHEN {GOOD} THEN 'Item 1 of part ' || CAST(l_partkey AS VARCHAR) END AS first_item
        FROM lineitem""",
    "json_objects_parsed": """
        SELECT event_id, event_id % 9 NOT IN (4, 5) AS ok,
               CASE WHEN event_id % 9 NOT IN (4, 5) THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
        FROM events""",
    "json_object_failures": "SELECT event_id % 9 NOT IN (4, 5) AS ok, count(*) AS objects FROM events GROUP BY 1",
    "statement_types_joined": f"""
        SELECT type_name, split_type, start_pattern, start_phrase, must_not_contain,
               count(*) AS pages, count(CASE WHEN turn = 0 THEN 1 END) AS files
        FROM conversations JOIN (VALUES {_TYPE_ROWS})
             AS t(n, type_name, split_type, start_pattern, start_phrase, must_not_contain) ON conv_id % 4 = n
        GROUP BY ALL""",
    "tables_read_back": """
        SELECT event_id, CASE WHEN event_id % 7 NOT IN (1, 2, 3) THEN event_type END AS cell FROM events""",
    "currency_display": f"""
        SELECT "OriginalFileName", row_no,
               CASE WHEN "Amount" < 0 THEN '-' ELSE '' END || '$' || format('{{:,.2f}}', abs("Amount")) AS "Amount",
               CASE WHEN "Balance" < 0 THEN '-' ELSE '' END || '$' || format('{{:,.2f}}', abs("Balance")) AS "Balance"
        FROM (SELECT "OriginalFileName", row_no, {_MONEY} FROM ({ROWS}))""",
    "counts_of_run": f"SELECT *, 'run 1' AS run_id FROM ({FOLDER_TOTALS.format(detail=DETAIL, extra='')})",
    "json_objects": f"""
        SELECT '{{"folder":"' || folder || '","file_name":"' || file_name || '","page_no":' || page_no || '}}' AS value
        FROM ({PAGES})""",
    "processed_dates_display": "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS order_date FROM orders",
    "unsplit_manifest": f"""
        WITH {BY_PHRASE}
        SELECT {STEM} AS stem FROM (
          SELECT folder, file_name FROM events GROUP BY ALL HAVING count(start_id) = 0)""",
    "flag_machine_readable": f"WITH {RESOLVED} SELECT folder, file_name, page_no, machine_readable FROM resolved",
    "resolve_page_text": f"WITH {RESOLVED} SELECT folder, file_name, page_no, page_text FROM resolved",
    "normalise_text": f"""
        SELECT folder, file_name, page_no, {normalise('text')} AS text, {normalise('footer_text')} AS footer_text
        FROM ({PAGES})""",
    "footer_text": footers(SPANS),
    "page_matches": f"""
        WITH {BY_RANGE}
        SELECT folder, file_name, page_no, machine_readable, matched, source, match_id AS number, phrase_matched, closes
        FROM marked JOIN events USING (folder, file_name, page_no)""",
    "split_with_footers": f"""
        WITH {BY_RANGE_FOOTERS}, {RUNS}
        SELECT folder, file_name, page_no, statement_id,
               {STEM} || '_statement_' || statement_id || '.pdf' AS document_name
        FROM events JOIN statements USING (folder, file_name) WHERE page_no BETWEEN start_page AND end_page""",
    "split_unnumbered_pages": f"""
        WITH {BY_RANGE_MIXED}, {RUNS}
        SELECT folder, file_name, page_no, {STEM} || '_statement_' || statement_id || '.pdf' AS document_name
        FROM events JOIN statements USING (folder, file_name) WHERE page_no BETWEEN start_page AND end_page
        UNION ALL SELECT folder, file_name, NULL, NULL FROM (SELECT folder, file_name FROM events GROUP BY 1, 2 HAVING count(start_id) = 0)
        UNION ALL SELECT folder, file_name, NULL, NULL FROM unnumbered""",
    "preprocess_run": f"""
        WITH {BY_RANGE_MIXED}, {RUNS},
        docs AS (SELECT folder, file_name, count(*) AS documents, CAST(sum(end_page - start_page + 1) AS BIGINT) AS assigned_pages
                 FROM statements GROUP BY 1, 2),
        seen AS (SELECT folder, file_name, count(*) AS pages, count(page_no) AS numbered FROM mixed GROUP BY 1, 2)
        SELECT folder, file_name, CASE WHEN documents IS NULL THEN 'manual' ELSE 'split' END AS result,
               CASE WHEN documents IS NOT NULL THEN NULL WHEN pages IS NULL THEN 'no pages'
                    WHEN numbered < pages THEN 'pages without a number' ELSE 'no start found' END AS reason,
               coalesce(documents, 0) AS documents, coalesce(pages, 0) AS pages, coalesce(assigned_pages, 0) AS assigned_pages
        FROM ({BATCH}) batch LEFT JOIN seen USING (folder, file_name) LEFT JOIN docs USING (folder, file_name)""",
    "match_start": f"WITH {BY_RANGE} SELECT folder, file_name, page_no, matched, source, match_id AS start_id FROM marked",
    "match_start_without_group": f"""
        WITH {BY_PAGE} SELECT folder, file_name, page_no, matched, source, match_id AS start_id FROM marked""",
    "match_phrase": f"WITH {BY_RANGE} SELECT folder, file_name, page_no, phrase_matched FROM marked",
    "split_page_start": f"""
        WITH {BY_PAGE}, {STARTS}
        SELECT folder, file_name, CAST(ordinal AS VARCHAR) AS statement_id, ordinal, start_page, end_page FROM statements""",
    "split_start_end": f"WITH {BY_RANGE}, {RUNS} SELECT * FROM statements",
    "superseded_ranges": f"WITH {BY_RANGE}, {RUNS} SELECT * EXCLUDE (recency) FROM runs WHERE recency > 1",
    "assign_pages": f"""
        WITH {BY_RANGE}, {RUNS}
        SELECT folder, file_name, page_no, statement_id, start_page, end_page,
               {STEM} || '_statement_' || statement_id || '.pdf' AS document_name
        FROM events JOIN statements USING (folder, file_name) WHERE page_no BETWEEN start_page AND end_page""",
    "route_manual": f"""
        WITH {BY_PHRASE}
        SELECT folder, file_name, {STEM} AS stem FROM events GROUP BY ALL HAVING count(start_id) = 0""".replace(
        "GROUP BY ALL HAVING count(start_id) = 0", "GROUP BY folder, file_name HAVING count(start_id) = 0"
    ),
    "split_documents": f"""
        WITH {BY_PAGE}, {STARTS}
        SELECT folder, file_name, page_no,
               {STEM} || '_document_' || CAST(ordinal AS VARCHAR) || '.pdf' AS document_name
        FROM events JOIN statements USING (folder, file_name) WHERE page_no BETWEEN start_page AND end_page
        UNION ALL
        SELECT folder, file_name, NULL, NULL FROM events GROUP BY folder, file_name HAVING count(start_id) = 0""",
    "split_documents_by_range": f"""
        WITH {BY_RANGE}, {RUNS}
        SELECT folder, file_name, page_no, statement_id,
               {STEM} || '_statement_' || statement_id || '.pdf' AS document_name
        FROM events JOIN statements USING (folder, file_name) WHERE page_no BETWEEN start_page AND end_page""",
    "split_documents_by_phrase": f"""
        WITH {BY_PHRASE}, {STARTS}
        SELECT folder, file_name, CAST(ordinal AS VARCHAR) AS statement_id, ordinal, start_page, end_page,
               {STEM} || '_document_' || CAST(ordinal AS VARCHAR) || '.pdf' AS document_name
        FROM statements""",
    "split_documents_unknown_type": f"SELECT DISTINCT folder, file_name, {STEM} AS stem FROM ({PAGES})",
    "pages_per_document": DETAIL,
    "folder_summary": FOLDER_TOTALS.format(
        detail=DETAIL, extra="UNION ALL SELECT 'empty_' || lower(r_name), 0, 0 FROM region"
    ),
    "reconcile": f"""
        WITH {BY_PAGE}, {STARTS},
        pre AS (SELECT count(DISTINCT (folder, file_name)) AS pre_files, count(*) AS pre_pages FROM events),
        post AS (SELECT count(*) AS post_files, CAST(coalesce(sum(end_page - start_page + 1), 0) AS BIGINT) AS post_pages
                 FROM statements)
        SELECT *, post_files - pre_files AS file_diff, post_pages - pre_pages AS page_diff FROM pre, post""",
    "static_fields": f"""
        SELECT {fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS "OriginalFileName",
               {STATIC['StatementNumber']} AS "StatementNumber", {STATIC['AccountName']} AS "AccountName",
               {STATIC['AccountNumber']} AS "AccountNumber", '' AS "Reference", '' AS "Missing"
        FROM lineitem WHERE {GOOD}""",
    "transactions": f"""
        SELECT folder, "OriginalFileName", row_no, "Date", "Description", "Reference", {_MONEY} FROM ({ROWS})""",
    "convert_amount": f"""
        SELECT file_name, i, {amount('amount_text')} AS value,
               CASE WHEN amount_text LIKE '%-%' THEN -1 ELSE 1 END * abs({amount('amount_text')}) AS corrected_value,
               {amount_ok('amount_text')} AS ok
        FROM (SELECT {fx.FILE_SQL} AS file_name, i, {fx.AMOUNT_SQL} AS amount_text FROM {ITEMS})""",
    "conversion_success": f"""
        SELECT folder, "ConversionSuccess", count(*) AS rows FROM (SELECT folder, {_MONEY} FROM ({ROWS})) GROUP BY ALL""",
    "attach_static": f"""
        SELECT folder, row_no, "OriginalFileName", "AccountName", "Description", {amount('balance_text')} AS "Balance",
               {amount_ok('balance_text')} AS "ConversionSuccess"
        FROM ({ROWS})""",
    "summary_fields": SUMMARY_LONG,
    "flatten_summary": f"""
        SELECT {fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS "DocumentName",
               max({amount(f'({_CLOSING})')}) AS "ClosingBalance_Value", max({_CLOSING}) AS "ClosingBalance_Text",
               max({_CONF_1} || ' ' || {_CONF_2}) AS "ClosingBalance_Confidence"
        FROM lineitem WHERE {GOOD} GROUP BY 1, 2""",
    "coerce_amounts": """
        SELECT event_id, CASE event_id % 6 WHEN 1 THEN CAST(event_id AS DOUBLE)
               WHEN 3 THEN CAST('-.' || CAST(event_id AS VARCHAR) AS DOUBLE)
               WHEN 5 THEN CAST(event_id * 100 AS DOUBLE) END AS "Amount"
        FROM events""",
    "raw_text": """
        SELECT source AS folder, 'doc_' || CAST(doc_id AS VARCHAR) || '.pdf' AS document_name, text AS extracted_text
        FROM documents WHERE doc_id % 37 <> 0""",
    "table_rows": f"""
        SELECT {fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS file_name, CAST(0 AS INTEGER) AS table_idx,
               CAST(i - 1 AS INTEGER) AS row_index,
               CAST(l_partkey + i - 1 AS VARCHAR)
               || CASE WHEN (l_partkey + i - 1) % 5 <> 0 THEN '|' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) ELSE '' END
               || '|' || l_returnflag AS contents
        FROM {ITEMS}
        UNION ALL
        SELECT {fx.FOLDER_SQL}, {fx.FILE_SQL}, 2, 3, l_linestatus FROM lineitem""",
    "union_runs": f"""
        SELECT folder, "OriginalFileName", row_no, "AccountName",
               CASE WHEN l_returnflag <> 'R' THEN "AccountNumber" END AS "AccountNumber",
               CASE WHEN l_returnflag <> 'R' THEN {amount('amount_text')} END AS "Amount",
               {amount('balance_text')} AS "Balance"
        FROM ({ROWS})""",
    "mixed_transactions": f"""
        SELECT folder, row_no, "OriginalFileName",
               CASE WHEN kind = 'card' THEN "StatementNumber" END AS "StatementNumber",
               CASE WHEN kind IN ('card', 'listing') THEN "AccountName" END AS "AccountName",
               CASE WHEN kind = 'card' THEN "AccountNumber" WHEN kind = 'notes' THEN CAST(CAST("AccountNumber" AS DOUBLE) AS VARCHAR) END AS "AccountNumber",
               CASE WHEN kind = 'card' THEN "Reference" WHEN kind = 'notes' THEN '' END AS "Reference",
               CASE WHEN kind = 'card' THEN '' END AS "Missing",
               CASE WHEN kind IN ('card', 'notes') THEN "Date" END AS "Date",
               CASE WHEN kind <> 'bare' THEN "Description" END AS "Description",
               CASE WHEN kind IN ('card', 'bare') THEN {amount('amount_text')} END AS "Amount",
               CASE WHEN kind IN ('card', 'listing') THEN {amount('balance_text')} END AS "Balance",
               CASE kind WHEN 'card' THEN {_OK} WHEN 'listing' THEN {amount_ok('balance_text')} WHEN 'bare' THEN {amount_ok('amount_text')} ELSE TRUE END AS "ConversionSuccess"
        FROM ({TYPED_ROWS}) WHERE kind <> 'unlisted'""",
    "mixed_summaries": f"""
        SELECT {fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS "DocumentName",
               CASE WHEN kind IN ('card', 'notes') THEN {amount(_OPENING)} END AS "OpeningBalance_Value",
               CASE WHEN kind IN ('card', 'notes') THEN {_OPENING} END AS "OpeningBalance_Text",
               CASE WHEN kind IN ('card', 'notes') THEN {_CONF_1} END AS "OpeningBalance_Confidence",
               CASE WHEN kind IN ('card', 'listing') THEN {amount(f'({_CLOSING})')} END AS "ClosingBalance_Value",
               CASE WHEN kind IN ('card', 'listing') THEN {_CLOSING} END AS "ClosingBalance_Text",
               CASE WHEN kind IN ('card', 'listing') THEN {_CONF_1} || ' ' || {_CONF_2} END AS "ClosingBalance_Confidence",
               CASE WHEN kind <> 'listing' THEN 'two  words  end' END AS "Label_Value",
               CASE WHEN kind <> 'listing' THEN {_CONF_1} || ' ' || {_CONF_2} END AS "Label_Confidence",
               CASE WHEN kind = 'card' THEN {amount(f'({_RATE})')} END AS "Rate_Value",
               CASE WHEN kind = 'card' THEN {_RATE} END AS "Rate_Text", CASE WHEN kind = 'card' THEN {_RATE_CONF} END AS "Rate_Confidence"
        FROM (SELECT *, {TYPE} AS kind FROM lineitem) WHERE {GOOD} AND kind <> 'unlisted'""",
    "mixed_unmatched": f"""
        SELECT {fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS file_name,
               CASE WHEN kind IS NULL THEN 'no type' WHEN kind = 'unlisted' THEN kind ELSE 'failed' END AS why
        FROM (SELECT *, {TYPE} AS kind FROM lineitem) WHERE kind IS NULL OR kind = 'unlisted' OR {fx.FAILED_SQL}""",
    "named_objects": f"""
        SELECT folder || '/100% ' || file_name || '+' || page_no || '.json' AS name, * FROM ({PAGES})""",
    "file_inventory": f"""
        SELECT 'object=' || folder || '_' || file_name || '_' || page_no AS folder,
               CAST(strlen('{{"folder":"' || folder || '","file_name":"' || file_name || '","page_no":' || page_no || '}}') + 1 AS BIGINT) AS length
        FROM ({PAGES})""",
    "unsplit_manifest_of_runs": f"""
        WITH one AS ({ORACLE_PHRASE}), two AS ({ORACLE_PAGE})
        SELECT stem, min(run) AS first_run, count(*) AS runs
        FROM (SELECT stem, 'run 1' AS run FROM one UNION ALL SELECT stem, 'run 2' FROM two) GROUP BY stem""",
    "raw_text_written": f"""
        SELECT source AS folder, 'doc_' || CAST(doc_id AS VARCHAR) || '.pdf' AS document_name, text AS extracted_text
        FROM documents WHERE doc_id % 37 <> 0""",
    "tables_written": f"""
        SELECT *, CAST(NULL AS VARCHAR) AS "Note",
               CASE WHEN "Amount" < 0 THEN '-' ELSE '' END || '$' || format('{{:,.2f}}', abs("Amount")) AS shown_amount
        FROM ({FILLED})""",
    "run_all_document_tasks": f"""
        WITH first AS ({CATEGORISED}), second AS ({PREFIXED}), third AS ({DUPLICATES}),
        named AS (SELECT folder, file_name, first.target_folder,
                         CASE WHEN second.action = 'rename' THEN left(second.target_name, 9) ELSE '' END || first.target_name AS target_name
                  FROM first JOIN second USING (folder, file_name))
        SELECT folder, file_name, CAST(0 AS INTEGER) AS step, task, action, target_folder, target_name, detail FROM first
        UNION ALL
        SELECT folder, file_name, 1, second.task, second.action, named.target_folder, named.target_name, second.detail
        FROM named JOIN second USING (folder, file_name)
        UNION ALL
        SELECT folder, file_name, 2, third.task, third.action,
               CASE WHEN third.action = 'move' THEN third.target_folder ELSE named.target_folder END, named.target_name, third.detail
        FROM named JOIN third USING (folder, file_name)""",
    "incremental_retry": f"""
        SELECT {fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS file_name,
               CASE WHEN {fx.FAILED_SQL} AND NOT ({fx.RETURNED_SQL}) THEN 'failed' ELSE 'analysed' END AS status,
               CAST(CASE WHEN {fx.FAILED_SQL} THEN 1 ELSE 0 END AS BIGINT) AS batch_id,
               CASE WHEN {fx.FAILED_SQL} AND NOT ({fx.RETURNED_SQL}) THEN NULL ELSE CAST(sum(l_linenumber) AS BIGINT) END AS rows
        FROM lineitem GROUP BY folder, file_name, l_orderkey""",
    "extraction_totals": f"""
        SELECT count(*) AS files, count(CASE WHEN {fx.FAILED_SQL} THEN 1 END) AS failed,
               count(CASE WHEN {GOOD} THEN 1 END) AS summaries,
               CAST(sum(CASE WHEN {GOOD} THEN l_linenumber ELSE 0 END) AS BIGINT) AS transactions
        FROM lineitem""",
    "process_statements": f"""
        SELECT folder, row_no, "OriginalFileName", "StatementNumber", "AccountName", "AccountNumber", "Reference",
               "Missing", "Date", "Description", {_MONEY} FROM ({ROWS})""",
    "process_summary": f"""
        SELECT {fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS "DocumentName",
               {amount(_OPENING)} AS "OpeningBalance_Value", {_OPENING} AS "OpeningBalance_Text",
               {_CONF_1} AS "OpeningBalance_Confidence",
               {amount(f'({_CLOSING})')} AS "ClosingBalance_Value", {_CLOSING} AS "ClosingBalance_Text",
               {_CONF_1} || ' ' || {_CONF_2} AS "ClosingBalance_Confidence",
               'two  words  end' AS "Label_Value", {_CONF_1} || ' ' || {_CONF_2} AS "Label_Confidence",
               {amount(f'({_RATE})')} AS "Rate_Value", {_RATE} AS "Rate_Text", {_RATE_CONF} AS "Rate_Confidence"
        FROM lineitem WHERE {GOOD}""",
    "process_failures": f"""
        SELECT {fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS file_name FROM lineitem WHERE {fx.FAILED_SQL}""",
    "fill_missing_dates": FILLED,
    "pattern_from_example": r"""
        SELECT '(?iU)\d{1}\-[A-Za-z]{' || length(string_split(substring(o_orderpriority, 3), ' ')[1]) || '}'
               || CASE WHEN contains(o_orderpriority, ' ')
                       THEN '\s+[A-Za-z]{' || length(string_split(o_orderpriority, ' ')[2]) || '}' ELSE '' END AS pattern,
               count(*) AS orders
        FROM orders GROUP BY 1""",
    "region_text": f"""
        SELECT folder, file_name, page_no,
               {collapse("string_agg(text || ' ', '' ORDER BY block_no, line_no, span_no)")} AS region_text
        FROM ({SPANS}) WHERE block_type = 0 AND x1 - x0 > y1 - y0 AND y1 < page_height * 0.5
        GROUP BY folder, file_name, page_no""",
    "extract_value": values_of(ACCOUNT, 0.5),
    "extract_value_full_page": values_of(DATE, 1.0),
    "sanitise_name": "SELECT doc_id, regexp_replace(text, '[^-A-Za-z0-9._() ]', '', 'g') AS clean FROM documents",
    "categorise_by_value": CATEGORISED,
    "category_sizes": f"""
        SELECT folder, target_folder, count(*) AS files FROM ({CATEGORISED}) WHERE action = 'move' GROUP BY 1, 2""",
    "date_prefix": PREFIXED,
    "format_date": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 3 AND day(o_orderdate) <= 12
               THEN strftime(o_orderdate, '%Y%d%m') ELSE strftime(o_orderdate, '%Y%m%d') END AS prefix
        FROM orders""",
    "statement_number": f"""
        WITH {FILES}, {found_value(NUMBER, 1.0, 'found')}
        SELECT folder, file_name, regexp_replace(value, '[^0-9]', '', 'g') AS statement_number
        FROM files LEFT JOIN found USING (folder, file_name)""",
    "identify_duplicates": DUPLICATES,
    "duplicate_count": f"SELECT count(CASE WHEN action = 'move' THEN 1 END) AS duplicates FROM ({DUPLICATES})",
    "run_document_tasks": f"""
        WITH first AS ({CATEGORISED}), second AS ({PREFIXED})
        SELECT folder, file_name, CAST(0 AS INTEGER) AS step, task, action, target_folder, target_name, detail FROM first
        UNION ALL
        SELECT folder, file_name, 1, second.task, second.action, first.target_folder,
               CASE WHEN second.action = 'rename' THEN left(second.target_name, 9) ELSE '' END || first.target_name,
               second.detail
        FROM first JOIN second USING (folder, file_name)""",
    "run_table_tasks": f"""SELECT "Date_Processed", count(*) AS rows FROM ({FILLED}) GROUP BY 1""",
    "last_known_value": f"""
        SELECT "OriginalFileName", row_no,
               CASE WHEN "OriginalFileName" IS NOT NULL THEN last_value(CASE WHEN row_no % 5 = 0 THEN "Amount" END IGNORE NULLS)
               OVER (PARTITION BY "OriginalFileName" ORDER BY row_no) END AS "Amount_Processed"
        FROM ({TRANSACTIONS})""",
    "pending_results": f"""
        SELECT {fx.FOLDER_SQL} AS folder, {fx.FILE_SQL} AS file_name FROM lineitem
        WHERE l_orderkey % 3 = 0 OR {fx.FAILED_SQL}""",
    "process_incremental": f"""
        SELECT folder, "OriginalFileName", row_no, {_MONEY} FROM ({ROWS})""",
}
