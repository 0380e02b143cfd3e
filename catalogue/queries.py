"""One query per operator, over whole driver tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import fixtures as fx
from foliospark import config, schemas
from foliospark.functions import amounts, dates, examples, names
from foliospark.functions import text as tx
from foliospark.operators import counts, extract, page_text, postprocess, split, values
from foliospark.operators.chunks import last_known
from foliospark.plans import preprocess as pre
from foliospark.plans import process, tasks
from foliospark.session import shared_folder
from foliospark.sinks import writers
from foliospark.sources import readers
from foliospark.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Sources


def new_folder(spark, kind):
    """A path in the folder that all executors share; on this machine in tests on it."""
    base = shared_folder(spark)
    if base is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(base or tempfile.mkdtemp(prefix='run-', dir='/tmp')).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def stored(df, kind, fmt="parquet", **options):
    path = new_folder(df.sparkSession, kind)
    df.write.format(fmt).options(**options).save(path)
    return path


@query
def page_table(spark, sf_dir):
    """Pages written and read back by the page reader, which fills in a missing folder."""
    written = fx.pages(spark, sf_dir)
    pages = readers.read_pages(spark, stored(written, "page_table"))
    return pages.select("folder", "file_name", "page_no", "text", "ocr_text", "footer_text", "footer_ocr_text")


@query
def analysis_round_trip(spark, sf_dir):
    """Results written as JSON text and parsed back with the engine's schema."""
    results = fx.results(spark, sf_dir)
    objects = results.select(F.to_json(F.struct("*")).alias("content"))
    parsed = readers.parse_json_objects(objects, schemas.ANALYSIS).select("parsed.*")
    return parsed.select(
        "folder",
        "file_name",
        F.col("documents").isNull().alias("failed"),
        F.get("documents", F.lit(0))["transactions"][0]["Description"]["value"].alias("first_item"),
    )


@query
def analysis_documents(spark, sf_dir):
    """Every field and transaction cell of results that were written as JSON and read back by the reader, as text."""
    # Compressed, in files of a size that one task reads, as they can't be cut.
    path = stored(fx.results(spark, sf_dir), "analysis_documents", "json", compression="gzip", maxRecordsPerFile=200_000)
    results = readers.read_analysis_results(spark, path)
    unnamed = ("NoDate", "NoAmount", "NoRate")

    def texts(cells, *shown):
        named = F.filter(F.map_entries(cells), lambda e: ~e["key"].isin(*unnamed))
        return F.sort_array(F.transform(named, lambda e: F.concat(e["key"], F.lit("="), F.concat_ws("|", *(F.coalesce(show(e["value"]), F.lit("~")) for show in shown)))))

    content, value, confidence = (lambda c: c["content"]), (lambda c: c["value"]), (lambda c: tx.float_text(c["confidence"]))
    items = F.transform("_document.transactions", lambda item: F.array_join(texts(item, content, value), ";"))
    documents = results.select("folder", "file_name", F.posexplode_outer("documents").alias("document", "_document"))
    return documents.select(
        "folder", "file_name", "document", F.array_join(texts(F.col("_document.fields"), content, value, confidence), ";").alias("fields"), F.array_join(items, "\n").alias("items")
    )


@query
def named_objects(spark, sf_dir):
    """All seven columns of pages, written as one object each under names with blanks and percent signs, and read back."""
    path = new_folder(spark, "named_objects")
    name = F.format_string("%s/100%% %s+%d.json", "folder", "file_name", "page_no")
    writers.write_named_objects(fx.pages(spark, sf_dir), path, name)
    good, _ = readers.read_named_objects(spark, path, schemas.PAGES, prefix="f")
    return good


@query
def file_inventory(spark, sf_dir):
    """The files of pages that were written one by one: their folder's name and their length; no contents are read."""
    path = new_folder(spark, "file_inventory")
    pages = fx.pages(spark, sf_dir).select("folder", "file_name", "page_no")
    writers.write_named_objects(pages, path, F.concat_ws("_", "folder", "file_name", "page_no"))
    found = readers.read_file_inventory(spark, f"{path}/*", suffix="txt")
    return found.select(F.element_at(F.split("folder", "/"), -1).alias("folder"), "length")


@query
def unsplit_manifest_of_runs(spark, sf_dir):
    """The manual lists of two runs, one of which was repeated."""
    path = new_folder(spark, "unsplit")
    pages = fx.pages(spark, sf_dir)
    for run, rule in (("run 1", fx.PHRASE_RULE), ("run 2", fx.PAGE_RULE), ("run 2", fx.PAGE_RULE)):
        writers.append_unsplit_manifest(split.split_documents(pages, rule).manual, path, run)
    return readers.read_unsplit_manifest(spark, path)


@query
def raw_text_written(spark, sf_dir):
    """Texts of documents written and read back."""
    path = new_folder(spark, "raw_text")
    writers.write_raw_text(raw_text(spark, sf_dir), path)
    return spark.read.parquet(f"{path}/ExtractedText")


@query
def tables_written(spark, sf_dir):
    """Transactions of a run written as display tables, read back, date-filled and written as processed tables."""
    path = new_folder(spark, "tables")
    rows = fx.transactions(spark, sf_dir).withColumn("Note", F.when(F.col("row_no") % 3 == 1, "n/a").when(F.col("row_no") % 3 == 2, ""))
    summary = rows.groupBy("OriginalFileName").agg(F.count("*").alias("rows"))
    writers.write_tables(rows, summary, path, fx.CARD, csv=True)
    target = tasks.process_tables(spark, path, ["fill_missing_dates"], csv=True)
    shown = readers.read_tables(spark, f"{path}/csv", "csv")[0].select(F.col("row_no").cast("long").alias("row_no"), F.col("Amount").alias("shown_amount"))
    return spark.read.parquet(f"{target}/transactions").join(shown, "row_no")


@query
def json_objects_parsed(spark, sf_dir):
    """JSON objects, some of them cut off: which ones parse, and to what."""
    events = fx.table(spark, sf_dir, "events")
    content = F.when(F.col("event_id") % 9 == 4, F.expr("substring(props, 1, length(props) - 1)")).otherwise(
        F.when(F.col("event_id") % 9 == 5, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props"))
    )
    parsed = readers.parse_json_objects(events.select("event_id", content.alias("content")), "k long")
    return parsed.select("event_id", F.col("parsed").isNotNull().alias("ok"), F.col("parsed.k").alias("k"))


@query
def json_object_failures(spark, sf_dir):
    parsed = json_objects_parsed(spark, sf_dir)
    return parsed.groupBy("ok").agg(F.count("*").alias("objects"))


@query
def statement_types_joined(spark, sf_dir):
    """Files of several statement types in one table, joined with the configuration."""
    pages = fx.pages(spark, sf_dir)
    number = F.regexp_extract("file_name", r"(\d+)", 1).cast("long") % 4
    typed = pages.withColumn("type_name", F.element_at(F.array(*[F.lit(t.name) for t in fx.SPLIT_TYPES]), (number + 1).cast("int")))
    # As many rows as the configuration has types, so safe to send everywhere.
    types = F.broadcast(config.statement_types_df(spark, fx.SPLIT_TYPES))
    return (
        typed.join(types, "type_name")
        .groupBy("type_name", "split_type", "start_pattern", "start_phrase", "must_not_contain")
        .agg(F.count("*").alias("pages"), F.count(F.when(F.col("page_no") == 0, 1)).alias("files"))
    )


@query
def tables_read_back(spark, sf_dir):
    """Blank cells and spellings of "no value" read as null."""
    events = fx.table(spark, sf_dir, "events")
    cell = (
        F.when(F.col("event_id") % 7 == 1, "")
        .when(F.col("event_id") % 7 == 2, "n/a")
        .when(F.col("event_id") % 7 == 3, "NULL")
        .otherwise(F.col("event_type"))
    )
    return readers.blank_to_null(events.select("event_id", cell.alias("cell")))


# Sinks: the rows each one writes


@query
def currency_display(spark, sf_dir):
    rows = process.process_statements(fx.results(spark, sf_dir), fx.CARD).transactions
    return writers.display_amounts(rows, fx.CARD).select("OriginalFileName", "row_no", "Amount", "Balance")


@query
def counts_of_run(spark, sf_dir):
    detail = pages_per_document(spark, sf_dir)
    return writers.tagged_counts(counts.folder_summary(detail), "run 1")


@query
def json_objects(spark, sf_dir):
    pages = fx.pages(spark, sf_dir).select("folder", "file_name", "page_no")
    return writers.json_objects(pages)


@query
def processed_dates_display(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    return writers.display_dates(orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date")))


@query
def unsplit_manifest(spark, sf_dir):
    manual = split.split_documents(fx.pages(spark, sf_dir), fx.PHRASE_RULE).manual
    return manual.select("stem")


# Page text and splitting


@query
def flag_machine_readable(spark, sf_dir):
    flagged = page_text.flag_machine_readable(fx.pages(spark, sf_dir))
    return flagged.select("folder", "file_name", "page_no", "machine_readable")


@query
def resolve_page_text(spark, sf_dir):
    resolved = page_text.resolve_page_text(fx.pages(spark, sf_dir))
    return resolved.select("folder", "file_name", "page_no", "page_text")


@query
def normalise_text(spark, sf_dir):
    pages = fx.pages(spark, sf_dir)
    return pages.select(
        "folder",
        "file_name",
        "page_no",
        tx.normalise_text(F.col("text")).alias("text"),
        tx.normalise_text(F.col("footer_text")).alias("footer_text"),
    )


@query
def footer_text(spark, sf_dir):
    return page_text.footer_text(fx.spans(spark, sf_dir))


@query
def match_start(spark, sf_dir):
    pages = page_text.resolve_page_text(fx.pages(spark, sf_dir))
    found = page_text.match_start(pages, fx.RANGE_RULE)
    return found.select("folder", "file_name", "page_no", "matched", "source", "start_id")


@query
def match_start_without_group(spark, sf_dir):
    pages = page_text.resolve_page_text(fx.pages(spark, sf_dir))
    found = page_text.match_start(pages, fx.PAGE_RULE)
    return found.select("folder", "file_name", "page_no", "matched", "source", "start_id")


@query
def match_phrase(spark, sf_dir):
    pages = page_text.resolve_page_text(fx.pages(spark, sf_dir))
    found = page_text.match_phrase(page_text.match_start(pages, fx.RANGE_RULE), fx.RANGE_RULE)
    return found.select("folder", "file_name", "page_no", "phrase_matched")


@query
def split_page_start(spark, sf_dir):
    events = page_text.page_events(fx.pages(spark, sf_dir), fx.PAGE_RULE)
    return split.split_page_start(events)


@query
def split_start_end(spark, sf_dir):
    events = page_text.page_events(fx.pages(spark, sf_dir), fx.RANGE_RULE)
    return split.split_start_end(events).drop("ordinal")


@query
def superseded_ranges(spark, sf_dir):
    events = page_text.page_events(fx.pages(spark, sf_dir), fx.RANGE_RULE)
    return split.superseded_ranges(events)


@query
def assign_pages(spark, sf_dir):
    pages = fx.pages(spark, sf_dir)
    statements = split.split_start_end(page_text.page_events(pages, fx.RANGE_RULE))
    named = split.name_documents(statements, fx.RANGE_RULE)
    return split.assign_pages(pages.select("folder", "file_name", "page_no"), named.drop("ordinal"))


@query
def route_manual(spark, sf_dir):
    pages = fx.pages(spark, sf_dir)
    statements = split.split_documents(pages, fx.PHRASE_RULE).statements
    return split.route_manual(pages, statements)


@query
def split_documents(spark, sf_dir):
    """Every page with the document it went to, and the files left for manual splitting."""
    done = split.split_documents(fx.pages(spark, sf_dir), fx.PAGE_RULE)
    pages = done.assignments.select("folder", "file_name", "page_no", "document_name")
    manual = done.manual.select("folder", "file_name")
    return pages.unionByName(manual, allowMissingColumns=True)


@query
def split_documents_by_range(spark, sf_dir):
    done = split.split_documents(fx.pages(spark, sf_dir), fx.RANGE_RULE)
    return done.assignments.select("folder", "file_name", "page_no", "statement_id", "document_name")


@query
def split_documents_by_phrase(spark, sf_dir):
    done = split.split_documents(fx.pages(spark, sf_dir), fx.PHRASE_RULE)
    return done.statements


@query
def split_documents_unknown_type(spark, sf_dir):
    unknown = config.find_statement_type(fx.SPLIT_TYPES, "no such type")
    return split.split_documents(fx.pages(spark, sf_dir), unknown).manual


@query
def page_matches(spark, sf_dir):
    """What one pass over the text says about each page."""
    found = page_text.page_matches(fx.pages(spark, sf_dir), fx.RANGE_RULE)
    return found.select("folder", "file_name", "page_no", "machine_readable", "matched", "source", "number", "phrase_matched", "closes")


@query
def split_with_footers(spark, sf_dir):
    """Files split by numbers that stand in their footers, which are cut from spans."""
    done = split.split_documents(fx.pages(spark, sf_dir), fx.RANGE_RULE, spans=fx.page_spans(spark, sf_dir))
    return done.assignments.select("folder", "file_name", "page_no", "statement_id", "document_name")


@query
def split_unnumbered_pages(spark, sf_dir):
    """Files some of whose pages have no number are left for manual splitting as a whole."""
    done = split.split_documents(fx.mixed_pages(spark, sf_dir), fx.RANGE_RULE)
    pages = done.assignments.select("folder", "file_name", "page_no", "document_name")
    return pages.unionByName(done.manual.select("folder", "file_name"), allowMissingColumns=True)


@query
def preprocess_run(spark, sf_dir):
    """Where each file of a batch went, files without pages and with unnumbered pages among them."""
    return pre.preprocess(fx.batch_files(spark, sf_dir), fx.mixed_pages(spark, sf_dir), fx.RANGE_RULE).coverage


# Counts


@query
def pages_per_document(spark, sf_dir):
    return counts.pages_per_document(fx.inventory(spark, sf_dir), fx.inventory_pages(spark, sf_dir))


@query
def folder_summary(spark, sf_dir):
    detail = pages_per_document(spark, sf_dir)
    # One folder of the list has no file at all.
    folders = fx.table(spark, sf_dir, "region").select(F.concat(F.lit("empty_"), F.lower("r_name")).alias("folder"))
    return counts.folder_summary(detail, folders)


@query
def reconcile(spark, sf_dir):
    pages = fx.pages(spark, sf_dir)
    before = counts.pages_per_document(pages.select("folder", "file_name").distinct(), pages)
    after = pre.documents_after(split.split_documents(pages, fx.PAGE_RULE).assignments)
    return counts.reconcile(before, after)


# Extraction


@query
def static_fields(spark, sf_dir):
    return extract.static_fields(fx.results(spark, sf_dir), fx.CARD)


@query
def transactions(spark, sf_dir):
    return extract.transactions(fx.results(spark, sf_dir), fx.CARD)


@query
def convert_amount(spark, sf_dir):
    # Names and cents are those of a line, made before its amounts.
    lines = fx.line_items(spark, sf_dir).select(F.expr(fx.FILE_SQL).alias("file_name"), F.expr(fx.CENTS).alias("_cents"), "l_partkey", "l_linenumber")
    items = lines.select("*", F.expr("explode(sequence(1, l_linenumber)) AS i"))
    spelled = items.select("file_name", "i", F.expr(fx.AMOUNT_SQL.replace(fx.CENTS, "_cents")).alias("amount_text"))
    return spelled.select(
        "file_name",
        F.col("i").cast("long").alias("i"),
        amounts.convert_amount(F.col("amount_text"))["value"].alias("value"),
        amounts.amount_value(F.col("amount_text"), "corrected").alias("corrected_value"),
        amounts.convert_amount(F.col("amount_text"))["ok"].alias("ok"),
    )


@query
def conversion_success(spark, sf_dir):
    rows = extract.transactions(fx.results(spark, sf_dir), fx.CARD)
    return rows.groupBy("folder", "ConversionSuccess").agg(F.count("*").alias("rows"))


@query
def attach_static(spark, sf_dir):
    """Static fields joined to transactions of each file."""
    results = fx.results(spark, sf_dir)
    static = extract.static_fields(results, fx.LISTING).distinct()
    return extract.attach_static(extract.transactions(results, fx.LISTING), static)


@query
def summary_fields(spark, sf_dir):
    return extract.summary_fields(fx.results(spark, sf_dir), fx.CARD)


@query
def flatten_summary(spark, sf_dir):
    results = fx.results(spark, sf_dir)
    return extract.flatten_summary(extract.summary_fields(results, fx.LISTING), fx.LISTING)


@query
def coerce_amounts(spark, sf_dir):
    cell = (
        F.when(F.col("event_id") % 6 == 1, F.concat(F.lit(" "), F.col("event_id").cast("string"), F.lit(" ")))
        .when(F.col("event_id") % 6 == 2, F.concat(F.col("event_id").cast("string"), F.lit("d")))
        .when(F.col("event_id") % 6 == 3, F.concat(F.lit("-."), F.col("event_id").cast("string")))
        .when(F.col("event_id") % 6 == 4, F.concat(F.lit("$"), F.col("event_id").cast("string")))
        .when(F.col("event_id") % 6 == 5, F.concat(F.col("event_id").cast("string"), F.lit("e2")))
        .otherwise("")
    )
    rows = fx.table(spark, sf_dir, "events").select("event_id", cell.alias("Amount"))
    return extract.coerce_amounts(rows, fx.CARD)


@query
def raw_text(spark, sf_dir):
    found = extract.raw_text(fx.text_results(spark, sf_dir))
    return found.select(
        "folder", F.col("Document Name").alias("document_name"), F.col("Extracted Text").alias("extracted_text")
    )


@query
def table_rows(spark, sf_dir):
    rows = extract.table_rows(fx.table_results(spark, sf_dir))
    return rows.select("folder", "file_name", "table_idx", "row_index", F.array_join("contents", "|").alias("contents"))


@query
def union_runs(spark, sf_dir):
    """Two runs of different statement types in one table."""
    results = fx.analysis_results(fx.line_items(spark, sf_dir))
    typed = results.withColumn(
        "statement_type", F.when(F.col("l_returnflag") == "R", F.lit(fx.LISTING.name)).otherwise(F.lit(fx.CARD.name))
    )
    rows = process.process_mixed(typed, [fx.CARD, fx.LISTING]).transactions
    return rows.select("folder", "OriginalFileName", "row_no", "AccountName", "AccountNumber", "Amount", "Balance")


@query
def mixed_transactions(spark, sf_dir):
    """Transactions of four statement types in one table."""
    return process.process_mixed(fx.typed_results(spark, sf_dir), fx.MIXED_TYPES).transactions


@query
def mixed_summaries(spark, sf_dir):
    return process.process_mixed(fx.typed_results(spark, sf_dir), fx.MIXED_TYPES).summary


@query
def mixed_unmatched(spark, sf_dir):
    """Files that gave nothing: failed ones of known types, and all of unknown types."""
    done = process.process_mixed(fx.typed_results(spark, sf_dir), fx.MIXED_TYPES)
    failed = done.failed.withColumn("why", F.lit("failed"))
    return failed.unionByName(done.unmatched.select("folder", "file_name", F.coalesce("statement_type", F.lit("no type")).alias("why")))


@query
def extraction_totals(spark, sf_dir):
    return extract.extraction_totals(fx.results(spark, sf_dir))


@query
def process_statements(spark, sf_dir):
    return process.process_statements(fx.results(spark, sf_dir), fx.CARD).transactions


@query
def process_summary(spark, sf_dir):
    return process.process_statements(fx.results(spark, sf_dir), fx.CARD).summary


@query
def process_failures(spark, sf_dir):
    return process.process_statements(fx.results(spark, sf_dir), fx.CARD).failed


# Post-processing


@query
def fill_missing_dates(spark, sf_dir):
    return postprocess.fill_missing_dates(fx.transactions(spark, sf_dir))


@query
def pattern_from_example(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    return (
        orders.groupBy(examples.pattern_from_column(F.col("o_orderpriority")).alias("pattern"))
        .agg(F.count("*").alias("orders"))
    )


@query
def region_text(spark, sf_dir):
    return values.region_text(fx.spans(spark, sf_dir))


@query
def extract_value(spark, sf_dir):
    return values.extract_value(fx.spans(spark, sf_dir), fx.ACCOUNT_EXAMPLE)


@query
def extract_value_full_page(spark, sf_dir):
    return values.extract_value(fx.spans(spark, sf_dir), fx.DATE_EXAMPLE, values.FULL_PAGE)


@query
def sanitise_name(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents")
    return documents.select("doc_id", names.sanitise_name(F.col("text")).alias("clean"))


@query
def categorise_by_value(spark, sf_dir):
    return postprocess.categorise_by_value(fx.spans(spark, sf_dir), "Account Number", fx.ACCOUNT_EXAMPLE)


@query
def category_sizes(spark, sf_dir):
    return postprocess.category_sizes(categorise_by_value(spark, sf_dir))


@query
def date_prefix(spark, sf_dir):
    return postprocess.date_prefix(fx.spans(spark, sf_dir), fx.DATE_EXAMPLE)


@query
def format_date(spark, sf_dir):
    """Order dates spelled in eight ways and read back."""
    day = F.col("o_orderdate")
    spellings = ["dd MMM yyyy", "dd-MMM-yyyy", "MM-dd-yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "MMMM d, yyyy", "yyyyMMdd", "d MMMM yy"]
    text = F.lit(None).cast("string")
    for n, spelling in enumerate(spellings):
        text = F.when(F.col("o_orderkey") % 8 == n, F.date_format(day, spelling)).otherwise(text)
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("spelled"))
    return orders.select("o_orderkey", dates.format_date(F.col("spelled")).alias("prefix"))


@query
def statement_number(spark, sf_dir):
    return values.statement_number(fx.spans(spark, sf_dir), fx.STATEMENT_EXAMPLE)


@query
def identify_duplicates(spark, sf_dir):
    return postprocess.identify_duplicates(
        fx.spans(spark, sf_dir), fx.ACCOUNT_EXAMPLE, fx.STATEMENT_EXAMPLE, fx.DATE_EXAMPLE
    )


@query
def duplicate_count(spark, sf_dir):
    return postprocess.duplicate_count(identify_duplicates(spark, sf_dir))


@query
def run_document_tasks(spark, sf_dir):
    wanted = tasks.DocumentExamples(
        field_name="Account Number",
        value=fx.ACCOUNT_EXAMPLE,
        account=fx.ACCOUNT_EXAMPLE,
        statement=fx.STATEMENT_EXAMPLE,
        date=fx.DATE_EXAMPLE,
    )
    steps = ["categorise_by_value", "no_such_task", "add_date_prefix_to_filenames"]
    return tasks.run_document_tasks(fx.spans(spark, sf_dir), steps, wanted)


@query
def run_all_document_tasks(spark, sf_dir):
    """All tasks, duplicates last: their folders and names are those that the tasks before gave."""
    wanted = tasks.DocumentExamples(
        field_name="Account Number", value=fx.ACCOUNT_EXAMPLE, account=fx.ACCOUNT_EXAMPLE, statement=fx.STATEMENT_EXAMPLE, date=fx.DATE_EXAMPLE
    )
    steps = ["categorise_by_value", "add_date_prefix_to_filenames", "identify_and_move_duplicates"]
    return tasks.run_document_tasks(fx.spans(spark, sf_dir), steps, wanted)


@query
def run_table_tasks(spark, sf_dir):
    rows = fx.transactions(spark, sf_dir)
    filled = tasks.run_table_tasks(rows, ["fill_missing_dates", "no_such_task"])
    return filled.groupBy("Date_Processed").agg(F.count("*").alias("rows"))


@query
def last_known_value(spark, sf_dir):
    """Forward fill of an amount, in short chunks so that values cross them."""
    rows = fx.transactions(spark, sf_dir)
    kept = F.when(F.col("row_no") % 5 == 0, F.col("Amount"))
    return last_known(rows, ["OriginalFileName"], "row_no", kept, "Amount_Processed", width=64).select(
        "OriginalFileName", "row_no", "Amount_Processed"
    )


# Incremental processing


@query
def pending_results(spark, sf_dir):
    """Results still to be processed, given which files are done."""
    results = fx.results(spark, sf_dir)
    number = F.regexp_extract("file_name", r"item_(\d+)", 1).cast("long")
    manifest = incremental.batch_status(results).where(number % 3 != 0)
    return incremental.pending(results, manifest).select("folder", "file_name")


@query
def incremental_retry(spark, sf_dir):
    """Two deliveries, the second with failed files that came back under their own names: what is known of each file, and its transactions."""
    path = new_folder(spark, "incremental_retry")
    for number, batch in enumerate(fx.deliveries(spark, sf_dir)):
        for _ in range(number + 1):  # the second one is run again
            incremental.extract_batch(batch, fx.CARD, path, number)
    known = incremental.current_status(incremental.read_manifest(spark, path))
    rows = spark.read.parquet(f"{path}/transactions").groupBy("folder", F.col("OriginalFileName").alias("file_name")).agg(F.count("*").alias("rows"))
    return known.join(rows, ["folder", "file_name"], "left").select("folder", "file_name", "status", "batch_id", "rows")


@query
def process_incremental(spark, sf_dir):
    """Line items read as a stream of results, extracted with a checkpoint."""
    base = new_folder(spark, "process_incremental")
    schema = fx.table(spark, sf_dir, "lineitem").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
    results = fx.analysis_results(stream).drop("l_returnflag")
    incremental.process_stream(results, fx.CARD, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    written = spark.read.parquet(f"{base}/out/transactions")
    return written.select("folder", "OriginalFileName", "row_no", "Amount", "Balance", "ConversionSuccess")
