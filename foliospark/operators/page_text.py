"""Page text preparation and start-of-statement detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.config import StatementType
from foliospark.functions import text as tx
from foliospark.operators.chunks import CHUNK, PAGE_WIDTH, join_carry, with_chunk
from foliospark.schemas import FILE_KEY, with_known
from foliospark.session import settle

READABLE_ABOVE = 20  # characters of text on the first page
FOOTER_SHARE = 0.10
FOOTER_MINIMUM = 80


def is_readable_text(first_page_text: Column) -> Column:
    return F.coalesce(F.length(tx.strip(first_page_text)) > READABLE_ABOVE, F.lit(False))


def usable_text(text: Column, ocr_text: Column, readable: Column) -> Column:
    """Stripped text layer, or OCR text when that is empty or the file is scanned."""
    return F.when(~readable | tx.is_blank(text), ocr_text).otherwise(tx.strip(text))


def machine_readable_files(pages: DataFrame) -> DataFrame:
    """One row per file that has a first page; only first pages are read."""
    first = with_known(pages.where(F.col("page_no") == 0), *FILE_KEY)
    return first.select(*FILE_KEY, is_readable_text(F.col("text")).alias("machine_readable"))


def flag_machine_readable(pages: DataFrame, width: int = PAGE_WIDTH) -> DataFrame:
    """Add ``machine_readable``; a file without a first page counts as scanned.

    Text meets the flag by file and chunk of ``width`` pages, so no file sets
    the size of a task.  Pages without a number belong to the first chunk.
    """
    keyed = with_known(pages, *FILE_KEY)
    chunk = F.coalesce(F.expr(f"page_no div {int(width)}L"), F.lit(0).cast("long"))
    flagged = join_carry(keyed.withColumn(CHUNK, chunk), _readable_chunks(keyed, width), FILE_KEY)
    flag = F.coalesce("machine_readable", F.lit(False)).alias("machine_readable")
    return flagged.select(*[keyed[c] for c in keyed.columns if c != "machine_readable"], flag)


def resolve_page_text(pages: DataFrame) -> DataFrame:
    """Add ``page_text``, the text that later steps search."""
    if "machine_readable" not in pages.columns:
        pages = flag_machine_readable(pages)
    return pages.withColumn("page_text", usable_text(F.col("text"), F.col("ocr_text"), F.col("machine_readable")))


def footer_text(spans: DataFrame) -> DataFrame:
    """Text of the bottom strip of each page, in reading order.

    Spans are kept whole: one that reaches into the strip belongs to it.
    Pages with no such text have no row.
    """
    height = F.greatest(F.lit(FOOTER_MINIMUM), F.floor(F.col("page_height") * FOOTER_SHARE).cast("int"))
    in_strip = (F.col("y1") > F.col("page_height") - height) & (F.col("block_type") == 0)
    parts = F.sort_array(F.collect_list(F.struct("block_no", "line_no", "span_no", "text")))
    joined = F.array_join(F.transform(parts, lambda p: p["text"]), " ")
    return (
        with_known(spans, *FILE_KEY)
        .where(in_strip)
        .groupBy(*FILE_KEY, "page_no")
        .agg(tx.null_if_empty(tx.strip(joined)).alias("footer_text"))
        .where(F.col("footer_text").isNotNull())
    )


def start_match(page: Column, footer: Column, footer_ocr: Column, stype: StatementType) -> Column:
    """struct(matched, source, group1) of the start pattern.

    The page text is tried first, then the footer, then the footer's OCR text;
    all three are in normalised form.  The first text that matches decides.
    """
    pattern = tx.search_pattern(stype.start_pattern)
    sources = [("page", page), ("footer", footer), ("footer_ocr", footer_ocr)]
    source, group = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, text in reversed(sources):
        hit = F.coalesce(text.rlike(pattern), F.lit(False))
        source = F.when(hit, F.lit(name)).otherwise(source)
        if stype.pattern_has_group:
            group = F.when(hit, F.regexp_extract(text, pattern, 1)).otherwise(group)
    return F.struct(source.isNotNull().alias("matched"), source.alias("source"), group.alias("group1"))


def statement_number_text(group1: Column) -> Column:
    """The captured number without leading zeros; null unless it is all digits.

    Kept as text, so numbers of any length survive.
    """
    return F.when(group1.rlike(r"^\d+$"), F.regexp_replace(group1, r"^0+(?=\d)", ""))


def footer_sources(footer: Column, footer_ocr: Column) -> tuple[Column, Column]:
    """The footer's OCR text also stands in for an empty footer text layer."""
    ocr = F.coalesce(tx.strip(footer_ocr), F.lit(""))
    return F.coalesce(tx.null_if_empty(tx.strip(footer)), ocr), ocr


def match_start(pages: DataFrame, stype: StatementType) -> DataFrame:
    """Add ``matched``, ``source`` and ``start_id`` to pages that have ``page_text``.

    ``start_id`` is the number the pattern captured, else the page number; it is
    null where nothing matched.  A type without a pattern matches nothing.
    """
    if not stype.start_pattern:
        return pages.select(
            "*",
            F.lit(False).alias("matched"),
            F.lit(None).cast("string").alias("source"),
            F.lit(None).cast("string").alias("start_id"),
        )
    footer, footer_ocr = footer_sources(F.col("footer_text"), F.col("footer_ocr_text"))
    prepared = pages.select(
        "*",
        tx.normalise_text(F.col("page_text")).alias("_page"),
        tx.normalise_text(footer).alias("_footer"),
        tx.normalise_text(footer_ocr).alias("_footer_ocr"),
    )
    found = prepared.withColumn("_match", start_match(F.col("_page"), F.col("_footer"), F.col("_footer_ocr"), stype))
    number = F.coalesce(statement_number_text(F.col("_match.group1")), F.col("page_no").cast("string"))
    return found.select(
        *pages.columns,
        F.col("_match.matched").alias("matched"),
        F.col("_match.source").alias("source"),
        F.when(F.col("_match.matched"), number).alias("start_id"),
    )


def phrase_found(page_text: Column, stype: StatementType) -> Column:
    if not stype.start_phrase:
        return F.lit(False)
    return F.coalesce(page_text.contains(stype.start_phrase), F.lit(False))


def statement_ends(page_text: Column, stype: StatementType) -> Column:
    """True where the continuation phrase is configured and absent."""
    if not stype.must_not_contain:
        return F.lit(False)
    return F.coalesce(~page_text.contains(stype.must_not_contain), F.lit(True))


def match_phrase(pages: DataFrame, stype: StatementType) -> DataFrame:
    """Add ``phrase_matched``: the literal phrase is in the raw page text and the
    pattern did not match that page (``matched`` of :func:`match_start`)."""
    return pages.withColumn("phrase_matched", phrase_found(F.col("page_text"), stype) & ~F.col("matched"))


def found_start(text: Column, stype: StatementType) -> Column:
    """struct(hit, number) of the start pattern in one normalised text."""
    if not stype.start_pattern:
        return F.struct(F.lit(False).alias("hit"), F.lit(None).cast("string").alias("number"))
    pattern = tx.search_pattern(stype.start_pattern)
    hit, number = F.coalesce(text.rlike(pattern), F.lit(False)), F.lit(None).cast("string")
    if stype.pattern_has_group:
        number = F.when(hit, statement_number_text(F.regexp_extract(text, pattern, 1)))
    return F.struct(hit.alias("hit"), number.alias("number"))


def page_readings(pages: DataFrame, stype: StatementType, width: int = PAGE_WIDTH) -> DataFrame:
    """What one pass over the text says about each page: a small row without any text.

    Whether a file is machine readable is only known from its first page, so a
    page is searched both ways, as text ``layer`` and as ``scan`` (whose text is
    usually null and costs nothing); ``readable`` is the first page's own answer.
    Footers are searched as well.  Rows of pages without a number are kept, spread over chunks of their own.
    """
    page_no = F.col("page_no")
    layer, ocr = footer_sources(F.col("footer_text"), F.col("footer_ocr_text"))
    footers = [layer.alias("_footer"), ocr.alias("_footer_ocr")] if stype.start_pattern else []
    texts = with_known(pages, *FILE_KEY).select(
        *FILE_KEY,
        "page_no",
        F.when(page_no == 0, is_readable_text(F.col("text"))).alias("readable"),
        usable_text(F.col("text"), F.col("ocr_text"), F.lit(True)).alias("_layer"),
        F.col("ocr_text").alias("_scan"),
        *footers,
    )
    if footers:
        searched = ("_layer", "_scan", "_footer", "_footer_ocr")
        texts = texts.select("*", *[tx.normalise_text(F.col(c)).alias(f"{c}_norm") for c in searched])

    def start(name: str) -> Column:
        return found_start(F.col(f"{name}_norm") if footers else F.lit(None), stype)

    def reading(name: str) -> Column:
        raw = F.col(name)
        return F.struct(start(name).alias("start"), phrase_found(raw, stype).alias("phrase"), statement_ends(raw, stype).alias("ends"))

    spread = -1 - F.pmod(F.xxhash64("_layer", "_scan"), F.lit(1024))
    return texts.select(
        *FILE_KEY,
        "page_no",
        F.coalesce(F.expr(f"page_no div {int(width)}L"), spread).alias(CHUNK),
        "readable",
        reading("_layer").alias("layer"),
        reading("_scan").alias("scan"),
        start("_footer").alias("footer"),
        start("_footer_ocr").alias("footer_ocr"),
    )


def footer_starts(spans: DataFrame, stype: StatementType) -> DataFrame:
    """The start pattern in the footers that spans hold: a small row for each page with footer text."""
    footers = footer_text(spans)
    return footers.select(*FILE_KEY, "page_no", found_start(tx.normalise_text(F.col("footer_text")), stype).alias("strip"))


def with_footers(readings: DataFrame, footers: DataFrame) -> DataFrame:
    """Readings whose footer is that of :func:`footer_starts` on pages that have one; all pages stay.

    Only results of the search are joined, no text.
    """
    joined = readings.join(footers, [*FILE_KEY, "page_no"], "left")
    return joined.withColumn("footer", F.coalesce("strip", "footer")).drop("strip")


def page_matches(pages: DataFrame, stype: StatementType, spans: DataFrame | None = None, width: int = PAGE_WIDTH) -> DataFrame:
    """One row for each page: ``machine_readable``, ``matched``, ``source``, ``number``, ``phrase_matched``, ``closes``,
    and ``unnumbered``, whether the file has pages without a number.

    All text is read in one pass, whose small result is materialised once; every
    use of it reads that.  With ``spans`` footers are cut from them.
    """
    readings = page_readings(pages, stype, width)
    if spans is not None and stype.start_pattern:
        readings = with_footers(readings, footer_starts(spans, stype))
    readings = settle(readings)
    # The file's answer goes to each of its chunks, so pages of one file needn't meet in one task.
    in_chunk = readings.groupBy(*FILE_KEY, CHUNK).agg(F.max("readable").alias("_readable"), F.max(F.col("page_no").isNull()).alias("_null"))
    in_file = Window.partitionBy(*FILE_KEY)
    chunks = in_chunk.select(
        *FILE_KEY,
        CHUNK,
        F.coalesce(F.max("_readable").over(in_file), F.lit(False)).alias("machine_readable"),
        F.max("_null").over(in_file).alias("unnumbered"),
    )
    known = join_carry(readings, chunks, FILE_KEY)
    reading = F.when(F.col("machine_readable"), F.col("layer")).otherwise(F.col("scan"))
    sources = {"page": F.col("_reading.start"), "footer": F.col("footer"), "footer_ocr": F.col("footer_ocr")}
    source, number = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start in reversed(sources.items()):
        source = F.when(start["hit"], F.lit(name)).otherwise(source)
        number = F.when(start["hit"], start["number"]).otherwise(number)
    decided = known.withColumn("_reading", reading).withColumns({"source": source, "number": number})
    matched = F.col("source").isNotNull()
    return decided.select(
        *FILE_KEY,
        "page_no",
        CHUNK,
        "machine_readable",
        matched.alias("matched"),
        "source",
        F.when(matched, F.coalesce("number", F.col("page_no").cast("string"))).alias("number"),
        (F.col("_reading.phrase") & ~matched).alias("phrase_matched"),
        (F.col("_reading.ends") & ~matched).alias("closes"),
        "unnumbered",
    )


def events_of(matches: DataFrame) -> DataFrame:
    """``(file, page_no, start_id, closes)`` of numbered pages: ``start_id`` is set on pages that start a statement,
    ``closes`` where an open statement ends; a page whose pattern matched never closes."""
    start = F.coalesce("number", F.when(F.col("phrase_matched"), F.col("page_no").cast("string")))
    return matches.where(F.col("page_no").isNotNull()).select(*FILE_KEY, "page_no", start.alias("start_id"), "closes", CHUNK)


def page_events(pages: DataFrame, stype: StatementType, width: int = PAGE_WIDTH, spans: DataFrame | None = None) -> DataFrame:
    """Pages reduced to what splitting needs, spread by file and chunk of ``width`` pages."""
    return events_of(page_matches(pages, stype, spans, width))


def _readable_chunks(pages: DataFrame, width: int) -> DataFrame:
    """What first pages say about their file, once per chunk of the file.

    Few files have more than one chunk, and only their page numbers are read.
    """
    files = machine_readable_files(pages)
    later = with_chunk(pages.where(F.col("page_no") >= width).select(*FILE_KEY, "page_no"), "page_no", width)
    later = later.select(*FILE_KEY, CHUNK).distinct().join(files, FILE_KEY)
    first = files.withColumn(CHUNK, F.lit(0).cast("long"))
    return first.unionByName(later)
