"""Statement splitting: from page events to statements and page assignments."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.config import StatementType
from foliospark.functions import names
from foliospark.operators.chunks import (
    CHUNK,
    PAGE_WIDTH,
    before_in_chunk,
    earlier_chunks,
    join_carry,
    with_chunk,
    within_chunk,
)
from foliospark.operators.page_text import events_of, page_matches
from foliospark.schemas import FILE_KEY, with_known


@dataclass(frozen=True)
class SplitResult:
    events: DataFrame  # one small row per page
    statements: DataFrame  # one row per output document, with its name
    assignments: DataFrame  # one row per page that belongs to a document
    manual: DataFrame  # files without any start, or with pages that have no number


def pages_from_starts(events: DataFrame, width: int = PAGE_WIDTH) -> DataFrame:
    """Assign pages where every start page opens a new document.

    Document ``i`` runs to the page before the next start; pages ahead of the
    first start belong to none.
    """
    chunked = with_chunk(with_known(events, *FILE_KEY, "page_no"), "page_no", width)
    is_start = F.col("start_id").isNotNull().cast("long")
    # Both sides of the join below read the same shuffled rows (exchange reuse).
    local = chunked.withColumn("_local", F.sum(is_start).over(within_chunk(FILE_KEY, "page_no")))
    carry = (
        local.groupBy(*FILE_KEY, CHUNK)
        .agg(F.max("_local").alias("_starts"))
        .select(*FILE_KEY, CHUNK, F.sum("_starts").over(earlier_chunks(FILE_KEY)).alias("_before"))
        .where(F.col("_before") > 0)
    )
    ordinal = F.col("_local") + F.coalesce("_before", F.lit(0))
    return (
        join_carry(local, carry, FILE_KEY)
        .withColumn("ordinal", ordinal.cast("long"))
        .where(F.col("ordinal") > 0)
        .select(
            *FILE_KEY,
            "page_no",
            F.col("ordinal").cast("string").alias("statement_id"),
            "ordinal",
            F.lit(None).cast("int").alias("start_page"),
        )
    )


def split_page_start(events: DataFrame, width: int = PAGE_WIDTH) -> DataFrame:
    """Statements of files where every start page opens a new document."""
    return (
        pages_from_starts(events, width)
        .groupBy(*FILE_KEY, "ordinal")
        .agg(F.min("page_no").alias("start_page"), F.max("page_no").alias("end_page"))
        .select(*FILE_KEY, F.col("ordinal").cast("string").alias("statement_id"), "ordinal", "start_page", "end_page")
    )


def pages_from_ranges(events: DataFrame, width: int = PAGE_WIDTH) -> DataFrame:
    """Assign pages where statements have ids and explicit ends.

    A start page opens its id unless that id is already open; opening one
    closes the other on the page before.  A closing page is the last of the
    open statement.  The same id may come back: every run is reported here,
    told apart by ``start_page``.
    """
    page, start_id = F.col("page_no"), F.col("start_id")
    chunked = with_chunk(with_known(events, *FILE_KEY, "page_no"), "page_no", width)

    # A setter decides what is open after its page: an id, or nothing.
    open_after = F.when(~F.col("closes"), start_id)
    setter = F.when(
        start_id.isNotNull() | F.col("closes"),
        F.struct(page.alias("page"), start_id.alias("id"), open_after.alias("open_after")),
    )
    run = F.struct(page.alias("start"), start_id.alias("id"))

    local = (
        chunked.withColumn("_setter", setter)
        .withColumn("_first", F.first("_setter", ignorenulls=True).over(within_chunk(FILE_KEY, "page_no")))
        .withColumn("_previous", F.last("_setter", ignorenulls=True).over(before_in_chunk(FILE_KEY, "page_no")))
        .withColumn(
            "_opens",
            start_id.isNotNull()
            & F.col("_previous").isNotNull()
            & ~start_id.eqNullSafe(F.col("_previous.open_after")),
        )
        .withColumn(
            "_run", F.last(F.when(F.col("_opens"), run), ignorenulls=True).over(within_chunk(FILE_KEY, "page_no"))
        )
    )

    # Whether the first setter of a chunk opens a run depends on earlier chunks.
    def first_run(first: Column, state: Column) -> Column:
        opens = first["id"].isNotNull() & ~first["id"].eqNullSafe(state["open_after"])
        return F.when(opens, F.struct(first["page"].alias("start"), first["id"].alias("id")))

    earlier = earlier_chunks(FILE_KEY)
    carry = (
        local.groupBy(*FILE_KEY, CHUNK)
        .agg(F.min("_setter").alias("_first"), F.max("_setter").alias("_last"), F.max("_run").alias("_run"))
        .withColumn("_state", F.last("_last", ignorenulls=True).over(earlier))
        .withColumn("_chunk_run", F.coalesce("_run", first_run(F.col("_first"), F.col("_state"))))
        .select(
            *FILE_KEY,
            CHUNK,
            "_state",
            F.last("_chunk_run", ignorenulls=True).over(earlier).alias("_carried_run"),
        )
        .where(F.col("_state").isNotNull())
    )

    joined = join_carry(local, carry, FILE_KEY)
    open_before = F.coalesce("_previous", "_state")["open_after"]
    opens_here = start_id.isNotNull() & ~start_id.eqNullSafe(open_before)
    current = F.coalesce("_run", first_run(F.col("_first"), F.col("_state")), "_carried_run")
    return (
        joined.where(opens_here | open_before.isNotNull())
        .withColumn("_current", current)
        .select(
            *FILE_KEY,
            "page_no",
            F.col("_current.id").alias("statement_id"),
            F.lit(None).cast("long").alias("ordinal"),
            F.col("_current.start").alias("start_page"),
        )
    )


def _runs(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy(*FILE_KEY, "statement_id", "start_page").agg(F.max("page_no").alias("end_page"))


def _latest_runs(runs: DataFrame) -> DataFrame:
    latest = F.max(F.struct("start_page", "end_page")).alias("_range")
    return (
        runs.groupBy(*FILE_KEY, "statement_id")
        .agg(latest)
        .select(
            *FILE_KEY,
            "statement_id",
            F.lit(None).cast("long").alias("ordinal"),
            F.col("_range.start_page").alias("start_page"),
            F.col("_range.end_page").alias("end_page"),
        )
    )


def split_start_end(events: DataFrame, width: int = PAGE_WIDTH) -> DataFrame:
    """Statements with ids; when an id comes back, its last range counts."""
    return _latest_runs(_runs(pages_from_ranges(events, width)))


def _reopened(runs: DataFrame) -> DataFrame:
    """Ids with more than one run, and where the last one starts; usually none."""
    return (
        runs.groupBy(*FILE_KEY, "statement_id")
        .agg(F.max("start_page").alias("_kept_start"), F.count("*").alias("_runs"))
        .where(F.col("_runs") > 1)
        .drop("_runs")
    )


def superseded_ranges(events: DataFrame, width: int = PAGE_WIDTH) -> DataFrame:
    """Diagnostics: the earlier ranges of ids that came back later."""
    runs = with_known(_runs(pages_from_ranges(events, width)), "statement_id")
    again = runs.join(_reopened(runs), [*FILE_KEY, "statement_id"])
    return again.where(F.col("start_page") < F.col("_kept_start")).drop("_kept_start")


def name_documents(statements: DataFrame, stype: StatementType) -> DataFrame:
    """Add ``document_name``, the name of each output document."""
    file_stem = names.stem(F.col("file_name"))
    if stype.has_ranges:
        name = names.statement_name(file_stem, F.col("statement_id"))
    else:
        name = names.document_name(file_stem, F.col("ordinal"))
    return statements.withColumn("document_name", name)


def assign_pages(pages: DataFrame, statements: DataFrame, bucket: int = 64) -> DataFrame:
    """Interval join of pages to the statements that cover them.

    Both sides are cut into buckets of ``bucket`` pages and joined on file and
    bucket, so a file with very many pages and statements spreads over tasks
    and each page meets only the statements of its own bucket.
    """
    extra = [c for c in statements.columns if c not in FILE_KEY]
    first, last = F.expr(f"start_page div {int(bucket)}L"), F.expr(f"end_page div {int(bucket)}L")
    # In two steps, so that no statement needs one huge array of buckets.
    step = 65536
    coarse = F.explode(F.sequence(F.floor(first / step), F.floor(last / step)))
    low, high = F.greatest(first, F.col("_coarse") * step), F.least(last, F.col("_coarse") * step + step - 1)
    covered = statements.withColumn("_coarse", coarse).withColumn("_bucket", F.explode(F.sequence(low, high)))
    placed = pages.withColumn("_bucket", F.expr(f"page_no div {int(bucket)}L"))
    return (
        placed.join(covered, [*FILE_KEY, "_bucket"])
        .where(F.col("page_no").between(F.col("start_page"), F.col("end_page")))
        .select(*[placed[c] for c in pages.columns], *[covered[c] for c in extra])
    )


def route_manual(files: DataFrame, statements: DataFrame | None) -> DataFrame:
    """Files that have to be split by hand: no start was found, or
    (``statements=None``) the statement type is unknown."""
    wanted = with_known(files.select(*FILE_KEY), *FILE_KEY).distinct()
    if statements is not None:
        wanted = wanted.join(with_known(statements.select(*FILE_KEY), *FILE_KEY).distinct(), FILE_KEY, "left_anti")
    return with_stem(wanted)


def split_events(events: DataFrame, stype: StatementType, width: int = PAGE_WIDTH) -> SplitResult:
    """Statements, page assignments and manual files from page events."""
    if stype.has_ranges:
        assigned = pages_from_ranges(events, width)
        statements = split_start_end(events, width)
        assigned = with_known(assigned, "statement_id")
        assigned = assigned.join(_reopened(_runs(assigned)), [*FILE_KEY, "statement_id"], "left")
        assigned = assigned.where(F.col("start_page") == F.coalesce("_kept_start", "start_page"))
    else:
        assigned = pages_from_starts(events, width)
        statements = split_page_start(events, width)
    # Asking for a page, not just a flag, reads the same columns as the
    # assignments do, so both come from one pass.
    last_start = F.max(F.when(F.col("start_id").isNotNull(), F.col("page_no"))).alias("_last_start")
    known = with_known(events, *FILE_KEY, "page_no")
    manual = known.groupBy(*FILE_KEY).agg(last_start).where(F.col("_last_start").isNull())
    pages = [*FILE_KEY, "page_no", "statement_id", "ordinal"]
    return SplitResult(
        events=events,
        statements=name_documents(statements, stype),
        assignments=name_documents(assigned.select(*pages), stype),
        manual=with_stem(manual),
    )


def split_documents(
    pages: DataFrame, stype: StatementType | None, width: int = PAGE_WIDTH, spans: DataFrame | None = None
) -> SplitResult:
    """Split every file of a page table by the rules of one statement type; footers come from ``spans`` if given.

    Each file is split or on the manual list, never both: files without any
    start, and files with pages that have no number, whose place is unknown, go
    to the list; an unknown type (``None``) sends all there.  The text is read
    once for all results (see :func:`page_matches`).
    """
    if stype is None:
        keyed = with_known(pages, *FILE_KEY)
        events = keyed.select(
            *FILE_KEY, "page_no", F.lit(None).cast("string").alias("start_id"), F.lit(False).alias("closes")
        )
        files = keyed.select(*FILE_KEY).distinct()
        return replace(split_events(events, StatementType(name=""), width), manual=with_stem(files))
    matches = page_matches(pages, stype, spans, width)
    result = split_events(events_of(matches.where(~F.col("unnumbered"))), stype, width)
    unnumbered = matches.where("unnumbered").select(*FILE_KEY).distinct()
    return replace(result, events=events_of(matches), manual=result.manual.unionByName(with_stem(unnumbered)))


def with_stem(files: DataFrame) -> DataFrame:
    return files.select(*FILE_KEY, names.stem(F.col("file_name")).alias("stem"))
