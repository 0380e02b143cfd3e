"""Finding values in positioned text by the shape of an example.

A file's text can be arbitrarily long, so it is never put together in one
place.  Spans become page texts, pages are folded in groups of ``width``, and
groups are folded again.  Each fold keeps, per searched value, the first match
and the two ends of the text; the ends are all a later fold needs to find
matches that run across the seam, because a pattern always matches the same
number of characters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as tx
from foliospark.functions.examples import ExamplePattern, pattern_from_example
from foliospark.schemas import FILE_KEY, with_known

TOP_HALF = 0.5
FULL_PAGE = 1.0

# Stands for the text left out between the two ends; no pattern matches it.
_CUT = "\uffff"


@dataclass(frozen=True)
class ValueSearch:
    """What to look for: the first text shaped like ``example`` in the upper
    ``page_fraction`` of the pages, stored in column ``name``."""

    name: str
    example: str
    page_fraction: float = TOP_HALF

    @property
    def pattern(self) -> ExamplePattern:
        return pattern_from_example(self.example)


def in_region(page_fraction: float) -> Column:
    """Horizontal text spans that end above the given share of the page height."""
    horizontal = (F.col("x1") - F.col("x0")) > (F.col("y1") - F.col("y0"))
    return (F.col("block_type") == 0) & horizontal & (F.col("y1") < F.col("page_height") * page_fraction)


def _page_texts(spans: DataFrame, regions: dict[str, float]) -> DataFrame:
    """One row per page with a text column per region; null where it is empty.

    Spans outside all regions only keep their page's row alive: their text is
    dropped before the shuffle.
    """
    inside = {name: in_region(fraction) for name, fraction in regions.items()}
    any_region = F.lit(False)
    for test in inside.values():
        any_region = any_region | test
    flags = [test.alias(name) for name, test in inside.items()]
    part = F.struct("block_no", "line_no", "span_no", "text", F.struct(*flags).alias("inside"))
    pages = with_known(spans, *FILE_KEY).groupBy(*FILE_KEY, "page_no").agg(
        F.sort_array(F.collect_list(F.when(any_region, part))).alias("_parts")
    )

    def joined(name: str) -> Column:
        piece = F.transform("_parts", lambda p: F.when(p["inside"][name], F.concat(p["text"], F.lit(" "))))
        return tx.collapse_spaces(F.array_join(piece, ""))

    # In two steps, so that the text is put together once and used twice.
    texts = pages.select(*FILE_KEY, "page_no", *[joined(name).alias(name) for name in regions])
    return texts.select(*FILE_KEY, "page_no", *[tx.null_if_empty(F.col(name)).alias(name) for name in regions])


def region_text(spans: DataFrame, page_fraction: float = TOP_HALF) -> DataFrame:
    """Text of the upper part of each page, in reading order, spaces collapsed."""
    pages = _page_texts(spans, {"region_text": page_fraction})
    return pages.where(F.col("region_text").isNotNull())


def _ends(text: Column, length: int) -> Column:
    """Both ends of a text, long enough for any match across them."""
    short = (F.length(text) <= 2 * length) & ~text.contains(_CUT)
    return F.when(short, text).otherwise(F.concat(F.left(text, F.lit(length)), F.lit(_CUT), F.right(text, F.lit(length))))


def _first_match(text: Column, pattern: ExamplePattern) -> Column:
    return tx.null_if_empty(F.regexp_extract(text, pattern.regex, 0))


def _fold(rows: DataFrame, searches: Sequence[ValueSearch], group: list[str], position: str) -> DataFrame:
    """Combine consecutive pieces of text.

    ``rows`` hold, per search, ``text_<i>`` (a text or its two ends) and
    ``hit_<i>`` (the first match inside it).  A match across pieces counts only
    if it begins before the first piece that has a match of its own.
    """
    pieces = []
    for i in range(len(searches)):
        pieces += [F.col(f"text_{i}"), F.col(f"hit_{i}")]
    grouped = rows.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(position, *pieces))).alias("_pieces"))

    columns = []
    for i in range(len(searches)):
        own = F.array_position(F.transform("_pieces", lambda p: p[f"hit_{i}"].isNotNull()), True).cast("int")
        texts = F.transform("_pieces", lambda p: F.coalesce(p[f"text_{i}"], F.lit("")))
        columns += [own.alias(f"own_{i}"), texts.alias(f"texts_{i}")]
    prepared = grouped.select(*group, "_pieces", *columns)

    joined = []
    for i, search in enumerate(searches):
        own, texts = F.col(f"own_{i}"), F.col(f"texts_{i}")
        before = F.array_join(F.slice(texts, F.lit(1), F.greatest(own - 1, F.lit(0))), "")
        lead = F.left(F.get(texts, own - 1), F.lit(search.pattern.length))
        upto = F.when(own > 0, F.concat(before, lead)).otherwise(F.array_join(texts, ""))
        joined.append(tx.collapse_spaces(upto).alias(f"upto_{i}"))
        joined.append(tx.collapse_spaces(F.array_join(texts, "")).alias(f"whole_{i}"))
        joined.append(F.when(own > 0, F.get(F.col("_pieces"), own - 1)[f"hit_{i}"]).alias(f"first_{i}"))

    folded = []
    for i, search in enumerate(searches):
        across = _first_match(F.col(f"upto_{i}"), search.pattern)
        folded.append(_ends(F.col(f"whole_{i}"), search.pattern.length).alias(f"text_{i}"))
        folded.append(F.coalesce(across, F.col(f"first_{i}")).alias(f"hit_{i}"))
    return prepared.select(*group, *joined).select(*group, *folded)


def extract_values(
    spans: DataFrame, searches: Sequence[ValueSearch], files: DataFrame | None = None, width: int = 4096
) -> DataFrame:
    """Per file, one column per search with the first matching value, else null.

    All searches share one pass over the spans.  ``files`` names the files to
    report (default: all that have spans).  An empty example finds nothing.
    """
    active = [s for s in searches if s.pattern.length > 0]
    empty = [F.lit(None).cast("string").alias(s.name) for s in searches if s.pattern.length == 0]
    if not active:
        return with_known((spans if files is None else files).select(*FILE_KEY), *FILE_KEY).distinct().select("*", *empty)

    regions = {f"region_{n}": fraction for n, fraction in enumerate(sorted({s.page_fraction for s in active}))}
    region_of = {fraction: name for name, fraction in regions.items()}
    start = []
    for i, search in enumerate(active):
        text, pattern = F.col(region_of[search.page_fraction]), search.pattern
        start.append(_ends(text, pattern.length).alias(f"text_{i}"))
        start.append(_first_match(text, pattern).alias(f"hit_{i}"))
    pages = _page_texts(spans, regions).select(*FILE_KEY, "page_no", *start)

    blocks = _fold(pages.withColumn("_block", F.expr(f"page_no div {int(width)}L")), active, [*FILE_KEY, "_block"], "page_no")
    found = _fold(blocks, active, FILE_KEY, "_block")
    values = [tx.null_if_empty(tx.strip(F.col(f"hit_{i}"))).alias(s.name) for i, s in enumerate(active)]
    result = found.select(*FILE_KEY, *values, *empty)
    if files is not None:
        result = with_known(files.select(*FILE_KEY), *FILE_KEY).distinct().join(result, FILE_KEY, "left")
    return result.select(*FILE_KEY, *[s.name for s in searches])


def extract_value(
    spans: DataFrame, example: str, page_fraction: float = TOP_HALF, files: DataFrame | None = None
) -> DataFrame:
    """Per file, the first text shaped like ``example``."""
    return extract_values(spans, [ValueSearch("value", example, page_fraction)], files)


def digits_only(value: Column) -> Column:
    return F.regexp_replace(value, r"(?U)[^\d]", "")


def statement_number(spans: DataFrame, example: str, files: DataFrame | None = None) -> DataFrame:
    """Per file, the digits of the first text shaped like ``example`` on the full page."""
    found = extract_value(spans, example, FULL_PAGE, files)
    return found.select(*FILE_KEY, digits_only(F.col("value")).alias("statement_number"))
