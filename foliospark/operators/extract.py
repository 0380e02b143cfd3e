"""Field extraction: nested analysis results to flat tables.

Everything here works inside one row or explodes it, so no operator shuffles
except the optional join of :func:`attach_static`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.config import StatementType
from foliospark.functions import amounts
from foliospark.functions.names import quoted
from foliospark.functions import text as tx
from foliospark.schemas import FILE_KEY

STATIC_KEY = "OriginalFileName"
SUMMARY_KEY = "DocumentName"
SUCCESS = "ConversionSuccess"
ROW_NO = "row_no"


def _field_text(found: Column) -> Column:
    """Content of an extracted field, or its value when there is no content."""
    return F.coalesce(tx.null_if_empty(found["content"]), found["value"])


def analysed(results: DataFrame) -> DataFrame:
    return results.where(F.col("documents").isNotNull())


def failed(results: DataFrame) -> DataFrame:
    """Files whose analysis gave nothing."""
    return results.where(F.col("documents").isNull()).select(*FILE_KEY)


def _fields() -> Column:
    """The documents' fields alone, read as one column: transactions beside them needn't be read or made."""
    return F.col("documents")["fields"].alias("_fields")


def _found_in_fields(name: str) -> Column:
    """The named field of each document that has it, of :func:`_fields`."""
    return F.filter(F.transform("_fields", lambda f: F.try_element_at(f, F.lit(name))), lambda f: f.isNotNull())


def _static_column(name: str) -> Column:
    """The field of the first document that has it."""
    return F.get(_found_in_fields(name), F.lit(0))


def _static_names(stype: StatementType) -> list[str]:
    return list(dict.fromkeys(f.name for f in stype.static_fields if f.name != STATIC_KEY))


def _with_static(results: DataFrame, stype: StatementType, *extra: Column) -> DataFrame:
    """``folder``, ``_static_<i>`` texts with the file name first, and extra columns."""
    names = _static_names(stype)
    # Looked up in one step and read in the next, so each lookup runs once.
    read = results.select("folder", "file_name", _fields(), *extra)
    others = [c for c in read.columns if c not in ("folder", "file_name", "_fields")]
    found = read.select("folder", "file_name", *[_static_column(n).alias(f"_found_{i}") for i, n in enumerate(names)], *others)
    texts = [
        F.coalesce(_field_text(F.col(f"_found_{i}")), F.lit("")).alias(f"_static_{i + 1}") for i in range(len(names))
    ]
    kept = [c for c in found.columns if c not in ("folder", "file_name") and not c.startswith("_found_")]
    return found.select("folder", F.col("file_name").alias("_static_0"), *texts, *kept)


def static_fields(results: DataFrame, stype: StatementType) -> DataFrame:
    """Per file, each static field from the first document that has its key.

    A field that is present but empty stops the search and gives ``''``.
    """
    names = [STATIC_KEY, *_static_names(stype)]
    rows = _with_static(analysed(results), stype)
    return rows.select("folder", *[F.col(f"_static_{i}").alias(name) for i, name in enumerate(names)])


def _items(documents: Column) -> Column:
    """All documents' transactions; fields beside them needn't be read or made."""
    return F.flatten(F.filter(documents["transactions"], lambda t: t.isNotNull()))


def _exploded(rows: DataFrame) -> DataFrame:
    """One row per item.  The outer form keeps Spark from adding a filter that
    would build the array a second time just to see whether it is empty."""
    return rows.select("*", F.posexplode_outer("_items").alias(ROW_NO, "_item")).where(F.col(ROW_NO).isNotNull())


def _dynamic_columns(stype: StatementType, sign_mode: str) -> list[Column]:
    columns, ok = [], []
    for spec in stype.dynamic_fields:
        value = F.try_element_at(F.col("_item"), F.lit(spec.name))["value"]
        if spec.is_amount:
            ok.append(amounts.amount_ok(value))
            value = amounts.amount_value(value, sign_mode)
        columns.append(value.alias(spec.name))
    return [*columns, reduce(lambda a, b: a & b, ok, F.lit(True)).alias(SUCCESS)]


def transactions(results: DataFrame, stype: StatementType, sign_mode: str = "default") -> DataFrame:
    """One row per transaction with the configured dynamic fields.

    Amounts are doubles, null where the text holds no number; in that case
    ``ConversionSuccess`` is false.  ``row_no`` numbers a file's transactions.
    """
    return _exploded(analysed(results).select(*FILE_KEY, _items(F.col("documents")).alias("_items"))).select(
        "folder", F.col("file_name").alias(STATIC_KEY), F.col(ROW_NO).cast("long").alias(ROW_NO),
        *_dynamic_columns(stype, sign_mode),
    )


def _merged(static_names: list[str], dynamic_names: list[str]) -> list[str]:
    """Column order of static and dynamic fields put together."""
    return list(dict.fromkeys([*static_names, *dynamic_names]))


def transactions_with_static(results: DataFrame, stype: StatementType, sign_mode: str = "default") -> DataFrame:
    """Transactions with their file's static fields, without a join.

    On a name clash the transaction's field wins, in the static field's place.
    """
    names = [STATIC_KEY, *_static_names(stype)]
    rows = _exploded(_with_static(analysed(results), stype, _items(F.col("documents")).alias("_items")))
    dynamic = [*[f.name for f in stype.dynamic_fields], SUCCESS]
    values = {name: F.col(f"_static_{i}") for i, name in enumerate(names)}
    values.update(zip(dynamic, _dynamic_columns(stype, sign_mode)))
    columns = [values[name].alias(name) for name in _merged(names, dynamic)]
    return rows.select("folder", F.col(ROW_NO).cast("long").alias(ROW_NO), *columns)


def attach_static(rows: DataFrame, static: DataFrame) -> DataFrame:
    """Join form of :func:`transactions_with_static` for two separate tables.

    Every transaction stays; one whose file has no static row has nulls there.
    """
    key = ["folder", STATIC_KEY]
    clash = [c for c in static.columns if c in rows.columns and c not in key]
    keyed = static.drop(*clash).withColumnsRenamed({c: f"_of_{c}" for c in key})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in key]
    joined = rows.join(keyed, same[0] & same[1], "left")
    order = _merged([c for c in static.columns if c != "folder"], [c for c in rows.columns if c not in ("folder", ROW_NO)])
    return joined.select("folder", ROW_NO, *map(quoted, order))


def _with_summaries(
    results: DataFrame, names: list[str], where: dict[str, Column] | None = None, kept: Sequence[str] = ()
) -> DataFrame:
    """Per name, ``_text_<i>`` and ``_confidence_<i>`` joined over all documents.

    The fields are looked up in one step and joined in the next, so that each
    lookup runs once; with ``where`` only in the rows that have the field.
    """

    def lookup(name: str) -> Column:
        found = _found_in_fields(name)
        return F.when(where[name], found) if where else found

    def joined(i: int) -> list[Column]:
        texts = F.filter(F.transform(f"_found_{i}", _field_text), lambda t: t.isNotNull())
        confidences = F.transform(f"_found_{i}", lambda f: F.coalesce(tx.float_text(f["confidence"]), F.lit("N/A")))
        return [
            F.array_join(texts, " ").alias(f"_text_{i}"),
            F.array_join(confidences, " ").alias(f"_confidence_{i}"),
        ]

    read = results.select("folder", "file_name", *kept, _fields())
    found = read.select("folder", "file_name", *kept, *[lookup(n).alias(f"_found_{i}") for i, n in enumerate(names)])
    pairs = [column for i in range(len(names)) for column in joined(i)]
    return found.select("folder", F.col("file_name").alias(SUMMARY_KEY), *kept, *pairs)


def summary_fields(results: DataFrame, stype: StatementType, sign_mode: str = "default") -> DataFrame:
    """Long form: one row per file and summary field.

    ``text`` joins the field's values over all documents with a space; for
    amount fields ``amount`` is the number read from it, for others ``text`` is
    stripped.
    """
    rows = []
    for i, spec in enumerate(stype.summary_fields):
        text = F.col(f"_text_{i}")
        rows.append(
            F.struct(
                F.lit(spec.name).alias("field_name"),
                F.lit(spec.is_amount).alias("is_amount"),
                (text if spec.is_amount else tx.strip(text)).alias("text"),
                (amounts.amount_value(text, sign_mode) if spec.is_amount else F.lit(None).cast("double")).alias("amount"),
                F.col(f"_confidence_{i}").alias("confidence"),
            )
        )
    if not rows:
        raise ValueError(f"statement type {stype.name!r} has no summary fields")
    found = _with_summaries(analysed(results), [f.name for f in stype.summary_fields])
    return found.select("folder", SUMMARY_KEY, F.inline(F.array(*rows)))


def summary_table(results: DataFrame, stype: StatementType, sign_mode: str = "default") -> DataFrame:
    """Wide form: ``DocumentName``, then ``<F>_Value`` and ``<F>_Confidence``.

    Amount fields have a numeric ``_Value`` and keep their source text in
    ``<F>_Text``.  A summary field called ``DocumentName`` gives way to the file name.
    """
    specs = [f for f in stype.summary_fields if f.name != SUMMARY_KEY]
    columns = []
    for i, spec in enumerate(specs):
        text = F.col(f"_text_{i}")
        if spec.is_amount:
            columns.append(amounts.amount_value(text, sign_mode).alias(f"{spec.name}_Value"))
            columns.append(text.alias(f"{spec.name}_Text"))
        else:
            columns.append(tx.strip(text).alias(f"{spec.name}_Value"))
        columns.append(F.col(f"_confidence_{i}").alias(f"{spec.name}_Confidence"))
    found = _with_summaries(analysed(results), [f.name for f in specs])
    return found.select("folder", SUMMARY_KEY, *columns)


def flatten_summary(long: DataFrame, stype: StatementType) -> DataFrame:
    """Pivot the long summary to the wide one; the columns are the configured fields."""
    specs = [f for f in stype.summary_fields if f.name != SUMMARY_KEY]
    aggregates = []
    for spec in specs:
        here = F.col("field_name") == spec.name
        if spec.is_amount:
            aggregates.append(F.max(F.when(here, F.col("amount"))).alias(f"{spec.name}_Value"))
            aggregates.append(F.max(F.when(here, F.col("text"))).alias(f"{spec.name}_Text"))
        else:
            aggregates.append(F.max(F.when(here, F.col("text"))).alias(f"{spec.name}_Value"))
        aggregates.append(F.max(F.when(here, F.col("confidence"))).alias(f"{spec.name}_Confidence"))
    return long.groupBy("folder", SUMMARY_KEY).agg(*aggregates)


def coerce_amounts(rows: DataFrame, stype: StatementType) -> DataFrame:
    """Amount columns as doubles; text that is not a number becomes null."""
    types = dict(rows.dtypes)
    replaced = {
        name: amounts.to_number(quoted(name)) for name in stype.amount_columns if types.get(name) == "string"
    }
    return rows.withColumns(replaced) if replaced else rows


def raw_text(results: DataFrame) -> DataFrame:
    """All lines of a document in page order, joined by newlines."""
    lines = F.flatten(F.transform("pages", lambda p: F.transform(p["lines"], lambda x: x["content"])))
    return results.where(F.col("pages").isNotNull()).select(
        "folder",
        F.col("file_name").alias("Document Name"),
        F.array_join(lines, "\n").alias("Extracted Text"),
    )


def _in_order(cells: Column) -> Column:
    """Cells in (row, column) order."""
    placed = F.transform(
        cells,
        lambda c, i: F.struct(
            c["row_index"].alias("row"), c["column_index"].alias("col"), i.alias("seen"), c["content"].alias("content")
        ),
    )
    return F.sort_array(placed)


def _row_starts(ordered: Column) -> Column:
    """Where rows begin in ordered cells; null if there are no cells."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size(ordered) - 1),
        lambda i: (i == 0) | (F.get(ordered, i)["row"] != F.get(ordered, i - 1)["row"]),
    )
    return F.when(F.size(ordered) > 0, starts)


def _cut_rows(ordered: Column, begins: Column) -> Column:
    """Ordered cells, cut into one array of contents per row."""
    return F.transform(
        begins,
        lambda b, k: F.struct(
            F.get(ordered, b)["row"].alias("row_index"),
            F.transform(
                F.slice(ordered, b + 1, F.coalesce(F.get(begins, k + 1), F.size(ordered)) - b), lambda c: c["content"]
            ).alias("contents"),
        ),
    )


def table_rows(results: DataFrame) -> DataFrame:
    """One row per non-empty table row: its cell contents in column order.

    Missing cells are not padded.  The work stays inside each result row.
    Tables are taken apart by outer forms: the others have Spark make them twice,
    once to see whether there are any. Rows that these add have no cells.
    Ordered cells and the starts of rows are columns, each used more than once;
    bound inside a lambda, all that is made from them would be copied for each binding.
    """
    tables = results.select(*FILE_KEY, F.posexplode_outer("tables").alias("table_idx", "_table"))
    ordered = tables.select(*FILE_KEY, "table_idx", _in_order(F.col("_table.cells")).alias("_cells"))
    begun = ordered.withColumn("_begins", _row_starts(F.col("_cells")))
    rows = begun.select(*FILE_KEY, "table_idx", F.explode_outer(_cut_rows(F.col("_cells"), F.col("_begins"))).alias("_row"))
    return rows.where(F.col("_row").isNotNull()).select(*FILE_KEY, "table_idx", "_row.row_index", "_row.contents")


# Several statement types in one table


def of_types(results: DataFrame, types: Sequence[StatementType], type_column: str) -> Column:
    return F.coalesce(F.col(type_column).isin([t.name for t in types]), F.lit(False))


def _layout(of_type: dict[str, dict[str, str]]) -> dict[str, dict[str, list[str]]]:
    """Columns in the order in which types bring them, each with its kinds and their types."""
    layout: dict[str, dict[str, list[str]]] = {}
    for type_name, columns in of_type.items():
        for name, kind in columns.items():
            layout.setdefault(name, {}).setdefault(kind, []).append(type_name)
    return layout


def _owners(of_type: dict[str, list[str]]) -> dict[str, list[str]]:
    """Field names in order, each with the types that have it."""
    owners: dict[str, list[str]] = {}
    for type_name, names in of_type.items():
        for name in names:
            owners.setdefault(name, []).append(type_name)
    return owners


def transactions_of_types(
    results: DataFrame, types: Sequence[StatementType], type_column: str, sign_mode: str = "default"
) -> DataFrame:
    """Transactions with static fields, of results whose type a column names, in one projection over one read.

    Columns are those of all types, null in rows of types that lack them. A
    column that is an amount in some types and text in others is text.
    """
    static = _owners({t.name: _static_names(t) for t in types})
    amounts_of = {t.name: set(t.amount_columns) for t in types}

    def kinds(t: StatementType) -> dict[str, str]:
        # A transaction's field wins over a static one; amounts that come as text must be plain numbers.
        found = {STATIC_KEY: "file"} | {name: "static" for name in _static_names(t)}
        found |= {f.name: "amount" if f.is_amount else "dynamic" for f in t.dynamic_fields} | {SUCCESS: "ok"}
        names = _merged([STATIC_KEY, *_static_names(t)], [*(f.name for f in t.dynamic_fields), SUCCESS])
        number = {n for n in names if n in amounts_of[t.name] and found[n] in ("static", "dynamic")}
        return {n: f"number of {found[n]}" if n in number else found[n] for n in names}

    wanted = analysed(results).where(of_types(results, types, type_column))
    read = wanted.select(*FILE_KEY, F.col(type_column).alias("_type"), _items(F.col("documents")).alias("_items"), _fields())
    found = read.select(
        *FILE_KEY,
        "_type",
        "_items",
        *[F.when(F.col("_type").isin(owners), _static_column(n)).alias(f"_found_{i}") for i, (n, owners) in enumerate(static.items())],
    )
    texts = [F.coalesce(_field_text(F.col(f"_found_{i}")), F.lit("")).alias(f"_static_{i}") for i in range(len(static))]
    rows = _exploded(found.select(*FILE_KEY, "_type", "_items", *texts))

    def item(name: str) -> Column:
        return F.try_element_at(F.col("_item"), F.lit(name))["value"]

    success = None
    for t in types:
        ok = reduce(lambda a, b: a & b, [amounts.amount_ok(item(f.name)) for f in t.dynamic_fields if f.is_amount], F.lit(True))
        here = F.col("_type") == t.name
        success = F.when(here, ok) if success is None else success.when(here, ok)
    index = {name: i for i, name in enumerate(static)}

    def column(name: str, by_kind: dict[str, list[str]]) -> Column:
        if name == SUCCESS:
            return success
        text = F.col(f"_static_{index[name]}") if name in index else F.lit(None).cast("string")
        values = {
            "file": F.col("file_name"),
            "static": text,
            "number of static": amounts.to_number(text),
            "dynamic": item(name),
            "number of dynamic": amounts.to_number(item(name)),
            "amount": amounts.amount_value(item(name), sign_mode),
        }
        numeric = {"amount", "number of static", "number of dynamic"}
        if len({kind in numeric for kind in by_kind}) > 1:
            values = {kind: value.cast("string") for kind, value in values.items()}
        return reduce(lambda done, kind: done.when(F.col("_type").isin(by_kind[kind]), values[kind]), by_kind, F)

    layout = _layout({t.name: kinds(t) for t in types})
    columns = [column(name, by_kind).alias(name) for name, by_kind in layout.items()]
    return rows.select("folder", F.col(ROW_NO).cast("long").alias(ROW_NO), *columns)


def summaries_of_types(
    results: DataFrame, types: Sequence[StatementType], type_column: str, sign_mode: str = "default"
) -> DataFrame:
    """Wide summaries of results whose type a column names, in one projection over one read."""
    fields = {t.name: {f.name: f.is_amount for f in t.summary_fields if f.name != SUMMARY_KEY} for t in types}
    owners = _owners({name: list(specs) for name, specs in fields.items()})
    index = {name: i for i, name in enumerate(owners)}

    def kinds(specs: dict[str, bool]) -> dict[str, str]:
        found = {}
        for name, is_amount in specs.items():
            found[f"{name}_Value"] = "amount" if is_amount else "text"
            if is_amount:
                found[f"{name}_Text"] = "source"
            found[f"{name}_Confidence"] = "confidence"
        return found

    field_of = {c: n for n in owners for c in (f"{n}_Value", f"{n}_Text", f"{n}_Confidence")}
    wanted = analysed(results).where(of_types(results, types, type_column)).withColumn("_type", F.col(type_column))
    found = _with_summaries(wanted, list(owners), {n: F.col("_type").isin(o) for n, o in owners.items()}, ["_type"])

    def column(name: str, by_kind: dict[str, list[str]]) -> Column:
        i = index[field_of[name]]
        text = F.col(f"_text_{i}")
        values = {"amount": amounts.amount_value(text, sign_mode), "text": tx.strip(text), "source": text, "confidence": F.col(f"_confidence_{i}")}
        if len({kind == "amount" for kind in by_kind}) > 1:
            values["amount"] = values["amount"].cast("string")
        return reduce(lambda done, kind: done.when(F.col("_type").isin(by_kind[kind]), values[kind]), by_kind, F)

    layout = _layout({name: kinds(specs) for name, specs in fields.items()})
    return found.select("folder", SUMMARY_KEY, *[column(name, by_kind).alias(name) for name, by_kind in layout.items()])


def union_runs(runs: list[DataFrame]) -> DataFrame:
    """Rows of all runs; columns a run lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)


def extraction_totals(results: DataFrame) -> DataFrame:
    """Files given, files that failed, and summaries and transactions extracted."""
    # The lists are null where documents are, and nothing but their lengths is read.
    lists = results.select(F.col("documents")["transactions"].alias("_lists"))
    sizes = F.transform("_lists", lambda t: F.when(t.isNotNull(), F.size(t)).otherwise(F.lit(0)).cast("long"))
    items = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, n: a + n)
    counted = lists.select(F.col("_lists").isNotNull().alias("ok"), F.coalesce(items, F.lit(0)).alias("items"))
    return counted.agg(
        F.count("*").alias("files"),
        F.count(F.when(~F.col("ok"), 1)).alias("failed"),
        F.count(F.when(F.col("ok"), 1)).alias("summaries"),
        F.coalesce(F.sum("items"), F.lit(0)).cast("long").alias("transactions"),
    )
