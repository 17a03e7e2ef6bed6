"""OCR responses: blocks to pages, lines, form fields and tables.

``blocks`` has one row per block: ``documentId``, ``pos`` (position in the
response, from 0) and the block fields. Parent and child blocks meet in joins
on (documentId, block id): one for what lists blocks (form keys, tables), one
for what lists words. Blocks are moved once, to the partition of their document,
where all joins and groups of an operator follow; documents of more than
``HOT_BLOCKS`` blocks are spread by block id instead. What
is gathered into arrays is bounded by the id list of one block, or by one page,
which is one row of text as in the files that are written from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.operators.keyed import may_be_among
from docflow.operators.ordered import SLICE_ROWS, collect_in_order, latest_by_key, running

HOT_BLOCKS = 200_000  # documents above it are spread over many tasks


# --- blocks -------------------------------------------------------------------

def explode_blocks(responses: DataFrame) -> DataFrame:
    """One row per block of a response (``documentId``, ``Blocks``), in order."""
    return responses.select("documentId", F.posexplode("Blocks").alias("pos", "b")).select(
        "documentId", F.col("pos").cast("bigint").alias("pos"), "b.*"
    )


def geometry_columns(blocks: DataFrame) -> DataFrame:
    """Flatten the geometry to box columns and the polygon's points."""
    box = "Geometry.BoundingBox"
    return blocks.select(
        "*",
        *[F.col(f"{box}.{c}").alias(c.lower()) for c in ("Width", "Height", "Left", "Top")],
        F.coalesce(F.col("Geometry.Polygon"), F.array().cast("array<struct<X:double,Y:double>>")).alias("polygon"),
    )


def _ids(rel_type: str, which: str = "all") -> Column:
    """Ids listed by a block's relationships of one type: all of them, or the last list.

    Null where there is no such relationship.
    """
    lists = F.transform(
        F.filter("Relationships", lambda r: r["Type"] == rel_type),
        lambda r: F.coalesce(r["Ids"], F.array().cast("array<string>")),
    )
    if which == "last":
        return F.try_element_at(lists, F.lit(-1))
    return F.when(F.size(lists) > 0, F.flatten(lists))


def _is_word() -> Column:
    return F.col("BlockType") == "WORD"


def _token() -> Column:
    """What a block adds to a text: its own text or its selection status, null for other blocks."""
    return F.when(_is_word(), F.col("Text")).when(F.col("BlockType") == "SELECTION_ELEMENT", F.col("SelectionStatus"))


Place = Callable[[DataFrame], DataFrame]


def _by_document(rows: DataFrame) -> DataFrame:
    return rows.repartition("documentId")


def _spread(blocks: DataFrame, work: Callable[[DataFrame, Place], DataFrame]) -> DataFrame:
    """``work(blocks, place)``: ordinary documents are placed in one partition each, hot ones wherever joins put them."""
    hot = blocks.where((F.col("pos") >= HOT_BLOCKS) & F.col("documentId").isNotNull()).select("documentId").distinct()
    if hot.isEmpty():
        return work(blocks, _by_document)
    hot = F.broadcast(hot)  # at most one document for every HOT_BLOCKS blocks
    return work(blocks.join(hot, "documentId", "left_anti"), _by_document).unionByName(
        work(blocks.join(hot, "documentId", "left_semi"), lambda rows: rows))


def _nodes(blocks: DataFrame, place: Place, **child: Column) -> DataFrame:
    """What lists may stand for: the ``child`` columns of every block with an id.

    They move as plain columns, texts last, which takes less room than a struct in each row.
    """
    known = blocks.where(F.col("documentId").isNotNull() & F.col("Id").isNotNull() & F.col("BlockType").isNotNull()).select(
        "documentId", "pos", "Id", *[c.alias(f"_{n}") for n, c in child.items()])
    texts = [n for n, kind in known.dtypes if kind == "string"]
    moved = place(known.select(*[c for c in known.columns if c not in texts], *texts))
    return moved.select("documentId", "Id", F.struct("pos", *[F.col(f"_{n}").alias(n) for n in child]).alias("_child"))


def _resolve(listed: DataFrame, nodes: DataFrame, how: str = "inner") -> DataFrame:
    """Add to every listed ``Id`` the child columns of the block that it stands for.

    Of blocks with the same id the last one counts, whatever its type; it is
    chosen among the listed ones after the join, so blocks that nothing lists
    are moved once and never counted. ``listed`` holds narrow, distinct rows.
    """
    names = [f.name for f in nodes.schema["_child"].dataType.fields if f.name != "pos"]  # the block's own place is ``childPos``
    found = listed.join(nodes, ["documentId", "Id"], how)
    one = found.groupBy("documentId", "Id", *[c for c in listed.columns if c not in ("documentId", "Id")]).agg(
        F.max_by("_child", "_child.pos").alias("_child"))
    return one.select(*listed.columns, F.col("_child.pos").alias("childPos"), *[F.col("_child")[n].alias(n) for n in names])


def block_children(blocks: DataFrame, rel_type: str) -> DataFrame:
    """Children of every block by one relationship type, in listed order.

    Ids that no block carries are skipped.
    """
    def work(blocks, place):
        parents = place(blocks.select("documentId", "pos", F.col("BlockType").alias("parentType"), _ids(rel_type).alias("ids"))
                        .where(F.size("ids") > 0))
        listed = parents.select("documentId", "pos", "parentType", F.posexplode("ids").alias("ord", "Id"))
        return _resolve(listed, _nodes(
            blocks, place, childType=F.col("BlockType"), childText=F.col("Text"),
            childStatus=F.col("SelectionStatus"))).withColumnRenamed("Id", "childId")

    return _spread(blocks, work)


def extract_words(blocks: DataFrame) -> DataFrame:
    return blocks.where(F.col("BlockType") == "WORD").select(
        "documentId", "pos", "Id", "Text", "Confidence", "Geometry"
    )


def extract_selections(blocks: DataFrame) -> DataFrame:
    return blocks.where(F.col("BlockType") == "SELECTION_ELEMENT").select(
        "documentId", "pos", "Id", "SelectionStatus", "Confidence", "Geometry"
    )


# --- pages --------------------------------------------------------------------

def _opens() -> Column:
    """A PAGE block opens a page, and so does the first block of a document."""
    return (F.col("BlockType") == "PAGE") | (F.col("pos") == 0)


def _number_pages(rows: DataFrame, order: list[str], opens: Column, **kw) -> DataFrame:
    return (
        running(
            rows, ["documentId"], order,
            {"page": ("sum", opens.cast("int").cast("bigint")), "_start": ("max", F.when(opens, F.col("pos")))},
            slice_on=F.col("pos"), dense=True, **kw,
        )
        .withColumn("page", F.col("page").cast("int"))
        .withColumn("offset", F.col("pos") - F.col("_start"))
        .drop("_start")
    )


def segment_pages(blocks: DataFrame, **kw) -> DataFrame:
    """Add ``page``, from 1, and ``offset`` (position in the page).

    A PAGE block opens a page; blocks before the first PAGE form their own page.
    Rows may be left out beforehand, except PAGE blocks and the first block of
    a document.
    """
    return _number_pages(blocks, ["pos"], _opens(), **kw)


def page_starts(blocks: DataFrame) -> DataFrame:
    """The first block of every page."""
    return segment_pages(blocks.where(_opens()).select("documentId", "pos", "BlockType"))


def paged(
    rows: DataFrame, blocks: DataFrame, keep_marks: bool = False, slice_rows: int = SLICE_ROWS, offset: bool = False
) -> DataFrame:
    """Add page numbers to any rows that have ``documentId`` and ``pos``.

    The rows meet the page openings of ``blocks`` in one window; ``keep_marks``
    keeps the openings as rows without other values, ``offset`` the position in the page. The first block of every
    slice takes part in the totals, so a slice without openings has its carry.
    """
    marks = blocks.where(_opens()).select("documentId", "pos", F.lit(True).alias("_mark"))
    slices = blocks.where(F.col("pos") % slice_rows == 0).select("documentId", "pos", F.lit(False).alias("_mark"))
    mixed = rows.withColumn("_mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    numbered = _number_pages(
        mixed.withColumn("_rank", (~F.col("_mark")).cast("int")), ["pos", "_rank"], F.col("_mark"),
        contributors=marks.unionByName(slices), slice_rows=slice_rows,
    ).drop("_rank", *([] if offset else ["offset"]))
    return (numbered if keep_marks else numbered.where(~F.col("_mark"))).drop("_mark")


def page_lines(blocks: DataFrame) -> DataFrame:
    """LINE blocks with their page."""
    lines = blocks.where(F.col("BlockType") == "LINE").select("documentId", "pos", "Text")
    return paged(lines, blocks)


def extract_lines(blocks: DataFrame) -> DataFrame:
    """LINE blocks with their ordered words."""
    def work(blocks, place):
        lines = place(blocks.where(F.col("BlockType") == "LINE").select(
            "documentId", "pos", "Id", "Text", "Confidence", "Geometry", _ids("CHILD").alias("ids")))
        listed = lines.select("documentId", "pos", F.posexplode("ids").alias("ord", "Id"))
        found = _resolve(listed, _nodes(
            blocks, place, isWord=_is_word(), Confidence=F.when(_is_word(), F.col("Confidence")), Text=F.when(_is_word(), F.col("Text")))).where("isWord")
        content = found.withColumn("word", F.struct("Id", "Text", "Confidence")).groupBy("documentId", "pos").agg(
            collect_in_order("ord", "word").alias("words"))
        none = F.array().cast(dict(content.dtypes)["words"])
        return lines.drop("ids").join(content, ["documentId", "pos"], "left").withColumn(
            "words", F.coalesce("words", none))

    return _spread(blocks, work)


def page_text(lines: DataFrame) -> DataFrame:
    """Text of each page: every line in block order, each followed by a line feed."""
    return lines.groupBy("documentId", "page").agg(
        F.concat(F.array_join(collect_in_order("pos", "Text"), "\n"), F.lit("\n")).alias("text")
    )


# --- forms --------------------------------------------------------------------

def _key_blocks(blocks: DataFrame) -> DataFrame:
    """KEY blocks that have a CHILD list; others have no key and are left out."""
    return blocks.where(
        (F.col("BlockType") == "KEY_VALUE_SET") & F.array_contains("EntityTypes", "KEY")
    ).withColumn("keyIds", _ids("CHILD", "last")).where(F.col("keyIds").isNotNull())


def _texts(parents: DataFrame, blocks: DataFrame, place: Place) -> DataFrame:
    """Words and selections that each parent (``pos``, ``ids``) lists, joined by a space.

    ``words`` leaves out selections; a parent that lists nothing known has
    empty texts. A group holds the id list of one parent.
    """
    listed = parents.select("documentId", "pos", F.posexplode_outer("ids").alias("ord", "Id"))
    found = _resolve(listed, _nodes(blocks, place, word=_is_word(), token=_token()), "left")

    def joined(kept):
        tokens = F.sort_array(F.collect_list(F.when(kept, F.struct("ord", "token"))))
        return F.array_join(F.transform(tokens, lambda t: t["token"]), " ")

    return found.groupBy("documentId", "pos").agg(
        joined(F.col("word")).alias("words"), joined(F.col("token").isNotNull()).alias("tokens")
    )


def field_key_text(blocks: DataFrame) -> DataFrame:
    """Key text of each form field: its words joined by a space, possibly empty."""
    def work(blocks, place):
        keys = place(_key_blocks(blocks).select("documentId", "pos", "Id", "Confidence", F.col("keyIds").alias("ids")))
        texts = _texts(keys.select("documentId", "pos", "ids"), blocks, place)
        return keys.drop("ids").join(texts, ["documentId", "pos"]).select(
            "documentId", "pos", "Id", "Confidence", F.col("words").alias("key"))

    return _spread(blocks, work)


def _value_ids() -> Column:
    """The CHILD list of a VALUE block; null for other blocks."""
    return F.when(F.array_contains("EntityTypes", "VALUE"), _ids("CHILD", "last"))


def key_value_pairs(blocks: DataFrame) -> DataFrame:
    """The VALUE block that counts for each KEY block: the last with a CHILD list."""
    return _spread(blocks, _pairs)


def _pairs(blocks: DataFrame, place: Place) -> DataFrame:
    keys = place(_key_blocks(blocks).select("documentId", F.col("pos").alias("keyPos"), _ids("VALUE").alias("ids")))
    listed = keys.select("documentId", "keyPos", F.posexplode("ids").alias("ord", "Id"))
    found = _resolve(listed, _nodes(blocks, place, valueIds=_value_ids())).where(
        F.col("valueIds").isNotNull()).withColumnRenamed("childPos", "valuePos")
    return (
        found.groupBy("documentId", "keyPos")
        .agg(F.max_by(F.struct("Id", "valuePos", "valueIds"), F.col("ord")).alias("v"))
        .select("documentId", "keyPos", F.col("v.Id").alias("valueId"), "v.valuePos", "v.valueIds")
    )


def field_value_text(blocks: DataFrame) -> DataFrame:
    """Value text of each KEY block that has a value: words and selections joined by a space."""
    def work(blocks, place):
        pairs = _pairs(blocks, place).select(
            "documentId", F.col("keyPos").alias("pos"), "valueId", F.col("valueIds").alias("ids"))
        texts = _texts(pairs.select("documentId", "pos", "ids"), blocks, place)
        return pairs.drop("ids").join(texts, ["documentId", "pos"]).select(
            "documentId", "pos", "valueId", F.col("tokens").alias("value"))

    return _spread(blocks, work)


def _structures(blocks: DataFrame, forms: bool = True, tables: bool = True, mixed: bool = False) -> DataFrame:
    """Form fields and tables at their ``pos``: ``kind``, ``key``, ``value``, ``rows``.

    One resolution finds the value blocks of keys and the cells of tables, a
    second one all words that keys, values and cells list; both read the same
    nodes, which are moved once. What belongs to one
    key or table then stays in one partition: texts, rows and tables need no
    further shuffle. Groups are bounded by the id lists of one block and of the
    blocks it lists. Where documents without keys and tables are ``mixed`` in,
    most of their blocks are passed over before anything moves.
    """
    def work(part, place):
        if mixed:
            parents = part.where(_lists_blocks(forms, tables)).select("documentId")
            part = may_be_among(part, parents, "documentId")
        return _structures_of(part, place, forms, tables)

    return _spread(blocks, work)


def _lists_blocks(forms: bool, tables: bool) -> Column:
    """KEY blocks with a CHILD list and TABLE blocks."""
    key = (F.col("BlockType") == "KEY_VALUE_SET") & F.array_contains("EntityTypes", "KEY") & _ids("CHILD", "last").isNotNull()
    table = F.col("BlockType") == "TABLE"
    return key if not tables else (table if not forms else key | table)


def _structures_of(blocks: DataFrame, place: Place, forms: bool, tables: bool) -> DataFrame:
    table = F.col("BlockType") == "TABLE"
    none = F.array().cast("array<string>")
    parents = place(blocks.where(_lists_blocks(forms, tables)).select(
        "documentId", F.col("pos").alias("parent"), table.alias("isTable"),
        F.when(table, _ids("CHILD")).otherwise(_ids("VALUE")).alias("below"),
        # a key's own text, and a mark of every table: with a list of cells or without
        F.when(~table, "key").when(_ids("CHILD").isNotNull(), "listed").otherwise("table").alias("own"),
        F.when(~table, _ids("CHILD", "last")).alias("ownIds")))
    # the block itself, at -1, goes along with what it lists
    entry = "struct<nth:int,Id:string,own:string,ownIds:array<string>>"
    entries = F.concat(
        F.array(F.struct(F.lit(-1), F.lit(None), "own", "ownIds").cast(entry)),
        F.transform(F.coalesce("below", none), lambda x, n: F.struct(n, x, F.lit(None), F.lit(None)).cast(entry)))
    listed = parents.select("documentId", "parent", "isTable", F.inline(entries))
    itself = F.col("nth") == -1
    nodes = _nodes(
        blocks, place, known=F.lit(True), valueIds=_value_ids(), cellIds=_ids("CHILD"), RowIndex=F.col("RowIndex"),
        word=_is_word(), token=_token())
    ids = F.when(itself, F.col("ownIds")).when(F.col("isTable"), F.coalesce("cellIds", none)).otherwise(F.col("valueIds"))
    below = _resolve(listed, nodes, "left").withColumn("ids", ids).where(
        itself | (F.col("known") & F.col("ids").isNotNull())).select(
        "documentId", "parent", F.when(itself, F.col("own")).when(F.col("isTable"), "cell").otherwise("value").alias("side"),
        "nth", F.when(~itself, F.col("RowIndex")).alias("row"), "ids")
    words = below.select("documentId", "parent", "side", "nth", "row", F.posexplode_outer("ids").alias("ord", "Id"))
    found = _resolve(words, nodes, "left")

    def tokens(kept, value):
        items = F.sort_array(F.collect_list(F.when(kept & F.col("token").isNotNull(), F.struct("ord", value.alias("token")))))
        return F.transform(items, lambda t: t["token"])

    cell = F.col("side") == "cell"
    near = found if place is _by_document else found.repartition("documentId", "parent")
    texts = near.groupBy("documentId", "parent", "side", "nth", "row").agg(
        F.array_join(tokens(~cell & ((F.col("side") == "value") | F.col("word")), F.col("token")), " ").alias("text"),
        F.array_join(tokens(cell, F.concat("token", F.when(F.col("word"), " ").otherwise(", "))), "").alias("cell"),
    )
    rows = _table_rows(texts, ["documentId", "parent"], "nth", "row").groupBy("documentId", "parent", "side", "rowOrd").agg(
        F.max_by("text", "nth").alias("text"), collect_in_order("nth", "cell").alias("cells"))
    no_rows, empty_row = F.array().cast("array<array<string>>"), F.array(none)
    whole = rows.groupBy("documentId", "parent").agg(
        F.max(F.when(F.col("side") == "key", F.col("text"))).alias("key"),
        F.max(F.when(F.col("side") == "value", F.col("text"))).alias("value"),
        F.max(F.col("side").isin("listed", "table")).alias("_table"), F.max(F.col("side") == "listed").alias("_listed"),
        F.min(F.when(F.col("side") == "cell", F.col("rowOrd"))).alias("_first"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("side") == "cell", F.struct("rowOrd", "cells")))),
                    lambda r: r["cells"]).alias("_rows"),
    )
    return whole.select(
        "documentId", F.col("parent").alias("pos"), F.when(F.col("_table"), "table").otherwise("field").alias("kind"),
        "key", "value",
        F.when(~F.col("_table"), None).when(F.col("_first").isNull(), F.when(F.col("_listed"), empty_row).otherwise(no_rows))
        .when(F.col("_first") > 1, F.concat(empty_row, F.col("_rows"))).otherwise(F.col("_rows")).alias("rows"),
    )


def extract_form_fields(blocks: DataFrame) -> DataFrame:
    """Form fields with their page; ``value`` is null for a key without a value."""
    fields = _structures(blocks, tables=False).select("documentId", "pos", "key", "value")
    return paged(fields, blocks)


def form_map(fields: DataFrame) -> DataFrame:
    """Fields by key text; of fields with the same key on a page the last one counts."""
    return latest_by_key(fields, ["documentId", "page", "key"], "pos")


def get_field(fields: DataFrame, key: str) -> DataFrame:
    """The field with exactly this key on each page."""
    return form_map(fields.where(F.col("key") == key))


def search_fields(fields: DataFrame, text: str) -> DataFrame:
    """Fields whose key contains the text, whatever the case."""
    return fields.where(F.contains(F.lower("key"), F.lower(F.lit(text))))


def forms_rows(fields: DataFrame) -> DataFrame:
    """``[key, value]`` rows of each page in block order; a missing value is empty."""
    rows = fields.withColumn("row", F.array("key", F.coalesce("value", F.lit(""))))
    return rows.groupBy("documentId", "page").agg(collect_in_order("pos", "row").alias("forms"))


# --- tables -------------------------------------------------------------------

def _cell_texts(cells: DataFrame, keys: list[str], blocks: DataFrame, place: Place) -> DataFrame:
    """Text of each cell (``keys``, ``ids``): each word and a space, each selection and a comma and space."""
    listed = cells.select("documentId", *keys, F.posexplode_outer("ids").alias("ord", "Id"))
    found = _resolve(listed, _nodes(blocks, place, word=_is_word(), token=_token()), "left")
    text = F.concat("token", F.when(F.col("word"), " ").otherwise(", "))
    tokens = F.sort_array(F.collect_list(F.when(F.col("token").isNotNull(), F.struct("ord", text.alias("token")))))
    return found.groupBy("documentId", *keys).agg(
        F.array_join(F.transform(tokens, lambda t: t["token"]), "").alias("text"))


def cell_text(blocks: DataFrame) -> DataFrame:
    """Text of every CELL block."""
    def work(blocks, place):
        cells = place(blocks.where(F.col("BlockType") == "CELL").select("documentId", "pos", _ids("CHILD").alias("ids")))
        return _cell_texts(cells, ["pos"], blocks, place)

    return _spread(blocks, work)


def extract_cells(blocks: DataFrame) -> DataFrame:
    """CELL blocks with their indexes, spans and text."""
    cells = blocks.where(F.col("BlockType") == "CELL").select(
        "documentId", "pos", "Id", "RowIndex", "ColumnIndex", "RowSpan", "ColumnSpan", "Confidence"
    )
    return cells.join(cell_text(blocks), ["documentId", "pos"])


def table_cells(blocks: DataFrame) -> DataFrame:
    """Cells of every TABLE in listed order, with ``cellOrd`` and text."""
    def work(blocks, place):
        tables = place(blocks.where(F.col("BlockType") == "TABLE").select(
            "documentId", F.col("pos").alias("tablePos"), _ids("CHILD").alias("ids")))
        listed = tables.select("documentId", "tablePos", F.posexplode("ids").alias("cellOrd", "Id"))
        cells = _resolve(listed, _nodes(blocks, place, RowIndex=F.col("RowIndex"), ids=_ids("CHILD")))
        return _cell_texts(cells, ["tablePos", "cellOrd", "RowIndex"], blocks, place)

    return _spread(blocks, work)


def _table_rows(cells: DataFrame, table: list[str], order: str, row: str) -> DataFrame:
    w = Window.partitionBy(*table).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    top = F.max(F.greatest(F.coalesce(row, F.lit(1)), F.lit(1))).over(upto)
    return (
        cells.withColumn("_top", top)
        .withColumn("_opens", (F.col("_top") > F.lag("_top", 1, 1).over(w)).cast("int"))
        .withColumn("rowOrd", (F.sum("_opens").over(upto) + 1).cast("int"))
        .drop("_top", "_opens")
    )


def segment_table_rows(cells: DataFrame) -> DataFrame:
    """Add ``rowOrd``, from 1: a cell with a RowIndex above the running row opens a row.

    The running row starts at 1, so a first cell beyond it leaves an empty first
    row. The window is bounded by the id list of one TABLE block.
    """
    return _table_rows(cells, ["documentId", "tablePos"], "cellOrd", "RowIndex")


def extract_tables(blocks: DataFrame) -> DataFrame:
    """``rows`` of cell texts for every TABLE, with its page."""
    tables = _structures(blocks, forms=False).select("documentId", "pos", "rows")
    return paged(tables, blocks).withColumnRenamed("pos", "tablePos")


def table_csv_rows(tables: DataFrame) -> DataFrame:
    """CSV rows of each table: a title row, its rows, two empty rows."""
    return tables.withColumn("csv", _csv(F.col("rows")))


def tables_rows(tables: DataFrame) -> DataFrame:
    """CSV rows of all tables of each page, in block order."""
    return table_csv_rows(tables).groupBy("documentId", "page").agg(
        F.flatten(collect_in_order("tablePos", "csv")).alias("table")
    )


# --- whole pages ----------------------------------------------------------------

def _csv(rows: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.concat(F.array(F.array(F.lit("Table"))), rows, F.array(empty, empty))


def content(blocks: DataFrame, forms: bool = True, tables: bool = True) -> DataFrame:
    """Lines, fields and tables of all documents at their ``pos``, without pages."""
    none = F.lit(None)
    lines = blocks.where(F.col("BlockType") == "LINE").select(
        "documentId", "pos", F.lit("line").alias("kind"), F.col("Text").alias("text"),
        none.cast("string").alias("value"), none.cast("array<array<string>>").alias("rows"),
    )
    if not (forms or tables):
        return lines
    others = _structures(blocks, forms, tables, mixed=True).select(
        "documentId", "pos", "kind", F.col("key").alias("text"), "value",
        F.when(F.col("kind") == "table", _csv(F.col("rows")))
        .otherwise(F.array(F.array("key", F.coalesce("value", F.lit(""))))).alias("rows"),
    )
    return lines.unionByName(others)


def page_content(blocks: DataFrame) -> DataFrame:
    """Lines, tables and fields of each page mixed in block order (``pos``).

    ``text`` is the line, the field's key, or null; ``value`` the field's value;
    ``rows`` holds table rows or the field's key and value.
    """
    return paged(content(blocks), blocks)


def pages(blocks: DataFrame) -> DataFrame:
    """One row per page: its text, form rows and table rows.

    All content gets its page in one window and meets in one aggregation.
    """
    def gather(kind, value):
        return F.transform(F.sort_array(F.collect_list(
            F.when(F.col("kind") == kind, F.struct("pos", F.col(value).alias("v")))
        )), lambda x: x["v"])

    return paged(content(blocks), blocks, keep_marks=True).groupBy("documentId", "page").agg(
        F.array_join(F.transform(gather("line", "text"), lambda t: F.concat(t, F.lit("\n"))), "").alias("text"),
        F.flatten(gather("table", "rows")).alias("table"),
        F.flatten(gather("field", "rows")).alias("forms"),
    )
