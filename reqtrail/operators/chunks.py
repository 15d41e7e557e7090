"""A1, K9, T6 for documents that are larger than a row: children in chunks of a bounded number of elements.

A document's children are rows (keys, chunk, array). A chunk holds the elements at positions ``chunk * rows`` to
``chunk * rows + rows - 1`` of the document, so chunks laid end to end are the array that ``nest`` builds. Positions come from
the sequencer and chunks are grouped by (keys, chunk): a document with a third of all rows is spread over tasks at every step.

Defined cases: a header without children, or with a NULL key, has one empty chunk 0; children without a header are left out, as in
``nest.nest_lines``; order must tell rows apart (as in ``sequence_groups``); an empty table gives no chunks.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqtrail.operators.keyed import ColLike
from reqtrail.operators.nest import positions

CHUNK_ROWS = 4096


def chunk_lines(lines: DataFrame, keys: Sequence[str], order: Sequence[ColLike], fields: Sequence[str], as_name: str = "lines",
                chunk: str = "chunk", rows: int = CHUNK_ROWS) -> DataFrame:
    """A1: (keys, chunk, array) of the children alone; map tasks send partial arrays."""
    keys = list(keys)
    placed = positions(lines, keys, order, "_pos").withColumn(chunk, F.expr(f"_pos div {rows}").cast("int"))
    arr = F.sort_array(F.collect_list(F.struct("_pos", *[F.col(f) for f in fields])))
    return (placed.groupBy(*keys, chunk).agg(arr.alias("_a"))
                  .select(*keys, chunk, F.transform("_a", lambda e: e.dropFields("_pos")).alias(as_name)))


def with_header(header: DataFrame, chunks: DataFrame, keys: Sequence[str], as_name: str = "lines", chunk: str = "chunk") -> DataFrame:
    """Every header next to each of its chunks. The join is INNER, so AQE can divide the chunks of one document; headers
    without children are found by the documents' first chunks."""
    keys = list(keys)
    none = header.join(chunks.where(F.col(chunk) == 0).select(*keys), keys, "left_anti").select(
        *header.columns, F.lit(0).alias(chunk), F.array().cast(chunks.schema[as_name].dataType).alias(as_name))
    return header.join(chunks, keys).select(*header.columns, chunk, as_name).unionByName(none)


def unchunk_lines(chunks: DataFrame, keys: Sequence[str], arr: str, chunk: str = "chunk", pos: str = "pos",
                  rows: int = CHUNK_ROWS) -> DataFrame:
    """Inverse of ``chunk_lines``: one row per element with its 0-based position in the document."""
    flat = chunks.select(*keys, F.col(chunk).alias("_c"), F.posexplode(arr).alias("_i", "_e"))
    return flat.select(*keys, (F.col("_c") * rows + F.col("_i")).cast("int").alias(pos), "_e.*")


def set_in_chunks(chunks: DataFrame, links: DataFrame, keys: Sequence[str], arr: str, elem_key: str, link_key: str, field: str,
                  value_cols: Sequence[str], chunk: str = "chunk") -> DataFrame:
    """K9: ``nest.set_in_array`` by chunk. Every element meets its link in a join on (keys, element key); a chunk gets the links of its
    elements in their order and is zipped with them, so an element costs the same however many links its chunk has.

    ``links``: one row per (keys, link_key); a (keys, chunk) that comes twice, or a link that does, is an error."""
    keys = list(keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    elements = chunks.where(known).select(*keys, chunk, F.posexplode(F.transform(arr, lambda e: e[elem_key])).alias("_i", "_lk"))
    value = F.struct(*value_cols)
    links = links.where(known & F.col(link_key).isNotNull()).select(*keys, F.col(link_key).alias("_lk"), value.alias("_v"))
    # The join is LEFT, so that chunks get a value or NULL for each element; AQE can divide an element key that many elements have.
    found = (elements.join(links, [*keys, "_lk"], "left").groupBy(*keys, chunk)
                     .agg(F.sort_array(F.collect_list(F.struct("_i", "_v"))).alias("_found")))
    if field not in chunks.schema[arr].dataType.elementType.fieldNames():
        none = F.lit(None).cast(links.schema["_v"].dataType)
        chunks = chunks.withColumn(arr, F.transform(arr, lambda e: e.withField(field, none)))
    linked = F.zip_with(arr, "_found", lambda e, v: F.when(v["_v"].isNotNull(), e.withField(field, v["_v"])).otherwise(e))
    unlike = F.raise_error(F.lit("set_in_chunks: a chunk or a link comes twice")).cast(chunks.schema[arr].dataType)
    out = F.when(F.col("_found").isNull(), F.col(arr)).when(F.size("_found") == F.size(arr), linked).otherwise(unlike)
    return chunks.join(found, [*keys, chunk], "left").withColumn(arr, out).drop("_found")
