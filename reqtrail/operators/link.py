"""Cross-links between requisitions and purchase orders."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqtrail.operators.chunks import set_in_chunks
from reqtrail.operators.keyed import ColLike, last_per_key
from reqtrail.operators.nest import set_in_array

SRC = "_x_present"


def attach_link(lines: DataFrame, crosswalk: DataFrame, line_keys: Sequence[str], xwalk_keys: Sequence[str],
                link_cols: dict[str, str], order: Sequence[ColLike]) -> DataFrame:
    """J4/K9 on the flat line table.

    The crosswalk is reduced to its last row per key (repeated updates: last wins),
    then every line with that key gets the link; lines without a crosswalk row keep
    the link they had (or NULL). ``link_cols`` maps crosswalk column -> line column.
    """
    line_keys, xwalk_keys = list(line_keys), list(xwalk_keys)
    notnull = F.lit(True)
    for k in xwalk_keys:
        notnull = notnull & F.col(k).isNotNull()
    x = last_per_key(crosswalk.where(notnull), xwalk_keys, order, cols=list(link_cols))
    x = x.select(*[F.col(a).alias(b) for a, b in zip(xwalk_keys, line_keys)],
                 *[F.col(src).alias("_x_" + dst) for src, dst in link_cols.items()]).withColumn(SRC, F.lit(True))
    j = lines.join(x, line_keys, "left")
    present = F.coalesce(F.col(SRC), F.lit(False))
    out = [F.col(c) for c in lines.columns if c not in link_cols.values()]
    for dst in link_cols.values():
        old = F.col(dst) if dst in lines.columns else F.lit(None)
        out.append(F.when(present, F.col("_x_" + dst)).otherwise(old).alias(dst))
    return j.select(*out)


def attach_link_nested(docs: DataFrame, crosswalk: DataFrame, doc_keys: Sequence[str], xwalk_keys: Sequence[str],
                       arr: str, elem_key: str, xwalk_elem_key: str, field: str, link_cols: dict[str, str],
                       order: Sequence[ColLike], doc_id: Sequence[str] | None = None, chunk: str | None = None) -> DataFrame:
    """K9: the same link written into the nested ``arr[*].field`` struct of each document.

    ``doc_id``: the subset of ``doc_keys`` that identifies a document (see ``set_in_array``).
    ``chunk``: the chunk column where ``docs`` are chunked children (see ``chunks``).
    """
    doc_keys, xwalk_keys = list(doc_keys), list(xwalk_keys)
    all_keys = xwalk_keys + [xwalk_elem_key]
    notnull = F.lit(True)
    for k in all_keys:
        notnull = notnull & F.col(k).isNotNull()
    x = last_per_key(crosswalk.where(notnull), all_keys, order, cols=list(link_cols))
    x = x.select(*[F.col(a).alias(b) for a, b in zip(xwalk_keys, doc_keys)], F.col(xwalk_elem_key).alias("_lk"),
                 *[F.col(src).alias(dst) for src, dst in link_cols.items()])
    if chunk:
        return set_in_chunks(docs, x, doc_keys, arr, elem_key, "_lk", field, list(link_cols.values()), chunk)
    return set_in_array(docs, x, doc_keys, arr, elem_key, "_lk", field, list(link_cols.values()),
                        partition_keys=doc_id)
