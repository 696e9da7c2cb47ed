"""Lines and records of text files in file order, without reading a file in one task."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clanweave.functions.ordered import ordered_scan
from clanweave.session import materialize

ORDER = ["_file", "_block", "_row"]


def records(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """``(_file, _block, _row, value)``: a total order within a file that follows the bytes.

    ``_block`` is the split's offset, ``_row`` rises within a split, so splits may be read in any order.
    """
    reader = spark.read if sep is None else spark.read.option("lineSep", sep)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"), "value"
    )


def line_ranks(lines: DataFrame, name: str) -> DataFrame:
    """Add the 1-based number of each line in its file; only blocks are ordered, no line is sorted or moved.

    ``lines`` must be stored (numbers of rows hold for one read) and whole files: the rows of a block follow one another, so its first one gives a line's place in it.
    """
    blocks = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = ordered_scan(blocks, ["_file"], ["_block"], sums={"_upto": F.col("_n")})
    before = materialize(before.select("_file", "_block", (F.col("_upto") - F.col("_n") - F.col("_first") + 1).alias("_add")), "blocks")
    return lines.join(before, ["_file", "_block"]).withColumn(name, F.col("_row") + F.col("_add")).drop("_add")


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = None
    for pdf in batches:
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        nxt = pdf.shift(-1)
        whole = (pdf["_k"] == 0) & (nxt["_k"] == 1) & (pdf["_rec"] == nxt["_rec"]) & (pdf["_file"] == nxt["_file"])
        alone = ~whole & ~whole.shift(1, fill_value=False)
        held = pdf[-1:] if len(pdf) and alone.iloc[-1] and pdf["_k"].iloc[-1] == 0 else None
        if held is not None:
            alone.iloc[-1] = False
        yield pd.DataFrame({"_file": pdf["_file"], "_rec": pdf["_rec"], "h": pdf["value"], "seq": nxt["value"]})[whole]
        yield _halves(pdf[alone])
    if held is not None:
        yield _halves(held)


def _halves(pdf: pd.DataFrame) -> pd.DataFrame:
    first = pdf["_k"] == 0
    return pd.DataFrame({"_file": pdf["_file"], "_rec": pdf["_rec"], "h": pdf["value"].where(first, None), "seq": pdf["value"].where(~first, None)})


def first_lines(lines: DataFrame, per: int) -> DataFrame:
    """``(_file, _rec, h, seq)``: the first two lines of every record of ``per`` lines, NULL where the file ends before.

    Lines that follow one another in a task are put together there; only records that two tasks hold parts of are dealt by record.
    """
    r = F.col("_r") - 1
    top = line_ranks(lines, "_r").select("_file", F.floor(r / per).alias("_rec"), (r % per).cast("int").alias("_k"), "value").where("_k < 2")
    found = materialize(top.mapInPandas(_pairs, "_file string, _rec long, h string, seq string"), "pairs")
    cut = F.col("h").isNull() | F.col("seq").isNull()
    return found.where(~cut).unionByName(found.where(cut).groupBy("_file", "_rec").agg(F.max("h").alias("h"), F.max("seq").alias("seq")))


def under_heads(lines: DataFrame, is_head: Column, head_value: Column, by_file: bool = True) -> DataFrame:
    """Attach to each line the value of the nearest head line at or above it, and the head's ordinal.

    The block number is a running sum over the distributed file order; a block's lines are joined with its one
    head row, so a very long block is split like any other large side of a join.
    """
    by = ["_file"] if by_file else []
    order = ORDER[len(by):] if by_file else ORDER
    numbered = ordered_scan(lines.withColumn("_head", is_head), by, order, sums={"_no": F.col("_head").cast("long")})
    heads = numbered.where("_head").select(*[F.col(b) for b in by], "_no", head_value.alias("head"))
    return numbered.where("not _head").join(heads, [*by, "_no"])
