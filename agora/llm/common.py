"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.operators.keys import in_scratch
from agora.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Cuts the lineage at files that every executor sees, so an executor
    lost later costs no recomputation, and the input runs once however
    often the result is read.  An open ``scratch`` removes it at its end.
    """
    out, path = store_at(df, name)
    in_scratch(path)
    return out


def store_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``store`` with the path, for a caller that removes the table itself."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/agora-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)  # many small files: no direct buffers kept, as snappy does
    return spark.read.schema(df.schema).parquet(path), path


def text_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """``doc_id, text, block`` with null text as empty; a block holds about
    ``block_bytes`` of text, whatever the corpus size.

    The block is a hash of ``doc_id`` (of the text where that is null), so
    a hot source or a group of copies spreads over all blocks.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    return d.withColumn("block", F.pmod(key, F.lit(blocks)).cast("int"))


def sorted_block(block):
    """A block's rows in the order that numbers them: by ``doc_id`` (nulls
    last), then text.  Every stage that reads a block sorts it so."""
    return block.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def binary_list(block, name: str) -> list[bytes]:
    import pyarrow as pa

    return block[name].cast(pa.binary()).to_pylist()


def read_with(docs: DataFrame, added: list[str]) -> DataFrame:
    """``docs`` without columns whose names an operator is about to add."""
    taken = {a.lower() for a in added}
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken])


def own_names(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` under names that no operator adds, all but ``text``, and what
    gives a selection of its rows their own columns back."""
    plain = docs.select(*[F.col(f"`{c}`").alias("text" if c.lower() == "text" else f"own{i}") for i, c in enumerate(docs.columns)])
    return plain, lambda rows: rows.select(*[F.col(a).alias(c) for a, c in zip(plain.columns, docs.columns)])
