"""What several operators here share: reading tables, folds and bounded label samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text_col: str = "text") -> Column:
    """The text as it stands; null counts as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def label_sample(labels: DataFrame, label_col: str, id_col: str, train: Column, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled ids as (__id, __label), the same ones every time.

    An id with several labels takes the largest. Rows are chosen by a hash of the
    id, so that the sample doesn't follow the table's order. It's at most
    ``max_rows`` narrow rows and so may be broadcast.
    """
    per_id = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & train)
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(F.col(label_col)).cast("int").alias("__label"))
    )
    return per_id.orderBy(F.xxhash64("__id"), "__id").limit(max_rows)


def labelled_rows(docs: DataFrame, sample: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is in the bounded sample, with ``__label``; ``docs`` isn't shuffled."""
    return docs.join(F.broadcast(sample), docs[id_col] == sample["__id"]).drop("__id")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of ``df`` has, in any letter case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
