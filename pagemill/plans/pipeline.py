"""A fluent façade: files to elements to chunks to vectors to a table, each verb a DataFrame transformation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.ordered import token_windows
from pagemill.runtime import staged
from pagemill.sources import files as S


class Ingest:
    """Ingest(spark).files([...]).split(256).filter(...).embed(f).write(path). Nothing runs before write or df is used."""

    def __init__(self, spark: SparkSession, df: DataFrame | None = None):
        self.spark, self.df = spark, df

    def _with(self, df: DataFrame) -> "Ingest":
        return Ingest(self.spark, df)

    def files(self, patterns: list[str], readers: dict | None = None, strict: bool = True) -> "Ingest":
        paths = S.expand_paths(patterns, self.spark)
        own = {"text": S.text_chunks, "html": S.html_pages, "spreadsheet": S.csv_chunks} | (readers or {})
        return self._with(S.branches(S.scan(self.spark, paths), own, strict))

    def split(self, size: int, overlap: int = 0) -> "Ingest":
        """Token windows of the text column; page_number becomes the place of the chunk."""
        df = self.df.withColumn("_w", token_windows(F.col("text"), size, overlap))
        rest = [c for c in self.df.columns if c not in ("text", "page_number")]
        return self._with(df.select(*rest, F.posexplode("_w").alias("_i", "text")).withColumn("page_number", F.col("_i") + 1).drop("_i"))

    def dedup(self, *by: str) -> "Ingest":
        key = F.md5(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in by or ("text",)]))
        return self._with(self.df.withColumn("_k", key).dropDuplicates(["_k"]).drop("_k"))

    def filter(self, condition: Column | str) -> "Ingest":
        return self._with(self.df.where(condition))

    def udf(self, f: Callable[[DataFrame], DataFrame]) -> "Ingest":
        return self._with(self.df.transform(f))

    def embed(self, f: Callable[[Column], Column], name: str = "embedding") -> "Ingest":
        """f: a column of texts to a column of vectors, e.g. a pandas UDF around a model."""
        df = self.df.withColumn(name, f(F.col("text")))
        return self._with(df.withColumn("embedding_dim", F.coalesce(F.size(name), F.lit(0))).withColumn("has_embedding", F.col("embedding_dim") > 0))

    def save_intermediate(self, name: str) -> "Ingest":
        return self._with(staged(self.df, name))

    def write(self, path: str, mode: str = "overwrite", dim: int | None = None) -> DataFrame:
        return S.write_table(self.df, path, mode, dim)
