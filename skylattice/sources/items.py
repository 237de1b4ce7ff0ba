"""Stored sample frames of several modalities, laid out so that items meet without a shuffle.

Every modality is a table bucketed and sorted by the item's keys, all with the same number of
buckets. What belongs to one item is then in the same bucket of every table, and grouping or
joining by item needs no exchange of pixels.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from skylattice.schema import SCENE

BUCKETS = 64


@dataclass(frozen=True)
class ItemStore:
    """Tables ``<name>_<modality>`` below ``path``; ``keys`` name an item.

    The number of buckets is that of the parts an item join is split into: about the bytes of
    the largest modality divided by what one task should read. It is fixed for a store.
    """

    spark: SparkSession
    path: str
    name: str
    buckets: int = BUCKETS
    keys: list[str] = field(default_factory=lambda: list(SCENE))

    def _table(self, modality: str) -> str:
        return f"{self.name}_{modality}"

    def _folder(self, modality: str) -> str:
        return f"{self.path.rstrip('/')}/{modality}"

    def write(self, modality: str, frames: DataFrame) -> None:
        """Store a modality's frames. A bucket is one file: rows move to it before the write.

        The item keys are stored beside them, without pixels.
        """
        frames = frames.drop("modality") if "modality" in frames.columns else frames
        writer = frames.repartition(self.buckets, *self.keys).write.format("parquet")
        writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", self._folder(modality)).saveAsTable(
            self._table(modality)
        )
        items = self.read(modality).select(*self.keys).distinct()
        items.write.parquet(f"{self._folder(modality)}-items")

    def read(self, modality: str) -> DataFrame:
        """The stored frames; another session declares the table anew over its files."""
        table = self._table(modality)
        if not self.spark.catalog.tableExists(table):
            folder = self._folder(modality)
            columns = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(folder).schema
            )
            by = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{folder}'"
            )
        return self.spark.table(table)

    def items(self, modalities: list[str]) -> DataFrame:
        """The items that any of the modalities has, placed like the buckets."""
        found = None
        for m in modalities:
            own = self.spark.read.parquet(f"{self._folder(m)}-items")
            found = own if found is None else found.unionByName(own)
        return found.distinct().repartition(self.buckets, *self.keys)
