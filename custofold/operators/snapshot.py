"""What counts of all change records so far, kept up to date batch by batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custofold.operators.match import key_bucket
from custofold.operators.reconcile import reconcile
from custofold.schemas import FLAG, INSERT_FLAG
from custofold.sources.store import Store

SLICE = "SLICE"
LIVE = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("generation", T.LongType())])


@dataclass(frozen=True)
class Snapshot:
    """The result of ``reconcile`` over all batches, in buckets by key hash; a batch rewrites only those it touches.

    Rows lie in folders named by bucket and generation (column ``SLICE``). ``update`` reads the live slices of the
    batch's buckets, reconciles them with the batch, writes the next generation of just these buckets, and then commits
    the list of live slices. A failure before that changes nothing, and a batch that is given twice
    changes nothing either. The list has one row a bucket; the number of buckets is fixed for good. Take so many that
    a batch leaves most of them untouched, and so few that a bucket still fills a file.
    """

    store: Store
    table: str
    keys: Sequence[str]
    time: Sequence[str | Column]
    buckets: int = 256
    flag: str = FLAG
    insert: str = INSERT_FLAG
    ties: Sequence[str] | None = None

    @property
    def _list(self) -> str:
        return f"{self.table}_live"

    def live(self) -> dict[int, int]:
        """The generation of every bucket that holds rows."""
        if not self.store.exists(self._list):
            return {}
        return {r["bucket"]: r["generation"] for r in self.store.read(self._list, LIVE).collect()}

    @staticmethod
    def _slice(bucket: int, generation: int) -> str:
        return f"{bucket}-{generation}"

    def _stored(self, live: dict[int, int]) -> DataFrame:
        return self.store.read(self.table).where(F.col(SLICE).isin([self._slice(*x) for x in live.items()]))

    def read(self) -> DataFrame:
        """All rows that count."""
        return self._stored(self.live()).drop(SLICE)

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets of a batch."""
        own = batch.where(F.col(self.flag).isNotNull()).select(key_bucket(self.keys, self.buckets).alias("bucket"))
        return sorted(r["bucket"] for r in own.distinct().collect())

    def merged(self, batch: DataFrame, touched: Sequence[int]) -> DataFrame:
        """The batch reconciled with what is stored of its buckets; other buckets are not read."""
        live = self.live()
        old = {b: live[b] for b in touched if b in live}
        rows = self._stored(old).drop(SLICE).unionByName(batch) if old else batch
        return reconcile(rows, self.keys, self.time, self.flag, self.insert, self.ties)

    def update(self, batch: DataFrame) -> None:
        """Take a batch in."""
        live, touched = self.live(), self.touched(batch)
        if not touched:
            return
        new = max(live.values(), default=0) + 1
        name = F.concat_ws("-", key_bucket(self.keys, self.buckets).cast("string"), F.lit(str(new)))
        rows = self.merged(batch, touched).withColumn(SLICE, name)
        # a bucket's rows go to one task each, so that a slice is one file
        self.store.replace(rows.repartition(SLICE), self.table, [SLICE])
        live |= dict.fromkeys(touched, new)
        self.store.overwrite(self.store.spark.createDataFrame(sorted(live.items()), LIVE).coalesce(1), self._list)

    def compact(self) -> None:
        """Give back the space of slices that no longer count."""
        self.store.overwrite(self._stored(self.live()), self.table, [SLICE])
        self.store.expire(self.table)
        self.store.expire(self._list)
