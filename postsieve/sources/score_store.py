"""Model results that are kept: each input of a model is stored once, whoever writes and how often.

Rows lie in buckets by a checksum of their key, and the table changes by log entries (``snapshots``).
A writer scores what the buckets of its inputs lack, writes that, and commits it against the entry
it read.  If another writer came first, what the other stored is taken out and the rest committed;
the model doesn't run again.  A write that is repeated finds its results there and adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.session import checkpoint
from postsieve.sources.snapshots import Conflict, Snapshots

BUCKETS = 64
#: Sets of a bucket that become one.
MERGE = 16


class ScoreStore:
    """Results of type ``result`` below ``path``; an entry lists the sets of each bucket by model."""

    def __init__(self, spark: SparkSession, path: str, result: T.StructField, buckets: int = BUCKETS, merge_at: int = MERGE):
        self.table, self.result, self.buckets, self.merge_at = Snapshots(spark, path), result, buckets, merge_at
        self.schema = T.StructType([T.StructField("input_key", T.StringType()), result])

    def bucket(self, key: str = "input_key") -> Column:
        return F.pmod(F.crc32(F.col(key).cast("binary")), F.lit(self.buckets)).cast("int")

    def sets(self, entry: dict, model: str, buckets: list[int] | None = None) -> list[str]:
        held = entry.get(model, {})
        wanted = held if buckets is None else [str(b) for b in buckets]
        return [s for b in wanted for s in held.get(b, [])]

    def read(self, model: str, buckets: list[int] | None = None) -> DataFrame:
        """``input_key`` and result of a model, of some ``buckets`` alone if given."""
        return self.table.read(self.sets(self.table.latest()[1], model, buckets), self.schema)

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets that hold ``input_key``s, no more than there are."""
        return sorted(r[0] for r in keys.select(self.bucket().alias("b")).distinct().collect())

    def complete(self, model: str, inputs: DataFrame, score: Callable[[DataFrame], DataFrame], tries: int = 20) -> DataFrame:
        """Results of distinct ``inputs`` (``input_key``, ``input``); those not stored yet are scored.

        The inputs are held in a checkpoint, so what they come from is worked out once.
        """
        inputs = checkpoint(inputs)
        buckets, written = self.buckets_of(inputs), None
        for _ in range(tries):
            version, entry = self.table.latest()
            stored = self.table.read(self.sets(entry, model, buckets), self.schema).select("input_key")
            if written is None:
                missing = inputs.join(stored, "input_key", "left_anti")
                if missing.isEmpty():
                    break
                rows = score(missing)
            else:
                rows = self.table.read([written], self.schema).join(stored, "input_key", "left_anti")
            # A scorer that answers an input twice is heard once.
            rows = rows.select("input_key", self.result.name).dropDuplicates(["input_key"])
            written = self.table.write(rows.withColumn("bucket", self.bucket()), "bucket")
            found = self.table.read([written], T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())]))
            new = {str(b): f"{written}/bucket={b}" for b in [r[0] for r in found.select("bucket").distinct().collect()]}
            held = entry.get(model, {})
            added = {b: [*held.get(b, []), folder] for b, folder in new.items()}
            if self.table.commit(version, {**entry, model: {**held, **added}}):
                self.merge(model)
                break
        else:
            raise Conflict(self.table.path)
        return self.read(model, buckets).join(inputs.select("input_key"), "input_key", "left_semi")

    def merge(self, model: str) -> None:
        """Make one set of each bucket that has many; results stay as they are."""
        held = self.table.latest()[1].get(model, {})
        many = {b: sets for b, sets in held.items() if len(sets) >= self.merge_at}
        if not many:
            return
        rows = self.table.read(sum(many.values(), []), self.schema).withColumn("bucket", self.bucket())
        folder = self.table.write(rows.hint("rebalance", "bucket"), "bucket")

        def merged(entry: dict) -> dict:
            now = entry.get(model, {})
            for b, sets in many.items():
                if now.get(b, [])[: len(sets)] == sets:  # else another writer has merged them
                    now[b] = [f"{folder}/bucket={b}", *now[b][len(sets) :]]
            return {**entry, model: now}

        self.table.change(merged)
        self.table.clean(lambda e: [s for by_bucket in e.values() for sets in by_bucket.values() for s in sets])
