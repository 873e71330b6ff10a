"""Which events were processed before: keys in order of time, read for the times of a batch alone.

A replayed event has its time again.  So a batch reads only stored keys between its own first and
last time: the sets of its dates, of those the row groups whose statistics meet the range.  A batch
leaves one small set; every ``SETTLE`` of them become one set a date, sorted by time, and the sets
of a date become one when they are as many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.sources.snapshots import Snapshots

#: What tells events apart; an event without one of these can't be recognised.
EVENT_KEY = ("did", "collection", "rkey", "operation", "time_us")
KEY_TYPE = "did string, collection string, rkey string, operation string, time_us long"
#: How the keys of a batch are cut and sorted.
ORDER = ("time_us", "did", "rkey")
#: Sets that become one.
SETTLE = 20
DAY_US = 86_400_000_000


def known(events: DataFrame) -> DataFrame:
    """The events that can be recognised."""
    return events.dropna(subset=list(EVENT_KEY))


class ProcessedEvents:
    """Keys of processed events below ``path``, written by one job.

    An entry holds ``batches`` (a batch's folder and the range of its times) and ``days`` (the sets of
    a date, by days since 1970).
    """

    def __init__(self, spark: SparkSession, path: str, settle: int = SETTLE):
        self.table, self.settle_at = Snapshots(spark, path), settle

    def sets(self, first_us: int, last_us: int, batch_id: int | None = None) -> list[str]:
        """The folders that may hold keys of a time range, without those of ``batch_id`` itself."""
        _, entry = self.table.latest()
        found = [
            b["folder"] for number, b in entry.get("batches", {}).items()
            if int(number) != batch_id and b["first"] <= last_us and b["last"] >= first_us
        ]
        for day, sets in entry.get("days", {}).items():
            if first_us // DAY_US <= int(day) <= last_us // DAY_US:
                found += sets
        return found

    def between(self, first_us: int, last_us: int, batch_id: int | None = None) -> DataFrame:
        """Stored keys of a time range."""
        stored = self.table.read(self.sets(first_us, last_us, batch_id), KEY_TYPE)
        return stored.where(F.col("time_us").between(first_us, last_us))

    def add(self, events: DataFrame, batch_id: int) -> None:
        """Store the keys of a batch; one that runs again replaces its set.  Old batches are settled."""
        keys = known(events).select(*EVENT_KEY)
        span = keys.agg(F.min("time_us").alias("first"), F.max("time_us").alias("last")).first()
        number = str(batch_id)
        if span["first"] is None:
            self.table.change(lambda entry: _without(entry, number))
        else:
            # The adaptive planner makes one file of the keys of a small batch; times many events share are cut too.
            ordered = keys.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
            folder = self.table.write(ordered)
            new = {"folder": folder, "first": span["first"], "last": span["last"]}
            self.table.change(lambda entry: {**entry, "batches": {**entry.get("batches", {}), number: new}})
        self.settle(batch_id)

    def settle(self, batch_id: int) -> None:
        """Merge the batches before ``batch_id`` (which may run again) if they are many."""
        _, entry = self.table.latest()
        loose = {n: b for n, b in entry.get("batches", {}).items() if int(n) < batch_id}
        if len(loose) < self.settle_at:
            return
        days, folders = dict(entry.get("days", {})), [b["folder"] for b in loose.values()]
        for day, folder in self._by_day(folders).items():
            days[day] = [*days.get(day, []), folder]
        for day in [d for d, sets in days.items() if len(sets) >= self.settle_at]:
            days[day] = [self._by_day(days[day])[day]]

        def merged(entry: dict) -> dict:
            return {"batches": {n: b for n, b in entry["batches"].items() if n not in loose}, "days": days}

        self.table.change(merged)
        self.table.clean(lambda e: [b["folder"] for b in e.get("batches", {}).values()] + sum(e.get("days", {}).values(), []))

    def _by_day(self, folders: list[str]) -> dict[str, str]:
        """One set a date out of ``folders``, each date's files sorted by time."""
        keys = self.table.read(folders, KEY_TYPE).distinct()
        dated = keys.withColumn("day", F.floor(F.col("time_us") / DAY_US).cast("long"))
        ordered = dated.repartitionByRange("day", "time_us").sortWithinPartitions("day", "time_us")
        folder = self.table.write(ordered, "day")
        # One row a date; the dates of a few batches.
        found = self.table.read([folder], f"{KEY_TYPE}, day long").select("day").distinct().collect()
        return {str(r["day"]): f"{folder}/day={r['day']}" for r in found}


def _without(entry: dict, number: str) -> dict:
    return {**entry, "batches": {n: b for n, b in entry.get("batches", {}).items() if n != number}}


def fresh_events(batch: DataFrame, store: ProcessedEvents, batch_id: int) -> DataFrame:
    """The events of a batch that no other batch has stored, each once.

    ``batch`` is read twice, so it should be kept.  Events that lack a part of the key all pass.
    """
    span = known(batch).agg(F.min("time_us").alias("first"), F.max("time_us").alias("last")).first()
    if span["first"] is None:
        return batch
    once = known(batch).dropDuplicates(list(EVENT_KEY))
    stored = store.between(span["first"], span["last"], batch_id)
    unknown = batch.where(F.array_contains(F.array(*[F.col(c).isNull() for c in EVENT_KEY]), True))
    return once.join(stored, list(EVENT_KEY), "left_anti").select(*batch.columns).unionByName(unknown)

