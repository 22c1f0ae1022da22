"""The raw report kept up to date: a round reads only the batches that changed since the last.

A stored report holds its totals, the partial sums of each batch, and which files each batch had
when it was read. A round lists the files of the raw table, without opening one, and compares
them: batches that are new, that came late, that were replayed (their files are others) and that
were removed are found alike. New and replayed batches are read, by partition. Their partial
sums are added to the totals, those of what they replace are taken away.

    state/rounds/epoch=..   a file for each round (triprollup.sinks.commits)
    state/totals/run=..     the report after the round
    state/partials/run=..   report rows of the batches the round read, by batch
    state/batches/run=..    their files, as one number

A round that is cut off leaves the report before it. Of two rounds at the same time one counts,
and the other is repeated upon it.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triprollup.functions.numbers import Decimals, decimals_of, exact_sum
from triprollup.plans.reports import REPORT_VALUES
from triprollup.schemas import GROUP_KEYS, PARTITION, RAW_TABLE_SCHEMA
from triprollup.sinks.commits import (
    ATTEMPTS,
    EPOCH,
    VERSION,
    OtherWriter,
    add_commit,
    committed,
    current,
    latest,
    stored_or_none,
)
from triprollup.sinks.files import children, remove
from triprollup.sources.tables import RUN

COUNT, SUM = REPORT_VALUES
REPORT = "vendor_id string, payment_type string, n_trips bigint, sum_total_amount double"
PARTIALS = f"{PARTITION} bigint, {REPORT}"
BATCHES = f"{PARTITION} bigint, files bigint"
#: What a round tells: its run, and whether the run holds all batches and not only what changed.
ROUNDS = f"{RUN} string, whole boolean"
#: Folders that rounds write to, the first two for their own use.
WRITTEN = ("found", "new", "totals", "partials", "batches")
#: Batches up to so many are named to the scan one by one; beyond that by their range first.
NAMED_BATCHES = 2_000


def batch_files(spark: SparkSession, raw: str) -> DataFrame:
    """Each batch of a raw table and a number that stands for its files. No file is opened."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreMissingFiles", True)
        .load(raw)
    )
    if PARTITION not in listed.columns:  # an empty directory
        return spark.createDataFrame([], BATCHES)
    name = F.element_at(F.split("path", "/"), -1)
    file = F.xxhash64(name, "length", F.unix_millis("modificationTime"))
    # Without an order, and without overflow.
    files = F.sum(F.pmod(file, F.lit(1 << 40))).alias("files")
    return listed.groupBy(F.col(PARTITION).cast("bigint").alias(PARTITION)).agg(files)


class StoredReport:
    """The report of a raw table, kept at a path from round to round."""

    def __init__(self, spark: SparkSession, state: str, decimals: Decimals = None):
        self.spark, self.state = spark, state.rstrip("/")
        self.decimals = decimals_of(decimals, "total_amount")

    def _rounds(self) -> DataFrame:
        return committed(self.spark, f"{self.state}/rounds", ROUNDS)

    def _run(self, run: str, what: str) -> str:
        return f"{self.state}/{what}/{RUN}={run}"

    def _runs(self, rounds: list, what: str, schema: str) -> DataFrame:
        """What these rounds wrote, with the version of each."""
        if not rounds:
            return self.spark.createDataFrame([], f"{schema}, {VERSION} bigint")
        versions = self.spark.createDataFrame([(r[RUN], r[VERSION]) for r in rounds], f"{RUN} string, {VERSION} bigint")
        reader = self.spark.read.schema(f"{schema}, {RUN} string").option("basePath", f"{self.state}/{what}")
        return reader.parquet(*(self._run(r[RUN], what) for r in rounds)).join(versions, RUN).drop(RUN)

    @staticmethod
    def _since_whole(rounds: DataFrame) -> list:
        """Rounds from the last that is whole; there are EPOCH at most."""
        listed = rounds.orderBy(VERSION).collect()
        last = max((i for i, r in enumerate(listed) if r["whole"]), default=0)
        return listed[last:]

    def totals(self) -> DataFrame:
        """The report as the last round left it."""
        listed = self._since_whole(self._rounds())
        if not listed:
            return self.spark.createDataFrame([], REPORT)
        return self.spark.read.schema(REPORT).parquet(self._run(listed[-1][RUN], "totals"))

    def _read(self, raw: str, changed: DataFrame) -> DataFrame:
        """Report rows of these batches, by batch."""
        rows = self.spark.read.schema(RAW_TABLE_SCHEMA).parquet(raw)
        some = changed.filter("files is not null").select(PARTITION)
        span = some.agg(F.count(F.lit(1)), F.min(PARTITION), F.max(PARTITION)).first()
        if span[0] <= NAMED_BATCHES:
            rows = rows.filter(F.col(PARTITION).isin([r[0] for r in some.collect()]))
        else:
            rows = rows.filter(F.col(PARTITION).between(span[1], span[2]))
            rows = rows.join(some, PARTITION, "left_semi")
        return rows.groupBy(PARTITION, *GROUP_KEYS).agg(
            F.count(F.lit(1)).alias(COUNT), exact_sum("total_amount", self.decimals).alias(SUM)
        )

    def _added(self, rows: DataFrame) -> DataFrame:
        added = rows.groupBy(*GROUP_KEYS).agg(
            F.sum(COUNT).alias(COUNT), exact_sum(SUM, self.decimals).alias(SUM)
        )
        return added.filter(F.col(COUNT) != 0)

    def update(self, raw: str) -> DataFrame:
        """One round over the raw table at a path; its report, sorted."""
        for _ in range(ATTEMPTS):
            if self._round(raw):
                return self.totals().orderBy(*GROUP_KEYS)
        raise OtherWriter(f"{ATTEMPTS} times another round of {self.state} came first")

    def _round(self, raw: str) -> bool:
        rounds = self._rounds()
        base, listed = current(rounds), self._since_whole(rounds)
        # The files are listed before they are read: a batch that is replayed in between is
        # read with its new files, found changed by the next round, and corrected there.
        run = uuid4().hex
        known = latest(self._runs(listed, "batches", BATCHES), [PARTITION])
        known = known.filter("files is not null").select(PARTITION, F.col("files").alias("before"))
        now = batch_files(self.spark, raw).join(known, PARTITION, "full_outer")
        whole = (base[0] + 1) % EPOCH == 0
        same = F.col("files").eqNullSafe(F.col("before"))
        (now if whole else now.filter(~same)).write.parquet(self._run(run, "found"))
        found = self.spark.read.schema(f"{BATCHES}, before bigint").parquet(self._run(run, "found"))
        unchanged, found = found.filter(same), found.filter(~same)
        if listed and found.isEmpty():
            remove(self.spark, self._run(run, "found"))
            return True
        self._read(raw, found).write.parquet(self._run(run, "new"))
        new = self.spark.read.schema(PARTIALS).parquet(self._run(run, "new"))
        partials = self._partials(listed)
        replaced = found.filter("before is not null").select(PARTITION)
        gone = partials.join(replaced, PARTITION, "left_semi").select(*new.columns)
        kept = partials.join(replaced, PARTITION, "left_anti").select(*new.columns)
        if self._must_add_again(gone):
            totals = self._added(kept.unionByName(new))
        else:
            back = gone.withColumns({COUNT: -F.col(COUNT), SUM: -F.col(SUM)})
            rows = new.unionByName(back).drop(PARTITION)
            totals = self._added(rows.unionByName(self.totals()))
        totals.write.parquet(self._run(run, "totals"))
        (kept.unionByName(new) if whole else new).write.parquet(self._run(run, "partials"))
        batches = found.select(PARTITION, "files")
        if whole:
            batches = batches.unionByName(unchanged.select(PARTITION, "files"))
        batches.write.parquet(self._run(run, "batches"))
        told = self.spark.createDataFrame([(run, whole or not listed)], ROUNDS)
        return add_commit(self.spark, f"{self.state}/rounds", ROUNDS, run, base, told, [])

    def _partials(self, listed: list) -> DataFrame:
        """Report rows of each batch as it was last read."""
        owner = latest(self._runs(listed, "batches", BATCHES), [PARTITION])
        rows = self._runs(listed, "partials", PARTIALS)
        return rows.join(owner.select(PARTITION, VERSION), [PARTITION, VERSION], "left_semi")

    def _must_add_again(self, gone: DataFrame) -> bool:
        """Whether what is replaced can't be taken away to the last digit.

        Exact sums can; plain sums of doubles, NaN and infinities are added up again from the
        partial sums of all batches.
        """
        if self.decimals is not None:
            gone = gone.filter(F.isnan(SUM) | (F.abs(SUM) == float("inf")))
        return not gone.isEmpty()

    def remove_old(self) -> int:
        """Remove runs that no later round reads, those of cut-off rounds too; how many.

        Not to be called while a round is running.
        """
        live = {r[RUN] for r in self._since_whole(self._rounds())}
        removed = set()
        for what in WRITTEN:
            for name, _ in list(children(self.spark, f"{self.state}/{what}")):
                if name.partition("=")[2] not in live and remove(self.spark, f"{self.state}/{what}/{name}"):
                    removed.add(name)
        return len(removed)


def report_incremental(
    spark: SparkSession, raw: str, state: str, decimals: Decimals = None
) -> DataFrame:
    """The raw report of the table at `raw`, from what is stored at `state` and what came since."""
    return StoredReport(spark, state, decimals).update(raw)
