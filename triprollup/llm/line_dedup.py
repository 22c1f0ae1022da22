"""Line dedup that can be undone: sharded cuckoo filters before exact reference tables.

A store keeps, exactly, which document holds which line (`refs`) and how many hold each line
that is frequent (`counts`: lines of at least `min_docs` documents). Frequent lines are also
in a cuckoo filter for each shard of the key space. Inserting or deleting documents changes
the refs; the lines that became or ceased to be frequent are inserted into or removed from
the filters. To clean documents, a line's key is looked up in its shard's filter, and only
what the filter lets through is looked up in the exact counts.

Keys are 128-bit hashes. A shard whose lines are held by very many documents is probed in
several cells; each has the filter and a share of the refs, dealt by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triprollup.llm.batches import released, slices
from triprollup.llm.cuckoo import CuckooFilter
from triprollup.llm.tables import ceil_div, stored

MIN_CHARS = 20
MIN_DOCS = 3
#: Frequent lines of a shard, and refs of a cell, about; a store has so many shards at most,
#: which bounds the table of their sizes.
SHARD_LINES = 200_000
CELL_REFS = 500_000
MAX_SHARDS = 65_536

REFS = "h1 bigint, h2 bigint, doc_id bigint"
COUNTS = "h1 bigint, h2 bigint, refs bigint, last_doc bigint"
FILTERS = "shard int, held bigint, filter binary"


def key_of(line: bytes) -> bytes:
    """Without ASCII white space at the ends, A-Z in lower case."""
    return line.strip().lower()


def _is_long(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _hashes(keys: list[bytes]) -> np.ndarray:
    joined = b"".join(map(xxhash.xxh3_128_digest, keys))
    return np.frombuffer(joined, "<i8").reshape(-1, 2)


def refs_of(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row for each different key of a document; rows without an id have none."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            keys: list[bytes] = []
            counts = []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                own = {key_of(line) for line in (text or b"").split(b"\n")}
                own = [k for k in own if _is_long(k, min_chars)]
                keys += own
                counts.append(len(own))
            h = _hashes(keys)
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids, pa.int64())],
                names=["h1", "h2", "doc_id"],
            )

    rows = docs.filter(F.col("doc_id").isNotNull())
    return rows.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(scan, REFS)


def _updated_filter(key: tuple, lines: pa.Table, old: pa.Table) -> pa.Table:
    """The filter of a shard after its lines changed: change is 1 new, -1 gone, 0 neither."""
    change = lines.column("change").to_numpy()
    keys = lines.column("h2").to_numpy()
    held = int((change >= 0).sum())
    found = CuckooFilter(table=old.column("filter")[0].as_py()) if old.num_rows else None
    fits = found is not None and found.holds(held)
    if fits:
        found.remove(keys[change < 0])
        fits = found.insert(keys[change > 0])
    size = held
    while not fits:
        # Too small, or new: from the exact keys.
        found = CuckooFilter.for_keys(size)
        fits = found.insert(keys[change >= 0])
        size = 2 * max(size, 1)
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()], pa.int32()),
            "held": pa.array([held], pa.int64()),
            "filter": [found.to_bytes()],
        }
    )


@dataclass(frozen=True)
class LineStore:
    """What the documents inserted so far hold. Each change gives a new store."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS

    @classmethod
    def empty(
        cls, spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
    ) -> LineStore:
        tables = [spark.createDataFrame([], schema) for schema in (REFS, COUNTS, FILTERS)]
        return cls(*tables, 0, min_chars, min_docs)

    def insert(self, docs: DataFrame) -> LineStore:
        """With documents whose ids are not yet in the store.

        Rows that share an id are one document; rows without an id are not counted.
        """
        return self._changed(self.refs.unionByName(refs_of(docs, self.min_chars)))

    def delete(self, ids: DataFrame) -> LineStore:
        """Without the documents whose doc_id is in `ids`."""
        return self._changed(self.refs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti"))

    def _changed(self, refs: DataFrame) -> LineStore:
        refs = stored(refs, "line-refs")
        # Counted by line and document first, so that no line's documents meet in one task.
        counts = stored(
            refs.groupBy("h1", "h2")
            .agg(F.count_distinct("doc_id").alias("refs"), F.max("doc_id").alias("last_doc"))
            .filter(F.col("refs") >= self.min_docs),
            "line-counts",
        )
        shards = min(MAX_SHARDS, max(4, ceil_div(counts.count(), SHARD_LINES)))
        # Shards are dealt anew when lines have grown fourfold.
        same = 0 < self.shards and shards <= 4 * self.shards
        shards = self.shards if same else shards
        old = self.filters if same else self.filters.limit(0)
        before = (self.counts if same else self.counts.limit(0)).select("h1", "h2", F.lit(-1).alias("was"))
        lines = counts.select("h1", "h2", F.lit(1).alias("now")).join(before, ["h1", "h2"], "full")
        change = F.coalesce("now", F.lit(0)) + F.coalesce("was", F.lit(0))
        lines = lines.select(F.pmod("h1", F.lit(shards)).cast("int").alias("shard"), "h2", change.alias("change"))
        filters = lines.groupBy("shard").cogroup(old.groupBy("shard")).applyInArrow(_updated_filter, FILTERS)
        return LineStore(
            refs, counts, stored(filters, "line-filters"), shards, self.min_chars, self.min_docs
        )

    def dropped(self) -> DataFrame:
        """doc_id, h1, h2: the lines that documents lose, all but the last to hold a line."""
        spark = self.refs.sparkSession
        shard = F.pmod("h1", F.lit(self.shards)).cast("int")
        refs = self.refs.withColumn("shard", shard)
        sizes = refs.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()
        cells = spark.createDataFrame(
            [(r["shard"], ceil_div(r["n"], CELL_REFS)) for r in sizes], "shard int, cells int"
        )
        cells = F.broadcast(cells)  # at most MAX_SHARDS rows
        dealt = refs.join(cells, "shard").withColumn(
            "cell", F.pmod(F.xxhash64("doc_id"), F.col("cells")).cast("int")
        )
        exact = self.counts.withColumn("shard", shard).withColumn("filter", F.lit(None).cast("binary"))
        names = ["shard", "h1", "h2", "last_doc", "filter"]
        known = exact.select(*names).unionByName(
            self.filters.select("shard", "filter"), allowMissingColumns=True
        )
        each = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
        known = known.join(cells, "shard").select(*names, each.alias("cell"))
        probed = (
            dealt.select("shard", "cell", "h1", "h2", "doc_id")
            .groupBy("shard", "cell")
            .cogroup(known.groupBy("shard", "cell"))
        )
        return probed.applyInArrow(_lost, REFS)


def _lost(refs: pa.Table, known: pa.Table) -> pa.Table:
    """Refs that pass the filter and whose line has a later document by the exact counts."""
    none = pa.table({n: pa.array([], pa.int64()) for n in ("h1", "h2", "doc_id")})
    is_filter = known.column("filter").is_valid()
    tables = known.filter(is_filter).column("filter")
    if not refs.num_rows or not len(tables):
        return none
    passed = CuckooFilter(table=tables[0].as_py()).contains(refs.column("h2").to_numpy())
    names = ["h1", "h2", "doc_id"]
    hits = pd.DataFrame({n: refs.column(n).to_numpy()[passed] for n in names})
    exact = known.filter(pa.compute.invert(is_filter))
    exact = pd.DataFrame({n: exact.column(n).to_numpy() for n in ("h1", "h2", "last_doc")})
    found = hits.merge(exact, on=["h1", "h2"])
    found = found[found["doc_id"] != found["last_doc"]]
    return pa.Table.from_pandas(found[names], preserve_index=False)


def clean(docs: DataFrame, store: LineStore) -> DataFrame:
    """All columns of docs, the text without the lines it loses; and n_lines, n_dropped.

    The documents must be in the store. A null text is one empty line and becomes empty.
    Rows that share an id lose the same lines; a row without an id loses none. Lines in a
    document's text that repeat stay or go together. Columns of docs named n_lines or
    n_dropped are replaced.
    """
    lost = store.dropped().groupBy("doc_id").agg(
        F.collect_list(F.struct("h1", "h2")).alias("lost")
    )
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*names).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"))
    rows = rows.join(lost, "doc_id", "left").select("row", F.col("row.text").alias("text"), "lost")
    least = store.min_chars

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            texts, n_lines, n_dropped = [], [], []
            losses = batch.column("lost").to_pylist()
            for text, gone in zip(batch.column("text").cast(pa.binary()).to_pylist(), losses):
                lines = (text or b"").split(b"\n")
                kept = lines
                if gone:
                    hashes = np.array([(g["h1"], g["h2"]) for g in gone], "<i8")
                    keys = {h.tobytes() for h in hashes}
                    kept = [
                        line
                        for line in lines
                        if not _is_long(k := key_of(line), least)
                        or xxhash.xxh3_128_digest(k) not in keys
                    ]
                texts.append(b"\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_dropped, pa.int64()),
                ],
                names=["row", "text", "n_lines", "n_dropped"],
            )

    row = rows.schema["row"].dataType.simpleString()
    schema = f"row {row}, text string, n_lines bigint, n_dropped bigint"
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in names]
    return rows.mapInArrow(lambda batches: released(strip(batches)), schema).select(*columns, "n_lines", "n_dropped")


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """A store of these documents alone, and the documents cleaned by it."""
    store = LineStore.empty(docs.sparkSession, min_chars, min_docs).insert(docs)
    return clean(docs, store)
