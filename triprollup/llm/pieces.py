"""SentencePiece ids of whole texts, and texts of ids, by tables of distinct chunks.

White space becomes a marker, and a text begins with one. If no piece of a model has a marker
behind any other character, pieces never cross from a chunk, markers and what follows them, to
the next. The ids of a text are then those of its chunks one after the other. Each distinct
chunk of a block of texts is segmented once by the library itself; ids are joined back by
position. Chunks stay in the worker's table for the blocks that come next. Ids are decoded the
same way: a chunk of ids begins with each piece that begins with a marker. Where both are asked
for, the ids of each distinct chunk are decoded once, and only chunks that come back as other
text than they were are joined anew.

The tables are those of tasks. One table for all documents would need every block's distinct
chunks in a shuffle and their ids in another, which is more than twice the text; segmenting a
chunk again in another task costs less.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from triprollup.llm.batches import slices

MODEL = "piece_bpe_32k.model"
MARKER = "▁"
CHUNK = re.compile(" +[^ ]*")
#: Chunks a worker keeps, at most, and bytes worked on at a time.
KEPT_CHUNKS = 300_000
BLOCK = 2_000_000
#: Longer chunks are not kept.
KEPT_LENGTH = 64


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class ChunkTable:
    """Ids of chunks of text, and texts of chunks of ids, as far as a worker has met them."""

    def __init__(self, path: str):
        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.marker = self.model.piece_to_id(MARKER)
        marks = np.array([p.startswith(MARKER) for p in pieces], bool)
        crossing = [p for p in pieces if MARKER in p.lstrip(MARKER)]
        kept = self.model.decode(self.model.encode("  a  b ")) == "  a  b "
        if crossing or not kept or self.model.is_unknown(self.marker):
            raise ValueError("pieces cross white space, or white space is not kept as it is")
        self.marks = marks
        self.ids: dict[str, bytes] = {}
        self.changed: dict[str, str] = {}
        self.texts: dict[bytes, str] = {}

    def _segment(self, chunks: list[str]) -> dict[str, bytes]:
        """The library puts the first marker itself, but before nothing; and takes it away."""
        lists = self.model.encode([c[1:] for c in chunks], num_threads=1)
        lists = [i or [self.marker] for i in lists]
        texts = self.model.decode(lists, num_threads=1)
        self.changed.update((c, " " + t) for c, t in zip(chunks, texts) if t != c[1:])
        return {c: array("i", ids).tobytes() for c, ids in zip(chunks, lists)}

    def _spell(self, chunks: list[bytes]) -> dict[bytes, str]:
        """The library takes the first marker away."""
        lists = [np.frombuffer(c, "<i4").tolist() for c in chunks]
        found = self.model.decode(lists, num_threads=1)
        return {
            c: (" " if self.marks[ids[0]] else "") + text
            for c, ids, text in zip(chunks, lists, found)
        }

    @staticmethod
    def _known(table: dict, wanted: set, make) -> dict:
        """The table with all wanted chunks, and those that are too long to be kept."""
        missing = [c for c in wanted if c not in table]
        if len(table) + len(missing) > KEPT_CHUNKS:
            table.clear()
            missing = list(wanted)
        made = make(missing) if missing else {}
        long = {c: v for c, v in made.items() if len(c) > KEPT_LENGTH}
        table.update((c, v) for c, v in made.items() if c not in long)
        return table | long if long else table

    def _encoded(self, texts: list[str]) -> tuple[list[list[str]], list[bytes]]:
        # No marker stands before an empty text.
        split = [CHUNK.findall(" " + t.replace(MARKER, " ")) if t else [] for t in texts]
        known = self._known(self.ids, set().union(*split), self._segment)
        return split, [b"".join([known[c] for c in chunks]) for chunks in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, 32 bits each."""
        return self._encoded(texts)[1]

    def encode_and_decode(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids of each text, and the text that these ids give."""
        split, ids = self._encoded(texts)
        changed = self.changed
        again = [
            t.replace(MARKER, " ")
            if not changed or changed.keys().isdisjoint(chunks)
            else "".join([changed.get(c, c) for c in chunks])[1:]
            for t, chunks in zip(texts, split)
        ]
        if len(changed) > KEPT_CHUNKS:
            changed.clear()
            self.ids.clear()
        return ids, again

    def decode(self, lists: list[np.ndarray]) -> list[str]:
        """The text of each list of ids."""
        split = []
        for ids in lists:
            cuts = np.flatnonzero(self.marks[ids])
            bounds = (4 * np.unique([0, *cuts, len(ids)])).tolist()
            flat = ids.astype("<i4").tobytes()
            split.append([flat[a:b] for a, b in zip(bounds, bounds[1:])])
        known = self._known(self.texts, set().union(*split), self._spell)
        texts = ["".join([known[c] for c in chunks]) for chunks in split]
        return [t[1:] if len(i) and self.marks[i[0]] else t for i, t in zip(lists, texts)]


@functools.cache
def table_at(path: str) -> ChunkTable:
    """One for each Python worker."""
    return ChunkTable(path)


def _lists(ids: list[bytes]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])])
    flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)


def _mapped(rows: DataFrame, column: str, made: str, kind: str, make) -> DataFrame:
    """`rows` with the column `made` in place of `column`, some texts at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(column)
            for part, values in make(batch):
                yield part.set_column(at, made, values)

    kinds = [
        (made, kind) if f.name == column else (f.name, f.dataType.simpleString())
        for f in rows.schema.fields
    ]
    return rows.mapInArrow(work, ", ".join(f"`{n}` {k}" for n, k in kinds))


def encode_texts(rows: DataFrame, path: str, column: str = "text") -> DataFrame:
    """`rows` with ids (array<int>) in place of a column of texts, as the library gives them.

    A null or empty text has no ids. Repeated rows are answered each; texts of any length are
    whole. Other columns stay; one called ids must not be among them. An empty table gives no
    rows.
    """

    def make(batch: pa.RecordBatch):
        for some in slices(batch, column, BLOCK):
            texts = pc.fill_null(some.column(column), "").to_pylist()
            yield some, _lists(table_at(path).encode(texts))

    return _mapped(rows, column, "ids", "array<int>", make)


def decode_ids(rows: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """`rows` with text in place of a column of ids, as the library gives it.

    Null and empty lists give an empty text. Ids that the model has not, or null ones, fail. The
    rest as in `encode_texts`.
    """

    def make(batch: pa.RecordBatch):
        whole = batch.column(column)
        sizes = pc.fill_null(pc.list_value_length(whole), 0).to_numpy()
        blocks = np.cumsum(sizes) // (BLOCK // 4)
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(sizes)]
        for first, last in zip(cuts, cuts[1:]):
            if first == last:
                continue
            lists = whole.slice(first, last - first)
            flat, ends = lists.flatten().to_numpy(), np.cumsum(sizes[first:last])
            texts = table_at(path).decode(np.split(flat, ends[:-1]))
            yield batch.slice(first, last - first), pa.array(texts, pa.string())

    return _mapped(rows, column, "text", "string", make)


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, and the text that the ids give again, of each row; as `encode_texts`."""
    path = path or model_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", BLOCK):
                texts = pc.fill_null(some.column("text"), "").to_pylist()
                ids, again = table_at(path).encode_and_decode(texts)
                columns = [some.column("doc_id"), _lists(ids), pa.array(again, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"])

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(work, "doc_id bigint, ids array<int>, text string")
