"""Pack tokenized documents into sequences by best-fit decreasing."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.encoding import encoder, is_joined, some_texts
from flowgauge.llm.tables import stored, with_place
from flowgauge.llm.turns import released

#: Places of a length's documents are below this.
PLACES = 1 << 44


class OpenBins:
    """A segment tree over remaining capacities: how many bins are open below each node."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, left: int, bins: int) -> None:
        node = left + self.leaves
        while node:
            self.counts[node] += bins
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of ``length`` or more that some open bin has."""
        node = length + self.leaves
        if self.counts[node]:
            return length
        while node > 1 and (node & 1 or not self.counts[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node *= 2
            if not self.counts[node]:
                node += 1
        return node - self.leaves


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs (length, first place, items, first bin, offset, items per bin) of best-fit decreasing.

    ``counts`` says how many documents have each length, from 1 to ``capacity``. Documents of equal length are
    interchangeable and so are bins with equal remaining capacity, so both are handled in runs: the tightest open bins
    are found in the tree, and each takes documents of the length until no more fits, as they would one by one. The
    work and the runs are bounded by the capacity, not by the number of documents.
    """
    tree, runs = OpenBins(capacity), []
    open_: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first bin, bins) by remaining capacity
    next_bin = 0

    def put(left: int, first: int, bins: int) -> None:
        if left and bins:
            open_[left].append((first, bins))
            tree.add(left, bins)

    for length in sorted(counts, reverse=True):
        todo, place = counts[length], 0
        while todo:
            left = tree.tightest(length)
            if left is None:
                left, each = capacity, capacity // length
                bins = -(-todo // each)
                first, next_bin = next_bin, next_bin + bins
            else:
                first, bins = open_[left].pop()
                tree.add(left, -bins)
                each = left // length
            full = min(bins, todo // each)
            rest = min(todo - full * each, each - 1) if full < bins else 0
            taken = full * each + rest
            runs.append((length, place, taken, first, capacity - left, each))
            put(left - each * length, first, full)
            if rest:
                put(left - rest * length, first + full, 1)
            put(left, first + full + bool(rest), bins - full - bool(rest))
            todo, place = todo - taken, place + taken
    return np.array(runs, np.int64).reshape(-1, 6)


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every document."""
    joined = is_joined(tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        encode = encoder(tokenizer, joined).encode
        for whole in released(batches):
            for batch in some_texts(whole):
                coded = encode([t or "" for t in batch.column("text").to_pylist()])
                rows, pieces = [], []
                for i, ids in enumerate(coded):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at : at + 4 * capacity]
                        rows.append((i, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
                        if keep_ids:
                            pieces.append(np.frombuffer(piece, "<u4").astype(np.int32))
                table = np.array(rows, np.int64).reshape(-1, 5)
                arrays = [batch.column("doc_id").take(pa.array(table[:, 0])), pa.array(table[:, 1].astype(np.int32))]
                arrays += [pa.array(table[:, j]) for j in (2, 3, 4)]
                if keep_ids:
                    arrays.append(pa.array(pieces, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of every piece of ``docs`` (doc_id, text).

    A document is the ids of its whole text and ``end_id``; one longer than ``capacity`` is cut into full pieces and a
    rest. Null and empty texts are the end alone. Repeated rows and null ids are documents like others. Pieces fill
    sequences 0, 1, ... from offset 0 without gaps; which sequences, best-fit decreasing over all pieces says.

    Only the number of pieces of each length (``capacity`` rows) comes to the driver, which sends back the runs of the
    packing. A piece finds its run by its place among the pieces of its length, which ranges of rows count.
    """
    pieces = stored(tokenized_pieces(docs, tokenizer, capacity, end_id, keep_ids), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = best_fit_decreasing(counts, capacity)
    order = np.lexsort((runs[:, 1], runs[:, 0]))
    runs = runs[order]
    keys = runs[:, 0] * PLACES + runs[:, 1]
    names = pieces.columns
    placed = with_place(pieces, ["length"], [F.col(c) for c in ("doc_id", "piece", "start", "ids_crc32")], "place")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, place = (batch.column(c).to_numpy() for c in ("length", "place"))
            run = runs[np.searchsorted(keys, length * PLACES + place, "right") - 1]
            nth = place - run[:, 1]
            arrays = [batch.column(c) for c in names]
            arrays += [pa.array(run[:, 3] + nth // run[:, 5]), pa.array(run[:, 4] + nth % run[:, 5] * length)]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return placed.mapInArrow(assign, f"{schema}, sequence_id long, offset long")


def packed_sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids, lengths: the sequences of ``pack_documents(..., keep_ids=True)``, at most a capacity each."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"))
