"""Near-duplicate documents by SuperMinHash, banding, verification on full sets and connected components."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.components import components
from flowgauge.llm.super_minhash import WordHashes, band_keys, fingerprint, shingle_set, signatures
from flowgauge.llm.tables import stored
from flowgauge.llm.turns import released, take_turn

#: Values of a signature, and how often a pair of just the wanted similarity may share no band.
VALUES, MISS = 252, 1e-5
#: Hashes of shingles that one half of a verification cell holds: 8 bytes each.
CELL_ELEMENTS = 1 << 20
#: Documents whose signatures are made together.
DOCS_AT_ONCE = 256

_hashes = WordHashes()


def bands_for(percent: int, values: int = VALUES, miss: float = MISS) -> tuple[int, int]:
    """(bands, values of each): the longest bands by which a pair of the similarity is missed no more often than ``miss``.

    36 of 7 for 85 percent (missed once in a million), 42 of 6 for 80 percent (three times in a million). Equal sets share all.
    """
    for rows in range(values, 1, -1):
        if (1 - (percent / 100) ** rows) ** (values // rows) <= miss:
            return values // rows, rows
    return values, 1


def _texts(batch: pa.RecordBatch) -> list:
    return batch.column("text").cast(pa.large_binary()).to_pylist()


def _signer(width: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_turn("near_dedup", _hashes.clear)
        for whole in released(batches):
            for start in range(0, whole.num_rows, DOCS_AT_ONCE):
                batch = whole.slice(start, DOCS_AT_ONCE)
                sets = [shingle_set(t, width, _hashes) for t in _texts(batch)]
                keys = band_keys(signatures(sets, bands * rows), bands)
                empty = np.array([not len(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([None if e else k for e, k in zip(empty, keys, strict=True)], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "print", "bands"],
                )

    return sign


def _sets(width: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            sets = [shingle_set(t, width, _hashes).tobytes() for t in _texts(batch)]
            columns = [batch.column(c) for c in ("comp", "chunk", "chunks", "doc_id")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.binary())], ["comp", "chunk", "chunks", "doc_id", "elements"])

    return make


def spanning_links(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect whatever the pairs with ``100 * intersection >= percent * union`` connect.

    A document that asks is compared with all others at once: an index from element to documents, in order of size,
    counts its overlaps with those of a size that can reach the similarity. First ask those that no earlier one has
    linked, then the rest of every component but the largest. A link between two components has an end outside the
    largest, so none is lost, and a large group of near copies costs one question per component of it.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    n = len(sets)
    by_size = np.argsort(sizes, kind="stable")
    ids, sets, sizes = np.asarray(ids)[by_size], [sets[i] for i in by_size], sizes[by_size]
    known, number = np.unique(np.concatenate(sets), return_inverse=True)
    del known
    number = number.astype(np.int64)
    ends = np.cumsum(sizes)
    postings = np.sort(number * n + np.repeat(np.arange(n), sizes))
    low = np.searchsorted(100 * sizes, percent * sizes, "left")
    high = np.searchsorted(percent * sizes, 100 * sizes, "right")
    parent = np.arange(n)
    out: list[tuple[int, int]] = []

    def roots(x: np.ndarray) -> np.ndarray:
        r = parent[x]
        while (parent[r] != r).any():
            r = parent[r]
        parent[x] = r
        return r

    def ask(x: int) -> np.ndarray:
        own = number[ends[x] - sizes[x] : ends[x]] * n
        first = np.searchsorted(postings, own + low[x])
        count = np.searchsorted(postings, own + high[x]) - first
        # Positions of all postings of x's elements, without a loop over the elements.
        at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        shared = np.bincount(postings[at] % n, minlength=n)
        linked = np.nonzero(100 * shared >= percent * (sizes + sizes[x] - shared))[0]
        of, one = np.unique(roots(linked), return_index=True)
        mine = roots(np.array([x]))[0]
        for r, y in zip(of, linked[one], strict=True):
            if r != mine:
                out.append((int(ids[x]), int(ids[y])))
        parent[of] = parent[mine] = min(mine, of.min())
        return linked

    met = np.zeros(n, bool)
    asked = np.zeros(n, bool)
    for x in range(n):
        if not met[x]:
            met[ask(x)] = asked[x] = True
    all_roots = roots(np.arange(n))
    largest = np.bincount(all_roots, minlength=n).argmax()
    for x in np.nonzero(~asked & (all_roots != largest))[0]:
        ask(x)
    return out


def _verifier(percent: int):
    def verify(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(b, np.uint64) for b in table.column("elements").to_pylist()]
        links = spanning_links(table.column("doc_id").to_numpy(), sets, percent) if len(sets) > 1 else []
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return verify


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: groups of documents linked by Jaccard similarity of word shingles.

    * ``docs`` needs doc_id (integer) and text; other columns are left alone. Whole texts are used.
    * Words are runs of bytes other than space and 9 to 13, A-Z as a-z. A set holds the distinct runs of ``width`` words,
      or the whole sequence if that is shorter. Null, empty or blank texts have no set and link with nothing.
    * Documents are linked if ``100 * intersection >= percent * union``; component_id is the smallest doc_id reachable
      (itself included) and kept marks the document that has it.
    * Rows with the same doc_id are one document: they come back each, with one component. A null doc_id links with
      nothing, has a null component and is kept. An empty table gives an empty table.

    Equal sets are one class from the first grouping on; thousands of copies cost one row. Classes that share a band
    chain up to candidate components, each of whose sets is shipped once to a cell that counts all overlaps exactly. A
    component with more than ``CELL_ELEMENTS`` elements is dealt to chunks by hash, and a cell takes a pair of chunks:
    the memory of a task is bounded and no pair is left out. Cells return spanning links, never all pairs.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bands, rows = bands_for(percent)
    schema = "doc_id long, n_shingles long, print binary, bands array<long>"
    signed = stored(docs.mapInArrow(_signer(width, bands, rows), schema), "signatures")
    sized = signed.where("print is not null and doc_id is not null")
    classes = stored(
        sized.groupBy("print").agg(
            F.min("doc_id").alias("rep"),
            F.first("n_shingles").alias("n_shingles"),
            F.count("*").alias("copies"),
        ),
        "classes",
    )
    # The bands of one document per class: its copies have the same.
    reps = sized.select("doc_id", "print", "bands").join(
        classes.select(F.col("print").alias("of"), "rep"), (F.col("print") == F.col("of")) & (F.col("doc_id") == F.col("rep")), "left_semi"
    )
    keyed = reps.select(F.col("doc_id").alias("rep"), F.posexplode("bands").alias("band", "key")).select("rep", "key")
    keyed = stored(keyed, "bands")
    buckets = keyed.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    star = keyed.join(buckets.select("key", "least"), "key").where("rep <> least").select("rep", "least").distinct()
    # A doc_id that repeats with other texts has several classes, which it joins.
    near = components(star, "rep", "least").join(classes, F.col("node") == F.col("rep"))
    near = stored(near.select("root", F.col("rep"), "n_shingles").dropDuplicates(["rep"]), "candidates")
    links = _verified(docs, near, width, percent)
    several = sized.groupBy("doc_id").agg(F.min("print").alias("p"), F.max("print").alias("q")).where("p <> q")
    several = several.join(sized.select("doc_id", "print").distinct(), "doc_id").join(classes.select("print", "rep"), "print")
    links = links.unionAll(several.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    roots = components(links, "a", "b")
    of_class = classes.join(roots, classes.rep == roots.node, "left").select(
        F.col("print").alias("of"), F.coalesce("root", "rep").alias("component_id")
    )
    marked = sized.join(of_class, F.col("print") == F.col("of")).select("doc_id", "n_shingles", "component_id")
    alone = signed.where("print is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return marked.unionAll(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _verified(docs: DataFrame, near: DataFrame, width: int, percent: int) -> DataFrame:
    """Spanning links among the classes of each candidate component, counted on full sets."""
    weights = near.groupBy("root").agg(F.ceil(F.sum("n_shingles") / CELL_ELEMENTS).alias("chunks"))
    near = near.join(weights, "root").select(
        F.col("root").alias("comp"), F.pmod(F.xxhash64("rep"), F.col("chunks")).alias("chunk"), "chunks", F.col("rep")
    )
    # The same plan at every size: texts are dealt by id and meet a hash table of the candidates.
    texts = docs.join(near.hint("shuffle_hash"), docs.doc_id == near.rep).select("comp", "chunk", "chunks", "doc_id", "text")
    sets = texts.mapInArrow(_sets(width), "comp long, chunk long, chunks long, doc_id long, elements binary")
    # One chunk is a cell of its own; of several, every two make a cell.
    other = F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)
    cells = sets.withColumn("other", F.explode(other)).where("chunks = 1 or other <> chunk")
    cells = cells.select("comp", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "doc_id", "elements")
    return cells.groupBy("comp", "low", "high").applyInArrow(_verifier(percent), "a long, b long")
