"""Near-duplicate documents by min-max hashing.

Each permutation of the shingles gives two signature values, the smallest and the
largest hash, so half as many hashes are evaluated as with plain MinHash. Values are
banded into bucket keys; documents that share a key are candidates and every link is
confirmed on the full shingle sets.

Only documents with different sets take part: equal sets are one class first. Inside
a bucket no pairs are listed. All members are compared with the bucket's smallest
document; components of the confirmed links leave few outsiders per bucket, and these are
compared with the other members in blocks of bounded size, where only links come out.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table
from claimloom.llm import textkernels as K
from claimloom.llm.components import components

# 24 bands of 4 values: a pair of similarity 0.8 is missed with probability (1 - 0.8^4)^24 < 1e-5.
BANDS, ROWS = 24, 4
PERMUTATIONS = BANDS * ROWS // 2

# Most outsiders and most members that meet in one block.
BLOCK = 512

FACTORS = np.random.Generator(np.random.PCG64(7)).integers(0, 2**32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)


def _values(shingles: np.ndarray) -> np.ndarray:
    """Smallest and largest value of each permutation, side by side."""
    least = np.full(PERMUTATIONS, 2**32 - 1, np.uint32)
    most = np.zeros(PERMUTATIONS, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 8192):
        hashed = short[i : i + 8192, None] * FACTORS
        np.minimum(least, hashed.min(axis=0), out=least)
        np.maximum(most, hashed.max(axis=0), out=most)
    return np.stack([least, most], axis=1).ravel()


def signatures(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``n_shingles``, an identity of its set (``s1``, ``s2``) and its bucket ``keys``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = K.mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            for first, end, data, offsets in K.blocks(batch.column(1)):
                grams, counts = K.distinct_per_text(*K.text_grams(K.byte_words(data, offsets), words))
                bounds = np.cumsum(counts) - counts
                full = np.flatnonzero(counts)
                s1, s2 = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
                keys = np.zeros((len(full), BANDS), np.uint64)
                if len(full):
                    s1[full] = np.add.reduceat(K.mix(grams), bounds[full])
                    s2[full] = np.add.reduceat(K.mix(~grams), bounds[full])
                    sig = np.stack([_values(grams[bounds[t] : bounds[t] + counts[t]]) for t in full])
                    for r in range(ROWS):
                        keys = K.mix(keys + sig[:, r::ROWS].astype(np.uint64) + np.uint64(1))
                    keys += salt
                ends = np.zeros(len(counts) + 1, np.int32)
                ends[1:] = np.cumsum(np.where(counts > 0, BANDS, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array(counts),
                        pa.array(s1.view(np.int64)),
                        pa.array(s2.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64))),
                    ],
                    names=["doc_id", "n_shingles", "s1", "s2", "keys"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(
        sign, "doc_id long, n_shingles long, s1 long, s2 long, keys array<long>"
    )


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id`` and its sorted 64-bit shingle hashes as bytes, of ``docs(doc_id, text)``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in K.blocks(batch.column(1)):
                grams, counts = K.distinct_per_text(*K.text_grams(K.byte_words(data, offsets), words))
                bounds = np.cumsum(counts) - counts
                values = [grams[b : b + n].tobytes() for b, n in zip(bounds, counts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(values, pa.binary())],
                    names=["doc_id", "shingles"],
                )

    return docs.select("doc_id", "text").mapInArrow(sets, "doc_id long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` with 100 * intersection >= percent * union on the full sets."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select([0, 1]).filter(pa.array(keep))

    joined = (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
        .filter(100 * F.least(F.length("x"), F.length("y")) >= percent * F.greatest(F.length("x"), F.length("y")))
    )
    return joined.select("a", "b", "x", "y").mapInArrow(confirm, "a long, b long")


def _block_links(percent: int):
    """Links that connect components among the members of each block; rows arrive grouped by block.

    An outsider is compared with every member, but of the links between two components
    one is enough, so a block never gives more links than it has components.
    """

    def link(rows: pa.Table) -> tuple[list[int], list[int]]:
        ids = rows.column("rep").to_numpy()
        outside = rows.column("outside").to_numpy()
        if not outside.any() or outside.all():
            return [], []
        parts, part = np.unique(rows.column("label").to_numpy(), return_inverse=True)
        root = np.arange(len(parts))  # of each component seen here
        values = [np.frombuffer(s.as_py(), np.uint64) for s in rows.column("shingles")]
        sizes = np.array([len(v) for v in values])
        codes = np.unique(np.concatenate(values), return_inverse=True)[1]
        bounds = np.cumsum(sizes) - sizes
        here = np.zeros(codes.max() + 1, np.int32)
        members = np.flatnonzero(~outside)
        flat = codes[K.ragged(bounds[members], sizes[members])]
        starts = np.cumsum(sizes[members]) - sizes[members]
        left, right = [], []
        for o in np.flatnonzero(outside):
            own = codes[bounds[o] : bounds[o] + sizes[o]]
            here[own] = 1
            both = np.add.reduceat(here[flat], starts)
            here[own] = 0
            near = 100 * both >= percent * (sizes[o] + sizes[members] - both)
            near &= root[part[members]] != root[part[o]]
            found, first = np.unique(root[part[members[near]]], return_index=True)
            left.extend([ids[o]] * len(found))
            right.extend(ids[members[near][first]])
            root[np.isin(root, found)] = root[part[o]]
        return left, right

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            block = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = np.flatnonzero((block[1:] != block[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(block)]):
                if end <= start:
                    continue
                if waiting and tuple(block[start]) != last:
                    yield _pairs(*link(pa.Table.from_batches(waiting)))
                    waiting = []
                last = tuple(block[start])
                waiting.append(batch.slice(start, end - start))
        if waiting:
            yield _pairs(*link(pa.Table.from_batches(waiting)))

    return run


def _pairs(left: list[int], right: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _outsiders(colliding: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets whose links do not connect them yet, dealt to blocks.

    In a bucket, outsiders are the members outside its largest component. A block
    holds at most about ``BLOCK`` of them and ``BLOCK`` of all members.
    """
    named = colliding.filter("size > 2").join(labels, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", F.coalesce("label", "rep").alias("label")
    )
    named = as_table(named, "bucket-labels")
    parts = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = parts.groupBy("key").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("parts")
    )
    largest = largest.filter("parts > 1").select(
        "key",
        F.col("top.label").alias("main"),
        F.ceil(F.col("size") / BLOCK).cast("int").alias("member_blocks"),
        F.ceil((F.col("size") - F.col("top.n")) / BLOCK).cast("int").alias("outside_blocks"),
    )
    rows = named.join(as_table(largest, "open-buckets"), "key")
    spot = F.xxhash64("rep", "key")
    members = rows.select(
        "key",
        F.explode(F.sequence(F.lit(0), F.col("outside_blocks") - 1)).alias("i"),
        F.pmod(spot, "member_blocks").cast("int").alias("j"),
        "rep", "label", F.lit(False).alias("outside"),
    )
    outside = rows.filter("label != main").select(
        "key",
        F.pmod(spot, "outside_blocks").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("member_blocks") - 1)).alias("j"),
        "rep", "label", F.lit(True).alias("outside"),
    )
    return members.unionByName(outside)


def linked_classes(classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """``node`` and ``label`` (smallest linked rep) of the classes that have links.

    ``classes`` has a row per different shingle set: ``rep`` and its bucket ``keys``.
    ``sets_of(wanted)`` gives ``doc_id`` and ``shingles`` of the reps in ``wanted``.
    """
    buckets = classes.select("rep", F.explode("keys").alias("key")).distinct()
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("hub"))
    # Stored, so that both sides of the join are plain exchanges and a large bucket is split.
    shared = as_table(shared.filter("size > 1"), "shared-keys")
    colliding = as_table(buckets.join(shared, "key"), "buckets")
    sets = as_table(sets_of(colliding.select("rep").distinct()), "sets").dropDuplicates(["doc_id"])

    pairs = colliding.filter("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    links = as_table(confirmed(pairs, sets, percent), "links")
    labels = as_table(components(links), "labels")

    blocks = as_table(_outsiders(colliding, labels), "blocks")
    filled = (
        blocks.join(sets, blocks["rep"] == sets["doc_id"])
        .select("key", "i", "j", "rep", "label", "outside", "shingles")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
    )
    found = filled.mapInArrow(_block_links(percent), "a long, b long")
    more = as_table(found, "links")
    # Joining the stars of the first round with the new links gives the final components.
    stars = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    return as_table(components(stars.unionByName(more)), "labels")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Components of documents linked by near-equal shingle sets.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a document's set holds its
    distinct ``words``-word shingles, a shorter document is one shingle. Documents are
    linked when 100 * |intersection| >= percent * |union|. Returns per document
    ``doc_id``, ``n_shingles`` (long), ``component_id`` (smallest linked doc_id, itself
    included) and ``kept`` (doc_id = component_id).

    A null or empty text has no shingles and no links. Rows that repeat a doc_id come
    back as often as they came; other columns are ignored, whatever their names. An
    empty table gives an empty result. Ids must not be null to be linked; a row with
    a null id is returned with a null component and kept.
    """
    signed = as_table(signatures(docs, words, id_col, text_col), "signatures")
    identity = ["n_shingles", "s1", "s2"]
    classes = as_table(
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*identity)
        .agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys")),
        "classes",
    )

    def sets_of(wanted: DataFrame) -> DataFrame:
        texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        return shingle_sets(texts.join(wanted, texts["doc_id"] == wanted["rep"], "left_semi"), words)

    final = linked_classes(classes.select("rep", "keys"), sets_of, percent)
    named = classes.join(final, classes["rep"] == final["node"], "left").select(
        *identity, F.coalesce("label", "rep").alias("component_id")
    )
    full = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").drop("keys").join(named, identity)
    bare = signed.filter("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return (
        full.select("doc_id", "n_shingles", "component_id")
        .unionByName(bare)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
