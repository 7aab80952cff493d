"""Exact duplicates by Patricia tries of whole texts.

Texts are partitioned by length and content hash, and each partition inserts the full byte strings into a
compressed radix trie: an edge carries all bytes up to the next branch, and the node where a string ends
stores the smallest identifier and the number of its copies. Equal texts therefore meet at
one node, and different ones never do, whatever their hashes.

Tries work twice. Before the shuffle each task merges what it reads, so a text with very many
copies is sent once per task; a trie that outgrows its memory hands on its largest subtree and goes on. After
the shuffle rows arrive in order, so a subtree is handed on as soon as the input has passed it. Texts
that many tasks send are merged in salted parts first.
"""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table

# Bytes of strings that a task's trie holds before it hands on a subtree.
TRIE_BYTES = 64_000_000
# Bytes of strings in a batch that is handed on.
BATCH_BYTES = 4_000_000
# A text is hot if more than one of so many partial results are its own: fewer texts than this can be.
HOT_SHARE = 1_000
SALTS = 32

PARTIAL = "length long, digest string, content binary, owner long, copies long"
CLASSES = PARTIAL + ", clash boolean"


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by comparing halves."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Node:
    """An edge's bytes, the node's children by first byte, and what ends here."""

    __slots__ = ("label", "children", "owner", "copies")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.copies = label, {}, None, 0


class Trie:
    """Compressed radix trie from byte strings to (smallest identifier, copies)."""

    def __init__(self):
        self.root, self.bytes, self.strings = Node(b""), 0, 0

    def insert(self, key: bytes, owner: int | None, copies: int) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = Node(key[at:])
                node.children[key[at]] = child
                self.bytes += len(child.label)
                node, at = child, len(key)
                continue
            if not key.startswith(child.label, at):
                # The edge and the key part inside the edge: a node goes there.
                same = common_prefix(child.label, key[at : at + len(child.label)])
                upper = Node(child.label[:same])
                child.label = child.label[same:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = upper
                child = upper
            node, at = child, at + len(child.label)
        self.strings += node.copies == 0
        node.copies += copies
        if owner is not None and (node.owner is None or owner < node.owner):
            node.owner = owner

    def _walk(self, node: Node, prefix: bytes) -> Iterator[tuple[bytes, int | None, int]]:
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            key = prefix + node.label
            if node.copies:
                yield key, node.owner, node.copies
            # In order of bytes.
            stack += [(node.children[b], key) for b in sorted(node.children, reverse=True)]

    def drain(self) -> Iterator[tuple[bytes, int | None, int]]:
        """All strings with their owners; the trie is empty afterwards."""
        root, self.root, self.bytes, self.strings = self.root, Node(b""), 0, 0
        yield from self._walk(root, b"")

    def drain_largest(self) -> list[tuple[bytes, int | None, int]]:
        """The strings of the subtree that holds most bytes; it is cut off."""
        sizes = {b: sum(len(n.label) for n in _nodes(child)) for b, child in self.root.children.items()}
        if not sizes:
            return list(self.drain())
        largest = max(sizes, key=sizes.get)
        out = list(self._walk(self.root.children.pop(largest), b""))
        self.bytes -= sizes[largest]
        self.strings -= len(out)
        return out


def _nodes(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        node = stack.pop()
        yield node
        stack += node.children.values()


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``BATCH_BYTES`` of content (the third column)."""

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*waiting), kinds)], names=names)

    waiting, size = [], 0
    for row in rows:
        waiting.append(row)
        size += len(row[2] or b"") + 64
        if size >= BATCH_BYTES:
            yield batch()
            waiting, size = [], 0
    if waiting:
        yield batch()


_NAMES = ["length", "digest", "content", "owner", "copies"]
_KINDS = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64()]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(len(_NAMES))))


def merge_unordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per different text of what the task reads, or a few where memory is short.

    Strings are led by their hash, so the root has a subtree for each first digit of it.
    """

    def merged() -> Iterator[tuple]:
        trie, width = Trie(), {}

        def row(key: bytes, owner: int | None, copies: int) -> tuple:
            cut = width[key[:1]]
            return len(key) - cut, key[:cut].decode(), key[cut:], owner, copies

        for _, digest, content, owner, copies in _rows(batches):
            led = digest.encode()
            width[led[:1]] = len(led)
            trie.insert(led + content, owner, copies)
            while trie.bytes > TRIE_BYTES:
                yield from (row(*s) for s in trie.drain_largest())
        yield from (row(*s) for s in trie.drain())

    return _batches(merged(), _NAMES, _KINDS)


def merge_ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per different text, from rows in order of length, hash and content.

    ``clash`` tells that different texts share a length and hash. The trie holds one length and hash at a
    time; if many texts clash, what the input has passed is handed on earlier.
    """

    def merged() -> Iterator[tuple]:
        trie, key, spilled = Trie(), None, False

        def out(strings) -> Iterator[tuple]:
            clash = spilled or len(strings) > 1
            return ((*key, content, owner, copies, clash) for content, owner, copies in strings)

        for length, digest, content, owner, copies in _rows(batches):
            if key != (length, digest):
                if key is not None:
                    yield from out(list(trie.drain()))
                key, spilled = (length, digest), False
            elif trie.bytes > TRIE_BYTES and trie.strings > 1:
                strings = list(trie.drain())
                last = strings.pop()
                spilled = True
                yield from out(strings)
                trie.insert(*last)
            trie.insert(content, owner, copies)
        if key is not None:
            yield from out(list(trie.drain()))

    return _batches(merged(), [*_NAMES, "clash"], [*_KINDS, pa.bool_()])


def _in_tries(partials: DataFrame, *keys: str) -> DataFrame:
    """Partial results merged in partitions by length, hash and ``keys``."""
    dealt = partials.repartition("length", "digest", *keys)
    ordered = dealt.sortWithinPartitions("length", "digest", *keys, "content")
    return ordered.select(*_NAMES).mapInArrow(merge_ordered, CLASSES)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def classes(
    docs: DataFrame, largest: bool = False, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per different text: ``length`` (bytes), ``digest``, ``content``, ``owner``, ``copies``, ``clash``.

    ``owner`` is the smallest id that holds the text, or with ``largest`` the complement of the largest.
    """
    number = F.col(id_col).cast("long")
    rows = docs.select(
        F.octet_length(_text(text_col)).cast("long").alias("length"),
        digest(_text(text_col)).alias("digest"),
        _text(text_col).cast("binary").alias("content"),
        # The complement turns the order round and never overflows.
        (F.bitwise_not(number) if largest else number).alias("owner"),
        F.lit(1).cast("long").alias("copies"),
    )
    partials = as_table(rows.mapInArrow(merge_unordered, PARTIAL), "partial-texts")
    per_key = partials.groupBy("length", "digest").agg(F.count(F.lit(1)).alias("tasks"))
    least = partials.count() // HOT_SHARE + 1
    # Fewer than HOT_SHARE rows.
    hot = F.broadcast(per_key.filter((F.col("tasks") > 1) & (F.col("tasks") > least)).withColumn("hot", F.lit(True)))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("owner", "copies"), F.lit(SALTS)))
    salted = as_table(partials.join(hot, ["length", "digest"], "left").withColumn("salt", salt).drop("tasks", "hot")
                      .filter("salt IS NOT NULL").transform(_in_tries, "salt"), "salted-texts")
    rest = partials.join(hot, ["length", "digest"], "left_anti")
    return _in_tries(rest).unionByName(_in_tries(salted.drop("clash")))


# Names of working columns, kept apart from any column a table may have.
_LENGTH, _DIGEST, _OWNER, _COPIES = "__length", "__digest", "__owner", "__copies"
ADDED = ["__keep_id", "__group_size", "__kept", "__text_sha256"]


def owners(
    docs: DataFrame, largest: bool = False, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """``docs`` with the owner of each text.

    Adds ``__keep_id`` (smallest, or ``largest``, id of the rows with an equal text), ``__group_size``
    (rows with that text, long), ``__kept`` (the row has that id) and ``__text_sha256``. Texts are
    equal when all their bytes are; a null text is an empty one. Rows that share the owner's id and text
    all stay. Rows without an id count, but own nothing unless no row of the group has an id: then all stay
    and ``__keep_id`` is null. Other columns pass through, whatever their names. An
    empty table gives an empty result.
    """
    found = classes(docs, largest, id_col, text_col, digest).withColumn(
        "owner", F.bitwise_not("owner") if largest else F.col("owner")
    )
    # A text alone with its length and hash owns itself; the others are joined. Contents are needed
    # again only where different texts share a length and hash.
    found = as_table(
        found.filter("copies > 1 OR clash").withColumn("content", F.when(F.col("clash"), F.col("content"))), "owners"
    )
    plain = found.filter("NOT clash").select(
        F.col("length").alias(_LENGTH), F.col("digest").alias(_DIGEST), F.struct("owner", "copies").alias(_OWNER)
    )
    keyed = docs.withColumn(_LENGTH, F.octet_length(_text(text_col)).cast("long")).withColumn(
        _DIGEST, digest(_text(text_col))
    )
    joined = keyed.join(plain, [_LENGTH, _DIGEST], "left")
    clashes = found.filter("clash")
    if not clashes.isEmpty():
        exact = clashes.select(
            F.col("length").alias(_LENGTH), F.col("digest").alias(_DIGEST), F.col("content").cast("string").alias("__content"),
            F.struct("owner", "copies").alias("__exact"),
        )
        same = [joined[c] == exact[c] for c in (_LENGTH, _DIGEST)]
        joined = joined.join(exact, [*same, _text(text_col) == F.col("__content")], "left").drop(
            exact[_LENGTH], exact[_DIGEST]
        ).withColumn(_OWNER, F.coalesce(_OWNER, "__exact"))
    number = F.col(id_col).cast("long")
    alone = F.col(_OWNER).isNull()
    keep = F.when(alone, number).otherwise(F.col(_OWNER)["owner"])
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        keep.alias("__keep_id"),
        F.coalesce(F.col(_OWNER)["copies"], F.lit(1).cast("long")).alias("__group_size"),
        number.eqNullSafe(keep).alias("__kept"),
        (F.col(_DIGEST) if digest is sha256 else sha256(_text(text_col))).alias("__text_sha256"),
    )


def without_copies(docs: DataFrame, largest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that own their text, with all columns; see :func:`owners`."""
    return owners(docs, largest, id_col, text_col).filter("__kept").drop(*ADDED)
