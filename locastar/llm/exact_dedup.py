"""Exact deduplication with Patricia-trie owners (operator 4).

Full byte strings go into compressed radix tries, first one trie in each input
partition, then one in each partition by length class and content hash, where
the entries of all input partitions meet. A terminal node holds the id that
stays and the number of copies. A trie that grows beyond its bound spills its
largest subtree. The ids of all members never meet in one place: members join
their owner by (length, hash).
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locastar.llm.common import texts_of

#: Bytes of strings that a trie holds before it spills its largest subtree.
HELD_BYTES = 32 << 20
#: Bytes of texts in one batch that leaves a task.
OUT_BYTES = 8 << 20

#: Hash partitions of each length class (texts of less than twice the shortest one's bytes).
BUCKETS = 1024

OWNERS = "class int, bucket int, sha binary, text binary, best long, copies long"
GROUP = ["class", "bucket"]


class Node:
    __slots__ = ("label", "below", "best", "copies", "sha")

    def __init__(self, label: bytes):
        self.label, self.below, self.best, self.copies, self.sha = label, {}, None, 0, None


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving: slices compare at memory speed."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Trie:
    """Compressed radix trie: byte string -> (id that stays, copies, its hash).

    ``choose`` is max or min. ``bytes`` counts the labels held, ``texts`` the terminal nodes.
    """

    def __init__(self, choose=max):
        self.root, self.choose, self.bytes, self.texts = Node(b""), choose, 0, 0

    def insert(self, key: bytes, best: int, copies: int = 1, sha: bytes | None = None) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.below.get(key[at])
            if child is None:
                leaf = Node(key[at:])
                node.below[key[at]] = leaf
                self.bytes += len(leaf.label)
                node, at = leaf, len(key)
                break
            n = shared(child.label, key[at:at + len(child.label)])
            if n < len(child.label):  # the edge splits where the strings part
                upper = Node(child.label[:n])
                child.label = child.label[n:]
                upper.below[child.label[0]] = child
                node.below[key[at]] = upper
                child = upper
            node, at = child, at + n
        self.texts += node.best is None
        node.best = best if node.best is None else self.choose(node.best, best)
        node.copies += copies
        node.sha = sha

    def take(self, node: Node | None = None, prefix: bytes = b""):
        """(key, best, copies, hash) of a subtree in byte order, without recursion."""
        stack = [(node or self.root, prefix)]
        while stack:
            node, prefix = stack.pop()
            key = prefix + node.label
            if node.best is not None:
                yield key, node.best, node.copies, node.sha
            stack += [(node.below[b], key) for b in sorted(node.below, reverse=True)]

    def spill(self):
        """The largest subtree under the root, or under the only edge there, leaves the trie; its entries."""
        def size(node: Node) -> int:
            held, stack = 0, [node]
            while stack:
                x = stack.pop()
                held += len(x.label)
                stack += x.below.values()
            return held
        top, prefix = self.root, b""
        while len(top.below) == 1 and top.best is None:
            top = next(iter(top.below.values()))
            prefix += top.label
        if not top.below:  # one text alone
            top, prefix = self.root, b""
        sizes = {b: size(n) for b, n in top.below.items()}
        first = max(sizes, key=sizes.get)
        node = top.below.pop(first)
        self.bytes -= sizes[first]
        for found in self.take(node, prefix):
            self.texts -= 1
            yield found


def batches_of(rows, schema: pa.Schema):
    """Record batches of rows; what a row's texts hold counts towards OUT_BYTES."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(v) for v in row if isinstance(v, bytes))
        if size > OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held), schema.types)], schema=schema)


FULL = pa.schema([("class", pa.int32()), ("bucket", pa.int32()), ("sha", pa.binary()), ("text", pa.binary()), ("best", pa.int64()), ("copies", pa.int64())])
SLIM = pa.schema(list(zip(["sha", "n_bytes", "keep_id", "group_size"], [pa.binary(), pa.int64(), pa.int64(), pa.int64()])))


def owners(docs: DataFrame, keep: str = "max", held_bytes: int = HELD_BYTES) -> DataFrame:
    """(sha, n_bytes, keep_id, group_size), one row for each distinct text.

    ``keep``: the largest ('max') or the smallest ('min') doc_id stays. Two
    different texts with one SHA-256 would end the job, never merge. A trie
    holds about ``held_bytes``, one whole text at least.
    """
    choose = {"max": max, "min": min}[keep]

    def collapse(batches):
        """In an input partition: copies become one entry; what is spilled goes to the shuffle."""
        def entry(key, best, copies, sha):
            return len(key).bit_length(), int.from_bytes(sha[:4], "big") % BUCKETS, sha, key, best, copies

        def rows():
            trie = Trie(choose)
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    raw = text.encode("utf-8")
                    trie.insert(raw, doc_id, 1, hashlib.sha256(raw).digest())
                    while trie.bytes > held_bytes:
                        yield from (entry(*e) for e in trie.spill())
            yield from (entry(*e) for e in trie.take())
        yield from batches_of(rows(), FULL)

    def own(batches):
        """A trie for each (length class, bucket). Entries of one text follow each
        other, so all texts before the last one are whole and may be spilled."""
        def out(key, best, copies, sha):
            return sha, len(key), best, copies

        def rows():
            trie, now, last, text_of_last = Trie(choose), None, None, None
            for batch in batches:
                for size, bucket, sha, text, best, copies in zip(*(c.to_pylist() for c in batch.columns)):
                    if (size, bucket) != now:
                        yield from (out(*e) for e in trie.take())
                        trie, now = Trie(choose), (size, bucket)
                    elif sha == last and text != text_of_last:
                        raise ValueError("two different texts have one SHA-256")
                    if sha != last:
                        while trie.bytes > held_bytes:
                            yield from (out(*e) for e in trie.spill())
                    trie.insert(text, best, copies, sha)
                    last, text_of_last = sha, text
            yield from (out(*e) for e in trie.take())
        yield from batches_of(rows(), SLIM)

    entries = texts_of(docs.where("doc_id is not null")).mapInArrow(collapse, OWNERS)
    dealt = entries.repartition(*GROUP).sortWithinPartitions(*GROUP, "sha")
    return dealt.mapInArrow(own, "sha binary, n_bytes long, keep_id long, group_size long")


def exact_dedup(docs: DataFrame, keep: str = "max", held_bytes: int = HELD_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their UTF-8 bytes are; a null text is the empty text.
    Rows without a doc_id are left out, as no result can name them. Rows that
    repeat a doc_id and a text count in group_size and appear each, kept or
    not by their common id. No rows give no rows.
    """
    members = texts_of(docs.where("doc_id is not null")).select(
        F.col("doc_id").cast("long"), F.octet_length("text").cast("long").alias("n_bytes"),
        F.unhex(F.sha2("text", 256)).alias("sha"))
    return members.join(owners(docs, keep, held_bytes), ["sha", "n_bytes"]).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
