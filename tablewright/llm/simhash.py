"""Near-duplicates by SimHash fingerprints and anchor-point covering.

A text's fingerprint has 64 bits: the majority of the bits of its shingles'
hashes. Fingerprints link at ``most`` or fewer differing bits.

The 64 bits are laid out as three segments of 23, 23 and 18 bits. Two linked
fingerprints differ by at most ``most // 3`` bits in one of them. The anchors of
the first two are the words of the binary Golay code, which covers every value
within 3 bits; those of the last the words of a Hamming code of 15 bits with 3
free bits, which covers within 1. A fingerprint's home is its nearest anchor; it
is replicated to every anchor within the covering radius plus the segment's share
of the threshold, so a linked fingerprint meets it at its home in some segment.
Fingerprints are compared per anchor only.

Equal fingerprints are folded into one before, so copies cost nothing. An anchor
with many fingerprints is cut into blocks of bounded size, each pair of blocks a
group of its own; from each group comes a spanning forest of its links, not the
links, so the output stays linear in the group.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import components, stage

#: Fixed value: a word is a run of bytes that are none of these.
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Words in a shingle, seed of its hash, differing bits that still link.
SHINGLE, SEED, MOST = 4, 42, 4
#: Bits of the segments, lowest first.
SEGMENTS = (23, 23, 18)
#: Fixed value: generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011
#: Fixed value: generator polynomial of the Hamming code of 15 bits, x^4 + x + 1.
HAMMING = 0b10011
#: Parts that the members of a group are dealt to.
PARTS = 256
#: Rows of a block of an anchor.
BLOCK = 4096
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16

_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text, 0 if it has no words."""
    words = WORD.findall((text or "").encode().translate(_UPPER))
    if not words:
        return 0
    width = min(SHINGLE, len(words))
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(starts)
    stops = ends[width - 1 :].tolist()
    for k in range(0, n, COUNTED):
        hashes = np.fromiter(
            (digest(flat[a:b], SEED) for a, b in zip(starts[k : k + COUNTED], stops[k : k + COUNTED], strict=True)),
            np.dtype("<u8"),
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", into: str = "fp") -> DataFrame:
    """``docs`` without ``text``, with the fingerprint as a signed long in ``into``.

    A null text counts as empty: its fingerprint is zero, like that of any text
    without words. A column called ``into`` is replaced.
    """
    kept = docs.drop(into, text)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.LongType(), False)])
    source = docs.select(*kept.columns, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py()) for x in batch.columns[-1]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found)], names=[*batch.schema.names[:-1], into]
            )

    return source.mapInArrow(run, schema)


class Code:
    """A linear code as anchors of a segment.

    ``rows`` generate it, each with a leading bit of its own, so a value is reduced
    to the remainder of its coset by a few steps. What lies in reach depends on the
    remainder only, so it is tabled once for each of the few remainders.
    """

    def __init__(self, bits: int, rows: list[int], reach_beyond: int):
        self.rows = sorted(rows, reverse=True)
        words = np.zeros(1, np.int64)
        for row in rows:
            words = np.concatenate([words, words ^ row])
        words.sort()
        apart = np.bitwise_count(np.arange(1 << (bits - len(rows)))[:, None] ^ words[None, :])
        self.radius = int(apart.min(axis=1).max())
        self.near = []
        for remainder in apart:
            at = np.flatnonzero(remainder <= self.radius + reach_beyond)
            home = np.zeros(len(at), bool)
            home[remainder[at].argmin()] = True
            self.near.append((words[at], home))

    def remainders(self, values: np.ndarray) -> np.ndarray:
        left = values.copy()
        for row in self.rows:
            left ^= np.where(left >> (row.bit_length() - 1) & 1, row, 0)
        return left


@functools.cache
def _codes(most: int) -> tuple[Code, ...]:
    golay = [GOLAY << k for k in range(12)]
    hamming = [HAMMING << k for k in range(11)] + [1 << k for k in range(15, 18)]
    beyond = most // len(SEGMENTS)
    return Code(23, golay, beyond), Code(23, golay, beyond), Code(18, hamming, beyond)


def _anchored(fps: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions in ``fps``, anchors, whether it is the home) of every replica."""
    low = 0
    for segment, (bits, code) in enumerate(zip(SEGMENTS, _codes(most), strict=True)):
        values = (fps.view(np.uint64) >> np.uint64(low)).astype(np.int64) & ((1 << bits) - 1)
        remainders = code.remainders(values)
        counts = np.array([len(code.near[r][0]) for r in remainders.tolist()], np.int64)
        at = np.repeat(np.arange(len(fps)), counts)
        words = np.concatenate([code.near[r][0] for r in remainders.tolist()] or [np.zeros(0, np.int64)])
        home = np.concatenate([code.near[r][1] for r in remainders.tolist()] or [np.zeros(0, bool)])
        yield at, (values ^ remainders)[at] ^ words | segment << 23, home
        low += bits


def replicas(distinct: DataFrame, most: int = MOST) -> DataFrame:
    """``(anchor, fp, home)`` for every anchor in reach of each fingerprint."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps = frame["fp"].to_numpy(np.int64)
            for at, anchor, home in _anchored(fps, most):
                yield pd.DataFrame({"anchor": anchor.astype(np.int32), "fp": fps[at], "home": home})

    return distinct.select("fp").mapInPandas(run, "anchor int, fp long, home boolean")


def _forest(left: np.ndarray, right: np.ndarray, most: int, rows: int = 256) -> pd.DataFrame:
    """Spanning forest of the links between two sets of fingerprints."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    root = list(range(len(nodes)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    mine, other = at[: len(left)], at[len(left) :]
    for start in range(0, len(left), rows):
        near = np.bitwise_count(left[start : start + rows, None].view(np.uint64) ^ right[None, :].view(np.uint64)) <= most
        near &= mine[start : start + rows, None] != other[None, :]
        for i in np.flatnonzero(near.any(axis=1)):
            a = int(mine[start + i])
            mates = other[near[i]]
            for b in mates.tolist():
                x, y = top(a), top(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    kept.append((a, b))
    pairs = np.array(kept, np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": nodes[pairs[:, 0]], "b": nodes[pairs[:, 1]]})


def links(distinct: DataFrame, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: links that span every group of linked fingerprints.

    The counts of anchors have at most 4096 + 4096 + 16384 rows, as many as there
    are code words, so they may be broadcast whatever the input.
    """
    copies = stage(replicas(distinct, most), "simhash-replicas")
    sizes = copies.groupBy("anchor").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / block).cast("int").alias("homes"),
        F.ceil(F.count("*") / block).cast("int").alias("copies"),
    ).where("homes > 0")
    dealt = copies.join(F.broadcast(sizes), "anchor")
    part = F.pmod(F.xxhash64("fp"), F.lit(1 << 30))
    homes = dealt.where("home").select(
        "anchor", (part % F.col("homes")).cast("int").alias("h"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("c"),
        "fp", F.lit(True).alias("home"),
    )
    others = dealt.select(
        "anchor", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)).alias("h"), (part % F.col("copies")).cast("int").alias("c"),
        "fp", F.lit(False).alias("home"),
    )

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by group; a group may span two frames."""
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            keys = frame[["anchor", "h", "c"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            yield from groups(frame.iloc[:last], cuts)
            rest = frame.iloc[last:]
        if rest is not None:
            yield from groups(rest, np.zeros(0, np.int64))

    def groups(frame: pd.DataFrame, cuts: np.ndarray) -> Iterator[pd.DataFrame]:
        fps, home = frame["fp"].to_numpy(np.int64), frame["home"].to_numpy(bool)
        found, start = [], 0
        for end in [*(int(x) for x in cuts if x < len(frame)), len(frame)]:
            mine = home[start:end]
            if mine.any() and not mine.all():
                forest = _forest(fps[start:end][mine], fps[start:end][~mine], most)
                if len(forest):
                    found.append(forest)
            start = end
        if found:
            yield pd.concat(found, ignore_index=True)

    grouped = homes.unionByName(others).repartition("anchor", "h", "c").sortWithinPartitions("anchor", "h", "c")
    return grouped.mapInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """``(key, fp, component_id)`` for each row of ``docs``.

    ``component_id`` is the least key that links reach. Rows with a null key get
    the least key of the others in their group; null if there is none. Repeated
    rows keep their number. Other columns of ``docs`` are not looked at.
    """
    marked = stage(fingerprints(docs.select(F.col(key).alias("key"), F.col(text).alias("text"))), "simhash-fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("key").alias("least"))
    groups = components(links(distinct.select("fp"), most)).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    # The least key of a group is told to its parts, then to their members: a group of any size is many keys.
    part = F.pmod(F.xxhash64("fp"), F.lit(PARTS)).cast("int").alias("part")
    members = distinct.join(groups, "fp").select("fp", "least", "root", part)
    parts = members.groupBy("root", "part").agg(F.min("least").alias("least"))
    low = parts.groupBy("root").agg(F.min("least").alias("component_id"))
    told = members.join(parts.select("root", "part").join(low, "root"), ["root", "part"]).select("fp", "component_id")
    alone = distinct.join(groups, "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    known = told.unionByName(alone)
    return marked.join(known, "fp").select(F.col("key").alias(key), "fp", "component_id")
