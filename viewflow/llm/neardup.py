"""Near copies by SimHash: fingerprints, pigeonhole blocks, Hamming check, connected components.

Equal fingerprints are one row before anything is joined. A fingerprint is cut into blocks; two that differ in at
most `distance` bits agree on all but `distance` of them, so that each choice of the other blocks is a key, and close pairs share one.
Groups of a key are small, as a key has half the bits. In a group of up to `GROUP` fingerprints the distances are
taken at once and a spanning forest of the links is kept: as many rows as fingerprints, the same components. A
larger group is cut exactly once more: close pairs agree everywhere but on `distance` bits, so that all that agree
on a choice of the other bits are linked to the smallest of them, without any pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewflow.llm.common import blocks, stored

#: Words of a shingle, seed of its hash, bits that may differ, blocks of a fingerprint.
SHINGLE, SEED, DISTANCE, BLOCKS = 3, 42, 2, 4
#: Distinct fingerprints of a group whose distances are taken at once.
GROUP = 1000
#: Shingles whose bits are counted at a time.
_BITS_AT_ONCE = 200_000


def fingerprint(text: str, shingle: int = SHINGLE) -> bytes:
    """The eight bytes of a text's fingerprint; zero without a word."""
    words = text.encode().lower().split()
    if len(words) >= shingle:
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        digests = b"".join(map(xxhash.xxh64_digest, joined, repeat(SEED)))
    elif words:
        digests = xxhash.xxh64_digest(b" ".join(words), SEED)
    else:
        return bytes(8)
    rows = np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(rows), _BITS_AT_ONCE):
        counts += np.unpackbits(rows[at : at + _BITS_AT_ONCE], axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(counts * 2 > len(rows)).tobytes()


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """`key` and `bits`, the fingerprint as a long, of every row; a null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, 1):
            found = b"".join(fingerprint(x or "", shingle) for x in block.column(1).to_pylist())
            bits = np.frombuffer(found, dtype=">i8").astype(np.int64)
            yield pa.record_batch([block.column(0), bits], names=["key", "bits"])

    chosen = df.select(df[key].alias("key"), df[text].cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    return chosen.mapInArrow(run, f"key {kind}, bits long").withColumnRenamed("key", key)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _block_masks(distance: int, n_blocks: int) -> list[int]:
    """For each choice of blocks that close pairs may agree on, its bits."""
    cuts = [64 * i // n_blocks for i in range(n_blocks + 1)]
    block = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(n_blocks)]
    return [sum(chosen) for chosen in combinations(block, n_blocks - distance)]


def _forest(bits: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs within the distance, as places of the fingerprints."""
    out, left = [], np.arange(len(bits))
    while len(left):
        reached, left = left[:1], left[1:]
        while len(reached) and len(left):
            close = np.bitwise_count(bits[reached][:, None] ^ bits[left][None, :]) <= distance
            found = close.any(axis=0)
            out += zip(reached[close[:, found].argmax(axis=0)].tolist(), left[found].tolist())
            reached, left = left[found], left[~found]
    return out


def links(distinct: DataFrame, distance: int = DISTANCE, n_blocks: int = BLOCKS, group: int = GROUP) -> DataFrame:
    """`a` and `b`: links between distinct fingerprints (column `bits`) that connect all within the distance."""
    masks = _block_masks(distance, n_blocks)
    keys = F.array(*[F.col("bits").bitwiseAND(F.lit(_signed(mask))) for mask in masks])
    keyed = distinct.select("bits", F.posexplode(keys).alias("choice", "agreed"))
    sizes = keyed.groupBy("choice", "agreed").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stored(keyed.join(sizes, ["choice", "agreed"]))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = []
            for row in batch.column(0).to_pylist():
                bits = np.sort(np.array(row, dtype=np.int64).view(np.uint64))
                signed = bits.view(np.int64).tolist()
                pairs += [(signed[i], signed[j]) for i, j in _forest(bits, distance)]
            a, b = zip(*pairs) if pairs else ((), ())
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    grouped = shared.filter(F.col("size") <= group).groupBy("choice", "agreed").agg(F.collect_list("bits").alias("all"))
    found = grouped.select("all").mapInArrow(close, "a long, b long")
    large = shared.filter(F.col("size") > group)
    if not large.isEmpty():
        found = found.union(_links_by_bits(large.select("bits", "choice", "agreed"), masks, distance))
    return found.distinct()


def _links_by_bits(large: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """The links within large groups: to the smallest of those that agree but on some choice of bits."""
    choices = [
        [_signed(((1 << 64) - 1) ^ sum(bits)) for bits in combinations([1 << i for i in range(64) if not mask >> i & 1], distance)]
        for mask in masks
    ]
    tried: Column = F.lit(None).cast("array<bigint>")
    for number, kept in enumerate(choices):
        # One literal for each choice of blocks.
        values = F.split(F.lit(",".join(map(str, kept))), ",").cast("array<bigint>")
        tried = F.when(F.col("choice") == number, values).otherwise(tried)
    out = large.select("bits", "choice", "agreed", F.posexplode(tried).alias("number", "kept"))
    out = out.withColumn("rest", F.col("bits").bitwiseAND(F.col("kept")))
    same = ["choice", "agreed", "number", "rest"]
    least = out.groupBy(*same).agg(F.min("bits").alias("a"), F.count("*").alias("size")).filter("size > 1")
    return out.join(least, same).filter("bits > a").select("a", F.col("bits").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node it reaches, of every node of the links `a`, `b`.

    Large star and small star in turn: every node points its larger neighbours, then its smaller ones, to the
    smallest it knows. Each round is checkpointed, so that a lost executor never repeats earlier ones.
    """
    a, b = F.col("a"), F.col("b")
    now = edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct().checkpoint()
    state = None
    while True:
        both = now.union(now.select(b, a))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter(b > a).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.filter(b != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = small.union(least.select("a", F.col("m").alias("b"))).distinct().checkpoint()
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("b", "b"))


def near_copies(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """`key`, `fingerprint` (16 hex digits) and `component_id`, the smallest key linked to it, of every row.

    Texts without a word, nulls included, have fingerprint zero and are linked like any other. A null key is never
    the smallest unless its component has no other. Repeated rows stay, no rows give none.
    """
    found = stored(fingerprints(df, key, text, shingle))
    distinct = found.groupBy("bits").agg(F.min(key).alias("first"))
    linked = components(links(distinct.select("bits"), distance))
    rooted = distinct.join(linked.withColumnRenamed("node", "bits"), "bits", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "bits"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("bits", "component_id")
    hexed = F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint")
    return found.join(named, "bits").select(found[key], hexed, "component_id")


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of one row of each component: the one with the smallest key, any one of equal rows."""
    wrapped = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), F.monotonically_increasing_id().alias("id"))
    wrapped = stored(wrapped)
    order = F.struct(F.col(f"row.{key}").isNull(), F.col(f"row.{key}"), F.col("id"))
    ordered = wrapped.select(order.alias("order"), F.col(f"row.{text}").alias("text"))
    found = near_copies(ordered, "order", "text")
    kept = found.select(F.col("component_id.id").alias("id")).distinct()
    return wrapped.join(kept, "id", "left_semi").select("row.*")
