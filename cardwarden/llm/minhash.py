"""Near-duplicates by b-bit MinHash.

1. One pass over the texts makes each document's set of word shingles, its
   minima under many hash functions, a hash per band of minima (candidates), and
   a signature that keeps only the low bits of the minima, packed.
2. Documents with the same set are one class from here on, named by its smallest
   id; a group of copies of any size is a single row.
3. Classes that share a band hash meet at the smallest class of that band, a row
   per class and band and never a row per pair; the connected parts are the
   candidate clusters. A pair at the threshold is in one cluster unless all its
   bands differ, about 4 pairs in a million with the default bands.
4. A cluster's sets meet in tasks, a cluster that is too large in pairs of
   chunks. There the share of equal low bits, corrected for chance, estimates the
   similarity of pairs, and pairs that could reach the threshold (five standard
   deviations below it still count) are confirmed on the full sets, best
   estimates first; pairs that are connected already need no test. Links are
   confirmed until no likely pair is left between different components, and go
   on as stars, so that step 5 has no long chains to follow.
5. Confirmed links make components.

No bucket, cluster or list of partners is capped. Sets are held as 64-bit hashes
of shingles.

Defined results: a text without words, or null, is linked with nothing; a
text of fewer words than a shingle is one shingle; documents with the same id are
one node; a row with a null id belongs to the class of its text, but links
nothing by itself; extra columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import settled
from cardwarden.llm.components import components


@dataclass(frozen=True)
class MinHashPolicy:
    """Similarity is a percentage; `bands` times `rows` hash functions, `rows` at most 16."""

    shingle: int = 3
    percent: int = 85
    bands: int = 32
    rows: int = 7
    likely: float = 0.15
    chunk_shingles: int = 2_000_000
    seed: int = 7

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


BITS = 2
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64
)


class _Hashes(dict):
    """64-bit hash of a word; forgets all when it has become large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _ODD[4]
    x = (x ^ (x >> np.uint64(29))) * _ODD[3]
    return x ^ (x >> np.uint64(32))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    words = words_of(text)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    width = min(size, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        total = _mix(total * _ODD[0] + h[i : len(h) - width + 1 + i])
    return np.unique(total)


def minima(hashes: np.ndarray, policy: MinHashPolicy) -> np.ndarray:
    """The smallest value of the set under each hash function (32 bits)."""
    dice = np.random.default_rng(policy.seed)
    a, b = dice.integers(0, 1 << 31, (2, policy.hashes, 1), np.uint32) * 2 + 1
    low, high = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(policy.hashes, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), 2048):
        np.minimum(least, (a * low[at : at + 2048] + b * high[at : at + 2048]).min(1), out=least)
    return least


def band_hashes(least: np.ndarray, policy: MinHashPolicy) -> np.ndarray:
    """One hash per band, the number of the band included."""
    rows = least.reshape(policy.bands, policy.rows).astype(np.uint64)
    total = np.arange(1, policy.bands + 1, dtype=np.uint64)
    for i in range(policy.rows):
        total = _mix(total * _ODD[1] + rows[:, i])
    return total.view(np.int64)


def pack(least: np.ndarray) -> bytes:
    """The low two bits of each minimum, four to a byte, padded to whole 64-bit words."""
    low = (least & 3).astype(np.uint8)
    low = np.concatenate((low, np.zeros(-len(low) % 32, np.uint8))).reshape(-1, 4)
    return (low[:, 0] | low[:, 1] << 2 | low[:, 2] << 4 | low[:, 3] << 6).tobytes()


def estimated(packed: np.ndarray, one: np.ndarray, hashes: int) -> np.ndarray:
    """Similarity of one signature to many: share of equal low bits, corrected for chance."""
    differ = packed ^ one
    differ = (differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)
    equal = 1 - np.bitwise_count(differ).sum(1) / hashes
    chance = 0.5**BITS
    return (equal - chance) / (1 - chance)


def signatures(docs: DataFrame, key: str, text: str, policy: MinHashPolicy) -> DataFrame:
    """Rows (id, n_shingles, digest, signature, bands); the last three are null without words."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, packed, bands = [], [], [], []
            for x in batch.column(1):
                hashes = shingle_set(x.as_py(), policy.shingle)
                n.append(len(hashes))
                if len(hashes):
                    least = minima(hashes, policy)
                    digest.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                    packed.append(pack(least))
                    bands.append(band_hashes(least, policy))
                else:
                    digest.append(None), packed.append(None), bands.append(None)
            columns = [
                batch.column(0),
                pa.array(n, pa.int64()),
                pa.array(digest, pa.binary()),
                pa.array(packed, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_shingles", "digest", "signature", "bands"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        make, f"id {kind}, n_shingles long, digest binary, signature binary, bands array<bigint>"
    )


def linked(
    ids: list, sets: list[np.ndarray], packed: np.ndarray, policy: MinHashPolicy, block: int = 256
) -> list[tuple]:
    """Confirmed links that connect everything that is connected among these sets; equal ids are connected.

    Sets go by size, so those that may reach a set are a stretch before it. The
    stretch is compared a block at a time, the nearest sizes first, and what a link
    has connected drops out.
    """
    found = []
    order = sorted(range(len(ids)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order])
    packed = packed[order]
    label = np.unique([ids[i] for i in order], return_inverse=True)[1]
    floor = policy.percent / 100 - policy.likely
    for i in range(1, len(order)):
        low = np.searchsorted(100 * sizes[:i], policy.percent * sizes[i])
        near = low + np.flatnonzero(label[low:i] != label[i])
        while len(near):
            some, near = near[-block:], near[:-block]
            likeness = estimated(packed[some], packed[i], policy.hashes)
            likely = some[np.argsort(-likeness, kind="stable")][: int((likeness >= floor).sum())]
            for j in likely.tolist():
                if label[j] == label[i]:
                    continue
                both = len(np.intersect1d(sets[order[i]], sets[order[j]], assume_unique=True))
                if 100 * both >= policy.percent * (sizes[i] + sizes[j] - both):
                    found.append((ids[order[j]], ids[order[i]]))
                    label[label == label[i]] = label[j]
                    near = near[label[near] != label[i]]
    return found


def stars(links: list[tuple]) -> list[tuple]:
    """The same components as links from each one's smallest id."""
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return [(top(x), x) for x in list(root) if top(x) != x]


def confirmed_links(members: DataFrame, docs: DataFrame, key: str, text: str, policy: MinHashPolicy) -> DataFrame:
    """Links (a, b) within clusters, as stars; `members` has rows (id, cluster, n_shingles, digest)."""
    kind = members.schema["id"].dataType.simpleString()
    chunks = members.groupBy("cluster").agg(
        F.ceil(F.sum("n_shingles") / policy.chunk_shingles).cast("int").alias("chunks")
    )
    placed = members.join(chunks, "cluster").withColumn(
        "chunk", F.pmod(F.xxhash64("id", F.lit(policy.seed)), F.col("chunks")).cast("int")
    )
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            sets = [shingle_set(t, policy.shingle) for t in rows["text"]]
            kept = [i for i, s in enumerate(sets) if xxhash.xxh3_128_digest(s.tobytes()) == rows["digest"][i]]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(pa.array(kept, pa.int64())) for c in range(4)),
                    pa.array([sets[i].tobytes() for i in kept], pa.binary()),
                    pa.array([pack(minima(sets[i], policy)) for i in kept], pa.binary()),
                ],
                names=["id", "cluster", "chunks", "chunk", "hashes", "signature"],
            )

    # Members grow with the documents: the same join at every size, never a broadcast of one side.
    met = placed.join(texts.hint("merge"), "id").select("id", "cluster", "chunks", "chunk", "digest", "text")
    sets = met.mapInArrow(
        sets_of, f"id {kind}, cluster {kind}, chunks int, chunk int, hashes binary, signature binary"
    )
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    paired = sets.withColumn("other", other).select(
        "cluster",
        "chunks",
        F.least("chunk", "other").alias("first"),
        F.greatest("chunk", "other").alias("second"),
        "id",
        "hashes",
        "signature",
    )
    # A large cluster needs no task for a chunk alone: each pair of chunks looks inside both.
    paired = paired.filter("chunks = 1 OR first != second").drop("chunks")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        last, group = None, []

        def solve() -> pa.RecordBatch:
            rows = sorted(set(group))  # rows with the same id and set are one; an id may have several sets
            sets = [np.frombuffer(r[1], np.uint64) for r in rows]
            packed = np.stack([np.frombuffer(r[2], np.uint64) for r in rows])
            found = stars(linked([r[0] for r in rows], sets, packed, policy))
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], schema.types[0]), pa.array([f[1] for f in found], schema.types[1])],
                schema=schema,
            )

        for batch in batches:
            rows = batch.to_pydict()
            for at, place in enumerate(zip(rows["cluster"], rows["first"], rows["second"])):
                if place != last:
                    if len(group) > 1:
                        yield solve()
                    last, group = place, []
                group.append((rows["id"][at], rows["hashes"][at], rows["signature"][at]))
        if len(group) > 1:
            yield solve()

    place = ["cluster", "first", "second"]
    dealt = paired.repartition(*place).sortWithinPartitions(*place)
    return dealt.mapInArrow(confirm, "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", policy: MinHashPolicy = MinHashPolicy()
) -> DataFrame:
    """Rows (id, n_shingles, component_id), one per row of `docs`; ids are integers."""
    marked = settled(signatures(docs.withColumn(key, F.col(key).cast("long")), key, text, policy))
    classes = settled(
        marked.filter("digest IS NOT NULL AND id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    )
    banded = classes.select("id", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    met = banded.join(hubs, "band").filter("id != a").select("a", F.col("id").alias("b"))
    clusters = components(met)
    members = settled(
        classes.join(clusters, F.col("id") == F.col("node")).select(
            "id", F.col("component").alias("cluster"), "n_shingles", "digest"
        )
    )
    named = classes.select(F.col("digest").alias("__digest"), F.col("id").alias("__class"))
    links = confirmed_links(members, docs, key, text, policy)
    # An id with several sets is one node: it links the classes of its sets.
    several = (
        marked.filter("digest IS NOT NULL AND id IS NOT NULL")
        .groupBy("id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).filter("least != most")
    )
    if not several.isEmpty():
        own = marked.join(several, "id", "left_semi").join(named, F.col("digest") == F.col("__digest"))
        links = links.unionByName(own.select(F.col("id").alias("a"), F.col("__class").alias("b")))
    found = components(links)
    return (
        marked.join(named, F.col("digest") == F.col("__digest"), "left")
        .join(found, F.col("__class") == F.col("node"), "left")
        .select("id", "n_shingles", F.coalesce("component", "__class", "id").alias("component_id"))
    )


def op7_near_duplicates(docs: DataFrame) -> DataFrame:
    """The component of every document, and whether it is the one to keep."""
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
