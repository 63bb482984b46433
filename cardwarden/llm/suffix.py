"""Removal of long repeats: Burrows-Wheeler transforms of shards, merged by interleave refinement.

A byte is removed if a `length`-byte string that covers it also starts in a
document with a smaller id.

1. Documents with equal texts are known by a hash of the text; all but the one
   with the smallest id are removed whole, and only that one takes part in what
   follows, so a group of copies of any size is one text.
2. Every window of `length` bytes is represented by its anchor, the smallest hash
   of the 16-byte strings inside it. Equal windows have equal anchors, so windows
   whose anchor occurs in one text only cannot repeat; they are most of the
   text and go no further. Anchors of a batch are combined before they travel, so
   an anchor found in very many documents is one row per batch.
3. The windows that share an anchor in a row form a segment. Equal segments are
   combined, with their smallest document, before any text travels; each
   different one meets the others of its anchor once, and is cut to the part
   that some other of them may repeat, by comparing what stands around the
   anchor. Equal parts are one string again.
4. In a task, strings are dealt into shards; each shard's suffixes are sorted
   once, which gives its transform. The transforms are merged without sorting
   suffixes again: from an order by zero characters, each round of refinement
   reads the merged transform, sorts it stably by character and so obtains the
   interleave by one more character, together with the places where neighbours
   begin to differ (the common prefixes). After `length` rounds the suffixes
   between two such places are the repeated intervals, and the smallest document
   of an interval decides about all its windows.
5. Anchors whose different segments exceed `hot_bytes`, such as that of a line in a
   third of all documents with other text around it each time, are never brought
   together: their windows are 128-bit hashes, a pre-aggregated minimum finds the
   smallest document of each, and both sides of the join back are rows of fixed
   size.
6. The decisions go back to the documents that hold the segments, as runs.

Results are exact but for coincidences of 128-bit hashes of texts, segments and
windows.

Defined results: null is the empty text; texts shorter than `length` bytes keep
everything; rows with the same id never remove from each other; a null id
neither removes nor loses anything; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import settled
from cardwarden.session import discard

LENGTH = 50
GRAM = 16
PART_BYTES = 12 << 20
BLOCK_BYTES = 4 << 20
HOT_BYTES = 4 << 20
WINDOW_ROWS = 1 << 18
CHUNK = 1 << 18
SHARDS = 4
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)
_FAR = np.iinfo(np.int64).max


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _gram_hashes(raw: bytes) -> np.ndarray:
    """Hash of the 16 bytes at every place."""
    n = len(raw)
    if n < GRAM:
        return np.empty(0, np.uint64)
    words = np.ndarray((n - 7,), "<u8", raw, 0, (1,))
    gram = words[: n - GRAM + 1] * _ODD[0]
    gram ^= gram >> np.uint64(29)
    gram += words[8 : n - GRAM + 9] * _ODD[1]
    gram ^= gram >> np.uint64(32)
    gram *= _ODD[2]
    return gram ^ (gram >> np.uint64(29))


def runs_of_windows(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows) of the runs of windows with one anchor."""
    n = len(raw)
    if n < length:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    least, width, wanted = _gram_hashes(raw), 1, length - GRAM + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wanted:
        least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return least[first], first, np.diff(np.concatenate((first, [len(least)])))


def _suffix_order(text: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of strings (bytes from 1 on, each ended by 0) by their first `depth` bytes."""
    n = len(text)
    stop = np.repeat(ends, np.diff(np.concatenate(([0], ends))))
    padded = np.concatenate((text, np.zeros(depth + 8, np.uint8)))
    left = stop - np.arange(n)  # bytes up to and with the end mark
    keys = []
    for at in range(0, depth, 8):
        word = np.ndarray((n,), ">u8", padded.tobytes(), at, (1,)).astype(np.uint64)
        have = np.clip(left - at, 0, 8).astype(np.uint64)
        cut = np.where(have > 0, (np.uint64(8) - np.maximum(have, np.uint64(1))) * np.uint64(8), np.uint64(0))
        keys.append(np.where(have > 0, word >> cut << cut, np.uint64(0)))
    return np.lexsort(keys[::-1])


class Transform:
    """The transform of one shard of strings: sorted suffixes and the bytes before them."""

    def __init__(self, strings: list[bytes], depth: int):
        text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8) + np.uint8(1)  # 0xFF is in no UTF-8 text
        ends = np.flatnonzero(text == 0) + 1
        self.order = _suffix_order(text, ends, depth)
        before = np.concatenate((text[-1:], text[:-1]))
        self.before = before[self.order]
        self.string = np.repeat(np.arange(len(strings)), np.diff(np.concatenate(([0], ends))))[self.order]
        starts = np.concatenate(([0], ends[:-1]))
        self.start = self.order - starts[self.string]
        self.left = ends[self.string] - 1 - self.order


def merge_transforms(shards: list[Transform], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each merged place, number of its interval) after `depth` rounds of refinement."""
    sizes = [len(s.before) for s in shards]
    before = np.concatenate([s.before for s in shards])
    which = np.repeat(np.arange(len(shards), dtype=np.uint8), sizes)
    ends = np.repeat(np.arange(len(shards), dtype=np.uint8), [int((s.before == 0).sum()) for s in shards])
    group = np.zeros(len(which), np.int32)
    for _ in range(depth):
        merged = np.empty_like(before)
        merged[np.argsort(which, kind="stable")] = before
        order = np.argsort(merged, kind="stable")[len(ends) :]
        byte, old = merged[order], group[order]
        differs = np.concatenate(([True], (byte[1:] != byte[:-1]) | (old[1:] != old[:-1])))
        group = np.concatenate((np.zeros(len(ends), np.int32), np.cumsum(differs, dtype=np.int32)))
        which = np.concatenate((ends, which[order]))
    return which, group


def least_documents(strings: list[bytes], docs: np.ndarray, length: int = LENGTH, shards: int = SHARDS) -> list[np.ndarray]:
    """For every window of every string, the smallest document of the strings that contain it."""
    count = max(1, min(shards, len(strings)))
    dealt = [range(i, len(strings), count) for i in range(count)]
    made = [Transform([strings[j] for j in own], length) for own in dealt]
    which, group = merge_transforms(made, length)
    places = np.argsort(which, kind="stable")  # merged places of the shards' suffixes, shard by shard
    string = np.concatenate([np.array(own)[t.string] for own, t in zip(dealt, made)])
    start = np.concatenate([t.start for t in made])
    whole = np.concatenate([t.left for t in made]) >= length
    doc = np.full(len(which), _FAR)
    doc[places] = np.where(whole, docs[string], _FAR)
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    least = np.minimum.reduceat(doc, first)
    mine = least[np.cumsum(np.concatenate(([False], group[1:] != group[:-1])))][places]
    offsets = np.concatenate(([0], np.cumsum([max(0, len(s) - length + 1) for s in strings])))
    out = np.empty(offsets[-1], np.int64)
    out[offsets[string[whole]] + start[whole]] = mine[whole]
    return [out[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _shared_anchors(docs: DataFrame, parts: int, length: int) -> DataFrame:
    """Rows (name, anchor): anchors of the text that some other text may have too.

    `docs` has rows (name, text), where equal texts have the same name.
    """
    kind = "part int, anchors binary, names binary, known binary"

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, places = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_index=True)
            texts = batch.column(1)
            found = [np.unique(runs_of_windows(_utf8(texts[int(i)].as_py()), length)[0]) for i in places]
            anchor = np.concatenate([*found, np.empty(0, np.uint64)])
            doc = np.repeat(names, [len(f) for f in found])
            order = np.argsort(anchor)
            anchor, doc = anchor[order], doc[order]
            new = np.concatenate(([True], anchor[1:] != anchor[:-1])) if len(anchor) else np.empty(0, bool)
            many = np.concatenate((~new[1:], [False])) | ~new if len(new) else new
            # The first of a batch asks for all (known: 1 if the batch has several); the others need no answer.
            known = np.where(new, many, 2).astype(np.uint8)
            part = np.where(new, anchor, doc.astype(np.uint64) * _ODD[0] >> np.uint64(20)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            part, anchor, doc, known = part[order], anchor[order], doc[order], known[order]
            cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else []
            stops = [*cuts[1:], len(part)] if len(part) else []
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([int(part[a]) for a in cuts], pa.int32()),
                    "anchors": pa.array([anchor[a:b].tobytes() for a, b in zip(cuts, stops)], pa.binary()),
                    "names": pa.array([doc[a:b].tobytes() for a, b in zip(cuts, stops)], pa.binary()),
                    "known": pa.array([known[a:b].tobytes() for a, b in zip(cuts, stops)], pa.binary()),
                }
            )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list[np.ndarray]] = [[], [], []]
        for batch in batches:
            for c, (name, t) in enumerate((("anchors", np.uint64), ("names", np.int64), ("known", np.uint8))):
                columns[c] += [np.frombuffer(x.as_buffer(), t) for x in batch.column(name)]
        if not columns[0]:
            return
        anchor, doc, known = (np.concatenate(c) for c in columns)
        order = np.argsort(anchor)
        anchor, doc, known = anchor[order], doc[order], known[order]
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        sizes = np.diff(np.concatenate((first, [len(anchor)])))
        several = np.maximum.reduceat(doc, first) != np.minimum.reduceat(doc, first)
        shared = several | (np.maximum.reduceat(known, first) > 0)
        keep = np.repeat(shared, sizes)
        anchor, doc = anchor[keep], doc[keep]
        for at in range(0, len(doc), 1_000_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[at : at + 1_000_000]), pa.array(anchor[at : at + 1_000_000].view(np.int64))],
                names=["name", "anchor"],
            )

    asked = docs.select("name", "text").mapInArrow(collect, kind)
    return asked.repartition(parts, "part").mapInArrow(answer, "name long, anchor long")


def _occurrences(docs: DataFrame, shared: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """Rows (digest, anchor, windows, doc, mark, at): every segment with a shared anchor, without its text.

    `at` is its first byte in document `doc`, the first one with its text, whose
    hash is `mark`.
    """
    schema = pa.schema(
        [
            ("digest", pa.binary()),
            ("anchor", pa.int64()),
            ("windows", pa.int64()),
            ("doc", pa.int64()),
            ("mark", pa.int64()),
            ("at", pa.int64()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests: list[bytes] = []
            parts: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(5)]
            for doc, mark, text, lists in zip(*(batch.column(i) for i in range(4))):
                raw = _utf8(text.as_py())
                anchor, first, windows = runs_of_windows(raw, length)
                on = np.isin(anchor, lists.values.to_numpy().view(np.uint64))
                first, windows = first[on], windows[on]
                stops = (first + windows + (length - 1)).tolist()
                digests += [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(first.tolist(), stops)]
                own = np.full((2, len(first)), [[doc.as_py()], [mark.as_py()]], np.int64)
                for column, values in zip(parts, (anchor[on].view(np.int64), windows, own[0], own[1], first)):
                    column.append(values)
            columns = [pa.array(digests, pa.binary()), *(pa.array(np.concatenate(c)) for c in parts)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    lists = shared.groupBy("name").agg(F.collect_set("anchor").alias("lists"))
    wanted = firsts.join(lists, firsts["mark"] == lists["name"]).select(
        F.col("doc").alias("of"), F.col("mark").alias("of_mark"), "lists"
    )
    met = docs.hint("merge").join(
        wanted, (F.col("doc") == F.col("of")) & (F.col("mark") == F.col("of_mark"))
    ).select("doc", "mark", "text", "lists")
    return met.mapInArrow(cut, "digest binary, anchor long, windows long, doc long, mark long, at long")


def _carriers(occurrences: DataFrame) -> DataFrame:
    """Of each different segment the occurrence in the smallest document; `many`: others hold it too."""
    first = F.min(F.struct("doc", "mark", "at", "windows", "anchor")).alias("f")
    return occurrences.groupBy("digest").agg(first, F.max("doc").alias("last")).select(
        "digest", "f.*", (F.col("last") > F.col("f.doc")).alias("many")
    )


def _distinct_segments(docs: DataFrame, carriers: DataFrame, length: int) -> DataFrame:
    """Rows (anchor, digest, doc, many, segment): each different segment once, from its smallest document."""
    wanted = carriers.groupBy(F.col("doc").alias("of"), F.col("mark").alias("of_mark")).agg(
        F.collect_list(F.struct("at", "windows", "anchor", "many", "digest")).alias("wanted")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, told in zip(*(batch.column(i) for i in range(3))):
                raw, own = _utf8(text.as_py()), told.values
                at, windows, anchor, many, digest = (own.field(i) for i in range(5))
                pieces = [raw[a : a + w + length - 1] for a, w in zip(at.to_pylist(), windows.to_pylist())]
                docs_of = pa.array(np.full(len(pieces), doc.as_py(), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [anchor, digest, docs_of, many, pa.array(pieces, pa.binary())],
                    names=["anchor", "digest", "doc", "many", "segment"],
                )

    # Repeated rows of a document bring the same segments again, which changes nothing.
    met = docs.hint("merge").join(
        wanted, (F.col("doc") == F.col("of")) & (F.col("mark") == F.col("of_mark"))
    ).select("doc", "text", "wanted")
    return met.mapInArrow(cut, "anchor long, digest binary, doc long, many boolean, segment binary")


def _mix(x: np.ndarray, odd: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * odd
    return x ^ (x >> np.uint64(29))


def shared_parts(
    text: np.ndarray, starts: np.ndarray, ends: np.ndarray, anchors: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, name) of the part of each segment that some other segment of its anchor may repeat.

    `starts` and `ends` are the segments' places in `text`. Segments of an anchor
    are aligned at the anchor's string. What a segment has in common with its
    neighbours in the order of the text behind the anchor, and of the text before
    it read backwards, is the most it has in common with any. `name` is a hash of
    two words; equal parts of an anchor have equal names.
    """
    sizes = ends - starts
    owner = np.repeat(np.arange(len(sizes)), sizes)
    grams = _gram_hashes(text.tobytes())
    of = owner[: len(grams)]
    found = np.flatnonzero((np.arange(len(grams)) + GRAM <= ends[of]) & (grams.view(np.int64) == anchors[of]))
    times = np.bincount(owner[found], minlength=len(sizes))
    place = starts.copy()
    place[owner[found][::-1]] = found[::-1]
    left, right = place - starts, ends - place - GRAM
    widest = 64
    once = (times == 1) & (left <= widest) & (right <= widest)
    # A segment with its anchor twice could be aligned in other ways; it and its whole group stay as they are.
    loose = np.isin(anchors, anchors[~once])

    def common(step: int, first: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = -(-max(1, int(np.minimum(room[~loose], widest).max(initial=1))) // 8) * 8
        reach = np.arange(width)
        rows = text[np.clip(first[:, None] + step * reach, 0, len(text) - 1)]
        rows[reach >= np.minimum(room, width)[:, None]] = 0
        words = rows.view(">u8")
        order = np.lexsort([*(words[:, i] for i in range(width // 8 - 1, -1, -1)), anchors])
        same = rows[order[1:]] == rows[order[:-1]]
        length = np.where(same.all(1), width, same.argmin(1))
        length = np.minimum(length, np.minimum(room[order[1:]], room[order[:-1]]))
        length = np.where(anchors[order[1:]] == anchors[order[:-1]], length, 0)
        most = np.zeros(len(sizes), np.int64)
        np.maximum.at(most, order[1:], length)
        np.maximum.at(most, order[:-1], length)
        rows[reach >= most[:, None]] = 0
        return most, rows.view("<u8")

    before, left_words = common(-1, place - 1, left)
    after, right_words = common(1, place + GRAM, right)
    start = np.where(loose, 0, left - before)
    stop = np.where(loose, sizes, left + GRAM + after)
    name = np.stack([(before + 128 * after).astype(np.uint64), anchors.view(np.uint64)])
    for words in (left_words, right_words):
        for i in range(words.shape[1]):
            name[0] = _mix(name[0] * _ODD[0] + words[:, i], _ODD[1])
            name[1] = _mix(name[1] * _ODD[2] + words[:, i], _ODD[0])
    for i in np.flatnonzero(loose):
        digest = xxhash.xxh3_128_intdigest(text[starts[i] : ends[i]].tobytes())
        name[0, i], name[1, i] = digest >> 64, digest & 0xFFFFFFFFFFFFFFFF
    return start, stop, name


def decide_segments(
    text: np.ndarray, starts: np.ndarray, ends: np.ndarray, anchors: np.ndarray, docs: np.ndarray,
    length: int, chunk: int, shards: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Runs (segment, first window, windows, smallest document) in the segments' shared parts.

    The last result is each segment's shared part in windows (start, stop);
    windows outside it have their own segment's document. Equal parts are one
    string, and an anchor with one string needs no merge.
    """
    start, stop, name = shared_parts(text, starts, ends, anchors)
    windows = np.maximum(0, stop - start - length + 1)
    use = np.flatnonzero(windows)
    order = use[np.lexsort((name[1, use], name[0, use], anchors[use]))]
    a, x, y = anchors[order], name[0, order], name[1, order]
    new_anchor = np.concatenate(([True], a[1:] != a[:-1]))[: len(order)]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])))[: len(order)]
    string = np.cumsum(new) - 1  # number of the distinct part of each segment in order
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(docs[order], first) if len(first) else np.empty(0, np.int64)
    group = (np.cumsum(new_anchor) - 1)[first]
    several = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.empty(0, bool)
    parts = [[use[:0]], [use[:0]], [use[:0]], [use[:0]]]

    def put(segments, at, count, smallest) -> None:
        for column, values in zip(parts, (segments, at, count, smallest)):
            column.append(np.asarray(values, np.int64))

    alone = ~several[string]
    own = order[alone]
    put(own, start[own], windows[own], least[string[alone]])
    # Distinct parts that stand beside others of their anchor are merged, a chunk of anchors at a time.
    merged = np.flatnonzero(several)
    lengths = (stop - start)[order[first[merged]]] + 1
    last_of_group = np.flatnonzero(np.concatenate((group[merged][1:] != group[merged][:-1], [True])))[: len(merged)]
    filled = np.cumsum(lengths)
    members = np.diff(np.concatenate((first, [len(order)])))
    at = 0
    while at < len(merged):
        done = filled[at - 1] if at else 0
        ends_here = last_of_group[last_of_group >= at]
        stop_at = ends_here[min(len(ends_here) - 1, int(np.searchsorted(filled[ends_here], done + chunk)))] + 1
        chosen = merged[at:stop_at]
        leaders = order[first[chosen]]
        strings = [text[starts[i] + start[i] : starts[i] + stop[i]].tobytes() for i in leaders]
        for j, found in zip(chosen.tolist(), least_documents(strings, least[chosen], length, shards)):
            cuts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
            counts = np.diff(np.concatenate((cuts, [len(found)])))
            holders = order[first[j] : first[j] + members[j]]
            put(
                np.repeat(holders, len(cuts)),
                (start[holders][:, None] + cuts).ravel(),
                np.tile(counts, len(holders)),
                np.tile(found[cuts], len(holders)),
            )
        at = stop_at
    runs = [np.concatenate(c) for c in parts]
    low = np.where(windows > 0, start, 0)
    return (*runs, (low, low + windows))


def _decisions(segments: DataFrame, parts: int, length: int, chunk: int, shards: int) -> DataFrame:
    """Rows (digest, start, windows, least): runs of a segment's windows with the same smallest document."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks() if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        pieces = pa.concat_arrays([c.cast(pa.large_binary()) for c in table["segment"].chunks])
        offsets = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        text = np.frombuffer(pieces.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        starts, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        anchors, docs = table["anchor"].to_numpy(), table["doc"].to_numpy()
        many = table["many"].to_numpy()
        order = np.argsort(anchors)
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(anchors[order]) != 0)))
        block = np.cumsum((ends - starts)[order])[cuts] // BLOCK_BYTES  # whole anchors, a few MB at a time
        found: list[list[np.ndarray]] = [[], [], [], []]
        low, high = np.zeros(len(anchors), np.int64), np.zeros(len(anchors), np.int64)
        edges = [*cuts[np.flatnonzero(np.concatenate(([True], np.diff(block) != 0)))].tolist(), len(order)]
        for a, b in zip(edges[:-1], edges[1:]):
            own = order[a:b]
            sizes = (ends - starts)[own]
            stops = np.cumsum(sizes)
            places = np.repeat(starts[own] - (stops - sizes), sizes) + np.arange(stops[-1])
            *runs, (first, last) = decide_segments(
                text[places], stops - sizes, stops, anchors[own], docs[own], length, chunk, shards
            )
            low[own], high[own] = first, last
            for column, values in zip(found, (own[runs[0]], *runs[1:])):
                column.append(values)
        segment, at, count, least = (np.concatenate(c) for c in found)
        # Copies of a whole segment in other documents follow its smallest document outside the shared part.
        copied = np.flatnonzero(many)
        whole = (ends - starts - length + 1)[copied]
        segment = np.concatenate((segment, copied, copied))
        at = np.concatenate((at, np.zeros(len(copied), np.int64), high[copied]))
        count = np.concatenate((count, low[copied], whole - high[copied]))
        least = np.concatenate((least, docs[copied], docs[copied]))
        kept = np.flatnonzero((count > 0) & (many[segment] | (least < docs[segment])))
        for a in range(0, len(kept), 100_000):
            own = kept[a : a + 100_000]
            yield pa.RecordBatch.from_arrays(
                [
                    table["digest"].take(pa.array(segment[own])).combine_chunks(),
                    pa.array(at[own]),
                    pa.array(count[own]),
                    pa.array(least[own]),
                ],
                names=["digest", "start", "windows", "least"],
            )

    dealt = segments.repartition(parts, "anchor").select("anchor", "digest", "doc", "many", "segment")
    return dealt.mapInArrow(decide, "digest binary, start long, windows long, least long")


def _hot_anchors(carriers: DataFrame, hot_bytes: int, length: int) -> DataFrame:
    """Rows (anchor): those whose different segments have more than `hot_bytes` in all."""
    sizes = carriers.groupBy("anchor").agg(F.sum(F.col("windows") + (length - 1)).alias("bytes"))
    return sizes.filter(F.col("bytes") > hot_bytes).select("anchor")


def _window_names(text: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of two words of the `length` bytes at every place."""
    words = np.ndarray((len(text) - 7,), "<u8", text.tobytes(), 0, (1,))
    x = np.full(len(places), length, np.uint64)
    y = x.copy()
    for at in (*range(0, length - 8, 8), length - 8):
        word = words[places + at]
        x = _mix(x * _ODD[0] + word, _ODD[1])
        y = _mix(y * _ODD[2] + word, _ODD[0])
    return x, y


def _hashed_windows(segments: DataFrame, length: int) -> DataFrame:
    """Rows (x, y, digest, doc, start, windows): the windows of each segment; equal neighbours are one row."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            pieces = batch.column(2).cast(pa.large_binary())
            offsets = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
            text = np.frombuffer(pieces.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            starts = offsets[:-1] - offsets[0]
            stops = np.cumsum(np.diff(offsets) - length + 1)  # windows up to and with each segment
            docs = batch.column(1).to_numpy()
            for a in range(0, int(stops[-1]), WINDOW_ROWS):
                flat = np.arange(a, min(a + WINDOW_ROWS, int(stops[-1])))
                own = np.searchsorted(stops, flat, "right")
                start = flat - np.concatenate(([0], stops))[own]
                low = int(starts[own[0]] + start[0])
                high = int(starts[own[-1]] + start[-1]) + length
                x, y = _window_names(text[low:high], starts[own] + start - low, length)
                new = (own[1:] != own[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
                first = np.flatnonzero(np.concatenate(([True], new)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(x[first].view(np.int64)),
                        pa.array(y[first].view(np.int64)),
                        batch.column(0).take(pa.array(own[first])),
                        pa.array(docs[own[first]]),
                        pa.array(start[first]),
                        pa.array(np.diff(np.concatenate((first, [len(flat)])))),
                    ],
                    names=["x", "y", "digest", "doc", "start", "windows"],
                )

    kind = "x long, y long, digest binary, doc long, start long, windows long"
    return segments.select("digest", "doc", "segment").mapInArrow(explode, kind)


def _window_decisions(segments: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Rows as of `_decisions`, for anchors of any number of segments; and the stored table they read.

    No task holds an anchor: windows meet as hashes, with partial minima before
    the shuffle, and the table joined back is a stored one, whose join run-time
    skew handling can split.
    """
    windows = _hashed_windows(segments, length)
    least = windows.groupBy("x", "y").agg(F.min("doc").alias("least"), F.max("doc").alias("last"))
    repeated = settled(least.filter("last > least").select("x", "y", "least"))
    met = windows.join(repeated.hint("merge"), ["x", "y"]).filter("least < doc")
    lists = met.groupBy("digest").agg(F.collect_list(F.struct("start", "windows", "least")).alias("found"))

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(1)
            start, windows, least = (x.to_numpy() for x in found.flatten().flatten())
            row = np.repeat(np.arange(len(found)), found.value_lengths().to_numpy())
            order = np.lexsort((start, row))
            row, start, stop, least = row[order], start[order], (start + windows)[order], least[order]
            first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] != stop[:-1])))[: len(row)])
            last = np.concatenate((first[1:], [len(row)])) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row[first])),
                    pa.array(start[first]),
                    pa.array(stop[last[: len(first)]] - start[first]),
                    pa.array(np.maximum.reduceat(least, first) if len(first) else least),
                ],
                names=["digest", "start", "windows", "least"],
            )

    runs = lists.mapInArrow(join_up, "digest binary, start long, windows long, least long")
    # Copies of a whole segment in other documents follow its smallest document.
    count = (F.octet_length("segment") - (length - 1)).cast("long")
    whole = segments.filter("many").select(
        "digest", F.lit(0).cast("long").alias("start"), count.alias("windows"), F.col("doc").alias("least")
    )
    return runs.unionByName(whole), repeated


def removed_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    part_bytes: int = PART_BYTES,
    chunk: int = CHUNK,
    shards: int = SHARDS,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """Rows (doc, mark, runs): the removed (start, stop) in bytes, not yet joined; mark is the text's hash."""
    own = docs.filter(F.col(key).isNotNull() & (F.octet_length(text) >= length)).select(
        F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("mark"), F.col(text).alias("text")
    )
    size = own.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = 1 + size // part_bytes
    same = own.select("doc", "mark", F.unhex(F.md5("text")).alias("same"), F.octet_length("text").alias("bytes"))
    firsts = settled(same.groupBy("same").agg(F.min(F.struct("doc", "mark")).alias("f")).select("same", "f.*"))
    shared = settled(_shared_anchors(own.select(F.col("mark").alias("name"), "text"), parts, length))
    occurrences = settled(_occurrences(own, shared, firsts, length))
    discard(shared)
    carriers = settled(_carriers(occurrences))
    segments = settled(_distinct_segments(own, carriers, length))
    # A segment has at most `length` bytes per window, so in a small table no anchor can be hot.
    hot = settled(_hot_anchors(carriers, hot_bytes, length)) if size * length > hot_bytes else None
    discard(carriers)
    if hot is None or hot.isEmpty():
        decided = settled(_decisions(segments, parts, length, chunk, shards))
    else:
        few = _decisions(segments.join(F.broadcast(hot), "anchor", "left_anti"), parts, length, chunk, shards)
        many, repeated = _window_decisions(segments.join(F.broadcast(hot), "anchor", "left_semi"), length)
        decided = settled(few.unionByName(many))
        discard(repeated)
    if hot is not None:
        discard(hot)
    discard(segments)
    places = occurrences.select("digest", "doc", "mark", "at")
    met = places.join(decided.hint("merge"), "digest").filter("least < doc")
    run = F.struct((F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("start") + F.col("windows") + (length - 1)).alias("stop"))
    parts_of = met.groupBy("doc", "mark").agg(F.collect_set(run).alias("runs"))
    first = firsts.select(F.col("same").alias("of"), F.col("doc").alias("first"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("bytes").cast("long").alias("stop")))
    copies = same.join(first, F.col("same") == F.col("of")).filter("doc > first").select(
        "doc", "mark", whole.alias("runs")
    )
    runs = settled(parts_of.unionByName(copies.dropDuplicates(["doc", "mark"])))
    for table in (occurrences, decided, firsts):
        discard(table)
    return runs


def joined_runs(runs: list[dict]) -> list[tuple[int, int]]:
    """Overlapping or touching runs as maximal ones."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((r["start"], r["stop"]) for r in runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows (key, n_bytes, removed: array of (start, stop), kept: binary), one per document."""
    runs = removed_runs(docs, key, text, **options)
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            sizes, removed, kept = [], [], []
            for value, found in zip(batch.column(1), batch.column(2)):
                raw = _utf8(value.as_py())
                own = joined_runs(found.as_py() or [])
                edges = [0, *(x for run in own for x in run), len(raw)]
                sizes.append(len(raw))
                removed.append([{"start": a, "stop": b} for a, b in own])
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())],
                names=[key, "n_bytes", "removed", "kept"],
            )

    told = runs.select(F.col("doc").alias("__doc"), F.col("mark").alias("__mark"), "runs")
    whole = docs.select(key, text).hint("merge").join(
        told, (F.col(key).cast("long") == F.col("__doc")) & (F.xxhash64(text) == F.col("__mark")), "left"
    )
    return whole.select(key, text, "runs").mapInArrow(
        cut, f"{key} {kind}, n_bytes long, removed array<struct<start:bigint,stop:bigint>>, kept binary"
    )


def brute_force(rows: list[tuple[int | None, str | None]], length: int = LENGTH) -> list[tuple[int, list[tuple[int, int]], bytes]]:
    """(bytes, removed runs, kept) per row by a plain table of all windows, for tests."""
    least: dict[bytes, int] = {}
    for key, text in rows:
        raw = _utf8(text)
        for i in range(len(raw) - length + 1) if key is not None else ():
            window = raw[i : i + length]
            least[window] = min(least.get(window, key), key)
    out = []
    for key, text in rows:
        raw = _utf8(text)
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1) if key is not None else ():
            if least[raw[i : i + length]] < key:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).tolist()
        out.append((len(raw), list(zip(edges[::2], edges[1::2])), bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return out


def kept_digest(kept: bytes) -> str:
    return hashlib.sha256(kept).hexdigest()


def op6_suffix_dedup(docs: DataFrame) -> DataFrame:
    """What is removed from every document, and the digest of the rest."""
    found = without_repeats(docs.select("doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + r["stop"] - r["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
