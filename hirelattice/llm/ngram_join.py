"""Similarity join of documents on word shingles with count vectors in R-trees.

A document is the set of its distinct shingles (hashed to 64 bits). Its shingles are hashed into groups, and the group
counts are a point: the summed coordinate minima of two points bound the overlap of the sets. In many dimensions the boxes
of a tree over all points overlap so much that it prunes nothing, so the join first splits the space and then searches
small trees:

1. Equal sets collapse to one representative, by a 128-bit signature.
2. A set linked with another one shares at least ``part`` percent of its own shingles with it. So representatives go that have fewer
   shingles standing in any other one: texts are cut once into chunks of sorted shingles, whose keys meet in buckets, and each
   chunk gets a bit a key back. Only the others take part in what follows, and only their texts are cut again.
3. Two sets that reach the threshold differ in at most ``allowed`` shingles, which their sizes give. The hash range is cut
   into more segments than that, so at least one segment holds equal shingles in both: representatives are filed
   by segment and content. The number of segments depends on a size band; a set is filed in all bands that larger sets
   linked with it can have. Segments of at most one shingle say little; there are spare segments, so that
   two documents with no more such segments than spares meet in a better one. Documents with more are filed by all segments as
   well, empty ones too (small ones by groups of segments, which say more), so two of them meet. Sets so small that none may
   differ need no files: equal ones are one already.
4. Each file's members are compared with its smallest member: first by the summed minima of their points, then, if these
   leave it open, by the sets themselves. This links whole groups of copies at a cost in proportion to their size. Files whose
   members are not all linked by that are compared with another member, some times in turn as long as links are found.
5. Files whose members are not all linked yet are searched whole: an R-tree over the points, boxes and points
   pruned by summed minima, and the pairs that remain (between members not yet linked to each other) are verified. Large files
   are cut into chunks and pairs of chunks, so no task holds more than two chunks. A pair found in several files counts in the first.

Nothing is approximate: every pair that reaches the threshold is verified or already linked through others.

Defined results: a null or blank text has no shingles and links with nothing; a text with fewer words than a shingle
has its word sequence as its only one; repeated rows and ids are documents of their own. A null ``doc_id`` is never a
component's smallest id unless all are null. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelattice.llm import exchange
from hirelattice.llm.common import exact_key, parts_for, slices
from hirelattice.llm.components import connected_components
from hirelattice.llm.exchange import pack, pack_ids, pack_sorted, unpack, unpack_ids, unpack_sorted
from hirelattice.session import materialise

GROUPS, COARSE_GROUPS = 256, 32  # coordinates of a point, and of the boxes of a tree
FINE_GROUPS, FINE_FROM = 2048, 3000  # and those of a second point for sets of at least this size
BAND = 1.25  # a size band ends at this times its start
CHUNK = 256  # members of a file compared at once
GATHERED, GATHERED_BYTES = 4096, 6 << 20  # documents (a power of two) and text of a chunk of shingles
SHINGLE_BITS = np.uint64(40)  # of a shingle's hash that buckets compare; shingles that fall together only keep a set in
TURNS = 3  # more members that a file's others are compared with before it is searched whole
FIRST_FILES = 32  # of the files a member is searched in, so many say where a pair found in several files counts
LEAF = 8  # entries of a tree node
MOST_GROUPS = 84  # groups of segments that a small set is filed by
BUCKET_KEYS, BLOCK_KEYS = 1 << 21, 1 << 16  # keys that a bucket takes, and pairs in a block that needs no meeting
#: Up to so many narrow rows (at most 24 bytes each) are looked up by broadcast; beyond, by a shuffled join.
BROADCAST_ROWS = 500_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text: words are cut at ASCII blanks, A-Z lower-cased."""
    from xxhash import xxh3_64_intdigest

    found = text.lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([xxh3_64_intdigest(b" ".join(found), len(found))], np.uint64)
    hashed = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    count = len(found) - words + 1
    total = np.zeros(count, np.uint64)
    for i in range(words):
        total = _mix(total * _A + hashed[i:i + count] + _B)
    return np.unique(total)


class Threshold:
    """Jaccard similarity of at least ``part`` / 100 in whole numbers."""

    def __init__(self, part: int) -> None:
        self.part = part

    def reached(self, overlap, sizes):
        """overlap / (sizes - overlap) >= part / 100"""
        return (100 + self.part) * overlap >= self.part * sizes

    def allowed(self, size: int) -> int:
        """Shingles in which two linked sets of at most this size can differ."""
        return 2 * size * (100 - self.part) // (100 + self.part)


def band_of(size: int) -> int:
    return int(math.log(size) / math.log(BAND) + 1e-9)


def band_end(band: int) -> int:
    """An upper bound of the sizes in a band."""
    return math.ceil(BAND ** (band + 1)) + 1


@lru_cache(maxsize=4096)
def segment_plan(band: int, part: int) -> tuple[int, int]:
    """Segments of a band, and how many of them are spare: about as many as hold at most one shingle of its smallest sets."""
    needed, smallest = Threshold(part).allowed(band_end(band)) + 1, BAND**band
    spare = 2
    for _ in range(20):
        load = smallest / (needed + spare)
        weak = (needed + spare) * math.exp(-load) * (1 + load)
        spare = min(needed, max(2, math.ceil(weak + math.sqrt(weak))))
    return needed + spare, spare


def segment_keys(hashes: np.ndarray, band: int, threshold: Threshold) -> np.ndarray:
    """Keys of the segments: hashes of band, segment and the shingles in it."""
    segments, spare = segment_plan(band, threshold.part)
    at = ((hashes >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)  # sorted as the hashes are
    filled, starts, held = np.unique(at, return_index=True, return_counts=True)
    content = np.add.reduceat(_mix(hashes + _C), starts)
    place = (np.uint64(band) << np.uint64(40)) + np.uint64(1)
    keys = _mix(content * _A + _mix(filled + place))
    strong = keys[held > 1]
    if segments - len(strong) <= spare:
        return strong
    none = np.setdiff1d(np.arange(segments, dtype=np.uint64), filled)
    every = np.concatenate([keys, _mix(_mix(none + place))])
    if math.comb(segments, spare + 1) > MOST_GROUPS:
        return every
    # linked sets agree in more segments than there are spares: file by so many together
    together = np.array(list(combinations(range(segments), spare + 1)))
    return np.concatenate([strong, _mix(_mix(every)[np.argsort(np.concatenate([filled, none]))][together].sum(axis=1, dtype=np.uint64))])


def _bands(size: int, threshold: Threshold) -> list[int]:
    """The bands of all larger sets this one can be linked with, its own size included."""
    largest = size * 100 // threshold.part
    return [b for b in range(band_of(size), band_of(largest) + 1) if threshold.allowed(band_end(b))]


def _lists(arrays: list[np.ndarray], kind) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(kind)))


def _numbered_texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), F.col("text").cast("binary").alias("text")
    )


def set_points(texts: DataFrame, words: int, threshold: Threshold) -> DataFrame:
    """id, doc_id, t, n, counts, fine, keys of every text (id, doc_id, t, text)."""

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n, counts, fine, keys = [], [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingle_hashes(text, words)
                n.append(len(hashes))
                group = (hashes & np.uint64(FINE_GROUPS - 1)).astype(np.int64)
                counts.append(np.bincount(group % GROUPS, minlength=GROUPS))
                fine.append(np.bincount(group, minlength=FINE_GROUPS) if len(hashes) >= FINE_FROM else group[:0])
                own = [segment_keys(hashes, b, threshold) for b in _bands(len(hashes), threshold)] if len(hashes) else []
                keys.append(np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "doc_id", "t")), pa.array(n, pa.int64()), _lists(counts, np.int32),
                 _lists(fine, np.int32), _lists(keys, np.int64)],
                names=["id", "doc_id", "t", "n", "counts", "fine", "keys"],
            )

    return texts.mapInArrow(point, "id long, doc_id long, t long, n long, counts array<int>, fine array<int>, keys array<long>")


# --- sets that can be linked --------------------------------------------------------------


def shingle_chunks(documents: DataFrame, words: int) -> DataFrame:
    """chunk, the doc_id, t, n and signatures (s1, s2) of its documents, and their shingles in order: keys, owners (places in the chunk) and new.

    ``new`` tells the first entry of each key. The id of a document is the number of its chunk and its place; the written copy fixes both.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, turn = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", rows=GATHERED, size=GATHERED_BYTES):
            sets = [shingle_hashes(t, words) for t in batch.column("text").to_pylist()]
            sizes = np.array([len(x) for x in sets])
            signed = [np.array([_mix(x + seed).sum(dtype=np.uint64) for x in sets], np.uint64) for seed in (_A, _B)]
            keys = np.concatenate(sets) >> (np.uint64(64) - SHINGLE_BITS)
            owners = np.repeat(np.arange(len(sets), dtype=np.uint64), sizes)
            order = np.argsort(keys, kind="stable")
            keys, owners = keys[order], owners[order]
            new = np.ones(len(keys), np.uint64)
            new[1:] = keys[1:] != keys[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([exchange.chunk_number(partition, turn * GATHERED)], pa.int64()),
                 *(pa.array([batch.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("doc_id", "t")),
                 *(_lists([x.view(np.int64)], np.int64) for x in (sizes, *signed)),
                 *(pa.array([x], pa.binary()) for x in (pack_sorted(keys), pack(owners), pack(new)))],
                names=["chunk", "doc_id", "t", "n", "s1", "s2", "keys", "owners", "new"],
            )
            turn += 1

    lists = ", ".join(f"{c} array<long>" for c in ("doc_id", "t", "n", "s1", "s2"))
    return _numbered_texts(documents).mapInArrow(cut, f"chunk long, {lists}, keys binary, owners binary, new binary")


def chunk_members(chunks: DataFrame) -> DataFrame:
    """id, doc_id, t, n, s1, s2 of every document."""
    columns = ("doc_id", "t", "n", "s1", "s2")
    rows = chunks.select("chunk", F.posexplode(F.arrays_zip(*columns)).alias("at", "row"))
    return rows.select((F.col("chunk") + F.col("at")).alias("id"), *(F.col("row")[c].alias(c) for c in columns))


def _entries(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which entries of a chunk belong to representatives, their owners, and whether each is the first of its key."""
    owners = unpack(row["owners"])
    mine = ~np.isin(owners, np.array(row["copied"] or [], np.uint64))
    run = np.cumsum(unpack(row["new"]))[mine]
    return mine, owners[mine].astype(np.int64), np.diff(run, prepend=np.zeros(1, np.uint64)) != 0  # runs count from 1


def linkable(chunks: DataFrame, copies: DataFrame, threshold: Threshold) -> DataFrame:
    """id of the representatives that share at least the threshold's part of their shingles with others; ``copies`` (id) are none.

    A chunk sends each key once to the key's bucket, so a shingle that stands everywhere costs its bucket one entry a chunk.
    """
    held = chunks.agg(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda total, n: total + n))).first()[0]
    buckets = exchange.bucket_count(chunks, held, BUCKET_KEYS)
    place = F.pmod("id", F.lit(GATHERED))
    copied = copies.select((F.col("id") - place).alias("chunk"), place.alias("at")).groupBy("chunk").agg(F.collect_list("at").alias("copied"))
    marked = chunks.join(_narrow(copied, "copied"), "chunk", "left")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield batch.slice(at, 1).to_pylist()[0]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            mine, _, first = _entries(row)
            keys = unpack_sorted(row["keys"])[mine][first]
            several = np.diff(np.append(np.flatnonzero(first), len(first))) > 1
            cuts = list(exchange.bucket_cuts(exchange.bucket_of(keys << (np.uint64(64) - SHINGLE_BITS), buckets)))
            if cuts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in cuts], pa.int32()), pa.array([row["chunk"]] * len(cuts), pa.int64()),
                     pa.array([pack_sorted(keys[s]) for _, s in cuts], pa.binary()),
                     pa.array([pack(several[s].astype(np.uint64)) for _, s in cuts], pa.binary())],
                    names=["bucket", "chunk", "keys", "several"],
                )

    def answer(rows: list[dict]) -> list[tuple[int, bytes]]:
        asked = [unpack_sorted(r["keys"]) for r in rows]
        keys = np.concatenate(asked)
        shared = np.concatenate([unpack(r["several"]) for r in rows])
        order = np.argsort(keys)
        keys = keys[order]
        same = keys[1:] == keys[:-1]
        shared[order[1:][same]] = shared[order[:-1][same]] = 1
        parts = np.split(shared, np.cumsum([len(a) for a in asked])[:-1])
        return [(r["chunk"], pack(p)) for r, p in zip(rows, parts, strict=True)]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            _, owners, first = _entries(row)
            shared = np.concatenate([unpack(a["answer"]) for a in sorted(row["answers"], key=lambda a: a["bucket"])])
            sizes = np.array(row["n"])
            count = np.bincount(owners, weights=shared[np.cumsum(first) - 1], minlength=len(sizes)).astype(np.int64)
            stay = (np.bincount(owners, minlength=len(sizes)) > 0) & (100 * count >= threshold.part * sizes)
            yield pa.RecordBatch.from_arrays([pa.array(row["chunk"] + np.flatnonzero(stay), pa.int64())], names=["id"])

    asked = marked.select("chunk", "keys", "owners", "new", "copied").mapInArrow(ask, "bucket int, chunk long, keys binary, several binary")
    answered = materialise(exchange.answers(asked, answer), "shared-shingles")
    told = marked.select("chunk", "n", "owners", "new", "copied").join(exchange.by_chunk(answered, "answers"), "chunk")
    return told.mapInArrow(tally, "id long")


# --- the tree -----------------------------------------------------------------------------


def _coarse(points: np.ndarray) -> np.ndarray:
    """Points of fewer coordinates, each a sum of some: their summed minima bound the overlap too, at less cost."""
    return points.reshape(len(points), -1, COARSE_GROUPS).sum(axis=1, dtype=np.int32)


def _allowed(threshold: Threshold, x: np.ndarray, y: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (x[i], y[j]) have summed minima that allow the threshold; a block at a time."""
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 13):
        some = slice(at, at + (1 << 13))
        keep[some] = threshold.reached(np.minimum(x[i[some]], y[j[some]]).sum(axis=1), sizes[some])
    return keep


class RTree:
    """A packed R-tree over count vectors: per node the largest (coarse) counts and the smallest size below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        slab = max(1, int(math.sqrt(len(points) * LEAF)))
        by_size = np.argsort(sizes, kind="stable")
        strips = [by_size[i:i + slab] for i in range(0, len(points), slab)]
        half = points.shape[1] // 2
        lean = points[:, :half].sum(axis=1) - points[:, half:].sum(axis=1)
        self.order = np.concatenate([s[np.argsort(lean[s], kind="stable")] for s in strips])
        self.points = points[self.order]
        self.levels = [(_coarse(self.points), sizes[self.order])]
        while len(self.levels[-1][0]) > LEAF:
            tops, least = self.levels[-1]
            starts = np.arange(0, len(tops), LEAF)
            self.levels.append((np.maximum.reduceat(tops, starts), np.minimum.reduceat(least, starts)))

    def search(self, points: np.ndarray, sizes: np.ndarray, threshold: Threshold) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, indexed point) whose summed minima allow the threshold."""
        top, coarse = len(self.levels) - 1, _coarse(points)
        query = np.repeat(np.arange(len(points)), len(self.levels[top][0]))
        node = np.tile(np.arange(len(self.levels[top][0])), len(points))
        for level in range(top, -1, -1):
            tops, least = self.levels[level]
            keep = _allowed(threshold, coarse, tops, sizes[query] + least[node], query, node)
            query, node = query[keep], node[keep]
            if level:
                below = len(self.levels[level - 1][0])
                query = np.repeat(query, LEAF)
                node = (node[:, None] * LEAF + np.arange(LEAF)).ravel()
                query, node = query[node < below], node[node < below]
        keep = _allowed(threshold, points, self.points, sizes[query] + self.levels[0][1][node], query, node)
        return query[keep], self.order[node[keep]]


def _counted_here(file: int, x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Is the file the first one that both members of a pair are in? Also true where their first files have none in common."""
    here = np.ones(len(x), bool)
    for n, (a, b) in enumerate(zip(x, y, strict=True)):
        common = np.intersect1d(a, b, assume_unique=True)
        here[n] = not len(common) or common[0] == file
    return here


def _cell_pairs(threshold: Threshold, ids, sides, components, sizes, counts, file=0, files=None) -> list[tuple[int, int]]:
    """Pairs of a cell that their points leave open, between members that are not linked to each other yet."""
    left = np.flatnonzero(sides == 0)
    right = np.flatnonzero(sides == 1) if sides.any() else left
    if not len(left) or not len(right) or (components == components[0]).all():
        return []
    a, b = RTree(counts[left], sizes[left]).search(counts[right], sizes[right], threshold)
    a, b = right[a], left[b]
    apart = components[a] != components[b]
    a, b = a[apart], b[apart]
    if files is not None:
        here = _counted_here(file, [files[i] for i in a], [files[i] for i in b])
        a, b = a[here], b[here]
    x, y = ids[a], ids[b]
    return list(set(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), strict=True)))


def _search_cells(threshold: Threshold):
    columns = ("id", "side", "component", "n", "key", "files")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come cell by cell; a cell that a batch ends in waits for the next batch."""
        waiting: list[np.ndarray] | None = None
        found: list[tuple[int, int]] = []
        for batch in _and_end(batches):
            if batch is None:
                rows, ends = waiting, [len(waiting[0])] if waiting else []
            else:
                rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", *columns)]
                rows.append(batch.column("counts").flatten().to_numpy(zero_copy_only=False).reshape(-1, GROUPS))
                if waiting:
                    rows = [np.concatenate(pair) for pair in zip(waiting, rows, strict=True)]
                ends = (np.flatnonzero(rows[0][1:] != rows[0][:-1]) + 1).tolist()
            start = 0
            for end in ends:
                if end - start > 1:
                    ids, sides, components, sizes, keys, files, counts = (r[start:end] for r in rows[1:])
                    found += _cell_pairs(threshold, ids, sides, components, sizes, counts, keys[0], files)
                start = end
            waiting = [r[start:] for r in rows] if batch is not None else None
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], pa.int64()) for n in range(2)], names=["a", "b"])
                found = []

    return search


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches that have rows, then None."""
    yield from (b for b in batches if b.num_rows)
    yield None


# --- the files ----------------------------------------------------------------------------


def filed_together(chosen: DataFrame) -> DataFrame:
    """(key, id) of every representative (id, keys) and every key that it shares with another one.

    Most keys are held once. So a batch of rows sends each of its keys once, with the smallest id that has it, as sorted compressed numbers to
    the bucket of the key; the bucket knows the keys that two batches sent. The other ids of a key that a batch holds several times are
    known to share it, so they need no meeting: they travel in blocks dealt evenly. A key that a third of all rows have costs
    its bucket one entry a batch. Keys are cut to 32 bits below the bucket's; keys that fall together by that cost a comparison, no result.
    """
    held = chosen.agg(F.sum(F.size("keys"))).first()[0]
    buckets = exchange.bucket_count(chosen, held, BUCKET_KEYS)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in slices(batches, "keys", rows=8192, size=16 << 20):
            lists = batch.column("keys")
            lengths = np.diff(lists.offsets.to_numpy())
            raw = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ids = np.repeat(batch.column("id").to_numpy(), lengths)
            keys = (exchange.bucket_of(raw, buckets) << exchange.HALF) | (raw & exchange.MASK)
            order = np.lexsort((ids, keys))
            keys, ids = keys[order], ids[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])  # a row may have a key twice
            keys, ids = keys[new], ids[new]
            first = np.ones(len(keys), bool)
            first[1:] = keys[1:] != keys[:-1]
            several = np.append(~first[1:], False)[:len(keys)][first]
            out = [(b, True, pack_sorted(keys[first][s]), pack_ids(ids[first][s]), np.packbits(several[s]).tobytes())
                   for b, s in exchange.bucket_cuts(keys[first] >> exchange.HALF)]
            others, their = keys[~first], ids[~first]
            for at in range(0, len(others), BLOCK_KEYS):
                block = slice(at, at + BLOCK_KEYS)
                turn += 1
                out.append(((int(their[at]) + turn) % buckets, False, pack_sorted(others[block]), pack_ids(their[block]), b""))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "meets", "keys", "ids", "several"])

    def meet(table: pa.Table) -> pa.Table:
        known, asked = [], []
        for r in table.to_pylist():
            pair = unpack_sorted(r["keys"]), unpack_ids(r["ids"])
            if r["meets"]:
                asked.append((*pair, np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(pair[0])).astype(bool)))
            else:
                known.append(pair)
        if asked:
            keys, ids, several = (np.concatenate(x) for x in zip(*asked, strict=True))
            _, starts, run = exchange.groups(ids, keys)
            shared = (np.diff(np.append(starts, len(keys))) > 1) | (np.bincount(run, weights=several) > 0)
            known.append((keys[shared[run]], ids[shared[run]]))
        keys, ids = (np.concatenate(x) for x in zip(*known, strict=True))
        return pa.table({"key": pa.array(keys.view(np.int64)), "id": pa.array(ids)})

    asked = chosen.select("id", "keys").mapInArrow(ask, "bucket int, meets boolean, keys binary, ids binary, several binary")
    return asked.groupBy("bucket").applyInArrow(meet, "key long, id long")


# --- the join -----------------------------------------------------------------------------


def _reached(overlap: Column, sizes: Column, threshold: Threshold) -> Column:
    return overlap * (100 + threshold.part) >= sizes * threshold.part


def _both(pairs: DataFrame, side: DataFrame, *columns: str) -> DataFrame:
    """The pairs with the columns of both members, as columns_a and columns_b."""
    for end in "ab":
        pairs = pairs.join(side.select(F.col("id").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns)), end)
    return pairs


def _possible(pairs: DataFrame, points: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs that the summed minima of their points leave open, the finer points of large sets included."""

    def bound(counts: str) -> Column:
        least = F.zip_with(f"{counts}_a", f"{counts}_b", lambda x, y: F.least(x, y))
        return F.aggregate(least, F.lit(0), lambda total, x: total + x)

    known = _both(pairs, points, "n", "counts")
    sizes = F.col("n_a") + F.col("n_b")
    known = known.where(_reached(bound("counts"), sizes, threshold)).select("a", "b", "n_a", "n_b")
    large = (F.col("n_a") >= FINE_FROM) & (F.col("n_b") >= FINE_FROM)
    finer = _both(known.where(large), points.where(F.col("n") >= FINE_FROM), "fine")
    finer = finer.where(_reached(bound("fine"), sizes, threshold))
    return known.where(~large).select("a", "b").unionByName(finer.select("a", "b"))


def _narrow(rows: DataFrame, label: str) -> DataFrame:
    """The rows written once, and marked for broadcast if they are few enough; a join gives the same either way."""
    stored = materialise(rows, label)
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def _texts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, doc_id, t, text of the wanted documents, given as (id, doc_id, t)."""
    side = _narrow(wanted.toDF("id", "wanted_id", "wanted_t"), "wanted")
    same = (F.col("t") == F.col("wanted_t")) & F.col("doc_id").eqNullSafe(F.col("wanted_id"))
    found = _numbered_texts(documents).join(side, same)
    return found.groupBy("id").agg(*(F.first(c).alias(c) for c in ("doc_id", "t", "text")))  # repeated rows give one text


def _verified(pairs: DataFrame, points: DataFrame, documents: DataFrame, words: int, threshold: Threshold) -> DataFrame:
    """The pairs whose sets reach the threshold; only texts in open pairs are cut again."""
    pairs = materialise(_possible(pairs, points, threshold), "open-pairs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingle_hashes(t, words).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(sets, np.int64)], names=["id", "shingles"])

    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = points.select("id", "doc_id", "t").join(ids, "id", "left_semi")
    sets = _texts(documents, wanted).mapInArrow(cut, "id long, shingles array<long>")
    overlap = F.size(F.array_intersect("shingles_a", "shingles_b"))
    sizes = F.size("shingles_a") + F.size("shingles_b")
    return _both(pairs, sets, "shingles").where(_reached(overlap, sizes, threshold)).select("a", "b")


def join_components(documents: DataFrame, words: int = 3, part: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id for every document; linked at Jaccard >= ``part`` / 100."""
    return linked_rows(documents, words, part).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(documents: DataFrame, words: int = 5, part: int = 80) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest id, and all without shingles."""
    linked = linked_rows(documents, words, part).where("component IS NOT NULL").groupBy("doc_id", "t").agg(
        F.first("component").alias("component"), (F.count(F.lit(1)) > 1).alias("repeated")
    )
    linked = materialise(linked, "linked-rows")
    place = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)), "doc_id", "t")
    least = linked.groupBy("component").agg(F.min(place).alias("c"), F.count(F.lit(1)).alias("size")).where("size > 1")
    least = _narrow(least.select("component", F.col("c.doc_id").alias("least_id"), F.col("c.t").alias("least_t")), "least")
    chosen = F.col("least_t").isNull() | ((F.col("t") == F.col("least_t")) & F.col("doc_id").eqNullSafe(F.col("least_id")))
    marks = linked.join(least, "component", "left").withColumn("chosen", chosen).where("NOT chosen OR repeated")
    # only rows that go and rows that repeat id and text are marked; all others stay where they are
    marks = _narrow(marks.select(F.col("doc_id").alias("marked_id"), F.col("t").alias("marked_t"), "chosen"), "marks")
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"))
    same = (F.col("t") == F.col("marked_t")) & F.col("doc_id").eqNullSafe(F.col("marked_id"))
    first = F.row_number().over(Window.partitionBy("doc_id", "t").orderBy("t"))
    once = rows.join(marks.where("chosen"), same).withColumn("first", first).where("first = 1")
    return rows.join(marks, same, "left_anti").select("row.*").unionByName(once.select("row.*"))


def _labelled(members: DataFrame, linked: DataFrame) -> DataFrame:
    """id, key and component of the members (id, key)."""
    components = connected_components(linked).withColumnRenamed("node", "id")
    labelled = members.join(components, "id", "left").select("id", "key", F.coalesce("component", "id").alias("component"))
    return materialise(labelled, "labelled")


def _unsettled(labelled: DataFrame) -> DataFrame:
    """key and size of the files whose members are not all linked, one for each set of members.

    Documents that share many passages fill many files alike.
    """
    one, two = exact_key(F.col("id"))
    files = labelled.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"),
        F.bit_xor(one).alias("one"), F.bit_xor(two).alias("two"),
    )
    return files.where("low < high").groupBy("size", "one", "two").agg(F.min("key").alias("key"))


def linked_rows(documents: DataFrame, words: int, part: int) -> DataFrame:
    """doc_id, t, n, component, component_id for every document; the last two are null without shingles."""
    threshold = Threshold(part)
    chunks = materialise(shingle_chunks(documents, words), "chunks")
    points = chunk_members(chunks)
    classes = points.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("id").alias("id"), F.min("doc_id").alias("smallest"))
    classes = materialise(classes, "classes")
    numbers = points.where("n > 0").select("id", "s1", "s2", "n")
    copies = numbers.join(classes.select("s1", "s2", "n", F.col("id").alias("chosen")), ["s1", "s2", "n"]).where("id <> chosen")
    possible = _narrow(linkable(chunks, copies.select("id"), threshold), "linkable")
    wanted = points.join(possible, "id", "left_semi").select("id", "doc_id", "t")
    chosen = materialise(set_points(_texts(documents, wanted), words, threshold), "points")

    filed = materialise(filed_together(chosen), "filed-together")
    files = filed.groupBy("key").agg(F.min("id").alias("first"))
    members = materialise(filed.join(_narrow(files, "files"), "key"), "members")
    stars = members.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    in_files = chosen.drop("keys").join(_narrow(members.select("id").distinct(), "filed"), "id", "left_semi")
    in_files = materialise(in_files, "in-files")
    linked = materialise(_verified(stars, in_files, documents, words, threshold), "linked")

    # a file's first member has been compared with all others
    labelled = _labelled(members.where("id <> first").select("id", "key"), linked)
    for turn in range(TURNS):
        apart = materialise(labelled.join(_unsettled(labelled).select("key"), "key"), "apart")
        chosen_one = F.min(F.struct(F.xxhash64(F.lit(turn), "id").alias("order"), "id", "component")).alias("one")
        others = apart.join(_narrow(apart.groupBy("key").agg(chosen_one), "chosen-ones"), "key").where("component <> one.component")
        stars = others.select(F.least("id", "one.id").alias("a"), F.greatest("id", "one.id").alias("b")).distinct()
        found = materialise(_verified(stars, in_files, documents, words, threshold), "linked")
        if found.isEmpty():
            break
        linked = linked.unionByName(found)
        labelled = _labelled(apart.select("id", "key"), linked)
    unsettled = _unsettled(labelled).select("key", F.ceil(F.col("size") / CHUNK).alias("chunks"))
    searched = materialise(labelled.join(unsettled, "key"), "searched")
    in_order = Window.partitionBy("id").orderBy("key")
    first_files = searched.withColumn("nth", F.row_number().over(in_order)).where(F.col("nth") <= FIRST_FILES)
    first_files = first_files.groupBy("id").agg(F.sort_array(F.collect_list("key")).alias("files"))
    first_files = materialise(in_files.join(first_files, "id").select("id", "n", "counts", "files"), "searched-points")
    mine = F.pmod(F.xxhash64("id"), F.col("chunks"))
    cells = (
        searched.withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("id", "component", "key", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"),
                (F.col("mine") > F.col("other")).cast("int").alias("side"))
        .join(first_files, "id").repartition(parts_for(documents), "cell").sortWithinPartitions("cell")
    )
    pairs = materialise(cells.mapInArrow(_search_cells(threshold), "a long, b long").distinct(), "pairs")
    more = _verified(pairs, in_files, documents, words, threshold)
    components = connected_components(linked.unionByName(more))

    named = classes.join(components.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    lowest = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = named.join(lowest, "component").select("s1", "s2", "n", "component", "component_id")
    return points.select("doc_id", "t", "s1", "s2", "n").join(named, ["s1", "s2", "n"], "left").drop("s1", "s2")
