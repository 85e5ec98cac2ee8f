"""Substring dedup with fixed-block anchors.

A window of ``window`` words that also starts in a document with a smaller id is a repeat; every word that such a window
covers goes. Windows are judged on the input, not on what is left.

1. Documents are written in chunks of a few megabytes of text; all later passes read these.
2. Every document's non-overlapping blocks of (window + 1) / 2 words are the index. Any window holds one of them whole.
   Every rolling string of that many words probes it. Blocks and probes travel as hashes, each once a chunk, to buckets of the
   hash space; the answer is a bit a probe: some chunk's block meets another chunk's text here.
3. Hits are extended: the windows around a hit, and around strings that several documents of one chunk share, meet by a hash of all
   their words with the smallest document id that holds them in each chunk. The answer is a bit a window: it starts in an earlier
   document elsewhere. Inside a chunk the ids decide. No pair of documents is ever formed, so thousands of copies cost
   as many rows as documents.
4. Covered windows merge to maximal runs of words, and the words outside are kept.

Windows are equal by a hash of 64 bits within buckets dealt by a second one (64 bits more than the number of buckets has).

Defined results: words are strings of bytes other than blank and the five control characters from tab to carriage return. A null
or empty text has no words. A null ``doc_id`` counts as the largest id. Rows with equal ids never remove each other's
words. Texts of any length are read whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelattice.llm import exchange
from hirelattice.llm.exchange import (
    MASK, bucket_cuts, bucket_of, groups, mixed, pack, pack_ids, pack_sorted, unpack, unpack_ids, unpack_sorted,
)
from hirelattice.llm.words import WordHashes
from hirelattice.session import materialise

WINDOW = 13
CHUNK_BYTES = 4 << 20  # text in a chunk, a longer document alone
BUCKET_BYTES = 12 << 20  # of text whose keys one bucket takes
LAST = (1 << 63) - 1

# --- words and strings of words ------------------------------------------------------------


def rolling(words: np.ndarray, size: int, base: int) -> np.ndarray:
    """A hash of every string of ``size`` words, by its first word."""
    out = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        out = out * np.uint64(base) + words[k:k + len(out)]
    return mixed(out)


@dataclass
class Chunk:
    """The words of a chunk's documents, and its strings of ``block`` words as sorted keys."""

    ids: np.ndarray  # per document
    words: np.ndarray
    of: np.ndarray  # per word its document
    first_word: np.ndarray  # per document, one more at the end
    window: int
    buckets: int

    @classmethod
    def read(cls, row: dict, hasher: WordHashes, window: int, buckets: int) -> Chunk:
        body = zstandard.decompress(row["body"])
        sizes = unpack(row["sizes"]).astype(np.int64)
        words = hasher.of(body, sizes)
        ids = np.array([LAST if i is None else i for i in row["doc_ids"]], np.int64)
        return cls(ids, words.hashes, np.repeat(np.arange(len(ids)), np.diff(words.first)), words.first, window, buckets)

    @property
    def block(self) -> int:
        return (self.window + 1) // 2

    def strings(self, size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Where strings of so many words of one document start, and their hashes."""
        hashes = rolling(self.words, size, base)
        at = np.flatnonzero(self.of[:len(hashes)] == self.of[size - 1:size - 1 + len(hashes)])
        return at, hashes[at]

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The sorted keys of all strings, which of them are blocks, which stand in several documents, and by string its start and key."""
        at, hashes = self.strings(self.block, 0x9FB21C651E98DF25)
        keys = (bucket_of(hashes, self.buckets) << exchange.HALF) | (hashes & MASK)
        order, starts, run = groups(at, keys)
        is_block = (at - self.first_word[self.of[at]]) % self.block == 0
        blocks = np.logical_or.reduceat(is_block[order], starts) if len(starts) else is_block
        document = self.of[at][order]
        several = document[starts] != document[np.append(starts[1:], len(order)) - 1] if len(starts) else is_block
        return keys[order][starts], blocks, several, at, run

    def windows(self, hits: list[dict] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows around hits: their starts and runs; of each run its bucket, its key and the smallest id that holds it here."""
        keys, _, several, at, run = self.probes()
        met = several.copy()
        fill(met, keys >> exchange.HALF, hits)
        near = np.zeros(len(self.words) + 1, np.int64)
        near[at[met[run]] + 1] = 1
        near = np.cumsum(near)  # hits before each word
        start, hashes = self.strings(self.window, 0xA24BAED4963EE407)
        reach = self.window - self.block + 1
        some = near[np.minimum(start + reach, len(self.words))] > near[start]
        start, hashes = start[some], hashes[some]
        second = rolling(self.words, self.window, 0xC2B2AE3D27D4EB4F)[start]
        bucket, holder = bucket_of(second, self.buckets), self.ids[self.of[start]]
        order, starts, run = groups(holder, hashes, bucket)
        head = order[starts]
        return start, run, bucket[head], hashes[head], holder[head]


def fill(flags: np.ndarray, buckets: np.ndarray, answered: list[dict] | None) -> None:
    """Set the flags of sorted keys that the answers (packed bits, by bucket) say."""
    for given in answered or ():
        lo, hi = np.searchsorted(buckets, np.array([given["bucket"], given["bucket"] + 1], np.uint64))
        flags[lo:hi] |= np.unpackbits(np.frombuffer(given["answer"], np.uint8), count=hi - lo).astype(bool)


def bits(flags: np.ndarray, sizes: list[int]) -> list[bytes]:
    return [np.packbits(part).tobytes() for part in np.split(flags, np.cumsum(sizes)[:-1])]


# --- buckets ------------------------------------------------------------------------------


def hits(rows: list[dict]) -> list[tuple[int, bytes]]:
    """Per chunk a bit a key: a block of some chunk has it, and two chunks at least."""
    keys = [unpack_sorted(r["keys"]) for r in rows]
    sizes = [len(k) for k in keys]
    blocks = np.concatenate([np.unpackbits(np.frombuffer(r["more"], np.uint8), count=n) for r, n in zip(rows, sizes, strict=True)])
    _, run, held = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    met = ((held > 1) & (np.bincount(run, weights=blocks) > 0))[run]
    return [(r["chunk"], b) for r, b in zip(rows, bits(met, sizes), strict=True) if b.strip(b"\0")]


def earlier(rows: list[dict]) -> list[tuple[int, bytes]]:
    """Per chunk a bit a window: another chunk holds it under a smaller id."""
    keys = [unpack_sorted(r["keys"]) for r in rows]
    sizes = [len(k) for k in keys]
    holders = np.concatenate([unpack_ids(r["more"]) for r in rows])
    order, starts, run = groups(holders, np.concatenate(keys))
    later = holders > holders[order[starts]][run]
    return [(r["chunk"], b) for r, b in zip(rows, bits(later, sizes), strict=True) if b.strip(b"\0")]


# --- passes -------------------------------------------------------------------------------


def chunks_of(documents: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """chunk, doc_ids, sizes, n_bytes and the compressed texts, a line feed after each; written, so that chunk numbers stay."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, turn = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def row() -> pa.RecordBatch:
            lengths = np.fromiter(map(len, texts), np.uint64, len(texts))
            return pa.RecordBatch.from_pydict({
                "chunk": pa.array([exchange.chunk_number(partition, turn)], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "sizes": pa.array([pack(lengths)], pa.binary()),
                "n_bytes": pa.array([int(lengths.sum())], pa.int64()),
                "body": pa.array([zstandard.compress(b"\n".join([*texts, b""]), 3)], pa.binary()),
            })

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text").cast(pa.binary()), strict=True):
                if texts and held + len(text.as_buffer() or b"") > size:
                    yield row()
                    ids, texts, held, turn = [], [], 0, turn + 1
                ids.append(doc_id.as_py())
                texts.append(text.as_py() or b"")
                held += len(texts[-1]) + 1
        if texts:
            yield row()

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(source.mapInArrow(gather, "chunk long, doc_ids array<long>, sizes binary, n_bytes long, body binary"), "chunks")


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _asked(chunk: int, buckets: np.ndarray, keys: np.ndarray, more) -> pa.RecordBatch:
    """A row for each bucket that a chunk's sorted keys lie in."""
    cuts = list(bucket_cuts(buckets))
    return pa.RecordBatch.from_pydict({
        "bucket": pa.array([b for b, _ in cuts], pa.int32()),
        "chunk": pa.array([chunk] * len(cuts), pa.int64()),
        "keys": pa.array([pack_sorted(keys[s]) for _, s in cuts], pa.binary()),
        "more": pa.array([more(s) for _, s in cuts], pa.binary()),
    })


ASKED = "bucket int, chunk long, keys binary, more binary"


def remove_repeats(documents: DataFrame, window: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, repeats (first and last word of every run that goes), and, if asked for, kept_text."""
    chunks = chunks_of(documents)
    load = chunks.agg(F.sum("n_bytes")).first()[0]
    buckets = exchange.bucket_count(chunks, load, BUCKET_BYTES)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHashes()
        for row in _rows_of(batches):
            keys, blocks, *_ = Chunk.read(row, hasher, window, buckets).probes()
            yield _asked(row["chunk"], keys >> exchange.HALF, keys & MASK, lambda s, blocks=blocks: np.packbits(blocks[s]).tobytes())

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHashes()
        for row in _rows_of(batches):
            _, _, bucket, keys, holders = Chunk.read(row, hasher, window, buckets).windows(row["hits"])
            yield _asked(row["chunk"], bucket, keys, lambda s, holders=holders: pack_ids(holders[s]))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHashes()
        for row in _rows_of(batches):
            yield _kept(row, Chunk.read(row, hasher, window, buckets), keep_text)

    met = materialise(exchange.answers(chunks.drop("n_bytes").mapInArrow(probe, ASKED), hits), "hits")
    located = chunks.drop("n_bytes").join(exchange.by_chunk(met, "hits"), "chunk", "left")
    before = materialise(exchange.answers(located.mapInArrow(extend, ASKED), earlier), "earlier")
    judged = (
        chunks.drop("n_bytes").join(exchange.by_chunk(met, "hits").join(exchange.by_chunk(before, "earlier"), "chunk", "full"), "chunk", "left")
    )
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, repeats array<struct<first: long, last: long>>"
    return judged.mapInArrow(finish, schema + ", kept_text string" * keep_text)


def _kept(row: dict, chunk: Chunk, keep_text: bool) -> pa.RecordBatch:
    """What is left of each document of a chunk."""
    start, run, bucket, _, holder = chunk.windows(row["hits"])
    later = np.zeros(len(bucket), bool)
    fill(later, bucket, row["earlier"])
    gone_at = start[later[run] | (chunk.ids[chunk.of[start]] > holder[run])]
    turns = np.zeros(len(chunk.words) + 1, np.int64)
    np.add.at(turns, gone_at, 1)
    np.add.at(turns, gone_at + chunk.window, -1)
    gone = np.cumsum(turns)[:-1] > 0
    # runs end with their document, too
    edge = np.diff(gone.astype(np.int8), prepend=0) == 1
    edge[chunk.first_word[:-1][chunk.first_word[:-1] < len(gone)]] = True
    firsts = np.flatnonzero(edge & gone)
    stops = np.flatnonzero(np.append(edge, True) | ~np.append(gone, False))
    lasts = stops[np.searchsorted(stops, firsts, side="right")] - 1
    bounds = np.searchsorted(firsts, chunk.first_word)
    shift = np.repeat(chunk.first_word[:-1], np.diff(bounds))

    body, sizes = zstandard.decompress(row["body"]), unpack(row["sizes"]).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
    shas, texts = [], []
    for k in range(len(sizes)):
        words = body[offsets[k]:offsets[k + 1]].split()
        if bounds[k] < bounds[k + 1]:
            words = compress(words, (~gone[chunk.first_word[k]:chunk.first_word[k + 1]]).tolist())
        kept = b" ".join(words)
        shas.append(hashlib.sha256(kept).hexdigest())
        if keep_text:
            texts.append(kept.decode())
    removed = np.concatenate([[0], np.cumsum(gone)])[chunk.first_word]
    spans = pa.StructArray.from_arrays([pa.array(firsts - shift), pa.array(lasts - shift)], ["first", "last"])
    columns = {
        "doc_id": pa.array(row["doc_ids"], pa.int64()),
        "n_words": pa.array(np.diff(chunk.first_word)),
        "n_removed": pa.array(np.diff(removed)),
        "kept_sha256": pa.array(shas, pa.string()),
        "repeats": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans),
    }
    return pa.RecordBatch.from_pydict(columns | ({"kept_text": pa.array(texts, pa.string())} if keep_text else {}))
