"""Packing documents into token sequences of bounded length by swap-based local search.

A document is its token ids followed by the end id. Only a document longer than a sequence is cut, into
pieces of a sequence's length, the last one shorter. The pieces of one group go into bins as they arrive, each into the
fullest one that takes it; then, as long as the group has more bins than its tokens need, documents move between underfull bins, or
change places one for one, two for one or one for two, whenever that raises the sum of squared fills, until bins are empty.
Bins that stay underfull are taken apart and packed again with those of the other groups.

Groups hold a bounded number of pieces, drawn evenly by position and not by key, so a repeated ``doc_id`` makes no
group larger. Only lengths move between machines, not texts.

``in_order`` keeps the order of the documents (file by file and row by row where they are read from files, else by
partition): a group is a range of it, so a sequence holds neighbours, and ``sequence_id`` is the place of a sequence's
earliest piece. Pieces of bins that stay underfull meet those of the next ranges.

Defined results: a null text is empty and packs as the end id alone; an empty table gives no rows; repeated
rows are packed one by one; a null ``doc_id`` stays null; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelattice.llm.common import held, slices
from hirelattice.llm.words import Grown, Known, WordHashes
from hirelattice.session import materialise

LIMIT = 4096
END = struct.pack("<I", 1)
GROUP_PIECES = 8_192  # pieces that one task packs at once
ORDERED_PIECES = 2_048  # the same where the order is kept: how far apart the pieces of a sequence may be
ORDERED_ROWS = 1_024  # documents of a file that are numbered at once
KNOWN_STRINGS, KNOWN_IDS = 600_000, 4_000_000  # bound the memory of a worker (about 50 MB), not the result
PAIRED, SMALLEST = 24, 8  # pieces of a bin that are given, or taken back, two at a time
#: Bins with less fill than this are packed again with those of other groups.
GOOD_FILL = 0.99

# Texts of these characters only are cut here as the tokenizer would cut them; all others go to it whole.
PLAIN = re.compile("[^\t\n\r\x20-\x7e¡-±´-¸º»¿-ɏ]")
TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


class IdLists:
    """Lists of ids by hash, in a few arrays."""

    def __init__(self) -> None:
        self.known, self.upto, self.ids = Known(), Grown((), np.int64), Grown((), "<u4")
        self.upto.add(np.zeros(1, np.int64))

    def add(self, hashes: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows for new, ascending hashes, whose lists stand in ``ids`` and end there."""
        self.upto.add(self.ids.size + ends)
        self.ids.add(ids)
        return self.known.add(hashes)

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of rows one after the other, and where each ends."""
        upto = self.upto.values
        begins, counts = upto[rows], upto[rows + 1] - upto[rows]
        ends = np.cumsum(counts)
        return self.ids.values[np.repeat(begins - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)], ends


class Encoder:
    """Token ids of texts; words and blank-separated strings seen before are looked up by their hash.

    The tokenizer lower-cases, drops white space and encodes each word on its own, so a text's ids are those
    of its blank-separated strings in a row, and a string's those of its words.
    """

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        self.tokenizer = Tokenizer.from_str(definition)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # of words
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.hasher = WordHashes()
        self._forget()

    def _forget(self) -> None:
        self.strings, self.words = IdLists(), IdLists()

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn_words(self, hashes: np.ndarray, words: list[str]) -> np.ndarray:
        """Encode words in one text; each ends where a token ends a word."""
        ids = self._whole(" ".join(words))
        return self.words.add(hashes, ids, np.flatnonzero(self.ends[ids]) + 1)

    def _learn(self, hashes: np.ndarray, strings: list[bytes]) -> np.ndarray:
        """Put the ids of strings together from those of their words."""
        from xxhash import xxh3_64_intdigest

        every: list[str] = []
        upto = []
        for string in strings:
            text = string.decode().lower()
            core = text.rstrip(".,;:!?")  # one word and at most one run of marks, as most strings are
            if not core.isalpha():
                every += TOKEN.findall(text)
            elif len(core) < len(text):
                every += (core, text[len(core):])
            else:
                every.append(core)
            upto.append(len(every))
        hashed = np.fromiter(map(xxh3_64_intdigest, every), np.uint64, len(every))
        keys, sample, place = np.unique(hashed, return_index=True, return_inverse=True)
        rows = self.words.known.find(keys)
        fresh = np.flatnonzero(rows < 0)
        if len(fresh):
            rows[fresh] = self._learn_words(keys[fresh], [every[i] for i in sample[fresh].tolist()])
        ids, ends = self.words.of(rows[place])
        return self.strings.add(hashes, ids, np.concatenate([[0], ends])[upto])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if len(self.strings.known) > KNOWN_STRINGS or len(self.words.known) > KNOWN_STRINGS or self.strings.ids.size > KNOWN_IDS:
            self._forget()
        odd = [bool(t) and (PLAIN.search(t) is not None or "<|" in t) for t in texts]  # other characters, special tokens
        words = self.hasher.of_texts([b"" if o or not t else t.encode() for t, o in zip(texts, odd, strict=True)])
        hashes, sample, place = np.unique(words.hashes, return_index=True, return_inverse=True)
        rows = self.strings.known.find(hashes)
        fresh = np.flatnonzero(rows < 0)
        if len(fresh):
            rows[fresh] = self._learn(hashes[fresh], words.strings(sample[fresh]))
        ids, ends = self.strings.of(rows[place])
        cuts = np.concatenate([[0], ends])[words.first].tolist()
        return [self._whole(t).tobytes() if o else ids[a:b].tobytes() for t, o, a, b in zip(texts, odd, cuts, cuts[1:], strict=False)]


def _encoder(definition: str) -> Encoder:
    """The encoder of this worker process, kept from task to task."""
    return held("encoder", zlib.crc32(definition.encode()), build=lambda: Encoder(definition))


def _stands_at(documents: DataFrame) -> tuple[Column, Column]:
    """Where a row stands: its file, named so that names sort, and the row in it; in a computed table its partition and place."""
    if documents._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        return F.lpad(F.spark_partition_id().cast("string"), 20, "0"), F.monotonically_increasing_id()
    stored = documents.metadataColumn("_metadata")
    number = F.regexp_extract(stored["file_name"], r"^part-(\d+)", 1)  # has more digits in tables of 100,000 files
    return F.concat(F.lpad(number, 20, "0"), stored["file_path"]), stored["row_index"]


def token_pieces(
    documents: DataFrame, tokenizer: str, limit: int = LIMIT, keep_ids: bool = False, in_order: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (32-bit numbers as bytes) and the document's file and row."""
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition)
        for batch in slices(batches, "text", rows=2048, size=4 << 20):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, coded in enumerate(encoder.encode(batch.column("text").to_pylist())):
                coded += END
                for k, at in enumerate(range(0, len(coded), 4 * limit)):
                    part = coded[at:at + 4 * limit]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(part)
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            if in_order:
                columns += [batch.column(c).take(pa.array(row, pa.int64())) for c in ("file", "row")]
                names += ["file", "row"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    source = documents.select("doc_id", "text")
    if in_order:
        file, place = _stands_at(documents)
        source = documents.select("doc_id", "text", file.alias("file"), place.alias("row"))
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return source.mapInArrow(cut, schema + ", ids binary" * keep_ids + ", file string, row long" * in_order)


# --- one group ----------------------------------------------------------------------------


class Bins:
    """The bins of one group: each piece's bin, and the tokens in each."""

    def __init__(self, lengths: np.ndarray, limit: int) -> None:
        self.sizes, self.limit = np.asarray(lengths, np.int64), limit
        self.bin_of = np.zeros(len(self.sizes), np.int64)
        self.fill = np.zeros(0, np.int64)
        self.steps: Counter[tuple[int, int]] = Counter()  # by pieces given and taken back
        self.emptied = 0

    def arrive(self) -> None:
        """Pieces in their order, each into the fullest bin that takes it."""
        by_room: list[list[int]] = [[] for _ in range(self.limit + 1)]
        rooms = 0  # bit r: some bin has r tokens of room
        fill: list[int] = []
        for item, size in enumerate(self.sizes.tolist()):
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                at = by_room[room].pop()
                if not by_room[room]:
                    rooms ^= 1 << room
                fill[at] += size
            else:
                at = len(fill)
                fill.append(size)
            self.bin_of[item] = at
            room = self.limit - fill[at]
            if room:
                by_room[room].append(at)
                rooms |= 1 << room
        self.fill = np.array(fill, np.int64)

    def _give(self, low: int, high: int, given: list[int], back: list[int]) -> None:
        gain = int(self.sizes[given].sum() - self.sizes[back].sum())
        self.bin_of[given], self.bin_of[back] = high, low
        self.fill[low] -= gain
        self.fill[high] += gain
        self.steps[len(given), len(back)] += 1

    def _offers(self, low: int) -> tuple[np.ndarray, list[tuple[int, ...]]]:
        """What bin ``low`` can give, by size: its pieces, and pairs of its largest ones."""
        own = np.flatnonzero(self.bin_of == low)
        singles = [(i,) for i in own.tolist()]
        largest = own[np.argsort(-self.sizes[own], kind="stable")[:PAIRED]].tolist()
        offers = singles + list(combinations(largest, 2))
        sizes = np.array([sum(self.sizes[list(o)]) for o in offers], np.int64)
        order = np.argsort(sizes, kind="stable")
        return sizes[order], [offers[i] for i in order.tolist()]

    def _best(self, low: int, sizes: np.ndarray, back: np.ndarray, bins: np.ndarray) -> tuple[int, int] | None:
        """The offer and the return (of these sizes, in these bins) that raise the squared fills and move most."""
        room = self.limit - self.fill[bins]
        least = np.maximum(0, self.fill[low] - self.fill[bins])  # a gain above this raises the squared fills
        offer = np.searchsorted(sizes, back + room, side="right") - 1  # the largest that fits
        gain = np.where(offer >= 0, sizes[offer] - back, 0)
        gain[gain <= least] = 0
        if not len(gain) or not gain.max():
            return None
        at = int(gain.argmax())
        return int(offer[at]), at

    def _improve(self, low: int) -> bool:
        """The best move or exchange from bin ``low`` to another underfull bin."""
        open_bins = self.fill < self.limit
        open_bins[low] = False
        open_bins &= self.fill > 0
        sizes, offers = self._offers(low)
        bins, items = np.flatnonzero(open_bins), np.flatnonzero(open_bins[self.bin_of])
        best = self._best(low, sizes, np.concatenate([np.zeros(len(bins), np.int64), self.sizes[items]]), np.concatenate([bins, self.bin_of[items]]))
        if best:
            offer, at = best
            high, back = (bins[at], []) if at < len(bins) else (self.bin_of[items[at - len(bins)]], [int(items[at - len(bins)])])
            self._give(low, int(high), list(offers[offer]), back)
            return True
        # the other way: one for two of the smallest pieces of a bin
        items = items[np.lexsort((self.sizes[items], self.bin_of[items]))]
        where = self.bin_of[items]
        first = np.flatnonzero(np.diff(where, prepend=-1))
        rank = np.arange(len(items)) - np.repeat(first, np.diff(np.append(first, len(items))))
        pairs = [
            np.stack([np.flatnonzero(near), np.flatnonzero(near) + k])
            for k in range(1, SMALLEST) if (near := (where[:-k] == where[k:]) & (rank[k:] < SMALLEST)).any()
        ]
        if not pairs:
            return False
        left, right = items[np.concatenate(pairs, axis=1)]
        best = self._best(low, sizes, self.sizes[left] + self.sizes[right], self.bin_of[left])
        if best is None:
            return False
        offer, at = best
        self._give(low, int(self.bin_of[left[at]]), list(offers[offer]), [int(left[at]), int(right[at])])
        return True

    def search(self) -> None:
        """Empty the least filled bins into the others while there are more bins than the tokens need.

        A bin that no step improves is left, and the next one is tried, until none improves.
        """
        need, stuck = -(-int(self.sizes.sum()) // self.limit), np.zeros(len(self.fill), bool)
        while (self.fill > 0).sum() > need:
            tried = np.flatnonzero((self.fill > 0) & (self.fill < self.limit) & ~stuck)
            if not len(tried):
                return
            low = int(tried[self.fill[tried].argmin()])
            while self.fill[low] and self._improve(low):
                pass
            stuck[low] = True
            if not self.fill[low]:
                self.emptied += 1
                stuck[:] = False


def pack_lengths(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per piece its bin, its offset there, and the fill of that bin."""
    bins = Bins(lengths, limit)
    bins.arrive()
    bins.search()
    order = np.argsort(bins.bin_of, kind="stable")
    ends = np.cumsum(bins.sizes[order])
    starts = np.flatnonzero(np.diff(bins.bin_of[order], prepend=-1))
    base = np.repeat((ends - bins.sizes[order])[starts], np.diff(np.append(starts, len(order))))
    offset = np.empty(len(order), np.int64)
    offset[order] = ends - bins.sizes[order] - base
    return bins.bin_of, offset, bins.fill[bins.bin_of]


# --- all groups ---------------------------------------------------------------------------


def pack(
    documents: DataFrame, tokenizer: str, limit: int = LIMIT, keep_ids: bool = False, in_order: bool = False,
) -> DataFrame:
    """The pieces of all documents with sequence_id and offset."""
    cut = token_pieces(documents, tokenizer, limit, keep_ids, in_order)
    # the written copy fixes the row numbers
    pieces = materialise(cut.select(F.monotonically_increasing_id().alias("slot"), "*"), "pieces")
    if not in_order:
        return pieces.join(place(pieces.select("slot", "length"), limit), "slot").drop("slot")
    numbered = materialise(_numbered(pieces), "numbered")
    placed = place(numbered.select(F.col("at").alias("slot"), "length"), limit, in_order=True)
    placed = numbered.select("slot", "at").join(placed.withColumnRenamed("slot", "at"), "at").drop("at")
    return pieces.drop("file", "row").join(placed, "slot").drop("slot")


def _numbered(pieces: DataFrame) -> DataFrame:
    """slot, length, at: the places from 0 on in the order of file, row and piece, added up over files, runs of rows, pieces."""
    rows = pieces.select("slot", "length", "file", F.expr(f"row div {ORDERED_ROWS}").alias("run"), "row", "piece")
    runs = rows.groupBy("file", "run").agg(F.count(F.lit(1)).alias("held"))
    files = runs.groupBy("file").agg(F.sum("held").alias("held"))
    before = lambda window: F.coalesce(F.sum("held").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select("file", before(Window.orderBy("file")).alias("file_base"))  # a row per file
    runs = runs.select("file", "run", before(Window.partitionBy("file").orderBy("run")).alias("run_base"))
    inside = F.row_number().over(Window.partitionBy("file", "run").orderBy("row", "piece")) - 1
    based = rows.withColumn("inside", inside).join(runs, ["file", "run"]).join(files, "file")
    return based.select("slot", "length", (F.col("file_base") + F.col("run_base") + F.col("inside")).alias("at"))


def _ranges(rest: DataFrame, pieces: int) -> DataFrame:
    """The pieces with ``group``: ranges of the slots that hold about as many pieces each."""
    step = max(1, pieces // 16)
    fine = rest.withColumn("fine", F.expr(f"slot div {step}"))
    held = fine.groupBy("fine").agg(F.count(F.lit(1)).alias("held"))  # a row per 128 slots
    upto = F.sum("held").over(Window.orderBy("fine"))
    bounds = held.select("fine", F.floor((upto - 1) / pieces).alias("group"))
    return fine.join(bounds, "fine").drop("fine")


def place(pieces: DataFrame, limit: int = LIMIT, in_order: bool = False) -> DataFrame:
    """slot, sequence_id, offset for pieces given as (slot, length); slots are unique, and with ``in_order`` places in an order."""

    def pack_group(rows: pd.DataFrame) -> pd.DataFrame:
        if in_order:
            rows = rows.sort_values("slot")
        number, offset, fill = pack_lengths(rows["length"].to_numpy(), limit)
        named = rows["slot"].groupby(number).transform("min") if in_order else rows["sequence"] + number
        return rows.assign(sequence_id=named, offset=offset, fill=fill).drop(columns="sequence")

    rest, count = pieces.select("slot", "length"), pieces.count()
    size = ORDERED_PIECES if in_order else GROUP_PIECES
    done: DataFrame | None = None
    turn = 0
    while True:
        groups = max(1, -(-count // size))
        if in_order:
            numbered = _ranges(rest, size).withColumnRenamed("group", "sequence")
        else:
            group = F.pmod(F.xxhash64("slot"), F.lit(groups))
            first = (F.lit(turn << 36).cast("long") + group) * (1 << 20)  # a group has fewer bins than 2^20
            numbered = rest.withColumn("sequence", first)
        packed = numbered.groupBy("sequence").applyInPandas(
            pack_group, "slot long, length long, sequence_id long, offset long, fill long"
        )
        packed = materialise(packed, f"packed-{turn}")
        poor = packed.where(F.col("fill") < GOOD_FILL * limit)
        left = poor.count() if groups > 1 else 0
        again = 0 < left <= count * 3 // 4  # else taking bins apart no longer helps
        fixed = packed.where(F.col("fill") >= GOOD_FILL * limit) if again else packed
        fixed = fixed.select("slot", "sequence_id", "offset")
        done = fixed if done is None else done.unionByName(fixed)
        if not again:
            return done
        rest, count, turn = poor.select("slot", "length"), left, turn + 1


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and parts of pieces packed with ``keep_ids``: at most one sequence's tokens a row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"])).alias("ids"),
        F.transform("parts", lambda p: p.dropFields("ids")).alias("parts"),
    )
