"""Alignment of two tokenizers by divide and conquer at shared cuts.

A text with a blank before it is encoded by tokenizer A (byte-level BPE) and by tokenizer B (BPE with byte fallback, which adds
the blank itself). Where tokens of both end at the same byte the text can be cut. An interval is cut at the common end nearest to
its middle: from the middle token of A outwards, each token's end is looked up among B's by bisection; both halves are cut in
turn, and an interval without a common end inside is a group. The tokens that end a group together are linked.

Neither tokenizer has a token that reaches over a blank, unless blanks stand in a row. So a text without blanks in a row is a list
of blank-led strings, which are encoded and cut once in a while and looked up after that; other texts are encoded and cut whole.

How often a pair of ids is linked is counted over the whole corpus: documents are written in chunks with the pairs that each
chunk holds and their counts; buckets of the pairs add these up and answer. The highest count per id of B is a table no longer than
B's vocabulary, so it fits every task.

Defined results: a null or empty text, and one whose tokens do not spell it in bytes, has no tokens: zeros and an empty text for the groups' digest.
A null ``doc_id`` stays null; repeated rows are aligned and counted one by one. Texts of any length are encoded whole. An empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelattice.llm import exchange
from hirelattice.llm.common import held, slices
from hirelattice.llm.exchange import HALF, MASK, bucket_cuts, bucket_of, groups, mixed, pack, pack_sorted, unpack, unpack_sorted
from hirelattice.llm.words import Grown, Known, WordHashes
from hirelattice.session import materialise

CHUNK_BYTES = 4 << 20  # text in a chunk
KNOWN_STRINGS, KNOWN_BYTES = 500_000, 40 << 20  # strings that a task remembers; bounds its memory, not the result
BUCKET_PAIRS = 1 << 20
#: How byte-level BPE cuts a text before merging (a fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# --- cutting ------------------------------------------------------------------------------


def cut_groups(a: np.ndarray, b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of tokens of both -> for every group, in order, the number of tokens of A and of B up to its end.

    The intervals to begin with start at the tokens ``first_a`` and ``first_b``; each ends with a common end. All intervals
    of one depth are cut together.
    """
    i0, j0 = first_a, first_b
    i1, j1 = np.append(i0[1:], len(a)), np.append(j0[1:], len(b))
    leaves = []
    while len(i0):
        last_a, last_b = i1 - 1, j1 - 1  # these end the interval
        cut_a, cut_b = np.zeros(len(i0), np.int64), np.zeros(len(i0), np.int64)  # tokens before the cut
        middle = (i0 + last_a) // 2
        searching = np.flatnonzero((last_a > i0) & (last_b > j0))
        step = 0
        while len(searching):
            for side in (step, -step) if step else (0,):
                at = middle[searching] + side
                inside = (at >= i0[searching]) & (at < last_a[searching]) & (cut_a[searching] == 0)
                some, at = searching[inside], at[inside]
                found = np.searchsorted(b, a[at])  # by bisection
                common = (found < last_b[some]) & (b[np.minimum(found, len(b) - 1)] == a[at])
                cut_a[some[common]], cut_b[some[common]] = at[common] + 1, found[common] + 1
            step += 1
            left = (cut_a[searching] == 0) & (middle[searching] - step >= i0[searching])
            right = (cut_a[searching] == 0) & (middle[searching] + step < last_a[searching])
            searching = searching[left | right]
        whole = cut_a == 0
        leaves.append(np.stack([i1[whole], j1[whole]]))
        i0, i1, j0, j1, cut_a, cut_b = (x[~whole] for x in (i0, i1, j0, j1, cut_a, cut_b))
        i0, i1 = np.concatenate([i0, cut_a]), np.concatenate([cut_a, i1])
        j0, j1 = np.concatenate([j0, cut_b]), np.concatenate([cut_b, j1])
    ends_a, ends_b = np.concatenate([np.zeros((2, 0), np.int64), *leaves], axis=1)
    return np.sort(ends_a), np.sort(ends_b)


# --- tokenizers ---------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, the bytes of each of their ids, and the ids as texts."""

    def __init__(self, definition: str, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        self.a = Tokenizer.from_str(definition)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=model)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in pieces]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        # an id of A before another and at its group's end, one of B before another, at its group's end and at the last one's
        self.texts = [f"{i}{mark}" for n, mark in ((n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";"), (n_b, "")) for i in range(n)]
        self.text_sizes = np.array([len(t) for t in self.texts], np.int64)
        self.ranked = self._by_rank(definition)

    def _by_rank(self, definition: str):
        """The same byte-level BPE as a table of ranks, which is faster, if ids are in the order of their merges; else None."""
        import tiktoken

        parts = json.loads(definition)
        vocabulary, merges = parts["model"]["vocab"], parts["model"]["merges"]
        joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
        split = parts["pre_tokenizer"]
        plain = parts["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split["add_prefix_space"]
        if not plain or [vocabulary.get(t) for t in joined] != list(range(256, 256 + len(joined))):
            return None
        special = {t["id"] for t in parts["added_tokens"]}
        ranks = {self.a_bytes[i]: i for i in vocabulary.values() if i not in special}
        return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and of B, if the tokens of both spell the text with a blank before it."""
        spelt = " " + text
        a = self.ranked.encode_ordinary(spelt) if self.ranked else self.a.encode(spelt, add_special_tokens=False).ids
        b = self.b.encode(text)
        spelt = spelt.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != spelt or b"".join(map(self.b_bytes.__getitem__, b)) != spelt:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])

    def written(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, last: np.ndarray) -> tuple[str, np.ndarray]:
        """The groups that end at these tokens as one text, and where each ends there; after a last one there is no mark."""
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        code_a, code_b = a.copy(), b + 2 * n_a
        code_a[cut_a - 1] += n_a
        code_b[cut_b - 1] += n_b
        code_b[cut_b[last] - 1] += n_b
        # A's tokens of a group come before B's: behind all tokens of the groups before
        group_a, group_b = np.searchsorted(cut_a, np.arange(len(a)), side="right"), np.searchsorted(cut_b, np.arange(len(b)), side="right")
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.concatenate([[0], cut_b])[group_a]] = code_a
        codes[np.arange(len(b)) + cut_a[group_b]] = code_b
        upto = np.cumsum(self.text_sizes[codes])
        return "".join(map(self.texts.__getitem__, codes.tolist())), upto[cut_a + cut_b - 1]


class Aligner:
    """Strings seen so far as numbered rows, found by their hash: how they are cut, and the pairs they link."""

    def __init__(self, tokenizers: Tokenizers) -> None:
        self.tokenizers = tokenizers
        self.hasher = WordHashes(b" ")
        self.forget()

    def forget(self) -> None:
        self.known = Known()
        self.bytes_held = 0
        self.groups: list[bytes | None] = []  # None: the tokens do not spell it
        self.sizes = Grown((3,), np.int64)  # tokens of A, tokens of B, groups
        self.pairs, self.upto = Grown((), np.uint64), Grown((), np.int64)  # pairs of all rows up to a row
        self.upto.add(np.zeros(1, np.int64))

    @property
    def full(self) -> bool:
        return len(self.groups) > KNOWN_STRINGS or self.bytes_held > KNOWN_BYTES

    def _add(self, coded: tuple[np.ndarray, np.ndarray] | None, ends: np.ndarray) -> None:
        """Rows for strings whose tokens stand in a row and end at these bytes."""
        if coded is None:
            if len(ends) > 1:
                raise ValueError("strings that are not spelt come one by one")
            self.groups.append(None)
            self.sizes.add(np.zeros((1, 3), np.int64))
            self.upto.add(self.upto.values[-1:])
            return
        a, b = coded
        ends_a, ends_b = self.tokenizers.ends(a, b)
        last_a, last_b = np.searchsorted(ends_a, ends) + 1, np.searchsorted(ends_b, ends) + 1  # strings end with both
        first = [np.concatenate([[0], x[:-1]]) for x in (last_a, last_b)]
        cut_a, cut_b = cut_groups(ends_a, ends_b, *first)
        last = np.searchsorted(cut_a, last_a)  # groups
        text, stops = self.tokenizers.written(a, b, cut_a, cut_b, last)
        stops = stops[last].tolist()
        self.groups += [text[s:e].encode() for s, e in zip([0, *stops], stops, strict=False)]
        counts = np.diff(last, prepend=-1)
        self.sizes.add(np.stack([last_a - first[0], last_b - first[1], counts], axis=1))
        self.upto.add(self.upto.values[-1] + np.cumsum(counts))
        self.pairs.add((b[cut_b - 1].astype(np.uint64) << HALF) | a[cut_a - 1].astype(np.uint64))
        self.bytes_held += len(text) + 8 * len(cut_a)

    def whole(self, text: str) -> int:
        """A row for a text of its own."""
        self._add(self.tokenizers.encode(text), np.array([1 + len(text.encode())]))
        return len(self.groups) - 1

    def learn(self, strings: list[str]) -> np.ndarray:
        """Rows for strings without blanks: encoded and cut as one text, in which their ends are shared cuts."""
        before = len(self.groups)
        coded = self.tokenizers.encode(" ".join(strings))
        if coded is None and len(strings) > 1:
            for string in strings:
                self.whole(string)
        else:
            self._add(coded, np.cumsum([1 + len(s.encode()) for s in strings]))
        return np.arange(before, len(self.groups))

    def rows(self, texts: list[str | None]) -> list[np.ndarray]:
        """Each text as rows, in order."""
        odd = [bool(t) and "  " in f" {t} " for t in texts]
        words = self.hasher.of_texts([b"" if o or not t else t.encode() for t, o in zip(texts, odd, strict=True)])
        hashes, sample, place = np.unique(words.hashes, return_index=True, return_inverse=True)
        rows = self.known.find(hashes)
        fresh = np.flatnonzero(rows < 0)
        if len(fresh):
            strings = [s.decode() for s in words.strings(sample[fresh])]
            rows[fresh] = self.learn(strings)
            self.known.add(hashes[fresh], rows[fresh])
        cuts = words.first.tolist()
        found = rows[place]
        return [np.array([self.whole(t)]) if o else found[s:e] for t, o, s, e in zip(texts, odd, cuts, cuts[1:], strict=False)]


# --- passes -------------------------------------------------------------------------------

DOCUMENT = pa.struct([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string())])


class Gathered:
    """The documents of a chunk as lists of rows of an aligner."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.members: list[np.ndarray] = []
        self.shas: list[str] = []
        self.size = 0

    def add(self, aligner: Aligner, ids: list[int | None], texts: list[str | None]) -> None:
        for doc_id, text, rows in zip(ids, texts, aligner.rows(texts), strict=True):
            strings = list(map(aligner.groups.__getitem__, rows.tolist()))
            spelt = bool(strings) and None not in strings
            self.ids.append(doc_id)
            self.shas.append(hashlib.sha256(b";".join(strings)).hexdigest() if spelt else "")
            self.members.append(np.sort(rows) if spelt else rows[:0])
            self.size += len(text or "")

    def batch(self, aligner: Aligner, chunk: int) -> pa.RecordBatch:
        held = np.array([len(m) for m in self.members], np.int64)
        every = np.concatenate([np.zeros(0, np.int64), *self.members])
        used, member = np.unique(every, return_inverse=True)
        sizes, upto = aligner.sizes.values[used], aligner.upto.values
        per_row = upto[used + 1] - upto[used]
        ends = np.cumsum(per_row)
        links = np.repeat(upto[used] - (ends - per_row), per_row) + np.arange(ends[-1] if len(ends) else 0)
        pairs, link = np.unique(aligner.pairs.values[links], return_inverse=True)
        uses = np.bincount(member, minlength=len(used))
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, link, np.repeat(uses, per_row))
        of = np.repeat(np.arange(len(held)), held)
        totals = np.zeros((len(held), 3), np.int64)
        np.add.at(totals, of, sizes[member])
        fields = [pa.array(self.ids, pa.int64()), *(pa.array(totals[:, k]) for k in range(3)), pa.array(self.shas, pa.string())]
        documents = pa.StructArray.from_arrays(fields, fields=list(DOCUMENT))
        return pa.RecordBatch.from_pydict({
            "chunk": pa.array([chunk], pa.int64()),
            "documents": pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), documents),
            "held": pa.array([pack(held)], pa.binary()),
            "members": pa.array([_pack_runs(member, held)], pa.binary()),
            "per_row": pa.array([pack(per_row)], pa.binary()),
            "links": pa.array([pack(link)], pa.binary()),
            "pairs": pa.array([pack_sorted(pairs)], pa.binary()),
            "counts": pa.array([pack(counts)], pa.binary()),
            "n_pairs": pa.array([len(pairs)], pa.int64()),
        })


def _pack_runs(numbers: np.ndarray, lengths: np.ndarray) -> bytes:
    """Ascending runs, each as its first number and the differences."""
    steps = np.diff(numbers, prepend=0)
    heads = (np.cumsum(lengths) - lengths)[lengths > 0]
    steps[heads] = numbers[heads]
    return pack(steps)


def _unpack_runs(data: bytes, lengths: np.ndarray) -> np.ndarray:
    numbers = np.cumsum(unpack(data).astype(np.int64))
    heads = np.cumsum(lengths) - lengths
    before = np.concatenate([[0], numbers])[heads]
    return numbers - np.repeat(before, lengths)


ALIGNED = (
    "chunk long, documents array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, groups_sha256: string>>, "
    "held binary, members binary, per_row binary, links binary, pairs binary, counts binary, n_pairs long"
)


def aligned_chunks(documents: DataFrame, byte_bpe: str, piece_bpe: str) -> DataFrame:
    """Chunks of aligned documents, written: per document its numbers and its strings, per string its links, the pairs and their counts."""
    with open(byte_bpe, encoding="utf-8") as file:
        definition = file.read()
    with open(piece_bpe, "rb") as file:
        model = file.read()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = held("aligner", zlib.crc32(model, zlib.crc32(definition.encode())), build=lambda: Aligner(Tokenizers(definition, model)))
        partition, turn, gathered = TaskContext.get().partitionId(), 0, Gathered()
        for batch in slices(batches, "text", rows=1024, size=2 << 20):
            gathered.add(aligner, batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            if aligner.full or gathered.size > CHUNK_BYTES:
                yield gathered.batch(aligner, exchange.chunk_number(partition, turn))
                turn, gathered = turn + 1, Gathered()
                if aligner.full:
                    aligner.forget()
        if gathered.ids:
            yield gathered.batch(aligner, exchange.chunk_number(partition, turn))

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(source.mapInArrow(align, ALIGNED), "aligned")


def _bucketed(row: dict, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of a chunk sorted by bucket, their buckets, and the order that sorts them."""
    pairs = unpack_sorted(row["pairs"])
    bucket = bucket_of(mixed(pairs), buckets)
    order, _, _ = groups(pairs, bucket)
    return pairs[order], bucket[order], order


def _add_up(rows: list[dict]) -> list[tuple[int | None, bytes]]:
    """Per chunk the corpus-wide count of each pair; without a chunk, the ids of B here and their highest counts."""
    pairs = [unpack_sorted(r["keys"]) for r in rows]
    every = np.concatenate(pairs)
    order, starts, run = groups(every, every)
    counts = np.concatenate([unpack(r["more"]) for r in rows]).astype(np.int64)
    totals = np.add.reduceat(counts[order], starts)
    ids = every[order][starts] >> HALF
    firsts = np.flatnonzero(np.diff(ids, prepend=np.uint64(1 << 40)))
    best = np.maximum.reduceat(totals, firsts)
    top = pack_sorted(ids[firsts])
    cuts = np.cumsum([len(p) for p in pairs])[:-1]
    given = [(r["chunk"], pack(t)) for r, t in zip(rows, np.split(totals[run], cuts), strict=True)]
    return [*given, (None, len(top).to_bytes(8, "little") + top + pack(best))]


def align(documents: DataFrame, byte_bpe: str, piece_bpe: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every document."""
    chunks = aligned_chunks(documents, byte_bpe, piece_bpe)
    load = chunks.agg(F.sum("n_pairs")).first()[0]
    buckets = exchange.bucket_count(chunks, load, BUCKET_PAIRS)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, bucket, order = _bucketed(row, buckets)
                counts = unpack(row["counts"])[order]
                cuts = list(bucket_cuts(bucket))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([b for b, _ in cuts], pa.int32()),
                    "chunk": pa.array([row["chunk"]] * len(cuts), pa.int64()),
                    "keys": pa.array([pack_sorted(pairs[s]) for _, s in cuts], pa.binary()),
                    "more": pa.array([pack(counts[s]) for _, s in cuts], pa.binary()),
                })

    asked = chunks.select("chunk", "pairs", "counts").mapInArrow(ask, "bucket int, chunk long, keys binary, more binary")
    counted = materialise(exchange.answers(asked, _add_up), "pair-counts")
    highest = highest_counts(counted)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _scored(batch.slice(i, 1), highest, buckets)

    located = chunks.drop("counts", "n_pairs").join(exchange.by_chunk(counted.where("chunk IS NOT NULL"), "counts"), "chunk", "left")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return located.mapInArrow(finish, schema)


def highest_counts(counted: DataFrame) -> np.ndarray:
    """The highest count of a pair by id of B: at most as many numbers as B's vocabulary has ids."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for given in batch.column("answer").to_pylist():
                end = 8 + int.from_bytes(given[:8], "little")
                ids, best = unpack_sorted(given[8:end]), unpack(given[end:])
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (ids, best)], names=["id", "best"])

    lists = counted.where("chunk IS NULL").select("answer").mapInArrow(spread, "id long, best long")
    rows = lists.groupBy("id").agg(F.max("best").alias("best")).collect()
    out = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["best"]
    return out


def _scored(row: pa.RecordBatch, highest: np.ndarray, buckets: int) -> pa.RecordBatch:
    documents = row.column("documents").flatten()
    fields = row.drop_columns(["documents"]).to_pylist()[0]
    pairs, bucket, order = _bucketed(fields, buckets)
    total = np.zeros(len(pairs), np.int64)
    for given in fields["counts"] or ():
        lo, hi = np.searchsorted(bucket, np.array([given["bucket"], given["bucket"] + 1], np.uint64))
        total[lo:hi] = unpack(given["answer"])
    at_top = total == highest[(pairs >> HALF).astype(np.int64)] if len(pairs) else total > 0
    by_pair = np.empty((len(pairs), 3), np.int64)  # links, best links, counts; in the chunk's order of pairs
    by_pair[order] = np.stack([np.ones(len(pairs), np.int64), at_top, total], axis=1)
    held, per_row = unpack(fields["held"]).astype(np.int64), unpack(fields["per_row"]).astype(np.int64)
    by_row = _sums(by_pair[unpack(fields["links"]).astype(np.int64)], per_row)
    sums = _sums(by_row[_unpack_runs(fields["members"], held)], held)
    names = ["doc_id", "n_a", "n_b", "n_groups"]
    return pa.RecordBatch.from_arrays(
        [*(documents.field(n) for n in names), *(pa.array(np.ascontiguousarray(sums[:, k])) for k in range(3)), documents.field("groups_sha256")],
        names=[*names, "n_links", "n_best", "count_sum", "groups_sha256"],
    )


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of runs of rows of these lengths."""
    upto = np.zeros((len(values) + 1, values.shape[1]), np.int64)
    np.cumsum(values, axis=0, out=upto[1:])
    ends = np.cumsum(lengths)
    return upto[ends] - upto[ends - lengths]
