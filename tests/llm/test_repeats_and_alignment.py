"""Substring dedup and cross-tokenizer alignment against brute force."""

import hashlib
import random
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hirelattice.llm import alignment, exchange, oracles, substring, words
from hirelattice.llm.registry import BYTES, PIECES

from tests.oracle_compare import connect, difference

from .conftest import table

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tokenizers():
    with open(BYTES, encoding="utf-8") as a, open(PIECES, "rb") as b:
        return alignment.Tokenizers(a.read(), b.read())


# --- substring dedup ----------------------------------------------------------------------


def repeats_by_force(rows, window=13):
    """doc_id, n_words, n_removed, digest, runs, text per row, by a dictionary of all windows."""
    cut = [(i, WORD.findall((t or "").encode())) for i, t in rows]
    last = 1 << 64
    first = {}
    for i, w in cut:
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            first[key] = min(first.get(key, last), last if i is None else i)
    out = []
    for i, w in cut:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (last if i is None else i):
                gone[s:s + window] = [True] * window
        at = [k for k, g in enumerate(gone) if g]
        runs = [(k, min(j for j in range(k, len(w) + 1) if j == len(w) or not gone[j]) - 1) for k in at if k == 0 or not gone[k - 1]]
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), len(at), hashlib.sha256(kept).hexdigest(), runs, kept.decode()))
    return sorted(out, key=repr)


def repeats(df, window=13):
    found = substring.remove_repeats(df, window, keep_text=True).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, [tuple(x) for x in r.repeats], r.kept_text) for r in found), key=repr)


def test_repeats_on_the_given_documents(spark):
    docs = table(spark, "documents")
    expected = repeats_by_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert repeats(docs) == expected
    assert sum(r[2] for r in expected) > 0


def test_repeats_equal_sql(spark):
    found = substring.remove_repeats(table(spark, "documents")).drop("repeats")
    assert difference(found, connect("/root/testdata/sf0.001"), oracles.SUBSTRINGS) is None


@pytest.mark.parametrize("size", [60, 1 << 22])
def test_repeats_within_and_across_chunks(spark, docs_of, monkeypatch, size):
    """Passages moved by any number of words, overlapping ones, copies, chains, and texts of few different words."""
    monkeypatch.setattr(substring.chunks_of, "__defaults__", (size,))
    monkeypatch.setattr(substring, "BUCKET_BYTES", 500)
    rng = random.Random(5)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    passage = fresh(40)
    rows = [(k, " ".join(fresh(k % 9) + passage[k % 5:13 + k % 28] + fresh(3))) for k in range(40)]
    rows += [(100 + k, " ".join(rng.choice("ab") for _ in range(60))) for k in range(6)]
    rows += [(200, " ".join(passage)), (201, " \t ".join(passage)), (50, "\n".join(passage[::-1])), (49, " ".join(passage[::-1]))]
    assert repeats(docs_of(rows)) == repeats_by_force(rows)


def test_repeats_edge_cases(spark, docs_of):
    long = " ".join(f"x{k}" for k in range(60_000))  # longer than what is hashed at once
    shared = " ".join("one two three four five six seven eight nine ten eleven twelve thirteen".split())
    rows = [
        (5, None), (6, ""), (7, " \n\t "), (None, shared), (None, shared), (3, shared), (3, shared), (2, "short text"), (1, "short text"),
        (8, long), (9, long + " tail"), (10, "y" * 700_000), (11, "é " * 30), (12, "é " * 14), (-4, shared + " x"),
        (13, "a\x0bb\x0cc d e f \x1c g"),  # only ASCII blanks cut
    ]
    assert repeats(docs_of(rows)) == repeats_by_force(rows)
    assert repeats(docs_of(rows[:0])) == []
    assert repeats(docs_of([(1, "a b c a b c"), (2, "c a b")]), 3) == repeats_by_force([(1, "a b c a b c"), (2, "c a b")], 3)


def test_texts_without_keys(spark, docs_of, tokenizers):
    """Nothing to ask for: texts shorter than a block, and texts without tokens."""
    short = [(1, "a b c"), (2, None), (3, ""), (4, "a b c d e f")]
    assert repeats(docs_of(short)) == repeats_by_force(short)
    twelve = [(1, "a b c d e f g h i j k l"), (2, "a b c d e f g h i j k l")]
    assert repeats(docs_of(twelve)) == repeats_by_force(twelve)
    assert aligned(docs_of([(1, None), (2, "")])) == aligned_by_force([(1, None), (2, "")], tokenizers)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=8), st.integers(1, 30))
def test_word_hashes(texts, span):
    """Equal words have equal hashes wherever they stand, and the words are those of a plain split."""
    hasher = words.WordHashes()
    before, words.SPAN = words.SPAN, span
    try:
        found = hasher.of_texts(texts)
    finally:
        words.SPAN = before
    split = [t.split() for t in texts]
    assert found.strings(np.arange(len(found.starts))) == [w for ws in split for w in ws]
    assert np.diff(found.first).tolist() == [len(ws) for ws in split]
    by_word = {}
    for h, w in zip(found.hashes.tolist(), (w for ws in split for w in ws)):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_packed_numbers(values):
    numbers = np.array(values, np.uint64)
    assert exchange.unpack(exchange.pack(numbers)).tolist() == values
    assert exchange.unpack_sorted(exchange.pack_sorted(np.sort(numbers))).tolist() == sorted(values)


def test_known_rows():
    known = words.Known()
    assert known.find(np.array([3], np.uint64)).tolist() == [-1]
    known.add(np.array([5, 9], np.uint64))
    known.add(np.array([1, 7], np.uint64))
    assert known.find(np.array([1, 2, 5, 7, 9, 11], np.uint64)).tolist() == [2, -1, 0, 3, 1, -1]


# --- alignment ----------------------------------------------------------------------------


def aligned_by_force(rows, tokenizers):
    """The contract's columns, from whole texts and sets of ends."""
    links, found = {}, {}
    for k, (_, text) in enumerate(rows):
        coded = tokenizers.encode(text) if text else None
        if coded is None:
            found[k], links[k] = (0, 0, 0, ""), []
            continue
        a, b = coded
        ends_a, ends_b = tokenizers.ends(a, b)
        i = j = 0
        ends_a, ends_b, a, b = ends_a.tolist(), ends_b.tolist(), a.tolist(), b.tolist()
        groups, links[k] = [], []
        for end in sorted(set(ends_a) & set(ends_b)):
            p, q = bisect_left(ends_a, end) + 1, bisect_left(ends_b, end) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
            links[k].append((a[i - 1], b[j - 1]))
        found[k] = (len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest())
    counts = Counter(x for ls in links.values() for x in ls)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for k, (i, _) in enumerate(rows):
        n_a, n_b, n_groups, sha = found[k]
        ls = links[k]
        out.append((i, n_a, n_b, n_groups, len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), sha))
    return sorted(out, key=repr)


def aligned(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[n] for n in names) for r in alignment.align(df, BYTES, PIECES).collect()), key=repr)


def test_alignment_of_the_given_documents(spark, tokenizers):
    docs = table(spark, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = aligned_by_force(rows, tokenizers)
    assert aligned(docs) == expected
    assert sum(r[3] for r in expected) > len(rows)


@pytest.mark.parametrize("few", [False, True])
def test_alignment_edge_cases(spark, docs_of, tokenizers, monkeypatch, few):
    if few:  # a chunk a few texts, a few pairs a bucket
        monkeypatch.setattr(alignment, "CHUNK_BYTES", 20)
        monkeypatch.setattr(alignment, "BUCKET_PAIRS", 1)
    texts = [
        None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a   b", "a \n b", "a\n\n b", "a\tb \t c", "<|endoftext|>", "x <|endoftext|> <s> </s> <unk> y",
        "naïve café — “quotes” …", "日本語のテキスト です", "مرحبا بالعالم", "🙂🙃 emoji 👩‍👩‍👧", "un▁der ▁ x", "a b 　 c", "é a ́b", "it's they're we'll 'S",
        "12345 67,890.12 3.14", "\x00 \x01\x7f", "ﬁne ½ x² №5", "word " * 2000, "z" * 9000, "é" * 5000 + " tail", "same text", "same text", "İstanbul ß ſ",
    ]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "same text"), (7, "a second row of an id")]
    assert aligned(docs_of(rows)) == aligned_by_force(rows, tokenizers)
    assert aligned(docs_of(rows[:0])) == []


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_divide_and_conquer_finds_every_common_end(a, b):
    a, b = sorted(a | {61}), sorted(b | {61})
    ends_a, ends_b = alignment.cut_groups(np.array(a), np.array(b), np.zeros(1, np.int64), np.zeros(1, np.int64))
    assert [a[i - 1] for i in ends_a] == [b[j - 1] for j in ends_b] == sorted(set(a) & set(b))


def test_strings_encode_as_in_their_text(tokenizers):
    """The premise of the look-up: cut before single blanks, texts encode in parts, for any characters."""
    rng = random.Random(3)
    letters = "abE'é\n\t\r 　日▁½🙂́.,;-12 "
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 25)))
        if "  " in f" {text} ":
            continue
        whole = tokenizers.encode(text)
        parts = [tokenizers.encode(s) for s in text.split(" ")]
        if whole is None:
            assert None in parts
        else:
            assert [x.tolist() for x in whole] == [[i for p in parts for i in p[k]] for k in (0, 1)]


def test_vocabularies_are_read_from_the_given_paths():
    assert BYTES == public_tokenizers.path("byte_bpe_50k.json")


def test_strings_are_forgotten_and_learnt_again(tokenizers, monkeypatch):
    texts = ["a bb ccc", "ccc dddddddd a", "dddddddd", None, "x  y", "un▁der a"]
    aligner = alignment.Aligner(tokenizers)
    groups = lambda: [[aligner.groups[r] for r in rows] for rows in aligner.rows(texts)]
    expected = groups()
    assert expected[3] == [] and expected[5][0] is None
    assert groups() == expected
    monkeypatch.setattr(alignment, "KNOWN_STRINGS", 2)
    assert aligner.full
    aligner.forget()
    assert not aligner.full
    assert groups() == expected


def test_ranks_give_the_ids_of_the_merges(tokenizers):
    """The table of ranks is a faster form of tokenizer A."""
    assert tokenizers.ranked is not None
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzéèçñüABC'’.,;0123 \n日🙂"
    for _ in range(300):
        text = " " + "".join(rng.choice(letters) for _ in range(40))
        assert tokenizers.ranked.encode_ordinary(text) == tokenizers.a.encode(text, add_special_tokens=False).ids
