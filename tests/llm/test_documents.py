"""Operators on documents against brute force, and their defined results for odd input."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from hirelattice.llm import language, licenses, line_dedup, ngram_join, packing, quality
from tests.llm.conftest import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LONG = "lorem ipsum dolor sit amet " * 40_000  # a million characters

ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "42 !? 7"), (None, "one two three four five"), (6, LONG), (7, "same"), (7, "same")]


# --- packing ------------------------------------------------------------------------------


def packed_as_told(rows, documents, limit=4096):
    """Are the pieces the tokenizer's ids, cut and laid out as stated?"""
    tokenizer = Tokenizer.from_file(WORDS)
    wanted = Counter()
    for doc_id, text in documents:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), limit)):
            part = ids[at:at + limit]
            wanted[doc_id, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= limit
    return len(bins), -(-sum(r.length for r in rows) // limit)


def test_packing_ids_and_places(spark):
    docs = table(spark, "documents")
    bins, least = packed_as_told(packing.pack(docs, WORDS).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert bins == least


def test_packing_odd_texts(spark, docs_of):
    texts = [*ODD, (8, "a<|endoftext|>b <|END|>"), (9, "Ünïcode ΣΑΣ ﬁ ½ x² 漢字 é z\x1cq"), (10, "it's we'll 'Tis __a__")]
    packed_as_told(packing.pack(docs_of(texts), WORDS).collect(), texts)
    assert packing.pack(docs_of([]), WORDS).count() == 0


def test_packing_in_groups(spark, docs_of, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 40)
    rng = np.random.default_rng(3)
    texts = [(i, "word " * int(rng.integers(1, 3000))) for i in range(400)]
    bins, least = packed_as_told(packing.pack(docs_of(texts), WORDS).collect(), texts)
    assert bins <= least * 1.03 + 1


def bins_of(lengths, places, limit):
    bins = packing.Bins(np.array(lengths), limit)
    bins.bin_of = np.array(places)
    bins.fill = np.bincount(bins.bin_of, bins.sizes).astype(int)
    return bins


@pytest.mark.parametrize("lengths, places, limit, step", [
    ([6, 5, 5, 2, 2], [0, 1, 2, 0, 1], 10, (1, 1)),  # three bins; exchanges fit all into two
    ([9, 4, 3], [0, 1, 1], 16, (2, 0)), ([7, 6, 1], [0, 1, 2], 7, (1, 0)), ([8, 2, 7, 3], [0, 1, 2, 3], 10, (1, 0)),
    ([6, 3, 5, 4, 2], [0, 0, 1, 1, 2], 10, (1, 1)),  # the least filled bin is stuck, the next one is not
])
def test_local_search_empties_bins(lengths, places, limit, step):
    bins = bins_of(lengths, places, limit)
    bins.search()
    assert (bins.fill > 0).sum() == -(-sum(lengths) // limit)
    assert bins.steps[step] > 0
    assert np.bincount(bins.bin_of, bins.sizes, len(bins.fill)).tolist() == bins.fill.tolist()


@pytest.mark.parametrize("lengths, places, limit, step", [
    ([3, 3, 5, 4], [0, 0, 1, 1], 10, (2, 1)), ([5, 2, 2, 5], [0, 1, 1, 1], 10, (1, 2)), ([5, 4, 4], [0, 1, 1], 9, (1, 1)),
    ([2, 1, 7], [0, 0, 1], 10, (2, 0)),
])
def test_steps_raise_the_squared_fills(lengths, places, limit, step):
    bins = bins_of(lengths, places, limit)
    before = (bins.fill ** 2).sum()
    assert bins._improve(0) and bins.steps == {step: 1}
    assert (bins.fill ** 2).sum() > before and bins.fill.max() <= limit
    assert np.bincount(bins.bin_of, bins.sizes, 2).tolist() == bins.fill.tolist()
    while bins.fill[0] and bins._improve(0):
        assert bins.fill.max() <= limit


def test_local_search_does_the_work_on_test_data(spark):
    """From bins in order of arrival, its steps reach the least number of bins."""
    lengths = [r.length for r in packing.token_pieces(table(spark, "documents", "/root/testdata/sf0.01"), WORDS).select("length").collect()]
    bins = packing.Bins(np.array(lengths), packing.LIMIT)
    bins.arrive()
    arrived, need = len(bins.fill), -(-sum(lengths) // packing.LIMIT)
    bins.search()
    assert arrived > need == (bins.fill > 0).sum()
    assert bins.emptied == arrived - need and bins.steps[1, 1] > 0 and bins.steps[2, 1] > 0
    assert bins.fill.max() <= packing.LIMIT


def test_sequences_hold_the_ids(spark, docs_of):
    texts = [(1, "alpha beta"), (2, "gamma"), (3, None)]
    rows = packing.sequences(packing.pack(docs_of(texts), WORDS, keep_ids=True)).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    for row in rows:
        ids = np.frombuffer(bytes(row.ids), "<u4")
        expected = []
        for part in row.parts:
            expected += [*tokenizer.encode(dict(texts)[part.doc_id] or "", add_special_tokens=False).ids, 1]
        assert list(ids) == expected


# --- n-gram join --------------------------------------------------------------------------


def brute_components(documents, words, part):
    sets = []
    for _, text in documents:
        found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        grams = [tuple(found[i:i + words]) for i in range(len(found) - words + 1)] or ([tuple(found)] if found else [])
        sets.append(frozenset(grams))
    lowest = [i for i, _ in documents]
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= part * len(a | b) and lowest[j] < lowest[i]:
                    lowest[i], changed = lowest[j], True
    return Counter((d[0], len(s), c) for d, s, c in zip(documents, sets, lowest, strict=True))


def near_copies(seed, groups, words=60):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    out, n = [], 0
    for size in groups:
        base = [vocabulary[i] for i in rng.integers(0, 500, int(rng.integers(2, words)))]
        for _ in range(size):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(0, len(copy)))] = vocabulary[int(rng.integers(0, 500))]
            out.append((n, " ".join(copy)))
            n += 1
    return out


@pytest.mark.parametrize(("words", "part"), [(3, 90), (5, 80)])
def test_join_against_all_pairs(spark, docs_of, monkeypatch, words, part):
    monkeypatch.setattr(ngram_join, "CHUNK", 16)  # files are cut into chunks
    documents = near_copies(5, (60, 20, 8, 4, 3, 2, 2, *[1] * 60), words=150)
    got = ngram_join.join_components(docs_of(documents), words, part).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(documents, words, part)


def test_join_of_test_data(spark):
    docs = table(spark, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = ngram_join.join_components(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 3, 90)


def test_join_odd_rows(spark, docs_of):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_components(docs_of(
        [*ODD, (8, "SAME"), (9, "one two THREE four\nfive"), (10, "a b"), (11, "b a"), (12, "É b"), (13, "é b")]
    )).collect())
    assert got == Counter({
        (1, 0, 1): 1, (2, 0, 2): 1, (3, 0, 3): 1, (4, 1, 4): 1, (None, 3, 9): 1, (9, 3, 9): 1, (6, 5, 6): 1, (7, 1, 7): 2,
        (8, 1, 7): 1, (10, 1, 10): 1, (11, 1, 11): 1, (12, 1, 12): 1, (13, 1, 13): 1,
    })
    assert ngram_join.join_components(docs_of([])).count() == 0


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_linkable_sets_against_counts(spark, docs_of, monkeypatch, broadcast):
    """Sets stay that share enough of their shingles with other sets; equal sets count as one, within a chunk and across chunks."""
    monkeypatch.setattr(ngram_join, "GATHERED", 4)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", broadcast)
    rng = np.random.default_rng(3)
    passage = " ".join(f"p{i}" for i in range(12))
    own = [" ".join(f"v{i}" for i in rng.integers(0, 900, int(rng.integers(1, 60)))) for _ in range(30)]
    texts = [text for _, text in near_copies(9, (9, 4, 2, *[1] * 9), words=40)]
    texts += own + [f"{text} {passage}" for text in own[:20]] + own[:6] * 3 + [own[7].upper(), None, "", " \n", passage, "v1", "V1"]
    chunks = ngram_join.materialise(ngram_join.shingle_chunks(docs_of(list(enumerate(texts)), clash=False), 3), "chunks")
    rows = ngram_join.chunk_members(chunks).collect()
    assert len({r.id for r in rows}) == len(texts) and len({r.id - r.id % 4 for r in rows}) > 12
    sets = {r.id: frozenset(ngram_join.shingle_hashes((texts[r.doc_id] or "").encode(), 3).tolist()) for r in rows}
    assert {r.id: len(sets[r.id]) for r in rows} == {r.id: r.n for r in rows}
    chosen = {}
    for i in sorted(sets):
        chosen.setdefault(sets[i], i)
    chosen.pop(frozenset())
    copies = spark.createDataFrame([(i,) for i, x in sets.items() if x and chosen[x] != i], "id long")
    held_by = Counter(x for s in chosen for x in s)
    for part in (1, 50, 80, 90):
        stay = {i for s, i in chosen.items() if 100 * sum(held_by[x] > 1 for x in s) >= part * len(s)}
        assert 0 < len(stay) < len(chosen)
        got = [r.id for r in ngram_join.linkable(chunks, copies, ngram_join.Threshold(part)).collect()]
        assert sorted(got) == sorted(stay)


def test_shared_passages_fill_no_files(spark, docs_of, monkeypatch):
    """Documents that share passages, but have too many shingles of their own, meet in no file."""
    written, materialise = {}, ngram_join.materialise

    def watched(df, label):
        out = materialise(df, label)
        written.setdefault(label, out)
        return out

    monkeypatch.setattr(ngram_join, "materialise", watched)
    passage = " ".join(f"p{i}" for i in range(70))
    documents = [(i, f"{passage} " + " ".join(f"d{i}w{k}" for k in range(30))) for i in range(20)]
    documents += [(20, " ".join(f"x{k}" for k in range(99))), (21, " ".join(f"x{k}" for k in range(100)))]
    got = ngram_join.join_components(docs_of(documents), 5, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(documents, 5, 80)
    assert sorted(r.doc_id for r in written["points"].collect()) == [20, 21]
    filed = {r.id for r in written["filed-together"].collect()}
    assert filed and filed <= {r.id for r in written["points"].collect()}


def test_keep_one(spark, docs_of):
    kept = ngram_join.keep_one(docs_of([*ODD, (8, "SAME"), (9, "one two THREE four\nfive")])).select("doc_id", "text").collect()
    assert Counter(r.doc_id for r in kept) == Counter([1, 2, 3, 4, 9, 6, 7])


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_kept_rows_stay_where_they_are(spark, docs_of, monkeypatch, broadcast):
    """Of rows that repeat id and text one is kept, of a group the smallest place; rows without near-duplicates meet no shuffle."""
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", broadcast)
    lone = [(n, " ".join(f"lone{n}w{i}" for i in range(9))) for n in range(30, 40)]
    group = [(5, "MUCH the same text"), (4, "much the same\ntext"), (4, "much the same\ntext"), (9, "much the same text"), (None, "much the same text")]
    documents = [*lone, *lone[:3], *group, (None, "no id"), (None, "no id"), (50, None), (50, None), (51, " ")]
    kept = Counter((r.doc_id, r.text) for r in ngram_join.keep_one(docs_of(documents), 3, 90).collect())
    assert kept == Counter([*lone, group[1], (None, "no id"), (50, None), (50, None), (51, " ")])
    if broadcast:
        plan = ngram_join.keep_one(docs_of(documents), 3, 90)._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti, BuildRight" in plan and "SortMergeJoin" not in plan


def test_a_pair_counts_in_its_first_file():
    """Files that hold the same members give a pair once, and files of which none is among the first ones of both give it each."""
    counts = np.zeros((6, ngram_join.GROUPS), np.int32)
    counts[:, :20] = 1
    keys, files = [7, 8, 9], [[7, 8, 9], [7, 8, 9]]
    one = {"cell": np.repeat([1, 2, 3], 2), "id": [10, 11] * 3, "side": [0] * 6, "component": [10, 11] * 3, "n": [20] * 6,
           "key": np.repeat(keys, 2), "counts": list(counts), "files": files * 3}

    def found(columns):
        batch = pa.RecordBatch.from_pydict({**columns, "side": pa.array(columns["side"], pa.int32())})
        pairs = (b.to_pydict() for b in ngram_join._search_cells(ngram_join.Threshold(80))(iter([batch])))
        return [p for b in pairs for p in zip(b["a"], b["b"], strict=True)]

    assert found(one) == [(10, 11)]
    assert found({**one, "files": [[1, 8, 9], [2, 8, 9]] * 3}) == [(10, 11)]
    assert found({**one, "files": [[1, 2], [3, 4]] * 3}) == [(10, 11)] * 3


def test_candidates_come_from_trees(spark):
    """Cells of any size are searched by a tree, and some cells of the test data are."""
    rng = np.random.default_rng(1)
    threshold = ngram_join.Threshold(80)
    searched = []
    search = ngram_join.RTree.search
    ngram_join.RTree.search = lambda self, *a: searched.append(len(self.points)) or search(self, *a)
    try:
        for members in (2, 3, 9, 40):
            counts = rng.poisson(0.2, (members, ngram_join.GROUPS)).astype(np.int32)
            counts[members // 2:] = counts[:members - members // 2]
            sizes = counts.sum(axis=1).astype(np.int64)
            ids = np.arange(members)
            found = ngram_join._cell_pairs(threshold, ids, np.zeros(members, np.int64), ids, sizes, counts)
            bound = np.minimum(counts[:, None], counts[None]).sum(axis=2)
            wanted = threshold.reached(bound, sizes[:, None] + sizes[None])
            assert sorted(found) == [(i, j) for i in range(members) for j in range(i + 1, members) if wanted[i, j]]
    finally:
        ngram_join.RTree.search = search
    assert searched == [2, 3, 9, 40]


def test_tree_finds_all_pairs_within_bound():
    rng = np.random.default_rng(1)
    points = rng.poisson(3, (300, 256)).astype(np.int32)
    points[100:120] = points[0] + rng.integers(0, 2, (20, 256))
    sizes, threshold = points.sum(axis=1), ngram_join.Threshold(90)
    a, b = ngram_join.RTree(points, sizes).search(points, sizes, threshold)
    bound = np.minimum(points[:, None, :], points[None, :, :]).sum(axis=2)
    expected = threshold.reached(bound, sizes[:, None] + sizes[None, :])
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == set(zip(*map(list, map(np.ndarray.tolist, np.nonzero(expected))), strict=True))


# --- lines --------------------------------------------------------------------------------


def within_one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    front = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    back = next((i for i, (x, y) in enumerate(zip(a[::-1], b[::-1], strict=False)) if x != y), min(len(a), len(b)))
    return front + back >= max(len(a), len(b)) - 1


def brute_lines(documents, least=line_dedup.MIN_CHARS):
    """Equal lines that are not blank at any length, near ones from ``least`` characters on."""
    earlier, out = [], {}
    for doc_id, text in sorted(documents):
        kept = []
        for line in text.split("\n"):
            plain = line.strip(" \t\r\x0b\x0c")
            near = [e for e in earlier if len(e) >= least] if len(plain) >= least else []
            if not plain or not (plain in earlier or any(within_one_edit(plain, e) for e in near)):
                kept.append(line)
            if plain:
                earlier.append(plain)
        out[doc_id] = (len(text.split("\n")), len(text.split("\n")) - len(kept), "\n".join(kept))
    return out


def test_lines_against_all_pairs(spark, docs_of):
    rng = np.random.default_rng(11)
    letters = "abcdefgéß漢 "
    bases = ["".join(rng.choice(list(letters), int(rng.integers(8, 200)))) for _ in range(12)]
    documents = []
    for i in range(60):
        lines = []
        for _ in range(int(rng.integers(0, 6))):
            line = list(bases[int(rng.integers(0, 12))])
            for _ in range(int(rng.integers(0, 3))):
                at = int(rng.integers(0, len(line)))
                line[at:at + int(rng.integers(0, 2))] = rng.choice(list(letters), int(rng.integers(0, 2))).tolist()
            lines.append("".join(line))
        documents.append((i, "\n".join(lines)))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.report(docs_of(documents)).collect()}
    assert got == brute_lines(documents)


def test_lines_odd_rows(spark, docs_of):
    long = "x" * 5000 + "y" * 5000
    rows = [
        (1, None), (2, ""), (3, "a line of text\n\n a line of text\t\nshort"), (4, "a line of text"), (None, "a line of texts"),
        (5, long), (6, long[:70] + long[71:]), (7, "Zeile Nummer eins"), (7, "Zeile Nummer eins"), (8, "short\nZeile Nummer ein"),
    ]
    docs = docs_of(rows)
    got = Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in line_dedup.report(docs).collect())
    assert got == Counter([
        (1, 0, 0, None), (2, 1, 0, ""), (3, 4, 1, "a line of text\n\nshort"), (4, 1, 1, ""), (None, 1, 1, ""), (5, 1, 0, long),
        (6, 1, 1, ""), (7, 1, 0, "Zeile Nummer eins"), (7, 1, 0, "Zeile Nummer eins"), (8, 2, 2, ""),
    ])
    done = line_dedup.dedup_lines(docs)
    assert done.dtypes == docs.dtypes and {r.t for r in done.collect()} == {"clash"}
    assert Counter(r.text for r in done.collect()) == Counter(r[3] for r in got.elements())
    assert line_dedup.report(docs_of([])).count() == 0


def test_lines_without_broadcast(spark, docs_of, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    documents = [(1, "the first of lines"), (2, "the first of line"), (3, "the first of linez\nother line here")]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.report(docs_of(documents)).collect()}
    assert got == brute_lines(documents)


def test_few_shared_halves_move_no_lines(spark, docs_of, monkeypatch):
    """Halves are counted, without the lines that have them, and few shared ones go to where the lines are."""
    plans, materialise = {}, line_dedup.materialise

    def watched(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return materialise(df, label)

    monkeypatch.setattr(line_dedup, "materialise", watched)
    documents = [(1, "a pair of lines\nno other like it"), (2, "a pair of line\na pear of lines"), (3, "nothing alike in here")]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.report(docs_of(documents)).collect()}
    assert got == brute_lines(documents)
    assert "min(h1" not in plans["shared-halves"]
    assert "BroadcastHashJoin" in plans["partners"] and "SortMergeJoin" not in plans["partners"]


def test_short_lines_repeated_exactly(spark, docs_of):
    documents = [
        (1, "Les.\n\n \nAnd so on.\na"), (2, " Les.\t\nLes\nAnd so on.\n\nb\na"), (3, "Les.\nAnd so of.\nnine char"), (4, "nine chars"),
    ]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.report(docs_of(documents)).collect()}
    assert got == brute_lines(documents) == {  # near copies only from ten characters on; blank lines stay
        1: (5, 0, "Les.\n\n \nAnd so on.\na"), 2: (6, 3, "Les\n\nb"), 3: (3, 2, "nine char"), 4: (1, 0, "nine chars"),
    }
    kept = line_dedup.report(docs_of(documents), min_exact=line_dedup.MIN_CHARS).collect()
    assert {r.doc_id: r.n_removed for r in kept} == {1: 0, 2: 1, 3: 1, 4: 0}  # a floor for exact copies, if one is asked for


def test_lines_of_rows_with_one_id(spark, docs_of):
    """They are at the same place: none removes the other, a later id loses to both."""
    rows = [(1, "one common line here"), (1, "one common line here\nand another"), (2, "one common line herE\nand another"), (None, None), (None, "and another")]
    got = Counter((r.doc_id, r.n_removed, r.text) for r in line_dedup.report(docs_of(rows)).collect())
    assert got == Counter([
        (1, 0, "one common line here"), (1, 0, "one common line here\nand another"), (2, 2, ""), (None, 0, None), (None, 1, ""),
    ])


# --- licences -----------------------------------------------------------------------------


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        wanted = phrase.split()
        here = [i for i in range(len(words)) if words[i:i + len(wanted)] == wanted]
        places += here
        labels |= {label} if here else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licence_base_on_test_data(spark):
    docs = table(spark, "documents", "/root/testdata/sf0.01")
    wanted = {r.doc_id: brute_base(r.text) for r in docs.collect()}
    got = licenses.scan(docs).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == wanted
    assert any(r.labels != r.base_labels for r in got)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_licence_templates_and_odd_rows(spark, docs_of):
    mit = licenses.TEMPLATES[0][1]
    rows = [
        *ODD, (20, "x " * 500 + mit.upper() + ". then cc-by/nc and the Apache License, Version 2"),
        (21, mit.replace("software", "program")), (22, "permission is hereby granted to nobody"),
        (23, "under the MIT license under the mit license"), (24, "gnu general public license version 3"),
    ]
    got = {}
    for r in licenses.scan(docs_of(rows)).collect():
        got[r.doc_id] = r
    assert (got[20].labels, got[20].base_labels, got[20].score) == ("apache-2,cc-by-nc,mit", "apache-2,cc-by-nc", 1.0)
    assert got[21].labels == "mit" and got[21].base_labels == "" and 0.6 <= got[21].score < 1
    assert got[22].labels == "" and got[22].score == 0.0
    assert (got[23].n_base, got[23].first_word, got[23].last_word) == (2, 0, 4)
    assert got[24].labels == ""  # six of eleven words in place are too few
    assert (got[1].n_words, got[1].labels, got[1].first_word) == (0, "", None)
    assert licenses.scan(docs_of([])).count() == 0


def brute_labels(text):
    """Labels and score from every template, every phrase of it and every place in the text, without an index."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    labels = set(filter(None, brute_base(text)[4].split(",")))
    score = 1.0 if labels else 0.0
    cut = lambda t: re.findall(r"[a-z0-9]+", t.lower())
    for label, body, phrases in [*licenses.TEMPLATES, *licenses.FULL_TEXTS]:
        template = cut(body)
        for phrase in map(cut, phrases):
            place = next(i for i in range(len(template)) if template[i:i + len(phrase)] == phrase)
            for at in range(len(words) - len(phrase) + 1):
                if words[at:at + len(phrase)] == phrase:
                    start = at - place
                    same = sum(0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(template))
                    if same / len(template) >= 0.6:
                        labels.add(label)
                        score = max(score, same / len(template))
    return ",".join(sorted(labels)), score


def test_licence_labels_and_scores_against_all_places(spark, docs_of):
    rng = np.random.default_rng(8)
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    bodies = [body for _, body, _ in [*licenses.TEMPLATES, *licenses.FULL_TEXTS]]
    for k, body in enumerate(bodies * 4):
        words = body.split()
        for at in np.flatnonzero(rng.random(len(words)) < 0.02 * (k // len(bodies)) ** 2):
            words[at] = rng.choice(["other", "", "software", "license the"])
        cut = slice(int(rng.integers(0, 8)) * (k % 3 == 1), len(words) - int(rng.integers(0, 8)) * (k % 3 == 2))
        rows.append((10_000 + k, "Some text. " * int(rng.integers(0, 4)) + " ".join(words[cut]) + " More " + bodies[int(rng.integers(0, len(bodies)))][:80]))
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs_of(rows)).collect()}
    expected = {i: brute_labels(t) for i, t in rows}
    assert {i: x[0] for i, x in got.items()} == {i: x[0] for i, x in expected.items()}
    assert all(np.isclose(got[i][1], expected[i][1]) for i in got)
    assert len({x[0] for x in expected.values()}) > 15


# --- language -----------------------------------------------------------------------------


def segmentations(word, pieces):
    if not word:
        yield []
    for i in range(1, len(word) + 1):
        if word[:i] in pieces or i == 1:
            for rest in segmentations(word[i:], pieces):
                yield [word[:i], *rest]


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(2)
    pieces = {p: i for i, p in enumerate(["d", "a", "b", "ab", "▁a", "bab", "aab", "c"])}
    model = language.PieceModel(pieces, ["x", "y"], rng.dirichlet(np.ones(8), 2).T)
    words = ["a", "ab", "babaab", "abcdab", "q", "a" * 12]
    row = lambda p: model.table[pieces[p]] if p in pieces else np.full(2, model.other)
    for word, got in zip(words, language.word_log_probabilities(words, model), strict=True):
        total = sum(np.prod([row(p) for p in cut], axis=0) for cut in segmentations("▁" + word, pieces))
        assert np.allclose(got, np.log(total))
        assert np.allclose(language._scaled_forward("▁" + word, model), np.log(total))
    long = language.word_log_probabilities(["ab" * 3000], model)
    assert np.isfinite(long).all()


def test_long_words_are_learnt(spark, docs_of):
    """Expected uses of pieces in words of any length, against a sum over all segmentations."""
    pieces = {"▁a": 0, "▁": 1, "a": 2, "b": 3, "ab": 4, "ba": 5, "▁ab": 6}
    table = np.random.default_rng(1).dirichlet(np.ones(len(pieces)), 2).T.copy()
    model = language.PieceModel(pieces, ["x", "y"], table)
    words = ["abbaab", "bac", "a"]

    def segmentations(word):
        if not word:
            yield []
        for k in range(1, len(word) + 1):
            if word[:k] in pieces or (k == 1 and word[0] not in "▁ab"):
                yield from ([word[:k], *rest] for rest in segmentations(word[k:]))

    expected = np.zeros_like(table)
    for n, word in enumerate(words, 2):
        weighed = [(s, np.prod([table[pieces[p], 1] if p in pieces else model.other for p in s])) for s in segmentations("▁" + word)]
        total = sum(w for _, w in weighed)
        for s, w in weighed:
            for p in s:
                if p in pieces:
                    expected[pieces[p], 1] += n * w / total
    found = np.zeros_like(table)
    for n, word in enumerate(words, 2):
        language._add_long(found, "▁" + word, 1, n, model)
    assert np.allclose(found, expected)
    # a word of 50 letters counts as one of 10 does, and so does one whose probability leaves a double's range
    batch = pa.RecordBatch.from_pydict({"lang": ["x"] * 3, "word": ["ab" * 5, "ab" * 25, "ab" * 2000], "n": [5, 7, 1]})
    out = next(language._expected(model)(iter([batch])))
    uses = dict(zip(out.column("piece").to_pylist(), out.column("uses").to_pylist()))
    letters = sum(uses[pieces[p]] * len(p.strip("▁")) for p in pieces if pieces[p] in uses)
    assert np.isclose(letters, 5 * 10 + 7 * 50 + 4000)


def test_language_accuracy_held_out(spark):
    docs = table(spark, "documents", "/root/testdata/sf0.01")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.identify(docs, PIECES).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    tested = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in tested]) > 0.99


def test_language_odd_rows(spark, docs_of):
    rows = [(i, "the cat and the dog and the house", "en") for i in range(30)]
    rows += [(i, "der Hund und die Katze und das Haus", "de") for i in range(30, 60)]
    odd = [(i + 100 if i else None, t) for i, t in ODD] + [(200, "ሀሁሂ"), (201, "THE DOG!", "de")]
    got = {}
    for r in language.identify(docs_of(rows + odd), PIECES).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    for empty in (101, 102, 103, 104):
        assert got[empty] == [("und", 0.0)]
    assert got[201][0][0] == "en" and got[0][0][0] == "en" and got[30][0][0] == "de"
    assert len(got[107]) == 2 and got[None][0][0] in ("de", "en")
    assert got[200] == [("de", 0.5)]  # no training text has these letters: equal scores, first language
    unlabelled = language.identify(docs_of([(1, "some text"), (2, None)]), PIECES).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    assert language.identify(docs_of([]), PIECES).count() == 0


# --- quality ------------------------------------------------------------------------------


def test_quality_against_labels(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in table(spark, "labels", folder).collect()}
    got = [r for r in quality.classify(table(spark, "documents", folder)).collect() if r.doc_id in truth]
    good = [r.kept for r in got if truth[r.doc_id] == 1]
    bad = [r.kept for r in got if truth[r.doc_id] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.35


def test_labeller_accuracies_are_found():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.8
    accuracy = [0.95, 0.9, 0.8, 0.7, 0.6]
    said = [np.where(rng.random(len(truth)) < a, truth, ~truth) for a in accuracy]
    silent = rng.random((len(truth), 5)) < 0.2
    patterns = ["".join("0" if s else "+" if v else "-" for v, s in zip(vs, ss, strict=True)) for vs, ss in zip(zip(*said, strict=True), silent, strict=True)]
    belief = quality.posteriors(Counter(patterns))
    right = np.mean([(belief[p] > 0.5) == t for p, t in zip(patterns, truth, strict=True)])
    assert right > 0.93


def em_by_hand(counts, rounds=50):
    """The posteriors by plain loops over patterns, classes and labellers."""
    good = {p: 0.1 if "-" in p else 0.9 for p in counts}
    total = sum(counts.values())
    for _ in range(rounds):
        weight = {c: {p: n * (good[p] if c == "+" else 1 - good[p]) for p, n in counts.items()} for c in "+-"}
        new = {}
        for p in counts:
            odds = {}
            for c in "+-":
                odds[c] = np.log((sum(weight[c].values()) + 1) / (total + 2))
                for k, vote in enumerate(p):
                    if vote != "0":
                        said = {v: sum(w for q, w in weight[c].items() if q[k] == v) + (2.0 if v == c else 0.5) for v in "+-"}
                        odds[c] += np.log(said[vote] / sum(said.values()))
            new[p] = 1 / (1 + np.exp(odds["-"] - odds["+"]))
        good = new
    return good


def test_quality_against_brute_force(spark):
    """Votes, posteriors, the scorer's training and all scores, with dense features and plain loops."""
    rows = [(r.doc_id, (r.text or "").encode()) for r in table(spark, "documents").collect()]
    counts = Counter(quality.votes(t) for _, t in rows)
    belief = em_by_hand(counts)
    got = {r.doc_id: r for r in quality.classify(table(spark, "documents")).collect()}
    assert {i: got[i].votes for i, _ in rows} == {i: quality.votes(t) for i, t in rows}
    assert all(np.isclose(got[i].p_good, belief[quality.votes(t)], atol=1e-9) for i, t in rows)

    used = sorted({f for _, t in rows for w in t.split() for f in quality.features(w)})
    place = {f: k for k, f in enumerate(used)}
    texts = [(i, t) for i, t in rows if t.split()]
    x = np.zeros((len(texts), len(used)))
    for n, (_, t) in enumerate(texts):
        for w in t.split():
            for f in quality.features(w):
                x[n, place[f]] += 1 / len(t.split())
    wanted = np.array([belief[quality.votes(t)] for _, t in texts])
    weights, bias = np.zeros(len(used)), 0.0
    moments = [np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0]
    for step in range(1, 121):
        error = (1 / (1 + np.exp(-(x @ weights + bias))) - wanted) / len(texts)
        slope, lean = x.T @ error + 1e-7 * weights, error.sum()
        for k, g in ((0, slope), (2, lean)):
            moments[k] = 0.9 * moments[k] + 0.1 * g
            moments[k + 1] = 0.99 * moments[k + 1] + 0.01 * g ** 2
        rate = 0.3 * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
        weights = weights - rate * moments[0] / (np.sqrt(moments[1]) + 1e-9)
        bias -= rate * moments[2] / (np.sqrt(moments[3]) + 1e-9)
    scores = 1 / (1 + np.exp(-(x @ weights + bias)))
    assert all(abs(got[i].score - s) < 1e-5 for (i, _), s in zip(texts, scores, strict=True))
    assert all(r.kept == (r.score >= 0.5) for r in got.values())


def test_quality_odd_rows(spark, docs_of):
    rows = [*ODD, *((i, f"A plain sentence number {i} about the weather, the sea and the long road to the old town. It ends here, as all "
                       f"stories of this kind do, with a walk.") for i in range(20, 60)),
            *((i, "buy$$$ now### cheap%%% pills*** " * 10) for i in range(60, 70))]
    got = {}
    for r in quality.classify(docs_of(rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert all(got[i][0].kept for i in range(20, 60)) and not any(got[i][0].kept for i in range(60, 70))
    assert got[1][0].score == got[1][0].p_good and len(got[7]) == 2
    assert all(0 <= r.score <= 1 for rs in got.values() for r in rs)
    assert quality.classify(docs_of([])).count() == 0
