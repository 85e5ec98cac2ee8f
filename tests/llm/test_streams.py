"""Mixing, chat rendering, components and the pipeline."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from hirelattice.llm import chat, mixing, ngram_join, packing
from hirelattice.llm.components import connected_components
from hirelattice.session import materialise
from tests.llm.conftest import schema, table
from tests.llm.test_documents import LONG, ODD, brute_lines, packed_as_told
from tests.oracle_compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("operator", "source", "sql"), [
    (mixing.report, "documents", mixing.ORACLE), (chat.render, "conversations", chat.ORACLE),
])
def test_equals_sql(spark, operator, source, sql):
    assert difference(operator(table(spark, source)), connect(FOLDER), sql) is None


def test_schedule_keeps_every_window_and_share(spark):
    quotas = spark.createDataFrame([("=a", 7), ("=b", 1), ("=c", 13), ("=d", 3), ("=e", 8)], "stream string, slots long")
    rows = mixing.period_schedule(quotas).collect()
    period = 32
    assert sorted(r.slot for r in rows) == list(range(period))
    for r in rows:
        assert r.turn * period // r.slots <= r.slot < -(-(r.turn + 1) * period // r.slots)
    for stream, slots in (("=a", 7), ("=b", 1), ("=c", 13), ("=d", 3), ("=e", 8)):
        taken = [r.slot for r in rows if r.stream == stream]
        for now in range(period + 1):
            assert abs(sum(s < now for s in taken) - now * slots / period) < 1


def test_mixing_odd_rows(spark, docs_of):
    rows = [(i, t, None, s) for (i, t), s in zip(ODD, ["a", "a", None, "b", "b", "-", "", ""], strict=True)]
    rows += [(i, "text " * 900, None, "hot") for i in range(100, 160)]
    docs = docs_of(rows)
    got = mixing.report(docs).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, len(t or "")) for i, t, _, s in rows)
    for source in {r.source for r in got}:
        placed = sorted((r.block, r.slot) for r in got if r.source == source)
        assert [s for _, s in placed] == sorted(s for _, s in placed)
    assert all(r.released <= r.slot < r.due for r in got)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    key = lambda frame: Counter(tuple(r) for r in frame.collect())
    assert key(mixed) == key(docs)
    weights = spark.createDataFrame([("hot", 9.0), ("a", 1.0), ("gone", 5.0), ("b", -1.0)], "source string, weight double")
    assert mixing.report(docs, weights).count() == len(rows)
    assert mixing.report(docs_of([])).count() == 0


def test_mix_follows_target_weights(spark, docs_of):
    docs = docs_of([(i, "x" * 1000, None, "abc"[i % 3]) for i in range(3000)], clash=False)
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2)], "source string, weight double")
    placed = mixing.schedule(docs, weights, block_chars=1000, period=100).collect()
    for now in (50, 333, 1500):
        for source, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
            assert abs(sum(r.slot < now for r in placed if r.source == source) - share * now) < 1


def test_long_documents_are_ahead_by_no_more_than_a_block_and_themselves(spark, docs_of):
    sizes = {"a": 300, "b": 5200}  # blocks have 1,000 characters
    docs = docs_of([(i, "x" * sizes[s], None, s) for i in range(400) for s in [("a", "b")[i % 8 == 0]]], clash=False)
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, weight double")
    placed = mixing.schedule(docs, weights, block_chars=1000, period=10).collect()
    ahead = []
    for now in range(10, 180):  # both sources last
        for source, longest in sizes.items():
            ahead.append(sum(r.size for r in placed if r.source == source and r.slot < now) - 500 * now)
            assert -1000 < ahead[-1] < 1000 + longest
    assert max(ahead) > 1000  # one block alone is no bound


TURN = schema(conv_id=T.LongType(), turn=T.LongType(), role=T.StringType(), text=T.StringType())


def test_chat_perspectives_and_masks(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi <|im_end|> all"), (1, 2, "bob", None), (1, 3, None, "who?"),
        (1, 1, "ann", "Hi <|im_end|> all"), (2, 0, "system", "alone"), (None, 0, " ", "x"), (None, None, "bob", "y"),
        (3, 0, "ann", LONG), (3, 1, "bob", "short"), (3, 2, "ann", "end"),
    ]
    turns = spark.createDataFrame(rows, TURN).selectExpr("*", "1 AS part", "2 AS `group`", "3 AS at", "4 AS speaker", "5 AS c")
    dialogues = defaultdict(list)
    for r in chat.render(turns, part_chars=100).collect():
        dialogues[r.conv_id, r.assistant].append(r)
    assert set(dialogues) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "unknown"), (None, "bob"), (3, "ann"), (3, "bob")}
    whole = {}
    for key, parts in dialogues.items():
        parts.sort(key=lambda r: r.part)
        text = "".join(r.text for r in parts)
        assert [r.start for r in parts] == list(np.cumsum([0, *(len(r.text) for r in parts)])[:-1])
        spans = [tuple(map(int, s.split("-"))) for r in parts for s in r.masks.split(",") if s]
        whole[key] = text, [text[a:b] for a, b in spans]
    text, said = whole[1, "ann"]
    assert text == (
        "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>assistant\nHi < |im_end|> all<|im_end|>\n"
        "<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>user name=unknown\nwho?<|im_end|>\n"
    )
    assert said == ["Hi < |im_end|> all<|im_end|>"]
    assert whole[1, "bob"][1] == ["<|im_end|>"]
    assert whole[3, "ann"][1] == [LONG + "<|im_end|>", "end<|im_end|>"]
    assert whole[None, "bob"][0].index("assistant") < whole[None, "bob"][0].index("unknown")  # a null turn comes first
    assert chat.render(turns.limit(0)).count() == 0


def test_one_long_conversation(spark):
    rows = [(1, i, "ab"[i % 2], f"turn {i}") for i in range(3000)]
    got = chat.render(spark.createDataFrame(rows, TURN), part_chars=1000).where("assistant = 'a'").orderBy("part").collect()
    assert len(got) > 50
    assert "".join(r.text for r in got) == "".join(
        f"<|im_start|>{'user name=b' if i % 2 else 'assistant'}\nturn {i}<|im_end|>\n" for i in range(3000)
    )


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 400)] + [(500, 500), (7, 3), (3, 7), (601, 600)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = dict(connected_components(frame).collect())
    expected = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 400)} | {600: 600, 601: 600}
    assert got == expected
    assert connected_components(frame.limit(0)).count() == 0


def test_pipeline_stages(spark):
    """Every stage against what its operator is to do with the stage's own input."""
    docs = table(spark, "documents")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(materialise(stage(spark, frames[-1], FOLDER), "stage"))
    for frame in frames[:-1]:
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes
    named, lines, unique, mixed = (f.collect() for f in frames[1:5])
    assert {r.doc_id for r in named} == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    wanted = brute_lines([(r.doc_id, r.text) for r in named])
    wanted = {d: t for d, (_, gone, t) in wanted.items() if not gone or t.strip()}
    assert {r.doc_id: r.text for r in lines} == wanted
    assert all(r.n_chars == len(r.text) for r in lines if r.text != {n.doc_id: n.text for n in named}[r.doc_id])
    linked = ngram_join.join_components(frames[2], corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILARITY).collect()
    assert {r.doc_id for r in unique} == {r.doc_id for r in linked if r.doc_id == r.component_id}
    place = {r.doc_id: (r.slot, r.block_start) for r in mixing.report(frames[3]).collect()}
    files = defaultdict(list)  # each file holds a range of the mix, in order
    for r in frames[4].select("doc_id", F.input_file_name().alias("file")).collect():
        files[r.file].append(place[r.doc_id])
    assert sum((files[f] for f in sorted(files)), []) == sorted(place.values())
    assert len(mixed) == len(unique)
    packed_as_told(frames[5].collect(), [(r.doc_id, r.text) for r in mixed])


def test_pipeline_odd_and_empty_documents(spark, docs_of):
    rows = [(i, t, "en", "s") for i, t in ODD]
    for docs in (docs_of(rows), docs_of([])):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
        docs.collect()


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).agg(F.count(F.lit(1))).first()[0] > 0


def test_sequences_follow_the_mix(spark, monkeypatch):
    """Other target weights give other sequences, and each is numbered by the place of its earliest document."""
    monkeypatch.setattr(packing, "ORDERED_PIECES", 20)
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[3:])  # the mix and what follows it
    docs = table(spark, "documents")
    sources = sorted({r.source for r in docs.select("source").collect()}, key=str)
    mix, seen = mixing.mix, []
    for heavy in (sources[0], sources[-1]):
        weights = spark.createDataFrame([(s, 0.9 if s == heavy else 0.01) for s in sources], "source string, weight double")
        monkeypatch.setattr(corpus_pipeline.mixing, "mix", lambda docs, weights=weights: mix(docs, weights))
        groups = defaultdict(set)
        for r in corpus_pipeline.run(spark, FOLDER).collect():
            groups[r.sequence_id].add((r.doc_id, r.piece))
        seen.append([frozenset(groups[k]) for k in sorted(groups)])
        by_source = {r.doc_id: r.source for r in docs.collect()}
        early = [by_source[d] for group in seen[-1][:len(seen[-1]) // 4] for d, _ in group]
        late = [by_source[d] for group in seen[-1][-(len(seen[-1]) // 4):] for d, _ in group]
        assert early.count(heavy) / len(early) > late.count(heavy) / len(late)
    assert set().union(*seen[0]) == set().union(*seen[1])
    assert set(seen[0]) != set(seen[1])


def test_packing_keeps_the_order_of_the_files(spark, docs_of, monkeypatch):
    monkeypatch.setattr(packing, "ORDERED_PIECES", 30)
    monkeypatch.setattr(packing, "ORDERED_ROWS", 4)
    rng = np.random.default_rng(8)
    texts = [(i, "word " * int(rng.integers(1, 9000))) for i in range(300)]
    docs = materialise(docs_of(texts, clash=False).repartitionByRange(7, "doc_id").sortWithinPartitions("doc_id"), "ordered")
    rows = packing.pack(docs, corpus_pipeline.WORDS, in_order=True).collect()
    bins, least = packed_as_told(rows, texts)
    assert bins <= least * 1.05 + 1
    place = {key: i for i, key in enumerate(sorted((r.doc_id, r.piece) for r in rows))}
    members = defaultdict(list)
    for r in rows:
        members[r.sequence_id].append(place[r.doc_id, r.piece])
    assert all(number == min(places) for number, places in members.items())
    near = [places for places in members.values() if max(places) - min(places) < 32]
    assert len(near) > len(members) / 2


def edf_by_hand(quotas):
    """Earliest deadline first over one period, slot by slot over all sources."""
    period, used, order = sum(quotas), [0] * len(quotas), []
    for slot in range(period):
        ready = [(-(-(u + 1) * period // q), i) for i, (u, q) in enumerate(zip(used, quotas)) if u < q and u * period // q <= slot]
        order.append(min(ready)[1])
        used[order[-1]] += 1
    return order


@pytest.mark.parametrize("quotas", [
    [1], [5], [1] * 7, [3, 1, 4, 1, 5, 9, 2, 6], [200, 1, 1, 1, 100, 2, 2, 1], [1, 1, 700] + [1] * 400 + [2, 3] * 20, [2] * 50 + [1] * 900,
])
def test_period_against_plain_scheduling(spark, quotas):
    rows = [(f"s{i:04d}", q) for i, q in enumerate(quotas)]
    plan = mixing.period_schedule(spark.createDataFrame(rows, "stream string, slots long")).collect()
    order = {r.slot: r.stream for r in plan}
    assert [order[k] for k in range(sum(quotas))] == [f"s{i:04d}" for i in edf_by_hand(quotas)]
    assert {r.period for r in plan} == {sum(quotas)} and len(plan) == sum(quotas)
    for r in plan:  # every block in its window
        q = dict(rows)[r.stream]
        assert r.slots == q and r.turn * sum(quotas) // q <= r.slot < -(-(r.turn + 1) * sum(quotas) // q)


def test_many_sources(spark, docs_of):
    """More sources than a period has slots."""
    rows = [(i, "text " * (1 + i % 5), None, f"site{i}") for i in range(3000)] + [(10_000 + i, "word " * 900, None, "large") for i in range(200)]
    got = mixing.schedule(docs_of(rows)).collect()
    assert len(got) == 3200 and len({r.source for r in got}) == 3001
    assert all(r.released <= r.slot < r.due for r in got)
