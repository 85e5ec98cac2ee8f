"""Language ID by unigram pieces whose segmentations are summed out.

A word is a string of letters of the lower-cased text, written with the vocabulary's mark for
a word's start. Its probability in a language is the sum, over all ways to cut it into pieces of a
fixed public vocabulary, of the product of that language's piece probabilities; a forward pass over
the word gives that sum. A text scores the sum of its words' log probabilities. Piece probabilities
come from expectation-maximisation on word counts of a bounded sample of labelled documents. Letters that no training
text has say nothing, so a text in a foreign script scores the same in all languages.

Defined results: a null text or one without a letter is ``und`` with score 0; so is every text when
nothing can be learned (no labelled documents). Equal scores go to the alphabetically first
language. A null ``doc_id`` counts as held out. Repeated rows are predicted one by one. Extra columns are
ignored: only ``doc_id``, ``text`` and ``lang`` are read, and ``lang`` only in training. Words of any length are learnt, and texts of any
length are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelattice.llm.common import held, held_out, slices
from hirelattice.llm.words import Grown, Known, WordHashes
from hirelattice.session import materialise

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
START = "▁"  # the vocabulary's mark for the start of a word
UNSEEN = 0.01  # of the probability is spread evenly over all pieces, so pieces never seen favour no language
SHORT = 40  # longer words take the scaled path, as their probabilities leave a double's range
KNOWN_STRINGS = 400_000  # bounds the memory of a worker (about 60 MB), not the result


@dataclass
class PieceModel:
    """Log-free piece probabilities: ``table[piece]`` is a row with one value per language."""

    pieces: dict[str, int]
    languages: list[str]
    table: np.ndarray
    other: float = 1e-7  # probability of a character that no piece covers, the same everywhere
    longest: int = field(init=False)
    prefixes: dict[str, int] = field(init=False)  # every start of a piece; -1 if it is no piece itself

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.pieces), default=1)
        self.prefixes = {p[:i]: -1 for p in self.pieces for i in range(1, len(p))} | self.pieces


def vocabulary_pieces(path: str) -> dict[str, int]:
    """The letters-only, lower-case pieces of a sentencepiece vocabulary."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_byte(i) and not model.is_control(i))
    kept = [p for p in pieces if p.removeprefix(START).isalpha() and p == p.lower()]
    return {p: i for i, p in enumerate(dict.fromkeys(kept))}


def _matches(words: list[str], model: PieceModel) -> list[np.ndarray]:
    """All places where a piece stands in a word: arrays of word, start, end and piece (-1: other character)."""
    known = model.prefixes.get
    found: list[int] = []
    for w, word in enumerate(words):
        n = len(word)
        for i in range(n):
            piece = known(word[i])
            found += (w, i, i + 1, -1 if piece is None else piece)
            j = i + 1
            while piece is not None and j < n:
                j += 1
                piece = known(word[i:j])
                if piece is not None and piece >= 0:
                    found += (w, i, j, piece)
    return list(np.array(found, dtype=np.int64).reshape(-1, 4).T)


def _forward(words: list[str], model: PieceModel, found: list[np.ndarray]) -> np.ndarray:
    """alpha[word, position, language]: probability of all segmentations up to the position."""
    width = max(map(len, words)) + 1
    alpha = np.zeros((len(words), width, len(model.languages)))
    alpha[:, 0] = 1.0
    word_at, starts, ends, ids = found
    order = np.argsort(starts, kind="stable")
    cuts = np.searchsorted(starts[order], np.arange(width))
    table = np.vstack([model.table, np.full(len(model.languages), model.other)])  # the last row is piece -1
    for i in range(width - 1):
        at = order[cuts[i]:cuts[i + 1]]
        for length in np.unique(ends[at]) - i:
            here = at[ends[at] == i + length]
            w = word_at[here]
            alpha[w, i + length] += alpha[w, i] * table[ids[here]]
    return alpha


def word_log_probabilities(words: list[str], model: PieceModel) -> np.ndarray:
    """Log probability of each word in each language, all segmentations summed."""
    marked = [START + w for w in words]
    out = np.empty((len(words), len(model.languages)))
    short = [i for i, w in enumerate(marked) if len(w) <= SHORT]
    for at in range(0, len(short), 4096):
        some = short[at:at + 4096]
        group = [marked[i] for i in some]
        alpha = _forward(group, model, _matches(group, model))
        lengths = np.fromiter(map(len, group), dtype=np.int64)
        out[some] = np.log(alpha[np.arange(len(group)), lengths])
    for i, w in enumerate(marked):
        if len(w) > SHORT:
            out[i] = _scaled_forward(w, model)
    return out


def _scaled_forward(word: str, model: PieceModel) -> np.ndarray:
    """The forward pass for long words: only the last positions are kept, rescaled as they shrink."""
    n, span = len(word), model.longest
    window = np.zeros((span + 1, len(model.languages)))  # row r: position i + r
    window[0] = 1.0
    scale = np.zeros(len(model.languages))
    for i in range(n):
        for length in range(1, min(span, n - i) + 1):
            piece = model.pieces.get(word[i:i + length])
            if piece is not None:
                window[length] += window[0] * model.table[piece]
            elif length == 1:
                window[1] += window[0] * model.other
        window[:-1] = window[1:]
        window[-1] = 0.0
        top = window[0]
        scale += np.log(top)
        window /= top
    return scale


# --- training ---------------------------------------------------------------------------


def training_words(documents: DataFrame, max_documents: int) -> DataFrame:
    """Word counts per language of a bounded sample: about ``max_documents`` documents a language.

    The sample is a fixed set of hash values of ``doc_id`` and text, as many as the language's size asks for; repeated rows count once, so
    copies cannot swell it.
    """
    labelled = documents.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id")
    )
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), F.lit(float(max_documents)) / F.col("n"))
    steps = 1 << 30
    drawn = labelled.join(F.broadcast(sizes), "lang").where(  # one row per language
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(steps)) < share * steps
    ).select("doc_id", "lang", "text").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts: dict[tuple[str, str], int] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word in WORD.findall(text.lower()):
                    counts[lang, word] = counts.get((lang, word), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
                 pa.array(counts.values(), pa.int64())],
                names=["lang", "word", "n"],
            )

    counted = drawn.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _add_long(total: np.ndarray, word: str, lang: int, count: int, model: PieceModel) -> None:
    """Add the expected uses of pieces in a long word, by a forward and a backward pass over logarithms."""
    _, starts, ends, ids = (x.tolist() for x in _matches([word], model))
    logs = [float(np.log(model.table[i, lang] if i >= 0 else model.other)) for i in ids]
    forward, backward = (np.full(len(word) + 1, -np.inf) for _ in range(2))
    forward[0] = backward[-1] = 0.0
    matches = list(zip(starts, ends, logs, ids, strict=True))  # by start
    for i, j, p, _ in matches:
        forward[j] = np.logaddexp(forward[j], forward[i] + p)
    for i, j, p, _ in reversed(matches):
        backward[i] = np.logaddexp(backward[i], backward[j] + p)
    for i, j, p, piece in matches:
        if piece >= 0:
            total[piece, lang] += count * np.exp(forward[i] + p + backward[j] - forward[-1])


def _expected(model: PieceModel):
    """Expected uses of each piece by language, one array of them per task."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {lang: i for i, lang in enumerate(model.languages)}
        total = np.zeros_like(model.table)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True)
            usable = []
            for lang, word, n in rows:
                if len(word) < SHORT:
                    usable.append((place[lang], START + word, n))
                else:
                    _add_long(total, START + word, place[lang], n, model)
            for at in range(0, len(usable), 4096):
                some = usable[at:at + 4096]
                words = [w for _, w, _ in some]
                found = _matches(words, model)
                alpha = _forward(words, model, found)
                mirrored = _backward(words, model, found)
                lengths = np.fromiter(map(len, words), dtype=np.int64)
                langs = np.array([x[0] for x in some])
                counts = np.array([x[2] for x in some], dtype=float)
                whole = alpha[np.arange(len(words)), lengths, langs]
                w, starts, ends, ids = (x[found[3] >= 0] for x in found)
                lang = langs[w]
                use = counts[w] * alpha[w, starts, lang] * model.table[ids, lang] * mirrored[w, ends, lang] / whole[w]
                np.add.at(total, (ids, lang), use)
        at_piece, at_lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at_piece, pa.int32()), pa.array(at_lang, pa.int32()), pa.array(total[at_piece, at_lang])],
            names=["piece", "language", "uses"],
        )

    return step


def _backward(words: list[str], model: PieceModel, found: list[np.ndarray]) -> np.ndarray:
    """beta[word, position, language]: probability of all segmentations from the position on."""
    lengths = np.fromiter(map(len, words), dtype=np.int64)
    width = int(lengths.max()) + 1
    beta = np.zeros((len(words), width, len(model.languages)))
    beta[np.arange(len(words)), lengths] = 1.0
    word_at, starts, ends, ids = found
    table = np.vstack([model.table, np.full(len(model.languages), model.other)])
    order = np.argsort(starts, kind="stable")
    cuts = np.searchsorted(starts[order], np.arange(width + 1))
    for i in range(width - 2, -1, -1):
        at = order[cuts[i]:cuts[i + 1]]
        for length in np.unique(ends[at]) - i:
            here = at[ends[at] == i + length]
            w = word_at[here]
            beta[w, i] += beta[w, i + length] * table[ids[here]]
    return beta


def train(documents: DataFrame, vocabulary: str, max_documents: int = 600, rounds: int = 2) -> PieceModel:
    """Piece probabilities per language: ``rounds`` of expectation-maximisation from equal probabilities.

    ``max_documents`` bounds the training sample per language. Only piece totals (vocabulary times
    languages) come back to the driver.
    """
    words = materialise(training_words(documents, max_documents), "language-words")
    languages = sorted(row[0] for row in words.select("lang").distinct().collect())
    pieces = vocabulary_pieces(vocabulary)
    model = PieceModel(pieces, languages, np.full((len(pieces), len(languages)), 1.0 / max(1, len(pieces))))
    if not languages:
        return model
    for _ in range(rounds):
        uses = np.zeros_like(model.table)
        totals = (
            words.mapInArrow(_expected(model), "piece int, language int, uses double")
            .groupBy("piece", "language").agg(F.sum("uses").alias("uses"))
        ).toPandas()
        uses[totals["piece"], totals["language"]] += totals["uses"]
        shares = uses / np.maximum(uses.sum(axis=0), 1e-300)
        model = PieceModel(pieces, languages, (1 - UNSEEN) * shares + UNSEEN / len(pieces))
    return model


# --- prediction -------------------------------------------------------------------------


class Scorer:
    """Log probabilities of texts. Words and blank-separated strings seen before are looked up by their hash."""

    def __init__(self, model: PieceModel) -> None:
        self.model, self.width = model, len(model.languages)
        self.hasher = WordHashes()
        self._forget()

    def _forget(self) -> None:
        self.words, self.strings = Known(), Known()
        self.word_values, self.string_values = Grown((self.width,), float), Grown((self.width + 1,), float)

    def _of_strings(self, strings: list[str]) -> np.ndarray:
        """Per string the sum over its words, and how many they are."""
        from xxhash import xxh3_64_intdigest

        split = [WORD.findall(s.lower()) for s in strings]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        every = [w for ws in split for w in ws]
        hashed = np.fromiter((xxh3_64_intdigest(w) for w in every), np.uint64, len(every))
        keys, sample, place = np.unique(hashed, return_index=True, return_inverse=True)
        rows = self.words.find(keys)
        fresh = np.flatnonzero(rows < 0)
        if len(fresh):
            self.word_values.add(word_log_probabilities([every[i] for i in sample[fresh].tolist()], self.model))
            rows[fresh] = self.words.add(keys[fresh])
        out = np.zeros((len(strings), self.width + 1))
        out[:, -1] = counts
        np.add.at(out[:, :-1], np.repeat(np.arange(len(strings)), counts), self.word_values.values[rows[place]])
        return out

    def texts(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Per text its log probability in each language, None if it has no word."""
        if len(self.words) > KNOWN_STRINGS or len(self.strings) > KNOWN_STRINGS:
            self._forget()
        words = self.hasher.of_texts([t.encode() if t else b"" for t in texts])
        keys, sample, place = np.unique(words.hashes, return_index=True, return_inverse=True)
        rows = self.strings.find(keys)
        fresh = np.flatnonzero(rows < 0)
        if len(fresh):
            self.string_values.add(self._of_strings([s.decode() for s in words.strings(sample[fresh])]))
            rows[fresh] = self.strings.add(keys[fresh])
        totals = np.zeros((len(texts), self.width + 1))
        filled = np.flatnonzero(np.diff(words.first))
        if len(filled):
            totals[filled] = np.add.reduceat(self.string_values.values[rows[place]], words.first[:-1][filled], axis=0)
        return [t[:-1] if self.width and t[-1] else None for t in totals]

    def best(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Per text the most probable language and its posterior under equal priors."""
        return [self._top(total) for total in self.texts(texts)]

    def _top(self, total: np.ndarray | None) -> tuple[str, float]:
        if total is None:
            return UNKNOWN, 0.0
        top = int(total.argmax())
        return self.model.languages[top], 1.0 / float(np.exp(total - total[top]).sum())


def _scorer(model: PieceModel) -> Scorer:
    """The scorer of this worker process, kept from task to task while the model stays the same."""
    return held("scorer", zlib.crc32(model.table.tobytes(), len(model.languages)), build=lambda: Scorer(model))


def predict(documents: DataFrame, model: PieceModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score: the best language and its posterior under equal priors."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in slices(batches, "text", rows=2048, size=4 << 20):
            best = scorer.best(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([b[0] for b in best], pa.string()),
                 pa.array([b[1] for b in best], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    source = documents.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(label, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(documents: DataFrame, vocabulary: str, max_documents: int = 600) -> DataFrame:
    """Train on the documents that carry a language and are not held out, predict for all."""
    return predict(documents, train(documents, vocabulary, max_documents))


def keep_identified(documents: DataFrame, vocabulary: str, min_score: float = 0.5) -> DataFrame:
    """The documents in a recognised language, all columns as they were.

    Rejected are texts without a letter and texts for which no language reaches ``min_score``
    of the probability. The prediction is made in the pass that hands the rows on.
    """
    model = train(documents, vocabulary)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in slices(batches, "text", rows=2048, size=4 << 20):
            best = scorer.best(batch.column("text").to_pylist())
            yield batch.filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in best], pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
