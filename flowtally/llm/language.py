"""Language by unigram pieces, summed over all segmentations.

Pieces come from a fixed public vocabulary. A word (a run of letters, lower-cased, after a
word mark) has as its probability in a language the sum, over every way to cut it into
pieces, of the product of the pieces' probabilities: the forward algorithm. A text's score
is the product over its words and the share of the language.

Piece probabilities are learned from all training documents: each word's cuts are weighed
by a first guess that follows the vocabulary's order, and the expected number of times each
piece is used is summed per language (one round of expectation and maximisation). A letter
that no piece covers is the piece ``unknown``.

A word may be as long as a text that is written without blanks; its sums are scaled up
whenever they become small, and the scale is kept as a logarithm.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.llm.common import held_out

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
LONGEST_PIECE = 12
#: Words and letters of them a task keeps scored, and letters of words handled together. All
#: are shared among the languages, so that memory does not grow with them.
CACHE, CACHE_LETTERS, TOGETHER = 800_000, 1 << 25, 200_000
#: Imagined uses, spread over pieces by the first guess.
SMOOTHING = 1000.0
#: What a task holds besides is a probability for each piece and language.
MAX_LANGUAGES = 500
#: Sums below this are scaled up by its inverse.
SMALL = 1e-100


def pieces(path: str = VOCABULARY) -> list[str]:
    """The pieces of letters, with or without the word mark, in the vocabulary's order."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    listed = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    fit = [p for p in listed if len(p) <= LONGEST_PIECE and p == p.lower() and (p == MARK or LETTERS.fullmatch(p.removeprefix(MARK)))]
    return fit if MARK in fit else [*fit, MARK]


def first_guess(n: int) -> np.ndarray:
    """Shares that fall with the place in the vocabulary; ``unknown`` comes last."""
    guess = 1 / (np.arange(n + 1) + 20.0)
    guess[n] /= 100
    return guess / guess.sum()


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def _next_hash(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hash of a text from that of the text without its last letter."""
    h = (h + code) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Vocabulary:
    """Piece numbers by hash of the piece: two places for each, so that a look at both tells."""

    BITS = 17
    PREFIX_BITS = 20

    def __init__(self, listed: Sequence[str]) -> None:
        self.size = len(listed)
        self.keys = np.zeros(1 << self.BITS, np.uint64)
        self.numbers = np.full(1 << self.BITS, -1, np.int32)
        self.prefixes = np.zeros(1 << self.PREFIX_BITS, bool)
        owner: dict[int, int] = {}
        hashes = []
        for piece in listed:
            h = np.zeros(1, np.uint64)
            for code in np.frombuffer(piece.encode("utf-32-le"), np.uint32).astype(np.uint64):
                h = _next_hash(h, code)
                self.prefixes[h >> np.uint64(64 - self.PREFIX_BITS)] = True
            hashes.append(h[0])
        keys = np.array(hashes, np.uint64)
        places = np.stack(self._places(keys), 1)
        for number in range(self.size):
            place = int(places[number, 0])
            for _ in range(500):
                number, owner[place] = owner.get(place, -1), number
                if number < 0:
                    break
                place = int(places[number].sum() - place)  # the other place of the one turned out
            else:
                raise ValueError("The vocabulary does not fit its table")
        for place, number in owner.items():
            self.keys[place], self.numbers[place] = keys[number], number

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint64(64 - self.BITS)
        first = (h * np.uint64(0xD6E8FEB86659FD93)) >> shift
        second = (h * np.uint64(0xA0761D6478BD642F)) >> shift
        # Two different places, whatever the hash.
        return first.astype(np.int64), np.where(first == second, first ^ np.uint64(1), second).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 where there is none."""
        first, second = self._places(h)
        found = np.where(self.keys[second] == h, self.numbers[second], -1)
        return np.where(self.keys[first] == h, self.numbers[first], found)

    def begins(self, h: np.ndarray) -> np.ndarray:
        """False where no piece begins like this."""
        return self.prefixes[h >> np.uint64(64 - self.PREFIX_BITS)]


class Lattice:
    """All cuts of some words into pieces: an arc for each piece and place where it fits."""

    def __init__(self, words: Sequence[str], vocabulary: Vocabulary) -> None:
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        #: Rows are the words, the longest first.
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.n, self.length = len(words), int(self.lengths[0])
        codes = np.frombuffer("".join(MARK + words[i] for i in self.order).encode("utf-32-le"), np.uint32).astype(np.uint64)
        rows = np.repeat(np.arange(self.n, dtype=np.int32), self.lengths)
        places = np.arange(len(codes)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        left = self.lengths[rows] - places
        alive, h = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        arcs = []
        for size in range(1, LONGEST_PIECE + 1):
            inside = left[alive] >= size
            alive, h = alive[inside], h[inside]
            h = _next_hash(h, codes[alive + size - 1])
            found = vocabulary.find(h)
            if size == 1:
                found[found < 0] = vocabulary.size  # unknown
            held = found >= 0
            arcs.append((alive[held], np.full(held.sum(), size), found[held]))
            more = vocabulary.begins(h)
            alive, h = alive[more], h[more]
            if not len(alive):
                break
        start, size, piece = (np.concatenate(x) for x in zip(*arcs))
        self.row, self.start, self.end, self.piece = rows[start], places[start], places[start] + size, piece
        # By end, then by row: what comes in at a place lies together, and each row has some.
        self._sort(self.end)
        #: How many words are at least so long.
        self.live = np.searchsorted(-self.lengths, -np.arange(self.length + 2), "right")

    def _sort(self, place: np.ndarray) -> None:
        order = np.argsort(place * self.n + self.row, kind="stable")
        self.row, self.start, self.end, self.piece = (x[order] for x in (self.row, self.start, self.end, self.piece))

    def _in(self) -> Iterator[tuple[int, slice, np.ndarray]]:
        """Each place with the arcs that end there and where those of each row begin."""
        bounds = np.searchsorted(self.end, np.arange(self.length + 2))
        new = np.append(True, (self.row[1:] != self.row[:-1]) | (self.end[1:] != self.end[:-1]))
        for place in range(1, self.length + 1):
            arcs = slice(bounds[place], bounds[place + 1])
            yield place, arcs, np.flatnonzero(new[arcs])

    def log_total(self, p: np.ndarray) -> np.ndarray:
        """``[word, language]``: the logarithm of the sum over all cuts. Only the places that a
        piece can reach back to are held."""
        ring = LONGEST_PIECE + 1
        alpha = np.zeros((ring, self.n, p.shape[1]))
        alpha[0] = 1
        logs = np.zeros((self.n, p.shape[1]))
        totals = np.empty_like(logs)
        for place, arcs, first in self._in():
            came = alpha[self.start[arcs] % ring, self.row[arcs]]
            came *= p[self.piece[arcs]]
            now = np.add.reduceat(came, first)
            live, here = len(now), place % ring
            alpha[here, :live] = now
            if now.min() < SMALL:
                low = np.zeros(logs.shape, bool)
                low[:live] = now < SMALL
                alpha[:, low] /= SMALL
                logs[low] += np.log(SMALL)
            done = slice(self.live[place + 1], live)
            totals[self.order[done]] = np.log(alpha[here, done]) + logs[done]
        return totals

    def forward(self, p: np.ndarray) -> np.ndarray:
        """``[place, word, language]``: the sum over cuts up to each place."""
        alpha, logs = self._forward(p)
        back = np.argsort(self.order)
        return (alpha * np.exp(logs))[:, back]

    def _forward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums up to each place and the logarithms of their scales."""
        alpha = np.zeros((self.length + 1, self.n, p.shape[1]))
        alpha[0] = 1
        logs = np.zeros_like(alpha)
        for place, arcs, first in self._in():
            before = self.start[arcs], self.row[arcs]
            live = len(first)
            scale = logs[place - 1, :live]
            now = np.add.reduceat(alpha[before] * p[self.piece[arcs]] * np.exp(logs[before] - scale[self.row[arcs]]), first)
            low = now < SMALL
            alpha[place, :live], logs[place, :live] = np.where(low, now / SMALL, now), scale + np.where(low, np.log(SMALL), 0)
        return alpha, logs

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """``[piece, language]``: expected uses in words seen ``counts[word, language]`` times.

        With one column in ``p`` it holds for all languages, and the cuts are gone through once."""
        alpha, logs = self._forward(p)
        counts = counts[self.order]
        rows = np.arange(self.n)
        beta, beta_logs = np.zeros_like(alpha), np.zeros_like(alpha)
        beta[self.lengths, rows] = 1 / alpha[self.lengths, rows]
        beta_logs[self.lengths, rows] = -logs[self.lengths, rows]
        uses = np.zeros((len(p), counts.shape[1]))
        self._sort(self.start)
        bounds = np.searchsorted(self.start, np.arange(self.length + 1))
        new = np.append(True, (self.row[1:] != self.row[:-1]) | (self.start[1:] != self.start[:-1]))
        for place in range(self.length - 1, -1, -1):
            arcs = slice(bounds[place], bounds[place + 1])
            first, row, piece = np.flatnonzero(new[arcs]), self.row[arcs], self.piece[arcs]
            after = self.end[arcs], row
            live = len(first)
            scale = beta_logs[place + 1, :live]
            flow = p[piece] * beta[after] * np.exp(beta_logs[after] - scale[row])
            now = np.add.reduceat(flow, first)
            flow = flow * alpha[place, row] * np.exp(scale[row] + logs[place, row])
            low = now < SMALL
            beta[place, :live], beta_logs[place, :live] = np.where(low, now / SMALL, now), scale + np.where(low, np.log(SMALL), 0)
            for k in range(counts.shape[1]):
                uses[:, k] += np.bincount(piece, flow[:, min(k, flow.shape[1] - 1)] * counts[row, k], len(p))
        self._sort(self.end)
        return uses


def in_groups(words: Iterable[str], languages: int = 1) -> Iterator[list[str]]:
    """Words of like length, so many that their letters, filled up to the longest, times the
    languages stay bounded; one word may be longer."""
    ordered = sorted(words, key=len, reverse=True)
    low = 0
    while low < len(ordered):
        high = low + max(1, TOGETHER // ((len(ordered[low]) + 2) * max(1, languages)))
        yield ordered[low:high]
        low = high


def _use_batches(ids: Vocabulary, languages: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {x: k for k, x in enumerate(languages)}
        guess = first_guess(ids.size)[:, None]
        uses = np.zeros((ids.size + 1, len(languages)))
        seen: list[Counter] = [Counter() for _ in languages]
        letters = 0

        def add() -> None:
            for group in in_groups(set().union(*seen)):
                counts = np.array([[c[w] for c in seen] for w in group], float)
                uses.__iadd__(Lattice(group, ids).expected(guess, counts))
            for c in seen:
                c.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                words = words_of(text.as_py())
                seen[place[lang]].update(words)
                letters += sum(map(len, words))
                if sum(map(len, seen)) > CACHE // 4 or letters > CACHE_LETTERS:
                    add()
                    letters = 0
        add()
        piece, language = np.nonzero(uses)
        for low in range(0, len(piece), 1 << 16):
            part = slice(low, low + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece[part].astype(np.int32)), pa.array(language[part].astype(np.int32)), pa.array(uses[piece[part], language[part]])],
                ["piece", "language", "uses"],
            )

    return count


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    languages: list[str]
    p: np.ndarray
    prior: np.ndarray


def fit(docs: DataFrame, path: str = VOCABULARY) -> Model:
    """Learn from the text and language of all documents that are not held out.

    What comes to the driver is a count for each piece and language, whatever the corpus.
    """
    train = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text")
    listed = train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(listed) > MAX_LANGUAGES:
        raise ValueError(f"More than {MAX_LANGUAGES} languages")
    vocabulary, languages = Vocabulary(pieces(path)), [row.lang for row in listed]
    guess = first_guess(vocabulary.size)
    uses = np.zeros((len(guess), len(languages)))
    if languages:
        rows = train.mapInArrow(_use_batches(vocabulary, languages), "piece int, language int, uses double")
        total = rows.groupBy("piece", "language").agg(F.sum("uses").alias("uses")).toPandas()
        uses[total.piece.to_numpy(), total.language.to_numpy()] = total.uses.to_numpy()
    p = uses + SMOOTHING * guess[:, None]
    n = np.array([row.n for row in listed], float)
    return Model(vocabulary, languages, p / p.sum(0), n / n.sum())


def _predict_batches(model: Model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = model.vocabulary
        prior = np.log(model.prior)
        known: dict[str, int] = {}
        most = max(1000, CACHE // max(1, len(prior)))
        table = np.zeros((most, len(prior)))
        letters = 0

        def learn(fresh: set[str]) -> None:
            nonlocal table, letters
            if len(known) + len(fresh) > len(table):
                table = np.concatenate([table, np.zeros((len(known) + len(fresh) - len(table), len(prior)))])
            for group in in_groups(fresh, len(prior)):
                first = len(known)
                table[first : first + len(group)] = Lattice(group, ids).log_total(model.p)
                known.update(zip(group, range(first, first + len(group))))
                letters += sum(map(len, group))

        for batch in batches:
            best, score = [], []
            for low in range(0, batch.num_rows, 200):
                texts = [words_of(t) for t in batch.column("text").slice(low, 200).to_pylist()]
                fresh = {w for words in texts for w in words if w not in known}
                if len(known) + len(fresh) > most or letters > CACHE_LETTERS:
                    known.clear()
                    table, letters = table[:most], 0
                    fresh = {w for words in texts for w in words}
                if fresh and model.languages:
                    learn(fresh)
                for words in texts:
                    if not words or not model.languages:
                        best.append("und")
                        score.append(0.0)
                        continue
                    z = table[np.fromiter(map(known.__getitem__, words), np.int64, len(words))].sum(0) + prior
                    k = int(z.argmax())
                    best.append(model.languages[k])
                    score.append(float(1 / np.exp(z - z[k]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return predict


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row; ``score`` is the probability of
    the predicted language among those learned.

    NULL, empty and letterless texts are ``und`` with score 0, as is everything where no
    language could be learned; equal scores go to the first name. Repeated rows are answered
    each; an empty table gives no rows; other columns are not read.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return narrow.mapInArrow(_predict_batches(model), "doc_id bigint, held_out boolean, lang_pred string, score double")
