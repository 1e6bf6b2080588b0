"""Personal data by fixed patterns and a linear-chain conditional random field.

Patterns find the plain forms. The random field adds what they miss: national phone numbers,
spelled or non-ASCII addresses, IPv6 and defanged addresses, card numbers next to other
digits. It reads tokens (runs of digits, runs of letters, single signs) by their word shapes,
by the shapes and words around them, and by how many digits the number they stand in has.

Only tokens within ``CONTEXT`` blank-separated chunks of a digit, an at sign or a spelled dot
may be part of anything; all others are outside. A chain is independent beyond a token that
is known to be outside, so each stretch between such tokens is decoded alone, exactly, many
stretches at once. Long stretches are cut into blocks: the best ways through a block from
every label to every label are found for all blocks together, joined, and then followed.

The model is trained from a small table of labelled texts; :func:`examples` makes one by rule.
"""

from __future__ import annotations

import hashlib
import ipaddress
import random
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Labelled texts a model learns from at most.
MAX_EXAMPLES = 2000
CONTEXT = 2
#: Tokens decoded in one go at most, and tokens of a block.
TOGETHER, BLOCK = 1 << 16, 256

Span = tuple[int, int, int]  # start, kind, end: sorts as results are listed

# -- fixed patterns ------------------------------------------------------------------------

# Runs that lead nowhere match as a whole, so that they are not tried again from each letter.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(?:(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+)|)")
_IP = re.compile(r"([0-9]++)(?:(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)|)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip(".0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and kind; kinds may overlap one another."""
    found: list[Span] = []
    if "@" in text:
        found += [(m.start(), 0, m.end()) for m in _EMAIL.finditer(text) if m[1]]
    if "." in text:
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if m[2] and all(map(_octet, m.groups()))]
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 2 * 19:
            digits = _NOT_DIGITS.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGITS.sub("", m[0])) <= 15]
    return sorted(found)


# -- tokens and their features -------------------------------------------------------------

_MARK = re.compile(r"[0-9@]|\b[Dd][Oo][Tt]\b|[(\[{][Aa][Tt][)\]}]")
_CHUNK = re.compile(r"\S+")
_TOKEN = re.compile(r"[0-9]+|[^\W0-9_]+|[^\w\s]|_")
_HEX = re.compile(r"[0-9a-fA-F]{1,4}")
_LONG_NUMBER = re.compile(r"[0-9]+(?:(?:[ ./-]|[ ]?[()][ ]?)[0-9]+)*")


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Where personal data may stand: marked chunks with ``CONTEXT`` chunks on both sides."""
    marks = _MARK.finditer(text)
    end_of_text = len(text) + 1
    mark = next((m.start() for m in marks), end_of_text)
    if mark == end_of_text:
        return
    before: deque[int] = deque(maxlen=CONTEXT)
    start, end, left = -1, 0, 0
    for chunk in _CHUNK.finditer(text):
        a, b = chunk.span()
        if mark < b:
            while mark < b:
                mark = next((m.start() for m in marks), end_of_text)
            if start < 0:
                start = before[0] if before else a
            end, left = b, CONTEXT
        elif start >= 0:
            if left:
                end, left = b, left - 1
            else:
                yield start, end
                start = -1
                before.clear()
                if mark == end_of_text:
                    return
        before.append(a)
    if start >= 0:
        yield start, end


def _size(n: int) -> str:
    return str(n) if n <= 4 else "5" if n <= 6 else "7" if n <= 8 else "9" if n <= 11 else "12" if n == 12 else "13" if n <= 19 else "20"


def shape(token: str) -> str:
    """Digits by their number, letters by case and length, other signs as they are."""
    if "0" <= token[0] <= "9":
        return "d" + _size(len(token)) + ("" if not 13 <= len(token) <= 19 else "!" if luhn(token) else "?") + ("0" if token[0] == "0" and len(token) > 2 else "")
    if token[0].isalpha():
        case = "x" if token.islower() else "X" if token.isupper() else "Xx" if token.istitle() else "xX"
        return case + ("1" if len(token) == 1 else "3" if len(token) <= 3 else "4") + ("h" if _HEX.fullmatch(token) else "")
    return token if token < "\x7f" else "sign"


_COLONS = re.compile(r"(?:[0-9a-fA-F]{0,4}:){2,7}[0-9a-fA-F]{0,4}[,.;\])]?")
_RUNS = [(re.compile(r"[A-Z]+"), "X"), (re.compile(r"[^\W0-9_]+"), "x"), (re.compile(r"[0-9]{5,}"), "D")]


def chunk_shape(chunk: str) -> str:
    """A chunk with runs of letters as one letter and digits by place, up to some length."""
    if len(chunk) > 40:
        return "long"
    if _COLONS.fullmatch(chunk):
        return f"hex{':' * (1 + ('::' in chunk))}{chunk.count(':')}"
    for pattern, to in _RUNS:
        chunk = pattern.sub(to, chunk)
    return re.sub(r"[0-9]", "d", chunk.replace("Xx", "x").rstrip(",;:!?"))


#: Feature templates: which column of a token's values, from which neighbour.
SHAPE, WORD, CHUNK, RUN = range(4)
SINGLES = [(SHAPE, o) for o in (-3, -2, -1, 0, 1, 2, 3)] + [(WORD, o) for o in (-4, -3, -2, -1, 0, 1, 2)] + [(CHUNK, o) for o in (-1, 0, 1)] + [(RUN, 0)]
PAIRS = [((SHAPE, -1), (SHAPE, 0)), ((SHAPE, 0), (SHAPE, 1)), ((RUN, 0), (SHAPE, 0)), ((RUN, 0), (SHAPE, -1))]


class Tokens:
    """Tokens of one stretch: their places and, as numbers, their values."""

    def __init__(self, text: str, start: int, end: int, number) -> None:
        self.places: list[tuple[int, int]] = []
        rows = []
        runs = [(m.start(), m.end(), m[0]) for m in _LONG_NUMBER.finditer(text, start, end)]
        run = 0
        for chunk in _CHUNK.finditer(text, start, end):
            of_chunk = number(CHUNK, chunk_shape(chunk[0]))
            for m in _TOKEN.finditer(text, *chunk.span()):
                a, b = m.span()
                while run < len(runs) and runs[run][1] <= a:
                    run += 1
                digits = "-"
                if run < len(runs) and runs[run][0] <= a:
                    inside = _NOT_DIGITS.sub("", runs[run][2]) if runs[run][1] - runs[run][0] <= 64 else ""
                    digits = _size(len(inside)) + (("!" if luhn(inside) else "?") if 13 <= len(inside) <= 19 else "") if inside else "many"
                glued = "" if a == chunk.start() else "~"
                word = m[0].lower() if m[0][0].isalpha() else ""
                rows.append((number(SHAPE, glued + shape(m[0])), number(WORD, word), of_chunk, number(RUN, digits)))
                self.places.append((a, b))
        self.values = np.array(rows, np.int32).reshape(-1, 4)


# -- the model ---------------------------------------------------------------------------

LABELS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
NEVER = -1e4


def _allowed() -> np.ndarray:
    """0 where a label may follow another, ``NEVER`` where the inside of a kind has no beginning."""
    table = np.zeros((LABELS, LABELS))
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        table[:, inside] = NEVER
        table[[inside - 1, inside], inside] = 0
    return table


@dataclass
class Model:
    """Values known by column (others are number 0), and the weights of the templates."""

    known: list[dict[str, int]]
    singles: list[np.ndarray]
    pairs: list[np.ndarray]
    follow: np.ndarray

    def number(self, column: int, value: str) -> int:
        return self.known[column].get(value, 0)

    def emissions(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """``[token, label]`` for stretches that begin at ``starts``."""
        return sum(w[at] for w, at in zip([*self.singles, *self.pairs], _feature_numbers(values, starts, [len(k) + 2 for k in self.known])))


def _feature_numbers(values: np.ndarray, starts: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    """The number of each template's value for each token; ``size - 1`` stands beyond the ends."""
    n = len(values)
    lengths = np.diff(np.append(starts, n))
    first, last = np.repeat(starts, lengths), np.repeat(starts + lengths, lengths)
    places = np.arange(n)

    def neighbour(column: int, offset: int) -> np.ndarray:
        at = places + offset
        inside = (at >= first) & (at < last)
        return np.where(inside, values[np.where(inside, at, 0), column], sizes[column] - 1)

    singles = [neighbour(*t) for t in SINGLES]
    return singles + [neighbour(*a) * sizes[b[0]] + neighbour(*b) for a, b in PAIRS]


def _forward(emissions: np.ndarray, begin: np.ndarray, follow: np.ndarray, lengths: np.ndarray, back: np.ndarray | None) -> np.ndarray:
    """Best scores of each label at the end of sequences ``[sequence, place, label]``, longest
    first, from the scores ``begin`` of the labels before them; ways back go to ``back``."""
    score = begin.copy()
    for t in range(emissions.shape[1]):
        live = int(np.searchsorted(-lengths, -t, "left"))
        ways = score[:live, :, None] + follow
        if back is not None:
            back[:live, t] = ways.argmax(1)
        score[:live] = ways.max(1) + emissions[:live, t]
    return score


def _padded(emissions: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    table = np.zeros((len(starts), int(lengths.max()), LABELS))
    row = np.repeat(np.arange(len(starts)), lengths)
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    table[row, place] = emissions[np.repeat(starts, lengths) + place]
    return table


def _by_length(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of sequences, longest first, in groups of about ``TOGETHER`` padded tokens."""
    order = np.argsort(-lengths, kind="stable")
    low = 0
    while low < len(order):
        high = low + max(1, TOGETHER // int(lengths[order[low]]))
        yield order[low:high]
        low = high


def viterbi(emissions: np.ndarray, starts: np.ndarray, follow: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The best labels of stretches that begin at ``starts`` and stand between outside tokens."""
    ends = np.append(starts[1:], len(emissions))
    lows = np.concatenate([np.arange(a, b, block) for a, b in zip(starts, ends)]) if len(starts) else np.zeros(0, np.int64)
    owner = np.searchsorted(starts, lows, "right") - 1
    lengths = np.minimum(lows + block, ends[owner]) - lows
    first = np.append(True, owner[1:] != owner[:-1])
    last = np.append(first[1:], True)
    # The label before and after each block; stretches of one block stand between outsides.
    enter, leave = np.zeros(len(lows), np.int64), np.zeros(len(lows), np.int64)
    parts = np.flatnonzero(~(first & last))
    if len(parts):
        through = np.empty((len(lows), LABELS, LABELS))
        for group in _by_length(lengths[parts]):
            at = parts[group]
            each = np.repeat(at, LABELS)
            begin = np.where(np.eye(LABELS, dtype=bool), 0.0, -np.inf)
            score = _forward(_padded(emissions, lows[each], lengths[each]), np.tile(begin, (len(at), 1)), follow, lengths[each], None)
            through[at] = score.reshape(len(at), LABELS, LABELS)
        score, ways = None, {}
        for k in parts:
            if first[k]:
                score = np.where(np.arange(LABELS) == 0, 0.0, -np.inf)
            sums = score[:, None] + through[k]
            ways[k], score = sums.argmax(0), sums.max(0)
            if last[k]:
                label = int((score + follow[:, 0]).argmax())
                at = k
                while True:
                    leave[at] = label
                    label = int(ways[at][label])
                    if first[at]:
                        break
                    enter[at] = label
                    at -= 1
    labels = np.zeros(len(emissions), np.int8)
    whole = last
    for group in _by_length(lengths):
        size = lengths[group]
        back = np.zeros((len(group), int(size[0]), LABELS), np.int8)
        begin = np.where(np.arange(LABELS) == enter[group][:, None], 0.0, -np.inf)
        score = _forward(_padded(emissions, lows[group], size), begin, follow, size, back)
        # The last block of a stretch ends before an outside token; others end as was found.
        label = np.where(whole[group] & first[group], (score + follow[:, 0]).argmax(1), leave[group])
        for t in range(int(size[0]) - 1, -1, -1):
            live = np.flatnonzero(size > t)
            labels[lows[group][live] + t] = label[live]
            label[live] = back[live, t, label[live]]
    return labels


# -- training ------------------------------------------------------------------------------


def _gold(places: Sequence[tuple[int, int]], spans: Sequence[tuple[str, int, int]]) -> list[int]:
    labels = []
    for a, b in places:
        held = next(((k, s) for k, s, e in spans if s <= a and b <= e), None)
        labels.append(0 if held is None else 1 + 2 * KINDS.index(held[0]) + (a > held[1]))
    return labels


def train(rows: Sequence[tuple[str, Sequence[tuple[str, int, int]]]], steps: int = 120, l2: float = 0.02, rate: float = 0.15) -> Model:
    """Weights of greatest likelihood, less ``l2`` times their squares, by gradient steps."""
    known: list[dict[str, int]] = [{}, {}, {}, {}]

    def number(column: int, value: str) -> int:
        return known[column].setdefault(value, len(known[column]) + 1)

    values, gold, starts, n = [], [], [], 0
    for text, spans in rows:
        for a, b in stretches(text):
            tokens = Tokens(text, a, b, number)
            if tokens.places:
                values.append(tokens.values)
                gold += _gold(tokens.places, spans)
                starts.append(n)
                n += len(tokens.places)
    follow = _allowed()
    sizes = [len(k) + 2 for k in known]
    shapes = [sizes[c] for c, _ in SINGLES] + [sizes[a[0]] * sizes[b[0]] for a, b in PAIRS]
    if not n:
        tables = [np.zeros((s, LABELS)) for s in shapes]
        return Model(known, tables[: len(SINGLES)], tables[len(SINGLES) :], follow)
    x, y, first = np.concatenate(values), np.array(gold), np.array(starts)
    # Words seen once say nothing about others: they count as unknown.
    rare = np.bincount(x[:, WORD], minlength=sizes[WORD]) < 3
    x[:, WORD] = np.where(rare[x[:, WORD]], 0, x[:, WORD])
    offsets = np.cumsum([0, *shapes])
    features = np.stack(_feature_numbers(x, first, sizes), 1) + offsets[:-1]
    used, compact = np.unique(features, return_inverse=True)
    compact = compact.reshape(features.shape)
    order = np.argsort(compact.ravel(), kind="stable")
    bounds = np.searchsorted(compact.ravel()[order], np.arange(len(used)))
    token_of = order // features.shape[1]

    lengths = np.diff(np.append(first, n))
    by_length = np.argsort(-lengths, kind="stable")
    lengths, lows = lengths[by_length], first[by_length]
    row = np.repeat(np.arange(len(lows)), lengths)
    place = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    token = np.repeat(lows, lengths) + place
    longest = int(lengths[0])
    live = [int(np.searchsorted(-lengths, -t, "left")) for t in range(longest + 1)]
    truth = np.zeros((n, LABELS))
    truth[np.arange(n), y] = 1
    pairs = np.zeros((LABELS, LABELS))
    before = np.where(np.isin(np.arange(n), first), 0, np.roll(y, 1))
    np.add.at(pairs, (before, y), 1)
    np.add.at(pairs, (y[np.append(first[1:], n) - 1], 0), 1)

    w, moves = np.zeros((len(used), LABELS)), np.zeros((LABELS, LABELS))
    mean = [np.zeros_like(w), np.zeros_like(moves)]
    square = [np.zeros_like(w), np.zeros_like(moves)]
    for step in range(1, steps + 1):
        table = np.zeros((len(lows), longest, LABELS))
        table[row, place] = w[compact].sum(1)[token]
        step_moves = np.exp(moves) * (follow == 0)
        # Sums over all labellings, each place scaled to one; a sequence's scale cancels out.
        e = np.exp(table - table.max(2, keepdims=True))
        alpha, beta = np.zeros((len(lows), longest + 1, LABELS)), np.zeros((len(lows), longest, LABELS))
        alpha[:, 0, 0] = 1
        for t in range(longest):
            k = live[t]
            a = (alpha[:k, t] @ step_moves) * e[:k, t]
            alpha[:k, t + 1] = a / a.sum(1, keepdims=True)
        expected = np.zeros((LABELS, LABELS))
        for t in range(longest - 1, -1, -1):
            k, more = live[t], live[t + 1] if t + 1 < longest else 0
            beta[:k, t] = step_moves[:, 0]
            if more:
                beta[:more, t] = (beta[:more, t + 1] * e[:more, t + 1]) @ step_moves.T
            beta[:k, t] /= beta[:k, t].sum(1, keepdims=True)
            joint = alpha[:k, t, :, None] * step_moves * (e[:k, t] * beta[:k, t])[:, None, :]
            expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            ends = slice(more, k)
            out = alpha[ends, t + 1] * step_moves[:, 0]
            expected[:, 0] += (out / out.sum(1, keepdims=True)).sum(0)
        share = alpha[:, 1:] * beta
        share = share / np.maximum(share.sum(2, keepdims=True), 1e-300)
        marginal = np.empty((n, LABELS))
        marginal[token] = share[row, place]
        slopes = [np.add.reduceat((marginal - truth)[token_of], bounds) + l2 * w, expected - pairs + l2 * moves]
        for i, slope in enumerate(slopes):
            mean[i] = 0.9 * mean[i] + 0.1 * slope
            square[i] = 0.99 * square[i] + 0.01 * slope**2
            change = rate * (1 - step / (steps + 1)) * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-6)
            if i:
                moves = moves - change
            else:
                w = w - change
    full = np.zeros((offsets[-1], LABELS))
    full[used] = w
    tables = [full[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    known[WORD] = {word: number for word, number in known[WORD].items() if not rare[number]}
    # Numbers keep their places, so the size of the column has to stay.
    model = Model(known, tables[: len(SINGLES)], tables[len(SINGLES) :], moves + follow)
    return _renumbered(model, sizes)


def _renumbered(model: Model, sizes: Sequence[int]) -> Model:
    """The model with its remaining words numbered without gaps."""
    kept = [0, *model.known[WORD].values(), sizes[WORD] - 1]
    known = list(model.known)
    known[WORD] = {word: i for i, word in enumerate(model.known[WORD], 1)}
    singles = [w[kept] if column == WORD else w for (column, _), w in zip(SINGLES, model.singles)]
    return Model(known, singles, model.pairs, model.follow)


# -- finding -------------------------------------------------------------------------------

_AT, _DOT = re.compile(r"\s*(?:@|[(\[{]\s*at\s*[)\]}]|\bat\b)\s*", re.I), re.compile(r"\s*(?:\.|[(\[{]\s*(?:dot|\.)\s*[)\]}]|\bdot\b)\s*", re.I)
_PLAIN_EMAIL = re.compile(r"[^\s@]+@[^\s@.]+(?:\.[^\s@.]+)+")


def holds(kind: int, found: str) -> bool:
    """Whether a span can be what its label says, whatever stands around it."""
    digits = _NOT_DIGITS.sub("", found)
    if kind == 0:
        return _PLAIN_EMAIL.fullmatch(_DOT.sub(".", _AT.sub("@", found, count=1))) is not None
    if kind == 1:
        try:
            ipaddress.ip_address(re.sub(r"[\[({]\s*([.:])\s*[\])}]", r"\1", found))
        except ValueError:
            return False
        return True
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def added_spans(texts: Sequence[str], base: Sequence[Sequence[Span]], model: Model) -> list[list[Span]]:
    """What the model finds beside the base spans, for each text."""
    found: list[list[Span]] = [[] for _ in texts]
    held: list[tuple[int, Tokens]] = []
    size = 0
    begins = [[a for a, _, _ in spans] for spans in base]
    reach = [list(accumulate((b for _, _, b in spans), max)) for spans in base]

    def taken(i: int, start: int, end: int) -> bool:
        before = bisect_left(begins[i], end)
        return before > 0 and reach[i][before - 1] > start

    def decode() -> None:
        starts = np.cumsum([0, *(len(t.places) for _, t in held)])[:-1]
        values = np.concatenate([t.values for _, t in held])
        labels = viterbi(model.emissions(values, starts), starts, model.follow)
        for (i, tokens), low in zip(held, starts):
            here = labels[low : low + len(tokens.places)]
            for first in np.flatnonzero(here % 2 == 1):
                last = first
                while last + 1 < len(here) and here[last + 1] == here[first] + 1:
                    last += 1
                start, end, kind = tokens.places[first][0], tokens.places[last][1], int(here[first] - 1) // 2
                if not taken(i, start, end) and holds(kind, texts[i][start:end]):
                    found[i].append((start, kind, end))

    for i, text in enumerate(texts):
        for a, b in stretches(text):
            tokens = Tokens(text, a, b, model.number)
            if tokens.places:
                held.append((i, tokens))
                size += len(tokens.places)
            if size >= TOGETHER:
                decode()
                held, size = [], 0
    if held:
        decode()
    return found


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
FOUND = "base array<struct<kind: string, start: bigint, end: bigint>>, spans array<struct<kind: string, start: bigint, end: bigint>>"


def _listed(spans: Sequence[Span]) -> list[dict]:
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]


def _find_batches(model: Model):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            every = [sorted([*b, *more]) for b, more in zip(base, added_spans(texts, base, model))]
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array([_listed(b) for b in base], SPANS), pa.array([_listed(s) for s in every], SPANS)],
                [*kept, "base", "spans"],
            )

    return find


def fit(labelled: DataFrame, max_examples: int = MAX_EXAMPLES) -> Model:
    """A model from ``(text, spans)``; ``spans`` are ``(kind, start, end)``.

    At most ``max_examples`` rows are read, chosen by a hash of the text. Without rows the
    model finds nothing. Rows without text, and spans of other kinds, are left out.
    """
    chosen = labelled.where("text IS NOT NULL").orderBy(F.xxhash64("text"), "text").limit(max_examples).collect()
    rows = [(r.text, sorted((s.kind, s.start, s.end) for s in r.spans or [] if s is not None and s.kind in KINDS)) for r in chosen]
    return train(rows)


def find(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, base, spans)`` of every row: the spans of the fixed patterns, and those with
    the model's own, by start and kind. A span is ``(kind, start, end)`` in code points.

    The model's spans never touch a base span. NULL reads as empty; empty texts have no spans;
    repeated rows are answered each; an empty table gives no rows; other columns are not read.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return narrow.mapInArrow(_find_batches(model), f"doc_id bigint, {FOUND}")


def report(found: DataFrame) -> DataFrame:
    """Base spans by kind and a checksum of them, and all spans as text."""

    def text(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def redacted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; overlaps become one."""
    schema = docs.schema

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            plain = [t or "" for t in texts]
            base = [base_spans(t) for t in plain]
            for i, more in enumerate(added_spans(plain, base, model)):
                parts, last = [], 0
                for a, kind, b in sorted([*base[i], *more]):
                    if a >= last:
                        parts += [plain[i][last:a], f"[{KINDS[kind]}]"]
                    last = max(last, b)
                if parts:
                    texts[i] = "".join([*parts, plain[i][last:]])
            columns = [pa.array(texts, f.type) if f.name == "text" else c for f, c in zip(batch.schema, batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(replace, schema)


# -- the labelled table --------------------------------------------------------------------

# What stands around personal data, and around numbers that are none.
TEMPLATES = [
    "{w} {w} {phone} {w} {w}.", "Call {phone} or write to {email}.", "Tel.: {phone}, Fax: {phone}", "phone {phone}", "Telefon {phone} {w}",
    "Tél. {phone} {w} {w}", "teléfono: {phone}", "my number is {phone}, {w}", "{W} {w}, mobile {phone}.", "({phone})", "contact: {phone} / {email}",
    "{w} {w} {w} {email} {w} {w}", "e-mail: {email}", "<{email}>", "Mail an {email}, {w}.", "correo {email} {w}", "{W} {w} {w}.{email} {w}.",
    "reach me: {email} or {email}", "{w} {ip} {w} {w}", "from {ip} port {n}", "server {ip}:{n} {w}", "{w} from {ip} {w}", "IP {ip}, {w}", "host [{ip}] {w} {w}",
    "{w} {card} {w} {w}", "card {card} exp {month}/{yy}", "Kreditkarte: {card}.", "{n} {card} {w}", "{w} {n} {card} {w}", "{n} {n} {card} {w}", "visa {card} {card}", "tarjeta {card} {w} {phone}",
    "{w} {w} {number} {w} {w} {w}", "order {number} {w}", "{W} {w} {date} {w} {w}", "on {date} at {time}, {w}", "{w} costs {price} {w}", "version {version} {w}",
    "{w} {year} {w} {w} {year}-{year}.", "ISBN {isbn} {w}", "{w} {number} {number} {w}", "token = \"{hex}\" {w}", "key: {hex}", "{W}{sign} {w}{sign} {w}{sign} {n}",
    "Copyright (c) {year} {W} {W}", "page {n} of {n}, {w}", "{w} {n}.{n}.{n} {w}", "{n}, {n}, {n}, {n} {w}", "@{w} {w} {w}", "{w} at {w} dot {w}, {w}", "{w} @ {price} {w}",
    "{w} {time} {w} {n}:{n}:{n}", "{w} the dot {w} {w}", "room {n}-{n} {w}", "{n} {w} {n} {w} {number}", "{w} (at) {w} {w}", "https://{w}.com/{n}/{w}?id={number}", "sha {hex}{hex}",
    "{w} {decimal} {w} {decimal},{decimal}", "§ {n} ({n}) {w}", "{bad_card} {w} {w}", "{w} {bad_card} {bad_card}", "{n}x{n} {w} {n}%", "id {hex}-{n}-{n}-{hex}",
]
SYLLABLES = "an ber ción de el er est ge heit in la ment ne on ou qu re sch th tion un ver ß é ñ ü".split()
REPEATS = 10


def _digits(rng: random.Random, n: int) -> str:
    return str(rng.randrange(1, 10)) + "".join(str(rng.randrange(10)) for _ in range(n - 1))


def _with_check(digits: str) -> str:
    return next(digits + str(c) for c in range(10) if luhn(digits + str(c)))


def _values(rng: random.Random):
    def n(k: int) -> str:
        return _digits(rng, k)

    def word() -> str:
        return "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4)))

    def name() -> str:
        return rng.choice([word(), word() + "." + word(), word() + n(2), "." + n(2), word().title()])

    def host() -> str:
        return ".".join([rng.choice([word(), "mail", "mail" + n(1), word() + "-" + word()]), rng.choice(["example.com", "com", "org", "de", "co.uk", "net"])])

    def email() -> str:
        at, dot = rng.choice([("@", "."), ("@", "."), (" (at) ", "."), (" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "(dot)")])
        local = name().strip(".") if at != "@" else name()
        return local.replace(".", dot if at != "@" else ".") + at + host().replace(".", dot)

    def phone() -> str:
        plus = f"+{rng.choice(['1', '33', '34', '44', '49'])}"
        return rng.choice(
            [f"{plus} ({n(3)}) {n(3)}-{n(4)}", f"({n(3)}) {n(3)}-{n(4)}", f"{n(3)}-{n(3)}-{n(4)}", f"{n(3)}.{n(3)}.{n(4)}", f"0{n(2)} {n(7)}", f"0{n(3)} {n(6)}",
             f"00{n(2)} {n(3)} {n(7)}", f"0{n(2)}/{n(7)}", f"{plus} {n(2)} {n(3)} {n(4)}", f"{plus}-{n(3)}-{n(3)}-{n(4)}", f"0{n(1)} {n(2)} {n(2)} {n(2)} {n(2)}"]
        )

    def ip() -> str:
        four = [str(rng.randrange(256)) for _ in range(4)]
        six = [f"{rng.randrange(1 << rng.choice([8, 16])):x}" for _ in range(8)]
        cut = rng.randrange(1, 5)
        return rng.choice([".".join(four), "[.]".join(four), ":".join(six), "::".join([":".join(six[:cut]), ":".join(six[cut : cut + 2])]), "fe80::" + ":".join(six[:4])])

    def card() -> str:
        digits = _with_check(n(15))
        sign = rng.choice(["", "", " ", "-", "."])
        return sign.join(digits[i : i + 4] for i in range(0, 16, 4))

    def bad_card() -> str:
        digits = n(16)
        return digits if not luhn(digits) else digits[:-1] + str((int(digits[-1]) + 1) % 10)

    return {
        "w": word, "W": lambda: word().title(), "phone": phone, "email": email, "ip": ip, "card": card, "bad_card": bad_card,
        "n": lambda: n(rng.randrange(1, 5)), "number": lambda: n(rng.randrange(5, 13)), "year": lambda: str(rng.randrange(1950, 2030)),
        "month": lambda: f"{rng.randrange(1, 13):02d}", "yy": lambda: str(rng.randrange(24, 35)), "price": lambda: f"{rng.choice(['$', '€', ''])}{n(rng.randrange(1, 4))}.{rng.randrange(100):02d}",
        "date": lambda: rng.choice(["{0}-{1:02d}-{2:02d}", "{2:02d}.{1:02d}.{0}", "{1:02d}/{2:02d}/{0}"]).format(rng.randrange(1950, 2030), rng.randrange(1, 13), rng.randrange(1, 29)),
        "time": lambda: f"{rng.randrange(24):02d}:{rng.randrange(60):02d}", "version": lambda: f"{n(1)}.{rng.randrange(30)}.{rng.randrange(30)}",
        "isbn": lambda: f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}", "hex": lambda: f"{rng.getrandbits(64):016x}", "sign": lambda: rng.choice(["###", "%%%", "&&&", "***"]),
        "decimal": lambda: f"{rng.randrange(1000)}.{n(rng.randrange(1, 7))}",
    }


def labelled_texts(repeats: int = REPEATS, seed: int = 11) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """``(text, spans)`` for each template, ``repeats`` times with other values."""
    rng = random.Random(seed)
    values = _values(rng)
    rows = []
    for template in TEMPLATES * repeats:
        text, spans, last = "", [], 0
        for m in re.finditer(r"\{(\w+)\}", template):
            text += template[last : m.start()]
            value = values[m[1]]()
            if m[1] in KINDS:
                spans.append((m[1], len(text), len(text) + len(value)))
            text, last = text + value, m.end()
        rows.append((text + template[last:], spans))
    return rows


def examples(spark: SparkSession) -> DataFrame:
    """The labelled table that :func:`labelled_texts` makes."""
    return spark.createDataFrame(labelled_texts(), "text string, spans array<struct<kind: string, start: bigint, end: bigint>>")


def digest(spans: Sequence[Span]) -> str:
    """The checksum :func:`report` gives for some spans."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()
