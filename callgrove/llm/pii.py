"""Personal data by a semi-Markov conditional random field over whole spans.

Base patterns find e-mail addresses, IP addresses, card and phone numbers; what they find
always stays. The field adds spans that follow other forms. A text is cut into atoms (runs
of digits or letters, white space, single characters). A segmentation gives each stretch of
up to ``LONGEST`` atoms a kind or leaves single atoms outside; its weight is the sum of the
features of whole segments (numbers of digits, groups, separators, checksum, borders) and of
the kinds that follow each other. Dynamic programming over segments finds the best one, so
borders and kinds are chosen together.

A segment holds a digit or an ``@``. So only stretches around these are decoded; outside is
the only choice elsewhere, and the best segmentation of a text is the union of those of its
stretches. Segments that could not pay for their transitions are left out before decoding,
which changes no result.

The field is trained by gradient ascent on the likelihood of a bounded sample of stretches.
Their labels are the base patterns' spans; stretches with a span are also shown in other
forms (without country code, other separators), with the span at its new place.

Nulls: a null text counts as empty and has no spans; a null ``doc_id`` is kept. Texts are
read whole at any length, in time linear to it. Repeated rows have equal results. An empty
table gives no rows, and without training spans only base spans are found. Other columns
are ignored.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrove.llm.common import code_on_workers, in_batches, table

#: Contract: kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

#: Bounds of the training sample: texts (expected number), stretches, atoms of a stretch.
SAMPLE_TEXTS, SAMPLE_STRETCHES, SAMPLE_ATOMS = 12_000, 2000, 48
#: Longest segment in atoms; white space that may lie inside a stretch.
LONGEST, GAP = 24, 4

# ------------------------------------------------------------------ base patterns

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Runs of digits are taken whole: no address begins inside one whose parts are too few.
_IP = re.compile(r"[0-9]++((?:\.[0-9]+){3})?")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the base patterns' matches that pass their checks, in order."""
    found = [(0, *span) for span in _emails(text)]
    for match in _IP.finditer(text):
        if match[1] and all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in match[0].split(".")):
            found.append((1, *match.span()))
    for match in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", match[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *match.span()))
    for match in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", match[0])) <= 15:
            found.append((3, *match.span()))
    return found


# ------------------------------------------------------------------ stretches and atoms

_SEED = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_ATOM = re.compile(r"[0-9]+|[A-Za-z]+|[^\W\dA-Za-z_]+|\s+|.", re.DOTALL)
#: Classes of atoms: white space, digits, letters, marks of their own, others, no atom.
_MARKS = {"@": 3, ".": 4, "-": 5, "+": 6, "(": 7, ")": 8}
_BLANK, _DIGITS, _LETTERS, _OTHER, _NONE, CLASSES = 0, 1, 2, 9, 10, 11


def stretches(text: str) -> list[tuple[int, int]]:
    """Words with a digit or an ``@``; those with at most ``GAP`` characters between are one."""
    found: list[list[int]] = []
    seed = _SEED.search(text)
    while seed:
        start = seed.start()
        limit = found[-1][1] if found else 0
        while start > limit and not text[start - 1].isspace():
            start -= 1
        blank = _SPACE.search(text, seed.end())
        end = blank.start() if blank else len(text)
        if found and start - limit <= GAP:
            found[-1][1] = end
        else:
            found.append([start, end])
        seed = _SEED.search(text, end)
    return [(a, b) for a, b in found]


@dataclass
class Atoms:
    """Atoms of many stretches one after the other; ``last`` is the end of each one's own stretch."""

    start: np.ndarray
    end: np.ndarray
    kind: np.ndarray
    first: np.ndarray
    last: np.ndarray
    values: list[str] = field(repr=False)


def atoms_of(parts: list[str]) -> Atoms:
    start, end, kind, first, last, values = [], [], [], [], [], []
    for part in parts:
        begin = len(values)
        for match in _ATOM.finditer(part):
            value = match[0]
            start.append(match.start())
            end.append(match.end())
            values.append(value)
            head = value[0]
            if "0" <= head <= "9":
                kind.append(_DIGITS)
            elif head.isalpha():
                kind.append(_LETTERS)
            elif head.isspace():
                kind.append(_BLANK)
            else:
                kind.append(_MARKS.get(head, _OTHER))
        size = len(values) - begin
        first += [begin] * size
        last += [begin + size] * size
    return Atoms(*(np.array(v, np.int64) for v in (start, end, kind, first, last)), values)


# ------------------------------------------------------------------ features of segments

_COUNT, _GROUPS = 32, 8
#: Weight of a feature value that no training span has: it speaks against a span.
PRIOR = -1.0
#: Number of values of each feature, in the order of :func:`features`.
SIZES = (
    _COUNT, LONGEST + 1, CLASSES * CLASSES, CLASSES * CLASSES, _GROUPS * 4, _GROUPS * _GROUPS,
    _GROUPS * 16, 2 * 16, _COUNT, 16, _GROUPS, 3,
)


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values)])


def features(atoms: Atoms, begin: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Value of every feature for segments of 1 to ``LONGEST`` atoms from begin to stop.

    The first result has the shape (features, atoms, lengths), the second tells which
    segments may stand: inside their stretch, no white space at an end, a digit or an ``@``.
    """
    after = min(stop + LONGEST, len(atoms.kind))
    kind = atoms.kind[begin:after]
    size = atoms.end[begin:after] - atoms.start[begin:after]
    n = stop - begin
    low = np.arange(n)[:, None]
    high = np.minimum(low + np.arange(1, LONGEST + 1), len(kind))

    def count(values: np.ndarray, top: int) -> np.ndarray:
        sums = _sums(values)
        return np.minimum(sums[high] - sums[low], top - 1)

    digit = kind == _DIGITS
    digits = np.where(digit, size, 0)
    total = count(digits, 1 << 40)
    marks = {mark: count(kind == code, _GROUPS) for mark, code in _MARKS.items()}
    blanks = count(kind == _BLANK, _GROUPS)
    letters, groups = count(kind == _LETTERS, _GROUPS), count(digit, 16)
    others = count(kind == _OTHER, _GROUPS)

    values = atoms.values[begin:after]
    over = [d and not (len(v.lstrip("0")) <= 3 and int(v[-4:]) <= 255) for v, d in zip(values, digit, strict=True)]
    octets = count(np.array(over, bool), 2) == 0
    widest = np.maximum.accumulate(digits[np.minimum(low + np.arange(LONGEST), len(kind) - 1)], axis=1)

    # Luhn sums from the right: digits at an odd distance from the last one count double.
    flat = np.frombuffer("".join(v for v, d in zip(values, digit, strict=True) if d).encode(), np.uint8) - 48
    flat = flat.astype(np.int64)
    double = 2 * flat - 9 * (flat > 4)
    even = np.arange(len(flat)) % 2 == 0
    plain = [_sums(np.where(even, flat, double)), _sums(np.where(even, double, flat))]
    ends = _sums(digits)
    a, b = ends[low], ends[high]
    parity = (b - 1) % 2
    checks = np.where(parity == 0, plain[0][b] - plain[0][a], plain[1][b] - plain[1][a]) % 10 == 0
    number = (total >= 13) & (total <= 19) & (letters == 0)

    before = np.where(low[:, 0] + begin > atoms.first[begin:stop], atoms.kind[begin - 1 + low[:, 0]], _NONE)
    last = atoms.last[begin:stop, None] - begin
    inside = low + np.arange(1, LONGEST + 1) <= last
    follows = np.where(high < last, kind[np.minimum(high, len(kind) - 1)], _NONE)
    first_kind, last_kind = kind[:n, None], kind[high - 1]
    found = np.stack(
        [
            np.minimum(total, _COUNT - 1),
            np.broadcast_to(np.arange(1, LONGEST + 1), total.shape),
            first_kind * CLASSES + before[:, None] + 0 * high,
            last_kind * CLASSES + follows,
            marks["."] * 4 + np.minimum(marks["@"], 3),
            blanks * _GROUPS + marks["-"],
            letters * 16 + groups,
            octets * 16 + groups,
            np.minimum(widest, _COUNT - 1),
            np.minimum(marks["("] + marks[")"], 3) * 4 + np.minimum(marks["+"], 3),
            others,
            np.where(number, 1 + checks, 0),
        ]
    )
    possible = inside & (first_kind != _BLANK) & (last_kind != _BLANK) & ((groups > 0) | (marks["@"] > 0))
    return found, possible


# ------------------------------------------------------------------ the field


@dataclass
class Model:
    """Weights of feature values by kind, and of transitions; outside to outside weighs 0."""

    weights: list[np.ndarray]
    enter: np.ndarray
    leave: np.ndarray
    between: np.ndarray

    @classmethod
    def empty(cls) -> Model:
        k = len(KINDS)
        return cls([np.full((n, k), PRIOR) for n in SIZES], np.zeros(k), np.zeros(k), np.full((k, k), PRIOR))

    def scores(self, found: np.ndarray) -> np.ndarray:
        return sum(w[values] for w, values in zip(self.weights, found, strict=True))

    def parameters(self) -> list[np.ndarray]:
        return [*self.weights, self.enter, self.leave, self.between]


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(values - top).sum(axis=axis)) + np.squeeze(top, axis)


def expectations(model: Model, scores: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Log partition sums, and expected segments and transitions, of stretches side by side.

    ``scores`` has the shape (stretches, atoms, lengths, kinds), -inf where no segment may be.
    """
    count, steps, longest, k = scores.shape
    outside = np.full((count, steps + 1), -np.inf)
    ended = np.full((count, steps + 1, k), -np.inf)
    entered = np.full((count, steps + 1, k), -np.inf)
    outside[:, 0] = 0
    for at in range(steps + 1):
        if at:
            spans = [entered[:, at - d] + scores[:, at - d, d - 1] for d in range(1, min(longest, at) + 1)]
            ended[:, at] = _log_sum(np.stack(spans), 0)
            outside[:, at] = np.logaddexp(outside[:, at - 1], _log_sum(ended[:, at - 1] + model.leave, 1))
        entered[:, at] = np.logaddexp(
            outside[:, at, None] + model.enter, _log_sum(ended[:, at, :, None] + model.between, 1)
        )
    rows = np.arange(count)
    log_z = np.logaddexp(outside[rows, sizes], _log_sum(ended[rows, sizes] + model.leave, 1))

    rest = np.full((count, steps + 2), -np.inf)
    rest_in = np.full((count, steps + longest + 1, k), -np.inf)
    begun = np.full((count, steps + 1, k), -np.inf)
    for at in range(steps, -1, -1):
        if at < steps:
            reach = min(longest, steps - at)
            begun[:, at] = _log_sum(scores[:, at, :reach] + rest_in[:, at + 1 : at + reach + 1], 1)
        here = np.logaddexp(rest[:, at + 1], _log_sum(model.enter + begun[:, at], 1))
        inner = np.logaddexp(
            model.leave + rest[:, at + 1, None], _log_sum(model.between + begun[:, at, None, :], 2)
        )
        last = sizes == at
        rest[:, at] = np.where(last, 0, here)
        rest_in[:, at] = np.where(last[:, None], model.leave, inner)
    z = log_z[:, None, None]
    ahead = np.stack([rest_in[:, d : d + steps] for d in range(1, longest + 1)], axis=2)
    spans = np.exp(entered[:, :steps, None] + scores + ahead - z[..., None])
    enter = np.exp(outside[:, :, None] + model.enter + begun - z).sum(axis=(0, 1))
    leave = np.exp(ended + model.leave + rest[:, 1:, None] - z).sum(axis=(0, 1))
    leave += np.exp(ended[rows, sizes] + model.leave - log_z[:, None]).sum(axis=0)
    between = np.exp(ended[..., None] + model.between + begun[:, :, None, :] - z[..., None]).sum(axis=(0, 1))
    return log_z, spans, enter, leave, between


Example = tuple[str, list[Span]]


def _on_atoms(atoms: Atoms, spans: list[Span]) -> list[Span] | None:
    """Spans as (kind, first atom, atoms); None where one does not end on atoms or two overlap."""
    starts = {int(s): i for i, s in enumerate(atoms.start)}
    ends = {int(e): i for i, e in enumerate(atoms.end)}
    found, free = [], 0
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        if start not in starts or end not in ends or start < free:
            return None
        found.append((kind, starts[start], ends[end] - starts[start] + 1))
        free = end
    return found if all(length <= LONGEST for _, _, length in found) else None


def other_forms(text: str, spans: list[Span]) -> list[Example]:
    """The stretch with its one number in forms that the base patterns do not know."""
    if len(spans) != 1 or spans[0][0] not in (2, 3):
        return []
    kind, start, end = spans[0]
    number = text[start:end]
    if kind == 2:
        digits = _NOT_DIGIT.sub("", number)
        forms = [mark.join(re.findall(".{1,4}", digits)) for mark in "./"]
    else:
        local = number.partition(" ")[2]
        forms = ["00" + number[1:], number.replace(" ", "/")]
        forms += [local, local.replace("-", "."), local.replace("-", " ")] if local else []
    out = []
    for form in forms:
        part = text[:start] + form + text[end:]
        if len(_NOT_DIGIT.sub("", form)) >= 9:
            out.append((part, [(kind, start, start + len(form))]))
    return out


def examples_of(parts: list[str]) -> list[Example]:
    """Training stretches with their spans, other forms included."""
    found = []
    for part in parts:
        spans = base_spans(part)
        found.append((part, spans))
        found += other_forms(part, spans)
    return found


class _Batch:
    """Training stretches side by side: their possible segments, features and true segments."""

    def __init__(self, chosen: list[tuple[Atoms, list[Span]]]):
        k = len(KINDS)
        self.sizes = np.array([len(atoms.kind) for atoms, _ in chosen])
        self.shape = (len(chosen), int(self.sizes.max()), LONGEST)
        found = np.zeros((len(SIZES), *self.shape), np.int16)
        possible = np.zeros(self.shape, bool)
        seen = np.zeros((*self.shape, k))
        self.enter, self.leave, self.between = np.zeros(k), np.zeros(k), np.zeros((k, k))
        for i, (atoms, placed) in enumerate(chosen):
            found[:, i, : self.sizes[i]], possible[i, : self.sizes[i]] = features(atoms, 0, len(atoms.kind))
            for before, (kind, first, length) in zip([None, *placed], placed, strict=False):
                seen[i, first, length - 1, kind] = 1
                if before is not None and before[1] + before[2] == first:
                    self.between[before[0], kind] += 1
                    self.leave[before[0]] -= 1
                else:
                    self.enter[kind] += 1
                self.leave[kind] += 1
        self.possible = np.nonzero(possible)
        self.found, self.seen = found[(slice(None), *self.possible)], seen[self.possible]

    def gradient(self, model: Model) -> list[np.ndarray]:
        """Seen minus expected features and transitions, in the order of the model's parameters."""
        scores = np.full((*self.shape, len(KINDS)), -np.inf)
        scores[self.possible] = model.scores(self.found)
        _, spans, enter, leave, between = expectations(model, scores, self.sizes)
        surplus = self.seen - spans[self.possible]
        steps = [
            np.stack([np.bincount(values, surplus[:, k], n) for k in range(len(KINDS))], axis=1)
            for values, n in zip(self.found, SIZES, strict=True)
        ]
        return [*steps, self.enter - enter, self.leave - leave, self.between - between]


def fit_examples(examples: list[Example], epochs: int = 15, batch: int = 128, rate: float = 0.3) -> Model:
    """AdaGrad ascent of the log likelihood under a normal prior around ``PRIOR``."""
    model = Model.empty()
    known = []
    for text, spans in examples:
        atoms = atoms_of([text])
        placed = _on_atoms(atoms, spans)
        if placed is not None and 0 < len(atoms.kind) <= SAMPLE_ATOMS:
            known.append((atoms, placed))
    if not any(placed for _, placed in known):
        return model
    # Stretches of like length side by side, batches in a fixed random order.
    known.sort(key=lambda e: len(e[0].kind))
    batches = [_Batch(known[i : i + batch]) for i in range(0, len(known), batch)]
    squares = [np.full(p.shape, 1e-2) for p in model.parameters()]
    random = np.random.default_rng(13)
    for _ in range(epochs):
        for number in random.permutation(len(batches)):
            for value, step, square in zip(
                model.parameters(), batches[number].gradient(model), squares, strict=True
            ):
                step = step - 2e-2 * (value - PRIOR * (value.ndim == 2))
                square += step * step
                value += rate * step / np.sqrt(square)
    return model


Candidates = dict[int, list[tuple[int, int, float]]]


def candidates(model: Model, atoms: Atoms) -> dict[int, Candidates]:
    """Segments that may pay, by the first atom of their stretch and by their end.

    A segment whose score stays below what it loses on its borders at best is worse than
    the same atoms outside.
    """
    gain_in = np.maximum(model.enter, (model.between - model.leave[:, None]).max(axis=0))
    gain_out = np.maximum(model.leave, (model.between - model.enter[None, :]).max(axis=1))
    found: dict[int, Candidates] = {}
    for begin in range(0, len(atoms.kind), 4096):
        stop = min(begin + 4096, len(atoms.kind))
        values, possible = features(atoms, begin, stop)
        at, lengths = np.nonzero(possible)
        scores = model.scores(values[:, at, lengths])
        pair, kinds = np.nonzero(scores + gain_in + gain_out > 0)
        first = begin + at[pair]
        columns = atoms.first[first], first + lengths[pair] + 1, first, kinds, scores[pair, kinds]
        for stretch, end, start, kind, score in zip(*(c.tolist() for c in columns), strict=True):
            found.setdefault(stretch, {}).setdefault(end, []).append((start, kind, score))
    return found


def best_segments(model: Model, found: Candidates, first: int, last: int) -> list[Span]:
    """Best segmentation of the atoms first to last: (kind, first atom, end atom) of its segments.

    Of equal segmentations the one with more outside wins.
    """
    enter, leave, between = model.enter.tolist(), model.leave.tolist(), model.between.tolist()
    # What ends outside gets better only behind a segment: (atoms from which it holds,
    # score, last segment). Segments link to the one before them.
    outside: list[tuple[int, float, tuple | None]] = [(first, 0.0, None)]
    ended: dict[int, dict[int, tuple[float, tuple]]] = {}
    for end in sorted(found):
        best: dict[int, tuple[float, tuple]] = {}
        for begin, kind, score in found[end]:
            _, value, before = outside[bisect_right(outside, begin, key=lambda o: o[0]) - 1]
            value += enter[kind]
            for total, segment in ended.get(begin, {}).values():
                if total + between[segment[0]][kind] > value:
                    value, before = total + between[segment[0]][kind], segment
            if kind not in best or value + score > best[kind][0]:
                best[kind] = value + score, (kind, begin, end, before)
        ended[end] = best
        for total, segment in best.values():
            total += leave[segment[0]]
            if total > outside[-1][1]:
                # The atom behind the segment is outside, or else the stretch is at its end.
                outside.append((min(end + 1, last), total, segment))
    path, segment = [], outside[-1][2]
    while segment is not None:
        path.append(segment[:3])
        segment = segment[3]
    return path[::-1]


def added_spans(model: Model, text: str, base: list[Span]) -> list[Span]:
    """Spans of the field that overlap no base span."""
    places = stretches(text)
    if not places:
        return []
    atoms = atoms_of([text[a:b] for a, b in places])
    found = candidates(model, atoms)
    if not found:
        return []
    firsts = np.unique(atoms.first).tolist()
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    reach = list(accumulate((e for _, e in taken), max))
    out = []
    for first, (offset, _) in zip(firsts, places, strict=True):
        if first not in found:
            continue
        for kind, begin, end in best_segments(model, found[first], first, int(atoms.last[first])):
            a, b = offset + int(atoms.start[begin]), offset + int(atoms.end[end - 1])
            before = bisect_left(starts, b)
            if not before or reach[before - 1] <= a:
                out.append((kind, a, b))
    return out


# ------------------------------------------------------------------ on Spark


def _learned(docs: DataFrame, texts: int, sample: int) -> Model:
    """Field trained on stretches of about ``texts`` texts; all but its weights stays on workers."""
    share = min(1.0, texts / max(1, docs.count()))
    scale = 1 << 20
    chosen = docs.where(F.pmod(F.xxhash64("text"), F.lit(scale)) < int(share * scale)).where(
        F.col("text").rlike("[0-9@]")
    )

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_batches(batch, 256):
                found = []
                for text in part.column("text").to_pylist():
                    own = dict.fromkeys(text[a:b] for a, b in stretches(text) if b - a <= 8 * SAMPLE_ATOMS)
                    found += list(own)[:64]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["part"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [part for batch in batches for part in batch.column("part").to_pylist()]
        model = fit_examples(examples_of(parts))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    parts = chosen.select("text").mapInArrow(cut_out, "part string").distinct()
    bounded = parts.orderBy(F.xxhash64("part"), "part").limit(sample)
    rows = bounded.repartition(1).sortWithinPartitions("part").mapInArrow(fit, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else Model.empty()


def fit(docs: DataFrame, texts: int = SAMPLE_TEXTS, sample: int = SAMPLE_STRETCHES) -> Model:
    code_on_workers(docs.sparkSession)
    return _learned(docs, texts, sample)


def personal_data(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, spans) of every row; a span is (kind, start, end, base), ordered by kind and place.

    Positions are code points, the end exclusive. ``base`` tells a pattern's span from an
    added one.
    """
    code_on_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def spans_of(text: str | None) -> list[dict]:
        if not text or not _SEED.search(text):
            return []
        base = base_spans(text)
        found = [(*s, True) for s in base] + [(*s, False) for s in added_spans(shared.value, text, base)]
        return [dict(zip(("kind", "start", "end", "base"), (KINDS[s[0]], *s[1:]), strict=True)) for s in sorted(found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_batches(batch, 256):
                spans = [spans_of(text.as_py()) for text in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(spans, pa.list_(span))], ["doc_id", "spans"]
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind: string, start: int, end: int, base: boolean>>"
    )


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = personal_data(docs, fit(docs))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
