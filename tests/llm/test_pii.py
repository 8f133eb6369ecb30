"""Personal data: base patterns, the field against enumeration, odd rows, recall."""

from __future__ import annotations

import itertools
import re
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from callgrove.llm import common, pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _plain_base(text: str):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == "ip" and any(int(p) > 255 for p in match[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((k, *match.span()))
    return out


@given(st.text(st.sampled_from("aZé0159@.-+ ()%_\n٣"), max_size=60))
@settings(max_examples=400, deadline=None)
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == _plain_base(text)


@given(st.text(st.sampled_from("4111 -"), min_size=13, max_size=24))
@settings(max_examples=100, deadline=None)
def test_card_numbers(text):
    assert pii.base_spans(text) == _plain_base(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "a" * 200_000 + "@", "+" + "1 " * 200_000, "1." * 200_000, "a@" * 100_000):
        spans = pii.base_spans(text)
        assert spans == [] or text.startswith("1.")
    model = pii.Model.empty()
    assert pii.added_spans(model, "1 " * 20_000 + "x" * 100_000, []) == []


@pytest.fixture(scope="module")
def trained():
    random = np.random.default_rng(2)
    parts = []
    for i in range(150):
        a, b, c, d = (int(v) for v in random.integers(1, 256, 4))
        parts += [f"{a}.{b}.{c}.{d}", f"user{a}@mail{b % 9}.example.com", f"+1 ({100 + c}) 555-{1000 + a * 7}", f"{a}.{b}", f"v{i}"]
        digits = "".join(map(str, random.integers(0, 10, 15)))
        parts += [digits + str(next(k for k in range(10) if _luhn(digits + str(k)))), digits, f"{a}-{b}", str(1900 + i)]
    return pii.fit_examples(pii.examples_of(sorted(set(parts))))


def _random_model(seed: int) -> pii.Model:
    random = np.random.default_rng(seed)
    model = pii.Model.empty()
    for value in model.parameters():
        value += random.normal(0, 0.7, value.shape)
    model.enter += 3
    return model


def _segmentations(n: int, k: int):
    """All ways to cut n atoms: lists of (kind or None, first, end)."""
    if n == 0:
        yield []
        return
    for length in range(1, n + 1):
        for rest in _segmentations(n - length, k):
            for kind in ([None] if length == 1 else []) + list(range(k)):
                yield [*rest, (kind, n - length, n)]


def _weight(model, scores, possible, path) -> float:
    total, before = 0.0, None
    for kind, first, end in [*path, (None, 0, 0)]:
        if kind is not None:
            if not possible[first, end - first - 1]:
                return -np.inf
            total += scores[first, end - first - 1, kind]
            total += model.enter[kind] if before is None else model.between[before, kind]
        elif before is not None:
            total += model.leave[before]
        before = kind
    return total


@pytest.mark.parametrize(("seed", "text"), list(itertools.product(range(6), ["1 a@2", "+1 22", "1.2", "(3)@"])))
def test_decoding_and_sums_equal_enumeration(seed, text):
    model = _random_model(seed)
    atoms = pii.atoms_of([text])
    n = len(atoms.kind)
    found, possible = pii.features(atoms, 0, n)
    scores = model.scores(found)
    weights = [(_weight(model, scores, possible, p), p) for p in _segmentations(n, len(pii.KINDS))]
    best = max(w for w, _ in weights)
    path = pii.best_segments(model, pii.candidates(model, atoms).get(0, {}), 0, n)
    cut, at = [], 0
    for kind, first, end in path:
        cut += [(None, i, i + 1) for i in range(at, first)] + [(kind, first, end)]
        at = end
    cut += [(None, i, i + 1) for i in range(at, n)]
    assert _weight(model, scores, possible, cut) == pytest.approx(best)

    masked = np.where(possible[..., None], scores, -np.inf)[None]
    # A longer stretch beside it must not matter.
    padded = np.concatenate([masked, np.full((1, 3, *masked.shape[2:]), -np.inf)], axis=1)
    log_z, spans, enter, leave, between = pii.expectations(model, padded, np.array([n]))
    z = np.logaddexp.reduce([w for w, _ in weights])
    assert log_z[0] == pytest.approx(z)
    wanted = np.zeros(spans.shape)
    moves = [np.zeros_like(enter), np.zeros_like(leave), np.zeros_like(between)]
    for w, p in weights:
        before = None
        for kind, first, end in [*p, (None, 0, 0)]:
            share = np.exp(w - z)
            if kind is not None:
                wanted[0, first, end - first - 1, kind] += share
                if before is None:
                    moves[0][kind] += share
                else:
                    moves[2][before, kind] += share
            elif before is not None:
                moves[1][before] += share
            before = kind
    for got, want in zip((spans, enter, leave, between), (wanted, *moves), strict=True):
        assert np.allclose(got, want)


def test_field_knows_the_base_kinds_and_adds_other_forms(trained):
    known = ["9.8.7.6", "bob7@mail3.example.com", "+1 (333) 555-1234", "4111111111111111"]
    for k, text in enumerate(known):
        kind = (1, 0, 3, 2)[k]
        assert pii.added_spans(trained, f"xx {text} yy", []) == [(kind, 3, 3 + len(text))]
    assert pii.added_spans(trained, "call (333) 555-1234 now", []) == [(3, 5, 19)]
    assert pii.added_spans(trained, "4111.1111.1111.1111", []) == [(2, 0, 19)]
    for text in ("version 2.0 of 1999", "plain words", "", "10 pears, 20 apples", "1234567"):
        assert pii.added_spans(trained, text, pii.base_spans(text)) == []


def test_added_spans_do_not_overlap_base_spans(trained):
    text = "+1 (333) 555-1234 or 4111111111111111 at a@b.c"
    base = pii.base_spans(text)
    for _, start, end in pii.added_spans(trained, text, base):
        assert all(end <= s or start >= e for _, s, e in base)


def test_stretches_are_decoded_alike_wherever_they_are_cut(trained, monkeypatch):
    text = " ".join(["(333) 555-1234", "x", "1.2.3.4", "word words longer", "4111.1111.1111.1111"] * 700)
    whole = pii.added_spans(trained, text, [])
    one = [s for a, b in pii.stretches(text) for s in pii.added_spans(trained, text[a:b], [])]
    assert len(whole) == len(one) > 1400


def test_a_field_without_spans_to_learn_adds_nothing():
    model = pii.fit_examples(pii.examples_of(["1999", "v2"]))
    assert pii.added_spans(model, "+1 (333) 555-1234 1.2.3.4", []) == []


SCHEMA = "doc_id long, text string, spans string, kind int, start long, part string, model string"


def test_query_on_odd_rows(spark, tmp_path):
    common.code_on_workers(spark)
    texts = [
        (1, "mail a.b@c.de and 1.2.3.4"), (2, None), (3, ""), (None, "+1 (333) 555-1234 😀 x@y.z"), (None, None),
        (5, "4111 1111 1111 1111"), (5, "4111 1111 1111 1111"), (6, "é 😀 " * 30_000 + "q@r.st"), (7, "300.1.1.1 @ .@."),
    ]
    rows = [(i, t, "s", 1, 2, "p", "m") for i, t in texts]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = pii.op11_pii(spark, str(tmp_path))
    assert found.columns == ["doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256", "spans"]
    got = sorted((r.doc_id, *(r[f"n_{k}"] for k in pii.KINDS), r.base_sha256) for r in found.collect() if r.doc_id)
    wanted = []
    for i, text in texts:
        base = _plain_base(text or "")
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        counts = [sum(k == n for k, _, _ in base) for n in range(4)]
        if i:
            wanted.append((i, *counts, sha256(listed.encode()).hexdigest()))
    assert got == sorted(wanted)
    for row in found.collect():
        text = next(t for i, t in texts if i == row.doc_id and (i or (t is None) == (row.n_phone == 0)))
        own = row.spans.split(",") if row.spans else []
        assert {f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in _plain_base(text or "")} <= set(own)


def test_query_on_no_rows(spark, tmp_path):
    common.code_on_workers(spark)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert pii.op11_pii(spark, str(tmp_path)).count() == 0
