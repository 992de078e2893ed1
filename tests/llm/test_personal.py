"""Personal data: patterns against their plain form, the model against enumeration."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from factorloom.llm import crf, personal
from factorloom.llm.labelled import KINDS, MARK, labelled, sentences, unmark

# clashing names of work columns
DOCS = "doc_id long, text string, n_chars long, rank int, start string, base string, kind int"

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and personal.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((rank, m.start(), m.end(), kind))
    return out


def noise(seed, n, alphabet):
    rng = random.Random(seed)
    return "".join(rng.choice(alphabet) for _ in range(n))


TEXTS = [
    None, "", " \n", "no data here", "é ü a@b.c_d@e.f.g, x@y", "a@b.c.d@e.f", "1.2.3.4.5 256.1.1.1",
    "0000255.1.1.01 1..2.3.4 1.2.3", "4111 1111 1111 1111-2", "4111-1111-1111-1111 4111111111111111",
    "+1 (499) 555-6503", "+1 (499) 555-6503 4521940886194967", "+12 ++1.2.3.4.5.6.7.8.9. +1(2",
    "Tel. (212) 555-0187, mail ops@db7 card 9807915762804490 ip fe80::1ff:fe23:4567:890a",
    "+" * 50 + "1" * 9, "@" * 40, "ünï@ö.de é4111111111111111é", "1" * 20 + "." + "2" * 30,
    *[noise(s, 400, "01.2-@ a+()9\n") for s in range(30)],
    *[noise(s, 300, "4 1-@.b_%é") for s in range(30, 50)],
    *[noise(s, 300, "ab@._") for s in range(50, 60)], *[noise(s, 300, "12.") for s in range(60, 70)],
    *[noise(s, 300, "123456789+") for s in range(70, 80)]]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, len(t or ""), 1, "s", "b", 2) for i, t in rows], DOCS)


def test_base_spans_equal_the_plain_patterns():
    found = 0
    for text in TEXTS:
        spans = plain_spans(text)
        assert personal.base_spans(text or "") == spans
        found += len(spans)
    assert found > 60


def test_query_rows(spark):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[13])] * 2
    got = personal.digest(docs(spark, rows).repartition(4)).collect()
    assert len(got) == len(rows)

    def listed(spans):
        return ",".join(f"{k}:{a}:{b}" for _, a, b, k in spans)

    want = sorted([(i, *[sum(s[3] == k for s in plain_spans(t)) for k in PLAIN], hashlib.sha256(
        listed(plain_spans(t)).encode()).hexdigest()) for i, t in rows], key=repr)
    assert sorted([tuple(r)[:6] for r in got], key=repr) == want
    for r in got:
        base = [s for s in r["spans"].split(",") if s and not s.startswith("crf_")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r["base_sha256"]
    assert any("crf_phone" in r["spans"] and "crf_email" in r["spans"] for r in got)


def test_scan_keeps_columns_and_names(spark):
    df = docs(spark, [(1, "call (212) 555-0187 or a@b.cd"), (None, None)])
    found = personal.scan(df, names=("b1", "s1"))
    assert found.columns == [*df.columns, "b1", "s1"]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert [s["kind"] for s in rows[1]["s1"]] == ["email", "crf_phone"]
    assert rows[None]["s1"] == [] and rows[None]["text"] is None
    assert personal.digest(docs(spark, [])).collect() == []


def test_redact(spark):
    df = docs(spark, [(1, "call (212) 555-0187 or a@b.cd now"), (2, None), (3, "clean"), (3, "")])
    clean = personal.redact(df)
    assert clean.columns == df.columns
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in clean.collect()), key=repr)
    assert got == [(1, "call [PHONE] or [EMAIL] now", 27), (2, None, None), (3, "", 0),
                   (3, "clean", 5)]


@pytest.mark.parametrize("text", [
    "a" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "1 " * 500_000, "+1(" * 300_000,
    "a@" * 500_000, "a.b-" * 250_000 + "@", "+" + "(" * 1_000_000, "a@b" + ".c" * 400_000,
    "+1" + " (" * 400_000, "1-" * 400_000, "@" * 1_000_000])
def test_long_texts_take_linear_time(text, model):
    begin = time.time()
    (base, spans), = personal.find(model, pa.array([text]))
    assert time.time() - begin < 60
    assert base == personal.base_spans(text)


@pytest.fixture(scope="module")
def model():
    return crf.train([personal.example(s) for s in sentences()], KINDS)


def tiny(seed, kinds=2, features=6):
    rng = np.random.default_rng(seed)
    size = 1 + 2 * kinds
    pairs, first = crf.allowed(kinds)
    chains = [[rng.integers(0, features, rng.integers(0, 4)).tolist() for _ in range(n)]
              for n in (1, 4, 2, 3, 1)]
    return chains, rng.normal(size=(features, size)), rng.normal(size=(size, size)) + pairs, first


def scores(chain, weights, step, first):
    """The score of every sequence of states of a chain."""
    size = len(first)
    emit = [sum((weights[f] for f in word), np.zeros(size)) for word in chain]
    return {s: first[s[0]] + sum(e[x] for e, x in zip(emit, s))
            + sum(step[x, y] for x, y in zip(s, s[1:]))
            for s in itertools.product(range(size), repeat=len(chain))}


@pytest.mark.parametrize("seed", range(6))
def test_decoding_and_sums_equal_enumeration(seed):
    chains, weights, step, first = tiny(seed)
    laid = crf.Chains(chains)
    emit = laid.emissions(weights)
    best = crf.viterbi(laid, emit, step, first)
    marginal, moves, total = crf.forward_backward(laid, emit, step, first)
    z, expected = 0.0, np.zeros_like(step)
    for place, start, n in zip(laid.order, laid.starts, laid.lengths):
        every = scores(chains[place], weights, step, first)
        assert tuple(best[start:start + n].tolist()) == max(every, key=every.get)
        mass = {s: np.exp(v) for s, v in every.items()}
        whole = sum(mass.values())
        z += np.log(whole)
        for i in range(n):
            own = [sum(m for s, m in mass.items() if s[i] == x) / whole
                   for x in range(len(first))]
            assert np.allclose(marginal[start + i], own)
        for s, m in mass.items():
            for x, y in zip(s, s[1:]):
                expected[x, y] += m / whole
    assert np.isclose(total, z) and np.allclose(moves, expected)


def chain_states(model, words, states):
    for a, b in crf.marked_runs(words):
        named = crf.run_features(words[a:b], words[a - 1] if a else None,
                                 words[b] if b < len(words) else None)
        yield crf.decode(model, [named])[0], states[a:b]


def test_held_out_words_are_labelled(model):
    rows = [personal.example(s) for s in sentences()]
    right = n = 0
    for fold in range(4):
        part = crf.train([r for i, r in enumerate(rows) if i % 4 != fold], KINDS)
        for words, states in (r for i, r in enumerate(rows) if i % 4 == fold):
            for got, want in chain_states(part, words, states):
                right += sum(a == b for a, b in zip(got, want))
                n += len(want)
    assert right / n > 0.84, (right, n)
    for words, states in rows:
        for got, want in chain_states(model, words, states):
            assert got == want


def test_inside_follows_its_own_kind(model):
    rng = random.Random(4)
    for _ in range(40):
        words = [noise(rng.random(), rng.randrange(1, 9), "0123456789-+.@()") + "1"
                 for _ in range(rng.randrange(1, 30))]
        states = crf.decode(model, [crf.run_features(words, None, None)])[0]
        for before, state in zip([0, *states], states):
            assert state == 0 or state % 2 or before in (state, state - 1)


def test_labelled_table(spark):
    assert all(unmark(s)[0] == MARK.sub(lambda m: m[2], s) for s in sentences())
    found = personal.fit(labelled(spark).unionByName(labelled(spark).limit(0)))
    assert found.kinds == KINDS and len(found.index) > 100
    empty = personal.fit(labelled(spark).limit(0))
    assert personal.model_spans(empty, pa.array(["a 1 2 b@c"])) == [[]]
