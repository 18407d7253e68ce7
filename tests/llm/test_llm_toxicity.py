"""Toxicity: the kernel against its definition, the machine on held-out and odd rows."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from test_llm_texts import ODD, docs, table

from holdfast.llm import catalog, toxicity

INSULTS = ["dolt", "nitwit", "blockhead", "buffoon", "dunderhead"]


def plain_kernel(one, two):
    def features(word):
        letters = [(i, c) for i, c in enumerate(word) if toxicity.letters_of([c])[0].size]
        found = {}
        for (a, i), (b, j), (c, k) in itertools.combinations(list(enumerate(letters)), 3):
            if c - a <= toxicity.REACH:
                at = tuple(int(toxicity.letters_of([x[1]])[0][0]) for x in (i, j, k))
                found[at] = found.get(at, 0) + toxicity.DECAY ** (k[0] - i[0] - 2)
        norm = sum(v * v for v in found.values()) ** 0.5
        return {u: v / norm for u, v in found.items()}

    a, b = features(one), features(two)
    return sum(v * b.get(u, 0) for u, v in a.items()) ** toxicity.POWER


def test_kernel_equals_its_definition():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeé.*ß漢") for _ in range(rng.randint(0, 14))) for _ in range(60)] + ["", "a", "..", "abab" * 5]
    landmarks = [w for w in words if len(toxicity.subsequences([w])[0])][:20]
    got = toxicity.Machine(landmarks, np.zeros(len(landmarks)), 0.0).likeness(words)
    want = np.array([[plain_kernel(w, v) for v in landmarks] for w in words])
    assert np.allclose(got, want, atol=1e-9)


def test_likeness_survives_disguise():
    words = ["i.d.i.o.t", "idxiot", "idiiot", "id-iot", "table"]
    dotted, inserted, doubled, cut, other = toxicity.Machine(["idiot"], np.ones(1), 0.0).likeness(words)[:, 0]
    assert dotted > 0.7 and cut > 0.7 and inserted > 0.25 and doubled > 0.4 and other < 0.01


def test_words_of_texts():
    texts = pa.array(["You, s t u p i d!", "", "a b", "x y z x y z word w. o. r. d", "***"], type=pa.large_string())
    words, at, parents = toxicity.words_of(toxicity._lowered(texts))
    found = [sorted(words[i].as_py() for i, p in zip(at.tolist(), parents.tolist()) if p == row) for row in range(5)]
    assert found[0] == sorted(["you", "s", "t", "u", "p", "i", "d", "stupid"])
    assert found[1] == [""] and found[2] == ["a", "b"] and found[4] == [""]
    assert "xyzxyz" in found[3] and "word" in found[3] and found[3].count("word") == 2


def test_long_words_are_seen_whole():
    machine = toxicity.Machine(["blockhead"], np.ones(1), -0.5)
    long = "z" * 1_000 + "blockhead" + "z" * 1_000
    assert machine.margins([long])[0] > machine.margins(["z" * 2_000])[0]
    assert len(toxicity._spread([long])[0]) > 100


def test_worst_margins_are_different_and_fall():
    values, parents = np.array([1.0, 3.0, 3.0, 2.0, -5.0, 0.5]), np.array([0, 0, 0, 0, 2, 2])
    got = toxicity.worst_margins(values, parents, 3, -1.0)
    assert got.tolist() == [[3, 2, 1, -1], [-1] * 4, [0.5, -1, -1, -1]]


def insulting(n, seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioulnrstmdk") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        for _ in range(rng.randint(2, 5) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words), int(bad)))
    return rows


@pytest.fixture(scope="module")
def learned(spark):
    rows = insulting(1_200, 3)
    texts = docs(spark, [(k, t) for k, t, _ in rows])
    labels = spark.createDataFrame([(k, x) for k, _, x in rows] + [(0, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    machine = toxicity.train(texts, toxicity.labelled(labels))
    return rows, toxicity.rate(texts, labels).collect(), machine


def test_toxicity_of_held_out_rows(learned):
    rows, got, _ = learned
    truth = {k: x for k, _, x in rows}
    assert {r.doc_id: r.held_out for r in got} == {k: zlib.crc32(str(k).encode()) % 3 == 1 for k in truth}
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted for r in held if truth[r.doc_id]]) > 0.95
    assert np.mean([r.predicted for r in held if not truth[r.doc_id]]) < 0.01
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got)


def test_disguised_insults_count(learned):
    machine = learned[2]
    plain, disguised = "sotre name blockhead kilo buffoon dolt", "sotre name b.l.o.c.k.h.e.a.d kilo buff-oon n i t w i t"
    scores = machine.probability(toxicity.text_margins(machine, pa.array([plain, disguised, "sotre name kilo late"])))
    assert scores[0] > 0.7 and scores[1] > 0.7 and scores[2] < 0.1


def test_toxicity_on_labelled_documents(spark):
    path = "/root/testdata/sf0.1"
    got = catalog.op11_toxicity(spark, path).where("held_out").join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").collect()
    bad, good = ([r.score for r in got if r.toxic == x] for x in (1, 0))
    # Words of one stem are insults there in three languages and ordinary in some clean texts.
    assert np.mean(np.array(bad)[:, None] > np.array(good)[None, :]) > 0.87
    assert np.mean(np.array(good) >= 0.7) < 0.015 and np.mean(np.array(bad) >= 0.7) > 0.5


def test_toxicity_of_odd_rows(spark, tmp_path):
    odd = [*ODD, "a " * 5, "\x00", "漢字 🤖", "z" * 5_000, "word " * 100_000]
    rows = [(1_000 + i, t) if not isinstance(t, tuple) else t for i, t in enumerate(odd)]
    frame = docs(spark, [*rows, *[(k, t) for k, t, _ in insulting(200, 9)]])
    path = table(spark, tmp_path, frame)
    labels = spark.createDataFrame([(k, x, 0) for k, _, x in insulting(200, 9)], "doc_id long, toxic int, quality int")
    labels.write.parquet(f"{path}/labels.parquet")
    got = catalog.op11_toxicity(spark, path).collect()
    assert len(got) == frame.count() and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    nothing = {r.score for r in got if r.doc_id in (1_000, 1_001, 1_002, 1_003)}
    assert len(nothing) == 1 and nothing.pop() < 0.3


def test_toxicity_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.rate(docs(spark, []), empty).collect() == []
    assert {r.score for r in toxicity.rate(docs(spark, ["a", "b"]), empty).collect()} == {0.5}
    one_kind = spark.createDataFrame([(i, 0) for i in range(2)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.rate(docs(spark, ["some words", "b"]), one_kind).collect()} == {0.5}
