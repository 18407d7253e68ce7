"""Collocations against counting in plain Python."""

import collections
import random
import re

import numpy as np
import pytest
from test_llm_texts import docs, table

from holdfast.llm import catalog, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    """{lang: Counter of word tuples of up to five words}."""
    out = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for m in range(1, 6):
                out[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    return out


def plain_python(rows, least, top, share=100):
    out = []
    for lang, f in counted(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = []
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        inside = collections.Counter()
        for p, c in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], c)
        for p, a in candidates.items():
            if p in inside and 100 * inside[p] >= share * a:
                continue
            score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "c", "É", "é", "漢", "of", "the", "The", "<x>", "\x01", " ", "b-c", "tab\tbed"]
    weights = [1 / (i + 1) for i in range(len(words))]
    ends = [" "] * 12 + ["  ", ". ", ",", "\n", "\r\n", "!? ", "\x0b"]
    fixed = "Licensed under the Apache License; all rights reserved."
    out = []
    for _ in range(n):
        text = "".join(rng.choices(words, weights)[0] + rng.choice(ends) for _ in range(rng.randint(0, 60)))
        out.append(text + rng.choice(["", "", fixed, " the the the the the the the"]))
    return out


@pytest.mark.parametrize("shard_bytes", [300, 4_000_000])
def test_collocations_equal_plain_python(spark, shard_bytes):
    rng = random.Random(2)
    rows = [(rng.choice(["en", "en", "fr", None, "und"]), t) for t in [None, "", " ", ".", *texts(1, 300)]]
    rows += [("one", "x y. " * 3_000), ("long", "very long piece " * 20_000)]
    frame = spark.createDataFrame([(*r, 1, "p") for r in rows], "lang string, text string, f int, phrase string")
    settings = phrases.Settings(least=7, top=40, shard_bytes=shard_bytes)
    got = sorted(map(tuple, phrases.collocations(frame.repartition(5), settings=settings).collect()))
    assert got == plain_python(rows, 7, 40)
    assert {r[0] for r in got} == {"en", "fr", "und", "one", "long"}


def test_share_of_longer_phrases(spark):
    rows = [("en", t) for t in texts(5, 200)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    settings = phrases.Settings(least=5, share=60, top=100)
    got = sorted(map(tuple, phrases.collocations(frame, settings=settings).collect()))
    assert got == plain_python(rows, 5, 100, 60)


def test_collocations_are_counted_past_64_bits(spark):
    """1000 * a * n and l * r as large as a corpus of 10^14 words makes them, in the operator's own expression."""
    row = spark.sql(
        "SELECT (cast(1000 as decimal(4,0)) * cast(90000000000000 as decimal(17,0)) * cast(99000000000000 as decimal(17,0)))"
        " div (cast(90000000000000 as decimal(18,0)) * cast(91000000000000 as decimal(18,0))) AS score"
    ).first()
    assert row.score == 1000 * 90000000000000 * 99000000000000 // (90000000000000 * 91000000000000)


@pytest.mark.parametrize("seed", range(4))
def test_index_extends_on_both_sides(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, 5, size=400)
    want = collections.Counter()
    joined = text.tolist()
    for m in range(1, 6):
        want.update(tuple(joined[i : i + m]) for i in range(len(joined) - m + 1) if 0 not in joined[i : i + m])
    index = phrases.Index(text, 4)
    found = index.words()
    got = {}
    for m in range(1, 6):
        found = found if m == 1 else index.extend_left(*found) if m % 2 else index.extend_right(*found)
        got.update(zip(map(tuple, found[0].tolist()), found[3].tolist()))
        if m < 5:
            for p, right, left in zip(map(tuple, found[0].tolist()), *(x.tolist() for x in index.longest_extensions(*found))):
                assert right == max(want[(*p, x)] for x in range(1, 5))
                assert left == max(want[(x, *p)] for x in range(1, 5))
    assert got == dict(want)
    # The two ways round agree with each other in every bi-interval.
    one = index.extend_left(*index.extend_right(*index.words()))
    two = index.extend_right(*index.extend_left(*index.words()))
    as_rows = lambda found: sorted(zip(map(tuple, found[0].tolist()), *(x.tolist() for x in found[1:])))
    assert as_rows(one) == as_rows(two)


def test_sieve_lets_its_phrases_through(spark):
    pairs = [(f"w{i}", f"v{i % 7}") for i in range(2_000)]
    lang, *words = (phrases.word_hashes(list(x)) for x in (["en"], *zip(*pairs)))
    hashes = phrases.phrase_hashes(lang, words)[0]
    sieve = phrases.sieve_of(spark.createDataFrame([(h,) for h in hashes[:1_000].view(np.int64).tolist()], "h1 long").repartition(6))
    assert phrases._passes(sieve, hashes[:1_000]).all()
    assert phrases._passes(sieve, hashes[1_000:]).mean() < 0.01
    assert phrases._passes(sieve, phrases.phrase_hashes(lang, words[::-1])[0]).mean() < 0.01


def test_collocations_of_nothing(spark, tmp_path):
    assert catalog.op12_phrases(spark, table(spark, tmp_path, docs(spark, []))).collect() == []
    assert phrases.collocations(docs(spark, [None, "", "only rare words here"])).collect() == []
