"""Vectors, near duplicates and learned scores against brute force and held-out accuracy; the pipeline stage by stage."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from holdfast.llm import catalog, common, language, minhash, quality, topk, vector_dedup
from holdfast.session import materialise

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, h1 long"
VECS = "vec_id long, embedding array<float>, label int, id long, node long, n_links string"


def docs(spark, rows):
    rows = [(k, t, lang, "s", None if t is None else len(t), 0.5, 3, 4) for k, t, lang in rows]
    return spark.createDataFrame(rows, DOCS)


def vectors(spark, rows):
    return spark.createDataFrame([(k, v, 0, 1, 2, "x") for k, v in rows], VECS)


def written(tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def roots(nodes, links):
    found = {n: n for n in nodes}

    def root(n):
        while found[n] != n:
            n = found[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        found[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def some_vectors(seed, n, dim=16, groups=12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    out = []
    for i in range(n):
        v = centres[rng.integers(groups)] + rng.standard_normal(dim) * rng.choice([0.05, 0.3, 1.0])
        out.append([float(x) for x in (v * rng.choice([0.5, 1, 2])).astype(np.float32)])
    return out


BAD = [None, [], [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]


@pytest.fixture(scope="module")
def vector_rows():
    rows = list(enumerate(some_vectors(1, 420)))
    rows += [(1000 + i, v) for i, v in enumerate(BAD)] + [(1100, [0.0] * 16), (1200, [1.0, 2.0])]
    rows += [(2000 + 100 * i, rows[7][1]) for i in range(40)]  # copies
    rows += [(3, rows[3][1]), (None, rows[4][1])]
    return rows


def good(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def test_top_k_equals_brute_force(spark, tmp_path, vector_rows):
    where = written(tmp_path, embeddings=vectors(spark, vector_rows))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in catalog.op2_topk(spark, where).collect()}
    whole = {k: np.pad(np.floor(1024 * np.array(v, dtype=np.float64)), (0, 16 - len(v))) for k, v in vector_rows if k is not None and good(v)}
    want = {}
    for q in whole:
        if q % 100 == 0:
            best = sorted((-int(whole[q] @ v), k) for k, v in whole.items() if k != q)[:10]
            want |= {(q, i): (k, -s) for i, (s, k) in enumerate(best, 1)}
    assert got == want


def test_top_k_with_few_rows(spark):
    frame = vectors(spark, [(0, [1.0, 0.0]), (100, [0.5, 0.5]), (7, [1.0, 0.0]), (9, [1.0, 0.0])])
    out = topk.top_k(frame, catalog.F.col("vec_id") % 100 == 0, k=5)
    got = collections.defaultdict(list)
    for r in out.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert got == {
        0: [(1, 7, 1024**2), (2, 9, 1024**2), (3, 100, 512 * 1024)],
        100: [(1, 0, 512 * 1024), (2, 7, 512 * 1024), (3, 9, 512 * 1024)],
    }
    assert topk.top_k(frame.where("vec_id = 0"), catalog.F.lit(True)).count() == 0
    assert topk.top_k(frame.limit(0), catalog.F.lit(True)).count() == 0


@pytest.mark.parametrize("largest", [70_000.0, 1e6, 1e8, 2.0**40])
def test_long_vectors_are_compared_exactly(spark, monkeypatch, largest):
    """Scores beyond double precision, and beyond 64 bits, where close ones differ by 1."""
    monkeypatch.setattr(topk, "RING_ROWS", 20)
    rng = np.random.default_rng(9)
    rows = [(i, (rng.integers(-8, 8, size=6) / 1024.0).tolist()) for i in range(200)]
    rows += [(300 + i, [largest, i / 1024, 1.0, 0.0, 0.0, 0.0]) for i in range(30)] + [(400 + i, [largest, 3.0, 0.0, 0.0, 0.0, i / 1024]) for i in range(101)]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(vectors(spark, rows), catalog.F.col("vec_id") % 50 == 0, k=6).collect()}
    whole = {k: [int(np.floor(1024 * x)) for x in v] for k, v in rows}
    want = {}
    for q in (k for k in whole if k % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v)), k) for k, v in whole.items() if k != q)[:6]
        want |= {(q, i): (k, max(-(2**63), min(2**63 - 1, -s))) for i, (s, k) in enumerate(best, 1)}
    assert got == want


def test_index_rows_are_copied_only_for_chunks_that_ask(spark, monkeypatch):
    """Two far groups, each queried by itself: no row of one meets a chunk of the other in the second search."""
    monkeypatch.setattr(topk, "RING_ROWS", 20)
    rows = [(i, (0 if i < 200 else 64, i % 7, i % 11)) for i in range(400)]
    index = topk.Search(spark.createDataFrame([(k, [int(x) for x in v]) for k, v in rows], "id long, vector array<bigint>"), 3)
    asked = spark.createDataFrame([(5, [0, 5, 5], 0.0, 0), (300, [64, 6, 3], 4000.0, 1)], "id long, vector array<bigint>, bound double, chunk long")
    plan = index._scored(index._plan(asked, False))._jdf.queryExecution().optimizedPlan().toString()
    # The only rows generated are the blocks of a query's ring.
    generated = [line for line in plan.splitlines() if "Generate" in line]
    assert generated and all("blocks#" in line for line in generated)


def test_rings_are_skipped_and_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(topk, "RING_ROWS", 20)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 7)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rows = list(enumerate(some_vectors(3, 300)))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(vectors(spark, rows), catalog.F.col("vec_id") % 30 == 0, k=4).collect()}
    whole = np.floor(1024 * np.array([v for _, v in rows]))
    want = {}
    for q in range(0, 300, 30):
        best = sorted((-int(whole[q] @ v), k) for k, v in enumerate(whole) if k != q)[:4]
        want |= {(q, i): (k, -s) for i, (s, k) in enumerate(best, 1)}
    assert got == want


def check_links(spark, rows, found):
    whole = {k: np.array(v, dtype=np.float64) for k, v in rows if k is not None and v and good(v) and any(v)}
    links = []
    for a in whole:
        for b in whole:
            if a < b and len(whole[a]) == len(whole[b]):
                cosine = whole[a] @ whole[b] / np.linalg.norm(whole[a]) / np.linalg.norm(whole[b])
                assert abs(cosine - 0.9) > 1e-9
                if cosine >= 0.9:
                    links.append((a, b))
    count = collections.Counter(x for link in links for x in link)
    component = roots({k for k, _ in rows if k is not None}, links)
    want = [(k, count[k], component.get(k), None if k is None else component[k] == k) for k, _ in rows]
    assert collections.Counter(map(tuple, found)) == collections.Counter(want)


@pytest.mark.parametrize("tile", [1024, 20])
def test_vector_links_equal_brute_force(spark, tmp_path, vector_rows, monkeypatch, tile):
    monkeypatch.setattr(vector_dedup, "TILE", tile)
    where = written(tmp_path, embeddings=vectors(spark, vector_rows))
    out = catalog.op3_vectors(spark, where)
    check_links(spark, vector_rows, out.select("vec_id", "n_links", "component_id", "kept").collect())


def test_vector_links_of_nothing(spark):
    assert vector_dedup.near_vectors(vectors(spark, []).limit(0)).count() == 0
    alone = vector_dedup.near_vectors(vectors(spark, [(5, None), (6, [1.0])])).orderBy("vec_id").collect()
    assert [tuple(r) for r in alone] == [(5, 0, 5, True), (6, 0, 6, True)]


def test_filters_find_nearly_all_pairs_just_over_the_limit():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    away = rng.standard_normal((400, 64))
    away -= (away * a).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * away / np.linalg.norm(away, axis=1, keepdims=True)
    filters = vector_dedup.CapFilters(64, vector_dedup.code_size(50_000))
    met = [len(np.intersect1d(x, y)) > 0 for x, y in zip(filters.decode(a), filters.decode(b))]
    assert np.mean(met) >= 0.99


@pytest.mark.parametrize("vectors_in_all", [200_000, 5_000_000, 50_000_000])
def test_no_pair_just_over_the_limit_is_lost_in_large_tables(vectors_in_all):
    rng = np.random.default_rng(6)
    a = rng.standard_normal((1_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    away = rng.standard_normal((1_000, 64))
    away -= (away * a).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * away / np.linalg.norm(away, axis=1, keepdims=True)
    filters = vector_dedup._filters(64, vector_dedup.code_size(vectors_in_all))
    assert all(len(np.intersect1d(x, y)) for x, y in zip(filters.decode(a), filters.decode(b)))


def words(rng, n):
    return [rng.choice(["la", "ne", "tor", "mi", "sa", "qu", "ve"]) + str(rng.randint(0, 400)) for _ in range(n)]


def near_texts(seed):
    rng = random.Random(seed)
    shared = words(rng, 60)
    texts = []
    for i in range(60):
        base = words(rng, rng.choice([3, 8, 30, 120]))
        if i % 3 == 0:
            base = base[:20] + shared + base[20:]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            other = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 60)):
                other[rng.randrange(len(other))] = "changed"
            texts.append(" ".join(other))
    near = words(rng, 300)
    for _ in range(60):  # one large group
        other = list(near)
        other[rng.randrange(300)] = f"c{rng.randint(0, 99)}"
        texts.append("\n ".join(other))
    return texts


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_near_duplicates_equal_brute_force(spark, tmp_path):
    texts = [*near_texts(4), None, "", " \n", "one", "ONE", "two words", "x " * 4_000]
    rows = [(i + 10, t, "en") for i, t in enumerate(texts)]
    rows += [(10, texts[0], "en"), (None, texts[0], "en")]
    got = catalog.op6_minhash(spark, written(tmp_path, documents=docs(spark, rows))).collect()
    sets = {k: shingle_set(t) for k, t, _ in rows if k is not None}
    links = [
        (a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    component = roots(sets, links)
    want = collections.Counter((k, component.get(k), None if k is None else component[k] == k) for k, _, _ in rows)
    assert collections.Counter((r.doc_id, r.class_id, r.kept) for r in got) == want


def template_texts(seed, n):
    """Form letters of 20 clauses, each now and then in another version: one clause apart is linked, two are not."""
    rng = random.Random(seed)
    clauses = [[" ".join(words(rng, 10)) for _ in range(3)] for _ in range(20)]
    return [" ".join(c[rng.choice([1, 2]) if rng.random() < 0.12 else 0] for c in clauses) for _ in range(n)]


def template_classes(texts):
    """Of numbered texts: the smallest number each is linked to, by brute force."""
    sets = [shingle_set(t) for t in texts]
    pairs = ((a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)))
    return roots(range(len(sets)), [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])


@pytest.mark.parametrize("tile", [512, 30])
def test_near_duplicates_of_a_template_family(spark, monkeypatch, tile):
    monkeypatch.setattr(minhash, "TILE", tile)
    rng = random.Random(3)
    # Two texts of each group are linked with one another but not with the group's smallest.
    base = [words(rng, 100) for _ in range(20)]
    texts = [" ".join([*b[:76], *words(rng, 24)]) for b in base]
    texts += [" ".join([*b, *end]) for b in base for end in (["p"], ["q"])]
    texts += template_texts(5, 300)
    want = template_classes(texts)
    assert any(k >= 20 and k != root for k, root in want.items()) and len(set(want.values())) > 100
    frame = docs(spark, [(k, t, "en") for k, t in enumerate(texts)])
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(frame).collect()} == want


def test_tiles_give_no_more_rows_than_members(spark):
    """A family with almost no links: what the tiles give grows with the members, not with their pairs."""
    made = {}
    for n in (300, 600):
        rng = random.Random(11)
        base = words(rng, 100)
        texts = []
        for _ in range(n):
            other = list(base)
            for at in rng.sample(range(100), 3):
                other[at] = f"new{rng.randint(0, 10**6)}"
            texts.append(" ".join(other))
        source = docs(spark, [(k, t, "en") for k, t in enumerate(texts)]).selectExpr("doc_id AS doc", "text")
        signed = minhash._by_document(
            source.select("doc", minhash.words_of(F.col("text")).alias("words")),
            lambda w: minhash._signed(w, 100),
            [T.StructField("n", T.IntegerType()), T.StructField("signature", T.ArrayType(T.IntegerType()))],
        )
        pairs, larger = minhash.near_pairs(materialise(signed, "signed"), 0.8, 20, 5)
        classes = minhash.components(minhash._links(source, materialise(pairs, "pairs"), 0.8))
        made[n] = minhash.rest_links(signed, larger, classes, source, 0.8).count()
        assert made[n] <= n
        want = template_classes(texts)
        got = {r.doc_id: r.class_id for r in minhash.near_duplicates(source.toDF("doc_id", "text")).collect()}
        assert got == want
    assert made[600] <= 3 * max(made[300], 50)


def test_near_duplicates_of_nothing(spark):
    frame = docs(spark, [(1, "a b", "en")])
    assert minhash.near_duplicates(frame.limit(0)).count() == 0
    assert [tuple(r) for r in minhash.near_duplicates(frame).collect()] == [(1, 1)]


def test_darts_estimate_weighted_similarity():
    rng = np.random.default_rng(7)
    true, seen = [], []
    for _ in range(60):
        x = rng.integers(0, 2**63, 70).astype(np.uint64)
        a = rng.random(70) * 3 + 0.1
        b = a * rng.choice([0.5, 1, 1, 2], 70)
        true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        seen.append((minhash.dart_signature(x, a, 100) == minhash.dart_signature(x, b, 100)).mean())
    assert abs(np.mean(true) - np.mean(seen)) < 0.03


def test_components_equal_a_walk(spark):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 520)]
    links += [(600, 601 + i) for i in range(80)] + [(5, 5)]
    out = common.components(spark.createDataFrame(links, "a long, b long"))
    want = roots({n for link in links for n in link if link[0] != link[1]}, [x for x in links if x[0] != x[1]])
    assert {r.node: r.component for r in out.collect()} == want


def test_sieve_and_without_split_the_rows(spark):
    frame = docs(spark, [(i, "t", "en") for i in range(50)] + [(None, "t", "en")])
    ids = spark.range(0, 100, 3).toDF("doc_id")
    assert {r.doc_id for r in common.sieve(frame, "doc_id", ids).collect()} >= set(range(0, 50, 3))
    left = common.without(frame, "doc_id", ids)
    assert left.columns == frame.columns
    assert collections.Counter(r.doc_id for r in left.collect()) == collections.Counter([*(i for i in range(50) if i % 3), None])


def test_quality_on_held_out_rows(spark, sf_dir):
    where = sf_dir.replace("0.001", "0.1")
    rows = catalog.op8_quality(spark, where).join(spark.read.parquet(f"{where}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    kept = [r.predicted for r in held if r.quality == 1]
    let_in = [r.predicted for r in held if r.quality == 0]
    assert len(kept) > 100 and len(let_in) > 30
    assert np.mean(kept) >= 0.98 and np.mean(let_in) <= 0.1


def test_quality_of_odd_rows(spark, tmp_path):
    rows = [(1, None, None), (2, "", "en"), (3, "x" * 3_000_000, "en"), (3, "again", "en"), (None, "no key", "en"), (4, "A\nA\n", "de")]
    labels = spark.createDataFrame([(2, 1, 0), (4, 1, 0), (4, 0, 0), (None, 1, 0), (77, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    where = written(tmp_path, documents=docs(spark, rows), labels=labels)
    out = catalog.op8_quality(spark, where).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(k for k, _, _ in rows)
    assert all(0 <= r.score <= 1 for r in out)
    nothing = quality.rate(docs(spark, rows), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in nothing} == {(0.5, 1)}
    assert quality.rate(docs(spark, rows).limit(0), labels).count() == 0


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(1)
    good_rows, bad = rng.normal(0, 1, (2_000, 6)), rng.normal(3, 1, (800, 6))
    mixed = np.vstack([rng.normal(0, 1, (3_200, 6)), bad])
    settings = quality.Settings(steps=400)
    assert abs(quality.estimate_prior(good_rows, rng.permutation(mixed), settings) - 0.8) < 0.05


def test_language_on_held_out_rows(spark, sf_dir):
    where = sf_dir.replace("0.001", "0.01")
    rows = catalog.op10_language(spark, where).join(spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) >= 0.97


def test_language_of_odd_rows(spark, tmp_path):
    rows = [(i, "the and of to", "en") for i in range(40)] + [(100 + i, "der und die das", "de") for i in range(40)]
    rows += [(200, None, "en"), (201, "", "en"), (202, "123 !!", "en"), (203, "the and " * 90_000, None), (203, "und das", None), (None, "of the", "xx")]
    out = catalog.op10_language(spark, written(tmp_path, documents=docs(spark, rows))).collect()
    assert len(out) == len(rows)
    by = collections.defaultdict(list)
    for r in out:
        by[r.doc_id].append((r.lang_pred, r.score))
        assert 0 <= r.score <= 1
    assert by[200] == by[201] == by[202] == [("und", 0.0)]
    assert sorted(name for name, _ in by[203]) == ["de", "en"]
    assert by[None][0][0] in ("de", "en")
    nothing = language.identify(docs(spark, [(1, "text", None)])).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]


def test_tables_of_the_network_equal_its_definition():
    net = language.Network.start(["a", "b", "c"], language.Settings())
    windows = np.random.default_rng(3).integers(0, 256, (5, language.WINDOW)).astype(np.uint8)
    embedded, top = net.embedding[windows], []
    for f, b in zip(net.filters, net.biases):
        places = [np.einsum("nwd,wdf->nf", embedded[:, i : i + len(f)], f) + b for i in range(language.WINDOW - len(f) + 1)]
        top.append(np.max(places, axis=0))
    logits = np.maximum(np.hstack(top), 0) @ net.dense + net.offset
    want = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    assert np.allclose(net.probabilities(windows), want, atol=1e-5)


def test_gradient_of_the_network():
    net = language.Network.start(["a", "b"], language.Settings())
    for w in net.parameters():
        w[...] = w * 0.5
    windows = np.random.default_rng(5).integers(0, 256, (3, language.WINDOW)).astype(np.uint8)
    target = np.array([0, 1, 1])
    gradient = net.loss_gradient(windows, target)

    def loss():
        net._tables.clear()
        return -np.log(net.probabilities(windows)[np.arange(3), target]).mean()

    for w, g in zip(net.parameters(), gradient):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        step = 1e-2
        w[at] += step
        up = loss()
        w[at] -= 2 * step
        down = loss()
        w[at] += step
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 1e-3


def test_pipeline_keeps_one_text_of_each_class_of_a_template_family(spark, sf_dir):
    texts = template_texts(9, 400)
    want = template_classes(texts)
    frame = docs(spark, [(k, t, "en") for k, t in enumerate(texts)])
    kept = dict(corpus_pipeline.STAGES)["MinHash near-dedup"](spark, frame, sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_pipeline_stages(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")  # the smallest that holds a secret in a good text
    docs_in = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, seen = {r.doc_id: r for r in docs_in.collect()}, docs_in
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.materialise(stage(spark, seen, sf_dir), "stage")
        assert out.dtypes == docs_in.dtypes, name
        after = {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before) and out.count() == len(after)
        if name == "line dedup":
            assert set(after) == set(before)
            held = collections.Counter(line for r in after.values() for line in set(r.text.split("\n")) if len(line.strip()) >= 10)
            assert set(held.values()) <= {1}
        if name == "MinHash near-dedup":
            kept = [shingle_set(r.text) for r in after.values()]
            assert all(len(a & b) < 0.8 * len(a | b) for i, a in enumerate(kept) for b in kept[:i])
        if name == "secret scans":
            assert set(after) == set(before)
            assert all(r.n_chars == len(r.text) for r in after.values())
            assert sum(r.text != before[k].text for k, r in after.items()) >= 1
        before, seen = after, out
    packed = corpus_pipeline.STAGES[-1][1](spark, seen, sf_dir)
    assert {r.doc_id for r in packed.collect()} == set(before)


def test_pipeline_with_odd_and_more_columns(spark, tmp_path):
    rows = [(1, None, None), (2, "", None), (3, "a line to keep here", "en"), (4, "a line to keep here", "en"), (None, "no key token=abcdef12", "en")]
    frame = docs(spark, rows)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    where = written(tmp_path, documents=frame, labels=labels)
    seen = frame
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen = common.materialise(stage(spark, seen, where), "stage")
        assert seen.columns == frame.columns
    assert sorted(((r.doc_id or 0), r.text) for r in seen.where("doc_id IS NULL OR doc_id > 2").collect()) == [
        (0, "no key [SECRET]"), (3, "a line to keep here"),
    ]
    assert corpus_pipeline.run(spark, where).count() >= 2
    empty = frame.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = common.materialise(stage(spark, empty, where), "stage")
    assert empty.count() == 0


@pytest.mark.parametrize("most", [4096, 1])
def test_language_sample_draws_by_key_and_text(spark, monkeypatch, most):
    """A key with a third of the rows isn't taken or left as a whole, and each language has its own limit."""
    monkeypatch.setattr(language, "MOST_LANGUAGES", most)
    rows = [(7 if i < 1000 else i, f"wort {i} und mehr" if i % 3 else f"word {i} and more", "de" if i % 3 else "en") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    usable = frame.selectExpr("doc_id AS key", "text", "lang")
    taken = language.drawn(usable, 300).groupBy("lang").count().collect()
    assert all(200 < r["count"] < 400 for r in taken) and len(taken) == 2
    hot = language.drawn(usable, 300).where("key = 7").count()
    assert 120 < hot < 280
