"""Fill-in-middle examples against plain Python."""

import collections
import hashlib
import re

import pyarrow as pa
from test_llm_texts import ODD, docs, noisy, table

from holdfast.llm import catalog, chunks, infill

MARKED = ["a <P> b\nc", "<S>", "x\n<M>\n", "<", "<P", "S>\n<", "\n<\nS>\n<P\n>", "M><\n\n<S\n>"]
LINES = ["one\ntwo\nthree", "one\ntwo\n", "\n\n\n", "\r\n\x0b\n", "é\n漢字\n🤖", "line\n" * 3_000, "word " * 40_000]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_python(key, text, rate=100, suffix_first=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha(f"7:{'' if key is None else key}")
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:one], units[one:two], units[two:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < suffix_first:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_infill_equals_plain_python(spark, tmp_path):
    frame = docs(spark, [*ODD, *MARKED, *LINES, *noisy(4, 400)])
    got = catalog.op13_infill(spark, table(spark, tmp_path, frame)).collect()
    want = collections.Counter()
    for row in frame.collect():
        *head, output = plain_python(row.doc_id, row.text)
        want[row.doc_id, *head, sha(output), sha(row.text or "")] += 1
    assert collections.Counter(tuple(r) for r in got) == want
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_infill_rates_and_key_types(spark):
    texts = [f"a{i}\nb\nc{i}\n" for i in range(300)]
    frame = spark.createDataFrame([(f"k{i}", t, "x", 1) for i, t in enumerate(texts)], "key string, body string, form string, n int")
    settings = infill.Settings(rate=40, suffix_first=20)
    got = infill.restore(infill.rearrange(frame, "key", "body", settings), settings).collect()
    for row in got:
        text = texts[int(row.key[1:])]
        assert (row.n, row.form, row.prefix_chars, row.middle_chars, row.output) == plain_python(row.key, text, 40, 20)
        assert row.restored == text
    shares = collections.Counter(r.form for r in got)
    assert shares["plain"] > shares["psm"] > shares["spm"] > 0


def test_groups_hold_every_row_once():
    texts = pa.array(["a" * n if n is not None else None for n in [3, 4, 50, 0, None, 10, 1, 9, 2]])
    runs = list(chunks.runs_of(texts, 10))
    assert [i for start, length in runs for i in range(start, start + length)] == list(range(9))
    sizes = [len(t or "") for t in texts.to_pylist()]
    assert all(length == 1 or sum(sizes[start : start + length]) <= 10 for start, length in runs)


def test_infill_of_nothing(spark, tmp_path):
    assert catalog.op13_infill(spark, table(spark, tmp_path, docs(spark, []))).collect() == []
