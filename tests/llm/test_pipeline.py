"""The corpus pipeline against plain Python, and its import guard."""

import hashlib
import os
import re
import shutil
import subprocess
import sys

import corpus_pipeline
import pytest
from test_bpe import library, packed  # noqa: F401
from test_minhash import brute_force
from pyspark.sql import functions as F
from test_mixing import by_hand as _mix
from test_quality import by_hand
from test_secrets import base_spans

from tagloom.llm import mixing, quality, secrets

SF_DIR = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def mix_by_hand(rows, weights, chars):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("test_mixing.CHARS", chars)
        return _mix(rows, weights)


def redacted(rows):
    """Values that fewer than three sources hold, masked in their texts, overlapping ones together."""
    vendor = re.compile(secrets.VENDOR)

    def values(text):
        for lo, no, hi in base_spans(text):
            v = re.search(r"[A-Za-z0-9+/_.=-]+\Z", text[lo:hi])[0] if no == 0 else text[lo:hi]
            yield hi - len(v), hi, v
        yield from ((m.start(), m.end(), m[0]) for m in vendor.finditer(text))

    owners, repos = {}, {}
    for i, text, source in rows:
        for _, _, v in values(text):
            owners.setdefault(v, set()).add(source)
            repos.setdefault(v, set()).add((source, i))
    for i, text, source in rows:
        out, at = "", 0
        live = [
            (lo, hi) for lo, hi, v in values(text)
            if len(set(v)) >= 6 and len(owners[v]) < 3 and (len(owners[v]) == 1 or len(repos[v]) < secrets.EXAMPLE_REPOS)
        ]
        for lo, hi in sorted(live):
            if lo >= at:
                out += text[at:lo] + secrets.MASK
            at = max(at, hi)
        yield i, out + text[at:]


def test_against_plain_python(spark, library):  # noqa: F811
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    good = []
    for d in docs:
        m = dict(zip(quality.MEASURES, by_hand(d[1])))
        if not any(eval(c, {}, m) for _, c in quality.RULES):
            good.append(d)
    kept = {i for i, _, _, k in brute_force([d[:2] for d in good]) if k}
    assert 0 < len(kept) < len(good) < len(docs)
    expected = set()
    for i, text in redacted([d for d in good if d[0] in kept]):
        ids = library.encode_ordinary(text)
        expected.add((i, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect()]
    assert set(got) == expected and len(got) == len(expected)


def test_stages_keep_columns_and_stand_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    prose = " ".join(f"word{i}" for i in range(40)) + "."
    key = "ghp_" + "aB3dE5gH7jK9mN1pQ3sT5"
    rows = [(1, prose, "en", "src0", 5), (2, prose + " more", "en", None, None), (None, prose, None, None, 7), (3, None, None, None, 0),
            (4, "", "en", "src1", 0), (5, prose[::-1] + " " + key, "en", "srcX", 1), (5, prose[::-1] + " " + key, "en", "srcX", 1)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.schema.names == schema.replace(",", "").split()[::2], name
            docs = spark.createDataFrame(docs.collect(), schema)
        if given:
            texts = sorted((r.doc_id or 0, r.text, r.n_chars) for r in docs.collect())
            masked = prose[::-1] + " " + secrets.MASK
            assert texts == [(0, prose, len(prose)), (1, prose, len(prose)), *[(5, masked, len(masked))] * 2]
        out = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
        assert len(out) == (4 if given else 0)


def test_mix_leaves_its_schedule(spark):
    """A hot source: slots by a step-by-step scheduler over what the stages before let through."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("source", F.expr("if(doc_id % 4 > 0, 'src1', source)"))
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), docs.schema)
    docs = docs.withColumn("text", F.repeat("text", 60))  # long enough for several blocks
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, "")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    hand, _, _ = mix_by_hand(rows, mixing.WEIGHTS, mixing.BLOCK_CHARS)
    got = corpus_pipeline.mix_schedule(spark).collect()
    assert {r.doc_id: (r.mix_source, r.block, r.slot) for r in got} == hand and len(got) == len(rows) == mixed.count()
    assert max(r.block for r in got) > 0 and len({r.slot for r in got}) > len({r.mix_source for r in got})


def test_tokens_come_in_the_order_of_the_mix(spark, library):  # noqa: F811
    """The mix decides in which order the last stage returns its rows, also of ids that come twice or are null."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, f"w{i} " * 30_000, "en", f"src{i % 3}", 9) for i in range(24)] + [(5, "a", "en", "src9", 1), (None, "b", "en", None, 1)]
    docs = spark.createDataFrame(rows, schema)
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, "").collect()
    slot = {}
    for r in corpus_pipeline.mix_schedule(spark).collect():
        slot[r.doc_id] = min(r.slot, slot.get(r.doc_id, r.slot))
    out = corpus_pipeline.STAGES[4][1](spark, spark.createDataFrame(sorted(mixed, key=lambda r: r.text), schema), "").collect()
    key = lambda i: (slot[i], hashlib.md5(("" if i is None else str(i)).encode()).hexdigest())
    got = [r.doc_id for r in out]
    assert got == sorted((r[0] for r in rows), key=key) and len({slot[i] for i in got}) > 3


@pytest.mark.parametrize("without", ["corpus_pipeline.py", "tagloom/llm"])
def test_entry_imports_without_this_package(tmp_path, without):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/{name}", tmp_path / name)
    shutil.copytree(f"{ROOT}/tagloom", tmp_path / "tagloom", ignore=shutil.ignore_patterns("__pycache__"))
    gone = tmp_path / "gone"
    (tmp_path / without).rename(gone)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 136 and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
