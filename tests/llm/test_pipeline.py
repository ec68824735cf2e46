"""The pipeline against plain Python, and the entry without it."""

import hashlib
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np

import corpus_pipeline
from tests.llm.test_copies import brute_components
from tests.llm.test_texts import reference  # noqa: F401
from weekfold.llm import mixing, quality
from weekfold.session import settle

ROOT = Path(__file__).resolve().parents[2]


def test_every_stage_does_its_work(llm, small, reference):  # noqa: F811
    docs = llm.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(llm, before, small), "test-stage")
        kept[name] = (before, after)
        assert name == "tokens" or after.columns == columns
        before = after

    first, good = kept["quality"]
    accepted = {r.doc_id for r in quality.quality(first).collect() if r.kept}
    assert sorted(r.doc_id for r in good.collect()) == sorted(accepted)
    labels = {r.doc_id: r.quality for r in llm.read.parquet(f"{small}/labels.parquet").collect()}
    assert all(labels.get(r.doc_id, 1) == 1 or r.doc_id not in accepted for r in first.collect())
    assert all(d in accepted for d, q in labels.items() if q == 1)

    distinct = kept["exact dedup"][1]
    largest = {}
    for r in good.collect():
        largest[r.text] = max(r.doc_id, largest.get(r.text, -1))
    assert sorted(r.doc_id for r in distinct.collect()) == sorted(largest.values())

    apart = kept["near dedup"][1]
    want = [d for d, _, c in brute_components([(r.doc_id, r.text) for r in distinct.collect()], 5) if d == c]
    assert sorted(r.doc_id for r in apart.collect()) == sorted(want)

    mixed = kept["mixing"][1].collect()
    plan = {r.doc_id: r.taken // max(r.size, 1) for r in mixing.mixture(apart).collect() if r.size}
    assert Counter(r.doc_id for r in mixed) == Counter({d: n for d, n in plan.items() if n})

    encoded = kept["tokens"][1].collect()
    texts = {r.doc_id: r.text for r in mixed}
    assert len(encoded) == len(mixed)
    for r in encoded:
        assert r.ids == reference.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_empty_documents_pass_through(llm, small):
    docs = llm.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(llm, docs, small), "test-empty")
    assert docs.count() == 0


def test_odd_rows_pass_through(llm, small, odd_docs, odd_rows):
    """Null ids, texts and sources, repeated rows, long texts and clashing columns: no stage fails or invents rows."""
    texts = {t or "" for _, t, _ in odd_rows}
    before = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(llm, before, small), "test-odd")
        if name == "tokens":
            assert after.count() == before.count()
            assert all(r.n_tokens == len(r.ids) for r in after.collect())
            break
        assert after.columns == odd_docs.columns
        rows = after.collect()
        assert all((r.text or "") in texts and r.digest == r.row == "x" for r in rows)
        if name == "exact dedup":
            assert len({r.text for r in rows}) == len(rows)
        elif name == "mixing":
            kept = Counter((r.doc_id, r.text) for r in before.collect())
            assert all(n <= 2 * kept[k] for k, n in Counter((r.doc_id, r.text) for r in rows).items())
        before = after


def test_entry_works_without_these_operators():
    code = (
        "import sys\n"
        "sys.modules['corpus_pipeline'] = None\n"
        "sys.modules['weekfold.llm'] = None\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 100 and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_entry_has_all_of_them():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} <= {q[: q.index("_") + 1] for q in names if q.startswith("op")}
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
