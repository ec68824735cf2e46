"""Spelling variants, fingerprints and centroid clusters against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from weekfold.llm import fingerprints as fp
from weekfold.llm import spelling
from weekfold.llm import zone_clusters as zc
from weekfold.llm.fm_index import VariantIndex


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


@pytest.mark.parametrize("seed", range(40))
def test_index_finds_every_word_one_edit_away_once(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 3 else "abcdéñ"

    def some(k, most):
        return {"".join(rng.choice(letters) for _ in range(rng.randint(1, most))) for _ in range(k)}

    words = some(rng.randint(1, 60), 9 if seed % 5 else 60)
    queries = sorted(some(30, 9) | set(list(words)[:10]) | {"zzz", "az", "z"})
    index = VariantIndex(list(words))
    for half in range(6):
        for side, find in ((0, index.left_exact), (1, index.right_exact)):
            own = [q for q in queries if (len(q) + side) // 2 == half]
            got = sorted((own[q], index.words[w]) for q, w in zip(*find(own, half)))
            want = sorted((q, w) for q in own for w in words if one_edit(q, w) and (
                w.endswith(q[len(q) - half:]) if side else w.startswith(q[:half])))
            assert got == want


def test_very_long_words():
    long = "ab" * 5000
    index = VariantIndex([long, long[:-1], "x" + long, "short"])
    found = {index.words[w] for f in (index.left_exact, index.right_exact) for w in f([long], 5000)[1]}
    assert found == {long[:-1], "x" + long}


def variants_of(counts, ratio=10):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def test_variants_equal_all_pairs(llm):
    rng = random.Random(5)
    counts = {}
    for stem in ("separate", "necessary", "accommodate", "prefixaaaa", "prefixbbbb", "éèêëàçñ"):
        counts[stem] = 5000
        for _ in range(40):
            w = list(stem)
            for _ in range(rng.randint(1, 2)):
                i = rng.randrange(len(w))
                kind = rng.randrange(3)
                w[i:i + 1] = [[], [rng.choice("abcé")], [w[i], rng.choice("abcé")]][kind]
            if w:
                counts.setdefault("".join(w), rng.choice((2, 3, 40, 400)))
    words = llm.createDataFrame([(w, n, "x", "y") for w, n in counts.items()], "word string, n long, form string, root string")
    # groups so small that most are split
    got = spelling.spelling_variants(words, group_chars=60, most_chars=80)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()} == variants_of(counts)
    assert any(v[1] != (v[0] or k) for k, v in variants_of(counts).items())  # chains of more than one step


def test_vocabulary(llm, odd_docs, no_docs, odd_rows):
    got = {r.word: r.n for r in spelling.vocabulary(odd_docs, min_length=3, drop_every=2).collect()}
    want = Counter()
    for doc_id, text, _ in odd_rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 2 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += 1
    assert got == {w: n for w, n in want.items() if n >= 2 and len(w) >= 3}
    assert spelling.spelling_variants(spelling.vocabulary(no_docs)).count() == 0
    odd = llm.createDataFrame([(None, 5), ("", 5), ("a", 3), ("a", 4), ("b", 100)], "word string, n long")
    rows = {r.word: (r.form, r.n, r.n_near) for r in spelling.spelling_variants(odd).collect()}
    assert rows == {"a": ("b", 7, 1), "b": (None, 100, 1)}


# --- fingerprints -----------------------------------------------------------------------
def test_fingerprints_are_sums_of_paragraphs():
    text = "first paragraph\nsecond one\n\nsecond one\n" + "a long one " * 100
    pieces = text.split("\n")
    whole = fp.Fingerprint.of(text)
    shuffled = pieces[:]
    random.Random(1).shuffle(shuffled)
    assert str(fp.Fingerprint.of("\n".join(shuffled))) == str(whole)
    grown = fp.Fingerprint()
    for p in pieces:
        grown.add([p])
    assert str(grown) == str(whole)
    grown.add(["something else"])
    assert str(grown) != str(whole)
    grown.add(["something else"], -1)
    assert str(grown) == str(whole) and str(fp.Fingerprint.parse(str(whole))) == str(whole)
    # how often a paragraph occurs matters
    assert len({str(fp.Fingerprint.of(t)) for t in ("", "\n", "\n\n", "a", "a\na", "a\na\na")}) == 6


def test_likeness_follows_what_is_shared():
    rng = random.Random(2)
    lines = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(12)) for _ in range(80)]
    whole = fp.Fingerprint.of("\n".join(lines))
    last = 1.0
    for kept in (70, 55, 40, 25, 10):
        other = fp.Fingerprint.of("\n".join(lines[:kept] + [x[::-1] for x in lines[kept:]]))
        assert abs(whole.likeness(other) - kept / 80) < 0.25 and whole.likeness(other) < last
        last = whole.likeness(other)
    assert whole.likeness(fp.Fingerprint.of("\n".join(lines[::-1]))) == 1.0


def expected_prints(rows):
    known = sorted((d, t or "") for d, t, _ in rows if d is not None)
    pairs = [(d, t, known[(i + 1) % len(known)][1]) for i, (d, t) in enumerate(known)]
    pairs += [(None, t or "", "") for d, t, _ in rows if d is None]
    out = []
    for d, t, following in pairs:
        edited = fp.edited_text(t, following)
        a, b, c = (fp.Fingerprint.of(x) for x in (t, edited, following))
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), str(a), str(b), a.likeness(b), a.likeness(c)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("span", [1, 3, 1000])
def test_fingerprints_of_a_table(llm, odd_docs, no_docs, odd_rows, span):
    got = sorted((tuple(r) for r in fp.fingerprints(odd_docs, span=span).collect()), key=repr)
    assert got == expected_prints(odd_rows)
    if span == 3:
        assert fp.fingerprints(no_docs).count() == 0
        alone = odd_docs.where("doc_id = 3")
        assert [tuple(r) for r in fp.fingerprints(alone).collect()] == expected_prints([odd_rows[3]])


def test_fingerprints_of_the_small_table(llm, small):
    docs = llm.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text, None) for r in docs.select("doc_id", "text").collect()]
    got = fp.fingerprints(docs.repartition(7), span=10).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected_prints(rows)
    edited = [r.near_edited for r in got if r.n_chars >= 200]
    assert np.mean(edited) > 0.65 and np.mean([r.near_next for r in got]) < 0.2


def plain_counts(paragraph):
    """Signed counts of different runs, one run after the other."""
    every, odd = 2 ** 64, 0x9E3779B97F4A7C15
    out = [0] * fp.COUNTS
    for at in range(0, max(len(paragraph) - fp.GRAM + 1, 1) if paragraph else 0, fp.SLICE):
        part = paragraph[at:at + fp.SLICE + fp.GRAM - 1]
        width, found = min(fp.GRAM, len(part)), set()
        for i in range(len(part) - width + 1):
            h = width
            for c in part[i:i + width]:
                h = (h * odd + ord(c)) % every
            found.add((h ^ h >> 32) * odd % every >> 8)
        for h in found:
            place = h % (2 * fp.COUNTS)
            out[place % fp.COUNTS] += 1 if place < fp.COUNTS else -1
    return out


@pytest.mark.parametrize("block", [1, 100, 1 << 15])
def test_runs_are_counted_once_in_each_paragraph(monkeypatch, block):
    monkeypatch.setattr(fp, "SLICE", 60)
    monkeypatch.setattr(fp, "BLOCK", block)
    rng = random.Random(block)
    paragraphs = ["", "a", "é\U0001f600", "1234567", "12345678", "x" * 500] + [
        "".join(rng.choice("abé\U0001f600") for _ in range(rng.choice((0, 3, 30, 66, 67, 68, 300)))) for _ in range(60)
    ]
    hashed = fp.Paragraphs(paragraphs)
    got = [hashed.lanes(i, i + 1) for i in range(len(paragraphs))]
    assert [x[fp.EXACT:].astype(np.int32).tolist() for x in got] == [plain_counts(p) for p in paragraphs]
    assert [x[:fp.EXACT].tobytes() for x in got] == [hashlib.shake_128(p.encode()).digest(4 * fp.EXACT) for p in paragraphs]
    assert (hashed.lanes() == np.sum(got, axis=0, dtype=np.uint32)).all()


def test_an_edit_hashes_cut_paragraphs_only(monkeypatch):
    rng = random.Random(4)
    texts = ["\n".join(f"{rng.random()} and {rng.random()}" for _ in range(100)) for _ in range(30)]
    hashed, shake = [], hashlib.shake_128
    monkeypatch.setattr(fp.hashlib, "shake_128", lambda x: (hashed.append(x), shake(x))[1])
    frame = pd.DataFrame([(0, False, i, t) for i, t in enumerate(texts)], columns=["span", "guest", "doc_id", "text"])
    got = pd.concat(list(fp._with_next(iter([frame[:7], frame[7:]]))))
    assert len(hashed) <= 102 * len(texts)
    monkeypatch.undo()
    want = expected_prints([(i, t, None) for i, t in enumerate(texts)])
    assert sorted(got.itertuples(index=False, name=None), key=repr) == [r for r in want if r[0] != len(texts) - 1]


# --- clusters ---------------------------------------------------------------------------
@pytest.mark.parametrize("axes,bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_the_curve_moves_by_one_cell(axes, bits):
    cells = np.array(list(itertools.product(range(2 ** bits), repeat=axes)))
    keys = zc.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def expected_clusters(rows, k, rounds, dimensions, scale=64):
    kept = []
    for i, v in rows:
        if v is None or len(v) != dimensions or any(x is None or not np.isfinite(x) or abs(x * scale) >= 2 ** 27 for x in v):
            continue
        kept.append((i, [int(np.floor(x * scale)) for x in v]))
    by_hash = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    points = [list(v) for _, v in by_hash[:k]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points)) for _, v in kept]

    for _ in range(rounds):
        own = nearest()
        for c in range(len(points)):
            members = [v for (_, v), (_, o) in zip(kept, own) if o == c]
            if members:
                points[c] = [sum(x) // len(members) for x in zip(*members)]
    own = nearest()
    inertia = Counter()
    for d, c in own:
        inertia[c] += d
    return sorted(((i, c, d, inertia[c], sum(inertia.values()),
                    hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, own)), key=repr)


def test_clusters_equal_brute_force(llm):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] + 0.2 * rng.normal(size=8)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # a vector that many rows have
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (2000, [1e5] * 8), (2001, [-1e5] * 8)]
    rows += [(3000, None), (3001, [1.0] * 7), (3002, [float("nan")] * 8), (3003, [None] * 8), (3004, [1e30] * 8), (3005, [])]
    df = llm.createDataFrame([(*r, 1, 2, "c") for r in rows], "vec_id long, embedding array<double>, cluster int, distance int, n string")
    for k, block in ((5, 16), (16, 3), (1, 64)):
        got = zc.clusters(df.repartition(5), k=k, dimensions=8, block_rows=block)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == expected_clusters(rows, k, 3, 8)
    few = df.where("vec_id in (7, 8, 9)")
    assert sorted((tuple(r) for r in zc.clusters(few, dimensions=8).collect()), key=repr) == expected_clusters(rows[7:10], 16, 3, 8)
    assert zc.clusters(df.limit(0)).count() == 0
    assert zc.clusters(df.limit(0)).columns == got.columns


def test_boxes_leave_out_only_what_cannot_be_nearest():
    rng = np.random.default_rng(1)
    middles = rng.integers(-50, 50, size=(20, 8))
    vectors = middles[rng.integers(20, size=500)] + rng.integers(-6, 7, size=(500, 8))
    axes = zc.Axes(vectors.astype(float), 3)
    centroids = zc.Centroids(middles.tolist(), axes)
    order = np.argsort(axes.keys(vectors.astype(float)))
    left = 0
    for at in range(0, 500, 10):
        block = vectors[order[at:at + 10]]
        along = block @ axes.turn
        among = centroids.candidates(along.min(axis=0), along.max(axis=0))
        left += len(among)
        whole, far = centroids.assign(block, np.arange(20))
        some, near = centroids.assign(block, among)
        assert (whole == some).all() and (far == near).all()
    assert left < 0.5 * 50 * 20
