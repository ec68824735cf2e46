"""Exact and near duplicates, components, and mixing."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from weekfold.llm import exact_dedup, minhash, mixing
from weekfold.llm.components import components
from weekfold.session import settle


def test_misra_gries_keeps_what_is_frequent():
    random.seed(1)
    counts = Counter({f"d{i}": n for i, n in enumerate([500, 300, 90, *[1] * 200])})
    kept = exact_dedup._shrink(counts, 10)
    assert {"d0", "d1", "d2"} <= set(kept) and len(kept) <= 10
    assert all(counts[d] - sum(counts.values()) / 11 <= n <= counts[d] for d, n in kept.items())


@pytest.mark.parametrize("counters", [1024, 2])
def test_duplicate_report(llm, odd_docs, odd_rows, counters):
    rows = exact_dedup.duplicate_report(odd_docs, counters=counters).collect()
    groups = defaultdict(list)
    for d, t, _ in odd_rows:
        groups[t or ""].append(d)
    assert len(rows) == len(odd_rows)
    kept = Counter()
    for r in rows:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        ids = [d for d in groups[text] if d is not None]
        assert r.keep_id == max(ids, default=None) and r.group_size == len(groups[text])
        kept[text] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_whole_rows_without_duplicates(odd_docs, no_docs, odd_rows):
    for counters in (1024, 2):
        left = exact_dedup.without_duplicates(odd_docs, counters=counters)
        assert left.columns == odd_docs.columns
        assert sorted((r.text or "") for r in left.collect()) == sorted({t or "" for _, t, _ in odd_rows})
    assert exact_dedup.without_duplicates(no_docs).count() == 0
    assert exact_dedup.duplicate_report(no_docs).count() == 0


def test_components_of_chains_stars_and_loops(llm):
    random.seed(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (9, 8), (8, 9)]
    links += [(random.randrange(1000, 1200), random.randrange(1000, 1200)) for _ in range(120)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = dict(map(tuple, components(llm.createDataFrame(links, "a long, b long")).collect()))
    assert got == {x: root(x) for x in parent if x != 7}
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, words):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return frozenset()
    n = min(words, len(found))
    return frozenset(tuple(found[i:i + n]) for i in range(len(found) - n + 1))


def brute_components(rows, words):
    sets = [(d, shingles(t, words)) for d, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and None not in (sets[i][0], sets[j][0]) and 100 * len(a & b) >= 80 * len(a | b):
            parent[root(j)] = root(i)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(s), least.get(root(i)) if d is not None else None) for i, (d, s) in enumerate(sets)]


def variants(rng, count):
    """Texts of a few families: chains of edits, so that families hold indirect links."""
    out = []
    for family in range(count):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 30, 80, 200]))]
        for _ in range(rng.randint(1, 9)):
            base = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(base) // 20])):
                base[rng.randrange(len(base))] = f"e{rng.randrange(10_000)}"
            out.append(" ".join(base))
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_against_all_pairs(llm, words):
    texts = variants(random.Random(words), 45)
    rows = [(i * 3 % 1009, t) for i, t in enumerate(texts)]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs, words=words).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(brute_components(rows, words))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_near_duplicates_in_large_buckets(llm, seed):
    """Bands of one value: families that are no neighbours share buckets and hubs; links between members count."""
    rng = random.Random(seed)
    texts = []
    base = [f"w{k}" for k in range(60)]
    for _ in range(6):
        family = list(base)
        for i in rng.sample(range(60), rng.choice([4, 6, 8, 12])):
            family[i] = f"f{rng.randrange(99)}"
        for _ in range(rng.randint(3, 9)):
            member = list(family)
            for i in rng.sample(range(60), rng.choice([0, 1, 2, 3])):
                member[i] = f"m{rng.randrange(999)}"
            texts.append(" ".join(member))
    rows = list(enumerate(texts))
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs, words=1, bands=12, rows=1).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(brute_components(rows, 1))


def test_pairs_of_two_clusters_do_not_grow_with_their_square(llm, monkeypatch):
    """Two clusters of n near copies each, 36 of 300 words apart, a word of noise in each text."""
    made = {}
    whole = minhash._candidates

    def counted(*args):
        out = whole(*args)
        made[counted.n] = out.count()
        return out

    monkeypatch.setattr(minhash, "_candidates", counted)
    for n in (50, 200):
        counted.n = n
        rng = random.Random(n)
        one = [f"w{rng.randrange(5000)}" for _ in range(300)]
        other = list(one)
        for i in rng.sample(range(300), 36):
            other[i] = f"x{rng.randrange(5000)}"
        rows = []
        for k in range(2 * n):
            text = list((one, other)[k % 2])
            text[rng.randrange(300)] = f"n{k}"
            rows.append((k, " ".join(text)))
        got = minhash.near_duplicates(llm.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sum(r.kept for r in got) == 2
    assert made[200] <= 4 * max(made[50], 10)


def test_near_duplicates_on_odd_rows(odd_docs, no_docs, odd_rows):
    got = minhash.near_duplicates(odd_docs, words=2).collect()
    want = brute_components([(d, t) for d, t, _ in odd_rows], 2)
    assert sorted(map(str, (tuple(r)[:3] for r in got))) == sorted(map(str, want))
    assert all(r.kept for r in got if r.doc_id is None)
    left = minhash.without_near_duplicates(odd_docs, words=2)
    assert left.columns == odd_docs.columns
    assert Counter(str(r.doc_id) for r in left.collect()) == Counter(
        {"1": 1, "3": 1, "4": 1, "None": 2, "5": 1, "7": 2, "8": 1, "9": 1}
    )
    assert minhash.near_duplicates(no_docs).count() == 0


def test_min_and_max_come_from_one_evaluation():
    signer = minhash.Signer(4, 3)
    assert len(signer.xor) == 6
    low, high = signer.extremes(minhash.Shingler(1).shingles("a b c d"))
    assert (low <= high).all() and len(low) == 6


def shares(sizes, weights, share, most):
    """The targets as the words say it: share by weight, cap, share the excess anew."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    total = share * sum(sizes.values())
    target, opened = dict.fromkeys(names, 0.0), {s for s in names}
    rest = total
    while rest > 1e-9 and opened:
        heft = sum(weight[s] for s in opened)
        for s in opened:
            target[s] += rest * weight[s] / heft
        rest = 0.0
        for s in sorted(opened, key=str):
            if target[s] >= most * sizes[s]:
                rest += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                opened = opened - {s}
    return target


def test_targets_and_mixture(llm):
    rng = random.Random(6)
    rows = [
        (i, " ".join(["w"] * rng.choice([1, 5, 20, 200])), rng.choice(["a"] * 30 + ["b", "c", "d", "e", None]))
        for i in range(1500)
    ]
    docs = llm.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixture(docs).collect()
    sizes = Counter()
    for r in got:
        sizes[r.source] += r.size
    want = shares(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.MOST)
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 100.5  # half of the longest text
    again = mixing.mixture(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = mixing.mixed_rows(docs).collect()
    copies = Counter(r.doc_id for r in mixed)
    assert all(copies[r.doc_id] * r.size == r.taken for r in got)


def test_weights_change_who_is_drawn(llm):
    rows = [(i, "a b c d", "s", 9.0 if i % 2 else 1.0) for i in range(2000)] + [(5000, "x", "t", 1.0)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, source string, worth double")
    got = mixing.mixture(docs, share=0.4, most=1.0, weight="worth").collect()
    odd = sum(r.taken > 0 for r in got if r.doc_id % 2)
    even = sum(r.taken > 0 for r in got if not r.doc_id % 2)
    assert odd > 5 * even
    assert abs(sum(r.taken for r in got) - 0.4 * 8001) < 10


def test_documents_are_drawn_as_often_as_their_chances_say(llm):
    rng = random.Random(1)
    sizes = [rng.choice([2, 40, 300, 2000]) for _ in range(400)]
    docs = llm.createDataFrame([(i, " ".join(["w"] * n), "s") for i, n in enumerate(sizes)], "doc_id long, text string, source string")
    docs = settle(docs, "test-docs")
    share = 0.6
    weight = [1000 * n // (n + mixing.TYPICAL) for n in sizes]
    mean = sum(w * n for w, n in zip(weight, sizes)) / sum(sizes)
    chance = [share + min(share, 1 - share) * (w - mean) / 1000 for w in weight]
    assert all(0 < c < 1 for c in chance)
    assert sum(c * n for c, n in zip(chance, sizes)) == pytest.approx(share * sum(sizes))
    drawn = Counter()
    for seed in range(12):
        got = mixing.mixture(docs, share=share, most=1.0, seed=f"s{seed}").collect()
        for r in got:
            drawn[r.size] += r.taken > 0
        assert abs(sum(r.taken for r in got) - share * sum(sizes)) <= 1000.5
    for n in (2, 40, 300, 2000):
        trials = 12 * sizes.count(n)
        own = chance[sizes.index(n)]
        assert abs(drawn[n] / trials - own) < 4 * (own * (1 - own) / trials) ** 0.5 + 0.01
    assert chance[sizes.index(2000)] > 1.5 * chance[sizes.index(2)]


def test_a_source_at_its_cap_has_no_cut_and_slices_are_even(llm):
    docs = llm.range(3000).selectExpr("id as doc_id", "'some few words' as text", "'s' || id % 3 as source")
    rows = settle(mixing._measured(docs, "doc_id", "text", "source", "mix", None).select(*mixing._NEEDED), "test-mix")
    plan = {r.source: r for r in mixing.sampling_plan(rows).collect()}
    capped = [r for r in plan.values() if r.missing == 0]
    assert capped and all(r.has_cut is None and r.whole == mixing.MOST for r in capped)
    assert any(r.has_cut for r in plan.values())
    for missing in (1.0, 4500.0, 8999.0):  # a small, an even and a large chance
        drawn = rows.selectExpr("*", f"{missing}d as missing", "9000L as source_size", "1.0d as mean_weight")
        sizes = drawn.groupBy(mixing._slice().alias("slice")).count().select("count").collect()
        assert max(r[0] for r in sizes) < 20


def test_mixture_on_odd_rows(odd_docs, no_docs, odd_rows):
    got = mixing.mixture(odd_docs).collect()
    assert len(got) == len(odd_rows)
    assert all(r.size == len(re.findall(r"[^\x20\x09-\x0D]+", next(
        t or "" for d, t, _ in odd_rows if d == r.doc_id and len((t or "").split()) == r.size
    ))) for r in got)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert mixing.mixed_rows(odd_docs).columns == odd_docs.columns
    assert mixing.mixture(no_docs).count() == 0 and mixing.mixed_rows(no_docs).count() == 0
