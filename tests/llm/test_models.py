"""Learned operators: toxicity, quality, main text; and exact search."""

import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekfold.llm import html_text, quality, toxicity
from weekfold.llm.html_blocks import blocks
from weekfold.llm.lexicon import Filter, Trie, matches
from weekfold.llm.topk import BallTree, top_k
from weekfold.session import settle


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_and_filter_against_plain_distance():
    random.seed(1)
    terms = {"".join(random.choices("abc", k=random.randint(5, 8))) for _ in range(60)}
    trie, fits = Trie(terms), Filter(terms)
    for _ in range(2000):
        word = "".join(random.choices("abcd", k=random.randint(5, 9)))
        want = {t for t in terms if distance(word, t) <= 1}
        assert set(matches(word, trie)) == want
        assert fits.may_match(word) or not want


def swap_distance(a, b):
    """Distance in which two neighbouring letters in each other's place are one edit."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(rows[-1][j] + 1, new[-1] + 1, rows[-1][j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                new[-1] = min(new[-1], rows[-2][j - 2] + 1)
        rows.append(new)
    return rows[-1][-1]


@pytest.mark.parametrize("edits, shortest, longest", [(1, 4, 9), (2, 10, 13)])
def test_swaps_and_two_edits_against_plain_distance(edits, shortest, longest):
    rng = random.Random(edits)
    terms = sorted({"".join(rng.choices("abc", k=rng.randint(shortest, longest))) for _ in range(50)})
    trie, fits = Trie(terms), Filter(terms, edits)
    for _ in range(1000):
        word = rng.choice(terms)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(1, len(word))
            word = rng.choice([
                word[:i] + rng.choice("abcd") + word[i:], word[:i] + word[i + 1:],
                word[:i - 1] + rng.choice("abcd") + word[i:], word[:i - 1] + word[i] + word[i - 1] + word[i + 1:],
            ])
        want = {t: n for t in terms if (n := swap_distance(word, t)) <= edits}
        assert matches(word, trie, edits, swaps=True) == want
        assert fits.may_match(word) or not want


@pytest.mark.parametrize("word, want", [
    ("dsgustng", ("disgusting", 2)), ("diisgusttingg", None), ("pahtetic", ("pathetic", 1)),
    ("scmu", ("scum", 1)), ("skum", ("scum", 1)), ("scm", ("scum", 1)), ("stpd", None), ("mild", None),
])
def test_misspelled_terms_by_their_length(word, want):
    terms = {"disgusting": 7.0, "pathetic": 6.0, "scum": 5.0, "stupid": 4.0, "mildew": 3.0}
    got = toxicity.Matcher({(t, False): w for t, w in terms.items()}).look_up(word)
    if want is None:
        assert got is None
    else:
        assert got == (pytest.approx(0.6 ** want[1] * terms[want[0]]), want[1], want[0])


def test_misspelled_terms_of_low_weight_count():
    lexicon = {("pathetic", False): 6.0, ("scum", False): 5.0}
    matcher = toxicity.Matcher(lexicon, {("pathetic", 1): 0.5, ("scum", 1): 0.0})
    assert matcher.hits(["pathetik", "skum", "scum"]) == [(0, 0.5, 1, "pathetic"), (2, 5.0, 0, "scum")]


@pytest.mark.parametrize("text, want", [
    ('you fool', False), ('he said "you fool" to us', True), ('"a" fool "b"', False), ('"a\nfool"', False),
    ('"' + "so it was " * 40 + "fool" + " and on" * 60 + '"', True),  # a quotation of over 200 characters
    ('"' + "so it was " * 40 + '" you fool, "he"', False),  # a window would begin inside the first one
    ("it’s a fool’s game, isn’t it", False), ("‘you fool’ it’s", True),
    ("no\n" * 50 + '"one" and "a fool"\n"', True),
])
def test_quotation_on_whole_lines(text, want):
    at = text.index("fool")
    assert toxicity._quoted(text, [(at, at + 4)]) == [want]
    every = [(m.start(), m.end()) for m in toxicity._WORD.finditer(text)]
    assert toxicity._quoted(text, every)[every.index((at, at + 4))] == want


def insults(rng, n):
    """Texts of common words; toxic ones with terms of a small lexicon."""
    common = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit", "ame") for b in ("um", "or", "et", "is", "ad")]
    rows = []
    for i in range(n):
        words = rng.choices(common, k=rng.randint(20, 60))
        toxic = int(rng.random() < 0.3)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["fleabag", "nitwit", "muppet"]))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_toxicity_on_held_out_rows(llm):
    rows = insults(random.Random(3), 800)
    docs = llm.createDataFrame([r[:2] for r in rows] + [(9000, "sit dolor you fleabagg and nitwwit"), (9001, None), (9001, ""), (None, "amead")],
                               "doc_id long, text string")
    labels = llm.createDataFrame([(r[0], 1, r[2]) for r in rows] + [(None, 1, 1), (5, 1, None)],
                                 "doc_id long, quality int, toxic int")
    got = settle(toxicity.toxicity(docs, labels), "toxic").collect()
    assert len(got) == 804
    truth = {r[0]: r[2] for r in rows}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    misspelled = next(r for r in got if r.doc_id == 9000)
    clean = [r.score for r in got if r.doc_id is None or (r.doc_id in truth and not truth[r.doc_id])]
    assert misspelled.score > max(clean)
    # labels of held-out rows change nothing
    turned = llm.createDataFrame(
        [(r[0], 1, 1 - r[2] if zlib.crc32(str(r[0]).encode()) % 4 == 2 else r[2]) for r in rows],
        "doc_id long, quality int, toxic int",
    )
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs, turned).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score) for r in got if r.doc_id not in (9001, None))


def test_toxicity_on_odd_rows(llm, odd_docs, no_docs, odd_rows):
    labels = llm.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(odd_docs, labels).count() == len(odd_rows)
    assert toxicity.toxicity(odd_docs, labels.limit(0)).count() == len(odd_rows)
    assert toxicity.toxicity(no_docs, labels).count() == 0


@pytest.mark.parametrize("page, want", [
    ("<p>a</p><svg><p>b</p>", ["a", "b"]), ("<select><option>x<p>b", ["x", "b"]),
    ("<p>a</p><script>b<p>c", ["a"]), ("<p>a</p><video src=x><p>b</video><p>c", ["a", "c"]),
    ("<head><title>t</title><meta x><div>a</div>", ["a"]), ("<html><head><link x>plain <b>text</b>", ["plain text"]),
    ("<head><title>a <b>t</b></title><style>s</style></head><p>b", ["b"]),
    ("<head><svg></svg><p>b", ["b"]), ("<head><title>t</title>\n<br>a", ["a"]),
])
def test_unclosed_heads_and_unseen_elements_keep_the_page(page, want):
    assert [b.text for b in blocks(page)] == want


def test_shape_of_a_whole_word():
    assert quality.Hasher.shape("ab-" * 30 + "77Z") == "a-" * 30 + "9A"


def quality_rows(rng, n):
    vocabulary = ["".join(rng.choices("aeiounrst", k=rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(40, 120))]
        text = ". ".join(" ".join(words[j:j + 9]).capitalize() for j in range(0, len(words), 9)) + "."
        fault = rng.choice(["", "", "", "", "signs", "shout", "echo", "bars"])
        if fault == "signs":
            text = " ".join(w + rng.choice(["###", "%%%"]) for w in words)
        elif fault == "shout":
            text = " ".join(w.upper() + "!!" for w in words)
        elif fault == "echo":
            text = " ".join(w for w in words[:8] for _ in range(9))
        elif fault == "bars":
            text = " | ".join(words)
        rows.append((i, text, fault))
    return rows


def test_quality_without_any_labels(llm):
    rows = quality_rows(random.Random(4), 600)
    docs = llm.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    wrong = [i for i, _, fault in rows if got[i].kept == bool(fault)]
    assert len(wrong) <= 3
    assert not [i for i in wrong if not rows[i][2]]  # no clean text goes
    left = quality.good_rows(docs)
    assert {r.doc_id for r in left.collect()} == {i for i, r in got.items() if r.kept}


def test_vote_model_finds_who_is_right():
    good, bad = "+" * 12, "--" + "+" * 10
    model = quality.VoteModel({good: 800, bad: 150, "-" + "+" * 11: 20, "0" * 12: 30})
    assert model.posterior(good) > 0.95 > 0.3 > model.posterior(bad)
    assert 0 < model.posterior("0" * 12) < 1
    assert quality.VoteModel({}).posterior(good) > 0.5


def test_quality_on_odd_rows(odd_docs, no_docs, odd_rows):
    got = quality.quality(odd_docs).collect()
    assert len(got) == len(odd_rows)
    assert all(r.score == 0 and not r.kept for r in got if r.doc_id in (3, 4, 8))
    assert quality.good_rows(odd_docs).columns == odd_docs.columns
    assert quality.quality(no_docs).count() == 0 and quality.good_rows(no_docs).count() == 0


@pytest.mark.parametrize("page, want", [
    ("plain  text &amp; more", ["plain text & more"]),
    ("<p>a<p>b<li>c", ["a", "b", "c"]),
    ("<p>x <b>y<br>z</p> w", ["x y z", "w"]),
    ("<script>var a='</p>';</script><p>ok<!-- no <p> -->!", ["ok !"[:2] + "!"]),
    ("<div class='a > b'>t</div>", ["t"]),
    ("<a href=\"x>broken</a> tail", ["broken tail"]),
    ("<title>t</title><body>&lt;b&gt; &copy;", ["<b> ©"]),
    ("", []),
    ("<style>p{}</style", []),
])
def test_blocks(page, want):
    assert [b.text for b in blocks(page)] == want


def site(rng, i, container):
    """A page with a known main text; ``container`` is the opening tag around it."""
    def say(n):
        return " ".join("".join(rng.choices("aeiounrst", k=rng.randint(2, 8))) for _ in range(n)).capitalize() + "."

    body = [say(rng.randint(12, 60)) for _ in range(rng.randint(2, 6))]
    menu = "".join(f"<li><a href='/{k}'>{say(1)}</a></li>" for k in range(5))
    close = container.split()[0].strip("<>")
    html = (
        f"<html><head><title>{say(3)}</title></head><body><nav><ul>{menu}</ul></nav><div class='ad'>{say(6)}</div>"
        f"{container}" + "".join(f"<p>{b}</p>" for b in body) + f"</{close}>"
        f"<div class='comments'><p>{say(9)}</p></div><footer>&copy; {say(3)}</footer></body></html>"
    )
    return i, f"http://x/{i}", html, " ".join(body)


def test_main_text_of_known_pages(llm):
    rng = random.Random(5)
    made = [site(rng, i, "<article>") for i in range(120)]
    made += [site(rng, 200 + i, "<div class='post-content'>") for i in range(20)]
    pages = llm.createDataFrame(
        [(*m[:3], "x") for m in made] + [(900, None, None, "x"), (901, "u", "", "x"), (901, "u", "", "x")],
        "page_id long, url string, html string, text string",
    )
    rows = html_text.main_text(pages).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == 143 and got[900].text == "" and got[901].n_chars == 0
    assert all(r.n_chars == len(r.text) for r in rows)
    right = [got[m[0]].text == m[3] for m in made]
    assert all(right[:120]) and sum(right[120:]) >= 18
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_lstm_gradients_are_right():
    rng = np.random.default_rng(2)
    model = html_text.Labeller()
    x = rng.standard_normal((5, 2, html_text.WIDTH)).astype(np.float32)
    mask = np.array([[1, 1], [1, 1], [1, 1], [1, 0], [1, 0]], np.float32)
    y = rng.integers(0, 2, (5, 2)).astype(np.float32)

    def loss():
        p = model.forward(x, mask)[0].astype(np.float64)
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    grad = model.gradients(x, mask, y)
    for name in ("fh", "bx", "fb", "in", "out"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        before = model.w[name][at]
        model.w[name][at] = before + 1e-2
        up = loss()
        model.w[name][at] = before - 1e-2
        slope = (up - loss()) / 2e-2
        model.w[name][at] = before
        assert slope == pytest.approx(grad[name][at], rel=0.05, abs=1e-4)


def brute_top(rows, k, queries):
    out = []
    for q, v in rows:
        if q in queries:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, query_rows", [(10_000, 8192), (40, 3)])
def test_top_k_against_all_pairs(llm, shard_rows, query_rows):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-0.5, -0.25, 0.0, 0.25, 1.0]) for _ in range(6)]) for i in range(300)]
    frame = llm.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, vector string")
    got = top_k(frame, F.col("vec_id") % 20 == 0, 5, shard_rows=shard_rows, query_rows=query_rows).collect()
    whole = [(i, [int(256 * x // 1) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got)) == brute_top(whole, 5, set(range(0, 300, 20)))


def test_top_k_of_large_components(llm):
    """Products beyond 2^52 are exact; what no long can hold takes no part."""
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(-200_000, 200_000)) + rng.randrange(256) / 256 for _ in range(5)]) for i in range(120)]
    rows += [(200 + i, [v + (1 / 256 if k == i else 0) for k, v in enumerate(rows[1][1])]) for i in range(5)]
    frame = llm.createDataFrame([*rows, (400, [1e30] * 5), (401, [3e5] * 5)], "vec_id long, embedding array<double>")
    whole = [(i, [int(256 * x // 1) for x in v]) for i, v in rows]
    for shard_rows in (16, 1000):
        got = top_k(frame, F.col("vec_id") % 20 == 0, 5, shard_rows=shard_rows).collect()
        assert sorted(map(tuple, got)) == brute_top(whole, 5, {i for i, _ in rows if i % 20 == 0})
    assert max(abs(r.score) for r in got) > 2**52


def test_top_k_on_odd_vectors(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]),
            (5, []), (6, [0.5]), (50, [0.1, 0.1]), (7, [1.0, 1.0]), (8, [1.0, 1.0]), (None, [9.0, 9.0])]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_k(frame, F.col("vec_id") % 50 == 0, 5).collect()
    assert [tuple(r)[:3] for r in sorted(got)] == [(0, 1, 7), (0, 2, 8), (0, 3, 50), (50, 1, 0), (50, 2, 7), (50, 3, 8)]
    assert top_k(frame.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_ball_tree_opens_few_nodes_and_misses_nothing():
    rng = np.random.default_rng(3)
    centres = rng.integers(-200, 200, (20, 8))
    vectors = (centres[rng.integers(0, 20, 2000)] + rng.integers(-5, 6, (2000, 8))).astype(np.float64)
    tree = BallTree(np.arange(2000), vectors)
    for q in range(0, 2000, 97):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        best = sorted(zip(-scores, range(2000)))[:5]
        assert tree.search(q, vectors[q], 5, -np.inf) == [(int(-s), i) for s, i in best]
        assert tree.search(q, vectors[q], 5, -best[-1][0]) == [(int(-s), i) for s, i in best]


def test_words_looked_up_together_are_found_as_one_by_one():
    rng = random.Random(4)
    terms = ["disgusting", "worthless", "degenerate", "pathetic", "imbecile", "stupid", "moron", "scum", "naïveté"]
    lexicon = {(t, False): 3.0 for t in terms} | {("filth", True): 2.0}
    words = {"Filthy", "SCUM", "ﬁlth", "straße", "a"}
    for t in terms:
        for _ in range(400):
            w = list(t)
            for _ in range(rng.randint(1, 3)):
                i = rng.randrange(len(w))
                kind = rng.randrange(4)
                if kind == 3 and i:
                    w[i - 1:i + 1] = w[i - 1:i + 1][::-1]
                else:
                    w[i:i + 1] = [[], [rng.choice("abcxé")], [w[i], rng.choice("abcxé")]][kind % 3]
                if not w:
                    break
            words.add("".join(w).capitalize() if rng.random() < 0.3 else "".join(w))
    words.discard("")
    one, many = toxicity.Matcher(lexicon), toxicity.Matcher(lexicon)
    many.learn(words)
    assert many.found == {w: hit for w in words if (hit := one.look_up(w.lower())) is not None}
    assert len({e for _, e, _ in many.found.values()}) == 3
    # forgetting changes nothing
    few = toxicity.Matcher(lexicon)
    few.seen.update(str(i) for i in range(toxicity.SEEN_WORDS))
    assert few.hits(["Filthy", "no", "scum"]) == [(0, 2.0, 0, "filth"), (2, 3.0, 0, "scum")]


@pytest.mark.parametrize("piece", [
    "<svg>", "<a ", "<div>x", "<div><p>y</p>", '<a ">"', "<h1>", "<!--", "<", "<b><i></b>", "<li><td>", "</div><b>", "<x y='",
])
def test_odd_pages_of_a_megabyte_take_time_by_their_length(piece):
    page = piece * (1_000_000 // len(piece))
    begun = time.process_time()
    found = blocks(page)
    assert time.process_time() - begun < 6  # seconds; the square would take minutes
    assert all(b.path is None or b.path.depth <= 512 for b in found)
    if "x" in piece and "<x" not in piece:
        assert sum(len(b.text) for b in found) == page.count("x")


def test_vectors_of_deep_pages_keep_few_paths():
    page = blocks("<div class='a b'>x" * 3000)
    paths = html_text.PathVectors()
    rows = html_text.vectors(page, 0, len(page), paths)
    assert len(rows) == 3000 and len(paths.known) <= html_text.PathVectors.KEPT
    # the same as summing each path anew
    for i in (0, 1, 7, 300):
        alone = html_text.vectors(page, i, i + 1)
        assert (alone[0] == rows[i]).all()


def test_without_marked_pages_there_is_no_text(llm):
    pages = llm.createDataFrame(
        [(i, "u", f"<html><body><div><p>Some text number {i} of a page.</p></div></body></html>") for i in range(30)],
        "page_id long, url string, html string",
    )
    got = html_text.main_text(pages)
    assert got.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    assert {(r.text, r.n_chars) for r in got.collect()} == {("", 0)}


def test_the_sample_of_pages_does_not_depend_on_files(llm):
    rng = random.Random(8)
    made = [site(rng, i, "<article>")[:3] for i in range(40)] + [site(rng, 50 + i, "<div class='story'>")[:3] for i in range(20)]
    pages = llm.createDataFrame(made, "page_id long, url string, html string")
    one = html_text.main_text(pages.repartition(1), training_pages=25).collect()
    other = html_text.main_text(pages.repartition(7), training_pages=25).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, other))
