"""Near duplicates of texts and of vectors, repeated lines, components."""

import collections
import itertools
import random

import numpy as np
import pytest

from inkplane.llm import embeddings, graphs, line_dups, near_dups
from inkplane.llm import _shared
from inkplane.llm._shared import Scratch


def union_find(ids, links):
    label = {i: i for i in ids}
    for a, b in links:
        low, high = sorted((label[a], label[b]))
        label = {k: low if v == high else v for k, v in label.items()}
    return label


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000)] + [(9000, 9000 + i) for i in range(1, 50)]
    got = {r.node: r.component for r in graphs.components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t")).collect()}
    want = union_find({x for l in links for x in l}, links)
    assert got == {k: v for k, v in want.items() if k != 5000}
    assert graphs.components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


# Near duplicates.


def sets_of(docs, k):
    out = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    return out


def brute(docs, k, percent=80):
    s = sets_of(docs, k)
    links = [(a, b) for a, b in itertools.combinations(sorted(s), 2) if s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b])]
    return s, union_find(s, links)


def near_corpus(seed):
    """Groups of copies with few to many changes, texts round a shared passage, and unrelated ones."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    docs, i = [], 0
    passage = [word() for _ in range(60)]
    for _ in range(6):
        base = [word() for _ in range(rnd.choice([20, 80, 150]))]
        for _ in range(rnd.choice([3, 40])):
            t = list(base)
            for _ in range(rnd.randint(0, max(1, len(t) // 10))):
                t[rnd.randrange(len(t))] = word()
            docs.append((i := i + 1, " ".join(t)))
            if rnd.random() < 0.2:
                docs.append((i := i + 1, " ".join(t)))
    for _ in range(40):
        docs.append((i := i + 1, " ".join(passage + [word() for _ in range(rnd.choice([2, 6, 10, 40]))])))
    docs += [(i + 1, "Same  WORDS"), (i + 2, "same words"), (i + 3, "same words"), (i + 4, ""), (i + 5, None), (i + 6, " \t\n"), (i + 7, "a" * 20000), (i + 8, "a b " * 9000)]
    rnd.shuffle(docs)
    return docs


@pytest.mark.parametrize(("seed", "k"), [(1, 2), (2, 5), (3, 2)])
def test_near_duplicates(spark, seed, k):
    docs = near_corpus(seed)
    s, want = brute(docs, k)
    got = near_dups.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), words=k).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(s[i]), c, c == i) for i, c in want.items()}
    left = near_dups.first_of_groups(spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, node int, _id int"), words=k)
    assert {r.doc_id for r in left.collect()} == {i for i, c in want.items() if i == c} and left.columns == ["doc_id", "text", "node", "_id"]


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_by_blocks(spark, monkeypatch, k):
    """Full centres, compared block by block, give the same groups."""
    monkeypatch.setattr(near_dups, "FULL", 8)
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    docs = near_corpus(4)
    _, want = brute(docs, k)
    got = near_dups.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=k).collect()
    assert {r.doc_id: r.component_id for r in got} == want


@pytest.mark.parametrize("full", [None, 1 << 40])
def test_few_members_meet_past_centres(spark, monkeypatch, full):
    """Texts of one passage and words that many of them have, but without links: by keys, where these are asked for, few meet."""
    rnd, met, save = random.Random(11), [], Scratch.save

    def spied(self, df, name, *args, **named):
        out = save(self, df, name, *args, **named)
        if name == "met":
            met.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "save", spied)
    if full is not None:
        monkeypatch.setattr(near_dups, "FULL", full)
    passage, beside = [f"p{i}" for i in range(60)], [f"s{i}" for i in range(120)]
    docs = [(i, " ".join(passage + rnd.sample(beside, 14))) for i in range(1, 121)]
    docs += [(1000 + i, f"{t} end{i}") for i, t in docs[::10]]
    _, want = brute(docs, 2)
    got = near_dups.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=2).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(met) == 1 and met[0] <= 10 * len(docs)  # all pairs: 66 times as many as documents


def test_near_duplicates_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(3, text), (3, text), (2, text + " x"), (None, text), (None, None), (4, "other words here")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dups.near_duplicates(docs, 2).collect()), key=repr)
    assert got == sorted([(3, 2, False), (3, 2, False), (2, 2, True), (None, None, True), (None, None, True), (4, 4, True)], key=repr)
    assert near_dups.first_of_groups(docs, 2).count() == 4
    assert near_dups.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_near_duplicates_repeated_rows(spark):
    """Of rows with one id and text one stays, also where that id is its group's first or has no copies."""
    text, other = " ".join(f"w{i}" for i in range(40)), "words of its own"
    rows = [(2, text, "b"), (2, text, "a"), (2, text, "b"), (3, text + " x", "a"), (4, other, "z"), (4, other, "z"), (5, "here once", "q"), (None, other, "n"), (None, other, "n"), (6, "", "e"), (6, "", "e")]
    left = near_dups.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), 2).collect()
    want = [(2, text, "a"), (4, other, "z"), (5, "here once", "q"), (6, "", "e"), (None, other, "n"), (None, other, "n")]
    assert sorted(map(tuple, left), key=repr) == sorted(want, key=repr)


def test_band_recall():
    """At a resemblance of 0.8 pairs share a band with near certainty; far pairs hardly ever do."""
    rng = np.random.default_rng(3)
    met = {0.8: 0, 0.1: 0}
    for j in met:
        for _ in range(300):
            both, own = int(round(j * 180)), int(round((1 - j) * 90))
            a = rng.integers(0, 1 << 63, both + 2 * own).astype(np.uint64)
            x, y = np.unique(a[: both + own]), np.unique(np.concatenate([a[:both], a[both + own :]]))
            (p, f), (q, g) = near_dups.signatures([x]), near_dups.signatures([y])
            met[j] += bool((p == q).any()) and near_dups.VALUES - int(np.bitwise_count((f ^ g).view(np.uint64)).sum()) >= near_dups.least_bits(80)
    assert met[0.8] == 300 and met[0.1] <= 2


# Repeated lines.


def brute_lines(docs, m):
    """Every run of lines of at least m words that stands earlier, however long, goes."""
    seqs = {i: [x.strip() for x in (t or "").split("\n") if x.strip()] for i, t in docs}
    first, gone = {}, collections.defaultdict(set)
    for i in sorted(seqs):
        s = seqs[i]
        for a in range(len(s)):
            for b in range(a, len(s)):
                if sum(len(x.split()) for x in s[a : b + 1]) >= m:
                    if first.setdefault(tuple(s[a : b + 1]), (i, a)) != (i, a):
                        gone[i] |= set(range(a, b + 1))
    return gone


def line_corpus(seed, n=40):
    rnd = random.Random(seed)
    lines = [" ".join(rnd.choice("abcdefgh") * 3 for _ in range(rnd.choice([1, 4, 9, 30, 60]))) for _ in range(30)]
    docs = []
    for i in range(n):
        t = [rnd.choice([*lines, "", f"own {i} {rnd.random()}"]) for _ in range(rnd.randint(0, 14))]
        if rnd.random() < 0.4 and docs:
            t += docs[-1][1].split("\n")[: rnd.randint(1, 9)]
        docs.append((i, "\n".join(t)))
    return docs


@pytest.mark.parametrize(("seed", "m"), [(1, 50), (2, 20), (3, 1)])
def test_repeated_lines(spark, seed, m):
    docs = line_corpus(seed)
    gone = brute_lines(docs, m)
    got = line_dups.deduplicate_lines(spark.createDataFrame([(i, t, len(t)) for i, t in docs], "doc_id long, text string, n_chars int").repartition(4), m).collect()
    want = {i: (line_dups.without_lines(t, gone[i]) if gone[i] else t, len(gone[i])) for i, t in docs}
    assert {r.doc_id: (r.text, r.n_deleted) for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_repeated_lines_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    schema = "doc_id long, text string, place int, digest int, n_deleted string"
    docs = spark.createDataFrame([(2, f"{long}\n\nend", 1, 1, ""), (1, f"start\n{long}  \n", 1, 1, ""), (3, None, 1, 1, ""), (4, "", 1, 1, ""), (None, long, 1, 1, ""), (5, long, 1, 1, ""), (5, long, 1, 1, ""), (6, "x y\n" * 5000, 1, 1, "")], schema)
    got = sorted(((r.doc_id, r.text, r.n_deleted) for r in line_dups.deduplicate_lines(docs).collect()), key=repr)
    same = lambda i, t, n: (i, t, n)
    six = [r for r in got if r[0] == 6][0]
    assert 0 < len(six[1].split("\n")) < 60
    assert [r for r in got if r[0] != 6] == sorted([same(2, "\nend", 1), same(1, f"start\n{long}  \n", 0), same(3, None, 0), same(4, "", 0), same(None, "", 1), same(5, "", 1), same(5, "", 1)], key=repr)
    left = line_dups.left_over(docs)
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 4, 6] and left.columns == docs.columns
    empty = spark.createDataFrame([], schema)
    assert line_dups.deduplicate_lines(empty).count() == 0


def brute_passages(docs, m):
    """Words of runs of m words that stand earlier, in texts without repeated lines."""
    first, gone = set(), collections.defaultdict(set)
    for i, t in sorted(docs):
        w = t.split()
        for a in range(len(w) - m + 1):
            if (run := tuple(w[a : a + m])) in first:
                gone[i] |= set(range(a, a + m))
            first.add(run)
    return gone


def test_repeated_passages(spark):
    """Runs of 50 words and more inside longer lines that differ, over a line's end, and twice in one text."""
    rnd = random.Random(6)
    new = lambda n: [f"w{rnd.randrange(10**9)}" for _ in range(n)]
    passages, docs = [new(n) for n in (49, 50, 51, 54, 120)], []
    for i in range(60):
        words = new(rnd.randint(1, 40))
        for _ in range(rnd.randint(1, 3)):
            words += rnd.choice(passages) + new(rnd.randint(1, 40))
        for a in rnd.sample(range(1, len(words)), 2) if i % 2 else []:
            words[a] = "\n" + words[a]
        docs.append((i, " ".join(words)))
    docs.append((60, " ".join(["a", "b"] * 200)))
    gone = brute_passages(docs, 50)
    got = {r.doc_id: r for r in line_dups.deduplicate_lines(spark.createDataFrame([(i, t, len(t)) for i, t in docs], "doc_id long, text string, n_chars int").repartition(4)).collect()}
    assert {i: got[i].text.split() for i, _ in docs} == {i: [w for k, w in enumerate(t.split()) if k not in gone[i]] for i, t in docs}
    assert all((r.n_deleted > 0) == bool(gone[i]) and r.n_chars == len(r.text) for i, r in got.items())
    assert all(got[i].text == t for i, t in docs if not gone[i]) and sum(map(bool, gone.values())) > 40


@pytest.mark.parametrize("n", [1, 7, 40])
def test_repeated_places_over_many_tasks(spark, n):
    """Keys that lie in several tasks: the first place of each is told, whatever the tasks' edges."""
    rnd = random.Random(n)
    rows = [(rnd.choice([0, 0, 0, rnd.randrange(20)]), rnd.randrange(3), rnd.randrange(60), 1, rnd.randrange(4)) for _ in range(900)]
    first = {}
    for k, j, *place in sorted(rows):
        first.setdefault((k, j), tuple(place))
    want = {r for r in rows if first[r[:2]] != r[2:]}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        frame = spark.createDataFrame(rows, "a long, b long, doc_id long, digest long, place int")
        got = line_dups.later_places(frame, ["a", "b"], Scratch(spark, "t"), "later").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    places = {(r[:2], r[4]) for r in rows}
    assert all(((r.a, r.b), r["at"]) in places for r in got)


@pytest.mark.parametrize("n", [4, 23])
def test_hot_passages_over_many_tasks(spark, n):
    """Passages that many texts share, in texts that share more or less of what is around them."""
    rnd = random.Random(n)
    new = lambda k: [f"w{rnd.randrange(10**9)}" for _ in range(k)]
    hot, bases, docs = new(60), [new(90) for _ in range(3)], []
    for i in range(90):
        base = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 3])):
            base[rnd.randrange(90)] = new(1)[0]
        docs.append((i, " ".join(rnd.choice([new(rnd.randint(0, 30)) + hot + new(rnd.randint(0, 30)), base, base + hot, ["a", "b"] * 60]))))
    gone = brute_passages(docs, 50)
    repeated = brute_lines(docs, 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        got = {r.doc_id: r.text for r in line_dups.deduplicate_lines(spark.createDataFrame([(i, f"start{i} {t}") for i, t in docs] + [(1000 + i, t) for i, t in docs], "doc_id long, text string")).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    whole = brute_passages([(i, f"start{i} {t}") for i, t in docs] + [(1000 + i, t) for i, t in docs], 50)
    assert {i: got[i].split() for i, _ in docs} == {i: [w for k, w in enumerate(f"start{i} {t}".split()) if k not in whole[i]] for i, t in docs}
    assert all(got[1000 + i].split() == ([] if repeated[i] else [w for k, w in enumerate(t.split()) if k not in whole[1000 + i]]) for i, t in docs) and len(gone) > 30


def test_passages_leave_words_round_deleted_lines():
    def starts(text, lines, found, m):
        return line_dups.passage_starts(text, lines, *np.array(found).T, m).tolist()

    text = "a b c\nd e\nf g h i"
    assert starts(text, set(), [(0, 2), (4, 1)], 3) == [0, 1, 4]
    assert starts(text, {1}, [(0, 7)], 3) == [0, 3, 4] and starts(text, {0, 2}, [(0, 7)], 3) == [] and starts(text, {0}, [(3, 2)], 3) == [0, 1]


def test_hashed_words():
    texts = ["", " a  b\u3000c\x1cd\x85", "a", None or "", "x" * 3000 + " y", " ".join(f"w{i}" for i in range(5000))]
    for size in (1 << 20, 40):
        _shared.HASHED_CHARS, old = size, _shared.HASHED_CHARS
        h, counts = _shared.hashed_words(texts, 2)
        _shared.HASHED_CHARS = old
        words = [w for t in texts for w in t.split()]
        assert counts.tolist() == [len(t.split()) for t in texts] and h.shape == (2, len(words))
        for x in h:
            assert len(set(x.tolist())) == len(set(words)) == len(set(zip(words, x.tolist(), strict=True)))


def test_least_places():
    rng = np.random.default_rng(1)
    for w in (1, 2, 3, 8, 35):
        g = rng.integers(0, 9, 300).astype(np.uint64)
        views = np.lib.stride_tricks.sliding_window_view(g, w)
        assert (line_dups.least_places(g, w) == np.arange(len(views)) + w - 1 - views[:, ::-1].argmin(1)).all()


def test_repeated_lines_on_the_table(spark, sf_dir):
    """Each line but for its first place goes, and each word of a repeated passage in what is left of the lines."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: r.text for r in line_dups.deduplicate_lines(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    lines, runs, n = set(), set(), 0
    for i, t in sorted(docs):
        kept, words, at = [], [], 0
        for x in (t or "").split("\n"):
            if s := x.strip():
                kept += [s not in lines] * len(s.split())
                lines.add(s)
                words += s.split()
        cut = [False] * len(words)
        for a in range(len(words) - 49):
            run = tuple(words[a : a + 50])
            if run in runs and all(kept[a : a + 50]):
                cut[a : a + 50] = [True] * 50
            runs.add(run)
        left = [w for w, k, c in zip(words, kept, cut, strict=True) if k and not c]
        assert (got[i] or "").split() == left
        n += len(words) - len(left)
    assert n > 500


def test_copied_runs(spark):
    """Deleted lines fall into maximal runs, each a copy of one earlier run."""
    one, two = [f"line {k}" for k in range(6)], [f"row {k}" for k in range(4)]
    docs = [(1, one), (2, two), (3, one[:4] + ["own"] + one[1:3] + two), (4, two + one), (5, ["new"] + two[1:2] + ["newer"])]
    got = {r.doc_id: (r.n_deleted, r.n_runs, r.longest_run) for r in line_dups.deduplicate_lines(spark.createDataFrame([(i, "\n".join(x)) for i, x in docs], "doc_id long, text string")).collect()}
    assert got == {1: (0, 0, 0), 2: (0, 0, 0), 3: (10, 3, 4), 4: (10, 2, 6), 5: (1, 1, 1)}
    again = line_dups.deduplicate_lines(spark.createDataFrame([(i, "\n".join(x)) for i, x in docs], "doc_id long, text string, n_runs int".replace(", n_runs int", "")), 4).collect()
    assert {r.doc_id: (r.n_deleted, r.n_runs, r.longest_run) for r in again} == {1: (0, 0, 0), 2: (0, 0, 0), 3: (10, 3, 4), 4: (10, 2, 6), 5: (0, 0, 0)}


def test_without_passages():
    cut = line_dups.without_passages
    assert cut("a b c\nd  e f g", [1, 2], 2) == ("a e f g", 1) and cut(" a b c d", [0, 2], 2) == (" ", 1)
    assert cut("a b c\nd e", [1], 2) == ("a\nd e", 1) and cut("a b c d e f", [1, 4], 1) == ("a c d f", 2)
    assert line_dups.joints("a b\n\nc\nd e\nf", {1, 3}) == [2, 4]


def test_line_runs():
    rnd = random.Random(2)
    for _ in range(500):
        w, m = [rnd.choice([1, 2, 5, 20, 50, 60]) for _ in range(rnd.randint(0, 12))], rnd.choice([1, 10, 50])
        ahead = [next((j - i + 1 for j in range(i, len(w)) if sum(w[i : j + 1]) >= m), None) for i in range(len(w))]
        behind = [next((j - i + 1 for i in range(j, -1, -1) if sum(w[i : j + 1]) >= m), None) for j in range(len(w))]
        assert line_dups.line_runs(w, m) == (ahead, behind)


# Vectors.


def vectors(seed, dims=64):
    rng = np.random.default_rng(seed)
    out = []
    for label in range(3):
        for _ in range(40):
            base = rng.standard_normal(dims)
            for _ in range(rng.choice([1, 2, 8])):
                out.append((len(out), [float(x) for x in base + rng.normal(0, rng.choice([0.0, 0.05, 0.1]), dims)], label))
    return out


def brute_vectors(data, t=0.98):
    links = [(a, b) for (a, x, l), (b, y, m) in itertools.combinations(data, 2) if l == m and np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= t]
    n = collections.Counter(x for l in links for x in l)
    return n, union_find([i for i, _, _ in data], links), len(links)


@pytest.mark.parametrize("seed", [1, 2])
def test_vectors(spark, seed):
    data = vectors(seed)
    n, label, total = brute_vectors(data)
    got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(5)).collect()}
    found = sum(r.n_links for r in got.values()) / 2
    assert total > 100 and total * 0.97 <= found <= total
    assert all(got[i].n_links <= n[i] for i in got)
    assert np.mean([got[i].component_id == label[i] for i in got]) > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_vectors_odd_rows(spark):
    one, nan, inf = [1.0, 2.0], float("nan"), float("inf")
    data = [(5, one, 1), (4, [2.0, 4.0], 1), (3, one, None), (2, None, 1), (1, [0.0, 0.0], 1), (0, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (8, one, 2), (9, one, 1), (None, one, 1), (10, [1.0], 1)]
    schema = "vec_id long, embedding array<double>, label int, code int, class string"
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(spark.createDataFrame([(*d, 1, "x") for d in data], schema)).collect()}
    alone = {i: (0, i, True) for i in (0, 1, 2, 3, 6, 7, 8, 10)}
    assert got == alone | {4: (2, 4, True), 5: (2, 4, False), 9: (2, 4, False), None: (0, None, True)}
    assert embeddings.near_vectors(spark.createDataFrame([], schema)).count() == 0


def brute_rows(data, t=0.98):
    """n_links and component_id of each row, rows with one id being vectors of their own."""
    n, label = [0] * len(data), list(range(len(data)))
    for p, q in itertools.combinations(range(len(data)), 2):
        (a, x, l), (b, y, m) = data[p], data[q]
        if l == m and len(x) == len(y) and np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= t:
            n[p], n[q] = n[p] + 1, n[q] + 1
            low, high = sorted((label[p], label[q]))
            label = [low if v == high else v for v in label]
    least = {c: min(data[k][0] for k in range(len(data)) if label[k] == c) for c in set(label)}
    return sorted((data[k][0], n[k], least[label[k]]) for k in range(len(data)))


def test_vectors_with_repeated_ids(spark):
    rng = np.random.default_rng(5)
    e = rng.standard_normal((6, 32))
    near = lambda k: [float(x) for x in e[k] + rng.normal(0, 0.01, 32)]
    data = [(1, list(map(float, e[0])), 7), (1, list(map(float, e[1])), 7), (2, near(0), 7), (3, near(0), 7), (4, list(map(float, e[2])), 7), (4, near(2), 7), (4, list(map(float, e[2])), 7), (9, near(3), 7), (0, near(3), 7), (9, near(4), 7)]
    got = embeddings.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(3)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute_rows(data)


@pytest.mark.parametrize("odd", [range(3000, 3040), [0]])
def test_vectors_of_several_lengths(spark, odd):
    """Vectors of one label and length meet, also where rows of other lengths come first in the sample."""
    rng = np.random.default_rng(6)
    data = []
    for dims in (48, 64, 16):
        for _ in range(5):
            base = rng.standard_normal(dims)
            data += [(len(data) + 1, [float(x) for x in base + rng.normal(0, 0.01, dims)], 0) for _ in range(4)]
    data += [(i, [1.0 + k], 0) for k, i in enumerate(odd)]
    got = embeddings.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(3), sample=30).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute_rows(data)


def test_balanced_codes():
    x = np.random.default_rng(1).standard_normal((3000, 64)) * np.linspace(1, 3, 64)
    mean, projection = embeddings.learn_rotation(x)
    bits = (x - mean) @ projection >= 0
    assert np.abs(bits.mean(0) - 0.5).max() < 0.1
    assert np.allclose(projection.T @ projection, np.eye(64), atol=1e-8)
