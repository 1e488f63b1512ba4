"""Set join, phrases and Merkle manifest: against SQL on the tables, against brute force on awkward ones."""

import hashlib
import itertools
import os
import random
import re
import subprocess
import sys
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as contract
from compare import differences, sql_connection
from conftest import ROOT
from test_operators import SCHEMA, collected, docs, nothing, sentences, texts  # noqa: F401
from scoreflow.llm import collocations, hashcounts, merkle, registry, setjoin

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    con = sql_connection(sf_dir)
    assert differences(registry.QUERIES[name](spark, sf_dir), con, contract.oracle_sql()[name]) == []


def frame(spark, rows):
    """Rows (doc_id, text, lang, source, n_chars) with the clashing columns of the other tests."""
    return spark.createDataFrame([(*r, "k", 1, "c") for r in rows], SCHEMA).repartition(3)


# ---- 11: sets


def set_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 3:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(words, words[1:], words[2:]))


def jaccard_components(rows):
    """(doc_id, text) -> the expected rows, by comparing all pairs."""
    sets = [set_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
            root[find(a)] = find(b)
    low = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)].append(i)
    return Counter((i, len(sets[k]), (min(low[find(k)], default=None) if sets[k] else i)) for k, (i, _) in enumerate(rows))


def joined(df, **options):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in setjoin.jaccard_components(df, **options).collect())


@pytest.mark.parametrize("unit_grams", [1200, 60])
def test_set_join(spark, texts, unit_grams):  # noqa: F811
    rng = random.Random(7)
    words = [f"w{k}" for k in range(300)]
    made = list(texts.items())
    drift = sentences(rng, 120, words).split()
    for k in range(40):  # a chain: each text is close to the one before, not to the first
        drift[rng.randrange(120)] = rng.choice(words)
        made.append((100 + k, " ".join(drift)))
    star = sentences(rng, 110, words).split()
    for k in range(30):  # each close to the middle, few to each other
        own = list(star)
        own[3 * k] = f"own{k}"
        made.append((200 + k, " ".join(own)))
    made += [(300, " ".join(star)), (301, " ".join(star) + " end"), (None, " ".join(star)), (302, "A"), (303, "a"), (304, "a b"),
             (305, "b a"), (5, "another text of a doc_id that is there"), (None, None), (None, "only here without an id")]
    made += made[-3:]
    shared = sentences(rng, 30, words)
    made += [(400 + k, f"{shared} {sentences(rng, 3, words)}") for k in range(20)]
    got = joined(frame(spark, [(i, t, None, None, None) for i, t in made]), unit_grams=unit_grams)
    assert got == jaccard_components(made)


def sets_moved(monkeypatch):
    """Grows by the number of sets that each comparison in tries is given."""
    moved, compare = [], setjoin.links_within

    def counted(rows, *rest):
        moved.append(rows.count())
        return compare(rows, *rest)

    monkeypatch.setattr(setjoin, "links_within", counted)
    return moved


def test_sets_that_meet_by_chance_do_not_move(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(12)]  # n-grams of so few words hang all texts together
    made = [(k, sentences(rng, 60, words)) for k in range(150)]
    made += [(200 + k, f"{made[k][1]} end") for k in range(10)]
    moved = sets_moved(monkeypatch)
    got = joined(frame(spark, [(i, t, None, None, None) for i, t in made]), unit_grams=300)
    assert got == jaccard_components(made)
    assert 20 <= sum(moved) <= 40


def test_copies_of_a_middle_move_once(spark, monkeypatch):
    rng = random.Random(12)
    middle = sentences(rng, 150, [f"w{k}" for k in range(300)]).split()
    made = [(k, " ".join([*middle[:k], f"own{k}", *middle[k + 1 :]])) for k in range(0, 150, 4)]
    moved = sets_moved(monkeypatch)
    got = joined(frame(spark, [(i, t, None, None, None) for i, t in made]), unit_grams=300)
    assert got == jaccard_components(made) == Counter((i, 148, 0) for i, _ in made)
    assert sum(moved) == 0


@pytest.mark.parametrize("percent", [50, 80, 90, 97, 100])
def test_similar_sets_have_equal_parts(percent):
    rng = random.Random(percent)
    linked = 0
    for _ in range(150):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([1, 2, 3, 5, 9, 11, 14, 20, 40, 90, 300, 700]))]
        made = []
        for _ in range(6):
            own = list(base)
            for _ in range(rng.randint(0, 1 + len(base) * (100 - percent) // 400)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            made.append(" ".join(own[rng.randint(0, len(own) // 12) : len(own) - rng.randint(0, len(own) // 20)]))
        sets = setjoin.Sets([t.encode() for t in made], 3)
        unique, seen = np.unique(sets.gram, return_counts=True)
        kinds = (seen[np.searchsorted(unique, sets.gram)] > 1).astype(np.uint8)  # as low as classes may be
        names, owner = setjoin.part_names(sets, np.flatnonzero(sets.size), kinds, percent)
        named = [set(names[owner == k].tolist()) for k in range(len(made))]
        for a, b in itertools.combinations(range(len(made)), 2):
            one, two = set_of(made[a]), set_of(made[b])
            both = len(one & two)
            if one != two and 100 * both >= percent * (len(one) + len(two) - both):
                linked += 1
                assert named[a] & named[b]
    assert linked > 20 or percent == 100


def test_trie_finds_the_components_of_all_pairs():
    rng = random.Random(3)
    for _ in range(60):
        pool = [rng.getrandbits(64) for _ in range(rng.randint(5, 40))]
        base = rng.sample(pool, rng.randint(3, len(pool)))
        sets = []
        for _ in range(rng.randint(1, 25)):
            own = set(base)
            for _ in range(rng.randint(0, 4)):
                own.symmetric_difference_update([rng.choice(pool)])
            sets.append(np.array(sorted(own), np.uint64))
        sizes = np.array([len(s) + rng.randint(0, 1) for s in sets])
        sides = np.array([rng.randint(0, 1) for _ in sets]) if rng.random() < 0.5 else np.zeros(len(sets), int)
        kinds = {x: rng.randint(0, 3) for x in pool}
        percent = rng.choice([60, 80, 90])
        found = setjoin.trie_links(sets, sizes, sides, lambda u: np.array([kinds[int(x)] for x in u]), percent)
        one_side = len(set(sides.tolist())) == 1

        def linked(a, b):
            both = len(np.intersect1d(sets[a], sets[b]))
            return (one_side or sides[a] != sides[b]) and 100 * both >= percent * (sizes[a] + sizes[b] - both)

        assert all(linked(a, b) for a, b in found)
        every = [p for p in itertools.combinations(range(len(sets)), 2) if linked(*p)]
        assert groups(found, len(sets)) == groups(every, len(sets))


def groups(pairs, count):
    name = list(range(count))
    for a, b in pairs:
        if name[a] != name[b]:
            gone = name[a]
            name = [name[b] if x == gone else x for x in name]
    return sorted(tuple(k for k in range(count) if name[k] == n) for n in set(name))


def test_classes_are_never_too_low(spark, monkeypatch):
    monkeypatch.setattr(hashcounts, "SLAB", 50)
    rng = random.Random(4)
    hashes = [rng.getrandbits(64) for _ in range(300)]
    rows = [(h - (1 << 63),) for k, h in enumerate(hashes) for _ in range(k % 20 + 1)]
    df = spark.createDataFrame(rows, "h bigint").repartition(5)
    classes = hashcounts.frequency_classes(
        df, lambda b: b.column("h").to_numpy().view(np.uint64) + np.uint64(1 << 63), (2, 8), max_bits=16)
    got = classes.of(np.array(hashes, np.uint64)).tolist()
    exact = [(k % 20 + 1 >= 2) + (k % 20 + 1 >= 8) for k in range(300)]
    assert all(g >= e for g, e in zip(got, exact))
    assert sum(g == e for g, e in zip(got, exact)) > 280


def test_class_table_stays_off_the_driver(spark, monkeypatch):
    from pyspark import SparkContext
    from pyspark.sql import DataFrame

    rng = random.Random(5)
    hashes = [rng.getrandbits(64) for _ in range(200)]
    df = spark.createDataFrame([(h - (1 << 63),) for k, h in enumerate(hashes) for _ in range(k % 10 + 1)], "h bigint")

    def refused(*args, **kwargs):
        raise AssertionError("the class table went through the driver")

    with monkeypatch.context() as patched:
        patched.setattr(SparkContext, "broadcast", refused)
        patched.setattr(DataFrame, "collect", refused)
        classes = hashcounts.frequency_classes(
            df, lambda b: b.column("h").to_numpy().view(np.uint64) + np.uint64(1 << 63), (2, 8), max_bits=16)

    def looked_up(batches):
        for batch in batches:
            own = batch.column("h").to_numpy().view(np.uint64) + np.uint64(1 << 63)
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(classes.of(own).astype(np.int32))], ["h", "c"])

    import pyarrow as pa

    got = dict(df.distinct().mapInArrow(looked_up, "h bigint, c int").collect())
    exact = [(k % 10 + 1 >= 2) + (k % 10 + 1 >= 8) for k in range(200)]
    assert all(got[h - (1 << 63)] >= e for h, e in zip(hashes, exact))
    assert sum(got[h - (1 << 63)] == e for h, e in zip(hashes, exact)) > 190


# ---- 12: phrases


def phrases(rows, least, top):
    total, seen = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            seen.update((lang, *words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in seen.items() if len(p) > 2 and a >= least}
    out = defaultdict(list)
    for (lang, *words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = seen[lang, *words[:k]], seen[lang, *words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        longer = [f for (other, *w), f in candidates.items() if other == lang and len(w) > len(words)
                  and any(w[i : i + len(words)] == words for i in range(len(w) - len(words) + 1))]
        if not any(100 * f >= 80 * a for f in longer):
            out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, rank, p.decode(), -a, left, right, total[lang], -score)
        for lang, found in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


def mined(df, **options):
    return {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
            for r in collocations.phrases(df, **options).collect()}


@pytest.mark.parametrize("top", [5, 2000])
def test_phrases(spark, texts, top):  # noqa: F811
    rows = [(i, t, ["en", None, "de", "und"][i % 4], "a", None) for i, t in texts.items()]
    ring = "p q r s t u v " * 9  # words in a circle: no path through the graph has an end
    rows += [(90, ring, "en", "a", None), (91, "A, b c\x1cd é; a b\tc d? e\na b c d e. f g h", "en", "a", None)] * 4
    rows += [(92, "one long passage that comes again and again, word by word, in the same order", None, "a", None)] * 6
    got = mined(frame(spark, rows), min_count=4, top=top)
    assert got == phrases(rows, 4, top)
    assert any(len(p[2].split()) == 4 for p in got)


def test_paths_are_compacted_and_opened_again(spark):
    words = [f"n{k}" for k in range(30)]
    edges = [(" ".join(words[i : i + 4]), 7) for i in range(27)]
    edges += [("n29 n28 x y", 7), ("o o o o", 7), ("a b c a", 7), ("b c a b", 7), ("c a b c", 7)]
    edges[20] = (edges[20][0], 9)  # another weight ends a path
    df = spark.createDataFrame([("en", *e) for e in edges], "lang string, words string, count bigint")
    paths = collocations.unary_paths(df)
    lengths = sorted(len(r["words"]) for r in paths.collect())
    assert lengths == [4, 4, 4, 4, 4, 4, 9, 23]
    assert {tuple(r) for r in collocations.path_edges(paths).collect()} == {("en", *e) for e in edges}


# ---- 13: manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    fields = [None if x is None else str(x) for x in (doc_id, source, lang, n_chars, text)]
    return sha(*("-" if x is None else f"{len(x.encode())}:{x}" for x in fields))


def climbed(nodes):
    """The last node of a tree, and each node's siblings to the left and right, level by level."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i // 8 * 8
            paths[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 8])))
        at = [i // 8 for i in at]
        nodes = [sha(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def manifest(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for lang in langs}
    tops = {lang: climbed([leaf(*r) for r in trees[lang]]) for lang in langs}
    root, upper = climbed([tops[lang][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for r, path in zip(trees[lang], tops[lang][1]):
            path = path + upper[k]
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            folded = leaf(r[0], r[1].translate(LOWER), *r[2:]) if tampered else leaf(*r)
            for left, right in path:
                folded = sha(left, folded, right)
            out.append((r[0], leaf(*r), tops[lang][0], root, sha(*(a + b for a, b in path)), folded, folded == root))
    return Counter(out)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_manifest(spark, texts):  # noqa: F811
    rows = [(i, t, ["en", None, "de"][i % 3], ["a", None][i % 2], i) for i, t in texts.items()]
    rows += [(1000 + k, f"Text {k}", "en", "a", None) for k in range(140)]
    rows += [(2000, "Alone É", "ünï", None, 5), (None, "No id", "en", "a", 1), (None, None, "en", None, None)]
    rows += rows[3:5] + [(3, "same id, other text", rows[3][2], "a", 1)]
    got = Counter(tuple(r[c] for c in COLUMNS) for r in merkle.manifest(frame(spark, rows)).collect())
    assert got == manifest(rows)
    assert {x[-1] for x in got} == {True, False}


@pytest.mark.parametrize("count", [1, 8, 9, 64, 65])
def test_manifest_of_full_and_open_runs(spark, count):
    rows = [(k, "X", "en", "a", 1) for k in range(count)]
    got = Counter(tuple(r[c] for c in COLUMNS) for r in merkle.manifest(frame(spark, rows)).collect())
    assert got == manifest(rows)


def test_manifest_of_many_languages(spark):
    rows = [(k, "X y", f"l{k % 70}", "a", 1) for k in range(90)]
    got = Counter(tuple(r[c] for c in COLUMNS) for r in merkle.manifest(frame(spark, rows)).collect())
    assert got == manifest(rows)


# ---- all three


@pytest.mark.parametrize("run", [setjoin.jaccard_components, collocations.phrases, merkle.manifest])
def test_empty_tables(spark, nothing, run):  # noqa: F811
    assert run(nothing).count() == 0


@pytest.mark.parametrize("run", [setjoin.jaccard_components, collocations.phrases, merkle.manifest])
def test_very_long_texts(spark, run):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(3000)]
    long = sentences(rng, 60000, words)
    rows = [(1, long, "en", "a", 1), (2, long + " more", "en", "a", 1), (3, long.upper(), "en", "a", 1), (4, "x " * 40000, "en", "a", 1)]
    df = frame(spark, rows)
    if run is setjoin.jaccard_components:
        assert joined(df) == jaccard_components([r[:2] for r in rows])
    elif run is merkle.manifest:
        assert Counter(tuple(r[c] for c in COLUMNS) for r in run(df).collect()) == manifest(rows)
    else:
        assert mined(df) == phrases(rows, 30, 2000)


SCRIPT = """
    import sys
    sys.path.insert(0, {root!r})
    from scoreflow.llm import merkle, pii, setjoin
    from scoreflow.session import build_session

    spark = build_session("bare", "local[2]", **{{"spark.ui.enabled": "false"}})
    df = spark.createDataFrame([(1, "a b c d"), (2, "a b c d")], "doc_id bigint, text string")
    assert setjoin.jaccard_components(df).where("component_id = 1").count() == 2
    assert pii.find_personal_data(df).count() == 2
    print("all found")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(textwrap.dedent(SCRIPT.format(root=ROOT)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all found" in run.stdout, run.stderr[-3000:]
