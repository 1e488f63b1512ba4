"""Every corpus operator against a brute-force version on a small, awkward table."""

import base64
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from scoreflow.llm import (
    decontaminate, pii, quality, recompress, simhash, suffixdedup, tokenfiles, toxicity, warc, wordbpe,
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, _m int, component_id string"


def sentences(rng, count, words):
    return " ".join(rng.choice(words) for _ in range(count))


@pytest.fixture(scope="module")
def texts():
    """doc_id -> text: copies, near copies, shared passages, runs of one word, odd white space, nothing."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    passage = sentences(rng, 60, words)
    base = sentences(rng, 300, words)
    near = base.split()
    near[150] = "CHANGED"
    made = [
        base, base, " ".join(near), base.upper(), passage, f"{sentences(rng, 40, words)} {passage} {sentences(rng, 9, words)}",
        None, "", "   \n\t ", "a " * 400, "b a " * 300, "x", "Two words", "z" * 5000, "z" * 4000 + "y" + "z" * 600,
        "line one\nline one\n\nline two", "\x1c odd \x85 white　space é ½ 日本 ΑΣ İ", "café 1234 it's WE'RE",
        "mail me at jo.x@ex-ample.org, card 4111 1111 1111 1111, host 10.0.0.1, +1 (614) 555-8001 and 300.1.1.1",
        "jo (at) ex (dot) org <|endoftext|> text<|startoftext|>!", f"{passage[:150]} {passage[-260:]}", passage + " " + passage,
    ]
    made += [sentences(rng, rng.randint(1, 90), words) for _ in range(18)]
    return dict(enumerate(made))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", None, "de"][i % 3], ["a", "b", None][i % 3], None, "k", i, "c") for i, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def bytes_of(text):
    return (text or "").encode()


# ---- 3: bytes that repeat


def repeated_bytes(texts):
    seen = Counter()
    for text in texts.values():
        data = bytes_of(text)
        seen.update(data[k : k + 200] for k in range(len(data) - 199))
    out = {}
    for i, text in texts.items():
        data = bytes_of(text)
        hit = np.zeros(len(data), bool)
        for k in range(len(data) - 199):
            if seen[data[k : k + 200]] > 1:
                hit[k : k + 200] = True
        spans = int((np.diff(np.concatenate([[0], hit, [0]])) == 1).sum())
        kept = bytes(b for b, h in zip(data, hit) if not h)
        out[i] = (len(data), int(hit.sum()), spans, sha(kept))
    return out


@pytest.mark.parametrize("options", [{}, {"group_pieces": 1}])
def test_suffix_dedup(docs, texts, options):
    report = suffixdedup.substring_report(docs, **options)
    expected = repeated_bytes(texts)
    assert sum(e[1] for e in expected.values()) > 5000
    assert collected(report, "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected


def test_deep_shallow_sorts_and_knows_common_prefixes():
    rng = random.Random(2)
    for _ in range(200):
        head = b"q" * rng.choice([0, 3, 70, 130])
        strings = [head + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 90))) for _ in range(rng.randint(1, 12))]
        strings += rng.choices(strings, k=2)
        order, shared = suffixdedup.deep_shallow(strings, list(range(len(strings))), shallow=rng.choice([0, 8, 64]))
        assert [strings[i] for i in order] == sorted(strings)
        for k in range(1, len(order)):
            a, b = strings[order[k - 1]], strings[order[k]]
            assert shared[k] == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


# ---- 5: words that repeat


def repeated_words(texts):
    seen, out = set(), {}
    for i in sorted(texts):
        words = bytes_of(texts[i]).split()
        hit = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                hit[k : k + 20] = [True] * 20
            seen.add(window)
        out[i] = (len(words), sum(hit), sha(b" ".join(w for w, h in zip(words, hit) if not h)))
    return out


@pytest.mark.parametrize("options", [{}, {"group_pieces": 1}])
def test_recompression_dedup(docs, texts, options):
    expected = repeated_words(texts)
    assert sum(e[1] for e in expected.values()) > 1000
    assert collected(recompress.word_report(docs, **options), "n_words", "n_removed", "kept_sha256") == expected


@pytest.mark.parametrize("options", [{}, {"group_pieces": 1}])
def test_recompression_keeps_the_first_of_rows_repeated_in_full(spark, options):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    first, other, again = (sentences(rng, 120, words) for _ in range(3))
    cut_short = " ".join(first.split()[30:75])
    later = {5: f"{sentences(rng, 3, words)} {cut_short} {sentences(rng, 30, words)}", 6: f"{again} {sentences(rng, 25, words)}"}
    rows = [(1, first)] * 3 + [(2, other)] + [(3, again)] * 2 + [(4, f"{again[:len(again) // 2]} end")] * 2 + list(later.items())
    expected = repeated_words(dict(rows))
    assert expected[1][1] == expected[3][1] == 0 and expected[4][1] > 50 and expected[5][1] >= 45
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = recompress.word_report(frame, **options).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == {(i, *e) for i, e in expected.items()}


@pytest.mark.parametrize("options", [{}, {"group_pieces": 1}])
def test_recompression_orders_texts_of_one_doc_id(spark, options):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(3000)]
    shared = sentences(rng, 40, words)
    rows = [(1, f"{shared} {sentences(rng, 30, words)}") for _ in range(4)]
    got = recompress.word_report(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), **options).collect()
    assert sorted(r["n_removed"] for r in got) == [0, 40, 40, 40]


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefgh"])
def test_equal_windows_are_filed_alike(letters, monkeypatch):
    monkeypatch.setattr(recompress, "GROUP_WORDS", 150)
    rng = random.Random(len(letters))
    texts = []
    for _ in range(40):
        words = [rng.choice(letters) for _ in range(rng.randint(0, 80))]
        if texts and rng.random() < 0.6:
            words += rng.choice(texts)[rng.randint(0, 10) :] + [rng.choice(letters)]
        texts.append(words)
    filed = {}
    for owner, (start, n, anchor, key, _) in recompress.cut([" ".join(t).encode() for t in texts]):
        for text, first, count, at, name in zip(owner, start, n, anchor, key):
            for k in range(count):
                window = tuple(texts[text][first + k : first + k + 20])
                assert len(window) == 20
                assert filed.setdefault(window, name) == name
    windows = {tuple(t[k : k + 20]) for t in texts for k in range(len(t) - 19)}
    assert set(filed) == windows


# ---- 6: near-duplicates


def fingerprint(text):
    words = bytes_of(text).lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(prints):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in prints}


def test_simhash(docs, texts):
    prints = {i: fingerprint(t) for i, t in texts.items()}
    roots = smallest_reachable(prints)
    got = collected(simhash.simhash_duplicates(docs), "fingerprint", "component_id")
    assert got == {i: (f"{prints[i]:016x}", roots[i]) for i in prints}
    kept = simhash.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots.values()))


def test_one_row_stays_for_each_component_whatever_its_doc_id(spark):
    rng = random.Random(13)
    words = [f"w{i}" for i in range(500)]
    one, two, three, four = (sentences(rng, 80, words) for _ in range(4))
    rows = [(1, one, "a"), (5, one, "a"), (5, two, "a"), (5, two, "a"), (6, two, "b"), (None, three, "a"), (None, three, "a"),
            (None, one, "a"), (7, four, "b"), (7, four, "a")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = [[tuple(r) for r in simhash.keep_one_per_component(frame.repartition(n)).collect()] for n in (1, 5)]
    assert {r[:2] for r in kept[0]} == {(1, one), (5, two), (None, three), (7, four)}
    assert len(kept[0]) == 4 and set(kept[0]) == set(kept[1])
    ids = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.simhash_duplicates(frame).collect()}
    of = lambda i, text: ids[i, f"{fingerprint(text):016x}"]
    assert of(5, one) == of(None, one) == 1 and of(5, two) == of(6, two) == 5 and of(None, three) is None


@pytest.mark.parametrize("hot_bucket", [1000, 1])
def test_all_pairs_within_three_bits_are_linked(spark, hot_bucket):
    rng = random.Random(1)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values):
        for bits in (1, 2, 3, 4):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), bits)))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(v),) for v in values], "fingerprint bigint")
    found = {frozenset((r.left, r.right)) for r in simhash.linked_pairs(frame, hot_bucket).collect()}
    expected = {
        frozenset((signed(a), signed(b))) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 3
    }
    assert found == expected


# ---- 7: personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def personal_spans(text):
    found = [("email", 0, m) for m in EMAIL.finditer(text)]
    found += [("ip", 1, m) for m in ADDRESS.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in re.sub("[^0-9]", "", m[0])]
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        if 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append(("card", 2, m))
    found += [("phone", 3, m) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(kind, m.start(), m.end()) for kind, _, m in sorted(found, key=lambda f: (f[2].start(), f[1]))]


def test_base_spans_of_random_texts():
    rng = random.Random(9)
    for _ in range(20_000):
        letters = rng.choice(["ab@.-_1 é", "0123.9 +()-", "+1 23-4.(5)0", "09 -"])
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == personal_spans(text)


@pytest.mark.parametrize("sign", ["at", "At", "aT", "AT"])
@pytest.mark.parametrize("more", ["", " é"])
def test_spelt_signs_are_found_in_any_case(sign, more):
    for opens, closes in ("()", "[]", "{}"):
        text = f"jo {opens}{sign}{closes} ex {opens}dot{closes} org{more}"
        assert [s[0] for s in pii.loose_spans(text, [])] == [0]


def test_personal_data(docs, texts):
    got = collected(pii.find_personal_data(docs), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    for i, text in texts.items():
        base = personal_spans(text or "")
        named = [f"{k}:{a}:{b}" for k, a, b in base]
        kinds = Counter(k for k, _, _ in base)
        assert got[i][:5] == (kinds["email"], kinds["ip"], kinds["card"], kinds["phone"], sha(",".join(named)))
        assert set(named) <= set(filter(None, got[i][5].split(",")))
    masked = pii.mask_personal_data(docs)
    assert masked.columns == docs.columns
    shown = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert shown[6] is None and shown[0] == texts[0]
    assert "[EMAIL]" in shown[18] and "[CARD]" in shown[18] and "[IP]" in shown[18] and "[PHONE]" in shown[18]
    assert "300.1.1.1" in shown[18]


@pytest.mark.parametrize("base", [0, 5, 3000])
@pytest.mark.parametrize("several", [8, 100])
def test_candidates_are_added_by_evidence(spark, base, several):
    wanted = {
        "cued": "please call me 312-867-5{:03d} tonight", "mobile": "my mobile is 613 482 9{:03d} now",
        "spelt": "ask jo{} (at) example (dot) org about it", "card": "pay by visa 4111.1111.1111.1111 item {}"}
    clean = {
        "order": "your order id 312-867-6{:03d} was sent", "serial": "the unit with serial 613 482 7{:03d} works",
        "bare": "numbers like 312-867-8{:03d} stand here"}
    texts = {f"{kind} {i}": form.format(i) for kind, form in {**wanted, **clean}.items() for i in range(several)}
    texts |= {f"base {i}": f"they have +1 312 867 {i:04d} there and a{i}@b.example" for i in range(base)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    added = Counter(r["doc_id"].split()[0] for r in pii.find_personal_data(docs).collect() if r["spans"])
    assert added == {**dict.fromkeys(wanted, several), **({"base": base} if base else {})}


def test_labelers_vote_no():
    vote = lambda text, part, kind: pii.votes_of(text, (kind, text.index(part), text.index(part) + len(part)), False)[2:6]
    assert vote("call 112-867-5309", "112-867-5309", 3) == (0, 1, 2, 2)
    assert vote("order id 312-867-5309", "312-867-5309", 3) == (1, 0, 2, 2)
    assert vote("call about invoice 312-555-0142x", "312-555-0142", 3) == (2, 0, 0, 2)
    assert vote("see you @ the.office", "you @ the.office", 0) == (0, 2, 2, 0)
    assert vote("server fe80:0:0:0:0:0:0:1", "fe80:0:0:0:0:0:0:1", 1) == (0, 1, 2, 2)


# ---- 8: quality


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for k in range(len(words) - 2):
        windows[tuple(words[k : k + 3])].append(k)
    twice = {p + o for at in windows.values() if len(at) > 1 for p in at for o in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(words) < 50 or 100 * len(twice) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, repeated, len(twice), failed


def test_quality_rules(docs, texts, spark):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    report = quality.quality_report(docs)
    got = collected(report, *columns)
    assert got == {i: measured(t) for i, t in texts.items()}
    assert all(not r["kept"] for r in report.collect() if r["base_failed"])
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in report.where("kept").collect()}


def test_thresholds_follow_language_and_source(spark):
    rows = []
    for i in range(600):
        signs = "## " if i % 2 else ""
        rows.append((i, " ".join(f"{signs}w{i}x{k}" for k in range(60)), "en", "tables" if i % 2 else "prose"))
    rows.append((1000, " ".join(f"## w{k}y ### ** ##" for k in range(60)), "en", "prose"))
    rows.append((1001, " ".join(f"## w{k}z" for k in range(60)), "en", "tables"))
    kept = {r["doc_id"] for r in quality.quality_report(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).where("kept").collect()}
    assert kept == set(range(600)) | {1001}


def test_kept_is_what_the_fences_say(spark):
    """Fences of exact quantiles, which the sketches equal in groups this small, and the verdicts they give."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    rows = []
    for k in range(700):
        text = rng.sample(words, 70) + ["long" * 4] * (k % 3)
        text += ["#"] * (60 if k % 41 == 0 else rng.randint(1, 12) if k % 9 == 0 else 0)
        body = " ".join(text) + "\nsame line" * (k % 5 if k % 4 == 0 else 0)
        rows.append((k, body, ["en", "de", None][k % 3], ["a", "b"][k % 2 if k < 600 else 0], None, "k", 1, "c"))
    frame = spark.createDataFrame(rows, SCHEMA)
    measured_rows = {i: quality.measure(t) for i, t, *_ in rows}
    rates = {}
    for i, (n, chars, symbols, dup, repeat, lines) in measured_rows.items():
        rates[i] = {"symbol_rate": symbols / n, "dup_line_rate": dup / lines, "repeat_rate": repeat / n, "word_length": chars / n}
    own, wide = defaultdict(list), defaultdict(list)
    for i, _, lang, source, *_ in rows:
        own[lang, source].append(i)
        wide[lang].append(i)

    def quantile(values, rank):
        values = sorted(values)
        return values[min(max(int(np.ceil(rank * len(values))) - 1, 0), len(values) - 1)]

    expected = {}
    for i, _, lang, source, *_ in rows:
        group = own[lang, source] if len(own[lang, source]) >= 110 else wide[lang]
        kept = True
        for name, (rank, least) in quality.MEASURES.items():
            values = [rates[j][name] for j in group]
            high, middle, low = (quantile(values, r) for r in (rank, 0.5, 1 - rank))
            kept &= rates[i][name] <= high + max(3 * (high - middle), least)
            if name in quality.TWO_SIDED:
                kept &= rates[i][name] >= low - max(3 * (middle - low), least)
        expected[i] = kept
    for most in (quality.MAX_BROADCAST, 1):  # fences by broadcast, and by group
        got = {r["doc_id"]: r["kept"] for r in quality.quality_report(frame, min_group=110, max_broadcast=most).collect()}
        assert got == expected
    assert 0 < sum(expected.values()) < len(expected)
    assert {r["doc_id"] for r in quality.keep_good(frame, min_group=110).collect()} == {i for i, k in expected.items() if k}


def test_fences_move_where_most_texts_have_none(spark):
    rng = random.Random(8)
    words = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 6))) for _ in range(n)]
    prose = lambda: " ".join(words(60))
    ruled = lambda n: " ".join(" ".join([a, b, c, "|"]) for a, b, c in zip(words(n), words(n), words(n)))
    # Lines with `again` repeated ones among forty.
    lined = lambda again: "\n".join(["same one"] * (again + 1) + [" ".join(words(3)) for _ in range(39 - again)])
    rows = [(100 + i, prose(), "en", "prose") for i in range(300)] + [(1000 + i, ruled(20), "en", "tables") for i in range(300)]
    rows += [(2000 + i, lined(3 if i < 30 else 0), "en", "lists") for i in range(300)]
    rows += [(1, ruled(20), "en", "tables"), (2, lined(9), "en", "lists"), (3, lined(9), "en", "prose"), (4, ruled(20), "en", "prose"),
             (5, " ".join(chr(97 + k % 26) + chr(97 + k // 26) for k in range(60)), "en", "prose"), (6, prose(), "en", "prose")]
    report = quality.quality_report(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()
    assert not any(r["base_failed"] for r in report)
    gone = {r["doc_id"] for r in report if not r["kept"]}
    assert gone == {3, 4, 5}


# ---- 9: benchmark passages


def contaminated(texts, items, window=13):
    words = lambda t: [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes_of(t).lower())]
    windows = defaultdict(set)
    for item, text in items:
        found = words(text)
        size = min(window, len(found))
        for k in range(len(found) - size + 1 if found else 0):
            windows[tuple(found[k : k + size])].add(item)
    out = {}
    for i, text in texts.items():
        found, hit, met = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(found) - size + 1):
                if own := windows.get(tuple(found[k : k + size])):
                    hit.update(range(k, k + size))
                    met |= {str(x) for x in own if x is not None}
        out[i] = (len(found), len(hit), len(met), sha(",".join(sorted(met))), bool(hit) and 20 * len(hit) >= len(found))
    return out


def test_decontamination(spark, docs, texts):
    passage = texts[4].split()
    items = [(1, " ".join(passage[5:40])), (2, " ".join(passage[5:40]).upper()), (30, "Two, words!"), (4, None), (5, "..."),
             (None, " ".join(passage[20:36])), (7, "nowhere to be found in any of these texts at all, not even once or twice"),
             (8, "a"), (9, " ".join(passage[:13]))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = collected(decontaminate.find_hits(docs, benchmark), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    expected = contaminated(texts, items)
    assert got == expected
    clean = decontaminate.drop_contaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, e in expected.items() if not e[4]}
    without = decontaminate.find_hits(docs, benchmark.limit(0))
    assert {r["n_hit"] for r in without.collect()} == {0}


# ---- 2 and 10: token ids


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(wordbpe.word_vocabulary_path())


def test_word_bpe(docs, texts, word_tokenizer):
    got = collected(wordbpe.token_report(docs, wordbpe.word_vocabulary_path()), "n_tokens", "ids_sha256", "decoded_sha256")
    for i, text in texts.items():
        ids = word_tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = word_tokenizer.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded))
    rows = {r["doc_id"]: r for r in wordbpe.tokenized(docs, wordbpe.word_vocabulary_path()).collect()}
    assert rows[12]["ids"] == word_tokenizer.encode(texts[12], add_special_tokens=False).ids
    assert rows[12]["decoded"] == word_tokenizer.decode(rows[12]["ids"], skip_special_tokens=False)


def test_word_bpe_knows_every_code_point(word_tokenizer):
    """All code points but surrogates; of private ones and of the large even blocks some."""
    encoder = wordbpe.Encoder(wordbpe.Vocabulary(wordbpe.word_vocabulary_path()))
    even = [(0x3400, 0x9FFF), (0xAC00, 0xD7A3), (0x20000, 0x3FFFF), (0x40000, 0x10FFFF)]
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000
              and (c % 97 == 0 or not any(a + 300 < c < b - 300 for a, b in even))]
    for start in range(0, len(points), 2000):
        made = [f"x{chr(c)}1 {chr(c)}" for c in points[start : start + 2000]]
        theirs = word_tokenizer.encode_batch(made, add_special_tokens=False)
        ours = encoder.encode(made)
        assert [m for m, o, t in zip(made, ours, theirs) if np.frombuffer(o, "<u4").tolist() != t.ids] == []


def test_word_bpe_on_random_texts(word_tokenizer):
    encoder = wordbpe.Encoder(wordbpe.Vocabulary(wordbpe.word_vocabulary_path()))
    rng = random.Random(3)
    letters = "aAbB'sStT  \n\t1²é́ΣσİßЖ日本#*<|>½\x1c\x85　'll'RE​😀"
    for i in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        if i % 10 == 0:
            text += "<|endoftext|>" + text[:3] + "<|startoftext|>"
        expected = word_tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == expected
    for text in ("ab" * 3000, "thequick" * 500, "x" * 2000):
        expected = word_tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == expected


def test_short_and_long_words_merge_alike():
    vocabulary = wordbpe.Vocabulary(wordbpe.word_vocabulary_path())
    ranks = wordbpe.PairRanks(vocabulary.rank)
    rng = random.Random(4)
    words = [bytes(rng.choice(b"theraniou") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    coded = wordbpe.merge_words(words, vocabulary, ranks)
    for word, ids in zip(words, coded):
        parts = [vocabulary.inner[b] for b in word[:-1]] + [vocabulary.last[word[-1]]]
        assert np.frombuffer(ids, "<u4").tolist() == wordbpe.merge_long(parts, vocabulary)


def test_variable_length_coding():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        values = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        control, data = tokenfiles.pack(values)
        assert len(control) == -(-n // 4)
        assert (tokenfiles.unpack(control, data, n) == values).all()


def test_token_files(spark, docs, texts, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BLOCK_TOKENS", 300)
    path = str(tmp_path / "files")
    tokenfiles.write_token_files(docs, path, tokenfiles.byte_vocabulary_path(), shards=3)
    got = collected(tokenfiles.read_token_files(spark, path), "start", "n_tokens", "ids")
    tokenizer = Tokenizer.from_file(tokenfiles.byte_vocabulary_path())
    start = 0
    for i in sorted(texts):
        ids = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [2]
        assert got[i] == (start, len(ids), np.array(ids, "<u4").tobytes())
        start += len(ids)
    blocks = spark.read.parquet(f"{path}/blocks").orderBy("shard", "block").collect()
    assert [d for b in blocks for d in b["doc_ids"]] == sorted(texts)
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert [r["seen"] for r in ranks] == sorted((r["seen"] for r in ranks), reverse=True)


def test_byte_chunks_give_the_library_s_ids(monkeypatch):
    with open(tokenfiles.byte_vocabulary_path(), encoding="utf-8") as file:
        encoder = tokenfiles.ByteEncoder(file.read())
    tokenizer = Tokenizer.from_file(tokenfiles.byte_vocabulary_path())
    rng = random.Random(6)
    letters = "aAb.'s  \n\t12é#　​😀\x1c"
    texts = []
    for i in range(3000):
        text = "".join(rng.choice(letters if i % 2 else "ab1.\n '") for _ in range(rng.randint(0, 25)))
        text += "<|endoftext|> x" if i % 20 == 0 else ""
        texts.append(text)
    expected = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    for text, ids in zip(texts[:1000], expected):
        assert encoder.encode(pa.array([text]))[0].tolist() == ids
    # Together, with an end each, while chunks are forgotten in between.
    monkeypatch.setattr(tokenfiles, "REMEMBERED", 200)
    for start in range(0, 3000, 500):
        ids, lengths = encoder.encode(pa.array(texts[start : start + 500]), 2)
        assert ids.tolist() == [i for own in expected[start : start + 500] for i in (*own, 2)]
        assert lengths.tolist() == [len(own) + 1 for own in expected[start : start + 500]]


# ---- 4: web archive


def test_archive(spark, tmp_path):
    pages = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, "other é"), (4, "http://c/", None), (5, "http://d/", ""),
             (9, "http://e/\r\nX: y", "same"), (None, "http://f/", "other é")]
    path = str(tmp_path / "archive")
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, html string, store_key string")
    warc.write_archive(frame, path)
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
           for r in warc.read_index(spark, path).collect()}
    digest = lambda t: (len(bytes_of(t)), base64.b32encode(hashlib.sha1(bytes_of(t)).digest()).decode())
    first = {"same": 9, "other é": 3, "": 5}
    for page_id, _, html in pages:
        refers = first[html or ""] if page_id is not None and first[html or ""] != page_id else None
        assert got[page_id] == (*digest(html), "revisit" if refers else "response", refers)
    records = {r["page_id"]: r for r in warc.read_records(spark, path).collect()}
    assert bytes(records[1]["payload"]) == b"same"
    header = bytes(records[9]["header"]).decode()
    assert header.startswith("WARC/1.1\r\n") and header.endswith("\r\n\r\n") and "http://e/%0D%0AX: y" in header
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    some = str(tmp_path / "some")
    warc.write_archive(frame, some, min_payload_bytes=5)
    kinds = {r["page_id"]: r["record_type"] for r in warc.read_index(spark, some).collect()}
    assert set(kinds.values()) == {"response"}


# ---- 1: toxicity


def test_toxicity(spark, docs, nothing):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    bad = ["worthless", "disgusting", "moron"]
    rows, labels = [], []
    for i in range(500):
        toxic = i % 4 == 0
        text = [rng.choice(words) for _ in range(60)]
        if toxic:
            for word in rng.choices(bad, k=3):
                text[rng.randrange(60)] = word
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    filler = " ".join(words[:50])
    rows += [(9001, f"{filler} worthles disgustin mooron morons disgustingly"), (9002, filler), (9003, None), (9004, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = spark.createDataFrame(labels + [(None, 1, 1), (7, 1, None)], "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(frame, table).collect()}
    truth = {i: t for i, _, t in labels}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [i for i in truth if got[i]["held_out"]]
    right = sum(got[i]["predicted"] == truth[i] for i in held)
    assert len(held) > 60 and right >= 0.9 * len(held)
    assert got[9001]["score"] > got[9002]["score"]  # misspellings that were never seen
    assert got[9003]["score"] == got[9004]["score"] and 0 <= got[9003]["score"] <= 1
    none = toxicity.score_toxicity(docs, table.limit(0))
    assert {r["predicted"] for r in none.collect()} == {0}
    assert toxicity.score_toxicity(nothing, table).count() == 0


# ---- awkward tables


OPERATORS = {
    "suffix": suffixdedup.substring_report,
    "words": recompress.word_report,
    "simhash": simhash.simhash_duplicates,
    "pii": pii.find_personal_data,
    "quality": quality.quality_report,
    "bpe": lambda d: wordbpe.token_report(d, wordbpe.word_vocabulary_path()),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_repeated_and_null_rows(spark, nothing, name):
    assert OPERATORS[name](nothing).count() == 0
    long = " ".join(f"w{k}" for k in range(200))
    rows = [(1, long), (1, long), (None, long), (None, None), (2, None), (3, long)]
    frame = spark.createDataFrame(
        [(i, t, None, None, None, None, None, None) for i, t in rows], SCHEMA)
    assert OPERATORS[name](frame).count() == len(rows)


def stepwise_anchors(name, text, window=recompress.WINDOW, rounds=recompress.ROUNDS):
    """Each window's best symbol, place by place: the lexicographically smallest (rank, first) covering it."""
    n = len(name)
    place = np.arange(n)
    s = recompress.Symbols(name, text, place, place + 1, place, place + 1)
    best = [(np.iinfo(np.uint64).max, recompress.FAR)] * n
    for round_ in range(1, rounds + 1):
        s = recompress.join_pairs(recompress.join_runs(s), round_)
        for i in np.flatnonzero((s.low >= 0) & (s.high - s.low <= window) & (s.high <= n)):
            words = int(s.high[i] - s.low[i])
            preferred = 0 if recompress.FEW <= words <= recompress.MANY else 1 if words > recompress.MANY else 2
            content = recompress.value_range_hashes(name, s.low[i : i + 1], s.high[i : i + 1])[0]
            rank = (preferred << 62) | (int(content) >> 2)
            for to in range(max(int(s.high[i]) - window, 0), int(s.low[i]) + 1):
                best[to] = min(best[to], (rank, int(s.first[i])))
    return np.array([a if a < recompress.FAR else -1 for _, a in best]), np.array([r for r, _ in best], np.uint64)


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh"])
def test_anchors_take_the_best_symbol_of_every_window(letters):
    rng = random.Random(len(letters))
    texts = []
    for _ in range(30):
        words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        if texts and rng.random() < 0.6:
            words += rng.choice(texts)[rng.randint(0, 10) :]
        texts.append(words)
    name = np.concatenate([recompress.Words([" ".join(t).encode()], recompress.NO_SPACE).hash for t in texts])
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    at, rank = recompress.anchors(name, text)
    want_at, want_rank = stepwise_anchors(name, text)
    assert np.array_equal(at, want_at) and np.array_equal(rank, want_rank)
