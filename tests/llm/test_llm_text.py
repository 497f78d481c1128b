"""Quality rules, classifier, near-duplicates, decontamination and language model against brute force."""

import collections
import itertools
import math
import random
import re
import struct

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from vaultspark.llm.eliasfano import EliasFano
from vaultspark.llm import decontaminate, ngram_trie, quality_mil, quality_rules, simhash
from vaultspark.llm.bytewords import Hasher
from vaultspark.llm.common import crc_mod, table

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MASK = (1 << 64) - 1


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SMALL, "documents").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


# -- near-duplicates ---------------------------------------------------------

def brute_fingerprint(text, n=4):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=4):
    """Smallest reachable index of each fingerprint."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(fps))]


def test_near_duplicates_equal_all_pairs(spark, docs, rows):
    rows = sorted(rows)
    fps = [brute_fingerprint(t) for _, t in rows]
    want = {rows[i][0]: (f"{fps[i]:016x}", rows[r][0]) for i, r in enumerate(brute_components(fps))}
    got = simhash.near_duplicates(spark, docs).select("doc_id", simhash.hex_fingerprint().alias("f"), "component_id").collect()
    assert {r.doc_id: (r.f, r.component_id) for r in got} == want


@pytest.mark.parametrize("group", [4, 1024])
def test_golay_keys_lose_no_link(spark, group):
    """Fingerprints at 0 to 6 bits from common centres, with buckets split or whole."""
    rng = random.Random(5)
    fps = set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(8):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
    fps = sorted(fps)
    want = brute_components(fps)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    tree = {r.node & MASK: r.root & MASK for r in simhash.components(spark, simhash.links(spark, df, 4, group)).collect()}
    got = [tree.get(f, f) for f in fps]
    classes = lambda labels: sorted(sorted(i for i, _ in g) for _, g in itertools.groupby(sorted(enumerate(labels), key=lambda p: p[1]), lambda p: p[1]))
    assert classes(got) == classes(want)


def test_keys_of_fingerprints_are_never_broadcast_by_their_estimate(spark):
    fps = spark.range(64).selectExpr("xxhash64(id) fp")  # as small as an estimate can be; the keys are 87 times as many
    plan = simhash.links(spark, fps)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_deduplicate_keeps_one_of_each_group(spark, docs):
    found = simhash.near_duplicates(spark, docs).select("component_id").distinct().collect()
    kept = simhash.deduplicate(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.component_id for r in found)


# -- quality rules -----------------------------------------------------------

def brute_measures(text):
    words = WORD.findall(text)
    seen, line_dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            line_dups += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), line_dups, len(covered),
            len(words) < 20 or 100 * len(covered) > 30 * len(words))


def brute_features(text):
    runs = regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+", text)
    h = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    first = [xxhash.xxh64_intdigest(struct.pack("<Q", a), seed=42) for a in h[:-1]]
    return h + [xxhash.xxh64_intdigest(struct.pack("<Q", b), seed=a) for a, b in zip(first, h[1:])]


def test_quality_rules_equal_brute_force(spark, docs, rows):
    trusted = {r.doc_id for r in table(spark, SMALL, "labels").filter("quality = 1").collect()}
    buckets = 1 << 10
    raw, target = collections.Counter(), collections.Counter()
    for i, t in rows:
        for f in brute_features(t):
            raw[f % buckets] += 1
            target[f % buckets] += i in trusted
    share = sum(target.values()) / sum(raw.values())
    weight = {b: math.log((target[b] + quality_rules.PRIOR) / (raw[b] * share + quality_rules.PRIOR)) for b in range(buckets)}
    out = quality_rules.judge(spark, docs, table(spark, SMALL, "labels").filter("quality = 1").select("doc_id"), buckets=buckets)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r, f = got[i], brute_features(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_measures(t)
        score = sum(weight[x % buckets] for x in f) / max(1, len(f))
        assert r.score == pytest.approx(score, abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= quality_rules.THRESHOLD)


def test_quality_rules_have_no_python_in_the_plan(spark, docs):
    out = quality_rules.judge(spark, docs, table(spark, SMALL, "labels").select("doc_id"), buckets=64)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- quality classifier ------------------------------------------------------

def test_classifier_on_held_out_rows(spark):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    held = crc_mod("doc_id", 4) == 2
    model = quality_mil.fit(spark, docs, labels, learn=~held)
    out = quality_mil.score(docs, model).join(labels.select("doc_id", "quality"), "doc_id").filter(held).collect()
    good = [r.score for r in out if r.quality == 1]
    bad = [r.score for r in out if r.quality == 0]
    better = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert better >= 0.9
    assert quality_mil.score(docs, model).count() == docs.count()


@pytest.mark.parametrize("text", [
    "\n".join("\u4e2d" * 500 for _ in range(48)), "x" * 300_000, "\n".join("7Aa!" * 700 for _ in range(48)),
    "short before " * 48 + "y" * 70_000 + " 12 after\n" * 60,
])
def test_byte_classes_of_long_passages_equal_a_plain_count(text):
    raw = text.encode()
    w = Hasher().words([raw])
    _, feats, _, of = quality_mil.passages(Hasher(), np.zeros(1, np.int64), [raw])
    begin = [0, *(int(w.start[k]) for k in range(quality_mil.PASSAGE, len(w.start), quality_mil.PASSAGE)), len(w.raw)]
    assert len(feats) == len(begin) - 1
    for f, lo, hi, n in zip(feats, begin, begin[1:], collections.Counter(of.tolist()).values()):
        part = bytes(w.raw[lo:hi])
        count = [sum(part.count(b) for b in members) for members in quality_mil.CLASSES]
        assert f[:8] == pytest.approx([*(c / len(part) for c in count[:-1]), count[-1] / n], rel=1e-5)


# -- decontamination ---------------------------------------------------------

ITEM = "If a train travels 60 miles in 3 hours and then Alice walks another 12 miles home how far did she go in all today"
CHANGED = ITEM.replace("60", "84").replace("12", "31").replace("3 hours", "7 hours").replace("Alice", "Bob")
FILL = "some other words stand here so that the document is longer than the question that it holds in its middle part"


@pytest.mark.parametrize("text, kind", [
    (f"{FILL}. {ITEM}. {FILL}", "verbatim"), (f"{FILL}. {CHANGED}. {FILL}", "reparameterised"),
    (FILL, None), ("", None), (None, None), (" ".join(ITEM.split()[:8]), None),
])
def test_decontamination_cases(spark, text, kind):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(7, ITEM), (8, None), (9, "")], "item_id long, text string")
    got = decontaminate.contaminated(spark, docs, items).collect()
    assert [(r.item_id, r.kind) for r in got] == ([(7, kind)] if kind else [])
    assert decontaminate.remove_contaminated(spark, docs, items).count() == (kind is None)


@pytest.mark.parametrize("copy", [
    ITEM.lower(), ITEM.upper(), ITEM.replace(" Alice", "\nAlice"), ITEM.replace(" ", "  "), ITEM.replace(" ", "\r\n\t"),
    ITEM.replace(" ", "\u00a0"),
])
def test_decontamination_of_copies_in_other_case_and_spacing(spark, copy):
    docs = spark.createDataFrame([(1, f"{FILL}. {copy}. {FILL}"), (2, FILL)], "doc_id long, text string")
    items = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    got = decontaminate.contaminated(spark, docs, items).collect()
    assert [(r.doc_id, r.item_id, r.kind) for r in got] == [(1, 7, "verbatim")] and got[0].similarity == 1
    assert [r.doc_id for r in decontaminate.remove_contaminated(spark, docs, items).collect()] == [2]


def test_decontamination_finds_every_whole_item(spark):
    docs, items = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "benchmark")
    known = [(i.item_id, i.text.strip()) for i in items.collect() if i.text and len(i.text.split()) >= 8]
    want = {(d.doc_id, i) for d in docs.collect() for i, t in known if d.text and t in d.text}
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark, docs, items, broadcast_rows=0).collect()}
    same = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark, docs, items).collect()}
    assert want and want <= got and got == same


# -- language model ----------------------------------------------------------

@pytest.mark.parametrize("segment_bytes", [1 << 14, 32 << 20])
def test_language_model_equals_brute_force(spark, docs, rows, segment_bytes):
    """Counts and base exactly, the model up to its 8-bit probabilities; one segment or many."""
    learn = crc_mod("doc_id", 7) != 2
    ids = {r.doc_id for r in docs.filter(learn).select("doc_id").collect()}
    cut = {i: ["".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(t)] + [None] for i, t in rows}
    one, two, first = collections.Counter(), collections.Counter(), collections.Counter()
    for i in ids:
        one.update(cut[i])
        for v, w in zip([None] + cut[i], cut[i]):
            two[v, w] += 1
    follow = collections.Counter(v for v, _ in two)
    for (v, _), c in two.items():
        first[v] += c
    n, size, d = sum(one.values()), len(one), ngram_trie.DISCOUNT

    def p(v, w):
        base = (one[w] + 1) / (n + size + 1)
        if not first[v]:
            return base
        return max(two[v, w] - d, 0) / first[v] + d * follow[v] / first[v] * base

    model = ngram_trie.learn(spark, docs, learn_from=learn, segment_bytes=segment_bytes)
    assert model.tokens == n
    got = {r.doc_id: r for r in ngram_trie.score(docs, model).collect()}
    assert len(got) == len(rows)
    for i, t in cut.items():
        r = got[i]
        assert (r.n_tokens, r.n_known) == (len(t), sum(one[w] > 0 for w in t))
        assert r.base_score == pytest.approx(sum(math.log10((one[w] + 1) / (n + size + 1)) for w in t), abs=1e-6)
        whole = sum(math.log10(p(v, w)) for v, w in zip([None] + t, t))
        assert abs(r.score - whole) <= 0.02 * len(t) + 1e-6


@pytest.mark.parametrize("order", [3, 4])
def test_deeper_levels_equal_brute_force(spark, docs, rows, order, monkeypatch):
    """Counts of longer n-grams below the nodes of pairs, over many segments and texts that are cut into parts."""
    monkeypatch.setattr(ngram_trie, "PIECE", 20_000)
    learn = crc_mod("doc_id", 7) != 2
    ids = {r.doc_id for r in docs.filter(learn).select("doc_id").collect()}
    cut = {i: ["".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(t)] + [None] for i, t in rows}
    one, d = collections.Counter(w for i in ids for w in cut[i]), ngram_trie.DISCOUNT
    n, size = sum(one.values()), len(one)
    grams = collections.Counter()  # a text's first words stand behind one end
    for i in ids:
        t = [None] + cut[i]
        grams.update(tuple(t[k - m + 1:k + 1]) for m in range(2, order + 1) for k in range(m - 1, len(t)))
    total, follow = collections.Counter(), collections.Counter(g[:-1] for g in grams)
    for g, c in grams.items():
        total[g[:-1]] += c

    def p(context, w):
        if not context:
            return (one[w] + 1) / (n + size + 1)
        low = p(context[1:], w)
        if not total[context]:
            return low
        return max(grams[context + (w,)] - d, 0) / total[context] + d * follow[context] / total[context] * low

    got = {r.doc_id: r for r in ngram_trie.score(docs, ngram_trie.learn(spark, docs, learn_from=learn, segment_bytes=1 << 17, order=order)).collect()}
    plain = {r.doc_id: r for r in ngram_trie.score(docs, ngram_trie.learn(spark, docs, learn_from=learn)).collect()}
    assert len(got) == len(rows)
    for i, t in cut.items():
        t = [None] + t
        whole = sum(math.log10(p(tuple(t[max(0, k - order + 1):k]), t[k])) for k in range(1, len(t)))
        assert abs(got[i].score - whole) <= 0.02 * (len(t) - 1) + 1e-6
    assert sum(got[i].score for i in ids) > sum(plain[i].score for i in ids)  # what it has learned is likelier with more context


def test_order_without_learning_texts(spark, docs):
    model = ngram_trie.learn(spark, docs.limit(0), order=3)
    got = ngram_trie.score(docs, model).collect()
    assert all(r.n_known == 0 and r.score == r.base_score for r in got)


def test_open_segments_of_a_remote_store_are_bounded(spark, docs, monkeypatch):
    model = ngram_trie.learn(spark, docs, segment_bytes=1 << 14)
    real, seen = ngram_trie.read_array, []
    free = ngram_trie.Trie(model)
    prev = np.repeat(np.arange(300), 3)
    word, base = np.tile(np.arange(3), 300), np.full(900, 1e-6)
    want = free.log10(prev, word, base)
    monkeypatch.setattr(ngram_trie, "read_array", lambda *a: seen.append(a) or np.array(real(*a)))  # as from a store that cannot be mapped
    all_open = ngram_trie.Trie(model)
    assert all_open.log10(prev, word, base).tolist() == want.tolist() and len(all_open.open.held) > 2
    bound = all_open.open.size // 2
    monkeypatch.setattr(ngram_trie, "OPEN_BYTES", bound)
    few = ngram_trie.Trie(model)
    assert few.log10(prev, word, base).tolist() == want.tolist()
    assert 0 < few.open.size <= bound < all_open.open.size and len(few.open.held) < len(all_open.open.held)


def test_a_search_selects_one_zero_for_each_value(monkeypatch):
    """The zero behind a value's members is read from where they begin; both ways give the same places."""
    rng = np.random.default_rng(11)
    asked = []
    select = EliasFano.zero_place
    monkeypatch.setattr(EliasFano, "zero_place", lambda self, k: asked.append(len(k)) or select(self, k))
    for values in (rng.integers(0, 1 << 40, 5000), np.repeat(rng.integers(0, 50, 40), 30), np.arange(700), np.array([0, 0, 1 << 50])):
        values = np.sort(values).astype(np.uint64)
        e = EliasFano.build(values)
        asked.clear()
        wanted = np.concatenate((values, values + np.uint64(1), rng.integers(0, 1 << 50, 500).astype(np.uint64)))
        at = e.find(wanted)
        assert sum(asked) <= len(wanted)
        last = {int(v): i for i, v in enumerate(values)}
        assert at.tolist() == [last.get(int(v), -1) for v in wanted]
        bits = np.unpackbits(e.high.view(np.uint8), bitorder="little")
        zeros = np.flatnonzero(bits == 0)
        places = np.arange(zeros[-1] + 1)
        assert e.next_zero(places).tolist() == zeros[np.searchsorted(zeros, places)].tolist()
        assert e.get(np.arange(e.n)).tolist() == values.tolist()


def test_distinct_keys_and_the_order_of_segments():
    rng = np.random.default_rng(12)
    for keys in (rng.integers(0, 99, 5000).astype(np.uint64), np.empty(0, np.uint64), np.array([7], np.uint64)):
        first, place = ngram_trie.distinct(keys)
        known, inverse = np.unique(keys, return_inverse=True)
        assert keys[first].tolist() == known.tolist() and place.tolist() == inverse.tolist()
    for seg in (rng.integers(0, 9, 3000), rng.integers(0, 1 << 20, 3000), np.empty(0, np.int64)):
        assert ngram_trie.by_number(seg).tolist() == np.argsort(seg, kind="stable").tolist()


def test_merged_counts_are_not_held_beside_their_sum():
    held = ngram_trie.Held()
    held.add(np.array([3, 9], np.uint64), np.array([1, 2]))
    held.add(np.array([1, 9], np.uint64), np.array([5, 7]))
    keys, counts = held.merged()
    assert (keys.tolist(), counts.tolist()) == ([1, 3, 9], [5, 1, 9])
    assert held.parts == [] and held.size == 0 and not held.full()
    assert [len(x) for x in held.merged()] == [0, 0]
