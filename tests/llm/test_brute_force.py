"""Operators against plain Python on a small part of the driver tables or planted cases."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from conftest import DOCS, words
from pyspark.sql import functions as F

from shelfmark.llm import components, decontamination, language_model, mixing, near_duplicates, quality_rules, substrings, toxicity, url_filter
from shelfmark.llm.queries import ORACLE, QUERIES
from shelfmark.llm.words import WordHashes


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    known = {}
    return lambda name: known.setdefault(name, QUERIES[name](spark, sf_dir).collect())


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w)} - {()} if len(w) < 5 else set(zip(*(w[i:] for i in range(5))))


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(sets)
    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= 85 * max(len(x), len(y)) and 100 * len(x & y) >= 85 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def test_near_duplicates_of_the_table(result, texts):
    want, sizes = brute_components(texts)
    got = result("op8_near_duplicates")
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == sizes[r.doc_id] and r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_in_a_large_group(spark):
    """More near copies than are compared pair by pair, some linked to few others only."""
    rng = random.Random(3)
    base = words(rng, 80)
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.choice((0, 1, 2, 3))):
            w[rng.randrange(len(w))] = words(rng, 1)[0] + str(rng.randrange(50))
        rows.append((i, " ".join(w), "en", "a", 0))
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components({r[0]: r[1] for r in rows})[0]


def test_sketch_estimates_the_overlap(spark):
    rng = random.Random(1)
    h = np.unique(np.array([rng.getrandbits(64) for _ in range(6000)], np.uint64))
    a, b = np.sort(h[:4000]), np.sort(h[1000:])  # 3000 of 6000 in common
    x, y = near_duplicates.registers(a), near_duplicates.registers(b)
    df = spark.createDataFrame([(x.astype(int).tolist(), y.astype(int).tolist(), len(a), len(b))], "a array<int>, b array<int>, n int, m int")
    jaccard, used = near_duplicates.estimate(F.col("a"), F.col("b"), F.col("n"), F.col("m"))
    row = df.select(jaccard.alias("j"), used.alias("u")).first()
    assert row.u == near_duplicates.REGISTERS and abs(row.j - 0.5) < 0.15


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 300)]
    random.Random(2).shuffle(chain)
    star = [(500, i) for i in range(501, 550)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 301)} | {i: 500 for i in range(500, 550)}


def test_language_model(spark, sf_dir, result, texts):
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in texts.items()}
    held_out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    count = collections.Counter(w for i, ws in tokens.items() if not held_out[i] for w in ws)
    n, kinds = sum(count.values()), len(count)
    for r in result("op6_language_model"):
        ws = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out[r.doc_id], len(ws), sum(w in count for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + kinds + 1)) for w in ws), rel_tol=1e-9)
    unseen = [r for r in result("op6_language_model") if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learns = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    shuffled = language_model.score_texts(docs, learns, batch_bytes=100_000, broadcast_bytes=0).collect()
    broadcast = language_model.score_texts(docs, learns, batch_bytes=100_000).collect()
    assert sorted((r.doc_id, r.score) for r in shuffled) == sorted((r.doc_id, r.score) for r in broadcast)


def test_filter_levels():
    rng = np.random.default_rng(0)
    h, counts = rng.integers(0, 1 << 63, 20_000).astype(np.uint64), rng.zipf(1.5, 20_000).clip(1, 10**6)
    level = language_model.levels(counts)
    read = language_model.probed(language_model.filled_filter(h, level), h)
    assert (read >= level).all() and (read == level).mean() > 0.9
    back = language_model.counts_of(level)
    assert (np.abs(back - counts) <= 0.34 * counts).all() and (back[counts == 1] == 1).all()
    absent = language_model.probed(language_model.filled_filter(h, level), rng.integers(0, 1 << 63, 20_000).astype(np.uint64))
    assert (absent > 0).mean() < 0.1


def test_quality_rules(result, texts):
    for r in result("op9_quality_rules"):
        text = texts[r.doc_id] or ""
        w = text.encode().split()
        grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        times = collections.Counter(grams)
        repeated = {j for i, g in enumerate(grams) if times[g] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(w) < 20 or 100 * len(repeated) > 30 * len(w)) and not (r.base_failed and r.kept)


def test_divergence_keeps_good_and_drops_symbol_text(spark, sf_dir, result):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [r for r in result("op9_quality_rules") if not r.base_failed]
    assert all(r.kept for r in judged if labels.get(r.doc_id) == 1)
    p = np.array([[2.0, 0, 0], [0, 3, 0], [1, 1, 0]])
    # halves against a point: 1/2 log2(1/2 / 3/4) * 1/2 + 1/2 log2(2) * 1/2 + 1/2 log2(1 / 3/4)
    half = math.sqrt((0.5 * math.log2(2 / 3) + 0.5 + math.log2(4 / 3)) / 2)
    assert np.allclose(quality_rules.distance(p, np.array([5.0, 0, 0])), [0, 1, half])


@pytest.mark.parametrize("name, label, threshold", [("op2_toxicity", "toxic", 0.5), ("op5_quality_model", "quality", 0.7)])
def test_classifiers_on_held_out_rows(spark, sf_dir, result, name, label, threshold):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = result(name)
    n, rest = (5, 0) if name == "op2_toxicity" else (4, 2)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % n == rest) and 0 <= r.score <= 1 and r.predicted == (r.score >= threshold) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert held and sum(r.predicted == labels[r.doc_id] for r in held) >= 0.9 * len(held)


def test_composed_grammar_tells_clauses_apart():
    symbols = toxicity.Symbols({"scum": 3.0, "kill": 2.0, "lowe*": 4.0})
    kinds = lambda text: [k for k, x in zip(toxicity.KINDS, toxicity.clauses(text, symbols)) if x]
    assert kinds("You are scum.") == ["insult aimed"]
    assert kinds("She said: you are not scum!") == ["insult aimed negated reported"]
    assert kinds("He wrote you are scum") == ["insult aimed reported"]
    assert kinds("I will kill them, scum") == ["insult", "threat aimed"]
    assert kinds("Der Loweiei kommt. Nothing else") == ["insult"]
    assert kinds("") == kinds(None) == []


def test_url_rules(spark, sf_dir, result):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in result("op10_url_filter"):
        rest = pages[r.page_id].partition("://")[2]
        cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(rule), rule, says) for says, rule in url_filter.RULES if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith(rule[rule.index("/") :])]
        assert (r.host, r.path, r.rule) == (host, path, max(fits)[1] if fits else None)
        assert r.verdict == max(fits)[2] if fits else r.verdict in ("allow", "block")


def test_url_model_learns_hosts(spark):
    rng = random.Random(4)
    rows = [(i, f"http://{'good' if i % 2 else 'spam'}{rng.randrange(99)}.example.{'org/fr' if i % 2 else 'net/de'}/{i}") for i in range(400)]
    rows += [(1000 + i, f"http://{'good' if i % 2 else 'spam'}{rng.randrange(99)}.example.info/{i}") for i in range(40)]
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).where("rule is null").collect()}
    assert got == {1000 + i: "allow" if i % 2 else "block" for i in range(40)}


def test_mix_meets_targets(spark, result, texts):
    rows = result("op7_source_mix")
    size = {i: len((t or "").encode().split()) for i, t in texts.items()}
    assert all(r["size"] == size[r.doc_id] and r.taken == r.copies * r["size"] and 0 <= r.copies <= 3 for r in rows)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    names = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    total, limit = sum(size.values()), {s: 3 * sum(r["size"] for r in by[s]) for s in names}
    weight, target, free = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, {}, set(names)
    while True:
        left, w = total - sum(target.values()), sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * left / w > limit[s]]
        target |= {s: limit[s] for s in over}
        free -= set(over)
        if not over:
            break
    target |= {s: weight[s] * left / w for s in free}
    for s in names:
        assert math.isclose(by[s][0].target, target[s], rel_tol=1e-9)
        assert abs(sum(r.taken for r in by[s]) - target[s]) <= max(20, 0.05 * target[s])


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    sizes, p = rng.integers(0, 500, 300), rng.random(300)
    out = mixing.flight(sizes, p)
    assert ((out > 0) & (out < 1)).sum() <= 2 and math.isclose(out.sum(), p.sum(), abs_tol=1e-6) and math.isclose(out @ sizes, p @ sizes, rel_tol=1e-9)
    mean = np.mean([mixing.flight(np.array([1, 1, 1, 1, k]), np.array([0.3, 0.6, 0.5, 0.6, 0.0])) for k in range(400)], axis=0)
    assert np.abs(mean[:4] - [0.3, 0.6, 0.5, 0.6]).max() < 0.12  # probabilities are kept on average


def test_spans_find_long_repeats_only(spark):
    rng = random.Random(8)
    passages = [words(rng, n) for n in (55, 80, 130) for _ in range(6)]
    line = " ".join(words(rng, 13))
    rows, planted = [], {}
    for i in range(60):
        body = words(rng, 150)
        at = rng.randrange(150)
        if i % 2:
            passage = passages[i // 2 % len(passages)]
            body[at:at] = passage
            planted[i] = " ".join(passage)
        rows.append((i, line + "\n" + " ".join(body), "en", "a", 0))
    docs = spark.createDataFrame(rows, DOCS)
    spans = substrings.repeated_spans(docs).collect()
    text = {r[0]: r[1] for r in rows}
    first = {}
    for i, p in planted.items():
        first.setdefault(p, i)
    again = {i for i, p in planted.items() if first[p] != i}
    assert {r.doc_id for r in spans} == again
    for r in spans:
        piece = text[r.doc_id].encode()[r.start_byte : r.end_byte].decode().strip()
        assert piece in planted[r.doc_id] and piece in text[r.first_doc_id] and r.n_words >= 20
    cut = {r.doc_id: (r.text, r.changed) for r in substrings.without_spans(docs, substrings.repeated_spans(docs), "changed").collect()}
    assert all(cut[i] == (text[i], False) for i in text if i not in again)
    assert all(planted[i] not in cut[i][0] and len(cut[i][0]) < len(text[i]) for i in again)


def test_cuts_move_with_the_text():
    raw = " ".join(words(random.Random(1), 400)).encode()
    ends, counted = substrings.cuts(raw)
    moved, _ = substrings.cuts(b"something else in front " + raw)
    assert set(e + 24 for e in ends if e > 40) <= set(moved) and counted[-1] == 400 and ends[-1] == len(raw)


def test_leaks_of_edited_copies(spark):
    rng = random.Random(6)
    items = [(i, " ".join(words(rng, rng.randrange(12, 50)))) for i in range(30)]
    rows, planted = [], set()
    for i in range(90):
        body = words(rng, 200)
        if i % 3:
            item = items[i % 30]
            w = item[1].split()
            if i % 3 == 2:  # every sixth word replaced, one dropped, one added, case and stops changed
                w = [x.upper() + "," if j % 6 else words(rng, 1)[0] + "zz" for j, x in enumerate(w)]
                del w[len(w) // 2]
                w.insert(3, "inserted")
            body[50:50] = w
            planted.add((i, item[0]))
        rows.append((i, " ".join(body), "en", "a", 0))
    docs, benchmark = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    assert all(50 <= r.start_word <= 53 and r.score > 0.5 and (r.score == 1.0) == (r.doc_id % 3 == 1) for r in got)
    some = decontamination.with_leaks(docs, benchmark, block_words=100).select("doc_id", F.explode("leaks.item_id")).collect()
    assert {tuple(r) for r in some} == planted


def test_alignment_against_the_full_table():
    rng = np.random.default_rng(2)
    for _ in range(30):
        a, b = rng.integers(0, 6, 12).astype(np.uint64), rng.integers(0, 6, 25).astype(np.uint64)
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                table[i, j] = max(0, table[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
        assert decontamination.align(a, b)[0] == table.max()


def test_repeated_words():
    hashes = WordHashes().of([w.encode() for w in ("a b c d e f g h x a b c d e f g h y").split()])
    assert quality_rules.repeated_words(hashes) == 16


def test_warc_query_against_hashlib(spark, sf_dir, result):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    last = {}
    for i in sorted(pages):
        last[pages[i]] = i
    for r in result("op4_warc_revisits"):
        p = pages[r.page_id]
        again = len(p) >= 1000 and last[p] != r.page_id
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", last[p] if again else None)


def test_oracles_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES)
