"""Operators that relate rows: near duplicates, quality cutoffs, chat windows, url rules, shards, the pipeline."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations, product

import duckdb
import numpy as np
import pytest
import xxhash
from oracle_check import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from offerforge.llm import chat, components, decontaminate, jaccard, quality, queries, reshard, simhash, urlrules
from offerforge.llm.encoder import TextEncoder
from offerforge.session import scratch_path

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = connect(SMALL)
    assert differences(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], SMALL) == []


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_covers_its_table(spark, name):
    rows = queries.QUERIES[name](spark, SMALL)
    count = rows.count()
    whole = {"op4_simhash_groups": "documents", "op5_main_text": "pages", "op8_token_files": "documents", "op10_reshard": "documents"}
    if name in whole:
        assert count == spark.read.parquet(f"{SMALL}/{whole[name]}.parquet").count()
    assert count > 0


def _fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(prints):
    """Smallest key reachable by fingerprints of at most 3 differing bits."""
    distinct = sorted(set(prints.values()))
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    array = np.array(distinct, dtype=np.uint64)
    for k, f in enumerate(distinct):
        for j in np.nonzero(np.bitwise_count(array ^ np.uint64(f)) <= 3)[0]:
            parent[root(f)] = root(distinct[int(j)])
    least = {}
    for key, f in prints.items():
        least[root(f)] = min(key, least.get(root(f), key))
    return {key: least[root(f)] for key, f in prints.items()}


def test_simhash_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF_POINTS", 8)
    docs = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    rng, base = random.Random(4), docs[5][1].split()
    for k in range(300):  # a large group of near copies
        words = list(base)
        words[rng.randrange(len(words))] = f"x{k}"
        docs.append((10_000 + k, " ".join(words)))
    docs += [(20_000, None), (20_001, ""), (20_002, "\u00a0"), (20_003, "two words"), (20_004, "TWO  words")]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, fp int, id int")
    rows = simhash.group_near_duplicates(frame).collect()
    prints = {k: _fingerprint(t) for k, t in docs}
    assert {r.doc_id: r.fp & (1 << 64) - 1 for r in rows} == prints
    want = _groups(prints)
    assert {r.doc_id: r.component_id for r in rows} == want
    assert simhash.group_near_duplicates(frame.where("false")).count() == 0
    assert simhash.keep_one(frame.where("false")).count() == 0


def _similar(docs):
    """Pairs of keys with a Jaccard index of 0.8 or more of five-word shingles, and the shingles of each text."""
    sets = {}
    for key, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets[key] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    held = defaultdict(list)
    for key in sorted(sets):
        for shingle in sets[key]:
            held[shingle].append(key)
    common = Counter(pair for keys in held.values() for pair in combinations(keys, 2))
    return {p for p, n in common.items() if n >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - n)}


def _check_groups(docs, component):
    """Most similar pairs are joined, and who is joined has a partner that is similar or within three bits."""
    pairs = _similar(docs)
    joined = {p for p in pairs if component[p[0]] == component[p[1]]}
    assert len(joined) >= 0.9 * len(pairs)
    partner = Counter(k for p in joined for k in p)
    prints = {k: _fingerprint(docs[k], 5) for k in docs}
    for key, first in component.items():
        if key != first and not partner[key]:
            assert any((prints[key] ^ prints[k]).bit_count() <= 3 for k in docs if k != key and component[k] == first)


def test_similar_groups_against_brute_force(spark):
    docs = dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    rng = random.Random(4)
    for key in (5, 9, 40):
        for k in range(60):  # near copies, each with a few other words
            words = docs[key].split()
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = f"x{k}"
            docs[10_000 * key + k] = " ".join(words)
    docs |= {900_000: None, 900_001: "", 900_002: "two words", 900_003: "TWO  words"}
    frame = spark.createDataFrame([(k, t, 1, 2) for k, t in docs.items()], "doc_id long, text string, fp int, _kept int")
    component = {r.doc_id: r.component_id for r in simhash.group_similar(frame).collect()}
    assert component.keys() == docs.keys()
    _check_groups(docs, component)
    kept = simhash.keep_one(frame)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(component.values())) and kept.columns == frame.columns


def _exact_groups(docs):
    """Smallest key reachable over pairs of 0.8 or more."""
    parent = {k: k for k in docs}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in _similar(docs):
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {k: root(k) for k in docs}


def test_similar_groups_are_exact(spark):
    """Copies at 0.8 of one another, of a base only, in chains, of few and of many words; a base with the largest key."""
    docs = dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    rng, key = random.Random(7), 10_000
    for size in (9, 14, 60, 240, 1500):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for share in (0.01, 0.02, 0.03, 0.04, 0.05):
            for _ in range(6):
                words = list(base)
                for _ in range(max(1, round(size * share))):
                    words[rng.randrange(size)] = f"y{rng.randrange(10**6)}"
                docs[key] = " ".join(words).upper() if key % 3 else "\n".join(words)
                key += 1
        docs[key + 50_000] = " ".join(base)
        for k in range(1, 30):  # a chain: each a little further
            docs[key] = " ".join(base[: max(1, size - k * max(1, size // 25))])
            key += 1
    docs |= {900_000: None, 900_001: "", 900_002: "GRÜN ist die Farbe", 900_003: "grün ist die farbe"}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.group_similar(frame).collect()} == _exact_groups(docs)


def test_near_copies_go_through_the_trees_first(spark, monkeypatch):
    """The pairs of the trees join what three bits join; those that are similar are not searched for again, and the groups are
    exact."""
    rng, docs = random.Random(11), {}
    for base in range(4):
        words = [f"b{base}w{rng.randrange(10**6)}" for _ in range(400)]
        for k in range(8):
            copy = list(words)
            copy[rng.randrange(400)] = f"z{base}{k}"
            docs[100 * base + k] = " ".join(copy)
    docs |= {k: " ".join(f"o{rng.randrange(10**6)}" for _ in range(50)) for k in range(900, 910)}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    parent = {k: k for k in docs}
    for r in simhash.nearest_pairs(frame, frame.select("doc_id")).collect():
        low, high = sorted((parent[r.a], parent[r.b]))
        parent = {k: low if g == high else g for k, g in parent.items()}
    assert parent == _groups({k: _fingerprint(t) for k, t in docs.items()})
    assert len(set(parent.values())) < len(docs)
    asked, near = [], jaccard._near

    def kept(pairs, *rest):
        asked.append({(r.a, r.b) for r in pairs.collect()})
        return near(pairs, *rest)

    monkeypatch.setattr(jaccard, "_near", kept)
    assert {r.doc_id: r.component_id for r in simhash.group_similar(frame).collect()} == _exact_groups(docs)
    assert asked[0] and not any(parent[a] == parent[b] for pairs in asked[1:] for a, b in pairs)


def test_equal_fingerprints_are_no_link(spark):
    """One fingerprint by a phrase that is said over and over, but other words behind it; and a copy of the second text."""
    docs = {k: "a b c d e f g " * 200 + " ".join(f"t{k}x{n}" for n in range(40)) for k in (1, 2, 3)}
    docs[9] = docs[2].replace("t2x39", "other")
    assert len({_fingerprint(t, 5) for t in docs.values()}) == 1
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.group_similar(frame).collect()}
    assert got == _exact_groups(docs) == {1: 1, 2: 2, 3: 3, 9: 2}


def test_wide_pairs_carry_groups_over_batches(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    near = base[:200].copy()
    for _ in range(8):
        near ^= np.uint64(1) << rng.integers(0, 62, 200).astype(np.uint64)
    fps, more = np.concatenate([base, near]), rng.integers(0, 2**63, 300, dtype=np.uint64)
    more = np.concatenate([more, more[:200]])
    columns = zip(fps.view("<i8").tolist(), more.view("<i8").tolist(), range(500), strict=True)
    frame = spark.createDataFrame(list(columns), "fp long, fp2 long, id long")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        got = {(r.a, r.b) for r in simhash.wide_pairs(frame).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    want = {(i, j) for i in range(500) for j in range(i + 1, 500) 
            if int(fps[i] ^ fps[j]).bit_count() <= simhash.WIDE_RADIUS
            and int(fps[i] ^ fps[j]).bit_count() + int(more[i] ^ more[j]).bit_count() <= simhash.WIDE_TOTAL}
    assert got <= want and len(got) >= 0.9 * len(want) and len(want) >= 200


def test_wide_pairs_of_a_dense_group_are_all_given(spark):
    rows = [((1 << k) ^ 0x1234567, 1 << (k + 20), 100 - k) for k in range(12)]  # any two are 4 bits apart
    frame = spark.createDataFrame(rows, "fp long, fp2 long, id long")
    ids = sorted(r[2] for r in rows)
    assert {(r.a, r.b) for r in simhash.wide_pairs(frame, recall=0.9999).collect()} == set(combinations(ids, 2))


def test_simhash_null_keys_and_repeated_rows(spark):
    docs = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (7, "a b c d"), (None, "quite another text"), (9, "q w e r t")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id) for r in simhash.group_near_duplicates(frame).collect())
    assert got == Counter({(None, 3): 1, (3, 3): 2, (7, 3): 1, (None, None): 1, (9, 9): 1})
    assert Counter(r.doc_id for r in simhash.keep_one(frame).collect()) == Counter({None: 2, 3: 1, 9: 1})


def test_shards_and_parts_miss_no_pair(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 800, dtype=np.uint64)
    near = base[:400] ^ (np.uint64(1) << rng.integers(0, 60, 400).astype(np.uint64)) ^ (np.uint64(7) << np.uint64(60)) & np.uint64(3 << 60)
    fps = np.unique(np.concatenate([base, near]))
    monkeypatch.setattr(simhash, "POINTS_A_SHARD", 20)
    monkeypatch.setattr(simhash, "BOTH_SIDES", 2.2)
    frame = spark.createDataFrame([(int(f), k) for k, f in enumerate(fps.view("<i8"))], "fp long, id long")
    found = components.components(simhash.links(frame))
    got = {r.node: r.component for r in found.collect()}
    want = _groups({k: int(f) for k, f in enumerate(fps)})
    sizes = Counter(want.values())
    assert got == {k: c for k, c in want.items() if sizes[c] > 1} and got


def test_components_of_chains_stars_and_nothing(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5000), (None, 3)]
    random.Random(1).shuffle(links)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1300)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = defaultdict(list)
    for k in range(len(words) - 2):
        windows[tuple(words[k : k + 3])].append(k)
    again = {p + d for at in windows.values() if len(at) > 1 for p in at for d in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again))


@pytest.mark.parametrize("bits", [24, 3])
def test_base_columns_against_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(quality, "PLACE_BITS", bits)
    rng = random.Random(8)
    texts = [None, "", " ", "\n\n", "a", "a b", "a b c", "a a a", "a a a a a", "a b c a b c", "#*$%&|<> \u00a0x\u00a0 \x1c", "x" * 5000,
             "word " * 5000, "\u4e2d \u6587 " * 20, "l\nl\n l\n\nl"]
    texts += ["".join(rng.choices(["a ", "b ", "c\n", "\t", "#x ", "\u00e9 "], k=rng.randrange(60))) for _ in range(300)]
    frame = spark.createDataFrame([(k, t, 5, 1) for k, t in enumerate(texts)], "doc_id long, text string, N_Words int, _base int")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = {r.doc_id: tuple(r[n] for n in names) for r in quality.measured(frame).collect()}
    assert got == {k: _base(t) for k, t in enumerate(texts)}


def test_binomial_bound_is_exact(spark):
    for n, k, p in ((10, 0, 0.1), (50, 3, 0.02), (1000, 7, 0.02), (20_000, 60, 0.004), (3, 3, 0.5)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if n <= 1000 else None
        got = spark.range(1).select(quality.log_binomial(F.lit(n).cast("long"), F.lit(k).cast("long"), p)).first()[0]
        if want is None:
            logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)
                    for i in range(k + 1)]
            want = math.exp(max(logs)) * sum(math.exp(x - max(logs)) for x in logs)
        assert got == pytest.approx(math.log(want), abs=1e-7)


def test_cutoffs_reject_bad_and_spare_good(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for k in range(6000):
        lang, good = "ab"[k % 2], k % 5 > 0
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        if not good:
            words = ["|#|" if n % 2 else w for n, w in enumerate(words)]
        docs.append((k, " ".join(words), lang))
        if k % 3:
            labels.append((k, int(good)))
    docs += [(9000, None, "a"), (9001, "", None), (9002, "few words", "c"), (None, " ".join(f"w{k}" for k in range(400_000, 400_060)), "a")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, lang string, stratum int")
    marks = spark.createDataFrame(labels + [(None, 1), (77, None)], "doc_id long, quality int")
    rows = quality.quality(frame, marks, risk=0.1).collect()
    assert len(rows) == len(docs)
    verdict = {r.doc_id: r.kept for r in rows}
    assert all(verdict[k] == (k % 5 > 0) for k in range(6000))
    assert not verdict[9000] and not verdict[9001] and not verdict[9002] and verdict[None]
    kept = quality.filtered(frame, marks, risk=0.1)
    assert kept.columns == frame.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k for k, v in verdict.items() if v)
    nothing = quality.quality(frame, marks.where("false")).collect()
    assert all(r.kept != r.base_failed for r in nothing)
    assert quality.quality(frame.where("false"), marks).count() == 0


def test_few_labels_choose_no_cutoff(spark):
    docs = [(k, " ".join(["a#b"] * 3 + [f"w{k}x{n}" for n in range(60)]), "x") for k in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(k, 1) for k in range(40)], "doc_id long, quality int")
    assert all(r.kept for r in quality.quality(frame, marks).collect())


def _chats():
    rng = random.Random(6)
    rows = []
    for conv in range(25):
        start = 0
        if conv % 3 == 0:
            rows.append((conv, 0, "system", f"rules {conv} <turn x> & </turn>"))
            start = 1
        for k in range(rng.randint(1, 30)):
            text = " ".join(rng.choices(["word", "</turn>", "<turn user>", "&lt;", "\\n", "\u00e9", "\n"], k=rng.randrange(60)))
            rows.append((conv, start + k, ["user", "assistant", "tool>\n"][k % 3], text))
    rows += [(50, k, ["user", "assistant"][k % 2], f"turn {k}") for k in range(600)]
    rows += [(51, 0, "system", "only this"), (52, 0, None, None), (52, 0, None, None), (None, 1, "user", "of none"), (None, None, "assistant", "not numbered"), (53, None, "user", "not numbered"), (53, 0, "user", "numbered"),
             (54, 0, "assistant", "long " * 4000), (54, 1, "user", "")]
    rows += [(55, 1000 * k, ["system", "user", "assistant", "user"][k], f"sparse {k} " + "w " * 60) for k in range(4)]
    rows += [(56, 300 + 7 * k, ["user", "assistant"][k % 2] if k else "system", f"late {k}") for k in range(600)]
    rows += [(57, 5, "assistant", f"one number {k % 50}") for k in range(300)]
    return rows


def test_windows_cover_each_turn_once_within_budget(spark):
    rows, budget = _chats(), 120
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, window int, head string")
    found = chat.format_windows(frame, budget=budget, history_turns=3, history_tokens=40)
    found = found.withColumns({"read": chat.read_turns(F.col("text"), F.col("repeated")), "loss": chat.loss_text(F.col("text"), F.col("loss_spans"))})
    windows = sorted(found.collect(), key=lambda r: (r.conv_id or -1, r.block, r.window))
    turns, loss = defaultdict(list), defaultdict(str)
    for w in windows:
        turns[w.conv_id] += [tuple(t) for t in w.read]
        loss[w.conv_id] += w.loss
        assert (w.tokens > budget) == w.over_budget
        pieces = re.findall(r"[^\W\d_]{1,4}|\d|[^\w\s]|_", w.text)
        assert len(pieces) == w.tokens
        if w.over_budget:
            assert w.turns - w.repeated <= 1 + (w.window == w.block == 0 and w.text.startswith("<turn system>"))
    want, said = defaultdict(list), defaultdict(str)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or -1, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want[conv].append((role or "", text or ""))
        said[conv] += (text or "") if role == "assistant" else ""
    assert dict(turns) == dict(want)
    assert {k: v for k, v in loss.items() if v} == {k: v for k, v in said.items() if v}
    assert any(w.repeated > 1 for w in windows) and max(w.block for w in windows) == 2
    assert {w.block for w in windows if w.conv_id in (50, 56)} == {0, 1, 2} and {w.block for w in windows if w.conv_id == 57} == {0, 1}
    assert all(w.repeated == 3 + (w.conv_id == 56) for w in windows if w.conv_id in (50, 56) and w.block and not w.window)
    assert [(w.repeated, w.text.count("<turn ")) for w in windows if w.conv_id == 55] == [(0, 2), (1, 2), (1, 2)]
    system = [w for w in windows if w.conv_id in (55, 56) or w.conv_id is not None and w.conv_id % 3 == 0 and w.conv_id < 25]
    assert all(w.text.startswith("<turn system>\n") for w in system)
    assert chat.format_windows(frame.where("false")).count() == 0


def test_url_rules_and_parts(spark):
    urls = ["https://WWW.Example.com/en/a?x#y", "http://example.com/en/", "http://a.example.com/en/b", "http://example.com", "http://x.net/es/1",
            "http://x.net/de/1", "//no", None, "", "http://evilexample.com/en/", "a://b?c", "a://B#c", "x://y/z\nw/?k=v", "ftp://h/p://q/r"]
    frame = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    host, path = urlrules.host(F.col("url")), urlrules.path(F.col("url"))
    rows = frame.select("page_id", host.alias("h"), path.alias("p"), urlrules.rule_verdict(host, path, queries.URL_RULES).alias("v")).orderBy("page_id").collect()
    for r, url in zip(rows, urls, strict=True):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        want = (m[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m[2]) if m else ("", "")
        assert (r.h, r.p) == want
    verdicts = {r.page_id: (r.v.rule, r.v.verdict) if r.v else None for r in rows}
    assert verdicts[0] == ("www.example.com/en/", "allow") and verdicts[1] == ("example.com/en/", "block")
    assert verdicts[2] == ("example.com/en/", "block") and verdicts[3] is None and verdicts[4] == ("net/es/", "block")
    assert verdicts[5] is None and verdicts[7] is None and verdicts[9] == ("com/", "allow")


def test_mined_rules_against_brute_force(spark):
    rng = random.Random(12)
    rows = []
    for k in range(400):
        spam = rng.random() < 0.3
        site = rng.choice(["pills", "casino"] if spam else ["news", "blog", "pills"])
        url = f"http://{site}.example.org/{rng.choice(['en', 'de'])}/{'win' if spam and rng.random() < .7 else 'read'}/{k}?ref={k}"
        bad = None if k % 4 == 0 else spam
        rows.append((k, url, bad))
    rows += [(900, None, True), (901, "", False), (902, rows[0][1], None), (902, rows[0][1], None)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, bad boolean, mined string")
    items = {r.page_id: frozenset(r.t) for r in frame.select("page_id", urlrules.tokens(F.col("url")).alias("t")).collect()}
    seen, bad = Counter(), Counter()
    for k, _, label in rows:
        if label is not None:
            for size in (1, 2, 3):
                for part in combinations(sorted(items[k]), size):
                    seen[part] += 1
                    bad[part] += label
    rules = {p for p in seen if bad[p] >= urlrules.LEAST_PAGES and bad[p] >= urlrules.LEAST_CONFIDENCE * seen[p]}
    mined = urlrules.mine(frame)
    judged = urlrules.judge(frame, mined)
    want = {k: any(set(p) <= items[k] for p in rules) for k, _, _ in rows}
    assert {r.page_id: r.mined for r in judged.collect()} == want and any(want.values()) and not all(want.values())
    assert judged.count() == len(rows)
    for r in mined.collect():
        assert r.support == bad[tuple(sorted(r.tokens))] and r.anchor in r.tokens
    none = urlrules.mine(frame.where("false"))
    assert none.count() == 0 and not any(r.mined for r in urlrules.judge(frame, none).collect())


def _cheapest(supply, room, cost):
    if not supply:
        return 0
    best = math.inf
    for parts in product(*(range(min(supply[0], r) + 1) for r in room)):
        if sum(parts) == supply[0]:
            rest = _cheapest(supply[1:], [r - p for r, p in zip(room, parts, strict=True)], cost[1:])
            best = min(best, rest + sum(p * c for p, c in zip(parts, cost[0], strict=True)))
    return best


@pytest.mark.parametrize("seed", range(60))
def test_flow_is_cheapest(seed):
    rng = random.Random(seed)
    supply, room = [rng.randrange(5) for _ in range(rng.randint(1, 3))], [rng.randrange(6) for _ in range(rng.randint(1, 3))]
    while sum(room) < sum(supply):
        room[rng.randrange(len(room))] += 1
    cost = [[rng.randrange(6) for _ in room] for _ in supply]
    flow = reshard.min_cost_flow(supply, room, cost)
    assert [sum(f) for f in flow] == supply and all(sum(f[j] for f in flow) <= r for j, r in enumerate(room))
    assert sum(f * c for fs, cs in zip(flow, cost, strict=True) for f, c in zip(fs, cs, strict=True)) == _cheapest(supply, room, cost)


def test_reshard_moves_little_and_reads_back(spark, monkeypatch):
    monkeypatch.setattr(reshard, "BLOCK_BYTES", 3000)
    docs = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    docs += [(10_000, None), (10_001, ""), (None, "no key"), (10_002, "twice"), (10_002, "twice")]
    frame = spark.createDataFrame([(*d, "s", 7) for d in docs], "doc_id long, text string, shard string, _to int").repartition(3)
    old = F.pmod(F.coalesce(F.col("doc_id"), F.lit(1)), F.lit(3)).cast("int")
    planned = reshard.plan(frame, old, 5)
    rows = planned.select("doc_id", "text", "_old", "shard").collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(docs)
    sizes, before, largest = Counter(), Counter(), max(size(t) for _, t in docs)
    for r in rows:
        sizes[r.shard] += size(r.text)
        before[r._old] += size(r.text)
    total = sum(sizes.values())
    assert all(abs(sizes[k] - total / 5) <= 3 * largest for k in range(5))
    moved = sum(size(r.text) for r in rows if r._old != r.shard)
    least = sum(max(0, before[k] - total // 5) for k in before)
    assert moved <= least + 8 * largest
    path = scratch_path(spark, "shards")
    reshard.rewrite(planned, path)
    back = reshard.read_back(spark, path).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard) for r in back) == Counter(
        (r.doc_id, size(r.text), zlib.crc32((r.text or "").encode()), r.shard) for r in rows)
    for shard in range(5):
        slots = sorted(r.slot for r in back if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_reshard_leaves_shards_in_place(spark):
    frame = spark.createDataFrame([(k, "x" * 9) for k in range(90)], "doc_id long, text string")
    planned = reshard.plan(frame, F.col("doc_id") % 3, [300, 300, 300])
    assert planned.where("_old != shard").count() == 0
    path = scratch_path(spark, "shards")
    planned = reshard.plan(frame, F.col("doc_id") % 3, [300, 200, 300, 100])
    reshard.rewrite(planned, path, affected_only=True)
    assert {r.shard for r in reshard.read_back(spark, path).collect()} == {1, 3}
    assert reshard.plan(frame.where("false"), F.col("doc_id") % 3, 4).count() == 0
    with pytest.raises(ValueError, match="hold less"):
        reshard.plan(frame, F.col("doc_id") % 3, [1, 1])


def test_pipeline_stages_against_brute_force(spark):
    con = connect(SMALL)
    docs = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.ORACLES['op2_quality_rules']}) WHERE kept").fetchall()}
    items = [decontaminate.normalized(r[0]) for r in con.execute("SELECT text FROM benchmark").fetchall()]
    frame, seen = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SMALL)
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        seen.append({r.doc_id for r in frame.select("doc_id").collect()})
    component = {r.doc_id: r.component_id for r in simhash.group_similar(
        spark.createDataFrame([(k, docs[k]) for k in kept], "doc_id long, text string")).collect()}
    _check_groups({k: docs[k] for k in kept}, component)
    clean = {k for k in set(component.values()) if not any(i in decontaminate.normalized(docs[k]) for i in items)}
    assert seen == [kept, set(component.values()), clean] and len(clean) < len(seen[1])
    rows = corpus_pipeline.run(spark, SMALL).collect()
    library = TextEncoder(queries.vocabulary("word_bpe_49k.json"))._library
    lengths = Counter()
    for r in rows:
        lengths[r.doc_id] += r.length
    assert lengths == Counter({k: len(library(docs[k])) // 4 + 1 for k in clean})


def test_stages_take_an_empty_table(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame, SMALL).count() == 0
