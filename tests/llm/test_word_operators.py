"""Spelling variants, source mixing and ranked search against brute force, on odd rows and without rows."""

from __future__ import annotations

import math
import random
import re
import string
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from offerforge.llm import lexical, mixing, variants
from offerforge.session import scratch_path

DOCS = "doc_id long, text string, source string, n long, Word string, SIZE string, item string"


def documents(spark, rows):
    """Documents with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(*r, 1, "w", "s", "i") for r in rows], DOCS)


def odd_rows():
    rng = random.Random(5)
    words = ["color", "colour", "colors", "collor", "naïve", "naive", "naivé", "theatre", "theater", "aaaaa", "aaaa", "bbbbbb", "bbbbb", "ÀÀÀÀÀÀ"]
    words += ["".join(rng.choice("ab") for _ in range(rng.randint(5, 8))) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 80))), rng.choice(["a", "b", "c", "é", None])) for i in range(150)]
    rows += [(150, None, "a"), (151, "", "b"), (152, "Color COLOR color\x0bcolor", "b"), (None, "color theatre theatre", "z"), (None, "naive naive", None)]
    rows += [(7, rows[7][1], rows[7][2])] * 3  # repeated rows
    rows += [(201, " ".join(["zzqaaaa"] * 3 + ["zzqaaab"] * 8 + ["zzqaabb"] * 20), "b")]  # a chain of forms
    rows += [(200, " ".join(["theatre", "colour"] * 20_000), "c")]  # a very long text
    return rows


# --- spelling variants --------------------------------------------------------------------------------------------


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    counts = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    around = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(around[w]), counts.get(form[w])))
    return out


@pytest.mark.parametrize("at_once", [256, 2])
def test_variants_equal_brute_force(spark, monkeypatch, at_once):
    """With a common chunk from three words on, most pairs come through the rest of the word."""
    monkeypatch.setattr(variants.near_pairs, "__defaults__", (at_once,))
    rows = odd_rows()
    got = [tuple(r) for r in variants.spelling_variants(documents(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_variants(rows)
    assert any(r[1] for r in got) and any(r[1] and r[1] != r[2] for r in got)


def test_near_pairs_on_all_short_words(spark):
    """Every word of five and six letters over two: each one edit away from many."""
    words = [w for n in (5, 6) for w in map("".join, __import__("itertools").product("xy", repeat=n))]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    want = {(a, b) if (len(a), a) < (len(b), b) else (b, a) for a in words for b in words if near(a, b)}
    for at_once in (256, 3):
        got = [(r.a, r.b) for r in variants.near_pairs(df, at_once).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_variants_of_nothing(spark):
    assert variants.spelling_variants(documents(spark, [])).count() == 0
    assert variants.spelling_variants(documents(spark, [(1, None, "a"), (2, "", "a")])).count() == 0


# --- mixing -------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Shares by rounds of capping, as stated."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target = share * sum(sizes.values()), dict.fromkeys(sizes, 0.0)
    open_, left = set(sizes), total
    while open_ and left > 1e-9:
        whole, used = sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            add = min(left * weight[s] / whole, most * sizes[s] - target[s])
            target[s] += add
            used += add
            if target[s] >= most * sizes[s] - 1e-9:
                open_.discard(s)
        left -= used
    return target


def test_mix_keeps_shares_and_copies(spark):
    rows = odd_rows() + [(1000 + i, "one two three four", f"s{i % 9}") for i in range(4000)]
    docs = documents(spark, rows)
    planned = [r.asDict() | {"text": None} for r in mixing.plan(docs).collect()]
    sizes, by_key = Counter(), {}
    for key, text, source, *_ in rows:
        n = len(re.findall("[^\\x20\\x09-\\x0D]+", text or ""))
        sizes[source] += n
        by_key.setdefault((key, n), source)
    want = brute_targets(sizes)
    assert len(planned) == len(rows)
    taken = Counter()
    for r in planned:
        source = by_key[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(want[source])
        assert math.floor(r["target"] / max(r["source_size"], 1)) <= r["copies"] <= 2
        taken[source] += r["copies"] * r["size"]
    for source in (f"s{i}" for i in range(9)):
        assert taken[source] == pytest.approx(want[source], rel=0.02)
    again = mixing.plan(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in mixing.plan(docs).collect())

    emitted = mixing.mixed(docs)
    assert emitted.columns == [*docs.columns, "copy"]
    copies = Counter((r.doc_id, r.source, r.n_words) for r in emitted.select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).alias("n_words")).collect())
    planned_copies = sum(r["copies"] for r in planned)
    assert sum(copies.values()) == planned_copies


def test_mix_of_nothing(spark):
    assert mixing.plan(documents(spark, [])).count() == 0 and mixing.mixed(documents(spark, [])).count() == 0
    silent = mixing.plan(documents(spark, [(1, None, None), (2, " ", "a")])).collect()
    assert [(r["size"], r.source_size, r.target, r.copies) for r in silent] == [(0, 0, 0.0, 0)] * 2


# --- ranked search ------------------------------------------------------------------------------------------------

TERM = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def brute_search(items, rows, k=10):
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    docs = [(key, Counter(re.findall(TERM, (text or "").translate(lower)))) for key, text, *_ in rows]
    docs = [(key, c, sum(c.values())) for key, c in docs if c]
    n_docs, total = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for key, text in dict.fromkeys((k, t) for k, t in items if t is not None):
        asked, scored = Counter(re.findall(TERM, text.translate(lower))), []
        for doc, c, n in docs:
            m = 25 + (75 * n * n_docs) // total
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t, q in asked.items() if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(key, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 24)
    rows = odd_rows() + [(300 + i, f"tie {'pad ' * (i % 3)}rare{i % 4} x{i}", "a") for i in range(60)]
    items = [(1, "colour of the theatre, Theatre"), (2, "naïve NAIVE"), (3, ""), (4, None), (5, "tie rare1"), (5, "tie rare2"), (6, "unheard of"),
             (1, "colour of the theatre, Theatre"), (None, "rare3 tie"), (7, "color " * 30)]
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, score string")
    got = sorted((tuple(r) for r in lexical.ranked_search(asked, documents(spark, rows).repartition(3)).collect()), key=str)
    assert got == brute_search(items, rows)


def test_search_in_passes_and_of_nothing(spark):
    rows, items = odd_rows(), [(i, f"colour theatre naive {i}") for i in range(12)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    path = scratch_path(spark, "signatures")
    lexical.build_index(documents(spark, rows), path)
    got = sorted((tuple(r) for r in lexical.search(spark, path, asked, k=3, query_bytes=64).collect()), key=str)
    assert got == brute_search(items, rows, 3)
    assert lexical.ranked_search(asked, documents(spark, [])).count() == 0
    assert lexical.ranked_search(asked.limit(0), documents(spark, rows)).count() == 0
    assert lexical.ranked_search(asked, documents(spark, [(1, None, "a"), (2, "?!", "a")])).count() == 0


def test_bounds_are_never_below_scores():
    """Upper bounds from the slices against exact scores, with few bits so that false hits occur."""
    rng = random.Random(3)
    vocabulary = [f"t{i}".encode() for i in range(40)]
    texts = [b" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(50)]
    weights = {t: rng.randint(1, 3000) for t in vocabulary}
    queries = lexical._Queries([b" ".join(rng.choices(vocabulary, k=6)) for _ in range(20)], weights)
    block = lexical._Block(128)
    import numpy as np

    for i, text in enumerate(texts):
        counts = Counter(lexical.terms(text))
        bits = [lexical.signature_rows(np.array([lexical.digest(t) for t, n in counts.items() if n >= least], np.uint64), level, 128).ravel()
                for level, least in enumerate(lexical.LEVELS)]
        block.add(i, sum(counts.values()), text, np.concatenate(bits))
    lengths, total = block.lengths, sum(block.lengths)
    norms = [lexical.norm(n, 50, total) for n in lengths]
    for own, bound in zip(queries.terms, lexical._bounds(queries, 128, block.slices(), 50, norms, lengths)):
        for place, text in enumerate(texts):
            counts = Counter(lexical.terms(text))
            assert sum(w * lexical.part_score(counts[t], norms[place]) for t, w in own if t in counts) <= bound[place]
