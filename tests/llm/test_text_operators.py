"""Operators on single texts: packing, token files, licences, benchmark passages, main text."""

from __future__ import annotations

import random
import time
import weakref
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from offerforge.llm import decontaminate, encoder, licenses, maintext, packing, tokenstore
from offerforge.llm.encoder import TextEncoder
from offerforge.session import BATCH_SETTING, scratch_path, text_batches, written

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"
#: Null, empty, white space alone, repeated rows, a null key, a very long text, one without blanks; further columns that
#: have names of the operators' own.
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "the same text here"), (4, "the same text here"), (None, "no key"),
    (5, "word " * 30_000), (6, "x" * 20_000), (7, "don't\r\n\u00a0stop\x1c<|endoftext|> \u00e9\u0301 \U0001f600"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, t, 1, "a", 2) for k, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, length int, shard string, component int")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="module")
def documents():
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY 1").fetchall()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_are_the_librarys(path, documents):
    ours, rng, library = TextEncoder(path), random.Random(1), Tokenizer.from_file(path)
    parts = ["a", "Zoe", "\u00e9", "\u00df", "\u0130", "\u03a3", "\u03c3", "'", "'s", " ", "  ", "\n", "\n\n", "\t", "\r\n",
             "\u00a0", "\x1c", "\x85", ".", ",", "1", "23", "\u00bd", "\u4e2d", "e\u0301", "\u200b", "\u3000", "\U0001f600",
             "<|endoftext|>", "-", "_", "\x00", "can't.", "end.,"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(15))) for _ in range(1500)] + [t for _, t in documents[:60]]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ours.ids(text), "<u4").tolist() == want, text[:80]


def _placed(segments):
    for length, first, last, sequence, each, offset in segments:
        for r in range(first, last + 1):
            yield sequence + (r - first) // each, offset + (r - first) % each * length, length


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_gapless_and_no_worse_than_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 100, 4096])
    counts = Counter(rng.randint(1, rng.choice([capacity, max(1, capacity // 3)])) for _ in range(rng.randrange(300)))
    segments, sequences = packing.plan(counts, capacity)
    held = defaultdict(list)
    for sequence, offset, length in _placed(segments):
        held[sequence].append((offset, length))
    assert Counter(n for x in held.values() for _, n in x) == counts and len(held) == sequences
    for x in held.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= capacity
    rooms = []
    for n in sorted(counts.elements(), reverse=True):  # best fit decreasing, one by one
        fits = [k for k, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= n
        else:
            rooms.append(capacity - n)
    assert sequences <= len(rooms)


def _check_packed(rows, docs, capacity):
    library = TextEncoder(WORD)._library
    want = Counter()
    for doc, text in docs:
        ids = library(text or "") + (1).to_bytes(4, "little")
        for n, at in enumerate(range(0, len(ids), 4 * capacity)):
            part = ids[at : at + 4 * capacity]
            want[doc, n, at // 4, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for x in held.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= capacity


def test_packing_against_the_library(spark, odd, none, documents):
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    _check_packed(packing.pack_documents(docs, WORD, capacity=512).collect(), documents, 512)
    rows = packing.pack_documents(odd, WORD).collect()
    _check_packed(rows, ODD, 4096)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert packing.pack_documents(none, WORD).count() == 0


def test_packing_keeps_columns_of_its_own_names(spark):
    cut = spark.createDataFrame([(k, 0, 7, k % 3 + 1, "a", 2, 9) for k in range(30)],
                                "doc_id long, piece int, ids_crc32 long, length long, _rank string, Offset int, _bucket int")
    rows = packing.pack(cut, 4).collect()
    assert len(rows) == 30 and all(r["_rank"] == "a" and r["_bucket"] == 9 and r.offset + r.length <= 4 for r in rows)
    assert Counter(rows[0].asDict().keys())["offset"] == 1 and len(rows[0]) == 8


def test_buckets_number_a_hot_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_A_BUCKET", 50)
    docs = [(k, "one two three" if k % 3 else "four " * (k % 40)) for k in range(900)]
    rows = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), WORD, capacity=64).collect()
    _check_packed(rows, docs, 64)


def _index_of(docs):
    library, at, out = TextEncoder(BYTE)._library, 0, []
    for doc, text in docs:
        ids = library(text or "") + bytes(4)
        out.append((doc, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    return out


def test_token_files_round_trip(spark, odd, none, documents, monkeypatch):
    monkeypatch.setattr(tokenstore, "FILE_CHARS", 60_000)
    monkeypatch.setattr(tokenstore, "SEGMENT_BYTES", 20_000)
    path = scratch_path(spark, "tokens")
    tokenstore.write_tokens(spark.createDataFrame(documents, "doc_id long, text string").repartition(5), path, BYTE)
    got = sorted(map(tuple, tokenstore.token_index(spark, path).collect()))
    assert got == _index_of(documents)
    assert len({r.file for r in tokenstore.read_tokens(spark, path).select("file").collect()}) > 2
    some = {r.doc_id: r.ids for r in tokenstore.read_tokens(spark, path, [3, 77, 123456]).collect()}
    library = TextEncoder(BYTE)._library
    assert some == {k: library(dict(documents)[k]) + bytes(4) for k in (3, 77)}

    path = scratch_path(spark, "tokens")
    tokenstore.write_tokens(odd, path, BYTE)
    got = [tuple(r) for r in tokenstore.token_index(spark, path).orderBy("start").collect()]
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == _index_of(order)
    path = scratch_path(spark, "tokens")
    tokenstore.write_tokens(none, path, BYTE)
    assert tokenstore.token_index(spark, path).count() == 0


def test_a_wide_vocabulary_and_a_wrong_dictionary(spark):
    ids = np.array([1, 70_000, 0], "<u4").tobytes()
    content = tokenstore._segment(0, 0, 4, b"", [(5, ids)]) + b"\n"
    [(head, index, frames)] = list(tokenstore.segments(content))
    assert tokenstore.document(head, index, frames, 0, b"") == ids
    with pytest.raises(ValueError, match="dictionary"):
        tokenstore.document(head, index, frames, 0, b"other")


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("seed", range(40))
def test_best_end_is_the_least_distance(seed):
    rng = random.Random(seed)
    pattern = "".join(rng.choices("abc", k=rng.randint(1, 12)))
    text = "".join(rng.choices("abc", k=rng.randrange(25)))
    ends = [(min(_distance(pattern, text[s:e]) for s in range(e + 1)), e) for e in range(1, len(text) + 1)]
    for most in range(len(pattern) + 1):
        good = [x for x in ends if x[0] <= most]
        assert decontaminate.best_end(pattern, text, most) == (min(good, key=lambda x: (x[0], x[1])) if good else None)


def _edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        k = rng.randrange(len(text))
        rng.choice([lambda: text.pop(k), lambda: text.insert(k, "q"), lambda: text.__setitem__(k, "q")])()
    return "".join(text)


def test_leaks_against_brute_force(spark, none):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "in"]
    items = [(k, " ".join(rng.choices(words, k=12))) for k in range(8)]
    items += [(8, "short"), (9, None), (10, ""), (11, items[0][1]), (None, "a text of an item without a key"),
              (12, "Two  words")]
    docs, planted = [], set()
    for k in range(120):
        body = " ".join(rng.choices(words, k=20))
        if k % 2:
            item = rng.randrange(8)
            most = decontaminate.budget(len(items[item][1]), decontaminate.ERROR_RATE)
            body += ".\n" + _edited(rng, items[item][1], rng.randint(0, most + 3)).upper() + "\t. end"
        docs.append((k, body))
    for doc, body in docs:
        text = decontaminate.normalized(body)
        for item, raw in items:
            if item is not None and raw and len(raw) >= decontaminate.SHORTEST_ITEM:
                row = [0] * (len(text) + 1)  # least distance of the item to a substring that ends here
                for i, x in enumerate(raw, 1):
                    last, row = row, [i]
                    for j, y in enumerate(text, 1):
                        row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
                if min(row) <= decontaminate.budget(len(raw), decontaminate.ERROR_RATE):
                    planted.add((doc, item, min(row)))
    docs += [(203, "has two words, no two wordsmiths and not intwo words; Two\nWORDS"), (204, "now a Text of an item without a kay here")]
    docs += [(200, None), (201, ""), (None, items[2][1]), (202, items[3][1] + " " + items[3][1])]
    frame = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, distance int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.leaks(frame, bench).collect()
    best = {}
    for r in rows:
        if r.doc_id is not None and r.doc_id < 200:
            best[r.doc_id, r.item_id] = min(r.distance, best.get((r.doc_id, r.item_id), 99))
    assert {(d, i, n) for (d, i), n in best.items()} == planted and len(planted) > 30
    texts = dict(docs)
    for r in rows:
        part = decontaminate.normalized(texts[r.doc_id][r.start_char : r.end_char])
        item = next(t for k, t in items if k == r.item_id)
        assert _distance(part, decontaminate.normalized(item)) == r.distance
    assert sorted((r.item_id, r.start_char, r.end_char) for r in rows if r.doc_id == 203) == [(12, 4, 13), (12, 54, 63)]
    assert [(r.item_id, r.distance) for r in rows if r.doc_id == 204] == [(None, 1)]
    assert sum(r.doc_id is None for r in rows) == 1 and sum(r.doc_id == 202 for r in rows) == 2
    kept = decontaminate.without_leaks(frame, bench)
    bad = {d for d, _, _ in planted} | {None, 202, 203, 204}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _ in docs if d not in bad)
    assert kept.columns == frame.columns
    empty = bench.where("false")
    assert decontaminate.leaks(frame, empty).count() == 0 and decontaminate.without_leaks(frame, empty).count() == len(docs)
    assert decontaminate.leaks(none, bench).count() == 0


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    items = [(k, f"benchmark passage number {k} with {k * 7} words in it") for k in range(20)]
    docs = [(k, f"before benchmark passage number {k} with {k * 7} words in it behind") for k in range(20)]
    frame, bench = (spark.createDataFrame(x, f"{k} long, text string") for x, k in ((docs, "doc_id"), (items, "item_id")))
    whole = sorted(map(tuple, decontaminate.leaks(frame, bench, 0.0).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 150)
    assert sorted(map(tuple, decontaminate.leaks(frame, bench, 0.0).collect())) == whole
    assert [r[:2] for r in whole] == [(k, k) for k in range(20)]
    assert decontaminate.without_leaks(frame, bench, 0.0).count() == 0


def test_licenses_planted_and_edited(spark, odd, none):
    rng = random.Random(3)
    filler = ["lorem", "ipsum", "dolor", "sit", "amet", "the", "of", "under"]
    names, docs = [n for n, _ in licenses.TEMPLATES], []
    assert len(set(names)) == len(names)
    for k, (_, text) in enumerate(licenses.TEMPLATES):
        body = " ".join(rng.choices(filler, k=200))
        edited = " ".join("foo" if n % 10 == 9 else w for n, w in enumerate(text.split()))
        docs += [(k, f"{body}\n{text}\n{body}"), (100 + k, f"{body}\n{edited}\n{body}")]
    mit = dict(licenses.TEMPLATES)["mit statement"]
    docs += [(200, " ".join(filler * 50)), (201, "\u0130 " + mit + " x " + mit.upper()), (202, "Released with the MIT License."),
             (203, f"{mit} " * 3000)]
    rows = licenses.license_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = defaultdict(list)
    for r in rows:
        found[r.doc_id].append(r)
    for k, (name, text) in enumerate(licenses.TEMPLATES):
        (whole,) = found[k]
        assert whole.template == name and whole.coverage == 1.0 and whole.matched_words == whole.template_words
        assert text.startswith(dict(docs)[k][whole.start_char : whole.end_char])
        (near,) = found[100 + k]
        assert near.template.split("-")[0].split()[0] == name.split("-")[0].split()[0] and 0.6 <= near.coverage <= 1
    assert not found[200] and [r.template for r in found[202]] == ["mit statement"] and len(found[203]) == 3000
    twice = [dict(docs)[201][r.start_char : r.end_char] for r in found[201]]
    assert sorted(twice) == ["RELEASED UNDER THE MIT LICENSE", "Released under the MIT License"]
    assert licenses.license_spans(odd).count() == 0 and licenses.license_spans(none).count() == 0


def test_alignment_against_whole_table():
    rng = random.Random(2)
    for _ in range(60):
        template = np.array(rng.choices(range(6), k=rng.randint(3, 12)), "<u8")
        words = np.array(rng.choices(range(6), k=rng.randint(3, 12)), "<u8")
        best, above = 0, [0] * (len(words) + 1)
        for x in template:
            row = [0]
            for j, y in enumerate(words, 1):
                row.append(max(0, above[j - 1] + (2 if x == y else -1), above[j] - 1, row[-1] - 1))
            above = row
            best = max(best, *row)
        matched, first, last = licenses.align(template, words, -12, 12, 0, len(words))
        assert matched <= min(len(template), len(words)) and (matched > 0) == (best > 0) and 2 * matched >= best
        assert first < 0 or first <= last


PAGE = "<html><head><title>t</title><style>p{{}}</style><script>var a='<p>x</p>'</script></head><body>{}</body></html>"


def test_main_text_by_markup():
    page = PAGE.format(
        "<nav><ul><li>Menu</li></ul></nav><div class='box ad'>Buy</div><header>Top</header><form>Name <input> <p>Send</p></form>"
        "<article class=post><h1>Title &amp; more</h1><p>One <b>bo</b>ld\n\n word<br>next<p>a &lt; b<aside>see also</aside>"
        "<p>1 < 2 &copy;<!-- gone --><section id='comments'><p>nice!</section><p>last</article><footer>&am")
    kept = " ".join(t for v, t in maintext.blocks(page) if v == maintext.KEEP)
    assert kept == "Title & more One bold word next a < b 1 < 2 \u00a9 last"
    assert all(v != maintext.OPEN for v, _ in maintext.blocks(page))
    assert maintext.blocks("") == [] and maintext.blocks("<p") == [] and maintext.blocks("a") == [(maintext.OPEN, "a")]


def test_main_text_by_repeated_runs(spark):
    notice = "we keep your data for ever and share it with all of our friends"
    rows = []
    for k in range(40):
        unique = " ".join(f"w{k}x{n}" for n in range(30))
        rows.append((k, f"http://Site{k % 2}.org/{k}", PAGE.format(f"<div>{notice}</div><div>{unique} tail</div>")))
    rows += [(100, "http://alone.org/1", PAGE.format(f"<p>{notice}</p>")), (101, None, None), (102, "no url", ""),
             (103, "http://site0.org/copy", PAGE.format(f"<article>{notice}</article>")),
             (104, "http://twin.org/", PAGE.format("<p>one two three four five six seven eight nine</p>")),
             (104, "http://twin.org/", PAGE.format("<p>one two three four five six seven eight nine</p>"))]
    frame = spark.createDataFrame([(*r, 3, "x") for r in rows], "page_id long, url string, html string, page int, places string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in maintext.main_text(frame).collect())
    want = []
    for k in range(40):
        want.append((k, " ".join(f"w{k}x{n}" for n in range(30)) + " tail"))
    want += [(100, notice), (101, ""), (102, ""), (103, notice)] + [(104, "one two three four five six seven eight nine")] * 2
    assert got == sorted((k, t, len(t)) for k, t in want)
    assert maintext.main_text(frame.where("false")).count() == 0


def test_parts_of_names_and_open_quotes():
    inside = "<article><p>text</p><div class='{}'>more</div></article>"
    for name in ("post-comments", "comments_area", "adSlot", "cookie-bar", "nav-links", "sidebar-right", "x Ad"):
        assert maintext.blocks(inside.format(name)) == [(maintext.KEEP, "text"), (maintext.DROP, "more")], name
    for name in ("has-sidebar", "main-content", "download", "heading", "navy", "with-ads", "relatedness"):
        assert maintext.blocks(inside.format(name)) == [(maintext.KEEP, "text"), (maintext.KEEP, "more")], name
    page = "<article><a title='a > b' href=\"x>y\">one</a> <![CDATA[ gone > ]]><?php x?>two <p title=don't>three</article>"
    assert " ".join(t for _, t in maintext.blocks(page)) == "one two three"
    assert maintext.blocks("<article>a <b title=\"open>bold</b> c") == [(maintext.KEEP, "a bold c")]
    for part in ("<a ", "<a x=\"", "<a x='>", "<![CDATA[", "<![CDATA[>", "<a =\">\" ", "<!--", "<", "</b>", "<div></x>", "<title>"):
        began = time.perf_counter()
        maintext.blocks(part * (1_000_000 // len(part)))
        assert time.perf_counter() - began < 10, part


def test_copies_and_stock_phrases_stay(spark):
    line = " ".join(f"w{k}" for k in range(maintext.RUN - 1))
    rows = [(1, f"<p>first {line} apple</p>"), (2, f"<p>second {line} pear</p>"), (3, "<p>a page of its own</p><p>Menu</p>"),
            (4, "<p>a page of its own</p><p>Menu</p>"), (5, "<p>Menu</p><article>kept</article>")]
    rows += [(6, f"<p>third {line} last apple</p>"), (7, f"<p>fourth {line} last pear</p>")]
    frame = spark.createDataFrame([(k, "http://h.org/", t) for k, t in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in maintext.main_text(frame).collect()}
    assert got == {1: f"first {line} apple", 2: f"second {line} pear", 3: "a page of its own", 4: "a page of its own",
                   5: "kept", 6: "third apple", 7: "fourth pear"}


def test_repeated_runs_against_brute_force(spark):
    rng = random.Random(9)
    shared = [f"s{k}" for k in range(60)]
    pages = []
    for k in range(30):
        words = []
        for _ in range(6):
            words += [f"u{k}_{rng.randrange(10**6)}" for _ in range(rng.randint(1, 5))]
            at = rng.randrange(50)
            words += shared[at : at + rng.randint(1, 40)]
        pages.append((k, "http://h.org/", " ".join(words)))
    grams = defaultdict(set)
    for k, _, text in pages:
        words = text.split()
        for n in range(len(words) - maintext.RUN + 1):
            grams[tuple(words[n : n + maintext.RUN])].add(k)
    want = {}
    for k, _, text in pages:
        words, covered = text.split(), set()
        for n in range(len(words) - maintext.RUN + 1):
            if len(grams[tuple(words[n : n + maintext.RUN])]) > 1:
                covered |= set(range(n, n + maintext.RUN))
        want[k] = " ".join(w for n, w in enumerate(words) if n not in covered)
    frame = spark.createDataFrame([(k, u, f"<body>{t}</body>") for k, u, t in pages], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in maintext.main_text(frame).collect()} == want
    assert any(w != t for (_, _, t), w in zip(pages, want.values(), strict=True))


def test_repeats_are_neighbours_of_sorted_suffixes():
    """Any cut of the sorted array gives the repeats of the whole: runs on all pages, runs twice on one page, whole blocks."""
    rng = random.Random(5)
    shared = [f"s{k}" for k in range(30)]
    pages = {p: " ".join([f"u{p}"] + shared[: 20 + p % 9] + ["x"] * (24 if p == 2 else 1)) for p in range(12)}
    pages[12] = "x " * 30
    array = sorted((1, s, p, place, n, p != 3) for p, t in pages.items() for s, place, n in maintext._suffixes([(maintext.OPEN, t)]))
    runs = defaultdict(list)
    for _, suffix, page, place, length, opens in array:
        runs[suffix].append((page, place, length, opens))
    want = {row[:3] for rows in runs.values() if len({r[0] for r in rows}) > 1 for row in rows if row[3]}
    assert want and {p for p, _, _ in want} == set(pages) - {3}
    for parts in (1, 2, 5, 40, len(array)):
        cuts = [0, *sorted(rng.sample(range(1, len(array)), parts - 1)), len(array)]
        found = [r for a, b in zip(cuts, cuts[1:], strict=False) for r in maintext._repeats(array[a:b])]
        seen = defaultdict(set)
        for edge, page, place, _ in found:
            if place < 0:
                seen[edge].add(page)
        assert {r[1:] for r in found if r[2] >= 0 and (r[0] is None or len(seen[r[0]]) > 1)} == want, parts


def test_one_run_on_every_page_spreads_over_tasks(spark):
    notice = " ".join(f"n{k}" for k in range(25))
    pages = [(k, "http://h.org/", f"<p>{notice} own{k}</p>") for k in range(60)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = {r.page_id: r.text for r in maintext.main_text(frame).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {k: f"own{k}" for k in range(60)}


def test_kept_words_change_speed_only(monkeypatch):
    """Common words stay when the store is full, later ones come and go; ids are those of a full store."""
    monkeypatch.setattr(encoder, "KEEP_WORDS", 3)
    monkeypatch.setattr(encoder, "LATE_WORDS", 2)
    text = "one two three four five six. one two three four five six, seven one two\nthree four"
    small, plain = TextEncoder(BYTE), Tokenizer.from_file(BYTE)
    for _ in range(2):
        assert np.frombuffer(small.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert len(small.spaced) == 3 and 0 < len(small.spaced.late) <= 2 and "two" in small.spaced


def test_encoders_go_with_their_task(spark):
    """Python workers outlive their tasks; what they keep for the ids of texts must not stay beside the next stage."""

    def held(batches):
        from offerforge.llm import encoder

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([encoder.encoder.cache_info().currsize] * batch.num_rows, pa.int64())})

    kept = encoder.encoder(BYTE)
    kept.ids("two\nlines")
    gone = weakref.ref(kept)
    del kept
    encoder.release()
    assert gone() is None

    docs = spark.createDataFrame([(k, f"text {k}\nof two lines") for k in range(40)], "doc_id long, text string").repartition(8)
    probe = spark.range(0, 64, 1, 16).mapInArrow(held, "n long")
    assert packing.pieces(docs, WORD).count() == 40
    assert {r.n for r in probe.collect()} == {0}


def test_the_packing_plan_starts_no_python_workers(spark):
    cut = spark.createDataFrame([(k, 0, 0, k % 7 + 1, k) for k in range(30)],
                                "doc_id long, piece int, start long, length long, ids_crc32 long").coalesce(1)
    packed = packing.pack(written(cut), 16)
    plan = packed._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan and "Python" not in plan
    assert packed.where("offset + length > 16").count() == 0 and packed.count() == 30
    assert packing.pack(written(cut.limit(0)), 16).count() == 0


def test_texts_go_to_python_in_small_batches(spark):
    """Rows in a batch follow the length of the texts, not only Spark's number of rows; the session's bound comes back."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    before = spark.conf.get(BATCH_SETTING)
    rows = spark.range(0, 2000, 1, 1).selectExpr("id", "repeat('text ', 2000) AS text").mapInArrow(sizes, "n long")
    with text_batches(spark):
        got = [r.n for r in written(rows).collect()]
    assert sum(got) == 2000 and max(got) < 1000
    assert spark.conf.get(BATCH_SETTING) == before
