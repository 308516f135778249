"""Benchmark passages in documents, with a few edits allowed: pigeonhole pieces, then bit-parallel edit distance.

An item with an error budget of k edits is cut into k + 1 pieces. Whatever k edits do, one piece stays whole, so every
occurrence holds an exact piece. The pieces of all items are found in one pass over a text; around each hit the distance
is computed with one machine word for each column of the comparison (Myers), in Python's long integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerforge.llm.frames import map_rows, texts

ERROR_RATE = 0.08
#: Items of fewer characters are matched without edits and at the borders of words only.
SHORTEST_ITEM = 24
BLOCK_CHARS = 4_000_000


def normalized(text: str) -> str:
    """Lower case, white space as single blanks."""
    return " ".join(text.lower().split())


def budget(length: int, error_rate: float) -> int:
    return int(length * error_rate)


def cut(item: str, parts: int) -> list[tuple[int, str]]:
    """``parts`` consecutive pieces, their lengths at most one apart, with their places."""
    ends = [len(item) * k // parts for k in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:], strict=False) if b > a]


def best_end(pattern: str, text: str, most: int, anchored: bool = False) -> tuple[int, int] | None:
    """Least distance of ``pattern`` to a substring of ``text`` and the first end that has it; None beyond ``most``.

    ``anchored``: the substring begins where ``text`` does.
    """
    m = len(pattern)
    full, last = (1 << m) - 1, 1 << (m - 1)
    places: dict[str, int] = {}
    for k, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << k
    plus, minus, score, best, carry = full, 0, m, None, int(anchored)
    for end, c in enumerate(text, 1):
        equal = places.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (~(horizontal | plus) & full)
        down = plus & horizontal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up = (up << 1 | carry) & full
        down = (down << 1) & full
        plus = down | (~(vertical | up) & full)
        minus = up & vertical
        if score <= most and (best is None or score < best[0]):
            best = score, end
    return best


class Matcher:
    """All occurrences of a block of items in a text."""

    def __init__(self, items: tuple[tuple[int | None, str], ...], error_rate: float):
        import ahocorasick

        self.items: dict[str, list[int]] = {}
        for item, text in items:
            self.items.setdefault(normalized(text), []).append(item)
        self.known = list(self.items)
        self.most = [budget(len(t), error_rate) if len(t) >= SHORTEST_ITEM else 0 for t in self.known]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, item in enumerate(self.known):
            for at, piece in cut(item, self.most[n] + 1):
                pieces.setdefault(piece, []).append((n, at))
        self.pieces = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.pieces.add_word(piece, (len(piece), places))
        self.pieces.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) in code points of the normalised text."""
        begins: dict[int, list[int]] = {}
        for last, (length, places) in self.pieces.iter(text):
            for n, at in places:
                begins.setdefault(n, []).append(last + 1 - length - at)
        found = []
        for n, at in begins.items():
            item, most = self.known[n], self.most[n]
            at.sort()
            if len(item) < SHORTEST_ITEM:
                found += self._words(text, n, at)
                continue
            low = high = at[0]
            for begin in [*at[1:], None]:
                if begin is not None and begin - high <= 2 * most + 1:
                    high = begin
                    continue
                found += self._near(text, n, max(0, low - most), high + len(item) + most)
                low = high = begin
        return found

    def _words(self, text: str, n: int, begins: list[int]) -> list[tuple[int, int, int, int]]:
        """The occurrences of a short item that neither begin nor end inside a word."""
        item, out, free = self.known[n], [], 0
        for at in begins:
            end = at + len(item)
            inside = (at > 0 and text[at - 1].isalnum() and item[0].isalnum()
                      or end < len(text) and text[end].isalnum() and item[-1].isalnum())
            if at >= free and not inside:
                out += [(i, 0, at, end) for i in self.items[item]]
                free = end
        return out

    def _near(self, text: str, n: int, low: int, high: int) -> list[tuple[int, int, int, int]]:
        """The occurrences within a window: the best one, then those of the parts before and behind it."""
        item, most, out, work = self.known[n], self.most[n], [], [(low, min(high, len(text)))]
        while work:
            low, high = work.pop()
            if high - low < len(item) - most:
                continue
            at = text.find(item, low, high)
            if at >= 0:
                distance, start, end = 0, at, at + len(item)
            elif most and (hit := best_end(item, text[low:high], most)):
                distance, end = hit[0], low + hit[1]
                start = end - best_end(item[::-1], text[low:end][::-1], most, anchored=True)[1]
            else:
                continue
            out += [(i, distance, start, end) for i in self.items[item]]
            work += [(low, start), (end, high)]
        return out


@lru_cache(maxsize=2)
def matcher(items: tuple[tuple[int | None, str], ...], error_rate: float) -> Matcher:
    return Matcher(items, error_rate)


def places(text: str, spots: list[int]) -> dict[int, int]:
    """For ascending code points of the normalised text, the code points of ``text`` they come from."""
    out, at, wanted, gap = {}, 0, iter(sorted(set(spots))), False
    want = next(wanted, None)
    for k, c in enumerate(text):
        size = 0
        for x in c.lower():
            if x.isspace():
                gap = at > 0
            else:
                size += 1 + gap
                gap = False
        while want is not None and size and at <= want < at + size:
            out[want] = k
            want = next(wanted, None)
        at += size
    return out


def item_blocks(benchmark: DataFrame, item_key: str, item_text: str) -> Iterator[tuple[tuple[int | None, str], ...]]:
    """The items that can be matched, in blocks of about ``BLOCK_CHARS``; at least one block, perhaps empty."""
    items = benchmark.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("item"))
    items = items.where("length(trim(item)) > 0")
    blocks = (items.agg(F.sum(F.length("item"))).first()[0] or 0) // BLOCK_CHARS + 1
    for block in range(blocks):
        held = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        found = [(r[0], r[1]) for r in held if len(words := r[1].split()) > 1 or words and len(words[0]) >= SHORTEST_ITEM]
        yield tuple(sorted(found, key=lambda x: (x[0] is None, x[0] or 0, x[1])))


def leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, key: str = "doc_id", text: str = "text",
          item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each occurrence: doc_id, item_id, distance, start_char, end_char (code points of the given text).

    Texts are compared in lower case with white space as single blanks; up to ``error_rate`` of the item's length in
    edits is allowed. Occurrences of an item in a text do not overlap. Items shorter than ``SHORTEST_ITEM`` after
    normalising match exactly and between words; a single short word is no passage and matches nothing, like null and empty
    items. Items with a null id are reported under it. Null texts match nothing; repeated rows and items each give their rows. The items are asked against all documents in blocks of bounded size, so a larger
    benchmark takes more passes and no more memory; the documents are not shuffled.
    """
    rows = texts(docs, key, text, "doc_id")
    kinds = "doc_id long, item_id long, distance int, start_char long, end_char long"
    out = None
    for held in item_blocks(benchmark, item_key, item_text):
        part = map_rows(rows, _finder(held, error_rate), kinds)
        out = part if out is None else out.unionByName(part)
    return out


def _finder(held: tuple[tuple[int | None, str], ...], error_rate: float):
    def make(batch):
        if not held:
            return []
        find, rows = matcher(held, error_rate).matches, []
        for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            hits = find(normalized(body))
            if hits:
                at = places(body, [p for h in hits for p in (h[2], h[3] - 1)])
                rows += [{"doc_id": doc, "item_id": i, "distance": d, "start_char": at[a], "end_char": at[b - 1] + 1}
                         for i, d, a, b in hits]
        return rows

    return make


def without_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, key: str = "doc_id",
                  text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; only texts go to Python, nothing is shuffled.

    Rows with a null key are judged by their text like any other; null texts stay.
    """
    for held in item_blocks(benchmark, item_key, item_text):
        if held:
            docs = docs.where(~_leaky(held, error_rate)(F.coalesce(F.col(text), F.lit(""))))
    return docs


def _leaky(held: tuple[tuple[int | None, str], ...], error_rate: float):
    @F.pandas_udf("boolean")
    def leaky(bodies: pd.Series) -> pd.Series:
        find = matcher(held, error_rate).matches
        return bodies.map(lambda body: bool(find(normalized(body))))

    return leaky
