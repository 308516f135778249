"""Licence texts in documents: winnowed fingerprints of templates find candidates, a banded alignment measures them."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from offerforge.llm.frames import map_rows, texts
from offerforge.llm.license_texts import TEMPLATES

GRAM = 3
WINDOW = 3
BAND = 6
LEAST_COVERAGE = 0.6
KEEP_WORDS = 500_000
WORD = re.compile(r"\w+")


class _Hashes(dict):
    """64-bit hashes of lower-cased words; forgets all of them when it has ``KEEP_WORDS``."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= KEEP_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.lower())
        return value


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...]):
        self.hashes = _Hashes()
        self.names = [n for n, _ in templates]
        self.words = [self._words(t) for _, t in templates]
        self.index: dict[int, list[tuple[int, int]]] = {}
        for n, words in enumerate(self.words):
            grams = self.grams(words)
            short = len(words) < GRAM + 2 * WINDOW  # so short that one changed word could hit all picked ones
            for at in range(len(grams)) if short else winnow(grams):
                self.index.setdefault(int(grams[at]), []).append((n, at))
        self.keys = np.array(sorted(self.index), dtype="<u8")
        self.coarse = np.zeros(1 << 16, dtype=bool)
        self.coarse[self.keys >> np.uint64(48)] = True

    def _words(self, text: str) -> np.ndarray:
        found = WORD.findall(text)
        return np.fromiter(map(self.hashes.__getitem__, found), "<u8", len(found))

    @staticmethod
    def grams(words: np.ndarray) -> np.ndarray:
        """One number for every ``GRAM`` words in a row."""
        n = len(words) - GRAM + 1
        out = np.zeros(max(n, 0), dtype="<u8")
        for k in range(GRAM if n > 0 else 0):
            out = out * np.uint64(0x9E3779B97F4A7C15) + (words[k : k + n] ^ (words[k : k + n] >> np.uint64(29)))
        return out

    def scan(self, text: str) -> list[dict]:
        words = self._words(text)
        grams = self.grams(words)
        at = np.nonzero(self.coarse[grams >> np.uint64(48)])[0]
        at = at[np.isin(grams[at], self.keys)]
        if not len(at):
            return []
        hits: dict[int, list[tuple[int, int]]] = {}
        for p in at.tolist():
            for n, spot in self.index[int(grams[p])]:
                hits.setdefault(n, []).append((p - spot, p))
        found = [(n, *place) for n, spots in hits.items() for place in self._places(n, words, sorted(spots))]
        found.sort(key=lambda x: (-x[1], -x[1] / len(self.words[x[0]]), x[0], x[2]))
        taken, out, spans = bytearray(len(words)), [], [m.span() for m in WORD.finditer(text)] if found else []
        for n, matched, first, last in found:
            if 2 * sum(taken[first : last + 1]) <= last + 1 - first:
                taken[first : last + 1] = b"\1" * (last + 1 - first)
                out.append({"template": self.names[n], "matched_words": matched, "template_words": len(self.words[n]),
                            "coverage": matched / len(self.words[n]), "start_char": spans[first][0],
                            "end_char": spans[last][1]})
        return out

    def _places(self, n: int, words: np.ndarray, hits: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """Alignments around hits (begin of the template, place of the hit): of hits whose begins lie close together the
        best one, then those of the hits before and behind it. A chain of begins ends when it is as long as the template, and
        what it has found is not looked at again, so the work grows with the hits."""
        template, out, free, at = self.words[n], [], 0, 0
        while at < len(hits):
            stop = at + 1
            while stop < len(hits) and hits[stop][0] - hits[stop - 1][0] <= BAND and hits[stop][0] - hits[at][0] <= len(template):
                stop += 1
            work = [([h for h in hits[at:stop] if h[1] >= free], free, len(words))]
            at = stop
            while work:
                group, begin, end = work.pop()
                if not group:
                    continue
                low, high = group[0][0], group[-1][0]
                around = words[max(begin, low - BAND) : max(0, min(end, high + BAND + len(template)))]
                if np.isin(template, around).sum() < LEAST_COVERAGE * len(template):
                    continue
                matched, first, last = align(template, words, low, high, begin, end)
                if matched < LEAST_COVERAGE * len(template):
                    continue
                out.append((matched, first, last))
                free = max(free, last + 1)
                work += [([h for h in group if h[1] < first], begin, first), ([h for h in group if h[1] > last], last + 1, end)]
        return sorted(out, key=lambda x: x[1])


def winnow(grams: np.ndarray) -> list[int]:
    """Places of the least number in every ``WINDOW`` in a row, the last one of equals; all of a shorter text's least."""
    picked = set()
    for at in range(max(1, len(grams) - WINDOW + 1)):
        part = grams[at : at + WINDOW]
        if len(part):
            picked.add(at + len(part) - 1 - int(np.argmin(part[::-1])))
    return sorted(picked)


def align(template: np.ndarray, words: np.ndarray, low: int, high: int, begin: int, end: int) -> tuple[int, int, int]:
    """Matched words, first and last matched word of the best alignment with the words from ``begin`` to before ``end``
    that starts between ``low`` and ``high``, within ``BAND`` words. A match counts 2, a word left out or exchanged costs 1; among equals the one ending first."""
    offset, width = low - BAND, high - low + 2 * BAND + 1
    empty = (0, 0, -1, -1)  # score, matched, first, last
    above, best = [empty] * (width + 1), empty
    for i in range(len(template)):
        row, left = [], empty
        for d in range(width):
            j = offset + i + d
            if not begin <= j < end:
                cell = empty
            else:
                score, matched, first, last = above[d]
                if template[i] == words[j]:
                    cell = (score + 2, matched + 1, j if first < 0 else first, j)
                else:
                    cell = (score - 1, matched, first, last)
                for other in (above[d + 1], left):
                    if other[0] - 1 > cell[0]:
                        cell = (other[0] - 1, *other[1:])
                if cell[0] <= 0:
                    cell = empty
                if cell[0] > best[0]:
                    best = cell
            row.append(cell)
            left = cell
        above = [*row, empty]
    return best[1], best[2], best[3]


@lru_cache(maxsize=2)
def scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(templates)


def license_spans(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """One row for each place where a template covers ``LEAST_COVERAGE`` of its words: doc_id, template, matched_words,
    template_words, coverage, start_char, end_char (code points of the text).

    Words are runs of letters, digits and underscores in any case. A run of ``GRAM + WINDOW - 1`` words shared with a
    template is always found, of a short template any ``GRAM`` words. Where templates are found in the same words the one with
    most matched words is reported, of equals the one covered best: so versions and relatives, which share most of their words,
    are told apart, and a notice comes without the statement it begins with.
    Null and empty texts and texts of fewer than ``GRAM`` words have no row; repeated rows each have theirs. Templates are
    a parameter of a few kilobytes; documents are neither shuffled nor collected.
    """
    kinds = ("doc_id long, template string, matched_words long, template_words long, coverage double, "
             "start_char long, end_char long")

    def make(batch):
        find, rows = scanner(templates).scan, []
        for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows += [{"doc_id": doc} | hit for hit in find(body)]
        return rows

    return map_rows(texts(docs, key, text, "doc_id"), make, kinds)
