"""Licence scan by patience alignment of texts with licence templates.

Words that occur once in a stretch of text and once in the template are anchors; the longest increasing subsequence of
their places is kept, and the gaps between anchors are aligned in the same way, down to gaps without anchors, where the longest
common subsequence is taken. Coverage is the share of a template's words that are aligned within a short span.

Stretches are found without loss: a span that covers enough of a template holds at least as many of its words.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spherecube.llm import texts as tx
from spherecube.llm.common import id_and_text
from spherecube.llm.license_texts import TEMPLATES

COVERAGE = 0.8
#: words a covering span may have for each word of the template, and a few more
STRETCH, SLACK = 1.25, 3


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []
    holders: list[int] = []
    behind = [-1] * len(values)
    for k, v in enumerate(values):
        pile = bisect_left(tops, v)
        behind[k] = holders[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(v)
            holders.append(k)
        else:
            tops[pile], holders[pile] = v, k
    out = []
    k = holders[-1] if holders else -1
    while k >= 0:
        out.append(k)
        k = behind[k]
    return out[::-1]


def align(template: list[int], text: list[int]) -> list[tuple[int, int]]:
    """Aligned places (in the template, in the text), increasing in both."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(template), 0, len(text))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and template[a] == text[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a >= b or c >= d:
            continue
        ours, theirs = Counter(template[a:b]), Counter(text[c:d])
        place = {w: k for k, w in enumerate(text[c:d], c) if theirs[w] == 1}
        anchors = [(k, place[w]) for k, w in enumerate(template[a:b], a) if ours[w] == 1 and w in place]
        if anchors:
            chain = [anchors[k] for k in increasing([y for _, y in anchors])]
            found += chain
            before = (a - 1, c - 1)
            for x, y in [*chain, (b, d)]:
                todo.append((before[0] + 1, x, before[1] + 1, y))
                before = (x, y)
        else:
            # all places of each word, later ones first: no two of one word get into an increasing sequence
            spots: dict[int, list[int]] = {}
            for k in range(d - 1, c - 1, -1):
                spots.setdefault(text[k], []).append(k)
            pairs = [(k, y) for k in range(a, b) for y in spots.get(template[k], ())]
            found += [pairs[k] for k in increasing([y for _, y in pairs])]
    return sorted(found)


class Scanner:
    """Templates as numbers of a common vocabulary of word hashes."""

    def __init__(self, templates: Mapping[str, str], coverage: float):
        self.names = list(templates)
        words = tx.Texts(pa.array(list(templates.values()), pa.string())).words(tx.ALNUM, lower=True)
        self.vocabulary, number = np.unique(words.hashes, return_inverse=True)
        self.templates = [number[words.bounds[k] : words.bounds[k + 1]] for k in range(len(self.names))]
        self.coverage = coverage

    def scan(self, texts: tx.Texts) -> list[tuple[int, int, int, int, int]]:
        """(row, template, first word, end word, aligned words) of every covering span, spans of a template apart."""
        words = texts.words(tx.ALNUM, lower=True)
        if not len(words.hashes) or not len(self.vocabulary):
            return []
        slot = np.minimum(np.searchsorted(self.vocabulary, words.hashes), len(self.vocabulary) - 1)
        number = np.where(self.vocabulary[slot] == words.hashes, slot, -1)
        out = []
        for t, template in enumerate(self.templates):
            if not len(template):
                continue
            need = int(np.ceil(self.coverage * len(template) - 1e-9))
            span = int(STRETCH * len(template)) + SLACK
            own = np.zeros(len(self.vocabulary) + 1, dtype=bool)
            own[template] = True
            total = np.concatenate([[0], np.cumsum(own[number])])
            at = np.flatnonzero(own[number])  # a span starts at a word of the template
            enough = at[total[np.minimum(at + span, len(number))] - total[at] >= need]
            if not len(enough):
                continue
            # starts whose spans overlap are one region, within their row
            ends = np.minimum(enough + span, words.bounds[words.row[enough] + 1])
            opens = np.concatenate([[True], (enough[1:] > ends[:-1]) | (words.row[enough[1:]] != words.row[enough[:-1]])])
            starts, stops = enough[opens], ends[np.append(np.flatnonzero(opens)[1:] - 1, len(ends) - 1)]
            for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                row = int(words.row[a])
                base = int(words.bounds[row])
                out += [(row, t, x - base, y - base, n) for x, y, n in self._spans(template.tolist(), number, a, b, span, need)]
        return out

    def _spans(self, template: list[int], number: np.ndarray, start: int, stop: int, span: int, need: int) -> list[tuple[int, int, int]]:
        found: list[tuple[int, int, int]] = []
        todo = [(start, stop)]
        # pieces that overlap by a span hold every covering span whole
        if stop - start > 2 * span:
            todo = [(k, min(k + 2 * span, stop)) for k in range(start, stop, span)]
        while todo:
            a, b = todo.pop()
            if b - a < need:
                continue
            places = [a + y for _, y in align(template, number[a:b].tolist())]
            # the part of the chain within one span that holds most words
            best, low = (0, 0, 0), 0
            for high, place in enumerate(places):
                while place - places[low] >= span:
                    low += 1
                best = max(best, (high - low + 1, -low, high))
            if best[0] < need:
                if b - a > span + need:
                    # copies side by side hide one another's unique words: look at both halves
                    middle = (a + b) // 2
                    todo += [(a, min(middle + span // 2, b - 1)), (max(middle - span // 2, a + 1), b)]
                continue
            x, y = places[-best[1]], places[best[2]] + 1
            found.append((x, y, best[0]))
            todo += [(a, x), (y, b)]
        # of overlapping finds the fuller stays
        kept: list[tuple[int, int, int]] = []
        for f in sorted(found, key=lambda f: (-f[2], f[0], f[1])):
            if all(f[1] <= k[0] or f[0] >= k[1] for k in kept):
                kept.append(f)
        return sorted(kept)


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license, start, end (words, end excluded), n_aligned, coverage of every covering span in the whole texts.

    Words are runs of digits, lower-cased A-Z and characters beyond ASCII. A text may hold several licences, and one of
    them several times; where a notice is part of a longer template both are reported. Null and empty texts and empty
    templates give no rows; repeated rows are reported each.
    """
    scanner = Scanner(templates, coverage)
    docs = id_and_text(docs, id_col, text_col)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in tx.chunks(batches, "text"):
            found = np.array(scanner.scan(texts), dtype=np.int64).reshape(-1, 5)
            sizes = np.array([len(t) for t in scanner.templates], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(found[:, 0])), pa.array([scanner.names[t] for t in found[:, 1]], pa.string()), pa.array(found[:, 2]), pa.array(found[:, 3]), pa.array(found[:, 4]),
                 pa.array(found[:, 4] / np.maximum(sizes[found[:, 1]], 1))],
                names=["doc_id", "license", "start", "end", "n_aligned", "coverage"],
            )

    return docs.mapInArrow(compute, f"doc_id {dict(docs.dtypes)['doc_id']}, license string, start bigint, end bigint, n_aligned bigint, coverage double")
