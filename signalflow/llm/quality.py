"""Quality rules: counts over words and lines, and repetition by a suffix array of each text's words.

The suffix array sorts all word positions of a text by what follows them. Neighbours in that order
share the longest prefixes, so the intervals of equal prefixes are the text's repeated substrings and
the longest prefix a position shares with a neighbour is its longest repeat. A text is turned down
when such repeats cover too much of it, or when one of them is too long a part of it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField

from signalflow.llm.common import WORD, map_batches, slices

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
WINDOW = 3
# Of the method: repeats of at least so many words count; the greatest share of the words they may cover
# together, and the greatest share that one of them may have. Two copies of a passage cover twice its length, so
# a repeat beyond half of what may be covered only stays below that if it overlaps itself: words that go round
# in circles. Published limits for repeated sequences (0.1 to 0.2) would turn down short clean texts with one line twice.
MIN_REPEAT = 8
MAX_COVERED = 0.45
MAX_LONGEST = MAX_COVERED / 2
# Words that are sorted together; a longer text is sorted alone and whole.
BATCH_WORDS = 200_000

_WORDS = re.compile(WORD)


def longest_repeats(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position the longest word sequence from it that also begins elsewhere in its text.

    ``words`` are the word numbers of several texts in a row, ``ends[i]`` is the end of the text that
    position ``i`` lies in. Prefix doubling: positions are grouped by their first 1, 2, 4, ... words
    until no group has two members; only groups that are still shared are sorted on. Common prefixes
    of neighbours are then read from the stored groupings, from the longest down.
    """
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    _, text = np.unique(ends, return_inverse=True)
    _, first, inverse, counts = np.unique(
        text.astype(np.int64) * (int(words.max()) + 1) + words, return_index=True, return_inverse=True, return_counts=True
    )
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    rank, shared = starts[inverse], counts[inverse] > 1
    levels, step = [rank], 1
    while shared.any():
        at = np.flatnonzero(shared)
        after = np.where(at + step < ends[at], rank[np.minimum(at + step, n - 1)], -1)
        order = np.lexsort((after, rank[at]))
        at, after = at[order], after[order]
        group = rank[at]
        new_group = np.concatenate(([True], group[1:] != group[:-1]))
        new_part = new_group | np.concatenate(([True], after[1:] != after[:-1]))
        index = np.arange(len(at))
        group_start = np.maximum.accumulate(np.where(new_group, index, 0))
        part_start = np.maximum.accumulate(np.where(new_part, index, 0))
        rank = rank.copy()
        rank[at] = group + part_start - group_start
        part_size = np.diff(np.append(np.flatnonzero(new_part), len(at)))
        shared = np.zeros(n, bool)
        shared[at] = np.repeat(part_size > 1, part_size)
        levels.append(rank)
        step *= 2
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    left, right = array[:-1].copy(), array[1:].copy()
    length = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        groups = np.append(levels[level], -1)
        same = (left < n) & (right < n)
        same &= groups[np.minimum(left, n)] == groups[np.minimum(right, n)]
        move = np.where(same, 1 << level, 0)
        length, left, right = length + move, left + move, right + move
    reach = np.zeros(n, np.int64)
    reach[array[:-1]] = length
    reach[array[1:]] = np.maximum(reach[array[1:]], length)
    return reach


def _covered(begin: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """How many of the spans lie over each of ``n`` positions."""
    change = np.bincount(begin, minlength=n + 1) - np.bincount(np.minimum(begin + length, n), minlength=n + 1)
    return np.cumsum(change[:n])


def _repetition(texts: list[list[str]]) -> list[tuple[int, int, int]]:
    """Per text: words in repeated windows, words under long repeats, longest repeat."""
    numbers: dict[str, int] = {}
    sizes = [len(t) for t in texts]
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, sum(sizes))
    bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    ends = np.repeat(bounds[1:], sizes)
    reach = longest_repeats(words, ends)
    n = len(words)
    windows, long = np.flatnonzero(reach >= WINDOW), np.flatnonzero(reach >= MIN_REPEAT)
    in_window = _covered(windows, np.full(len(windows), WINDOW), n) > 0
    in_long = _covered(long, reach[long], n) > 0
    total_window, total_long = np.concatenate(([0], np.cumsum(in_window))), np.concatenate(([0], np.cumsum(in_long)))
    longest = [int(reach[a:b].max()) if b > a else 0 for a, b in zip(bounds[:-1], bounds[1:])]
    return list(zip(np.diff(total_window[bounds]).tolist(), np.diff(total_long[bounds]).tolist(), longest))


def _repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = Counter(text.split("\n"))
    return sum(c - 1 for line, c in lines.items() if c > 1 and _WORDS.search(line))


NEW = [
    *[StructField(c, LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    StructField("covered_share", DoubleType()),
    StructField("longest_share", DoubleType()),
    StructField("base_failed", BooleanType()),
    StructField("kept", BooleanType()),
]


def _measure(texts: list[str | None]) -> dict[str, list]:
    out: dict[str, list] = {f.name: [] for f in NEW}
    group: list[list[str]] = []
    held = 0

    def close() -> None:
        nonlocal held
        for words, (repeated, covered, longest) in zip(group, _repetition(group)):
            n = len(words)
            failed = n < MIN_WORDS or 100 * repeated > 50 * n
            out["n_repeat_words"].append(repeated)
            out["covered_share"].append(covered / n if n else 0.0)
            out["longest_share"].append(longest / n if n else 0.0)
            out["base_failed"].append(failed)
            out["kept"].append(not failed and covered <= MAX_COVERED * n and (longest < MIN_REPEAT or longest <= MAX_LONGEST * n))
        group.clear()
        held = 0

    for text in texts:
        text = text or ""
        words = _WORDS.findall(text)
        out["n_words"].append(len(words))
        out["word_chars"].append(sum(map(len, words)))
        out["n_symbols"].append(sum(map(text.count, SYMBOLS)))
        out["n_dup_lines"].append(_repeated_lines(text))
        group.append(words)
        held += len(words)
        if held >= BATCH_WORDS:
            close()
    close()
    return out


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Append the counts of :data:`NEW`, ``base_failed`` and the verdict ``kept`` to every row.

    A NULL or empty text has no words and is not kept. Texts are measured whole, each on its own, so
    there is no shuffle and rows that are repeated get the same verdict. Columns of the new names are
    replaced.
    """
    return map_batches(df, lambda batch: _measure(batch.column(text).to_pylist()), NEW)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that pass, with their own columns, whatever their names; each row is sent through Python once."""
    at = docs.columns.index(text)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(_measure(batch.column(at).to_pylist())["kept"], pa.bool_()))

    return docs.mapInArrow(passing, docs.schema)


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document."""
    return measure(docs.select("doc_id", "text")).drop("text")


SQL = None
