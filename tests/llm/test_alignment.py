"""Alignment against the whole table of scores, and its memory."""

import random
import tracemalloc

import numpy as np

from shelfmark.llm.decontamination import GAP, MATCH, MISMATCH, align


def whole_table(item, text):
    """The first best cell in reading order, followed back over the diagonal, the item, the text."""
    table = [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    best = (0, 0, 0)
    for i in range(1, len(item) + 1):
        for j in range(1, len(text) + 1):
            pair = MATCH if item[i - 1] == text[j - 1] else MISMATCH
            table[i][j] = max(0, table[i - 1][j - 1] + pair, table[i - 1][j] + GAP, table[i][j - 1] + GAP)
            if table[i][j] > best[0]:
                best = (table[i][j], i, j)
    score, i, j = best
    end, matched = j, 0
    while table[i][j]:
        pair = MATCH if item[i - 1] == text[j - 1] else MISMATCH
        if table[i][j] == table[i - 1][j - 1] + pair:
            matched += pair == MATCH
            i, j = i - 1, j - 1
        elif table[i][j] == table[i - 1][j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, matched, j, end


def test_equals_the_whole_table():
    rng = random.Random(31)
    for k in range(400):
        kinds = rng.choice([2, 4, 30])
        item = np.array([rng.randrange(kinds) for _ in range(rng.randrange(1, 25))], np.uint64)
        text = [rng.randrange(kinds) for _ in range(rng.randrange(0, 40))]
        if k % 3 == 0:  # an edited copy inside
            text[5:5] = [x for x in item.tolist() if rng.random() < 0.85]
        text = np.array(text, np.uint64)
        assert align(item, text) == whole_table(item.tolist(), text.tolist())


def test_long_items_take_bits_and_not_numbers():
    rng = np.random.default_rng(3)
    item = rng.integers(0, 1 << 60, 3000).astype(np.uint64)
    text = np.concatenate([rng.integers(0, 1 << 60, 1500).astype(np.uint64), np.delete(item, [700, 701, 2000]), item[:1500]])
    tracemalloc.start()
    score, matched, start, end = align(item, text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (score, matched, start, end) == (2997 * MATCH + 3 * GAP, 2997, 1500, 4497)
    assert peak < 12e6  # the table itself would be 72 MB
