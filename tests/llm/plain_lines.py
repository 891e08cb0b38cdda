"""The line operator's rule in plain Python."""

import re

from dealspark.llm import line_dedup


def words(text):
    return [w for w in re.split(r"[ \t\n\x0b\f\r]", text) if w]


def full_lines(text):
    """Numbers and texts of the lines that are not blank."""
    return [(i, x) for i, x in enumerate(text.split("\n")) if words(x)]


def plain_dedup(rows):
    """Texts of (id, text) rows, in their order; rows of one id have the same text.

    Every two lines in a row and every long line that an earlier place holds are
    found by looking all of them up; two-line pieces that follow each other go
    if they have words enough."""
    texts = {i: [x for _, x in full_lines(t)] for i, t in rows if i is not None and t is not None}
    seen, gone = set(), {}
    for i in sorted(texts):
        full, pairs, drop = texts[i], [], set()
        for m, line in enumerate(full):
            long = len(line) > 2 * line_dedup.LONG_WORDS and len(words(line)) > line_dedup.LONG_WORDS
            if long and (line,) in seen:
                drop.add(m)
            if tuple(full[m:m + 2]) in seen and m + 1 < len(full):
                pairs.append(m)
            seen |= {(line,), tuple(full[m:m + 2])}
        for m in pairs:
            if m - 1 in pairs:
                continue
            e = m
            while e + 1 in pairs:
                e += 1
            if len(words("\n".join(full[m:e + 2]))) >= line_dedup.MIN_WORDS:
                drop |= {(m, e + 1)}
        gone[i] = {(m, m) if isinstance(m, int) else m for m in drop}
    out = []
    for i, t in rows:
        if i is not None and t is not None:
            full = full_lines(t)
            drop = {k for s, e in gone[i] for k in range(full[s][0], full[e][0] + 1)}
            t = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop)
        out.append((i, t))
    return out
