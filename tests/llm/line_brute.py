"""Line dedup in plain Python, by its rules and without its joins."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import chain

from riskmart.llm.line_templates import DEPTH, MIN_DOCS, MIN_SIMILAR_PERCENT, WILD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def masked(line: str) -> tuple[str, ...]:
    words = WORD.findall(line)
    return tuple(WILD if re.search("[0-9]", w) else w for w in words) if len(words) >= DEPTH else tuple(words)


def templates(leaf: Counter, min_docs: int, name) -> dict:
    """Template of each masked line of a leaf (line: how often)."""
    found, groups = {}, [(name, dict(leaf))]
    while groups:
        name, lines = groups.pop()
        if sum(lines.values()) < min_docs:
            continue
        size, total = len(next(iter(lines))), sum(lines.values())
        at = [Counter() for _ in range(size)]
        for t, n in lines.items():
            for p, w in enumerate(t):
                at[p][w] += n
        top = [max(c, key=c.get) for c in at]
        shape = [w if 2 * c[w] > total else None for c, w in zip(at, top)]
        fits = {t for t in lines if 100 * sum(a == b for a, b in zip(t, shape)) >= MIN_SIMILAR_PERCENT * size}
        found.update(dict.fromkeys(fits, name))
        rest = {t: n for t, n in lines.items() if t not in fits}
        if sum(rest.values()) < min_docs:
            continue
        if fits:
            groups.append(((name, "rest"), rest))
            continue
        cuts = [(covered, -len(c), -p) for p, c in enumerate(at)
                if (covered := sum(n for n in c.values() if n >= min_docs)) and len(c) > 1]
        if not cuts:
            continue
        p = -max(cuts)[2]
        often = Counter()
        for t, n in rest.items():
            often[t[p]] += n
        parts = defaultdict(dict)
        for t, n in rest.items():
            parts[(name, p, t[p]) if often[t[p]] >= min_docs else (name, "rest")][t] = n
        groups += list(parts.items())
    return found


def recurring(docs: list[tuple], min_docs: int = MIN_DOCS) -> dict:
    """For each distinct (doc_id, text): the places of the lines to drop."""
    rows = {d: [(j, masked(line)) for j, line in enumerate((d[1] or "").split("\n")) if WORD.search(line)] for d in dict.fromkeys(docs)}
    leaves = defaultdict(Counter)
    for _, t in chain(*rows.values()):
        leaves[(len(t), t[:DEPTH])][t] += 1
    template = {}
    for leaf, lines in leaves.items():
        if sum(lines.values()) >= min_docs:
            template.update({t: t for t in lines} | templates(lines, min_docs, ("leaf", leaf)))
    held = {d: [(j, template[t]) for j, t in lines if t in template] for d, lines in rows.items()}
    by_template = Counter(chain(*(set(x for _, x in lines) for lines in held.values())))
    held = {d: kept for d, lines in held.items() if (kept := [(j, x) for j, x in lines if by_template[x] >= min_docs])}
    # Copies: the rarest template of a document, and the templates most documents with it hold.
    sets = {d: {x for _, x in lines} for d, lines in held.items()}
    order = {x: i for i, x in enumerate(sorted(by_template, key=str))}
    rarest = {d: min(s, key=lambda x: (by_template[x], order[x])) for d, s in sets.items()}
    with_mark = defaultdict(list)
    for s in sets.values():
        for x in s & set(rarest.values()):
            with_mark[x].append(s)
    common = {x: frozenset(t for t, n in Counter(chain(*with_mark[x])).items() if 2 * n > by_template[x]) for x in set(rarest.values())}
    text = {}
    for d, lines in held.items():
        own = len(rows[d]) - len({j for j, _ in lines})
        lacks = len(common[rarest[d]]) - len(common[rarest[d]] & sets[d])
        text[d] = ("copy", common[rarest[d]]) if own <= lacks else ("own", d)
    texts = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            texts[x].add(text[d])
    return {d: {j for j, x in lines if len(texts[x]) >= min_docs} for d, lines in held.items()}


def report(docs: list[tuple], min_docs: int = MIN_DOCS) -> list[tuple]:
    """``doc_id, n_lines, n_dropped, cleaned`` of each row."""
    gone, out = recurring(docs, min_docs), []
    for doc_id, text in docs:
        lines = [] if text is None else text.split("\n")
        drop = gone.get((doc_id, text), set())
        cleaned = None if text is None else "\n".join(x for j, x in enumerate(lines) if j not in drop)
        out.append((doc_id, len(lines), len(drop), cleaned))
    return out
