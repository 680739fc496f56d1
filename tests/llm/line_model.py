"""Line dedup (operator 10) in plain Python, as its docstring states the rule."""

import math
import re
from collections import Counter, defaultdict

import regex

from postclust.llm.line_templates import AGREEMENT, FIELD, LEADING, MIN_DOCS, MIN_WORDS

UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")
NUMBERED = re.compile(r"(?<!\S)[^\s0-9]*+[0-9]\S*", re.ASCII)


def words_of(line):
    return re.sub(r"\s+", " ", line, flags=re.ASCII).strip(" ").split(" ")


def tree_line(line):
    """``(leaf, words)`` of a line, or None if it is not in the tree."""
    words = words_of(NUMBERED.sub(FIELD, line))
    if len(words) < MIN_WORDS and len(UNSPACED.findall(line)) < MIN_WORDS:
        return None
    if all(w == FIELD for w in words):
        words = words_of(line)
        return (len(words), *words), tuple(words)
    return (len(words), *words[:LEADING]), tuple(words)


def common_members(forms):
    """Of a leaf's different lines those that match its common form."""
    constants = []
    for place in zip(*forms):
        n, word = max((n, w) for w, n in Counter(place).items())
        constants.append(word if n >= AGREEMENT * len(forms) else None)
    fixed = sum(c is not None for c in constants[LEADING:])
    if fixed < 1 or fixed < AGREEMENT * (len(constants) - LEADING) or all(c in (None, FIELD) for c in constants):
        return []
    return [f for f in forms if all(c is None or c == w for c, w in zip(constants, f))]


def run_forms(words):
    after = len(words) - LEADING
    run = after - math.ceil(AGREEMENT * after)
    if run >= 1:
        for at in range(LEADING, len(words) - run + 1):
            outside = words[:at] + words[at + run:]
            if any(w != FIELD for w in outside):
                yield at, outside


def shares_a_third(a, b):
    third = (len(a) - LEADING) // 3
    return a[LEADING:LEADING + third] == b[LEADING:LEADING + third] or a[len(a) - third:] == b[len(b) - third:]


def drop_recurring(docs):
    """``docs``: (id, text), ids distinct but for equal rows. Dropped line numbers by row."""
    order = lambda d: (d[0] is None, d[0] or 0)
    lines = {d: [tree_line(x) for x in d[1].split("\n")] for d in set(docs) if d[1] is not None}
    seen = defaultdict(lambda: defaultdict(set))  # leaf -> form -> documents
    for d, own in lines.items():
        for x in own:
            if x:
                seen[x[0]][x[1]].add(d)
    first = {}
    for leaf, forms in seen.items():
        for form, ds in forms.items():
            if len(ds) >= MIN_DOCS:
                first[leaf, form] = min(ds, key=order)
        if len(forms) == 1 or len(set().union(*forms.values())) < MIN_DOCS:
            continue
        near = [f for f in forms if any(f != g and shares_a_third(f, g) for g in forms)]
        held = defaultdict(set)
        for f in near:
            for t in run_forms(f):
                held[t].add(f)
        for f in near:
            docs_of = [set().union(*(forms[g] for g in held[t])) for t in run_forms(f) if len(held[t]) > 1]
            if good := [ds for ds in docs_of if len(ds) >= MIN_DOCS]:
                most = min(good, key=lambda ds: (-len(ds), min(map(order, ds))))
                first[leaf, f] = min(most, key=order)
        members = common_members(list(forms))
        ds = set().union(*(forms[f] for f in members)) if members else set()
        if len(ds) >= MIN_DOCS:
            for f in members:
                first[leaf, f] = min(ds, key=order)
    return {d: {i for i, x in enumerate(own) if x and first.get(x, d) != d} for d, own in lines.items()}


def model(docs):
    """``(id, text left, lines, dropped)`` of each row."""
    gone = drop_recurring(docs)
    out = []
    for d in docs:
        i, t = d
        if not t:
            out.append((i, t, 0, 0))
            continue
        own = t.split("\n")
        out.append((i, "\n".join(x for k, x in enumerate(own) if k not in gone[d]), len(own), len(gone[d])))
    return out
