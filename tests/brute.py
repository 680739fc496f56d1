"""Plain-Python models of the analysis semantics, for brute-force comparison on
small inputs. Straightforward loops, no Spark."""

from __future__ import annotations

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def jvm_split(line: str) -> list[str]:
    """Split on ',' dropping trailing empty fields (an all-empty result of a
    non-empty line is no field at all; the empty line is one empty field)."""
    if line == "":
        return [""]
    fields = line.split(",")
    while fields and fields[-1] == "":
        fields.pop()
    return fields


def parse_int(s: str, lo: int, hi: int):
    """Signed decimal integer within [lo, hi], else None."""
    body = s[1:] if s[:1] in ("+", "-") else s
    if not body or not all("0" <= ch <= "9" for ch in body):
        return None
    v = int(s)
    return v if lo <= v <= hi else None


def parse_line(line: str):
    """(posting tuple, None) for a good line, (None, reason) for a bad one."""
    f = jvm_split(line)

    def get(i):
        return f[i] if i < len(f) else None

    pt = get(0)
    if pt is None:
        return None, "posting_type: missing"
    pt_v = parse_int(pt, INT_MIN, INT_MAX)
    if pt_v is None:
        return None, "posting_type: not an int"
    ident = get(1)
    if ident is None:
        return None, "id: missing"
    id_v = parse_int(ident, LONG_MIN, LONG_MAX)
    if id_v is None:
        return None, "id: not an int"
    opt = []
    for i, name in ((2, "accepted_answer"), (3, "parent_id")):
        s = get(i)
        if s is None:
            return None, f"{name}: missing"
        if s == "":
            opt.append(None)
            continue
        v = parse_int(s, LONG_MIN, LONG_MAX)
        if v is None:
            return None, f"{name}: not an int"
        opt.append(v)
    score = get(4)
    if score is None:
        return None, "score: missing"
    score_v = parse_int(score, INT_MIN, INT_MAX)
    if score_v is None:
        return None, "score: not an int"
    return (pt_v, id_v, opt[0], opt[1], score_v, get(5)), None


def trunc_div(a: int, b: int) -> int:
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def sq(a, b) -> float:
    dx = float(a[0] - b[0])
    dy = float(a[1] - b[1])
    return dx * dx + dy * dy


def closest(p, centers) -> int:
    best, best_d = 0, float("inf")
    for i, c in enumerate(centers):
        d = sq(p, c)
        if d < best_d:
            best, best_d = i, d
    return best


def kmeans(vectors, means, eta, max_iterations):
    """Returns (final means, iterations, converged)."""
    means = list(means)
    it = 1
    while True:
        groups: dict[int, list] = {}
        for v in vectors:
            groups.setdefault(closest(v, means), []).append(v)
        new = list(means)
        for i, vs in groups.items():
            new[i] = (trunc_div(sum(v[0] for v in vs), len(vs)), trunc_div(sum(v[1] for v in vs), len(vs)))
        shift = 0.0
        for a, b in zip(means, new):
            shift += sq(a, b)
        if shift < eta:
            return new, it, True
        if it >= max_iterations:
            return new, it, False
        means, it = new, it + 1


def median(ys) -> int:
    s = sorted(ys)
    half = len(s) // 2
    if len(s) % 2 == 0:
        return trunc_div(s[half - 1] + s[half], 2)
    return s[half]


def cluster_summary(vectors, means, langs, spread):
    """{cid: (lang, pct, size, median)} for non-empty clusters; count ties
    between languages go to the smaller x."""
    groups: dict[int, list] = {}
    for v in vectors:
        groups.setdefault(closest(v, means), []).append(v)
    out = {}
    for cid, vs in groups.items():
        by_x: dict[int, list] = {}
        for x, y in vs:
            by_x.setdefault(x, []).append(y)
        x_dom = min(by_x, key=lambda x: (-len(by_x[x]), x))
        ys = by_x[x_dom]
        out[cid] = (langs[trunc_div(x_dom, spread)], len(ys) * 100.0 / len(vs), len(vs), median(ys))
    return out
