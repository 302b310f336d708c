"""The operators in plain Python over small lists, written without the library's code."""

import hashlib
import html
import math
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

BLANK = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folded(text):
    return re.findall(r"(?:[^\W_]|[̀-ͯ])+", (text or "").lower())


def runs(text, width=5):
    w = folded(text)
    return [tuple(w[i : i + width]) for i in range(max(len(w) - width, 0) + 1)] if w else []


# --- quality


def counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if x.strip(BLANK)]
    windows = defaultdict(list)
    for i in range(len(w) - 7):
        windows[tuple(w[i : i + 8])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "lines": len(lines),
        "capitals": sum(c.isupper() for c in text or ""),
    }


def _cut(bins, share):
    need, upto = share * len(bins), 0
    for b, n in sorted(Counter(bins).items()):
        upto += n
        if upto >= need:
            return b


def _chi2(x, degrees):
    """Closed forms for five and seven degrees."""
    five = math.erf(math.sqrt(x / 2)) - math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)
    return five if degrees == 5 else five - math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * x * x / 15


def _chi2_at(share):
    low, high = 0.0, 100.0
    for _ in range(100):
        low, high = ((low + high) / 2, high) if _chi2((low + high) / 2, 5) < share else (low, (low + high) / 2)
    return low


def quality(docs, subset=0.75):
    """``{row number: (counts, base_failed, squared distance or None, kept)}`` of (id, text, lang, source) rows."""
    cutoff = _chi2_at(1 - 1.5e-5)
    floors = (0.06, 0.05, 0.155, 0.95 * math.sqrt(0.3 / cutoff), 0.08)
    factor = subset / _chi2(_chi2_at(subset), 7)
    out, groups = {}, defaultdict(list)
    for i, (_, text, lang, source) in enumerate(docs):
        c = counts(text)
        failed = c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]
        out[i] = [c, failed, None, False]
        if not failed:
            root = lambda a, b: math.sqrt(a / max(b, 1))
            x = [
                math.log(max(c["word_chars"], 1) / max(c["n_words"], 1)), root(c["n_symbols"], c["word_chars"]), root(c["n_dup_lines"], c["lines"]),
                root(c["n_repeat_words"], c["n_words"]), root(c["capitals"], c["word_chars"]),
            ]
            groups[lang, source].append((i, x))
    bins = lambda d2: np.floor(np.log1p(d2) * 200).astype(int)

    def fitted(near, by):
        cov = np.cov(near.T, bias=True).reshape(5, 5) * by + np.diag(np.square(floors))
        return near.mean(axis=0), cov

    def distances(x, fit):
        diff = x - fit[0]
        return np.einsum("ij,jk,ik->i", diff, np.linalg.inv(fit[1]), diff)

    # both starts of all groups take steps together until no cut moves
    runs_, last = {}, None
    for g, rows in groups.items():
        x = np.array([r[1] for r in rows])
        med = lambda v: (_cut(np.floor(v * 200).astype(int).tolist(), 0.5) + 0.5) / 200
        centre = np.array([med(x[:, k]) for k in range(5)])
        spread = np.array([med(np.abs(x[:, k] - centre[k])) for k in range(5)])
        runs_[g, 0] = [x, (((x - centre) / (1.4826 * spread + np.array(floors))) ** 2).sum(axis=1), None]
        runs_[g, 1] = [x, distances(x, fitted(x, 1.0)), None]
    for _ in range(30):
        cuts = {k: _cut(bins(d2).tolist(), subset) for k, (_, d2, _) in runs_.items()}
        if cuts == last:
            break
        for k, run in runs_.items():
            run[2] = fitted(run[0][bins(run[1]) <= cuts[k]], factor)
            run[1] = distances(run[0], run[2])
        last = cuts
    for g, rows in groups.items():
        best = min((0, 1), key=lambda n: (np.linalg.slogdet(runs_[g, n][2][1])[1], n))
        for (i, _), value in zip(rows, runs_[g, best][1]):
            out[i][2], out[i][3] = float(value), bool(value <= cutoff)
    return {i: tuple(v) for i, v in out.items()}


# --- lines


def lines(docs, min_sites=5):
    """Texts of (id, text, lang, source) rows without cross-site lines."""
    sites = defaultdict(set)
    for _, text, _, source in docs:
        for line in (text or "").split("\n"):
            if line.strip(BLANK) and source is not None:
                sites[line.strip(BLANK)].add(source)
    spread = {x for x, s in sites.items() if len(s) >= min_sites}
    out = []
    for _, text, _, _ in docs:
        if text is None:
            out.append(None)
            continue
        parts = text.split("\n")
        rest = [x for x in parts if x.strip(BLANK) not in spread]
        out.append("\n".join(rest) if any(x.strip(BLANK) for x in rest) else text)
    return out


# --- near copies


def similarity(a, b):
    a, b = Counter(runs(a)), Counter(runs(b))
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def classes(docs, threshold=0.8):
    """Class of every row by the smallest id linked to it."""
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [Counter(runs(d[1])) for d in docs]
    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for r in s:
            holders[r].add(i)
    pairs = {p for h in holders.values() for p in combinations(sorted(h), 2)}
    for i, j in pairs:
        both = sum((sets[i] & sets[j]).values())
        if both >= threshold * (sum(sets[i].values()) + sum(sets[j].values()) - both):
            parent[root(j)] = root(i)
    low = {}
    for i, d in enumerate(docs):
        if d[0] is not None:
            low[root(i)] = min(low.get(root(i), d[0]), d[0])
    return [low.get(root(i)) if sets[i] else docs[i][0] for i in range(len(docs))]


# --- test items


def contained(docs, items, threshold=0.8):
    """``{(row number, item): (shared, n)}``"""
    out = {}
    for item, text in items:
        want = set(runs(text))
        for i, d in enumerate(docs):
            w = folded(d[1])
            width = len(next(iter(want))) if want else 5
            have = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
            if want and len(want & have) >= threshold * len(want) - 1e-9:
                out[i, item] = (len(want & have), len(want))
    return out


# --- mixture


def mixture(docs, entropy_gain=0.5, max_repeats=4.0, block_tokens=100_000):
    """``[(id, source, pass, block, place, tokens)]`` of (id, text, lang, source) rows."""
    by = defaultdict(list)
    for i, text, _, source in docs:
        by[source].append((i, len(words(text)), None if text is None else hashlib.md5(text.encode()).hexdigest()))
    totals = {s: sum(r[1] for r in rows) for s, rows in by.items()}
    budget = sum(totals.values())
    live = {s: t / budget for s, t in totals.items() if t} if budget else {}
    if not live:
        return []

    def weights(a):
        z = sum(p**a for p in live.values())
        return {s: p**a / z for s, p in live.items()}

    entropy = lambda a: -sum(q * math.log(q) for q in weights(a).values())
    goal = entropy(1) + entropy_gain * (math.log(len(live)) - entropy(1))
    low, high = 0, 2**20
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if entropy(mid / 2**20) >= goal else (low, mid)
    a = low / 2**20
    drawn = lambda *parts: hashlib.md5(":".join(["mix", *(str(x) for x in parts if x is not None)]).encode()).hexdigest()
    repeats = lambda a: max(q * budget / totals[s] for s, q in weights(a).items())
    if repeats(a) > max_repeats:
        low, high = 0, 2**20
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (low, mid) if repeats(mid / 2**20) <= max_repeats else (mid, high)
        a = high / 2**20
    blocks, draws = max(1, math.ceil(budget / block_tokens)), []
    for s, q in weights(a).items():
        quota, at, turn = math.floor(q * budget), 0, 0
        while at < quota:
            for i, n, t in sorted(by[s], key=lambda r: (drawn(turn, r[0], s, r[2]), r[0] is not None, r[0], r[1])):
                if at < quota:
                    draws.append((min(int(at / quota * blocks), blocks - 1), i, s, turn, n, at, t))
                at += n
            turn += 1
    draws.sort(key=lambda r: (r[0], drawn(r[0], r[3], r[1], r[2], r[6]), r[1] is not None, r[1], r[3], str(r[2]), r[5]))
    place, out = Counter(), []
    for block, i, s, turn, n, *_ in draws:
        out.append((i, s, turn, block, place[block], n))
        place[block] += 1
    return out


# --- pages


def article(source):
    found = re.search(r"<article>(.*?)</article>", source or "", re.S)
    text = re.sub(r"</?(p|br|h1)>", " ", found[1]).replace("<b>", "").replace("</b>", "") if found else ""
    return " ".join(html.unescape(text).split())
