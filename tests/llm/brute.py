"""Plain versions of the operators, for tests."""

import hashlib
import math
import re
from collections import Counter, defaultdict

from corpusloom.llm.quality_rules import ALPHA, DELTA, GRIDS, MAX_STRATA, SYMBOLS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if grams[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in SYMBOLS for c in text), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}
    n = len(w)
    signals = [1000 * out["n_symbols"] // max(n, 1), 1000 * out["n_dup_lines"] // max(len(lines), 1), 1000 * len(covered) // max(n, 1), 1000 * out["word_chars"] // max(n, 1), -(1000 * out["word_chars"] // max(n, 1))]
    return out | {"base_failed": n < 50 or 100 * len(covered) > 50 * n}, signals


def tail(k, n, p):
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    return math.fsum(math.exp(log(i)) for i in range(k + 1))


def quality(rows, labels, alpha=ALPHA):
    """rows: (doc_id, lang, text); labels: (doc_id, quality). (doc_id, counts, kept) of each row."""
    lab = {}
    for d, q in labels:
        if q is not None:
            lab[d] = min(q, lab.get(d, q))
    all_counts = [(d, lang, *counts(t)) for d, lang, t in rows]
    fit, hold = defaultdict(list), defaultdict(list)
    for d, lang, c, x in all_counts:
        if d in lab and not c["base_failed"]:
            in_hold = hashlib.md5(f"quality:{d}".encode()).hexdigest()[0] < "8"
            fit[lang], hold[lang]  # noqa: B018  a stratum of its own, even if empty
            (hold if in_hold else fit)[lang].append((lab[d] == 1, x))
    strata = fit.keys() | hold.keys()
    assert len(strata) <= MAX_STRATA
    best = {}
    for lang in strata:
        order = []
        for s, cuts in enumerate(GRIDS.values()):
            for cut in cuts:
                goods, bads = ([x[s] > cut for g, x in fit[lang] if g == want] for want in (True, False))
                if sum(bads) * len(goods) > sum(goods) * len(bads):
                    order.append(((sum(goods) + 1) / (sum(bads) + 1), s, -cut))
        goods = [x for g, x in hold[lang] if g]
        rule = []
        for _, s, cut in sorted(order):
            rule.append((s, -cut))
            k, n = sum(any(x[i] > c for i, c in rule) for x in goods), len(goods)
            if not (k < n * alpha and tail(k, n, alpha) <= DELTA / (len(strata) + 1)):
                break
            best[lang, s] = min(-cut, best.get((lang, s), -cut))
    hit = lambda lang, x: any((lang, s) in best and v > best[lang, s] for s, v in enumerate(x))
    return [(d, c, not c["base_failed"] and not hit(lang, x)) for d, lang, c, x in all_counts]


def mix_targets(sizes, max_epochs=3):
    """sizes: {source: words}. {source: target}, None last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    clamped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(max_epochs * sizes[s] for s in clamped)
        w = sum(weight[s] for s in names if s not in clamped)
        share = {s: float(max_epochs * sizes[s]) if s in clamped else weight[s] * float(left) / w for s in names}
        more = {s for s in names if s not in clamped and share[s] > max_epochs * sizes[s]}
        if not more:
            return share
        clamped |= more


def mix(rows):
    """rows: (doc_id, text, source). (doc_id, size, source_size, target, taken, times) of each row; times in whole documents."""
    sized = [(d, s, len(WORD.findall(t or ""))) for d, t, s in rows]
    sizes = Counter()
    for _, s, n in sized:
        sizes[s] += n
    out, left = [], {}
    for s, t in mix_targets(sizes).items():
        goal = math.floor(t + 0.5)
        left[s] = (t, goal // max(sizes[s], 1), goal % max(sizes[s], 1) if sizes[s] else goal)
    key = lambda r: (hashlib.md5(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, r[2])
    rest = {s: x[2] for s, x in left.items()}
    for d, s, n in sorted(sized, key=key):
        part = max(0, min(n, rest[s]))
        times = left[s][1] + (2 * rest[s] >= n) if n else 0
        out.append((d, n, sizes[s], left[s][0], left[s][1] * n + part, times))
        rest[s] -= n
    return out
