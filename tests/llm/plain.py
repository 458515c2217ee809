"""Plain versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from math import ceil, exp, log

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(rows, k=2, percent=80):
    """doc_id -> (set size, component)."""
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        m = min(k, len(words))
        sets[i] = {tuple(words[j:j + m]) for j in range(len(words) - m + 1)} if m else set()
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != label[b]
            label[a] = label[b] = low
    return {i: (len(s), label[i]) for i, s in sets.items()}


def base_spans(text):
    """kind:start:end of the checked patterns, in order."""
    def luhn(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            x = int(c) * (1 + i % 2)
            total += x - 9 * (x > 9)
        return total % 10 == 0

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
    out = []
    for rank, (kind, pattern) in enumerate(kinds):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


def kneser_ney(texts, order=4):
    """Function from a text to its log probability sum, by the textbook formulas."""
    pad = "\x02" * (order - 1)
    counts = {order: Counter()}
    for text in texts:
        full = pad + text
        for i in range(order - 1, len(full)):
            counts[order][full[i - order + 1:i + 1]] += 1
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cuts, totals, weights = {}, {}, {}
    for n, own in counts.items():
        seen = Counter(c for c in own.values() if c <= 4)
        n1, n2, n3, n4 = (seen[i] for i in range(1, 5))
        y = n1 / (n1 + 2 * n2) if n1 else 0
        ratio = lambda a, b: a / b if b else 0
        raw = (1 - 2 * y * ratio(n2, n1), 2 - 3 * y * ratio(n3, n2), 3 - 4 * y * ratio(n4, n3))
        cuts[n] = [min(max(d, 0.1 * (i + 1)), i + 1.0) for i, d in enumerate(raw)]
        total, cut = defaultdict(int), defaultdict(float)
        for gram, c in own.items():
            total[gram[:-1]] += c
            cut[gram[:-1]] += cuts[n][min(c, 3) - 1]
        totals[n], weights[n] = total, {h: cut[h] / total[h] for h in total}

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / (len(counts[1]) + 1)
        context = gram[:-1]
        if context not in totals[n]:
            return p(gram[1:])
        c = counts[n].get(gram, 0)
        own = max(c - cuts[n][min(c, 3) - 1], 0) / totals[n][context] if c else 0
        return own + weights[n][context] * p(gram[1:])

    return lambda text: sum(log(p((pad + text)[i:i + order])) for i in range(len(text)))


def perplexity(score, text):
    return exp(-score(text) / len(text))


def quality(rows, labels, quantile=0.995, factor=1.02, enough=20, prior=200.0):
    """doc_id -> whether a document of (doc_id, text, lang) is kept, for labels of (doc_id, quality)."""
    worst = {}
    for i, good in labels:
        if i is not None and good is not None:
            worst[i] = min(good, worst.get(i, 1))
    trusted = {i for i, good in worst.items() if good == 1}
    apart = {i for i in trusted if zlib.crc32(str(i).encode()) % 2 == 0}
    score = kneser_ney([t or "" for i, t, _ in rows if i in trusted - apart])
    seen = [(i, lang, len(t), score(t)) for i, t, lang in rows if t]
    unseen = [(lang, n, s) for i, lang, n, s in seen if i in apart]

    def of_language(lang, value):
        own = [x for x in unseen if x[0] == lang] if lang is not None else []
        return value(own if len(own) >= enough else unseen)

    def smoothed(lang, n, s):
        usual = of_language(lang, lambda own: -sum(x[2] for x in own) / sum(x[1] for x in own))
        return exp((prior * usual - s) / (n + prior))

    def threshold(lang):
        def highest(own):
            steps = sorted(ceil(smoothed(*x) / 0.001) for x in own)
            return steps[ceil(len(steps) * quantile) - 1] * 0.001 * factor

        return of_language(lang, highest)

    kept = {i: smoothed(lang, n, s) <= threshold(lang) for i, lang, n, s in seen}
    return {i: kept.get(i, False) for i, _, _ in rows}
