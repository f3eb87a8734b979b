"""Plain second computations that several tests compare with."""

import itertools
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def plain_groups(texts, similarity=0.8, counted=False):
    sets = {}
    for i, text in texts.items():
        w = words(text)
        n = min(5, len(w))
        grams = [tuple(w[j : j + n]) for j in range(len(w) - n + 1)] if w else []
        sets[i] = {(g, k) for g in set(grams) for k in range(grams.count(g) if counted else 1)}
    group = {i: i for i in texts}
    for a, b in itertools.combinations(texts, 2):
        if sets[a] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
            low, high = sorted((group[a], group[b]))
            group = {i: low if g == high else g for i, g in group.items()}
    return group
