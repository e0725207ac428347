"""Fixtures and brute-force versions for the operators of ``riskflow.llm``."""

import random
import re
import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SYLLABLES = ["ba", "do", "ki", "lu", "me", "na", "po", "ri", "sa", "tu", "vo", "ze"]


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))


def edited(rng: random.Random, text: str, times: int) -> str:
    words = text.split(" ")
    for _ in range(times):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


def documents(spark, rows, extra=""):
    """rows: (doc_id, text[, lang, source])."""
    full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def corpus(seed: int = 1, texts: int = 60, family: int = 40) -> list[tuple[int, str | None]]:
    """Prose, exact copies, a large family of near copies, a shared passage, and odd texts."""
    rng = random.Random(seed)
    out = [prose(rng, rng.choice([3, 7, 40, 120, 300])) for _ in range(texts)]
    base = prose(rng, 150)
    out += [edited(rng, base, rng.choice([0, 1, 2, 4, 8])) for _ in range(family)]
    passage = prose(rng, 70)
    out += [prose(rng, 40) + " " + passage + " " + prose(rng, 60) for _ in range(20)]
    out += out[:10] + [out[0].upper(), out[3] + " " + prose(rng, 2)]
    out += [None, None, "", "", "   ", "a b", "A  b", "one", "\n\t", "é ü ñ", "x " * 400, "the end. " * 120, prose(rng, 4000)]
    rng.shuffle(out)
    return list(enumerate(out))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, k=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


class Union:
    def __init__(self, nodes):
        self.p = {n: n for n in nodes}

    def find(self, a):
        while self.p[a] != a:
            self.p[a] = self.p[self.p[a]]
            a = self.p[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.p[max(a, b)] = min(a, b)


def jaccard_components(rows):
    """doc_id -> (set size, least doc_id of its component)."""
    sets = {i: shingles(t) for i, t in rows}
    u = Union(sets)
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                u.join(i, j)
    return {i: (len(s), u.find(i)) for i, s in sets.items()}
