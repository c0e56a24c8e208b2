"""Plain Python versions of the operators, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Awkward texts: null, empty, blank, white space of many kinds, one word, other scripts, no final line feed.
ODD = [None, "", " ", "\n\n", "a", "A\tb\x0b\x0cc\r\n d  e ", "中文 字 　x", "ẞ İİ ÀÉ", "  x", "x" * 5000, "a  b\n\n\n c"]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, k=5):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def components(docs):
    sets = {i: shingles(t) for i, t in docs}
    ids, top = sorted(sets), {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                top[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in ids}
